"""Numeric column functions: parsing with suppression tokens, guarded division, count intervals."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SUPPRESSED = ("", "*", "-", "--", "N/A", "n/a", "NA", "null", "NULL")
DASHES = ("", "-", "--", "–", "—", "*", "†", "‡")


def truthy(x: Column) -> Column:
    """x, with 0 and NaN as null: a count of zero counts as missing."""
    return F.nullif(F.nanvl(x.cast("double"), F.lit(0.0)), F.lit(0.0))


def or_zero(x: Column) -> Column:
    return F.coalesce(F.nanvl(x.cast("double"), F.lit(0.0)), F.lit(0.0))


def safe_float(x: Column, suppressed: tuple[str, ...] = SUPPRESSED) -> Column:
    """A number from text; suppression tokens and what isn't a number are null."""
    t = F.trim(x)
    return F.when(~t.isin(*suppressed), t.try_cast("double"))


def safe_int(x: Column) -> Column:
    """Like safe_float, cut off towards zero."""
    return safe_float(x).cast("long")


def safe_percent(x: Column, as_decimal: bool = True) -> Column:
    v = safe_float(x)
    return v / 100 if as_decimal else v


def float_with_commas(x: Column) -> Column:
    """A number written with thousands separators; dashes and footnote marks are null."""
    t = F.trim(F.replace(x, F.lit(","), F.lit("")))
    return F.when(~t.isin(*DASHES), t.try_cast("double"))


def safe_divide(n: Column, d: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(default))


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def within_tolerance(actual: Column, expected: Column, percent: float) -> Column:
    """Whether actual differs from expected by `percent` at most; for an expected 0 only 0 does."""
    return F.when(expected == 0, actual == 0).otherwise(F.abs(actual - expected) * 100 <= F.abs(expected) * percent)


def count_interval(n: Column, level: float = 0.95) -> tuple[Column, Column]:
    """Low and high end of a Poisson interval of a count."""
    z = 2.576 if level >= 0.99 else 1.96
    n = n.cast("double")
    low = F.when(n <= 0, F.lit(0)).otherwise(F.greatest((n - z * F.sqrt(n)).cast("long"), F.lit(0)))
    high = F.when(n <= 0, F.lit(math.ceil(-math.log(1 - level)))).otherwise(F.ceil(n + z * F.sqrt(n)))
    return low.cast("long"), high.cast("long")


def discrepancy(claimed: Column, actual: Column, level: float = 0.95) -> Column:
    """(percent, severity) of a claimed count against an actual one, by the claimed count's interval.

    info inside the interval; warning outside it; critical where only one of the two is 0 or the counts differ twofold.
    """
    low, high = count_interval(claimed, level)
    percent = F.when(claimed == 0, F.when(actual == 0, F.lit(0.0)).otherwise(F.lit(100.0))).otherwise(F.round(F.abs(actual - claimed) * 100.0 / claimed, 4))
    one_zero = (claimed == 0) != (actual == 0)
    severity = F.when(one_zero, "critical").when(actual.between(low, high), "info").when((actual > 2 * claimed) | (2 * actual < claimed), "critical").otherwise("warning")
    return F.struct(percent.alias("percent"), severity.alias("severity"))


def backoff_ms(attempt: Column, first: int = 1000, most: int = 8000) -> Column:
    """The wait before a retry, without its random part: doubling from `first` up to `most`."""
    return F.least(F.lit(first) * F.pow(F.lit(2), attempt - 1), F.lit(most)).cast("long")


def input_hash(*counts: Column) -> Column:
    """Sixteen hex digits that stand for the sizes of a run's inputs."""
    return F.left(F.md5(F.concat_ws(":", *counts).cast("binary")), F.lit(16))


def combine_scores(model: Column, pattern: Column, weight: float = 0.7) -> Column:
    """A model's score and a pattern score weighed together; without a model score the pattern score alone."""
    return F.when(model.isNotNull(), weight * model + (1 - weight) * pattern).otherwise(pattern)
