"""School years, clock times and year windows as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COVID_YEARS = ("2019-20", "2020-21", "2021-22", "2022-23")


def start_year(x: Column) -> Column:
    """2023 from "2023-24"; null where the first four characters are no number."""
    return F.substring(x, 1, 4).try_cast("int")


def year_span(a: Column, b: Column) -> Column:
    return F.abs(start_year(a) - start_year(b))


def span_of(*years: Column) -> Column:
    """Years between the first and the last known start year; 0 where fewer than two are known."""
    known = F.filter(F.array(*[start_year(y) for y in years]), lambda y: y.isNotNull())
    return F.coalesce(F.array_max(known) - F.array_min(known), F.lit(0))


def in_window(*years: Column, most: int = 3) -> Column:
    return span_of(*years) <= most


def temporal_flags(span: Column, baseline: Column | None = None) -> Column:
    flags = [F.when(span.between(2, 3), "WARN_YEAR_GAP"), F.when(span > 3, "ERR_SPAN_EXCEEDED")]
    if baseline is not None:
        flags.append(F.when(baseline, "INFO_RATIO_BASELINE"))
    return F.filter(F.array(*flags), lambda f: f.isNotNull())


def temporal_class(span: Column) -> Column:
    return F.when(span.isNull(), "UNKNOWN").when(span == 0, "SAME_YEAR").when(span <= 3, "VALID_BLEND").otherwise("SPAN_EXCEEDED")


def covid_year(x: Column) -> Column:
    return F.coalesce(x.isin(*COVID_YEARS), F.lit(False))


def staleness(x: Column, now: int, most: int = 3) -> Column:
    old = F.lit(now) - start_year(x)
    return F.when(old.isNull(), "UNKNOWN").when(covid_year(x), "COVID").when(old > most, "STALE").otherwise("CURRENT")


_STRICT = r"(?i)^\s*(\d{1,2}):(\d{2})\s*(AM|PM)\s*$"
_LENIENT = r"(?i)^\s*(\d{1,2}):(\d{2})\s*(AM|PM)?"


def _minutes(x: Column, pattern: str) -> Column:
    part = lambda i: F.regexp_extract(x, pattern, i)
    hour, minute, half = part(1).try_cast("int"), part(2).try_cast("int"), F.upper(part(3))
    hour = F.when((half == "AM") & (hour == 12), 0).when((half == "PM") & (hour != 12), hour + 12).otherwise(hour)
    return F.when(x.rlike(pattern), hour * 60 + minute)


def clock_minutes(x: Column) -> Column:
    """Minutes from midnight of "8:05 AM"; null for any other form."""
    return _minutes(x, _STRICT)


def clock_minutes_lenient(x: Column) -> Column:
    """Like clock_minutes, the half of the day may be left out."""
    return _minutes(x, _LENIENT)


def normal_time(x: Column) -> Column:
    """"8:05 AM" from "8:05 a.m." or "8:05"; without a half of the day hours 6 to 11 are AM, 12 and 1 to 5 PM."""
    t = F.upper(F.trim(F.regexp_replace(F.regexp_replace(x, r"(?i)a\.?m\.?", "AM"), r"(?i)p\.?m\.?", "PM")))
    hour, minute = F.regexp_extract(t, r"(\d{1,2}):(\d{2})", 1).try_cast("int"), F.regexp_extract(t, r"(\d{1,2}):(\d{2})", 2)
    half = F.when(t.contains("AM"), "AM").when(t.contains("PM"), "PM").when(hour.between(6, 11), "AM").when((hour == 12) | hour.between(1, 5), "PM").otherwise("")
    return F.when(hour.isNotNull(), F.trim(F.concat(hour.cast("string"), F.lit(":"), minute, F.lit(" "), half)))


def marked_time(x: Column) -> Column:
    """Like normal_time, with the digits as they are written and other hours left without a half."""
    t = F.trim(x)
    for pattern, half in ((r"(?i)a\.m\.|am", "AM"), (r"(?i)p\.m\.|pm", "PM")):
        t = F.regexp_replace(t, pattern, half)
    t = F.regexp_replace(t, r"(\d)(AM|PM)", "$1 $2")
    hour = F.regexp_extract(t, r"^(\d{1,2}):\d{2}", 1).try_cast("int")
    half = F.when(hour.between(6, 11), " AM").when((hour == 12) | hour.between(1, 5), " PM").otherwise("")
    return F.when(t.contains("AM") | t.contains("PM"), t).otherwise(F.concat(t, F.coalesce(half, F.lit(""))))


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes from start to end, over midnight if end comes first."""
    return F.pmod(clock_minutes_lenient(end) - clock_minutes_lenient(start), F.lit(1440))


def minutes_between_or_zero(start: Column, end: Column) -> Column:
    return F.coalesce(minutes_between(start, end), F.lit(0))


def utc_stamp(x: Column) -> Column:
    return F.date_format(x, "yyyyMMdd'T'HHmmss'Z'")
