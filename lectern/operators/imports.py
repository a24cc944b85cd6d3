"""State files under a common shape: identifiers bridged, numbers parsed, rows without what matters left out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as T

PARSERS = {
    "float": N.safe_float, "int": N.safe_int, "float0": lambda x: F.coalesce(N.safe_float(x), F.lit(0.0)), "int0": lambda x: F.coalesce(N.safe_int(x), F.lit(0).cast("long")),
    "commas": N.float_with_commas, "whole": lambda x: N.float_with_commas(x).cast("long"), "text": lambda x: F.trim(F.coalesce(x, F.lit(""))),
    # "11.3 to 1"
    "ratio": lambda x: F.when(x.contains("to"), F.trim(F.split_part(x, F.lit("to"), F.lit(1))).try_cast("double")),
}


@dataclass(frozen=True)
class StateFile:
    """What a state calls its columns: the identifier's, and each field's with the way its text is parsed."""

    state: str
    ident: str
    fields: dict[str, tuple[str, str]]
    #: Fields of which a missing or zero value makes the row worthless.
    needed: tuple[str, ...] = ()
    year: str = "2023-24"
    #: Conditions on the file's own columns.
    only: dict[str, str] = field(default_factory=dict)


def identifier(state: str, raw: Column) -> Column:
    """A district's identifier as its state's crosswalk has it.

    A code of Massachusetts ends in four digits of a school; what stands before them is the district, whole, where a
    state has more than four digits of districts.
    """
    if state == "NY":
        return T.as_integer_text(F.trim(raw))
    if state == "MA":
        code = T.zero_fill(F.regexp_replace(F.trim(raw), "[^0-9]", ""), 8)
        return F.left(code, F.length(code) - 4)
    return T.state_district_id(F.lit(state), raw)


def import_rows(raw: DataFrame, file: StateFile, crosswalk: DataFrame) -> DataFrame:
    """(district_id, year, fields): the rows of a file whose identifier the crosswalk (state_id, district_id) knows.

    A column that the file hasn't is null.  A field that is needed must be there and not 0.
    """
    have = set(raw.columns)
    for column, value in file.only.items():
        raw = raw.where(F.col(f"`{column}`") == value)
    value = lambda header: F.col(f"`{header}`") if header in have else F.lit(None).cast("string")
    rows = raw.select(identifier(file.state, F.col(f"`{file.ident}`")).alias("state_id"), *[PARSERS[kind](value(header)).alias(out) for out, (header, kind) in file.fields.items()])
    for name in file.needed:
        rows = rows.where(F.coalesce(F.col(name), F.lit(0)) != 0)
    return rows.join(crosswalk.select("state_id", "district_id"), "state_id").select("district_id", F.lit(file.year).alias("year"), *file.fields)


def nested_counts(rows: DataFrame, counts: list[str], name: str) -> DataFrame:
    """The counts above 0 as one JSON object under `name`, in place of their columns."""
    one = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(c).alias("k"), F.col(f"`{c}`").alias("v")) for c in counts]), lambda e: e["v"] > 0)) if counts else F.create_map()
    return rows.withColumn(name, F.to_json(one)).drop(*counts)
