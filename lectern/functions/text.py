"""String column functions: identifiers, names, URLs, codes and status inference."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

STATES = dict(
    AL="Alabama", AK="Alaska", AZ="Arizona", AR="Arkansas", CA="California", CO="Colorado", CT="Connecticut", DE="Delaware", DC="District of Columbia", FL="Florida", GA="Georgia", HI="Hawaii", ID="Idaho", IL="Illinois", IN="Indiana", IA="Iowa", KS="Kansas",
    KY="Kentucky", LA="Louisiana", ME="Maine", MD="Maryland", MA="Massachusetts", MI="Michigan", MN="Minnesota", MS="Mississippi", MO="Missouri", MT="Montana", NE="Nebraska", NV="Nevada", NH="New Hampshire", NJ="New Jersey", NM="New Mexico", NY="New York",
    NC="North Carolina", ND="North Dakota", OH="Ohio", OK="Oklahoma", OR="Oregon", PA="Pennsylvania", RI="Rhode Island", SC="South Carolina", SD="South Dakota", TN="Tennessee", TX="Texas", UT="Utah", VT="Vermont", VA="Virginia", WA="Washington",
    WV="West Virginia", WI="Wisconsin", WY="Wyoming",
)
SUFFIXES = (" School District", " Public Schools", " Unified", " Schools", " District", " County", " City", " ISD", " USD", " Elementary", " Union", " Township", " Area", " Independent")
NOTHING = ("", "M", "N", "NULL", "NONE", "NAN", "N/A")


def lookup(table: dict, key: Column, default: Column | None = None) -> Column:
    """A value from a literal map, null (or the default) for an unknown key."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = F.try_element_at(pairs, key)
    return F.coalesce(found, default) if default is not None else found


def state_code(x: Column) -> Column:
    """Two-letter code of a state's name or code; null where unknown."""
    t = F.lower(F.trim(x))
    return F.when(F.length(t) == 2, lookup({k.lower(): k for k in STATES}, t)).otherwise(lookup({v.lower(): k for k, v in STATES.items()}, t))


def state_name(x: Column) -> Column:
    return lookup(STATES, F.upper(F.trim(x)))


def thousands(x: Column, decimals: int = 0) -> Column:
    return F.coalesce(F.format_number(x, decimals), F.lit("N/A"))


def strip_zeros(x: Column) -> Column:
    """Without leading zeros; text of zeros alone stays as it is."""
    return F.coalesce(F.nullif(F.ltrim(x, F.lit("0")), F.lit("")), x)


def zero_fill(x: Column, width: int) -> Column:
    """Padded with zeros from the left; longer text stays whole."""
    t = F.trim(x)
    return F.when(F.length(t) >= width, t).otherwise(F.lpad(t, width, "0"))


def as_integer_text(x: Column) -> Column:
    """A whole number as text, from "12" or "12.0"; null for what isn't a number."""
    return F.coalesce(x.try_cast("bigint"), x.try_cast("double").try_cast("bigint")).cast("string")


def state_district_id(state: Column, raw: Column) -> Column:
    """A district's number in the form that its state writes it in."""
    t = F.trim(raw)
    digits = F.regexp_replace(t, "[^0-9]", "")
    illinois = F.concat_ws("-", F.substring(digits, 1, 2), F.substring(digits, 3, 3), F.substring(digits, 6, 4), F.substring(digits, 10, 2))
    return (
        F.when(state == "FL", zero_fill(as_integer_text(t), 2))
        .when(state == "VA", zero_fill(as_integer_text(t), 3))
        .when(state == "IL", F.when(F.length(digits) >= 11, illinois))
        .when(state == "MA", F.left(zero_fill(digits, 8), F.lit(4)))
        .when(state.isin("MI", "PA"), as_integer_text(t))
        .otherwise(t)
    )


def after_dash(x: Column) -> Column:
    """What follows the first dash of a prefixed id; null for ids without one or of three characters at most."""
    return F.when(x.contains("-") & (F.length(x) > 3), F.substring(x, F.instr(x, "-") + 1, F.length(x)))


def county_district_code(x: Column) -> Column:
    """A seven-digit county-district code from seven or fourteen digits, with or without the state's prefix."""
    t = F.regexp_replace(F.trim(x), "^CA-", "")
    t = F.when(F.length(t) == 14, F.substring(t, 1, 7)).otherwise(t)
    return F.when(t.rlike("^[0-9]{7}$"), t)


def valid_county_code(x: Column, school_level: bool = True) -> Column:
    return F.coalesce(F.trim(x).rlike("^(?:[0-9]{7}|[0-9]{14})$" if school_level else "^[0-9]{7}$"), F.lit(False))


def county_parts(x: Column) -> tuple[Column, Column]:
    return F.substring(x, 1, 2), F.substring(x, 3, 5)


def build_county_code(county: Column, district: Column) -> Column:
    return F.concat(F.lpad(F.trim(county), 2, "0"), F.lpad(F.trim(district), 5, "0"))


def normal_url(x: Column) -> Column:
    """Trimmed, with a scheme and without slashes at the end; null for empty text and its synonyms."""
    t = F.trim(x)
    t = F.when(~F.upper(t).isin(*NOTHING), t)
    t = F.when(t.rlike("^(?i)https?://"), t).otherwise(F.concat(F.lit("https://"), t))
    return F.regexp_replace(t, "/+$", "")


def normal_grade(x: Column) -> Column:
    t = F.upper(F.trim(x))
    t = F.when(~t.isin(*NOTHING), t)
    return F.when(t.rlike("^[0-9]$"), F.lpad(t, 2, "0")).otherwise(t)


def short_name(x: Column) -> Column:
    """A district's name without the endings of SUFFIXES, taken off one after another in that order."""
    return F.trim(reduce(lambda t, s: F.regexp_replace(t, f"{s}$", ""), SUFFIXES, F.trim(x)))


def sanitized(x: Column) -> Column:
    """A free-text reason made safe to store: at most 500 characters, no quotes or semicolons, SQL keywords masked."""
    t = F.regexp_replace(F.left(x, F.lit(500)), "[<>;'\"\\\\`]", "")
    t = F.regexp_replace(t, r"(?i)\b(?:select|insert|update|delete|drop|union|alter|create|exec)\b", "[FILTERED]")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def joined_notes(notes: Column, flags: Column) -> Column:
    """Sorted distinct flags behind the notes that are there, parted by semicolons."""
    return F.concat_ws("; ", F.nullif(notes, F.lit("")), F.nullif(F.array_join(F.array_sort(F.array_distinct(flags)), "; "), F.lit("")))


def ratio_number(x: Column) -> Column:
    """11.3 from "11.3 to 1"."""
    return F.trim(F.split_part(x, F.lit("to"), F.lit(1))).try_cast("double")


def safe_file_name(path: Column, i: Column) -> Column:
    """A file name for the i-th captured URL path."""
    t = F.regexp_replace(F.regexp_replace(F.coalesce(path, F.lit("")), "^/+|/+$", ""), "[^A-Za-z0-9]+", "_")
    return F.concat(F.lit("page_"), F.lpad(i.cast("string"), 3, "0"), F.lit("_"), F.left(F.coalesce(F.nullif(t, F.lit("")), F.lit("index")), F.lit(50)))


def safe_folder(x: Column) -> Column:
    return F.left(F.regexp_replace(x, "[^A-Za-z0-9]", "_"), F.lit(50))


def block_type(message: Column, code: Column) -> Column:
    t = F.lower(F.coalesce(message, F.lit("")))
    return F.when(t.contains("cloudflare"), "cloudflare").when(t.contains("captcha"), "captcha").when(t.contains("waf") | F.coalesce(code == 403, F.lit(False)), "waf")


def attempt_status(code: Column, table: dict[str, str]) -> Column:
    return lookup(table, code, F.lit("error"))


def failure_pattern(reason: Column) -> Column:
    t = F.lower(F.coalesce(reason, F.lit("")))
    return F.when(t.contains("timeout"), "timeout").when(t.contains("404") | t.contains("not found"), "not_found").when(t.contains("block") | t.contains("captcha"), "blocked").when(t.contains("parse"), "parse_error").otherwise("other")


def group_key(*parts: Column) -> Column:
    """The first ten characters of each part, joined; 'unknown' for null."""
    return F.concat_ws("_", *[F.left(F.coalesce(p, F.lit("unknown")), F.lit(10)) for p in parts])


def host(url: Column) -> Column:
    return F.parse_url(url, F.lit("HOST"))


def path(url: Column) -> Column:
    return F.parse_url(url, F.lit("PATH"))
