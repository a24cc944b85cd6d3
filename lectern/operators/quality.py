"""Data-quality rules: flags beside rows, and reports over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import clock_minutes
from .attention import BASE


def flags(**rules: Column) -> Column:
    """Names of the rules that hold, in the order given."""
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())


FLAGS = ("ERR_FLAT_STAFF", "ERR_IMPOSSIBLE_SSR", "ERR_RATIO_CEILING", "ERR_VOLATILE", "WARN_LCT_HIGH", "WARN_LCT_LOW", "WARN_SPED_RATIO_CAP")


def safeguards(rows: DataFrame) -> DataFrame:
    """Rows (district_id, scope, staff, pupils, lct, notes) with the flags that hold appended to their notes.

    Flat staff and the ratio ceiling are a district's: they look at its staff in the five base scopes, where it has all
    five, and are put on the rows of those scopes.  Scopes by level and of special education count other pupils than
    kindergarten to grade 12, so small numbers of them are not called volatile.  Flags stand in the order of their names.
    """
    own = Window.partitionBy("district_id")
    is_base = F.col("scope").isin(*BASE)
    base = F.when(is_base, F.col("staff"))
    staff_of = lambda scope: F.max(F.when(F.col("scope") == scope, F.col("staff"))).over(own)
    whole = is_base & (F.count(F.when(is_base, 1)).over(own) >= len(BASE))
    teachers, everyone = staff_of("teachers_only"), staff_of("all")
    found = flags(
        ERR_FLAT_STAFF=whole & (F.min(base).over(own) == F.max(base).over(own)),
        ERR_IMPOSSIBLE_SSR=is_base & (F.col("pupils") > 0) & (F.col("staff") != 0) & (F.try_divide("staff", "pupils") > 0.5),
        ERR_RATIO_CEILING=whole & (teachers > 0) & (everyone > 0) & (F.abs(teachers - everyone) < 0.01),
        ERR_VOLATILE=is_base & (F.col("pupils") != 0) & (F.col("pupils") < 50),
        WARN_LCT_HIGH=(F.col("scope") == "teachers_only") & (F.col("lct") > 120),
        WARN_LCT_LOW=(F.col("lct") != 0) & (F.col("lct") < 5),
    )
    return rows.withColumn("notes", F.concat_ws("; ", F.nullif("notes", F.lit("")), found))


SCOPE_ORDER = ("teachers_only", "teachers_elementary", "teachers_secondary", "core_sped", "teachers_gened", "instructional_sped", "teachers_core", "instructional", "instructional_plus_support", "all")
#: Scopes of which the first should have the lesser mean, by what the report calls the pair.
ORDERED = {
    "Secondary < Overall Teachers": ("teachers_secondary", "teachers_only"), "Teachers < Elementary": ("teachers_only", "teachers_elementary"), "Teachers < Core": ("teachers_only", "teachers_core"),
    "Core < Instructional": ("teachers_core", "instructional"), "Instructional < Support": ("instructional", "instructional_plus_support"), "Support < All": ("instructional_plus_support", "all"),
}


def qa_report(rows: DataFrame, per_scope: int = 5, in_all: int = 20) -> DataFrame:
    """(section, name, value, detail) of a run's rows (district_id, state, scope, lct, notes), flags among the notes.

    data_quality: calculations, valid ones (above 0 and up to 360), pass rate, districts with notes; safeguards: rows
    with each flag; scope_summary: figures of valid rows by scope; hierarchy: whether the means of scopes are ordered;
    state_coverage; outliers: up to `per_scope` below 5 and above 200 in each scope, by district, `in_all` in the order
    of scopes; overall_status: 1 unless a pair of scopes is out of order.  An empty run gives zeros and no scopes.
    """
    valid = rows.where("lct > 0 and lct <= 360")
    entry = lambda section, name, value, detail=None: F.struct(F.lit(section).alias("section"), (name if isinstance(name, Column) else F.lit(name)).alias("name"), value.cast("double").alias("value"), (F.lit(None) if detail is None else detail).cast("string").alias("detail"))
    is_valid = (F.col("lct") > 0) & (F.col("lct") <= 360)
    flagged = {f: F.count_if(F.col("notes").contains(f)).alias(f) for f in FLAGS}
    one = rows.agg(F.count("*").alias("n"), F.count_if(is_valid).alias("valid"), F.countDistinct(F.when(F.col("notes") != "", F.col("district_id"))).alias("noted"), F.countDistinct(F.when(is_valid, F.col("state"))).alias("states"), *flagged.values())
    rate = F.when(F.col("n") > 0, F.round(F.col("valid") * 100 / F.col("n"), 2)).otherwise(0)
    totals = [entry("data_quality", x, v) for x, v in (("total_calculations", F.col("n")), ("valid_calculations", F.col("valid")), ("invalid_calculations", F.col("n") - F.col("valid")), ("pass_rate", rate), ("districts_with_qa_notes", F.col("noted")))]
    totals += [entry("safeguards", f, F.col(f)) for f in FLAGS] + [entry("state_coverage", "states_with_data", F.col("states"))]
    # one row a scope, of which there are ten
    r = lambda x: F.round(x, 2)
    by_scope = valid.groupBy("scope").agg(F.countDistinct("district_id").alias("districts"), r(F.avg("lct")).alias("mean"), r(F.median("lct")).alias("median"), r(F.min("lct")).alias("min"), r(F.max("lct")).alias("max"))
    figures = [entry("scope_summary", F.concat("scope", F.lit(f".{x}")), F.col(x)) for x in ("districts", "mean", "median", "min", "max")]
    mean = {s: F.max(F.when(F.col("scope") == s, F.col("mean"))).alias(s) for pair in ORDERED.values() for s in pair}
    means = by_scope.agg(*mean.values())
    passed = {name: F.col(f"`{a}`") < F.col(f"`{b}`") for name, (a, b) in ORDERED.items()}
    checks = [F.when(ok.isNotNull(), entry("hierarchy", name, ok.cast("int"))) for name, ok in passed.items()]
    status = F.when(F.forall(F.array(*passed.values()), lambda x: F.coalesce(x, F.lit(True))), "PASS").otherwise("WARNING")
    checks.append(entry("overall_status", "overall_status", (status == "PASS").cast("int"), status))
    kind = F.when(F.col("lct") < 5, "low").when(F.col("lct") > 200, "high")
    place = F.row_number().over(Window.partitionBy("scope", "kind").orderBy("district_id"))
    order = F.array_position(F.array(*map(F.lit, SCOPE_ORDER)), F.col("scope"))
    out = valid.select("scope", "district_id", "lct", kind.alias("kind")).where("kind is not null").withColumn("place", place).where(F.col("place") <= per_scope)
    out = out.orderBy(order, F.desc("kind"), "place").limit(in_all)  # the report shows no more
    issue = F.concat(F.when(F.col("kind") == "low", "Very low LCT: ").otherwise("Very high LCT: "), F.format_string("%.1f", F.bround("lct", 1)), F.lit(" min"))
    outliers = entry("outliers", F.concat("scope", F.lit("."), "district_id"), F.col("lct"), F.concat(issue, F.when(F.col("kind") == "low", " (warning)").otherwise(" (info)")))
    parts = [one.select(F.explode(F.array(*totals)).alias("e")), by_scope.select(F.explode(F.array(*figures)).alias("e")), means.select(F.explode(F.array_compact(F.array(*checks))).alias("e")), out.select(outliers.alias("e"))]
    return reduce(DataFrame.unionByName, parts).select("e.*")


def level_notes(elementary: Column, secondary: Column, staff_e: Column, staff_s: Column, pupils_e: Column, pupils_s: Column, total: Column) -> Column:
    return flags(
        elementary_over=elementary > 360, secondary_over=secondary > 360,
        elementary_no_pupils=(staff_e > 0) & (F.coalesce(pupils_e, F.lit(0)) <= 0), secondary_no_pupils=(staff_s > 0) & (F.coalesce(pupils_s, F.lit(0)) <= 0),
        elementary_no_staff=(pupils_e > 0) & (F.coalesce(staff_e, F.lit(0)) <= 0), secondary_no_staff=(pupils_s > 0) & (F.coalesce(staff_s, F.lit(0)) <= 0),
        sum_mismatch=~(F.coalesce(pupils_e + pupils_s, F.lit(0)) / F.nullif(total, F.lit(0))).between(0.8, 1.2),
    )


def schedule_errors(start: Column, end: Column, minutes: Column, grade: Column) -> tuple[Column, Column]:
    """Errors and warnings of a daily schedule."""
    a, b = clock_minutes(start), clock_minutes(end)
    errors = flags(
        bad_start=a.isNull(), bad_end=b.isNull(), bad_grade=~F.coalesce(grade.isin("elementary", "middle", "high"), F.lit(False)), order=b <= a,
        minutes_range=~minutes.between(300, 480), minutes_over_duration=minutes > b - a,
    )
    warnings = flags(early_or_late_start=~a.between(360, 630), early_or_late_end=~b.between(840, 1050), minutes_far_below=minutes < b - a - 90)
    return errors, warnings


#: Ways in which a schedule may have been collected.
METHODS = tuple(sorted("web_scraping human_provided school_sample pdf_extraction automated_enrichment district_policy state_statutory manual_data_collection".split()))


def bell_file_checks(states: list[str]) -> tuple[Column, Column]:
    """Errors and warnings of a collected schedule: state, year, minutes, the form of its times, confidence, method, source and enriched flag."""
    x = F.col
    some = lambda name: F.nullif(x(name), F.lit(""))
    clock = lambda name: ~some(name).rlike(r"^[ \t]*[^ \t]*:[^ \t]*[ \t]+(AM|PM)[ \t]*$")
    errors = flags(missing_state=some("state").isNull(), invalid_state=~some("state").isin(*states), minutes_too_low=x("minutes") < 180, minutes_too_high=x("minutes") > 480)
    warnings = flags(
        missing_year=x("year").isNull(), minutes_missing=x("minutes").isNull(), minutes_low=(x("minutes") >= 180) & (x("minutes") < 240), minutes_high=(x("minutes") > 420) & (x("minutes") <= 480),
        bad_start_time=clock("start_time"), bad_end_time=clock("end_time"), bad_confidence=~some("confidence").isin("high", "medium", "low"), bad_method=~some("method").isin(*METHODS),
        missing_source=some("source").isNull(), missing_enriched=x("enriched").isNull(), not_enriched=~x("enriched"),
    )
    return errors, warnings


def enrollment_notes(total: Column, k12: Column, parts: Column) -> Column:
    return flags(negative=total < 0, zero=total == 0, extreme=total > 2_000_000, k12_over_total=k12 > total, parts_differ=parts != total)


def minutes_class(minutes: Column) -> Column:
    return F.when(minutes.isNull(), "missing").when(minutes == 0, "zero").when(minutes < 120, "too_low").when(minutes > 540, "too_high").when(minutes == 360, "default").otherwise("ok")


def value_class(lct: Column, sped: Column) -> Column:
    return F.when(lct < 0, "negative").when(lct < 1, "too_low").when((lct > 360) & ~sped, "too_high").when(lct > 360, "sped_capped").otherwise("ok")


def preferred_source(df: DataFrame, key: str, year: int) -> DataFrame:
    """One row a key: of the target year before others, federal before state, newer before older."""
    order = Window.partitionBy(key).orderBy((F.col("year") == year).desc(), (F.col("source") == "federal").desc(), F.desc("year"))
    return df.withColumn("__r", F.row_number().over(order)).where("__r = 1").drop("__r")


def missing_columns(df: DataFrame, needed: list[str]) -> list[str]:
    return [c for c in needed if c not in df.columns]


def column_report(df: DataFrame, needed: list[str], numeric: list[str]) -> DataFrame:
    """(column, nulls, negatives) for the needed columns, from one aggregate."""
    have = [c for c in needed if c in df.columns]
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in have], *[F.count_if(F.col(c) < 0).alias(f"m_{c}") for c in have if c in numeric])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("nulls"), (F.col(f"m_{c}") if c in numeric else F.lit(0).cast("long")).alias("negatives")) for c in have]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
