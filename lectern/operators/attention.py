"""The attention metric: daily minutes times staff over pupils, by staffing scope."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import or_zero, truthy
from .relational import latest_per_key

BASE = ("teachers_only", "teachers_core", "instructional", "instructional_plus_support", "all")
LEVEL = ("teachers_elementary", "teachers_secondary")
SPED = ("core_sped", "teachers_gened", "instructional_sped")
MOST = 360
NO_MINUTES = 360
#: The school year that state requirements and the default stand for.
REQUIRED_YEAR = "2023-24"


def attention(minutes: Column, staff: Column, pupils: Column) -> Column:
    """Null unless staff and pupils are above 0."""
    return F.when((staff > 0) & (pupils > 0), minutes * staff / pupils)


def attention_error(minutes: Column, staff: Column, pupils: Column) -> Column:
    """Why a strict calculation refuses its inputs; null where it doesn't."""
    return (
        F.when(pupils.isNull() | staff.isNull() | minutes.isNull(), "missing value")
        .when(pupils <= 0, "enrollment must be positive")
        .when(staff < 0, "staff cannot be negative")
        .when(~minutes.between(180, 480), "minutes out of range")
    )


#: Staff categories by the innermost scope that counts them; the scope "all" counts every one.
TEACHERS = ("elementary", "secondary", "kindergarten")
CORE = (*TEACHERS, "ungraded")
INSTRUCTIONAL = (*CORE, "coordinators", "paras")
SUPPORTED = (*INSTRUCTIONAL, "counselors", "psychologists", "student_support")
ALL = (*SUPPORTED, "librarians", "library_support", "lea_administrators", "lea_support", "school_administrators", "school_support", "other")


def scope_columns(category: Callable[[str], Column]) -> dict[str, Column]:
    """Nested staffing scopes as sums of categories, missing ones as 0; a sum of 0 is null."""
    total = lambda names: F.nullif(sum((or_zero(category(n)) for n in names), F.lit(0.0)), F.lit(0.0))
    return {
        "teachers_only": total(TEACHERS), "teachers_k5": total(("elementary", "kindergarten")), "teachers_612": total(("secondary",)), "teachers_core": total(CORE),
        "instructional": total(INSTRUCTIONAL), "instructional_plus_support": total(SUPPORTED), "all": total(ALL),
    }


def staff_scopes(staff: DataFrame) -> DataFrame:
    """staff with the scopes beside its categories; a category that it has no column for counts as missing."""
    have = set(staff.columns)
    return staff.withColumns(scope_columns(lambda n: F.col(n) if n in have else F.lit(None).cast("double")))


def with_scopes(staff: DataFrame) -> DataFrame:
    """Scopes of staff with six categories, where half the aides stand for counselors and a third of the coordinators for others."""
    own = {"counselors": F.floor(or_zero(F.col("paras")) / 2), "other": F.floor(or_zero(F.col("coordinators")) / 3)}
    have = set(staff.columns)
    return staff.withColumns(scope_columns(lambda n: own[n] if n in own else F.col(n) if n in have else F.lit(None).cast("double")))


def minutes_chain(bell: DataFrame, requirements: DataFrame, districts: DataFrame) -> DataFrame:
    """(district_id, minutes, minutes_source, minutes_year): the latest high, middle or elementary schedule with minutes, then the state's, then 360.

    Only the latest row of a level is looked at; minutes of 0 count as missing.  Years are text; what no schedule gives
    is of REQUIRED_YEAR.
    """
    newest = latest_per_key(bell.where(F.col("grade_level").isin("high", "middle", "elementary")), ["district_id", "grade_level"], [F.desc("year"), "bell_id"])
    source = F.when(F.col("grade_level") == "high", "bell_schedule").otherwise(F.concat(F.lit("bell_schedule_"), "grade_level"))
    found = F.struct("minutes", source.alias("source"), F.col("year").cast("string").alias("year"))
    fixed = F.lit(REQUIRED_YEAR).alias("year")
    by_level = newest.groupBy("district_id").pivot("grade_level", ["high", "middle", "elementary"]).agg(F.max(F.when(truthy(F.col("minutes")).isNotNull(), found)))
    state = requirements.select("state", F.coalesce(truthy(F.col("high")), F.col("fallback")).cast("long").alias("state_minutes"))
    both = districts.select("district_id", "state").join(by_level, "district_id", "left").join(F.broadcast(state), "state", "left")  # one row a state
    required = F.when(F.col("state_minutes").isNotNull(), F.struct(F.col("state_minutes").alias("minutes"), F.lit("state_requirement").alias("source"), fixed))
    default = F.struct(F.lit(NO_MINUTES).cast("long").alias("minutes"), F.lit("default").alias("source"), fixed)
    pick = F.coalesce("high", "middle", "elementary", required, default)
    return both.select("district_id", pick["minutes"].alias("minutes"), pick["source"].alias("minutes_source"), pick["year"].alias("minutes_year"))


def all_variants(districts: DataFrame, staff: DataFrame, enrollment: DataFrame, minutes: DataFrame, sped: DataFrame | None = None) -> DataFrame:
    """One row for each district and scope with a value: five base scopes, two by level, three for special education.

    districts: (district_id, state, shared_service); staff: one row a district with scope columns; enrollment: one row
    a district with k12, elementary and secondary pupils; sped: (district_id, self_contained, sped_teachers,
    sped_instructional, gened_teachers, confidence).  Districts that share services or have no pupils are left out.
    Level rows need a plausible value; special-education values are capped, those of general education dropped, above 360.
    """
    joined = staff.join(districts.where(~F.col("shared_service")), "district_id").join(enrollment.where("k12 > 0"), "district_id").join(minutes, "district_id")
    if sped is not None:
        joined = joined.join(sped.where("confidence <> 'low'"), "district_id", "left")
    return variant_rows(joined, sped is not None)


def variant_rows(joined: DataFrame, with_sped: bool) -> DataFrame:
    """The rows of all_variants() from one row a district that holds its scopes, pupils, minutes and estimates."""
    lct = lambda s, n: attention(F.col("minutes"), s, n)

    def row(scope: str, staff_col: Column, pupils: Column, keep: Column | None = None, cap: bool = False) -> Column:
        # in decimals, so that a tie is one whatever its doubles are
        exact = F.col("minutes").cast("decimal(12,0)") * staff_col.cast("decimal(14,4)") / pupils.cast("decimal(14,2)")
        value = F.when((staff_col > 0) & (pupils > 0), F.bround(exact, 2).cast("double"))
        note = F.when(F.lit(cap) & (value > MOST), "WARN_SPED_RATIO_CAP").otherwise("")
        shown = F.when(value.isNotNull(), F.least(value, F.lit(float(MOST)))) if cap else value
        if keep is not None:
            shown = F.when(keep, shown)
        return F.struct(F.lit(scope).alias("scope"), staff_col.cast("double").alias("staff"), pupils.cast("double").alias("pupils"), shown.alias("lct"), note.alias("notes"))

    rows = [row(s, F.col(s), F.col("k12")) for s in BASE]
    for scope, s, n in (("teachers_elementary", "teachers_k5", "k5"), ("teachers_secondary", "teachers_612", "g612")):
        rows.append(row(scope, F.col(s), F.col(n), lct(F.col(s), F.col(n)) <= MOST))
    if with_sped:
        gened = F.col("k12") - F.coalesce(F.col("self_contained"), F.lit(0))
        rows += [row("core_sped", F.col("sped_teachers"), F.col("self_contained"), cap=True), row("teachers_gened", F.col("gened_teachers"), gened, lct(F.col("gened_teachers"), gened) <= MOST), row("instructional_sped", F.col("sped_instructional"), F.col("self_contained"), cap=True)]
    return joined.select("district_id", "state", "minutes", "minutes_source", F.explode(F.array(*rows)).alias("r")).select("district_id", "state", "minutes", "minutes_source", "r.*").where("lct is not null")


def summary(rows: DataFrame, *by: str) -> DataFrame:
    """Count, mean, median, sample deviation, extremes and districts of a metric, to 8 places."""
    r = lambda c: F.round(c, 8)
    return rows.groupBy(*by).agg(F.count("lct").alias("n"), r(F.avg("lct")).alias("mean"), r(F.median("lct")).alias("median"), r(F.stddev_samp("lct")).alias("std"), F.min("lct").alias("least"), F.max("lct").alias("most"), F.countDistinct("district_id").alias("districts"))


def data_tier(source: Column) -> Column:
    """1 for the schedule of the level itself, 2 for another level's, 3 for what no schedule gives."""
    return F.when(source == "bell_schedule", 1).when(source.startswith("bell_schedule_"), 2).otherwise(3)


def with_special_education(rows: DataFrame, lea: DataFrame, state: DataFrame) -> DataFrame:
    """rows (district_id, state, pupils, teachers, ...) with the estimates of special_education() beside them.

    Where there is none, because no proportion is known or the district has no pupils, they are null.
    """
    mean = state.where("teacher_ratio is not null").agg(*[F.avg(truthy(F.col(c))).alias(f"mean_{c}") for c in ("self_contained", "teacher_ratio", "instructional_ratio")])
    states = state.select("state", F.col("proportion").alias("__p"), F.col("self_contained").alias("__sc"), F.col("teacher_ratio").alias("__tr"), F.col("instructional_ratio").alias("__ir"))
    have = rows.columns
    full = rows.join(lea.select("district_id", F.col("proportion").alias("__own")), "district_id", "left").join(F.broadcast(states), "state", "left").crossJoin(F.broadcast(mean))  # one row a state; one row
    share = F.when(F.col("pupils") > 0, F.coalesce(truthy(F.col("__own")), truthy(F.col("__p"))))
    national = truthy(F.col("__tr")).isNull() | truthy(F.col("__sc")).isNull()
    ratio = lambda short, c: F.when(national, F.col(f"mean_{c}")).otherwise(F.col(short))
    full = full.withColumns({"__share": share, "__national": national, "__a": ratio("__sc", "self_contained"), "__b": ratio("__tr", "teacher_ratio"), "__c": ratio("__ir", "instructional_ratio")})
    full = full.withColumn("sped", F.bround(F.col("pupils") * F.col("__share"), 0).cast("long")).withColumn("self_contained", F.bround(F.col("sped") * F.col("__a"), 0).cast("long"))
    full = full.withColumns({"sped_teachers": F.bround(F.col("self_contained") * F.col("__b"), 2), "sped_instructional": F.bround(F.col("self_contained") * F.col("__c"), 2)}).withColumn("gened_teachers", F.bround(F.col("teachers") - F.col("sped_teachers"), 2))
    there = lambda x: F.when(F.col("__share").isNotNull(), x)
    method = F.when(F.col("__national"), "national_average_fallback").when(truthy(F.col("__own")).isNotNull(), "lea_ratio").otherwise("state_ratio")
    confidence = F.when(F.col("gened_teachers") < 0, "low").otherwise("medium")
    full = full.withColumns({"gened": F.col("pupils") - F.col("self_contained"), "sped_method": there(method), "confidence": there(confidence)})
    return full.select(*have, *ESTIMATES)


#: What with_special_education() adds.
ESTIMATES = ("sped", "self_contained", "gened", "sped_teachers", "sped_instructional", "gened_teachers", "sped_method", "confidence")


def special_education(districts: DataFrame, lea: DataFrame, state: DataFrame, *also: str) -> DataFrame:
    """(district_id, sped, self_contained, gened, sped_teachers, sped_instructional, gened_teachers, method, confidence).

    districts: (district_id, state, pupils, teachers), and columns that go along; lea: (district_id, proportion); state:
    (state, proportion, self_contained, teacher_ratio, instructional_ratio).  A district's proportion falls back on its
    state's; one without either is left out.  Where a state lacks the teacher or the self-contained ratio, all three
    ratios are the means over the states, each over its own known values.  Counts of pupils are rounded half to even
    from step to step.
    """
    return with_special_education(districts, lea, state).where("sped_method is not null").select("district_id", *also, *ESTIMATES).withColumnRenamed("sped_method", "method")
