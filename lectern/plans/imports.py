"""State imports: the yearly counts laid out as each state's file, with its columns, identifiers and marks, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.imports import StateFile, import_rows, nested_counts
from .model import counts
from .registry import query, share

c = F.col
STATES = ("CA", "FL", "IL", "MA", "MI", "NY", "PA", "TX", "VA")
_SUMS = {"af": "category = 'AF'", "ao": "category = 'AO'", "nf": "category = 'NF'", "no": "category = 'NO'", "rf": "category = 'RF'", "ro": "category = 'RO'", "kg": "grade = 'KG'", "g1": "grade = '01'", "g5": "grade = '05'", "g8": "grade = '08'", "g9": "grade = '09'", "pk": "grade = 'PK'", "total": "n > 0"}
#: A district's latest year; `m` numbers the districts of a state.  One in ten is in no crosswalk.
share("latestcounts", f"""
    SELECT district_id, CAST(district_id AS BIGINT) // 9 AS m, [{", ".join(f"'{s}'" for s in STATES)}][CAST(district_id AS BIGINT) % 9 + 1] AS st, {", ".join(f"CAST(sum(n) FILTER ({cond}) AS BIGINT) AS {k}" for k, cond in _SUMS.items())}
    FROM (SELECT *, max(year) OVER (PARTITION BY district_id) AS last FROM counts) WHERE year = last GROUP BY 1""")


def latest_counts(t, state):
    n = c("district_id").cast("long")
    wide = counts(t).where(n % 9 == STATES.index(state)).groupBy("district_id", "year").agg(*[F.sum(F.when(F.expr(cond), c("n"))).alias(k) for k, cond in _SUMS.items()])
    last = wide.groupBy("district_id").agg(F.max_by(F.struct(*_SUMS), "year").alias("x"))
    return last.select("district_id", F.expr("cast(district_id as bigint) div 9").alias("m"), "x.*")


# how the files write a count: suppressed, empty, with a fraction, with thousands and a comma, or as a ratio
_CELL = "CASE WHEN {0} IS NULL THEN '*' WHEN {0} % 11 = 0 THEN '' ELSE CAST({0} AS STRING) || '.5' END"
_COMMA = "CASE WHEN {0} IS NULL THEN '-' ELSE CAST({0} AS STRING) || ',250' END"
_RATIO = "CASE WHEN {0} IS NULL THEN 'n/a' ELSE CAST({0} AS STRING) || '.3 to 1' END"


def _filled(n):
    """The number of a district in n digits, or in as many as it has: lpad() alone would cut it."""
    return f"lpad(CAST(m AS STRING), greatest({n}, length(CAST(m AS STRING))), '0')"


# how they write the number of a district, and what the crosswalk has for it
_CODES = {
    "CA": ("lpad(CAST(m AS STRING), 14, '0')", "lpad(CAST(m AS STRING), 14, '0')"), "FL": ("CAST(m AS STRING) || '.0'", "CASE WHEN m < 10 THEN '0' ELSE '' END || CAST(m AS STRING)"),
    "IL": ("lpad(CAST(m AS STRING), 11, '0') || '0000'", "concat_ws('-', substr({0}, 1, 2), substr({0}, 3, 3), substr({0}, 6, 4), substr({0}, 10, 2))".format("lpad(CAST(m AS STRING), 11, '0')")),
    "MA": ("CAST(m AS STRING) || '0000'", _filled(4)), "MI": ("CAST(m AS STRING) || '.0'", "CAST(m AS STRING)"), "NY": ("' ' || CAST(m AS STRING) || '.0'", "CAST(m AS STRING)"),
    "PA": ("CAST(m AS STRING)", "CAST(m AS STRING)"), "TX": (f"' ' || {_filled(6)} || ' '", _filled(6)), "VA": ("CAST(m AS STRING)", "CASE WHEN m < 1000 THEN lpad(CAST(m AS STRING), 3, '0') ELSE CAST(m AS STRING) END"),
}
_MARKS = "('', '*', '-', '--', 'N/A', 'n/a', 'NA', 'null', 'NULL')"
_FLOAT = f"TRY_CAST(CASE WHEN trim({{0}}) NOT IN {_MARKS} THEN trim({{0}}) END AS DOUBLE)"
_PARSED = {
    "float": _FLOAT, "int": f"CAST(trunc({_FLOAT}) AS BIGINT)", "float0": f"coalesce({_FLOAT}, 0.0)", "int0": f"coalesce(CAST(trunc({_FLOAT}) AS BIGINT), 0)", "commas": "TRY_CAST(replace({0}, ',', '') AS DOUBLE)",
    "whole": "CAST(TRY_CAST(replace({0}, ',', '') AS DOUBLE) AS BIGINT)", "ratio": "CASE WHEN contains({0}, 'to') THEN TRY_CAST(trim(split_part({0}, 'to', 1)) AS DOUBLE) END", "text": "trim({0})",
}


def _kind_of_cell(kind):
    return _RATIO if kind == "ratio" else _COMMA if kind in ("commas", "whole") else _CELL


def layout(t, file: StateFile, source: dict[str, str], extra: dict[str, str] | None = None):
    """The state's file: its identifier, the counts that stand for its columns, and columns with what all its rows have."""
    by_header = {header: (out, kind) for out, (header, kind) in file.fields.items() if out in source}
    cells = [F.expr(_kind_of_cell(kind).format(source[out])).alias(header) for header, (out, kind) in by_header.items()]
    return latest_counts(t, file.state).select(F.expr(_CODES[file.state][0]).alias(file.ident), *cells, *[F.expr(v).alias(k) for k, v in (extra or {}).items()])


def crosswalk(t, state):
    return latest_counts(t, state).where("m % 10 <> 3").select(F.expr(_CODES[state][1]).alias("state_id"), "district_id")


def register(name: str, file: StateFile, source: dict[str, str], extra: dict[str, str] | None = None, only_sql: str = "") -> None:
    fields = ", ".join(f"{_PARSED[kind].format('(' + _kind_of_cell(kind).format(source[out]) + ')') if out in source else 'CAST(NULL AS DOUBLE)'} AS {out}" for out, (_, kind) in file.fields.items())
    needed = "".join(f" AND coalesce({n}, 0) <> 0" for n in file.needed)
    sql = f"SELECT district_id, '{file.year}' AS year, {', '.join(file.fields)} FROM (SELECT *, {fields} FROM (SELECT district_id, m AS __m, st AS __st, {', '.join(f'{k} AS {k}' for k in _SUMS)} FROM latestcounts WHERE st = '{file.state}' AND m % 10 <> 3{only_sql})) WHERE true{needed}"
    sql = sql.replace("(SELECT *, ", "(SELECT district_id, ")
    query(name, sql)(lambda t: import_rows(layout(t, file, source, extra), file, crosswalk(t, file.state)))


def _grades(pattern, first=1):
    return {f"g{i}": (pattern.format(i), "float") for i in range(first, 13)}


_SOME = {"g1": "g1", "g5": "g5", "g8": "g8", "g9": "g9"}
register("i_ca_staff", StateFile("CA", "cds_code", {"teachers": ("TCH_FTE_N", "float"), "administrators": ("ADM_FTE_N", "float"), "pupil_services": ("PSV_FTE_N", "float"), "other": ("OTH_FTE_N", "float")}), dict(teachers="af", administrators="ao", pupil_services="nf", other="no"))
register("i_ca_enrollment", StateFile("CA", "cds_code", {"total": ("TOTAL_ENR_N", "int"), "k12": ("TOTAL_ENR_N", "int")}), dict(total="total", k12="total"))
register("i_fl", StateFile("FL", "Dist #", {"staff": ("Total Instructional Staff", "float0"), "teachers": ("Total Teachers", "float0"), "ese_teachers": ("Exceptional Education Teachers", "float0")}, year="2024-25"), dict(staff="total", teachers="af", ese_teachers="rf"))
register("i_fl_enrollment", StateFile("FL", "District #", {"total_enrollment": ("Total Enrollment", "int0")}, year="2024-25"), dict(total_enrollment="total"))
_IL = {"counselor_fte": "School Counselor FTE", "nurse_fte": "School Nurse FTE", "psychologist_fte": "School Psychologist FTE", "social_worker_fte": "School Social Worker FTE", "ratio_elementary": "Pupil Teacher Ratio - Elementary", "ratio_high": "Pupil Teacher Ratio - High School", "retention": "Teacher Retention Rate", "salary": "Teacher Avg Salary"}
register("i_il", StateFile("IL", "RCDTS", {"teacher_fte": ("Total Teacher FTE", "float")} | {k: (v, "float") for k, v in _IL.items()}, ("teacher_fte",)), dict(teacher_fte="af", counselor_fte="ao", nurse_fte="nf", psychologist_fte="no", social_worker_fte="rf", ratio_elementary="ro", ratio_high="g9", salary="total"))
_SHARES = {"white": "White", "black": "Black or African American", "hispanic": "Hispanic or Latino", "asian": "Asian", "low_income": "Low Income", "iep": "IEP", "el": "EL"}
register("i_il_enrollment", StateFile("IL", "RCDTS", {"enrolled": ("# Student Enrollment", "int")} | {f"pct_{k}": (f"% Student Enrollment - {v}", "float") for k, v in _SHARES.items()} | {"disabled": ("# Student Enrollment - Children with Disabilities", "int"), "ieps": ("# Student Enrollment - IEP", "int")}, ("enrolled",)), dict(enrolled="total", pct_white="af", pct_black="ao", pct_asian="nf", pct_el="no", disabled="rf", ieps="ro"))
register("i_ma", StateFile("MA", "district_code", {"teachers": ("teachers_fte", "float"), "licensed": ("pct_licensed", "float"), "ratio": ("student_teacher_ratio", "ratio"), "experienced": ("pct_experienced", "float")}), dict(teachers="af", licensed="ao", ratio="nf", experienced="no"))
# the file has years, organisations and totals of which one kind is taken; a code of 0 is the state's total
register("i_ma_enrollment", StateFile("MA", "DIST_CODE", {"all_pupils": ("TOTAL_CNT", "int"), "prek": ("PK_CNT", "int"), "kinder": ("K_CNT", "int"), "disabled": ("SWD_CNT", "int"), "disabled_pct": ("SWD_PCT", "float"), "learners": ("EL_CNT", "int"), "low_income": ("LI_CNT", "int")}, year="2025-26", only={"SY": "2026", "ORG_TYPE": "District", "TOTAL_ROW": "no"}), dict(all_pupils="total", prek="pk", kinder="kg", disabled="rf", disabled_pct="ro", learners="no", low_income="nf"), {"SY": "CASE WHEN m % 4 = 1 THEN '2025' ELSE '2026' END", "ORG_TYPE": "CASE WHEN m % 5 = 2 THEN 'School' ELSE 'District' END", "TOTAL_ROW": "CASE WHEN m = 0 THEN 'yes' ELSE 'no' END"}, " AND m % 4 <> 1 AND m % 5 <> 2 AND m <> 0")
register("i_mi", StateFile("MI", "DCODE", {"teachers": ("TEACHER", "float"), "se_instr": ("SE_INSTR", "float"), "aides": ("INST_AID", "float"), "supervisors": ("INST_SUP", "float")}), dict(teachers="af", se_instr="rf", aides="ro", supervisors="no"))
register("i_mi_enrollment", StateFile("MI", "District Code", {"everyone": ("tot_all", "float"), "k": ("k_totl", "float")} | _grades("g{}_totl") | {"male": ("tot_male", "float"), "female": ("tot_fem", "float")}), dict(everyone="total", k="kg", male="af", female="ao") | _SOME)
register("i_mi_sped", StateFile("MI", "DCODE.1", {"ieps": ("StudwI E P", "int"), "sped_pct": ("SpEd%", "float")}), dict(ieps="rf", sped_pct="ro"))
register("i_pa", StateFile("PA", "AUN", {"ct": ("CT", "float"), "pp": ("PP", "float"), "ad": ("Ad", "float"), "co": ("Co", "float"), "ot": ("Ot", "float")}), dict(ct="af", pp="ao", ad="nf", co="no", ot="ro"))
register("i_pa_enrollment", StateFile("PA", "AUN", {"everyone": ("Total", "float"), "pkf": ("PKF", "float"), "k5f": ("K5F", "float")} | _grades("{}.0")), dict(everyone="total", pkf="pk", k5f="kg") | _SOME)
register("i_va", StateFile("VA", "Division Number", {"teachers": ("Teachers", "commas"), "admin": ("Administration", "commas"), "aides": ("Aides and Paraprofessionals", "commas"), "others": ("Non-Instructional Personnel", "commas")}, year="2025-26"), dict(teachers="af", admin="ao", aides="rf", others="no"))
register("i_va_enrollment", StateFile("VA", "Division Number", {"everyone": ("Total Count", "whole"), "full_time": ("FT Count", "whole"), "part_time": ("PT Count", "whole")}, year="2025-26"), dict(everyone="total", full_time="af", part_time="ao"))
register("i_va_sped", StateFile("VA", "Division Number", {"sped": ("Total Count", "whole")}, year="2024-25"), dict(sped="rf"))
# columns of the Texas file go by their places; two fields read one place
_TX = {"total_enrollment": 27, "enrollment_pk": 14, "enrollment_k": 15} | {f"enrollment_g{i}": 15 + i for i in range(1, 13)} | {"enrollment_sped": 28, "enrollment_ell": 31, "enrollment_econ": 32}
_TX_AT = {14: "pk", 15: "kg", 16: "g1", 20: "g5", 23: "g8", 24: "g9", 27: "total", 28: "rf", 31: "ro", 32: "no"}
register("i_tx", StateFile("TX", "6 Digit County District Number", {k: (f"_c{v}", "int") for k, v in _TX.items()}), {k: _TX_AT[v] for k, v in _TX.items() if v in _TX_AT})
_TX_STAFF = {"teachers": 2, "regular": 34, "bilingual": 36, "gifted": 38, "special": 39}
register("i_tx_staff", StateFile("TX", "6 Digit County District Number", {k: (f"_c{v}", "float") for k, v in _TX_STAFF.items()}), dict(teachers="af", regular="ao", bilingual="nf", special="rf"))

_KINDS = {"Classroom Teacher": "af", "Paraprofessional": "rf", "Principal": "ao"}


@query("i_ny", " UNION ALL ".join(f"SELECT * FROM (SELECT district_id, '2023-24' AS year, '{k}' AS category, coalesce({_FLOAT.format('(' + _CELL.format(v) + ')')}, 0.0) AS fte FROM latestcounts WHERE st = 'NY' AND m % 10 <> 3) WHERE fte <> 0" for k, v in _KINDS.items()))
def _(t):
    file = StateFile("NY", "STATE_DISTRICT_ID", {"category": ("STAFF_IND_DESC", "text"), "fte": ("FTE", "float0")}, ("fte",))
    wide = latest_counts(t, "NY").select(F.expr(_CODES["NY"][0]).alias("STATE_DISTRICT_ID"), F.array(*[F.struct(F.lit(k).alias("k"), F.expr(_CELL.format(v)).alias("v")) for k, v in _KINDS.items()]).alias("e"))
    raw = wide.select("STATE_DISTRICT_ID", F.explode("e").alias("e")).select("STATE_DISTRICT_ID", F.concat(F.lit(" "), "e.k", F.lit(" ")).alias("STAFF_IND_DESC"), c("e.v").alias("FTE"))
    return import_rows(raw, file, crosswalk(t, "NY"))


_NY_GRADES = {"PreK (Full Day)": "pk", "Kindergarten (Full Day)": "kg", "Grade 1": "g1", "Grade 5": "g5", "Grade 8": "g8", "Grade 9": "g9"}
_NY_CELLS = ", ".join(f"CASE WHEN {_PARSED['int'].format('(' + _CELL.format(v) + ')')} > 0 THEN '\"{k}\":' || {_PARSED['int'].format('(' + _CELL.format(v) + ')')} END" for k, v in _NY_GRADES.items())


@query("i_ny_enrollment", f"SELECT district_id, '2023-24' AS year, 'All Students' AS subgroup, coalesce({_PARSED['int'].format('(' + _CELL.format('total') + ')')}, 0) AS everyone, '{{' || concat_ws(',', {_NY_CELLS}) || '}}' AS grades FROM latestcounts WHERE st = 'NY' AND m % 10 <> 3")
def _(t):
    fields = {"subgroup": ("Subgroup Name", "text"), "everyone": ("PreK-12 Total", "int0")} | {g: (g, "int") for g in _NY_GRADES}
    file = StateFile("NY", "State District Identifier", fields)
    raw = layout(t, file, {"everyone": "total"} | _NY_GRADES, {"Subgroup Name": "' All Students'"})
    return nested_counts(import_rows(raw, file, crosswalk(t, "NY")), list(_NY_GRADES), "grades")
