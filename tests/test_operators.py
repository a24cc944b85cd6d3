"""Column functions and relational blocks on small literal tables."""

import pytest
from pyspark.sql import functions as F

from lectern.functions import dates as D
from lectern.functions import numbers as N
from lectern.functions import text as T
from lectern.operators import attention as A
from lectern.operators import pages as P
from lectern.operators import quality as Q
from lectern.operators import queue as U
from lectern.operators import relational as R

c = F.col


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("minutes", "staff", "pupils", "want"), [(360, 10.0, 200.0, 18.0), (360, 0.0, 200.0, None), (360, None, 200.0, None), (360, 10.0, 0.0, None), (360, 10.0, None, None), (360, -1.0, 5.0, None)])
def test_attention(spark, minutes, staff, pupils, want):
    lit = lambda v: F.lit(v).cast("double")
    assert one(spark, A.attention(lit(minutes), lit(staff), lit(pupils))) == want


def test_scopes_are_nested_and_zero_is_missing(spark):
    df = spark.createDataFrame([(5.0, 3.0, 1.0, None, 4.0, 3.0), (0.0, None, None, None, None, None)], "elementary double, secondary double, kindergarten double, ungraded double, paras double, coordinators double")
    full, none = A.with_scopes(df).collect()
    order = [full[s] for s in A.BASE]
    assert order == sorted(order) and full["teachers_only"] == 9 and full["teachers_612"] == 3
    assert all(none[s] is None for s in A.BASE)


def test_scopes_of_all_categories(spark):
    parts = dict(elementary=100, kindergarten=20, secondary=80, ungraded=5, coordinators=3, paras=15, counselors=4, psychologists=2, student_support=3, librarians=2, lea_administrators=5, school_administrators=10, other=20)
    df = spark.createDataFrame([tuple(map(float, parts.values()))], ", ".join(f"{n} double" for n in parts))
    got = A.staff_scopes(df).first()
    assert [got[s] for s in A.BASE] == [200, 205, 223, 232, 269] and got["teachers_k5"] == 120 and got["teachers_612"] == 80
    lct = [one(spark, F.bround(A.attention(F.lit(360), F.lit(got[s]), F.lit(4000)), 2)) for s in A.BASE]
    assert lct == [18.0, 18.45, 20.07, 20.88, 24.21]


def test_safeguards(spark):
    cases = {"flat": ([100] * 5, 2000), "normal": ([100, 105, 118, 127, 169], 2000), "ssr": ([30, 31, 32, 33, 34], 50), "volatile": ([2, 2.1, 2.2, 2.3, 2.4], 49), "low": ([10, 11, 12, 13, 14], 2000), "four": ([100] * 4, 2000), "ceiling": ([100, 105, 90, 95, 100.001], 2000), "rounded": ([2, 2.02, 2.03, 2.04, 2.05], 20_000)}
    rows = [(d, s, float(v), float(n), round(360 * v / n, 2), "") for d, (staff, n) in cases.items() for s, v in zip(A.BASE, staff, strict=False)]
    rows += [("flat", "teachers_secondary", 100.0, 900.0, 40.0, ""), ("volatile", "core_sped", 9.0, 10.0, 324.0, "WARN_SPED_RATIO_CAP"), ("volatile", "teachers_elementary", 1.0, 12.0, 30.0, "")]
    got = {}
    for r in Q.safeguards(spark.createDataFrame(rows, "district_id string, scope string, staff double, pupils double, lct double, notes string")).collect():
        got.setdefault(r["district_id"], {})[r["scope"]] = r["notes"]
    assert all(got["flat"][s] == "ERR_FLAT_STAFF; ERR_RATIO_CEILING" for s in A.BASE) and got["flat"]["teachers_secondary"] == ""
    assert not any(got["normal"].values()) and not any(got["four"].values())
    assert all("ERR_IMPOSSIBLE_SSR" in f and "ERR_VOLATILE" not in f for f in got["ssr"].values()) and [s for s, f in got["ssr"].items() if "WARN_LCT_HIGH" in f] == ["teachers_only"]
    assert all("ERR_VOLATILE" in got["volatile"][s] for s in A.BASE) and got["volatile"]["core_sped"] == "WARN_SPED_RATIO_CAP" and got["volatile"]["teachers_elementary"] == ""
    assert all(f == "WARN_LCT_LOW" for f in got["low"].values()) and all(f == "ERR_RATIO_CEILING" for f in got["ceiling"].values())
    assert all(f == "WARN_LCT_LOW" for f in got["rounded"].values())  # few staff of many pupils round to one value: that isn't a ceiling


def test_qa_report(spark):
    rows = [(f"{i:03}", "A" if i % 2 else "B", s, 10.0 + k + i / 10, "") for i in range(8) for k, s in enumerate(A.BASE)]
    rows += [(f"9{i}", "C", "all", 1.0 + i / 100, "WARN_LCT_LOW") for i in range(7)] + [("x", "D", "all", 500.0, "note")] + [(f"8{i}", "A", s, 250.0, "") for i in range(9) for s in ("teachers_only", "instructional")]
    got = Q.qa_report(spark.createDataFrame(rows, "district_id string, state string, scope string, lct double, notes string")).collect()
    by = {(r["section"], r["name"]): r for r in got}
    assert by["data_quality", "total_calculations"]["value"] == 66 and by["data_quality", "pass_rate"]["value"] == 98.48 and by["data_quality", "districts_with_qa_notes"]["value"] == 8
    assert by["safeguards", "WARN_LCT_LOW"]["value"] == 7 and by["state_coverage", "states_with_data"]["value"] == 3
    assert by["hierarchy", "Teachers < Core"]["value"] == 0 and by["overall_status", "overall_status"]["detail"] == "WARNING" and ("hierarchy", "Teachers < Elementary") not in by
    out = [(r["name"], r["detail"]) for r in got if r["section"] == "outliers"]
    assert len(out) == 15 and out[0] == ("teachers_only.80", "Very high LCT: 250.0 min (info)") and out[-1] == ("all.94", "Very low LCT: 1.0 min (warning)")
    empty = {(r["section"], r["name"]): r["value"] for r in Q.qa_report(spark.createDataFrame([], "district_id string, state string, scope string, lct double, notes string")).collect()}
    assert empty["data_quality", "pass_rate"] == 0 and empty["overall_status", "overall_status"] == 1


def test_special_education_estimates(spark):
    d = spark.createDataFrame([("1", "A", 5000, 250.0), ("2", "A", 5000, 20.0), ("3", "B", 1000, 50.0), ("4", "C", 100, 9.0), ("5", "A", 0, 9.0)], "district_id string, state string, pupils bigint, teachers double")
    lea = spark.createDataFrame([("1", 0.13), ("2", 0.13), ("5", 0.2)], "district_id string, proportion double")
    st = spark.createDataFrame([("A", 0.1, 0.067, 0.5, 0.9), ("B", 0.1, None, 0.3, None)], "state string, proportion double, self_contained double, teacher_ratio double, instructional_ratio double")
    got = {r["district_id"]: r for r in A.special_education(d, lea, st).collect()}
    r = got["1"]
    assert (r["sped"], r["self_contained"], r["gened"], r["sped_teachers"], r["sped_instructional"], r["gened_teachers"], r["confidence"]) == (650, 44, 4956, 22.0, 39.6, 228.0, "medium")
    assert got["2"]["gened_teachers"] == -2.0 and got["2"]["confidence"] == "low"
    assert got["3"]["method"] == "national_average_fallback" and got["3"]["sped_teachers"] == round(7 * 0.4, 2)
    assert set(got) == {"1", "2", "3"}


def test_minutes_chain(spark):
    d = spark.createDataFrame([(i, s) for i, s in zip("123456", "AAABCD", strict=True)], "district_id string, state string")
    b = spark.createDataFrame([("1", "high", 390, 2024, 1), ("2", "middle", 375, 2023, 2), ("3", "high", 300, 2020, 3), ("3", "high", 0, 2024, 4), ("3", "elementary", 280, 2019, 5)], "district_id string, grade_level string, minutes bigint, year int, bell_id int")
    req = spark.createDataFrame([("A", 300, 310), ("B", 300, 310), ("C", 0, 330)], "state string, high int, fallback int")
    got = {r["district_id"]: tuple(r)[1:] for r in A.minutes_chain(b, req, d).collect()}
    assert got == {"1": (390, "bell_schedule", "2024"), "2": (375, "bell_schedule_middle", "2023"), "3": (280, "bell_schedule_elementary", "2019"), "4": (300, "state_requirement", "2023-24"), "5": (330, "state_requirement", "2023-24"), "6": (360, "default", "2023-24")}


def _inputs(spark, sped=None):
    d = spark.createDataFrame([("1", "A", False), ("2", "A", True), ("3", "B", False), ("4", "B", False)], "district_id string, state string, shared_service boolean")
    s = A.with_scopes(spark.createDataFrame([(i, 6.0, 4.0, 0.0, 0.0, 2.0, 3.0) for i in "1234"], "district_id string, elementary double, secondary double, kindergarten double, ungraded double, paras double, coordinators double"))
    e = spark.createDataFrame([("1", 100, 60, 40), ("2", 100, 60, 40), ("3", 0, 0, 0), ("4", 50, 1, 49)], "district_id string, k12 bigint, k5 bigint, g612 bigint")
    m = spark.createDataFrame([(i, 300, "default") for i in "1234"], "district_id string, minutes bigint, minutes_source string")
    return A.all_variants(d, s, e, m, sped)


def test_all_variants(spark):
    rows = {(r["district_id"], r["scope"]): r for r in _inputs(spark).collect()}
    assert {d for d, _ in rows} == {"1", "4"}  # shared services and districts without pupils go
    assert rows["1", "teachers_only"]["lct"] == 30.0 and rows["1", "teachers_elementary"]["lct"] == 30.0
    assert ("4", "teachers_elementary") not in rows  # 1800 minutes a pupil isn't plausible
    assert all(s not in A.SPED for _, s in rows)


def test_special_education_is_capped_and_missing_stays_missing(spark):
    sped = spark.createDataFrame([("1", 2, 5, 6, 5, "medium"), ("4", 9, 9, 9, 1, "low")], "district_id string, self_contained bigint, sped_teachers bigint, sped_instructional bigint, gened_teachers bigint, confidence string")
    rows = {(r["district_id"], r["scope"]): r for r in _inputs(spark, sped).collect()}
    assert rows["1", "core_sped"]["lct"] == 360.0 and rows["1", "core_sped"]["notes"] == "WARN_SPED_RATIO_CAP"
    assert ("4", "core_sped") not in rows and ("4", "instructional_sped") not in rows
    assert rows["1", "teachers_gened"]["pupils"] == 98


def test_clock_and_years(spark):
    for text, want in (("12:00 AM", 0), ("12:30 PM", 750), ("8:05 AM", 485), ("15:00", None), ("x", None)):
        assert one(spark, D.clock_minutes(F.lit(text))) == want
    assert one(spark, D.minutes_between(F.lit("10:00 PM"), F.lit("6:00 AM"))) == 480
    assert one(spark, D.span_of(F.lit("2023-24"), F.lit(None).cast("string"), F.lit("2020-21"))) == 3
    assert one(spark, D.in_window(F.lit("2023-24"), F.lit("2019-20"))) is False


def test_numbers(spark):
    assert one(spark, N.safe_float(F.lit("*"))) is None and one(spark, N.safe_float(F.lit(" 1e3 "))) == 1000.0
    assert one(spark, N.truthy(F.lit(float("nan")))) is None and one(spark, N.or_zero(F.lit(None).cast("double"))) == 0.0
    assert one(spark, N.backoff_ms(F.lit(6))) == 8000


def test_codes(spark):
    assert one(spark, T.state_district_id(F.lit("IL"), F.lit("01-234-5678-90"))) == "01-234-5678-90"
    assert one(spark, T.zero_fill(F.lit("12345678"), 7)) == "12345678"
    assert one(spark, T.strip_zeros(F.lit("000"))) == "000"


def test_upsert_with_null_keys_and_repeats(spark):
    old = spark.createDataFrame([(1, "a", "old"), (1, None, "old"), (2, "a", "old")], "k int, g string, v string")
    new = spark.createDataFrame([(1, "a", "new"), (1, None, "new"), (3, "a", "new")], "k int, g string, v string")
    got = sorted(map(tuple, R.upsert(old, new, ["k", "g"]).collect()), key=str)
    assert got == sorted([(1, "a", "new"), (1, None, "new"), (2, "a", "old"), (3, "a", "new")], key=str)
    assert R.upsert(old, new.limit(0), ["k", "g"]).count() == 3


def test_target_year_or_latest(spark):
    df = spark.createDataFrame([(1, 2020), (1, 2022), (2, 2021)], "d int, year int")
    assert sorted(map(tuple, R.target_or_latest(df, ["d"], "year", 2021, []).collect())) == [(2, 2021)]
    assert sorted(map(tuple, R.target_or_latest(df, ["d"], "year", 1999, []).collect())) == [(1, 2022), (2, 2021)]


def test_flags_and_classes(spark):
    assert one(spark, Q.minutes_class(F.lit(360))) == "default" and one(spark, Q.minutes_class(F.lit(None).cast("int"))) == "missing"
    errors, warnings = Q.schedule_errors(F.lit("8:00 AM"), F.lit("3:00 PM"), F.lit(400), F.lit("high"))
    assert one(spark, errors) == [] and one(spark, warnings) == []


def test_pages(spark):
    df = spark.createDataFrame([(1, '<html><title> A <b>b</b></title><a href="/x.pdf">High School</a><script>var a = 1;</script><p>t</p></html>')], "page_id int, html string")
    assert df.select(P.strip_tags(c("html")).alias("x")).first()["x"] == "A b High School t"
    assert [tuple(r) for r in P.links(df).collect()] == [(1, 0, "/x.pdf", "High School", "high")]
    assert df.select(P.markdown(c("html")).alias("x")).first()["x"].count("[High School](/x.pdf)") == 1


def test_runs(spark):
    log = [("a", "start", 1, 1, None, "s"), ("a", "complete", 5, 2, 9, "d"), ("b", "start", 1, 3, None, "s"), ("b", "fail", 2, 4, None, "no disk"), ("c", "start", 3, 5, None, "s"), ("d", "fail", 3, 6, None, "x"), ("e", "start", 1, 7, None, "s"), ("e", "fail", 2, 8, None, "x"), ("e", "start", 3, 9, None, "s")]
    got = {r["run_id"]: tuple(r)[1:] for r in U.runs(spark.createDataFrame(log, "run_id string, event string, at_time bigint, seq bigint, n bigint, message string")).collect()}
    assert got == {"a": ("completed", 1, 5, 9, None), "b": ("failed", 1, 2, None, "no disk"), "c": ("running", 3, None, None, None), "e": ("running", 3, None, None, None)}


def test_addresses(spark):
    cases = {"https://a.org/bell-schedule": 0.2, "https://a.org/Bell_Schedule/School-Hours": 0.4, "https://a.org/calendar/news": 0.0, "https://a.org/x": 0.0, "https://a.org/parents/x": 0.1}
    # clamped step by step: 1.2 counts as 1 before the penalty
    cases["https://a.org/bell-schedule/school-hours/daily-schedule/start-time/dismissal/arrival/news"] = 0.8
    df = spark.createDataFrame([(k,) for k in cases], "url string")
    assert {r[0]: r[1] for r in df.select("url", P.url_score(c("url"))).collect()} == cases
    words = df.select(P.keywords(c("url"), P.POSITIVE).alias("k"), P.keywords(c("url"), P.NEGATIVE).alias("n")).collect()
    assert words[0]["k"] == ["bell", "schedule", "schedules"] and words[2]["n"] == ["calendar", "news"]
    assert one(spark, P.glob(F.array(F.lit("bell"), F.lit("end")))) == "**/*bell*end*"


def test_cells_of_tables(spark):
    from lectern.plans.texts import table_schedules

    text = "| School | Hours |\n|---|---|\n| Oak Elementary | 8:00-2:30 | 9:00-1:00 |\n| Ash High | 7:25 AM - 1:00 |\n| Ash High | 7:25 AM - 2:05 PM |"
    got = table_schedules(spark.createDataFrame([(1, text)], "doc_id int, text string")).collect()
    assert sorted(map(tuple, got)) == [(1, "elementary", "8:00 AM", "2:30 PM", 390), (1, "high", "7:25 AM", "1:00 PM", 335)]


def test_triage(spark):
    text = "Bell schedule " + "8:00 " * 21
    points, first = P.triage(F.lit(text))
    assert one(spark, points) == 8 and len(one(spark, first)) == 10 and one(spark, P.triaged(points)) == "active"
    assert one(spark, P.triage(F.lit("School hours: start time 8:00"))[0]) == 3


def test_close_names_are_those_of_difflib(spark):
    import difflib

    from lectern.plans.joins import close_names

    known = ["Oak Park", "North Oak Park", "Yoak Prak", "Springfield", "oak park east", "Lake View", "Lakeview", "Bake View"]
    wanted = ["OAK PARK", "park", "Aok Parc", "Xake View", "ake Viev", "zzz"]
    df = close_names(spark.createDataFrame([(w,) for w in wanted], "wanted string"), spark.createDataFrame([(k,) for k in known + known], "name string"))
    got = {w: set() for w in wanted}
    for r in df.collect():
        got[r["wanted"]].add(r["name"])
    for w in wanted:
        want = [k for k in known if k.lower() == w.lower()] or [k for k in known if w.lower() in k.lower()] or difflib.get_close_matches(w, known, 3, 0.6)
        assert got[w] == set(want), w
    assert got["Xake View"] and got["OAK PARK"] == {"Oak Park"}


def test_fuzzy_cascade_looks_at_all_names(spark):
    from lectern.plans.joins import fuzzy_cascade

    known = ["North Oak Park", "Springfield Public Schools", "Los Angeles Unified", "Lakewood", "Los Alamos", "Oakdale", "Elm"]
    want = {"oak park": ("North Oak Park", 2), "Spring School District": ("Springfield Public Schools", 3), "Los Angeles County Office": ("Los Angeles Unified", 5), "Lake Shore East": ("Lakewood", 4), "Lakewood": ("Lakewood", 1), "LAKEWOOD": ("Lakewood", 2), "Oakd Hill": ("Oakdale", 4), "Elm Grove": None}
    df = fuzzy_cascade(spark.createDataFrame([(w,) for w in want], "wanted string"), spark.createDataFrame([(k,) for k in known], "name string"))
    assert {r["wanted"]: (r["name"], r["rule"]) for r in df.collect()} == {w: m for w, m in want.items() if m}
