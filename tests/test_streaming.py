import datetime
import random

from lectern.operators.queue import fold
from lectern.streaming import queue as Q

SCHEMA = "district_id string, attempted timestamp, attempt_id bigint, event_type string"
DAY = datetime.datetime(2024, 1, 1)


def events(n, seed=14):
    rng = random.Random(seed)
    return [(str(rng.randrange(12)), DAY + datetime.timedelta(minutes=10 * i), i, rng.choice(["signup", "error", "error", "view", "purchase", "click"])) for i in range(n)]


def test_stream_over_batches_ends_as_the_fold(spark, tmp_path):
    rows = events(300)
    for i in range(3):  # three files, three micro-batches
        spark.createDataFrame(rows[100 * i : 100 * i + 100], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        Q.upsert_batches(Q.queue_states(stream), f"{tmp_path}/out", f"{tmp_path}/check")
    last = {}
    for r in spark.read.parquet(f"{tmp_path}/out").orderBy("batch").collect():
        last[r["district_id"]] = (r["tier"], r["status"], r["steps"])
    want = {r["district_id"]: (r["tier"], r["status"], r["steps"]) for r in fold(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert last == want


def test_hours_close_behind_the_watermark(spark, tmp_path):
    rows = [("1", DAY + datetime.timedelta(minutes=m), m, "view") for m in (5, 50, 65, 400, 800)]
    spark.createDataFrame([(*r[:3], "x") for r in rows], SCHEMA.replace("event_type", "status")).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA.replace("event_type", "status")).parquet(f"{tmp_path}/in")
    Q.run_to_table(Q.attempts_by_hour(stream), f"{tmp_path}/out", f"{tmp_path}/check")
    got = {r["hour"].hour: r["n"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got[0] == 2 and got[1] == 1 and got[6] == 1 and 13 not in got
