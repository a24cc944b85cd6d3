"""Streams run to their end over the events table."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..sources.files import scratch
from ..streaming import queue as Q
from .model import attempts
from .registry import query
from .state import FOLD_SQL


class _Streamed:
    """The events table as a stream; other tables as they are."""

    def __init__(self, t) -> None:
        path = scratch(t.spark, "events-in")
        t.events.write.parquet(path)
        self.events = t.spark.readStream.schema(t.events.schema).parquet(path)


@query("stream_queue_states", FOLD_SQL)
def _(t):
    states = Q.queue_states(attempts(_Streamed(t)).select("district_id", "attempted", "attempt_id", "event_type"))
    out, check = scratch(t.spark, "states"), scratch(t.spark, "states-check")
    Q.upsert_batches(states, out, check)
    last = Window.partitionBy("district_id").orderBy(F.desc("batch"))
    rows = t.spark.read.schema("district_id string, tier int, status string, steps int, batch int").parquet(out)
    latest = rows.withColumn("r", F.row_number().over(last)).where("r = 1")
    return latest.select("district_id", "tier", "status", "steps")


@query("stream_attempts_by_hour")
def _(t):
    out, check = scratch(t.spark, "hours"), scratch(t.spark, "hours-check")
    Q.run_to_table(Q.attempts_by_hour(attempts(_Streamed(t))), out, check)
    return t.spark.read.schema("hour timestamp, status string, n bigint").parquet(out)
