"""The enrichment queue as a Structured Streaming job, and windowed counts of attempts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.queue import LAST_TIER

_OUT = "district_id string, tier int, status string, steps int"


def advance(tier: int, status: str, steps: int, event: str) -> tuple[int, str, int]:
    """One transition: the same table as the batch fold."""
    if event == "signup":
        return 1, "pending", steps + 1
    if status not in ("new", "pending"):
        return tier, status, steps
    if event == "error":
        return (LAST_TIER, "manual_review", steps + 1) if tier >= LAST_TIER else (tier + 1, "pending", steps + 1)
    if event == "view" and tier >= 4:
        return tier, "manual_review", steps + 1
    if event == "purchase":
        return tier, "completed", steps + 1
    return tier, status, steps


def _step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    now = state.get if state.exists else (0, "new", 0)
    rows = pd.concat(list(frames)).sort_values(["attempted", "attempt_id"])
    for event in rows["event_type"]:
        now = advance(int(now[0]), now[1], int(now[2]), event)
    state.update(now)
    yield pd.DataFrame({"district_id": [key[0]], "tier": [now[0]], "status": [now[1]], "steps": [now[2]]})


def queue_states(events: DataFrame) -> DataFrame:
    """A stream of (district_id, tier, status, steps): the state of each district that a micro-batch touched.

    events: a stream of (district_id, attempted, attempt_id, event_type).  Inside a micro-batch events are taken in the
    order of their time; state is kept by district, so its size follows the districts and not the events.
    """
    return events.groupBy("district_id").applyInPandasWithState(_step, _OUT, "tier int, status string, steps int", "update", GroupStateTimeout.NoTimeout)


def attempts_by_hour(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """Attempts by hour and status; events later than the watermark are dropped and closed windows leave the state."""
    timed = events.withColumn("attempted", F.col("attempted").cast("timestamp")).withWatermark("attempted", late)
    g = timed.groupBy(F.window("attempted", "1 hour").alias("w"), "status").agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("hour"), "status", "n")


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over what is there and end: each micro-batch is written once, whatever is run again."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def upsert_batches(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write each micro-batch of an update stream under its number; a batch that runs again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
