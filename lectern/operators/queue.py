"""The enrichment queue as pure functions over its rows, and as a fold over an ordered event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LAST_TIER = 5


def enqueue(ids: DataFrame, known: DataFrame) -> DataFrame:
    """New ids as pending rows of the first tier."""
    return ids.select("district_id").distinct().join(known.select("district_id").distinct(), "district_id", "left_anti").withColumns({"tier": F.lit(1), "status": F.lit("pending")})


def escalate(queue: DataFrame) -> DataFrame:
    """Each row at its next tier; from the last one it goes to manual review."""
    end = F.col("tier") >= LAST_TIER
    return queue.withColumns({"status": F.when(end, "manual_review").otherwise("pending"), "tier": F.least(F.col("tier") + 1, F.lit(LAST_TIER))})


def block(queue: DataFrame, blocked) -> DataFrame:
    return queue.withColumns({"status": F.when(blocked, "manual_review").otherwise(F.col("status")), "security_blocked": blocked})


def complete(queue: DataFrame, done) -> DataFrame:
    return queue.withColumns({"status": F.when(done, "completed").otherwise(F.col("status")), "success": F.when(done, F.lit(True))})


def fold(events: DataFrame) -> DataFrame:
    """(district_id, tier, status, steps): the queue after all events (district_id, attempted, attempt_id, event_type) in order.

    signup enqueues anew, error escalates, view blocks, purchase completes; a completed or blocked row stays until a
    signup.  A district's events are folded by one aggregate over its sorted array.
    """
    log = F.array_sort(F.collect_list(F.struct("attempted", "attempt_id", "event_type")))
    start = F.struct(F.lit(0).alias("tier"), F.lit("new").alias("status"), F.lit(0).alias("steps"))

    def step(s, e):
        kind, open_ = e["event_type"], s["status"].isin("new", "pending")
        row = lambda tier, status, n: F.struct(tier.alias("tier"), status.alias("status"), n.alias("steps"))
        n = s["steps"] + 1
        return (
            F.when(kind == "signup", row(F.lit(1), F.lit("pending"), n))
            .when((kind == "error") & open_ & (s["tier"] >= LAST_TIER), row(F.lit(LAST_TIER), F.lit("manual_review"), n))
            .when((kind == "error") & open_, row(s["tier"] + 1, F.lit("pending"), n))
            .when((kind == "view") & open_ & (s["tier"] >= 4), row(s["tier"], F.lit("manual_review"), n))
            .when((kind == "purchase") & open_, row(s["tier"], F.lit("completed"), n))
            .otherwise(s)
        )

    return events.groupBy("district_id").agg(F.aggregate(log, start, step).alias("s")).select("district_id", "s.tier", "s.status", "s.steps")


def repeat_failures(attempts: DataFrame, blocked: int = 3, not_found: int = 4) -> DataFrame:
    """(district_id, reason): districts not skipped so far with that many failures of a kind; both kinds give two rows."""
    open_ = attempts.join(attempts.where("skip").select("district_id").distinct(), "district_id", "left_anti")
    n = open_.groupBy("district_id").agg(F.count_if(F.col("status") == "blocked").alias("b"), F.count_if(F.col("status") == "not_found").alias("f"))
    reasons = F.array_compact(F.array(F.when(F.col("b") >= blocked, "repeatedly_blocked"), F.when(F.col("f") >= not_found, "repeatedly_not_found")))
    return n.select("district_id", F.explode(reasons).alias("reason"))


def pattern_status(feedback: DataFrame) -> DataFrame:
    """(pattern, n, districts, rate, status) from a feedback log (pattern, district_id, success)."""
    g = feedback.groupBy("pattern").agg(F.count("*").alias("n"), F.countDistinct("district_id").alias("districts"), F.round(F.avg(F.col("success").cast("double")), 4).alias("rate"))
    status = F.when((F.col("n") >= 10) & (F.col("rate") < 0.2), "flagged").when((F.col("districts") >= 3) & (F.col("rate") >= 0.8), "approved").when(F.col("districts") >= 2, "review").otherwise("learning")
    return g.withColumn("status", status)


def runs(log: DataFrame) -> DataFrame:
    """(run_id, status, started, ended, rows, error): each run as its last start and what came after it left it.

    log: (run_id, event, at_time, seq, n, message) of starts, completions and failures.  A run that was started again is
    running until it ends again; ends before the last start, or of runs never started, count for nothing.
    """
    place = F.struct("at_time", "seq")
    end = F.struct("at_time", "seq", "event", "n", "message")
    # both maxima are combined before the shuffle: a run's log is never gathered
    one = log.groupBy("run_id").agg(F.max(F.when(F.col("event") == "start", place)).alias("first"), F.max(F.when(F.col("event") != "start", end)).alias("last")).where("first is not null")
    over = (F.col("last.at_time") > F.col("first.at_time")) | (F.col("last.at_time") == F.col("first.at_time")) & (F.col("last.seq") > F.col("first.seq"))
    last = F.when(over, F.col("last"))
    done, failed = last["event"] == "complete", last["event"] == "fail"
    status = F.when(done, "completed").when(failed, "failed").otherwise("running")
    return one.select("run_id", status.alias("status"), F.col("first.at_time").alias("started"), last["at_time"].alias("ended"), F.when(done, last["n"]).alias("rows"), F.when(failed, last["message"]).alias("error"))
