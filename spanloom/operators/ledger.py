"""Delivery accounting over attempts: what became of each batch, replays, drops, rejects and the last writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def is_(outcome: str) -> Column:
    return F.col("outcome") == outcome


def settle(attempts: DataFrame, closed: bool = False) -> DataFrame:
    """One row per batch: batch_id, signal, table, records, attempts, status.

    ``attempts``: batch_id, signal, table, attempt, ts, outcome, retryable, records, error. A success settles a batch
    as written. Short of one, an ambiguous attempt leaves it ambiguous, whatever fails later. A failure that can't be
    retried drops it (permanent_failed); one that can leaves it pending, or retry_exhausted when ``closed``.
    """
    final = is_("failed") & ~F.col("retryable")
    status = F.when(F.bool_or(is_("succeeded")), "written").when(F.bool_or(is_("ambiguous")), "ambiguous").when(F.bool_or(final), "permanent_failed").otherwise("retry_exhausted" if closed else "pending")
    return attempts.groupBy("batch_id", "signal", "table").agg(F.max("records").alias("records"), F.count("*").alias("attempts"), status.alias("status"))


def last_attempts(attempts: DataFrame) -> DataFrame:
    """The latest attempt of each batch."""
    latest = F.row_number().over(Window.partitionBy("batch_id").orderBy(F.desc("attempt")))
    return attempts.withColumn("rank", latest).where("rank = 1").drop("rank")


def replays(attempts: DataFrame) -> DataFrame:
    """Per signal and table: replay_attempts (attempts after a batch's first ambiguous one) and replayed_records (of each such batch once)."""
    first = F.min(F.when(is_("ambiguous"), F.col("attempt"))).over(Window.partitionBy("batch_id"))
    again = attempts.withColumn("first", first).where(F.col("attempt") > F.col("first"))
    per_batch = again.groupBy("batch_id", "signal", "table").agg(F.count("*").alias("n"), F.max("records").alias("records"))
    return per_batch.groupBy("signal", "table").agg(F.sum("n").alias("replay_attempts"), F.sum("records").alias("replayed_records"))


REASONS = ("permanent_failed", "retry_exhausted", "enqueue_failed")


def drops(settled: DataFrame) -> DataFrame:
    """Per signal and table: written, ambiguous, each drop reason, and dropped, their sum, in records."""
    total = lambda s: F.coalesce(F.sum(F.when(F.col("status") == s, F.col("records"))), F.lit(0))
    sums = settled.groupBy("signal", "table").agg(*(total(s).alias(s) for s in ("written", "ambiguous", *REASONS)))
    return sums.withColumn("dropped", sum((F.col(r) for r in REASONS), F.lit(0)))


def local_rejects(rejects: DataFrame) -> DataFrame:
    """Per signal and reason: items (one for each reject) and data points."""
    return rejects.groupBy("signal", "reason").agg(F.count("*").alias("items"), F.sum("data_points").alias("data_points"))


def unsettled(counts: DataFrame) -> DataFrame:
    """``counts`` with unsettled: what was received and is neither written, ambiguous nor dropped, once the queue is seen empty; else 0."""
    final = F.col("written") + F.col("ambiguous") + F.col("dropped")
    empty = F.col("queue_observed") & (F.col("queue_size") <= 0)
    return counts.withColumn("unsettled", F.when(empty, F.greatest(F.col("received") - final, F.lit(0))).otherwise(F.lit(0)))


def last_writes(attempts: DataFrame) -> DataFrame:
    """Per signal and table: times of the last attempt, success and failure, the last error (none after a later success), and verified."""
    ok = is_("succeeded")
    ends = attempts.groupBy("signal", "table").agg(F.max("ts").alias("last_attempt"), F.max(F.when(ok, F.col("ts"))).alias("last_success"), F.max(F.when(~ok, F.col("ts"))).alias("last_failure"), F.max(F.when(~ok, F.struct("ts", "error"))).alias("e"), F.bool_or(ok).alias("verified"))
    cleared = F.col("last_success").isNotNull() & (F.col("last_success") >= F.col("last_failure"))
    return ends.select("signal", "table", "last_attempt", "last_success", "last_failure", F.when(~cleared, F.col("e.error")).alias("last_error"), "verified")
