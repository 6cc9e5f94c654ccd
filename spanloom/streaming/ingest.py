"""Structured Streaming: requests from landed files, mapped in micro-batches, with rejects and a ledger beside the rows."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.flatten import flatten, split_invalid_metrics
from ..operators.mapping import map_signal
from ..operators.sampling import capture, points_of
from ..sources.otlp import decode, split_decoded
from . import commits


def read_otlp_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """A stream of request texts, one per line; ids are file, place of the block in it, and a hash of the text, for which a
    micro-batch puts the row (see ``in_order``). Each micro-batch decodes its own."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.xxhash64("value").alias("row"))
    return lines.select(place.alias("request_id"), "value").where("trim(value) <> ''")


def in_order(texts: DataFrame) -> DataFrame:
    """A micro-batch's texts with ids that tell all apart, equal ones too, and sort them as they lie in their files."""
    return texts.withColumn("request_id", F.col("request_id").withField("row", F.monotonically_increasing_id()))


def write_batch(texts: DataFrame, batch_id: int, signal: str, mapping: dict, out: str, max_bytes: int | None = None) -> None:
    """Map one micro-batch: rows, rejects and a ledger line become visible together (see ``commits``); a batch that is there is left."""
    spark = texts.sparkSession
    if commits.is_committed(spark, out, batch_id):
        return
    decoded = decode(in_order(texts), signal).persist()  # decoded once for rows and rejects; what a lost executor held is decoded again
    good, bad = split_decoded(decoded)
    valid, wrong = map_signal(flatten(good, signal), mapping, signal, max_bytes)
    rejects = wrong.select("request_id", "reason", "column", "message").unionByName(bad.select("request_id", F.col("reject_reason").alias("reason"), F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("message")))
    if signal == "metrics":
        dropped = split_invalid_metrics(good)[1]
        rejects = rejects.unionByName(dropped.select("request_id", "reason", F.lit(None).cast("string").alias("column"), F.col("metric_name").alias("message")))
    folders = {"rows": commits.stage(valid, out, "rows", batch_id), "rejects": commits.stage(rejects, out, "rejects", batch_id)}
    written = spark.read.schema(valid.schema).parquet(f"{out}/{folders['rows']}").agg(F.count("*").alias("records"))
    refused = spark.read.schema(rejects.schema).parquet(f"{out}/{folders['rejects']}").agg(F.count("*").alias("rejected"))
    ledger = written.join(F.broadcast(refused)).select(F.lit(batch_id).alias("batch_id"), F.lit(signal).alias("signal"), F.lit("succeeded").alias("outcome"), "records", "rejected")
    folders["ledger"] = commits.stage(ledger, out, "ledger", batch_id)
    commits.commit(spark, out, batch_id, folders)
    decoded.unpersist()


def stream_to_table(stream: DataFrame, signal: str, mapping: dict, out: str, checkpoint: str, interval: str = "30 seconds", once: bool = False) -> StreamingQuery:
    """Start the stream; every batch is there exactly once, over restarts. Read it by ``commits.read_committed``."""
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger)
    return writer.foreachBatch(lambda df, n: write_batch(df, n, signal, mapping, out)).start()


def capture_batch(texts: DataFrame, batch_id: int, signal: str, n: int, out: str) -> int:
    """Take what is left of ``n`` records from one micro-batch, in the order in which they lie in its files; how many are taken in all.

    The count is that of committed batches, so that it outlives the stream, and a batch that is tried again counts once.
    """
    spark = texts.sparkSession
    before = commits.read_committed(spark, out, "items")
    size = points_of(F.col("item")) if signal == "metrics" else F.lit(1)
    taken = 0 if before is None else before.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]  # n items at most
    if taken < n and not commits.is_committed(spark, out, batch_id):
        part = capture(split_decoded(decode(in_order(texts), signal))[0], signal, n - taken).withColumn("batch", F.lit(batch_id))
        folder = commits.stage(part, out, "items", batch_id)
        commits.commit(spark, out, batch_id, {"items": folder})
        taken += spark.read.schema(part.schema).parquet(f"{out}/{folder}").agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return taken


def capture_stream(stream: DataFrame, signal: str, n: int, timeout: float, out: str, checkpoint: str, once: bool = False) -> DataFrame:
    """The first ``n`` records that a stream brings in the order of arrival (micro-batches, then places in their files), or what has come
    by ``timeout`` seconds, or with ``once`` what is there now; an error if nothing has ever come.

    The bound is the feature. Items have the number of their micro-batch in ``batch``. Started again on the same folders, it goes
    on with what is left of ``n``.
    """
    spark = stream.sparkSession
    state = {"taken": 0}

    def take(df: DataFrame, batch: int) -> None:
        state["taken"] = capture_batch(df, batch, signal, n, out)

    trigger = {"availableNow": True} if once else {"processingTime": "1 second"}
    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger).foreachBatch(take).start()
    ends = time.monotonic() + timeout
    while state["taken"] < n and time.monotonic() < ends and query.isActive:
        query.awaitTermination(1)
    if once and state["taken"] < n:
        query.awaitTermination(max(0, ends - time.monotonic()))
    query.stop()
    found = commits.read_committed(spark, out, "items")
    if found is None:
        raise TimeoutError("no item came in time")
    return found


BATCHES = "shard long, batch long, reason string, items array<string>"


class ItemBuffer(StatefulProcessor):
    """Items of a shard, kept until there are ``most`` of them, or until the first of them has waited for ``seconds``."""

    def __init__(self, most: int, seconds: float | None):
        self.most, self.seconds = most, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.items = handle.getListState("items", "item string")
        self.number = handle.getValueState("number", "batch long")

    def batch(self, key, items: list[str], reason: str) -> pd.DataFrame:
        number = self.number.get()[0] if self.number.exists() else 0
        self.number.update((number + 1,))
        return pd.DataFrame({"shard": [key[0]], "batch": [number], "reason": [reason], "items": [items]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = [r[0] for r in self.items.get()] if self.items.exists() else []
        waiting = bool(held)
        for part in rows:
            held += part["item"].tolist()
            full = len(held) // self.most * self.most
            for lo in range(0, full, self.most):
                yield self.batch(key, held[lo : lo + self.most], "items")
            if full:
                held, waiting = held[full:], False
        if held:
            self.items.put([(x,) for x in held])
        else:
            self.items.clear()
        if self.seconds is not None and not waiting:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            if held:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(1000 * self.seconds))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = [r[0] for r in self.items.get()] if self.items.exists() else []
        self.items.clear()
        if held:
            yield self.batch(key, held, "time")

    def close(self) -> None:
        pass


def batch_items(items: DataFrame, most: int = 2_000, seconds: float | None = 30) -> DataFrame:
    """A stream of (shard long, item string) as batches (BATCHES) of ``most`` items, or of those that have come when the first has
    waited for ``seconds`` (None: for ever); numbered for each shard.

    What waits is kept as state, over micro-batches and restarts: fewer than ``most`` items a shard. Items of one shard pass one
    task, so there should be many shards; null shards are one. Needs the RocksDB state store, and a time that goes on by itself where
    ``seconds`` is given (a processing-time trigger).
    """
    items.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    mode = "none" if seconds is None else "processingTime"
    return items.select("shard", "item").groupBy("shard").transformWithStateInPandas(ItemBuffer(most, seconds), BATCHES, "append", mode)
