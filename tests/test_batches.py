"""Greedy batches of keys with very many rows, and of streams, against going through the rows one by one."""

import random

import pytest
from pyspark.sql import functions as F

from spanloom.operators import sink


def one_by_one(rows, max_rows, max_bytes):
    """(key, place): batch, or None for a row that is too large."""
    out, state = {}, {}
    for key, place, size in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        number, n, total = state.get(key, (0, 0, 0))
        if size > max_bytes:
            out[key, place] = None
            continue
        if n and (n == max_rows or total + size > max_bytes):
            number, n, total = number + 1, 0, 0
        out[key, place] = number
        state[key] = (number, n + 1, total + size)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_batches_of_one_huge_key(spark, seed):
    """One key has nearly all rows, cut to chunks of some rows each; others, and rows without key, are small."""
    rng = random.Random(seed)
    sizes = [lambda: rng.randint(1, 40), lambda: rng.choice([1, 30, 101]), lambda: 50][seed]
    rows = [("hot", i, sizes()) for i in range(1_500)] + [(None, i, sizes()) for i in range(90)] + [(f"k{i % 7}", i, sizes()) for i in range(100)]
    frame = spark.createDataFrame(rows, "key string, place long, bytes long").repartition(6)
    for max_rows in (4, 7):
        packed = sink.pack_batches(frame, "key", ["place"], "bytes", max_rows=max_rows, max_bytes=100, chunk=40)
        assert packed.columns == ["key", "place", "bytes", "batch"]
        assert {(r.key, r.place): r.batch for r in packed.collect()} == one_by_one(rows, max_rows, 100)


def test_a_million_rows_of_one_key_in_many_tasks(spark):
    """Batches of 10^6 rows of one key end where a plain count says."""
    rows = spark.range(1_000_000).select(F.lit("r").alias("key"), F.col("id").alias("place"), (F.col("id") % 97 + 1).alias("bytes"))
    packed = sink.pack_batches(rows, "key", ["place"], "bytes", max_rows=500, max_bytes=30_000)
    found = packed.groupBy("batch").agg(F.min("place").alias("first"), F.count("*").alias("n")).collect()
    first, batch, n, size = {0: 0}, 0, 0, 0
    for i in range(1_000_000):
        if n == 500 or size + i % 97 + 1 > 30_000:
            batch, n, size = batch + 1, 0, 0
            first[batch] = i
        n, size = n + 1, size + i % 97 + 1
    assert {r.batch: r.first for r in found} == first
    assert packed.rdd.getNumPartitions() > 1


def test_huge_keys_are_followed_by_range_not_by_rounds(spark, monkeypatch):
    """However many chunks there are, rows are written a fixed number of times, none of them in pieces of a chunk's few rows."""
    tables, written = [], sink.written
    monkeypatch.setattr(sink, "written", lambda rows: tables.append(rows.columns) or written(rows))
    sizes = lambda i: (i * 37 % 45 + 1) if i % 11 else 200
    rows = [(key, i, sizes(i + len(key))) for key in ("a", "bb", "ccc") for i in range(1_200)]
    frame = spark.createDataFrame(rows, "key string, place long, bytes long").repartition(5)
    for chunk in (8, 300):
        packed = sink.pack_batches(frame, "key", ["place"], "bytes", max_rows=8, max_bytes=100, chunk=chunk)
        assert len(tables) == 3
        assert {(r.key, r.place): r.batch for r in packed.collect()} == one_by_one(rows, 8, 100)
        tables.clear()


def test_ranges_of_fewer_rows_than_a_batch_and_without_any_that_fit(spark):
    """Batches that go on over ranges of a row or two, of rows that are all too large, and of rows of no bytes."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # would put small ranges together
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        rows = [("k", i, 200 if 20 <= i < 40 else [0, 5, 30][i % 3]) for i in range(60)]
        frame = spark.createDataFrame(rows, "key string, place long, bytes long")
        packed = sink.pack_batches(frame, "key", ["place"], "bytes", max_rows=7, max_bytes=100, chunk=7)
        assert packed.rdd.getNumPartitions() > 1
        assert {(r.key, r.place): r.batch for r in packed.collect()} == one_by_one(rows, 7, 100)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_no_rows(spark):
    assert sink.pack_batches(spark.createDataFrame([], "key string, place long, bytes long"), "key", ["place"], "bytes").collect() == []
