"""Shared scratch space, size checks and joins on hot keys for the corpus operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side of a join is broadcast up to this many bytes.
BROADCAST_BYTES = 4 << 20
#: A key is hot beyond this many rows, and beyond one in HOT_KEYS of all rows: so there are at most HOT_KEYS of them.
HOT_ROWS, HOT_KEYS = 1_000, 100_000


def scratch_root(spark: SparkSession) -> str:
    """Folder that the driver and all executors share, from ``spark.checkpoint.dir``.

    Only a plain local session (one JVM, as in tests) may leave the setting out.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    root = tempfile.mkdtemp(prefix="spanloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to a fresh shared folder and read it back.

    A lost executor then costs a reread, not a recomputation. The folder stays until ``discard`` or ``clear_scratch``.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/spanloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.spanloom_folder = path
    return out


def delete(spark: SparkSession, pattern: str) -> None:
    """Delete the folders of the shared file system that match a pattern."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(pattern)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in files.globStatus(path) or ():
        files.delete(found.getPath(), True)


def discard(*frames: DataFrame) -> None:
    """Delete the folders of materialized frames that nothing will read again."""
    for frame in frames:
        delete(frame.sparkSession, frame.spanloom_folder)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that operators have left in the shared folder, once no result that reads it is wanted any more."""
    delete(spark, f"{scratch_root(spark)}/spanloom-*")


def bounded_batches(docs: DataFrame, max_bytes: int = 8 << 20) -> DataFrame:
    """``docs``, in a session whose Arrow batches hold at most ``max_bytes`` (a longer text comes alone).

    What a task holds in Python then follows the longest text, not the number of long texts that come together.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf = docs.sparkSession.conf
    if not 0 < int(re.sub("[^0-9-]", "", conf.get(key)) or 0) <= max_bytes:
        conf.set(key, str(max_bytes))
    return docs


def row_bytes(schema: T.StructType) -> Column:
    """About how many bytes a row takes: 8 a number, the length of texts, JSON's length for what is nested."""

    def one(field: T.StructField) -> Column:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 8
        if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        return F.lit(8)

    return sum((one(f) for f in schema.fields), F.lit(0).cast("long"))


def small_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only after its bytes have been summed and are few; else leave it to a shuffle join.

    Meant for materialized frames: the sum is one more reading of them.
    """
    return F.broadcast(df) if few_bytes(df, max_bytes) else df


def few_bytes(df: DataFrame, max_bytes: int) -> bool:
    """Whether the rows of ``df`` take at most ``max_bytes``, summed."""
    return (df.agg(F.sum(row_bytes(df.schema))).first()[0] or 0) <= max_bytes


#: Bits of a bitmap stand in blocks of 64 words of 64 bits.
BLOCK_BITS, WORD_BITS = 12, 6


def places_of(key: Column, bits: int) -> tuple[Column, Column, Column]:
    """Block, word in it and bit in that, of a 64-bit hash in a bitmap of two to the ``bits`` bits."""
    place = key.bitwiseAND(F.lit((1 << bits) - 1))
    low = F.lit((1 << WORD_BITS) - 1)
    return F.shiftright(place, BLOCK_BITS), F.shiftright(place, WORD_BITS).bitwiseAND(low).cast("int"), place.bitwiseAND(low).cast("int")


def bitmap(df: DataFrame, key: str, bits: int) -> DataFrame:
    """Which hashes ``key`` holds, as blocks of bits: two to the ``bits - 3`` bytes at most, however many rows there are."""
    block, word, bit = places_of(F.col(key), bits)
    set_bit = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = df.groupBy(block.alias("block"), word.alias("word")).agg(F.bit_or(set_bit).alias("bits"))
    held = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("held"))  # 64 entries at most
    every = F.sequence(F.lit(0), F.lit((1 << (BLOCK_BITS - WORD_BITS)) - 1))
    return held.select("block", F.transform(every, lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0).cast("long"))).alias("words"))


def sifted(rows: DataFrame, key: Column, blocks: DataFrame, bits: int, how: str = "left_semi") -> DataFrame:
    """``rows`` whose hash ``key`` may be in a ``bitmap`` (``left_anti``: certainly isn't), without a shuffle."""
    block, word, bit = places_of(key, bits)
    there = F.getbit(F.get(blocks["words"], word), bit) == 1
    return rows.join(F.broadcast(blocks), (block == blocks["block"]) & there, how)


def deal_join(rows: DataFrame, others: DataFrame, key: str, by: list[str]) -> DataFrame:
    """``rows`` joined with ``others`` on ``key``, which may repeat on both sides; both materialized.

    Rows of a hot key are dealt into parts by a hash of the columns ``by``, each of a bounded number of rows if these
    differ, and ``others`` goes to each part of its key.
    """
    parts, part = free_names([*rows.columns, *others.columns], "parts", "part")
    counts = rows.groupBy(key).agg(F.count("*").alias(parts))
    least = max(HOT_ROWS, rows.count() // HOT_KEYS)
    hot = materialize(counts.where(F.col(parts) > least).select(key, F.ceil(F.col(parts) / least).alias(parts)), "hot-keys")
    many = F.coalesce(F.col(parts), F.lit(1))
    rows = rows.join(F.broadcast(hot), key, "left").withColumn(part, F.pmod(F.xxhash64(*by), many)).drop(parts)
    others = others.join(F.broadcast(hot), key, "left").withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), many - 1))).drop(parts)
    return rows.join(others, [key, part]).drop(part)


def uses(facts: DataFrame, count: str) -> tuple[int, int]:
    """Of facts with their number of rows in ``count``: all rows, and the most of one key."""
    total, most = facts.agg(F.sum(count), F.max(count)).first()
    return total or 0, most or 0


def join_unique(rows: DataFrame, facts: DataFrame, keys: list[str], count: str, known: tuple[int, int] | None = None) -> DataFrame:
    """``rows`` with the columns of ``facts``, which has one row a key and in ``count`` how many rows have that key.

    Rows of hot keys would all go to one task; they meet their few facts by broadcast where they are. ``known`` are the
    ``uses`` of the facts, if they have been counted; null keys match nothing.
    """
    total, most = known or uses(facts, count)
    least = max(HOT_ROWS, total // HOT_KEYS)
    if most <= least:
        return rows.join(facts.drop(count), keys)
    hot = F.col(count) > least
    few = F.broadcast(facts.where(hot).drop(count))
    cold = rows.join(few.select(*keys), keys, "left_anti").join(facts.where(~hot).drop(count), keys)
    return cold.unionByName(rows.join(few, keys))


def join_facts(rows: DataFrame, facts: DataFrame, keys: list[str], count: str) -> DataFrame:
    """As ``join_unique``, for materialized facts; all are broadcast if their bytes are few."""
    size = facts.agg(F.sum(row_bytes(facts.schema))).first()[0] or 0
    return rows.join(F.broadcast(facts.drop(count)), keys) if size <= BROADCAST_BYTES else join_unique(rows, facts, keys, count)


def left_join_unique(rows: DataFrame, facts: DataFrame, keys: list[str], count: str) -> DataFrame:
    """As ``join_unique``, but rows without a fact stay, with nulls; ``facts`` should be materialized."""
    total, most = uses(facts, count)
    least = max(HOT_ROWS, total // HOT_KEYS)
    if most <= least:
        return rows.join(facts.drop(count), keys, "left")
    (met,) = free_names([*rows.columns, *facts.columns], "met")
    hot = F.col(count) > least
    first = rows.join(F.broadcast(facts.where(hot).drop(count).withColumn(met, F.lit(True))), keys, "left")
    cold = first.where(F.col(met).isNull()).select(*rows.columns).join(facts.where(~hot).drop(count), keys, "left")
    return first.where(met).drop(met).unionByName(cold)


def free_names(taken: list[str], *names: str) -> list[str]:
    """Names like these that none of ``taken`` has, in any letter case."""
    have = {t.lower() for t in taken}
    lead = "_"
    while any((lead + n).lower() in have for n in names):
        lead += "_"
    return [lead + n for n in names]


def bind(c: Column, f) -> Column:
    """``f`` of a column that is evaluated once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))
