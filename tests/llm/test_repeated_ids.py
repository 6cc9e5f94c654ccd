"""Byte deduplication where rows share an id but not their text."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from spanloom.llm import suffix_dedup

WIDE = 50


def brute(rows):
    """Per row: bytes removed and the hash of what is left. A string counts that also starts under a smaller id, in any of its rows."""
    raw = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, data in raw:
        for p in range(len(data) - WIDE + 1) if i is not None else ():
            s = data[p : p + WIDE]
            least[s] = min(i, least.get(s, i))
    out = []
    for i, data in raw:
        gone = bytearray(len(data))
        for p in range(len(data) - WIDE + 1) if i is not None else ():
            if least[data[p : p + WIDE]] < i:
                gone[p : p + WIDE] = b"\x01" * WIDE
        out.append((str(i), len(data), sum(gone), hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()))
    return sorted(out)


def judged(spark, rows, partitions, split=suffix_dedup.SPLIT):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.kept_sha256) for r in suffix_dedup.remove_repeats(frame, split=split).collect())


@pytest.fixture(scope="module")
def words():
    rng = random.Random(2)
    return lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))


@pytest.mark.parametrize("partitions", [1, 7])
def test_short_and_long_rows_of_one_id(spark, words, partitions):
    """A short text under the id of a long one, before and after it, and an unrelated text behind."""
    passage, lead, end = words(159), words(500), words(80)
    for rows in ([(1, passage), (2, lead + passage), (2, "x")], [(1, passage), (2, "x"), (2, lead + passage), (5, passage + end)], [(1, passage), (2, lead + passage), (5, passage + end), (2, ""), (2, None)]):
        assert judged(spark, rows, partitions) == brute(rows)


@pytest.mark.parametrize("split", [suffix_dedup.SPLIT, 1])
def test_many_texts_of_few_ids(spark, words, split):
    """Rows of few ids, one with a third of all, share passages at other places; some are equal, some have no id."""
    rng = random.Random(4)
    passages = [words(rng.randint(50, 300)) for _ in range(12)]
    rows = []
    for n in range(240):
        text = words(rng.randint(0, 200)) + rng.choice(passages)[rng.randint(0, 40) :] + words(rng.randint(0, 90)) + rng.choice(passages)
        rows.append((rng.choice([7, rng.randint(1, 40), n + 100, None]) if n % 3 else 7, text[: rng.choice([10, 60, 10_000])]))
    rows += rows[:20]
    assert judged(spark, rows, 6, split) == brute(rows)


def test_hot_ids_by_broadcast(spark, words, monkeypatch):
    """The same where ids count as hot."""
    from spanloom.llm import storage

    monkeypatch.setattr(storage, "HOT_ROWS", 3)
    monkeypatch.setattr(storage, "HOT_KEYS", 10**9)
    passage = words(120)
    rows = [(n % 3, words(n) + passage + words(n % 7)) for n in range(40)] + [(50 + n, passage) for n in range(5)]
    assert judged(spark, rows, 4) == brute(rows)


def test_unique_ids_need_no_numbers(spark, words):
    frame = spark.createDataFrame([(n, words(60)) for n in range(20)], "doc_id long, text string")
    assert suffix_dedup.numbered(frame.where(F.col("doc_id") >= 0)).columns == ["doc_id", "text"]
