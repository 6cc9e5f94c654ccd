"""Joins beyond the broadcast limit: bitmaps of fixed size, and hot keys that repeat on both sides."""

import random
import time

import pytest
from pyspark.sql import functions as F

from spanloom.llm import decontaminate, storage

from .brute_leaks import leaks as brute_leaks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(400)]
    items = [(i, " ".join(rng.choice(words) for _ in range((1, 3, 8, 20, 40)[i % 5]))) for i in range(10)] + [(10, "12 13 14 15 16 17 18"), (11, None), (12, "")]
    docs = []
    for d in range(80):
        text = [rng.choice(words) for _ in range(60)]
        if d % 4 == 0:
            text[20:20] = (items[d // 4 % 10][1]).split()
        if d % 3 == 0:
            text[5:5] = "31 32 33 34 35 36 37".split()
        docs.append((d, " ".join(text), d))
    docs += [(d, t, 7) for d, t, _ in docs[:8]] + [(None, docs[0][1], 1), (900, None, 1), (901, "", 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, k1 long").repartition(5).cache(), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("bits", [12, 28])
def test_leaks_are_the_same_without_broadcasts_of_windows(spark, corpus, bits):
    docs, items = corpus
    told = lambda **o: sorted(map(str, decontaminate.leaks(docs, items, **o).collect()))
    left = lambda **o: sorted(map(str, decontaminate.decontaminate(docs, items, **o).collect()))
    expected = told()
    assert len(expected) > 15
    assert told(broadcast_bytes=0, sift_bits=bits) == expected
    if bits == 12:  # almost every window passes such a bitmap: the joins alone tell
        assert left(broadcast_bytes=0, sift_bits=bits) == left()


def test_no_unsifted_row_is_shuffled(spark, corpus):
    hashes = spark.range(5000).select(F.xxhash64("id").alias("w"), "id")
    few = storage.materialize(hashes.where("id % 50 = 0"), "few")
    bits = storage.materialize(storage.bitmap(few, "w", 24), "bits")
    kept = storage.sifted(hashes, F.col("w"), bits, 24)
    assert "hashpartitioning" not in plan(kept) and "SortMergeJoin" not in plan(kept)
    found = {r.id for r in kept.collect()}
    assert set(range(0, 5000, 50)) <= found and len(found) <= 110
    assert {r.id for r in storage.sifted(hashes, F.col("w"), bits, 24, "left_anti").collect()} == set(range(5000)) - found
    assert storage.sifted(hashes, F.col("w"), storage.bitmap(few.limit(0), "w", 24), 24).count() == 0


def test_every_bit_of_a_bitmap(spark):
    keys = spark.createDataFrame([(k,) for k in (0, 1, 63, 64, 4095, 4096, -1, -(2**63), 2**63 - 1)], "w long")
    kept = storage.sifted(spark.range(0, 5000).select(F.col("id").alias("w")), F.col("w"), storage.bitmap(keys, "w", 40), 40)
    assert sorted(r.w for r in kept.collect()) == [0, 1, 63, 64, 4095, 4096]
    kept = storage.sifted(keys, F.col("w"), storage.bitmap(keys.where("w < 0"), "w", 40), 40)
    assert sorted(r.w for r in kept.collect()) == [-(2**63), -1, 0, 2**63 - 1]  # by their low bits


def test_hot_keys_on_both_sides_are_dealt(spark):
    rows = storage.materialize(spark.range(6000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 700).alias("w"), "id", F.lit(1).alias("parts")), "rows")
    others = storage.materialize(spark.range(1400).select((F.col("id") % 350).alias("w"), F.col("id").alias("item")), "others")
    dealt = storage.deal_join(rows, others, "w", ["id"])
    assert dealt.columns == ["w", "id", "parts", "item"]
    assert sorted(dealt.collect()) == sorted(rows.join(others, "w").collect())
    assert storage.deal_join(rows.limit(0), others, "w", ["id"]).count() == 0


def test_tables_of_candidates_hold_no_words_or_hashes(spark, corpus, monkeypatch):
    """One text a row: readers hold thousands of rows at once, and six arrays of a text took 2 GB of an executor."""
    kept = {}
    monkeypatch.setattr(decontaminate, "materialize", lambda df, name: kept.setdefault(name, storage.materialize(df, name)))
    found = decontaminate.leaks(*corpus)
    assert dict(kept["candidate-texts"].dtypes) == {"doc_id": "bigint", "k1": "bigint", "k2": "bigint", "marked": "string"}
    assert found.count() > 15 and "SortMergeJoin" not in plan(found)  # few alignments go to the texts, not texts to them


@pytest.mark.parametrize("widths", [[6], [1, 3, 6]])
def test_windows_of_two_templates(spark, widths):
    texts = ["", "a", "a b c", "x \x03anna y z \x03otto \x019 \x02km a b", "a b a b a b a b", "\x03anna"]
    marked = spark.createDataFrame(list(enumerate(texts)), "k1 long, marked string")
    forms = marked.select("k1", *(c.alias(name) for name, c in decontaminate.templates(F.col("marked")).items() if name != "words"))
    found = {tuple(r) for r in decontaminate.template_windows(forms, ["k1"], widths).collect()}
    each = [decontaminate.windows(F.col(name), n) for name in ("named", "plain") for n in widths]
    assert {tuple(r) for r in forms.select("k1", F.explode(F.concat(*each)).alias("w")).collect()} == found
    sliced = [decontaminate.windows(F.col(name), F.lit(n)) for name in ("named", "plain") for n in widths]
    assert forms.select(*each).collect() == forms.select(*sliced).collect()
    #: Of its nine words two are names: 9 + 1, 7 + 5 and 4 + 4 windows of one, three and six words.
    assert len({w for k, w in found if k == 3}) == sum({1: 10, 3: 12, 6: 8}[n] for n in widths)


def test_repetitive_texts_cost_no_more_than_their_length(spark):
    """Numbers and letters in turn: all windows of all texts have two templates, so every pair is judged in full."""
    text = lambda first, n: " ".join(f"w{first + i}" for i in range(n))
    docs = [(d, text(7 * d, 60)) for d in range(40)] + [(900, text(0, 600))]
    items = [(i, text(5 * i, 60)) for i in range(6)]
    began = time.monotonic()
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert time.monotonic() - began < 90
    assert {(r.doc_id, r.item_id): (r.item_windows, r.matched_windows, r.n_slots, r.n_consistent, r.n_changed) for r in found} == brute_leaks(docs, items)
    assert len(found) == 41 * 6
