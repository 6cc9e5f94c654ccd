"""Each corpus operator against a brute-force version, an exact round trip, or held-out accuracy, on small tables."""

import hashlib
import os
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanloom.llm import decontaminate, line_dedup, ngram_join, packing, pii, quality_classifier, quality_rules, storage, suffix_dedup, token_counts, warc

from . import brute_pipeline
from .brute_leaks import leaks as brute_leaks

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Columns that operators use inside, as extra columns of the input.
CLASHING = ["k1", "k2", "key", "node", "root", "rep", "a", "b", "pos", "line", "site", "id", "ranges", "places", "tile", "n_lines", "n_removed", "reason", "canonical", "windows", "deal", "n_bytes", "held_out", "base", "wide", "_k1", "__k1", "_gone", "_lines", "item", "spans", "y", "size"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abdeghilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = [text(rng.randint(1, 300)) for _ in range(60)]
    for t in texts[:15]:  # near copies: one word in thirty changes
        words = t.split()
        for i in range(0, len(words), 30):
            words[i] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    passage = text(60)
    texts += [f"{text(40)} {passage} {text(20)}" for _ in range(4)] + texts[:5]
    texts += [None, "", " \n\t ", "one", "one two", "ONE TWO", text(30_000), "a" * 400, "é" * 130, "x\x1cy z don't!!", "<|endoftext|> İstanbul 中文"]
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def docs(spark, rows):
    frame = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return frame.withColumns({c: F.lit(c) for c in CLASHING})


def table(frame, key="doc_id"):
    return {r[key]: r for r in frame.collect()}


def encodings(rows):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(token_counts.tokenizer_path())
    return {i: own.encode(t or "", add_special_tokens=False).ids for i, t in rows}


def test_token_counts_equal_the_library(docs, rows):
    found, expected = table(token_counts.count_tokens(docs)), encodings(rows)
    assert {i: r.n_tokens for i, r in found.items()} == {i: len(x) for i, x in expected.items()}
    assert all(r.n_bytes == len((dict(rows)[i] or "").encode()) and r.over_limit == (r.n_tokens > 2048) for i, r in found.items())


def test_whole_tokens_are_proved_and_tables_start_anew():
    own = token_counts.TokenTable(token_counts.tokenizer_path(), limit=40_000)
    assert len(own.whole) > 30_000 and all(own.tokenizer.encode(t, add_special_tokens=False).ids == [n] for t, n in list(own.whole.items())[::997])
    for i in range(3):
        strings = [f"qzx{j}w{i}" for j in range(6000)]
        rows = own.rows(strings)
        assert own.lengths()[rows].tolist() == [len(e.ids) for e in own.tokenizer.encode_batch(strings, add_special_tokens=False)]


def test_other_tokenizers_are_refused():
    from tokenizers import Tokenizer, models, pre_tokenizers

    token_counts.require_known_split(Tokenizer.from_file(token_counts.tokenizer_path()))
    other = Tokenizer(models.BPE())
    for split in (None, pre_tokenizers.Whitespace()):
        if split:
            other.pre_tokenizer = split
        with pytest.raises(ValueError, match="knows the split"):
            token_counts.require_known_split(other)


def test_packing_holds_every_id_once(docs, rows):
    ids = {i: [*x, 2] for i, x in encodings(rows).items()}
    pieces = packing.pack_documents(docs).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert by_doc.keys() == ids.keys()
    for i, parts in by_doc.items():
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids[i])
            assert p.ids_crc32 == zlib.crc32(np.array(ids[i][at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids[i])
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096


def test_first_fit_decreasing_is_first_fit():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 200):
        sizes = rng.integers(1, 101, n)
        bins, offsets = packing.first_fit_decreasing(sizes, 100)
        room, expected = [], {}
        for i in np.argsort(-sizes, kind="stable"):
            b = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
            if b == len(room):
                room.append(100)
            expected[i] = (b, 100 - room[b])
            room[b] -= sizes[i]
        assert {i: (bins[i], offsets[i]) for i in range(n)} == expected


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def components(rows, n, num):
    sets = {i: shingles(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("n", "num"), [(3, 90), (5, 80), (3, 50), (2, 60), (3, 70), (3, 100)])
def test_jaccard_components_equal_all_pairs(docs, rows, n, num):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs, n, num).collect()}
    assert found == components(rows, n, num)


@pytest.mark.parametrize("bounds", [{"shingles": 2000}, {"sets": 7}])
def test_large_components_are_cut_into_tiles(spark, docs, rows, bounds):
    """Tiles so small that a component spans many of them give the same links."""
    nodes = spark.createDataFrame([(i, len(shingles(t, 5)), 0) for i, t in rows if shingles(t, 5)], "node long, n_shingles long, root long")
    placed = ngram_join.tiles(nodes, 80, **bounds)
    assert placed.select("tile").distinct().count() > 10
    assert bounds.get("sets", 10**6) >= placed.groupBy("tile", "block").count().agg(F.max("count")).first()[0] // 3
    known = docs.select("doc_id", "text")
    profile = ngram_join.profiles(known, 5)
    near = ngram_join.connected_components(ngram_join.sift(profile, placed, 80))
    assert {r.node for r in near.collect()} < {i for i, t in rows if shingles(t, 5)}
    links = ngram_join.settle(known, placed, 5, 80)
    joined = ngram_join.connected_components(links)
    found = {r.node: r.root for r in joined.collect()}
    sifted = {r.node: r.root for r in near.collect()}
    assert all(sifted[i] == sifted[r] for i, r in found.items())  # no link is lost by bit counts
    assert {i: found.get(i, i) for i, t in rows} == {i: c for i, (_, c) in components(rows, 5, 80).items()}


def test_similarity_is_a_percentage(docs):
    for num in (0, 101):
        with pytest.raises(ValueError):
            ngram_join.near_duplicates(docs, 3, num)


def test_joins_on_hot_keys(spark, monkeypatch):
    """Hot keys met by broadcast give the rows of a plain join; components with hot nodes are the same."""
    monkeypatch.setattr(storage, "HOT_ROWS", 5)
    rows = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(60)], "u long, v long")
    facts = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    joined = storage.join_unique(rows, facts, ["u"], "n")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, rows.join(facts.drop("n"), "u").collect()))
    links = spark.createDataFrame([(1000, i) for i in range(40)] + [(i, i + 1) for i in range(2000, 2030)], "a long, b long")
    found = {r.node: r.root for r in ngram_join.connected_components(links).collect()}
    assert found == {i: 0 for i in [*range(40), 1000]} | {i: 2000 for i in range(2000, 2031)}


def test_broadcast_follows_bytes(spark):
    rows = spark.createDataFrame([(i, "x" * 1000, [i] * 10) for i in range(100)], "i long, t string, a array<long>")
    assert 100_000 < rows.agg(F.sum(storage.row_bytes(rows.schema))).first()[0] < 200_000
    plan = lambda size: spark.range(9).join(storage.small_side(rows, size), F.col("id") == F.col("i"))._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(10**6) and "strategy=broadcast" not in plan(10**4)


def test_keep_one_keeps_the_first_of_each_group(docs, rows):
    kept = {r.doc_id for r in ngram_join.keep_one(docs).collect()}
    assert kept == {i for i, (_, c) in components(rows, 5, 80).items() if i == c}


@pytest.mark.parametrize("split", [suffix_dedup.SPLIT, 1, 3])
def test_suffix_dedup_equals_brute_force(docs, rows, split):
    first = {}
    for i, t in sorted(rows, reverse=True):
        raw = (t or "").encode()
        for p in range(len(raw) - 49):
            first[raw[p : p + 50]] = i
    found = table(suffix_dedup.remove_repeats(docs, keep_text=True, split=split))
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            if first[raw[p : p + 50]] < i:
                gone[p : p + 50] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        r = found[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) == (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)


def test_bucket_refinement_in_small_portions(docs, rows, monkeypatch):
    whole = {r.doc_id: r.kept_sha256 for r in suffix_dedup.remove_repeats(docs).collect()}
    plain = suffix_dedup.refine_buckets
    monkeypatch.setattr(suffix_dedup, "refine_buckets", lambda c: plain(c, rows_at_once=3))
    assert {r.doc_id: r.kept_sha256 for r in suffix_dedup.remove_repeats(docs).collect()} == whole


def test_line_on_very_many_pages(spark):
    """A line with other bytes around it each time is dealt by its strings, in batches of few documents; each doc_id has two rows."""
    rng = random.Random(6)
    noise = lambda: "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(40, 90)))
    line = "All rights are reserved by the owner of this very site"
    texts = [(i // 2, f"{noise()}{line}{noise()}") for i in range(400)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    first = {}
    for i, t in reversed(texts):
        for p in range(len(t) - 49):
            first[t[p : p + 50]] = i
    starts = [{p for p in range(len(t) - 49) if first[t[p : p + 50]] < i} for i, t in texts]  # each row's own places
    expected = sorted((i, len({q for p in own for q in range(p, p + 50)})) for (i, _), own in zip(texts, starts))
    for split in (10, 10_000):
        assert sorted((r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeats(frame, split=split).collect()) == expected
    assert sum(n for _, n in expected) > 300 * len(line)


def test_line_dedup(spark):
    common, rare, short = "this line stands on very many sites", "this line stands on few sites only", "short"
    texts = [(i, f"{common}\nown line number {i} of its site\n{short}" + (f"\n{rare}" if i < 4 else ""), f"s{i % 12}") for i in range(24)]
    texts += [(100, None, None), (101, "", "s1"), (102, f"  {common}\t\r\n\n{common}", None), (0, texts[0][1], "s0")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string").withColumns({c: F.lit(c) for c in CLASHING})
    done = line_dedup.dedup_lines(docs, min_sites=10)
    assert set(done.columns) == set(docs.columns)
    found = defaultdict(list)
    for r in done.collect():
        found[r.doc_id].append((r.text, r.n_lines, r.n_removed))
    assert found[0] == [(texts[0][1], 4, 0)] * 2  # the first occurrence stays, in equal rows too
    assert found[1] == [(f"own line number 1 of its site\n{short}\n{rare}", 4, 1)]
    assert found[102] == [("", 3, 2)] and found[100] == [(None, 0, 0)] and found[101] == [("", 1, 0)]
    assert sum(map(len, found.values())) == len(texts)


def test_line_spread_is_exact_near_the_threshold(spark):
    docs = spark.createDataFrame([(100 * n + i, f"a line that is on {n} sites in all", f"s{i}") for n in (1, 8, 9, 10, 11, 12, 40) for i in range(n)], "doc_id long, text string, source string")
    removed = {r.n: r.s for r in line_dedup.dedup_lines(docs, min_sites=10).groupBy(F.floor(F.col("doc_id") / 100).alias("n")).agg(F.sum("n_removed").alias("s")).collect()}
    assert removed == {1: 0, 8: 0, 9: 0, 10: 9, 11: 10, 12: 11, 40: 39}


def test_line_dedup_of_many_lines(spark):
    """Documents of 40,000 boilerplate lines lose them in seconds, and a column may have any name."""
    text = "\n".join(f"boilerplate line number {i} of the site" for i in range(40_000))
    docs = spark.createDataFrame([(i, text, f"s{i}") for i in range(11)], "doc_id long, text string, source string").withColumns({c: F.lit(c) for c in CLASHING})
    began = time.perf_counter()
    found = line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.length("text").alias("n"), "_k1").collect()
    assert sorted(tuple(r) for r in found) == [(i, 40_000, 40_000 * (i > 0), 0 if i else len(text), "_k1") for i in range(11)]
    assert time.perf_counter() - began < 60


@pytest.mark.parametrize("hot", [10_000, 1])
def test_archive_round_trip(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(warc, "HOT_ROWS", hot)
    monkeypatch.setattr(storage, "HOT_ROWS", hot)
    urls = ["http://a/1\r\nPage-ID: 77", "http://a/\x00\x7f%0D", "http://a/\nWARC-Payload-Digest: sha1:NONE\r\n\r\n", "", "http://é/ü?q= x"]
    pages = [(20 + i, u, "<p>é same</p>") for i, u in enumerate(urls)]
    pages += [(3, "http://a/3", "<p>é same</p>"), (1, "http://a/1", "<p>é same</p>"), (2, None, None), (7, "http://a/7", ""), (5, "http://a/5", "WARC-Type: x\r\n\r\n"), (9, "http://a/9", "z" * 200_000)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({c: F.lit(c) for c in ("address", "payload", "first", "kind", "size", "digest")})
    warc.write_archive(frame, str(tmp_path / "w"))
    import base64

    found = table(warc.read_archive(spark, str(tmp_path / "w")), "page_id")
    for i, _, html in pages:
        raw = (html or "").encode()
        same = sorted(j for j, _, h in pages if (h or "") == (html or ""))
        expected = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if i == same[0] else "revisit", None if i == same[0] else same[0])
        assert tuple(found[i])[1:5] == expected
    assert spark.read.parquet(str(tmp_path / "w/payloads")).count() == 4
    records = warc.read_records(spark, str(tmp_path / "w")).collect()
    assert {(r.page_id, r.url, bytes(r.payload).decode()) for r in records} == {(i, u or "", h or "") for i, u, h in pages}
    for r in records:
        assert hashlib.sha256(bytes(r.record)).hexdigest() == found[r.page_id].record_sha256
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        lines = [line.split(": ", 1) for line in head.decode().split("\r\n")[1:]]
        fields = dict(lines)
        assert len(fields) == len(lines) == (11 if r.record_type == "revisit" else 8)
        assert fields["WARC-Target-URI"] == re.sub("[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", r.url)
        assert block.endswith(b"\r\n\r\n") and len(block) - 4 == int(fields["Content-Length"])
        body = block[:-4].partition(b"\r\n\r\n")[2]
        assert body == (dict((i, h) for i, _, h in pages)[r.page_id] or "").encode() * (fields["WARC-Type"] == "response")


def test_damaged_payload_is_noticed(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string"), str(tmp_path / "w"))
    (name,) = [f for f in os.listdir(tmp_path / "w/payloads") if f.endswith(".parquet")]
    bad = spark.read.parquet(str(tmp_path / "w/payloads")).withColumn("payload", F.lit(b"other")).toPandas()
    os.remove(tmp_path / f"w/payloads/.{name}.crc")
    bad.to_parquet(tmp_path / f"w/payloads/{name}")
    with pytest.raises(Exception, match="differs from its address"):
        warc.read_archive(spark, str(tmp_path / "w")).collect()


def test_missing_payload_is_noticed(spark, tmp_path):
    for n, text in (("w", "one"), ("v", "two")):
        warc.write_archive(spark.createDataFrame([(1, "u", text)], "page_id long, url string, html string"), str(tmp_path / n))
    spark.read.parquet(str(tmp_path / "v/headers")).write.mode("append").parquet(str(tmp_path / "w/headers"))
    with pytest.raises(Exception, match="no sound payload"):
        warc.read_archive(spark, str(tmp_path / "w")).collect()


def test_classifier_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.fit(docs, labels, sample_rows=600)
    scored = quality_classifier.classify(docs, model).join(labels, "doc_id").where("held_out").toPandas()
    assert (scored.predicted == scored.quality).mean() > 0.95
    assert scored.score.between(0, 1).all()
    good, bad = (scored.score[scored.quality == q].to_numpy() for q in (1, 0))
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    empty = spark.createDataFrame([(1, None), (None, ""), (2, "x" * 3_000_000)], "doc_id long, text string")
    assert all(0 <= r.score <= 1 for r in quality_classifier.classify(empty, model).collect())


def labelled(spark, texts):
    """Documents of a good and a bad kind, with labels."""
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string").withColumns({c: F.lit(c) for c in CLASHING})
    labels = spark.createDataFrame([(i, q, 0) for i, (_, q) in enumerate(texts)] + [(None, 1, 0), (10**6, 0, 0), (0, texts[0][1], 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_classifier_learns_from_whole_texts(spark):
    """What differs only beyond the first 20,000 characters of long texts changes the fit, and tells the labels apart."""
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdeghilnorst") for _ in range(6)) for _ in range(500)]
    head = " ".join(rng.choice(words) for _ in range(3000))
    tail = lambda q: " ".join(rng.choice(words[:250] if q else words[250:]) for _ in range(4000))
    texts = [(f"{head} {tail(i % 2)}", i % 2) for i in range(160)] + [("", 1), (None, 0)]
    docs, labels = labelled(spark, texts)
    model = quality_classifier.fit(docs, labels, dictionary_bytes=16 << 10)
    cut = quality_classifier.fit(docs.withColumn("text", F.substring("text", 1, 20_000)), labels, dictionary_bytes=16 << 10)
    assert model.weights != cut.weights and model.good != cut.good
    scored = quality_classifier.classify(docs, model).collect()
    truth = {i: q for i, (_, q) in enumerate(texts[:160])}
    assert sum((r.score > 0.5) == truth[r.doc_id] for r in scored if r.doc_id in truth) > 112  # a coin would give 80
    assert len(scored) == len(texts) and all(0 <= r.score <= 1 for r in scored)


def test_classifier_without_examples(spark):
    docs, labels = labelled(spark, [("some text", 1), ("other text", 1), ("more text", 1)])
    for d, own in ((docs, labels), (docs.limit(0), labels), (docs, labels.limit(0))):
        with pytest.raises(ValueError, match="are needed"):
            quality_classifier.fit(d, own)
    model = quality_classifier.Model(b"good words", b"bad words", (0.0,) * 7, (0.0,) * 6, (1.0,) * 6)
    assert quality_classifier.classify(docs.limit(0), model).count() == 0
    twice = docs.unionAll(docs).unionAll(docs.withColumn("doc_id", F.lit(None).cast("long")))
    scored = quality_classifier.classify(twice, model).collect()
    assert len(scored) == 9 and sum(r.doc_id is None and not r.held_out for r in scored) == 3


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    def luhn(d):
        return sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (c > "4") for k, c in enumerate(reversed(d))) % 10 == 0

    out = []
    for k, (name, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if not (name == "ip" and any(int(x) > 255 for x in m[0].split(".")) or name == "card" and not (14 <= len(d) <= 19 and luhn(d)) or name == "phone" and not 10 <= len(d) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_personal_data_base_and_added(spark):
    texts = ["", None, "a@b.c_d@e.f", "1.2.3.4.5.6.7.8 999.1.1.1 0001.002.03.0", "4111 1111 1111 1111 x 4111-1111-1111-1111-5 4111111111111111", "+1 (555) 123-4567 +1((( +12 34", "é😀 me@x.org 😀 10.0.0.1", "a" * 100_000 + "@x.y", "1" * 100_000, "1 " * 30_000, "please write to john (at) mail (dot) com or tel: (555) 123-4567 now", "79927398713 49927398716000", "x@y.org mail me@z.com phone +44 20 7946 0958"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({c: F.lit(c) for c in CLASHING})
    found = table(pii.find_personal_data(docs))
    for i, t in enumerate(texts):
        spans = base_spans(t or "")
        joined = ",".join(f"{list(BASE)[k]}:{a}:{b}" for a, k, b in spans)
        r = found[i]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in spans) for n in range(4)]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(",")) and r.n_added == len(list(filter(None, r.spans.split(",")))) - len(spans)


POSITIVE = ["please write to {n} (at) mail{i} (dot) com today", "contact: {n}[at]post{i}.org for more", "call ({a}) {b}-{c} now", "phone {a}-{b}-{c} is ours", "we have ({a}) {b}-{c} there"]
NEGATIVE = ["invoice 1234-5678-9012-{d} is due", "version {i}.400.1.2 is out", "part 0{e}-1{e}-{c} in stock", "tracking 8{d}123456781{d} left", "article 1{e}.0{e}.{c} sold", "build {d}.{i}.300.999 failed", "they saw 0{e}-0{e}-{c} there", "it says 9{d}1234567{d}"]
PLAIN = ["her mail {n}@web{i}.de", "server 12.{i}.7.9 is up", "card 4111 1111 1111 1111 paid", "see {n}@home{i}.org"]


def test_classifier_decides_what_is_added(spark, monkeypatch):
    """Planted candidates: with the classifier, nine in ten that it adds are right, and it adds nine in ten; taken out, not."""
    rng = random.Random(4)
    rows = []
    for i in range(600):
        kind = rng.randrange(3)
        fill = dict(n=rng.choice(["anna", "bob", "carla"]), i=i % 200, a=rng.randint(200, 999), b=rng.randint(200, 999), c=rng.randint(1000, 9999), d=rng.randint(1000, 9999), e=rng.randint(10, 99))
        rows.append((i, f"some words ahead. {rng.choice((POSITIVE, NEGATIVE, PLAIN)[kind]).format(**fill)} and after", kind))
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind int")

    def quality():
        found = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
        assert all(found[i].base_sha256 == hashlib.sha256(",".join(f"{list(BASE)[k]}:{a}:{b}" for a, k, b in base_spans(t)).encode()).hexdigest() for i, t, _ in rows)
        added = [kind == 0 for i, _, kind in rows if found[i].n_added]
        return sum(added) / max(1, len(added)), sum(added) / sum(kind == 0 for _, _, kind in rows)

    precision, recall = quality()
    assert precision > 0.9 and recall > 0.9
    monkeypatch.setattr(pii, "train_classifier", lambda cells: dict.fromkeys(pii.FEATURES, 1.0))
    assert quality()[0] < 0.6
    monkeypatch.setattr(pii, "train_classifier", lambda cells: dict.fromkeys(pii.FEATURES, -1.0))
    assert quality()[1] == 0


def test_expectation_maximisation_tells_reliable_labelers():
    rng = random.Random(2)
    counts = defaultdict(int)
    for _ in range(20_000):
        truth = rng.random() < 0.6
        votes = tuple(int(rng.random() < (p if truth else q)) for p, q in ((0.95, 0.05), (0.9, 0.2), (0.6, 0.4)))
        counts[votes] += 1
    for v, n in list(counts.items()):  # a labeler that doesn't vote changes nothing for the others
        counts[v[0], v[1], 2] += n
    posterior = pii.expectation_maximisation(sorted(counts.items()))
    assert posterior[1, 1, 2] > 0.9 and posterior[0, 0, 2] < 0.1
    assert posterior[1, 1, 1] > 0.95 and posterior[0, 0, 0] < 0.05 and posterior[1, 0, 1] > 0.5 > posterior[0, 1, 0]


def test_quality_rules_counts_and_verdicts(docs, rows):
    found = table(quality_rules.judge(docs))
    for i, t in rows:
        words = WORD.findall(t or "")
        windows = defaultdict(list)
        for k in range(len(words) - 2):
            windows[tuple(words[k : k + 3])].append(k)
        repeated = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(words) < 50 or 100 * len(repeated) > 50 * len(words)) and not (r.base_failed and r.kept)
    kept = {r.doc_id for r in quality_rules.apply_rules(docs).collect()}
    assert kept == {i for i, r in found.items() if r.kept}


def test_rule_order_changes_no_verdict(rows):
    texts = pa.array([t for _, t in rows])
    rules = list(quality_rules.RULES)
    plain = quality_rules.cascade(texts, tuple(rules))
    for seed in range(4):
        random.Random(seed).shuffle(rules)
        assert (quality_rules.cascade(texts, tuple(rules)) == plain).all()


def test_decontamination(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgilmnorstu") for _ in range(5))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [text(20) + " " + text(10), f"if {text(4)} sells 12 apples at 3 dollars and {text(5)} buys 12 pears for 40 km with Mary {text(8)} then 12 more", "too short", None]
    changed = items[1].replace("12", "57").replace("3 dollars", "9 euros").replace("40 km", "8 miles").replace("Mary", "Olga")
    mixed = items[1].replace("12", "57", 1)
    texts = [f"{text(50)}. {items[0].upper()} {text(50)}", f"{text(30)} {changed} {text(9)}", text(200), None, "", items[0], f"{text(40)} {items[0][:40]}", f"{text(5)} {mixed}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({c: F.lit(c) for c in CLASHING})
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, benchmark).collect()}
    assert {(0, 0), (1, 1), (5, 0)} <= found.keys() and not {d for d, _ in found} & {2, 3, 4}
    assert found[1, 1].n_changed >= 4 and found[1, 1].n_consistent == found[1, 1].n_slots
    kept = {r.doc_id for r in decontaminate.decontaminate(docs, benchmark).collect()}
    assert kept == set(range(len(texts))) - {d for d, _ in found}


REPEATING = "Tom has 3 apples and 4 pears. Anna has 5 apples and 6 pears. Ben has 7 apples and 9 pears. Mia has 8 apples and 2 pears. How many apples are there?"


def test_decontamination_aligns_repeated_templates(spark):
    items = [REPEATING, "Continue the sequence 2 4 6 8 10 12 14 16 18 20 and say which rule it follows"]
    other = REPEATING.replace("apples", "plums")
    numbers = iter("11 12 13 14 15 16 17 18".split())
    changed = re.sub("[0-9]", lambda m: next(numbers), REPEATING)
    scrambled = re.sub("[0-9]", "5", items[1].replace("10", "3").replace("12", "7")) + ". " + items[1]
    texts = [*items, f"Some words ahead of it, {items[0]} And some after it.", f"words {changed} words", other, scrambled, items[0][8:], f"{items[0][30:]} and then, later, {items[0]}"]
    docs, benchmark = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, benchmark).collect()}
    assert {(0, 0), (1, 1), (2, 0), (3, 0), (5, 1), (6, 0), (7, 0)} == found.keys()
    assert all(found[pair].n_changed == 0 and found[pair].n_consistent == found[pair].n_slots for pair in ((0, 0), (1, 1), (2, 0), (5, 1), (6, 0), (7, 0)))
    assert found[3, 0].n_changed == found[3, 0].n_consistent >= 8


def test_decontamination_ignores_case_and_wrapping(spark):
    items = ["Der alte Bauer aus Bremen kauft auf dem Markt in Köln für seine Straße 40 Km Draht, 3 Hämmer und die Leiter von Anna, bevor Otto kommt.",
             "When Mary and John met Olga in Paris, Peter sold 12 Apples to Anna and drove 40 km with Lucy, Frank and Emma to see Rome again."]
    change = [str.upper, str.lower, lambda t: t.replace(" ", "\n"), lambda t: t.replace(" ", "  "), lambda t: t.replace(" ", "\u00a0")]
    texts = [f"Before it. {f(t)} After it." for t in items for f in change]
    docs, benchmark = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, benchmark).collect()}
    assert found.keys() == {(d, d // len(change)) for d in range(len(texts))}
    assert all(r.matched_windows == r.item_windows and r.n_changed == 0 and r.n_consistent == r.n_slots for r in found.values())


def test_decontamination_short_items_and_quotes(spark):
    rng = random.Random(9)
    text = lambda n: " ".join("".join(rng.choice("abcdefgilmnorstu") for _ in range(6)) for _ in range(n))
    items = ["what is the capital of France", "how far is it from here now", "why is grass green", "5 7", text(90), ""]
    pairs = [(f"{text(n)} {item} {text(4)}", i) for i, item in enumerate(items[:4]) for n in (0, 1, 2, 3)]
    words = items[4].split()
    pairs += [(f"{text(20)} {' '.join(words[at : at + n])} {text(20)}", 4) for at, n in ((0, 13), (31, 13), (77, 13), (40, 30))]
    clean = [f"{text(20)} {' '.join(words[20:31])} {text(20)}", f"{text(9)} 6 8 {text(9)}", "why is grass", f"what is the capital {text(9)}"]
    docs = spark.createDataFrame(list(enumerate([t for t, _ in pairs] + clean)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = [(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()]
    assert sorted(found) == [(d, i) for d, (_, i) in enumerate(pairs)]


def test_leaks_equal_brute_force(spark):
    """Items of 1 to 30 words, documents with copies, other numbers and names, mixtures, variants of one item, and chance matches."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefgilmnorstu") for _ in range(rng.randint(2, 6))) for _ in range(60)]

    def word():
        return rng.choice([rng.choice(vocabulary)] * 6 + [str(rng.randint(1, 30)), f"{rng.randint(1, 99)} km", f"{rng.randint(1, 9)}.5%", rng.choice(["Mary", "Olga", "Straße", "Bremen"])])

    sentence = lambda n: " ".join(word() for _ in range(n))
    items = [(i, sentence(n)) for i, n in enumerate([*range(1, 13), 1, 2, 5, 6, 7, 8, 15, 20, 30])] + [(100, None), (101, ""), (102, "7 8"), (103, REPEATING), (104, REPEATING), (103, "another text under the same id, 3 km long")]

    def vary(t):
        t = re.sub("[0-9]+", lambda m: str(rng.randint(1, 30)) if rng.random() < 0.7 else m[0], t).replace("Mary", rng.choice(["Mary", "Olga"]))
        words = t.split(" ")
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            words[rng.randrange(len(words))] = word()
        return rng.choice([str, str.upper, str.lower])(" ".join(words))

    texts = [t for _, t in items if t]
    docs = [(0, None), (1, ""), (2, " \n "), (3, sentence(300))]
    for i in range(4, 120):
        parts = [sentence(rng.randint(0, 12))]
        for _ in range(rng.choice([1, 1, 2])):
            parts += [vary(rng.choice(texts)), sentence(rng.randint(0, 6))]
        docs.append((i, " ".join(parts)))
    docs += [(200 + i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs + docs[4:9], "doc_id long, text string").withColumns({c: F.lit(c) for c in CLASHING})
    found = decontaminate.leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = {}
    for pair in brute_leaks(docs, [(n, t) for n, (_, t) in enumerate(items)]).items():
        (d, n), figures = pair
        expected.setdefault((d, items[n][0]), []).append(figures)
    assert len(found) == len({(r.doc_id, r.item_id) for r in found}) and len(expected) > 100
    assert {(r.doc_id, r.item_id) for r in found} == expected.keys()
    assert all((r.item_windows, r.matched_windows, r.n_slots, r.n_consistent, r.n_changed) in expected[r.doc_id, r.item_id] for r in found)
    kept = {r.doc_id for r in decontaminate.decontaminate(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in expected}


def test_decontamination_of_very_long_texts(spark):
    """100,000 numbers joined by commas, a word of a megabyte, and an item behind 200,000 words."""
    item = "if he buys 3 apples and 4 pears how many pieces of fruit does he have"
    texts = [",".join(map(str, range(100_000))), "x" * 1_000_000, "ab " * 200_000 + item, " ".join(["1"] * 100_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontaminate.leaks(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(2, 5)]


EMPTY = "doc_id long, text string, lang string, source string, n_chars long"
TEXT = "some text of a document without an id"
NULLS = [(None, None, None, None, None), (None, TEXT, None, None, None), (1, TEXT, "en", "s", 3), (1, TEXT, "en", "s", 3)]
FAILED = (None, 0, 0, 0, 0, 0, True, False), *[(i, 8, 30, 0, 0, 0, True, False) for i in (None, 1, 1)]
SHA = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
#: What each operator gives for NULLS, in any order.
DEFINED = {
    token_counts.count_tokens: lambda rows: [(r.doc_id, r.n_bytes, r.n_tokens > 0, r.over_limit) for r in rows] == [(None, 0, False, False), (None, 37, True, False), (1, 37, True, False), (1, 37, True, False)],
    packing.pack_documents: lambda rows: sorted((r.doc_id is None, r.start, r.length == r.doc_tokens, r.length == 1) for r in rows) == [(False, 0, True, False)] * 2 + [(True, 0, True, False), (True, 0, True, True)],
    ngram_join.near_duplicates: lambda rows: sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in rows) == [(0, 0, 0), (0, 4, 0), (1, 4, 1), (1, 4, 1)],
    ngram_join.keep_one: lambda rows: len(rows) == 4,
    suffix_dedup.remove_repeats: lambda rows: sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256 == SHA(TEXT)) for r in rows) == [(0, 0, 0, 0, False), (0, 37, 0, 0, True), (1, 37, 0, 0, True), (1, 37, 0, 0, True)],
    line_dedup.dedup_lines: lambda rows: sorted((r.doc_id or 0, r.text or "", r.n_lines, r.n_removed) for r in rows) == [(0, "", 0, 0), (0, TEXT, 1, 0), (1, TEXT, 1, 0), (1, TEXT, 1, 0)],
    pii.find_personal_data: lambda rows: sorted((r.doc_id or 0, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans, r.n_added) for r in rows) == [(i, 0, 0, 0, 0, SHA(""), "", 0) for i in (0, 0, 1, 1)],
    quality_rules.judge: lambda rows: sorted(map(tuple, rows), key=repr) == sorted(FAILED, key=repr),
    quality_rules.apply_rules: lambda rows: rows == [],
}


@pytest.mark.parametrize("run", list(DEFINED))
def test_empty_tables_and_null_ids(spark, run):
    assert run(spark.createDataFrame([], EMPTY)).count() == 0
    rows = run(spark.createDataFrame(NULLS, EMPTY).coalesce(1)).collect()
    assert DEFINED[run](rows), rows


def test_leaks_of_null_and_repeated_rows(spark):
    items = spark.createDataFrame([(1, TEXT), (None, TEXT), (3, None)], "item_id long, text string")
    found = decontaminate.leaks(spark.createDataFrame(NULLS, EMPTY), items).collect()
    assert sorted((r.doc_id or 0, r.item_id or 0, r.item_windows, r.matched_windows) for r in found) == [(d, i, 3, 3) for d in (0, 1) for i in (0, 1)]
    kept = decontaminate.decontaminate(spark.createDataFrame(NULLS, EMPTY), items).collect()
    assert [tuple(r) for r in kept] == NULLS[:1]


def test_empty_archive_and_benchmark(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(pages).count() == 0
    docs, items = spark.createDataFrame([(1, "a b c d e f g h i")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(docs, items).count() == 0 and decontaminate.decontaminate(docs, items).count() == 1
    assert decontaminate.leaks(docs.limit(0), docs.select(F.col("doc_id").alias("item_id"), "text")).count() == 0


def test_pipeline_stages_equal_brute_force(spark):
    """Each stage on what the one before it kept: the same documents and texts, other columns as they were."""
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == [*brute_pipeline.STAGES, "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(n, r.text) for n, r in enumerate(spark.read.parquet(f"{SF}/benchmark.parquet").collect())]
    others = {r.doc_id: (r.lang, r.source, r.n_chars) for r in docs.collect()}
    before, acted = [(r.doc_id, r.text, r.source) for r in docs.collect()], {}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = storage.materialize(stage(spark, kept, SF), name)
        found = kept.collect()
        assert kept.columns == docs.columns and all((r.lang, r.source, r.n_chars) == others[r.doc_id] for r in found)
        expected = brute_pipeline.STAGES[name](before, items)
        assert len(found) == len(expected) and {r.doc_id: r.text for r in found} == expected, name
        acted[name] = expected != {i: t for i, t, _ in before}
        before = [(r.doc_id, r.text, r.source) for r in found]
    assert all(acted.values()), acted
    rows = [(i, t) for i, t, _ in before]
    pieces = corpus_pipeline.run(spark, SF).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in pieces} == {i: len(x) + 1 for i, x in encodings(rows).items()}


def test_scratch_is_cleared(spark):
    import glob

    root = storage.scratch_root(spark)
    frame = storage.materialize(spark.range(3), "cleared")
    storage.discard(frame)
    assert not glob.glob(f"{root}/spanloom-cleared-*")
