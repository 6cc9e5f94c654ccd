"""Repeated byte strings across documents, by bucket-pointer refinement over sampled suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller doc_id.

1. Suffixes are sampled where content says so: of every run of w = length - q + 1 q-grams, the one with the least hash
   (all of them, on ties). Equal strings of ``length`` bytes hold the same sampled q-gram at the same place, so looking
   at samples loses no repeat. About two in w positions are sampled.
2. The q-gram is the initial bucket. A second hash, of all bytes that strings through the sample can reach, settles most
   samples: if a smaller document has a sample with the same hash, every string through it repeats. Copies within a batch are
   settled there, before the shuffle, so that a hot bucket arrives as one row per batch.
3. Samples in buckets of several contexts fetch their context bytes, and their buckets are refined by sorting on the
   bucket identifiers of later offsets, doubling: 10-gram identifiers give 20-grams, these 40-grams, these and the
   first 50-grams. Identifiers are of bytes, not of hashes. A string repeats if its final bucket has a smaller document.
   A bucket of many contexts (a line on very many pages, each time with other bytes around it) is not refined in one
   task: its strings are dealt by 95 bits of their own hash, and copies within a batch settled before that shuffle too.
4. Starts of repeating strings are gathered per document, and the bytes under them removed.

Samples and contexts go through shuffles sorted by bucket and are read as streams: no bucket is held whole but for the rows that
still bring a string of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ngram_join import mix
from .storage import bounded_batches, left_join_unique, materialize, small_side, uses
from .textbatch import byte_view, slices

LENGTH, GRAM = 50, 20
WINDOW = LENGTH - GRAM + 1
BEFORE, CONTEXT = WINDOW - 1, WINDOW - 1 + LENGTH
INTERVALS = "key long, doc_id long, lo long, hi long"
#: A bucket of more contexts is dealt by its strings.
SPLIT = 4_096
#: Places are 32 bits; above them stands which text of its doc_id a place is in.
PLACE = (1 << 32) - 1
#: Marks, in place of where a context begins, of a string of a dealt bucket and of a settled range.
STRING, READY = -1, -2


def words_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as one number; data must have 7 bytes to spare."""
    return np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1)).copy().view(np.uint64).ravel()


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest of each ``width`` consecutive values, by doubling."""
    k = 1
    while 2 * k <= width:
        x = pick(x[:-k], x[k:])
        k *= 2
    return pick(x[: len(x) - (width - k)], x[width - k :]) if width > k else x


def padded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts with CONTEXT zeros before, between and after; start and size of each text."""
    data, offsets = byte_view(texts)
    size = np.diff(offsets)
    start = offsets[:-1] + CONTEXT * np.arange(1, len(size) + 1)
    out = np.zeros(len(data) + CONTEXT * (len(size) + 1) + 8, np.uint8)
    out[np.repeat(start - offsets[:-1], size) + np.arange(len(data))] = data
    return out, start, size


def samples(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all samples: text, position, bucket of the q-gram and hash of the context."""
    data, start, size = padded(texts)
    long = size >= LENGTH
    w = words_at(data)
    n = len(data) - 7 - GRAM + 4
    h = mix(mix(w[:n], 0) + mix(w[8 : 8 + n], 1) + mix(w[12 : 12 + n], 2), 3)
    top = np.uint64(2**64 - 1)
    inside = np.zeros(n + 1, np.int8)
    np.add.at(inside, start[long], 1)
    np.add.at(inside, (start + size - GRAM + 1)[long], -1)
    h = np.where(np.cumsum(inside[:-1]) > 0, np.minimum(h, top - np.uint64(1)), top)  # grams that leave their text never win
    least = sliding(h, WINDOW, np.minimum)
    edge = np.zeros(WINDOW - 1, np.uint64)
    best = sliding(np.concatenate((edge, np.where(least == top, 0, least), edge)), WINDOW, np.maximum)
    at = np.flatnonzero((best == h) & (h != top))
    text = np.searchsorted(start, at, side="right") - 1
    c = np.full(len(at), 1, np.uint64)
    for k in range(0, CONTEXT, 8):
        c = mix(c * np.uint64(0x9E3779B97F4A7C15) + w[at - BEFORE + k], k // 8 % 4)
    position = at - start[text]
    ends = np.minimum(size[text] - position, LENGTH) * (BEFORE + 1) + np.minimum(position, BEFORE)  # where the text cuts the context
    return text, position, h[at] >> np.uint64(16), mix(c + ends.astype(np.uint64), 1)


def joined(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of starts, those of a document that touch made one; given in the order of documents and places."""
    if not len(doc):
        return doc, lo, hi
    new = np.ones(len(doc), np.bool_)
    new[1:] = (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1] + 1) | (lo[1:] < lo[:-1])  # two rows may have one doc_id
    first = np.flatnonzero(new)
    return doc[first], lo[first], np.maximum.reduceat(hi, first)


def since_start(at: np.ndarray, back: int) -> np.ndarray:
    """Places ``back`` bytes before, but not before their texts."""
    return np.maximum(at & ~np.int64(PLACE), at - back)


def numbered(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, text); where ids are repeated, with ``turn``, which tells different texts of one doc_id apart.

    Repeated ids cost the texts one more writing; else only ids are shuffled, and no row carries a number.
    """
    zero = F.lit(0).cast("long")
    again = materialize(rows.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1"), "ids")
    if not uses(again, "n")[0]:
        return rows
    marked = left_join_unique(rows, again.withColumn("more", F.lit(True)), ["doc_id"], "n")
    marked = materialize(marked.select("doc_id", "text", F.when(F.col("more"), F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest")), "texts")
    texts = marked.where("digest is not null").groupBy("doc_id", "digest").agg(F.count("*").alias("n"))
    texts = materialize(texts.withColumn("at", F.monotonically_increasing_id()), "turns")
    parts = sorted((r["part"], r["n"]) for r in texts.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n")).collect())  # a row a partition
    begin = np.cumsum([1, *(n for _, n in parts)])
    if begin[-1] >= 1 << 31:
        raise ValueError("more than 2^31 different texts stand under repeated ids")
    offsets = rows.sparkSession.createDataFrame([(p, int(b)) for (p, _), b in zip(parts, begin)], "part long, begin long")
    turns = texts.join(F.broadcast(offsets), F.shiftright("at", 33) == F.col("part"))
    turns = materialize(turns.select("doc_id", "digest", "n", (F.col("begin") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("turn")), "turns")
    return left_join_unique(marked, turns, ["doc_id", "digest"], "n").select("doc_id", "text", F.coalesce("turn", zero).alias("turn"))


def turns_of(part: pa.RecordBatch) -> np.ndarray:
    return part.column("turn").to_numpy(zero_copy_only=False) if "turn" in part.schema.names else np.zeros(part.num_rows, np.int64)


def row_of(docs: DataFrame) -> list[Column]:
    """What a place's row is found by: its doc_id, and its number if rows have one."""
    return [F.col("doc_id"), *([F.shiftright("lo", 32).alias("turn")] if "turn" in docs.columns else [])]


def row_names(docs: DataFrame) -> list[str]:
    return [c for c in ("doc_id", "turn") if c in docs.columns]


def emit(key, doc, a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (key, doc, a, b)], ["key", "doc_id", "lo", "hi"])


def sample_rows(docs: DataFrame) -> DataFrame:
    """Samples as (key = bucket, doc_id, lo = position, hi = context hash); what the batch settles as (key, doc_id,
    lo = -1 - first start, hi = last start)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for part in slices(batch, max_bytes=2 << 20):
                text, position, bucket, context = samples(part.column("text"))
                position += turns_of(part)[text] << 32
                parts.append((part.column("doc_id").to_numpy(zero_copy_only=False)[text], position, bucket.view(np.int64), context.view(np.int64)))
            if not parts:
                continue
            doc, position, bucket, context = map(np.concatenate, zip(*parts))
            order = np.lexsort((doc, context))
            new = np.ones(len(order), np.bool_)
            new[1:] = context[order][1:] != context[order][:-1]
            head = np.empty(len(order), np.int64)
            head[order] = doc[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
            settled = doc > head
            yield emit(bucket[~settled], doc[~settled], position[~settled], context[~settled])
            d, lo, hi = joined(doc[settled], since_start(position[settled], BEFORE), position[settled])
            yield emit(mix(d.view(np.uint64)).view(np.int64), d, -1 - lo, hi)

    return docs.mapInArrow(run, INTERVALS)


def settle_contexts(rows: DataFrame, split: int) -> DataFrame:
    """From samples sorted by bucket, context, document: ranges of repeating starts (key null), samples to refine, and
    buckets of more than ``split`` contexts (key and doc_id null, lo = bucket, perhaps several times).

    Samples to refine are, in buckets of several contexts, the ones of each context's first document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_context = head = None
        contexts = 0  # of the bucket that the last batch ended in
        pending: list[tuple[np.ndarray, ...]] = []  # its samples to refine, if another context comes
        for batch in batches:
            key, doc, lo, hi = (batch.column(i).to_numpy() for i in range(4))
            ready = lo < 0
            yield emit(pa.nulls(int(ready.sum()), pa.int64()), doc[ready], -1 - lo[ready], hi[ready])
            key, doc, at, context = (x[~ready] for x in (key, doc, lo, hi))
            if not len(key):
                continue
            new_key = np.concatenate(([key[0] != last_key], key[1:] != key[:-1]))
            new = new_key | np.concatenate(([context[0] != last_context], context[1:] != context[:-1]))
            index = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            heads = np.where(index >= 0, doc[np.maximum(index, 0)], head if head is not None else 0)
            repeat = doc > heads
            yield emit(pa.nulls(int(repeat.sum()), pa.int64()), doc[repeat], since_start(at[repeat], BEFORE), at[repeat])
            bucket = np.cumsum(new_key) - (0 if not new_key[0] else 1)
            kinds = np.bincount(bucket, new).astype(np.int64)
            if new_key[0]:
                pending = []
            else:
                kinds[0] += contexts
            large = key[np.searchsorted(bucket, np.flatnonzero(kinds > split))]
            none = pa.nulls(len(large), pa.int64())
            yield emit(none, none, large, none)
            own = np.flatnonzero(~repeat)
            if pending and kinds[0] > 1:
                yield from (emit(*p) for p in pending)
                pending = []
            many = kinds[bucket[own]] > 1
            x = own[many]
            yield emit(key[x], doc[x], at[x], np.zeros(len(x), np.int64))
            if bucket[-1] > 0:
                pending = []
            if kinds[-1] == 1:
                x = own[bucket[own] == bucket[-1]]
                pending.append((key[x], doc[x], at[x], np.zeros(len(x), np.int64)))
            last_key, last_context, head, contexts = key[-1], context[-1], heads[-1], int(kinds[-1])

    return rows.repartition("key").sortWithinPartitions("key", "hi", "doc_id", "lo").mapInArrow(run, INTERVALS)


def fetched(key, doc, at, since, until, raw=None) -> pa.RecordBatch:
    columns = [*(pa.array(x, pa.int64()) for x in (key, doc, at)), *(pa.array(x, pa.int32()) for x in (since, until))]
    return pa.RecordBatch.from_arrays([*columns, pa.nulls(len(doc), pa.binary()) if raw is None else raw], ["key", "doc_id", "at", "since", "until", "bytes"])


def dealt_strings(data: np.ndarray, first: np.ndarray, since: np.ndarray, until: np.ndarray, doc: np.ndarray, base: np.ndarray, turn: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of contexts at ``first`` (documents ``doc``, whose texts of number ``turn`` begin at ``base``): each string once, by its hash (key,
    and until = 31 bits more), but for those that a smaller document here has, whose starts come as settled ranges."""
    starts = np.arange(WINDOW)
    valid = (starts >= since[:, None]) & (starts + LENGTH <= until[:, None])
    place, where = np.unique((first[:, None] + starts)[valid], return_index=True)
    row = np.nonzero(valid)[0][where]
    doc, position = doc[row], (place - base[row]) + (turn[row] << 32)
    strings = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[place]
    one, two = np.full(len(place), 1, np.uint64), np.full(len(place), 2, np.uint64)
    for i, k in enumerate((*range(0, LENGTH - 8, 8), LENGTH - 8)):
        word = strings[:, k : k + 8].copy().view(np.uint64).ravel()
        one, two = mix(one * np.uint64(0x9E3779B97F4A7C15) + word, i % 4), mix(two * np.uint64(0xC2B2AE3D27D4EB4F) + word, (i + 1) % 4)
    key, tag = one.view(np.int64), (two >> np.uint64(33)).astype(np.int32)
    order = np.lexsort((doc, tag, key))
    new = np.ones(len(order), np.bool_)
    new[1:] = (key[order][1:] != key[order][:-1]) | (tag[order][1:] != tag[order][:-1])
    head = np.empty(len(order), np.int64)
    head[order] = doc[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    settled = doc > head
    yield fetched(key[~settled], doc[~settled], position[~settled], np.full(int((~settled).sum()), STRING), tag[~settled])
    d, lo, hi = joined(doc[settled], position[settled], position[settled])
    yield fetched(mix(d.view(np.uint64)).view(np.int64), d, lo, np.full(len(d), READY), hi - lo)


def fetch_contexts(docs: DataFrame, wanted: DataFrame, large: DataFrame) -> DataFrame:
    """Context bytes of the wanted samples: key, doc_id, at, and how much of the context the text has, from and to.

    Samples in ``large`` buckets give their strings instead (since = STRING), and ranges (since = READY: starts at to at + until).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, start, size = padded(part.column("text"))
                lists = part.column("places")
                places = lists.flatten()
                key, at, dealt = (places.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                text = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy())
                doc, turn = part.column("doc_id").to_numpy()[text], turns_of(part)[text]
                first = start[text] + at - BEFORE
                since = np.maximum(0, BEFORE - at)
                until = np.minimum(CONTEXT, BEFORE + size[text] - at)
                whole = np.flatnonzero(~dealt)
                bytes_at = np.lib.stride_tricks.sliding_window_view(data, CONTEXT)[first[whole]]
                raw = pa.Array.from_buffers(pa.binary(CONTEXT), len(whole), [None, pa.py_buffer(np.ascontiguousarray(bytes_at))]).cast(pa.binary())
                yield fetched(key[whole], doc[whole], at[whole] + (turn[whole] << 32), since[whole], until[whole], raw)
                if dealt.any():
                    yield from dealt_strings(data, *(x[dealt] for x in (first, since, until, doc, start[text], turn)))

    marked = wanted.join(small_side(large), wanted["key"] == large["large"], "left")
    place = F.struct("key", F.col("lo").bitwiseAND(PLACE).alias("at"), F.col("large").isNotNull().alias("dealt"))
    places = marked.groupBy(*row_of(docs)).agg(F.collect_list(place).alias("places"))
    joined_rows = docs.join(places, row_names(docs)).select(*row_names(docs), "text", "places")
    return joined_rows.mapInArrow(run, "key long, doc_id long, at long, since int, until int, bytes binary")


def pair_buckets(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifiers of pairs of identifiers, by sorting."""
    return np.unique(a.astype(np.int64) * (int(b.max()) + 1) + b, return_inverse=True)[1].reshape(a.shape)


def string_buckets(context: np.ndarray) -> np.ndarray:
    """Bucket of the LENGTH bytes from each of the WINDOW places on, of each row of context bytes."""
    n, m = len(context), CONTEXT - 9
    eight = np.lib.stride_tricks.sliding_window_view(context, 8, axis=1)[:, :m].copy().view(np.uint64).reshape(n, m)
    two = context[:, 8 : 8 + m].astype(np.int64) * 256 + context[:, 9 : 9 + m]
    ten = pair_buckets(np.unique(eight, return_inverse=True)[1].reshape(n, m), two)
    twenty = pair_buckets(ten[:, :-10], ten[:, 10:])
    forty = pair_buckets(twenty[:, :-20][:, :WINDOW], twenty[:, 20:][:, :WINDOW])
    return pair_buckets(forty, ten[:, 40 : 40 + WINDOW])


def refine(doc: np.ndarray, since: np.ndarray, until: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Which strings of each row (one for each of WINDOW starts) repeat one of a smaller document."""
    bucket = string_buckets(context)
    starts = np.arange(WINDOW)
    valid = (starts >= since[:, None]) & (starts + LENGTH <= until[:, None])
    least = np.full(int(bucket.max()) + 1, np.iinfo(np.int64).max)
    docs = np.broadcast_to(doc[:, None], bucket.shape)
    np.minimum.at(least, bucket[valid], docs[valid])
    return valid & (least[bucket] < doc[:, None])


def refine_buckets(contexts: DataFrame, rows_at_once: int = 20_000) -> DataFrame:
    """Ranges of repeating starts, from contexts sorted by bucket and document, and dealt strings by hash and document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        own = 0  # rows held that are answered already, and only serve as sources
        string, head = None, 0  # hash of the last string, and its first document

        def settle(rows: tuple[np.ndarray, ...], answered: int) -> tuple[pa.RecordBatch, np.ndarray]:
            key, doc, at, since, until, context = rows
            repeat = refine(doc, since, until, context)
            flags = np.zeros((len(doc), WINDOW + 2), np.int8)
            flags[:, 1:-1] = repeat
            flags[:answered] = 0
            turn = np.diff(flags, axis=1)
            row, lo = np.nonzero(turn == 1)
            hi = np.nonzero(turn == -1)[1] - 1
            first = at[row] - BEFORE
            starts = np.arange(WINDOW)
            brings = ((starts >= since[:, None]) & (starts + LENGTH <= until[:, None]) & ~repeat).any(1)
            return emit(pa.nulls(len(row), pa.int64()), doc[row], first + lo, first + hi), brings

        for batch in batches:
            key, doc, at, since, until = (batch.column(c).to_numpy() for c in ("key", "doc_id", "at", "since", "until"))
            ready = since == READY
            yield emit(pa.nulls(int(ready.sum()), pa.int64()), doc[ready], at[ready], at[ready] + until[ready])
            if (since == STRING).any():
                k, d, start, tag = (x[since == STRING] for x in (key, doc, at, until))
                new = np.concatenate(([(k[0], tag[0]) != string], (k[1:] != k[:-1]) | (tag[1:] != tag[:-1])))
                index = np.maximum.accumulate(np.where(new, np.arange(len(k)), -1))
                heads = np.where(index >= 0, d[np.maximum(index, 0)], head)
                yield emit(pa.nulls(int((d > heads).sum()), pa.int64()), d[d > heads], start[d > heads], start[d > heads])
                string, head = (k[-1], tag[-1]), heads[-1]
            batch = batch.filter(pa.array(since >= 0))
            for i in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(i, rows_at_once)
                columns = [part.column(c).to_numpy() for c in ("key", "doc_id", "at", "since", "until")]
                raw = b"".join(part.column("bytes").to_pylist())
                held.append((*columns, np.frombuffer(raw, np.uint8).reshape(-1, CONTEXT)))
                if sum(len(h[0]) for h in held) - own < rows_at_once:
                    continue
                rows = tuple(map(np.concatenate, zip(*held)))
                out, brings = settle(rows, own)
                yield out
                kept = brings & (rows[0] == rows[0][-1])  # the last bucket may go on
                held, own = [tuple(x[kept] for x in rows)], int(kept.sum())
        if sum(len(h[0]) for h in held) > own:
            yield settle(tuple(map(np.concatenate, zip(*held))), own)[0]

    tag = F.when(F.col("since") == STRING, F.col("until"))
    return contexts.repartition("key").sortWithinPartitions("key", tag, "doc_id", "at").mapInArrow(run, INTERVALS)


def cut(docs: DataFrame, ranges: DataFrame, keep_text: bool) -> DataFrame:
    """Remove the bytes under strings that start in the ranges of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, offsets = byte_view(part.column("text"))
                lists = part.column("ranges")
                of = np.repeat(np.arange(part.num_rows), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
                places = lists.flatten()
                lo, hi = (places.field(i).to_numpy() for i in (0, 1))
                end = np.minimum(hi + LENGTH, np.diff(offsets)[of]) + offsets[of]
                turn = np.zeros(len(data) + 1, np.int32)
                np.add.at(turn, lo + offsets[of], 1)
                np.add.at(turn, end, -1)
                gone = np.cumsum(turn[:-1]) > 0
                n, removed, spans, digests, texts = np.diff(offsets), [], [], [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    g = gone[a:b]
                    kept = data[a:b][~g].tobytes()
                    removed.append(int(g.sum()))
                    spans.append(int((g[1:] & ~g[:-1]).sum() + g[:1].sum()))
                    digests.append(hashlib.sha256(kept).hexdigest())
                    texts.append(kept)
                out = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests)]
                yield pa.RecordBatch.from_arrays([*out, *([pa.array(texts, pa.binary())] * keep_text)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * keep_text])

    place = F.struct(*(F.col(c).bitwiseAND(PLACE).alias(c) for c in ("lo", "hi")))
    per_doc = ranges.groupBy(*row_of(docs)).agg(F.collect_list(place).alias("ranges"))
    rows = docs.join(per_doc, row_names(docs), "left").select("doc_id", "text", F.coalesce("ranges", F.array().cast("array<struct<lo:bigint,hi:bigint>>")).alias("ranges"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text)


def remove_repeats(docs: DataFrame, keep_text: bool = False, split: int = SPLIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with ``keep_text`` the bytes left, too.

    Texts are UTF-8 bytes; what is left may cut a character. Null and empty texts have 0 bytes. Strings are judged on
    the input. Rows with equal doc_id are one document with several texts: none removes from another, and each is cut at its own
    places. A row without doc_id keeps its bytes and removes none elsewhere. Other columns are ignored. Buckets of more
    than ``split`` contexts are dealt by their strings, which changes no result.
    """
    rows = numbered(bounded_batches(docs).select(F.col("doc_id").cast("long"), "text"))
    known = rows.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    first = materialize(settle_contexts(sample_rows(known), split), "repeats")
    large = first.where("key is null and doc_id is null").select(F.col("lo").alias("large")).distinct()
    more = refine_buckets(fetch_contexts(known, first.where("key is not null"), large))
    ranges = first.where("key is null and doc_id is not null").select("doc_id", "lo", "hi").union(more.select("doc_id", "lo", "hi"))
    return cut(rows, ranges, keep_text)
