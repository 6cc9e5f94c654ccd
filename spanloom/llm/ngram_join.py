"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures, exact, as components.

A document is the set of its n-word shingles (64-bit hashes, kept sorted). Two documents link when the Jaccard
similarity of their sets is ``num``/100 or more.

1. Documents with equal sets are one class, by a 128-bit digest of the set; only one of each class goes on.
2. Sizes of linked sets differ little, so sets meet in bands of sizes. In a band, at most d shingles can differ; they
   are dealt by hash to more than d/2 blocks of three parts, so that some block has one difference at most, and two of
   its parts agree whole. The hash of two parts is a key; equal keys are only a reason to look, never a link. Each key
   group becomes a star around its first document, not pairs. Groups are combined on the map side first.
3. Components of these stars bound where links can be. Each is cut into tiles by size band (and by hash beyond that),
   so that a tile holds a bounded number of sets and shingles whatever the component's size. In a tile, bitmaps of hashed
   shingles bound each overlap from above by bit counts. What they leave connected are the components that go on.
4. These are cut into tiles again, and settled: bit counts again, then exact intersection of sorted arrays. In both
   steps pairs that are connected already are skipped: no link between components is lost, and bitmaps and arrays
   travel, never pairs.
5. Components of the links found give the result.

Shingles never leave their task but for documents in step 3; texts and sets are never collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .storage import bounded_batches, discard, join_unique, materialize, small_side
from .textbatch import Words, slices

BAND_RATIO = 1.4
#: A component is one tile up to so many shingles and sets, and a block of a larger one holds about as many.
TILE_SHINGLES, TILE_SETS = 1_000_000, 16_384
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def mix(x: np.ndarray, k: int = 0) -> np.ndarray:
    """Scramble 64-bit values; a different way for each k."""
    x = (x ^ (x >> np.uint64(32))) * ODD[k]
    x = (x ^ (x >> np.uint64(29))) * ODD[(k + 1) % 4]
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and the offsets of the texts.

    Words are cut at ASCII white space, A-Z lower-cased. Fewer than n words make one shingle; none make an empty set.
    """
    words = Words(pc.ascii_lower(pc.fill_null(texts, "")))
    own = np.array([xxhash.xxh64_intdigest(w) for w in words.distinct.to_pylist()], np.uint64)
    h = own[words.index] if len(own) else np.zeros(0, np.uint64)
    sizes = np.diff(words.offsets)
    count = np.where(sizes >= n, sizes - n + 1, np.minimum(sizes, 1))
    offsets = np.concatenate(([0], np.cumsum(count)))
    out = np.zeros(offsets[-1], np.uint64)
    owner = words.owner()
    at = np.flatnonzero(owner[n - 1 :] == owner[: len(owner) - n + 1]) if len(h) >= n else np.zeros(0, np.int64)
    rolled = np.zeros(len(at), np.uint64)
    for k in range(n):
        rolled = mix(rolled * ODD[3] + h[at + k], k % 4)
    out[offsets[owner[at]] + at - words.offsets[owner[at]]] = rolled
    for i in np.flatnonzero((sizes > 0) & (sizes < n)).tolist():
        x = np.array([sizes[i]], np.uint64)
        for w in h[words.offsets[i] : words.offsets[i + 1]]:
            x = mix(x * ODD[2] + w, 1)
        out[offsets[i]] = x[0]
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a > 1:
            out[a:b].sort()
    first = np.ones(len(out), np.bool_)
    if len(out):
        first[1:] = out[1:] != out[:-1]
        first[offsets[:-1][count > 0]] = True
    kept = np.concatenate(([0], np.cumsum(first)))
    return out[first], kept[offsets]


def wrapped_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def map_bits(size: np.ndarray) -> np.ndarray:
    """Bits of a set's map: the power of two at 4 to 8 times its size, within 64 and 16,384."""
    return 1 << np.clip(np.ceil(np.log2(4 * np.maximum(size, 1))), 6, 14).astype(np.int64)


def bitmaps(sets: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Maps of hashed shingles, one of each set. Bits are taken by the low digits of the hash, so that a map folds to a smaller one."""
    size = np.diff(offsets)
    bits = map_bits(size)
    first = np.concatenate(([0], np.cumsum(bits)))
    flags = np.zeros(first[-1], np.uint8)
    of = np.repeat(np.arange(len(size)), size)
    flags[first[of] + (sets & (bits[of] - 1).astype(np.uint64)).astype(np.int64)] = 1
    raw = np.packbits(flags, bitorder="little").tobytes()
    return [raw[a // 8 : b // 8] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def profiles(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, the digest (c1, c2) and the bitmap of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets, offsets = shingle_sets(part.column("text"), n)
                digests = [wrapped_sums(mix(sets, k), offsets).view(np.int64) for k in (0, 2)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(offsets)), *map(pa.array, digests), pa.array(bitmaps(sets, offsets), pa.binary())], ["doc_id", "n_shingles", "c1", "c2", "bits"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, c1 long, c2 long, bits binary")


def band_of(size: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(size, 1)) / np.log(BAND_RATIO) + 1e-9).astype(np.int64)


def band_shape(band: np.ndarray, num: int) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs whose smaller set is in a band: most shingles that can differ, and blocks that they are dealt to."""
    small = np.ceil(BAND_RATIO ** (band + 1) + 1e-6)
    differ = np.floor((small + np.floor(small * 100 / num)) * (100 - num) / (100 + num)).astype(np.int64)
    return differ, differ // 2 + 1 + spare(differ)


def spare(differ: np.ndarray) -> np.ndarray:
    """Blocks beyond need: as many may have an empty key before empty keys have to be written too."""
    return 1 + differ // 24


def block_keys(sets: np.ndarray, offsets: np.ndarray, num: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all texts and the number of the text that each is of."""
    sizes = np.diff(offsets)
    own = band_of(sizes)
    low = band_of(-(-sizes * num // 100))
    keys, texts = [], []
    for step in range(int(np.log(100 / num) / np.log(BAND_RATIO)) + 2):  # bands that the sizes of a linked pair can span
        band = own - step
        here = np.flatnonzero((sizes > 0) & (band >= low))
        differ, blocks = band_shape(band[here], num)
        here, blocks, band = here[differ > 0], blocks[differ > 0], band[here][differ > 0]  # else only equal sets link
        if not len(here):
            continue
        n = sizes[here]
        of = np.repeat(np.arange(len(here)), n)
        at = np.repeat(offsets[here] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        first = np.concatenate(([0], np.cumsum(3 * blocks)))
        value = mix(sets[at], 1)
        place = first[of] + (mix(sets[at], 3) % (3 * blocks[of]).astype(np.uint64)).astype(np.int64)
        sums, filled = np.zeros(first[-1], np.uint64), np.zeros(first[-1], np.int64)
        np.add.at(sums, place, value)
        np.add.at(filled, place, 1)
        sums, filled = sums.reshape(-1, 3), filled.reshape(-1, 3)
        sums, filled = sums.sum(1, keepdims=True, dtype=np.uint64) - sums, filled.sum(1, keepdims=True) - filled  # of the other two parts
        row = np.repeat(np.arange(len(here)), blocks)
        block = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        tag = (band[row] << 40) + (block << 8)
        key = mix(sums + mix((tag[:, None] + np.arange(3)).astype(np.uint64), 2), 0)
        some_empty = np.bincount(row, (filled == 0).any(1), len(here))
        write = (filled > 0) | (some_empty > spare(band_shape(band, num)[0]))[row][:, None]
        keys.append(key[write])
        texts.append(here[np.broadcast_to(row[:, None], key.shape)[write]])
    return (np.concatenate(keys), np.concatenate(texts)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def pairs_batch(key: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(a), pa.array(b)], ["key", "a", "b"])


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), np.bool_)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def stars(docs: DataFrame, n: int, num: int) -> DataFrame:
    """Pairs (a, b) of documents with a common key: each key's first document with each other one."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keys (a = b), but for keys that an earlier document of the batch has: these are pairs at once."""
        for batch in batches:
            for part in slices(batch):
                sets, offsets = shingle_sets(part.column("text"), n)
                key, text = block_keys(sets, offsets, num)
                doc = part.column("doc_id").to_numpy(zero_copy_only=False)[text]
                key, first, group = np.unique(key, return_index=True, return_inverse=True)
                head = doc[first]
                by_doc = np.argsort(first)  # runs of equal ids shrink the shuffle
                yield pairs_batch(key[by_doc], head[by_doc], head[by_doc])
                a, b = distinct_pairs(head[group], doc)
                a, b = a[a != b], b[a != b]
                yield pairs_batch(mix(b.view(np.uint64)), a, b)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; the first document of a key is carried over from batch to batch."""
        key, head = None, None
        for batch in batches:
            k, a, b = (batch.column(i).to_numpy() for i in range(3))
            ready = a != b
            yield pa.RecordBatch.from_arrays([pa.array(a[ready]), pa.array(b[ready])], ["a", "b"])
            k, a = k[~ready], a[~ready]
            if not len(k):
                continue
            start = np.ones(len(k), np.bool_)
            start[1:] = k[1:] != k[:-1]
            heads = a[np.maximum.accumulate(np.where(start, np.arange(len(k)), 0))]
            if k[0] == key:
                heads[: int(np.argmax(start[1:])) + 1 if start[1:].any() else len(k)] = head
            key, head = k[-1], heads[-1]
            x, y = distinct_pairs(heads, a)
            yield pa.RecordBatch.from_arrays([pa.array(x[x != y]), pa.array(y[x != y])], ["a", "b"])

    rows = docs.mapInArrow(write, "key long, a long, b long")
    return rows.repartition("key").sortWithinPartitions("key", "a").mapInArrow(meet, "a long, b long").distinct()


def tile_pairs(size: np.ndarray, blocks: np.ndarray, root: np.ndarray, num: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of sets in the order of their sizes: each with the later ones that could link to it and are not connected to it
    yet, and the overlaps that links would take. In a tile of two blocks, only sets of different blocks meet."""
    crossing = len(np.unique(blocks)) > 1
    for i in range(len(size)):
        js = np.arange(i + 1, int(np.searchsorted(size, size[i] * 100 // num, side="right")))
        js = js[root[js] != root[i]]
        if crossing:
            js = js[blocks[js] != blocks[i]]
        if len(js):
            yield i, js, -(-num * (size[i] + size[js]) // (100 + num))


def connect(root: np.ndarray, i: int, j: int) -> None:
    root[root == root[j]] = root[i]


def overlap_bound(size: np.ndarray, raw: list[bytes]):
    """From the maps of sets in the order of their sizes: a function of i and js that bounds their overlaps from above.

    A bit of one map that the other lacks is a shingle at least that the other set lacks. Partners have maps of the
    same width, or of twice as much, which are folded.
    """
    maps = [np.frombuffer(m, np.uint64) for m in raw]
    width = np.array([len(m) for m in maps])
    tables, place = {}, {}
    for w in np.unique(width).tolist():
        rows = np.flatnonzero((width == w) | (width == 2 * w))
        tables[w] = np.stack([maps[r] if width[r] == w else maps[r][:w] | maps[r][w:] for r in rows.tolist()])
        place[w] = np.full(len(size), -1)
        place[w][rows] = np.arange(len(rows))

    def bound(i: int, js: np.ndarray) -> np.ndarray:
        w = int(width[i])
        own, others = tables[w][place[w][i]], tables[w][place[w][js]]
        lacking = [np.bitwise_count(x).sum(1, dtype=np.int64) for x in (own & ~others, others & ~own)]
        return np.minimum(size[i] - lacking[0], size[js] - lacking[1])

    return bound


def sift_tile(ids: np.ndarray, size: np.ndarray, blocks: np.ndarray, maps: list[bytes], num: int) -> list[tuple[int, int]]:
    """Pairs that connect what bit counts can't keep apart."""
    order = np.argsort(size, kind="stable")
    size, ids, blocks = size[order], ids[order], blocks[order]
    bound = overlap_bound(size, [maps[i] for i in order.tolist()])
    root = np.arange(len(size))
    out = []
    for i, js, need in tile_pairs(size, blocks, root, num):
        for j in js[bound(i, js) >= need].tolist():
            if root[i] != root[j]:
                out.append((int(ids[i]), int(ids[j])))
                connect(root, i, j)
    return out


def settle_tile(ids: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], num: int) -> list[tuple[int, int]]:
    """Links that connect what is linked: bit counts first, then exact intersection."""
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    size, ids, blocks, sets = size[order], ids[order], blocks[order], [sets[i] for i in order.tolist()]
    bound = overlap_bound(size, bitmaps(np.concatenate(sets), np.concatenate(([0], np.cumsum(size)))))
    root = np.arange(len(sets))
    links = []
    for i, js, need in tile_pairs(size, blocks, root, num):
        may = bound(i, js) >= need
        for j, least in zip(js[may].tolist(), need[may].tolist()):
            if root[i] == root[j]:
                continue
            at = np.searchsorted(sets[j], sets[i])
            at[at == len(sets[j])] = 0
            if int((sets[j][at] == sets[i]).sum()) >= least:
                links.append((int(ids[i]), int(ids[j])))
                connect(root, i, j)
    return links


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows with equal keys together, of batches that come sorted by key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        k = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            if held and held[-1].column(key)[0].as_py() != k[lo]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def tiles(nodes: DataFrame, num: int, shingles: int = TILE_SHINGLES, sets: int = TILE_SETS) -> DataFrame:
    """Tiles that each node is compared in: rows (node, tile, block), from nodes (node, n_shingles, root).

    A component of at most so many ``shingles`` and ``sets`` is one tile. A larger one is cut into blocks of a size
    band (of the width of the similarity) and, beyond the same bounds in a band, by hash; blocks of equal or
    neighbouring bands meet in a tile each.
    """
    total = materialize(nodes.groupBy("root").agg(F.sum("n_shingles").alias("all"), F.count("*").alias("members"), F.count("*").alias("n")), "tile-totals")
    summed = join_unique(nodes, total, ["root"], "n").where("members > 1")
    fits = (F.col("all") <= shingles) & (F.col("members") <= sets)
    small = summed.where(fits).select("node", F.xxhash64("root").alias("tile"), F.lit(0).cast("long").alias("block"))
    if total.where(~fits).isEmpty():
        return small
    large = summed.where(~fits).withColumn("band", F.floor(F.log("n_shingles") / F.log(F.lit(100 / num))))
    pieces = F.ceil(F.greatest(F.sum("n_shingles") / shingles, F.count("*") / sets)).cast("int")
    cuts = materialize(large.groupBy("root", "band").agg(pieces.alias("cuts"), F.count("*").alias("n")), "tile-cuts")
    block = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    here, there = cuts.select("root", "band", block.alias("cut")), cuts.select("root", F.col("band").alias("band2"), block.alias("cut2"))
    near = there.withColumn("band", F.explode(F.array(F.col("band2"), F.col("band2") - 1)))
    meet = here.join(near, ["root", "band"]).where((F.col("band") < F.col("band2")) | (F.col("cut") <= F.col("cut2")))
    meet = meet.withColumn("tile", F.xxhash64("root", "band", "cut", "band2", "cut2"))
    sides = meet.select("root", "band", "cut", "tile").union(meet.select("root", "band2", "cut2", "tile")).distinct()
    placed = join_unique(large, cuts, ["root", "band"], "n").withColumn("cut", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    of_large = placed.join(sides, ["root", "band", "cut"]).select("node", "tile", F.xxhash64("band", "cut").alias("block"))
    return of_large.union(small)


def in_tiles(rows: DataFrame, answer) -> DataFrame:
    """Pairs (a, b) that ``answer`` finds in each tile; tiles are streamed, one held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in runs(batches, "tile"):
            if tile.num_rows > 1:
                found = answer(tile)
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return rows.repartition("tile").sortWithinPartitions("tile", "doc_id").mapInArrow(run, "a long, b long")


def sift(profile: DataFrame, placed: DataFrame, num: int) -> DataFrame:
    """Pairs (a, b) of the tiles of ``placed`` that bitmaps leave connected."""

    def answer(tile: pa.Table) -> list[tuple[int, int]]:
        ids, size, blocks = (tile.column(c).to_numpy() for c in ("doc_id", "n_shingles", "block"))
        return sift_tile(ids, size, blocks, tile.column("bits").to_pylist(), num)

    return in_tiles(placed.join(profile.select("doc_id", "n_shingles", "bits"), F.col("node") == F.col("doc_id")).select("tile", "block", "doc_id", "n_shingles", "bits"), answer)


def settle(docs: DataFrame, placed: DataFrame, n: int, num: int) -> DataFrame:
    """Links (a, b) found in the tiles of ``placed``."""
    places = placed.groupBy("node").agg(F.collect_list(F.struct("tile", "block")).alias("places"))
    texts = docs.join(small_side(materialize(places, "tile-places")), docs["doc_id"] == F.col("node")).select("doc_id", "text", "places")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets, offsets = shingle_sets(part.column("text"), n)
                raw = sets.tobytes()
                packed = [raw[8 * a : 8 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(packed, pa.binary()), part.column("places")], ["doc_id", "shingles", "places"])

    def answer(tile: pa.Table) -> list[tuple[int, int]]:
        sets = [np.frombuffer(b, np.uint64) for b in tile.column("shingles").to_pylist()]
        return settle_tile(tile.column("doc_id").to_numpy(), tile.column("block").to_numpy(), sets, num)

    sets = texts.mapInArrow(sets_of, "doc_id long, shingles binary, places array<struct<tile:long,block:long>>")
    return in_tiles(sets.select("doc_id", "shingles", F.inline("places")).select("tile", "block", "doc_id", "shingles"), answer)


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles (size of its set), component_id (least doc_id linked to it, itself included).

    Documents link at a Jaccard similarity of ``num`` percent (1 to 100) of their n-word shingles. Null, empty and
    blank texts have no shingle and link with nothing; a null doc_id has a null component and links nothing. Rows with
    equal doc_id are one document that links as any of them does. Other columns are ignored.
    """
    if not 1 <= num <= 100:
        raise ValueError("num is a percentage, 1 to 100")
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long"), "text")
    known = rows.where("doc_id is not null")
    profile = materialize(profiles(rows, n), "shingle-profiles")
    full = profile.where("doc_id is not null and n_shingles > 0").select("doc_id", "n_shingles", "c1", "c2")
    same = ["c1", "c2", "n_shingles"]
    classes = materialize(full.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "set-classes")
    member = materialize(join_unique(full, classes, same, "n").select("doc_id", "n_shingles", "rep").distinct(), "set-members")
    discard(classes)
    copies = member.where("doc_id <> rep").select("rep", "doc_id")
    heads = member.where("doc_id = rep").select(F.col("doc_id").alias("node"), "n_shingles")

    def place(pairs: DataFrame, name: str) -> DataFrame:
        return tiles(materialize(connected_components(pairs).join(heads, "node"), name), num)

    candidates = place(stars(known, n, num).union(copies), "candidates")
    sifted = place(sift(profile, candidates, num), "sifted")
    linked = connected_components(settle(known, sifted, n, num).union(copies))
    done = profile.join(linked, profile["doc_id"] == linked["node"], "left")
    return done.select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80) -> DataFrame:
    """``docs``, all columns, with one document of each group of near duplicates: that with the least doc_id."""
    groups = near_duplicates(docs, n, num)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(small_side(materialize(gone, "near-copies")), "doc_id", "left_anti").select(*docs.columns)
