"""Near duplicates among embeddings of one label, found by an inverted multi-index.

Vectors are scaled to length 1 and cut into halves, each with a codebook of its own; the two codes name a cell of the
product grid. A vector at a cosine of at least the threshold is at most sqrt(2 - 2 threshold) away, so its half lies at most
that far beyond the border between two codes' regions. How far beyond the borders of its own codes the pairs at exactly the
threshold lie is measured on a sample: ``reach`` is the squared distance, of both halves, that ``target_recall`` of them keep.
The traversal visits the cells in the order of their borders' distances, half by half, until ``reach`` is spent. Each pair is
met once: a vector visits cells before its own only. What meets is compared by cosine in double precision.

Equal vectors of a label are one class with a count, so copies never meet. Large cells are dealt in blocks of ``BLOCK``
vectors, whose tiles count links by one matrix product each; a tile sends on one row a linked vector (its links, and the
least vector of its component in the tile), never pairs.

Vectors that are null, zero, or hold null or numbers that are not finite, and those without label, link with nothing; so do
vectors of different length. A row of its own class is its own component. Rows with one id are rows of their own; a null id is
the least of its component only where there is no other. An empty table gives no rows. Columns that are named as results
are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .storage import join_unique, left_join_unique, materialize, small_side, uses
from .textbatch import give_back_memory
from .vectors import is_finite, matrix

#: Codebooks are fitted on at most this many vectors, taken by hash; there are at most MAX_CODES codes a half.
FIT_ROWS, MAX_CODES = 32_768, 1_024
#: A cell of the grid is meant to hold about this many vectors.
CELL_ROWS = 512
#: Most vectors on either side of a tile.
BLOCK = 1_024
RESULTS = ("n_links", "component_id", "kept")


def unit(v: np.ndarray) -> np.ndarray:
    """Rows at length 1, whatever their size."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


@dataclass(frozen=True)
class Codebook:
    """Centroids of one half, and the distances between them."""

    centres: np.ndarray
    apart: np.ndarray

    def borders(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's own code, and the squared distance to the border of every other code's region."""
        far = squared_distances(x, self.centres)
        own = far.argmin(axis=1)
        gap = (far - far[np.arange(len(x)), own][:, None]) / (2 * self.apart[own])
        return own, gap * gap


@dataclass(frozen=True)
class MultiIndex:
    """Two codebooks and how far a traversal reaches, for vectors of one length."""

    halves: tuple[Codebook, Codebook]
    reach: float

    def cells(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own cell of each row, and (row, cell) of the cells before it that the traversal visits, nearest borders first."""
        half = v.shape[1] // 2
        (own1, gap1), (own2, gap2) = self.halves[0].borders(v[:, :half]), self.halves[1].borders(v[:, half:])
        codes = gap2.shape[1]
        home = own1 * codes + own2
        order1, order2 = gap1.argsort(axis=1, kind="stable"), gap2.argsort(axis=1, kind="stable")
        gap1, gap2 = np.take_along_axis(gap1, order1, 1), np.take_along_axis(gap2, order2, 1)
        rows, cells = [], []
        for rank in range(gap1.shape[1]):  # next code of the first half, with all of the second half's that are still in reach
            live = np.flatnonzero(gap1[:, rank] <= self.reach)
            if not len(live):
                break
            room = (gap2[live] <= (self.reach - gap1[live, rank])[:, None]).sum(axis=1)
            row = np.repeat(live, room)
            second = order2[row, np.arange(len(row)) - np.repeat(np.cumsum(room) - room, room)]
            rows.append(row)
            cells.append(order1[row, rank] * codes + second)
        row, cell = np.concatenate(rows), np.concatenate(cells)
        before = cell < home[row]
        return home, row[before], cell[before]


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1), 0)


def codebook(x: np.ndarray, codes: int, rng: np.random.Generator, rounds: int = 10) -> Codebook:
    """Lloyd's rounds from random rows; equal centroids stand as they are."""
    centres = x[rng.choice(len(x), min(codes, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([squared_distances(x[i : i + 4096], centres).argmin(axis=1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        count = np.bincount(own, minlength=len(centres))
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    apart = np.sqrt(squared_distances(centres, centres))
    return Codebook(centres, np.where(apart > 0, apart, 1.0))


def build(v: np.ndarray, codes: int, threshold: float, target_recall: float) -> MultiIndex:
    """Codebooks of a sample, and the reach that keeps ``target_recall`` of pairs at exactly the threshold."""
    rng = np.random.default_rng(13)
    half = v.shape[1] // 2
    halves = (codebook(v[:, :half], codes, rng), codebook(v[:, half:], codes, rng))
    at = v[rng.permutation(len(v))[:4096]]
    away = rng.normal(size=at.shape)
    away -= (away * at).sum(axis=1)[:, None] * at
    size = np.sqrt((away * away).sum(axis=1))[:, None]
    near = threshold * at + math.sqrt(max(0.0, 1 - threshold * threshold)) * np.where(size > 0, away / np.where(size > 0, size, 1), 0)
    own = [h.borders(x)[0] for h, x in zip(halves, (near[:, :half], near[:, half:]))]
    gaps = [h.borders(x)[1] for h, x in zip(halves, (at[:, :half], at[:, half:]))]
    spent = sum(g[np.arange(len(at)), o] for g, o in zip(gaps, own))
    return MultiIndex(halves, float(np.quantile(spent, target_recall)))


def fit(classes: DataFrame, n: int, threshold: float, target_recall: float) -> dict[int, MultiIndex]:
    """An index for each length of vectors in a sample of ``FIT_ROWS`` rows by hash, with more codes for more rows; vectors of
    other lengths stay in one cell, in blocks."""
    share = min(1.0, FIT_ROWS / max(n, 1))
    by_hash = F.pmod("k2", F.lit(1 << 32)) < int(share * (1 << 32))
    sample = classes.where(by_hash).select("vector").limit(FIT_ROWS).toArrow().column("vector").combine_chunks()
    codes = int(min(MAX_CODES, max(2, math.sqrt(n / CELL_ROWS))))
    lengths = np.array([len(v) for v in sample])
    out = {}
    for length in np.unique(lengths) if len(lengths) else ():
        if length > 1:
            rows = matrix(sample.take(pa.array(np.flatnonzero(lengths == length))), pa.float64(), int(length))
            out[int(length)] = build(unit(rows), codes, threshold, target_recall)
    return out


def classes_of(rows: DataFrame) -> DataFrame:
    """Distinct (label, vector) of rows (id, k1, k2, label, vector), with a number, their least id and how many rows they stand for."""
    sound = rows.where("k1 is not null")
    merged = sound.groupBy("k1", "k2").agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("id").alias("least"), F.count("*").alias("copies"))
    return materialize(merged.withColumn("cid", F.monotonically_increasing_id()), "classes")


GRID = ["label", "length", "cell"]


def on_grid(classes: DataFrame, index: dict[int, MultiIndex]) -> DataFrame:
    """A row of each class in its own cell (``home``) and in those that it visits."""
    schema = f"label {classes.schema['label'].dataType.simpleString()}, length int, cell bigint, home boolean, cid bigint, copies bigint, vector array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column("vector")], np.int64)
            for length in np.unique(lengths):
                part = batch.take(pa.array(np.flatnonzero(lengths == length)))
                v = unit(matrix(part.column("vector"), pa.float64(), int(length)))
                own = np.zeros(len(v), np.int64)
                row, cell = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if int(length) in index:
                    own, row, cell = index[int(length)].cells(v)
                at = np.concatenate((np.arange(len(v)), row))
                for lo in range(0, len(at), 8192):
                    some = at[lo : lo + 8192]
                    flat = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * length, pa.int32()), pa.array(v[some].ravel()))
                    of = part.take(pa.array(some))
                    yield pa.RecordBatch.from_arrays([of.column("label"), pa.array(np.full(len(some), length, np.int32)), pa.array(np.concatenate((own, cell))[lo : lo + 8192].astype(np.int64)), pa.array(np.arange(lo, lo + len(some)) < len(v)), of.column("cid"), of.column("copies"), flat], names=[*GRID, "home", "cid", "copies", "vector"])
            give_back_memory()

    return classes.select("label", "vector", "cid", "copies").mapInArrow(run, schema)


def tiled(placed: DataFrame) -> DataFrame:
    """``placed`` with ``tile`` (two numbers in one cell) and ``side``: cells of several blocks send each row to all tiles of its block.

    Tile (k, k) compares block k of a cell's own vectors with itself, and, where the cell is one block, with its visitors;
    (k, m) compares it with block m > k; numbers from ``BLOCK_VISITORS`` on are the visitors' blocks.
    """
    sizes = placed.groupBy(*GRID).agg(F.count_if("home").alias("own"), F.count_if(~F.col("home")).alias("guests"), F.count("*").alias("rows"))
    large = materialize(sizes.where(F.greatest("own", "guests") > BLOCK), "cells")
    zero = F.lit(0).cast("bigint")
    plain = lambda df: df.select(*GRID, zero.alias("k"), zero.alias("m"), F.when(F.col("home"), 0).otherwise(1).alias("side"), F.lit(True).alias("within"), "cid", "copies", "vector")
    counted = uses(large, "rows")
    if not counted[0]:
        return plain(placed)
    blocks = lambda c: F.ceil(F.col(c) / BLOCK)
    hot = join_unique(placed, large, GRID, "rows", counted)
    mine = F.pmod(F.xxhash64("cid"), F.greatest(F.when(F.col("home"), blocks("own")).otherwise(blocks("guests")), F.lit(1)))
    hot = hot.withColumn("block", mine)
    upto = lambda n: F.when(n > 0, F.sequence(zero, n - 1)).otherwise(F.array().cast("array<bigint>"))
    at = lambda k, m, side, within: F.struct(k.alias("k"), m.alias("m"), F.lit(side).alias("side"), within.alias("within"))
    block = F.col("block")
    own_tiles = F.transform(upto(blocks("own")), lambda b: F.when(b < block, at(b, block, 1, F.lit(False))).otherwise(at(block, b, 0, b == block)))
    guest_tiles = F.transform(upto(blocks("guests")), lambda b: at(block, b + GUESTS, 0, F.lit(False)))
    visiting = F.transform(upto(blocks("own")), lambda b: at(b, block + GUESTS, 1, F.lit(False)))
    spread = hot.select(*GRID, F.explode(F.when(F.col("home"), F.concat(own_tiles, guest_tiles)).otherwise(visiting)).alias("t"), "cid", "copies", "vector")
    cold = placed.join(small_side(large.select(*GRID)), GRID, "left_anti")
    return plain(cold).unionByName(spread.select(*GRID, "t.*", "cid", "copies", "vector"))


#: Blocks of visitors are numbered from here, so that they differ from blocks of the cell's own vectors.
GUESTS = 1 << 40
LINKS = "cid bigint, n bigint, least bigint"


def compare(threshold: float):
    """Links of a tile: for every linked vector how many rows it links with, and the least vector of its component here."""

    def run(tile: pa.Table) -> pa.Table:
        tile = tile.combine_chunks()
        cid, copies = (tile.column(c).to_numpy() for c in ("cid", "copies"))
        side, within = tile.column("side").to_numpy(), tile.column("within").to_numpy(zero_copy_only=False)
        own, guest = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(own):
            return pa.table({"cid": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "least": pa.array([], pa.int64())})
        length = int(tile.column("length")[0].as_py())
        v = matrix(tile.column("vector").combine_chunks(), pa.float64(), length)
        linked, least = np.zeros(len(cid), np.int64), cid.copy()
        pairs = []
        if within[own[0]]:
            near = links(v[own], v[own], threshold)
            np.fill_diagonal(near, False)
            pairs.append((own, own, near))
        for lo in range(0, len(guest), BLOCK):
            some = guest[lo : lo + BLOCK]
            pairs.append((own, some, links(v[own], v[some], threshold)))
        for a, b, near in pairs:
            linked[a] += near @ copies[b]
            if a is not b:
                linked[b] += copies[a] @ near
        spread_least(least, [(a[i], b[j]) for a, b, near in pairs for i, j in [np.nonzero(near)]])
        found = linked > 0
        give_back_memory()
        return pa.table({"cid": cid[found], "n": linked[found], "least": least[found]})

    return run


def links(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows have a cosine of at least the threshold; products too near to it to tell are summed exactly."""
    dot = a @ b.T
    near = dot >= threshold
    for i, j in zip(*np.nonzero(np.abs(dot - threshold) < 1e-13)):
        near[i, j] = math.fsum(a[i] * b[j]) >= threshold
    return near


def spread_least(least: np.ndarray, ends: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Least number of each component, by minimum over links and halving of the paths, in place."""
    a = np.concatenate([x for x, _ in ends]) if ends else np.zeros(0, np.int64)
    b = np.concatenate([y for _, y in ends]) if ends else a
    root = np.arange(len(least))
    order = np.argsort(least, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    a, b = rank[a], rank[b]
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for at in (a, b, root[a], root[b]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    least[:] = least[order][root[rank]]


def judged(rows: DataFrame, threshold: float, target_recall: float, key: str, vector: str, label: str) -> DataFrame:
    """``row`` (all columns of the input), n_links, component_id and kept."""
    v, by = F.col(f"`{vector}`"), F.col(f"`{label}`")
    sound = is_finite(v) & by.isNotNull() & F.coalesce(F.exists(v, lambda c: c != 0), F.lit(False))
    #: 128 bits stand for a label and a vector.
    hashed = lambda *more: F.when(sound, F.xxhash64(*more, by, v))
    base = rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"), F.col(f"`{key}`").alias("id"), hashed().alias("k1"), hashed(F.lit("second")).alias("k2"), by.alias("label"), v.alias("vector"))
    classes = classes_of(base)
    n = classes.count()
    index = fit(classes, n, threshold, target_recall)
    placed = materialize(on_grid(classes, index), "cells")
    found = materialize(tiled(placed).groupBy(*GRID, "k", "m").applyInArrow(compare(threshold), LINKS), "links")
    roots = connected_components(found.where("cid <> least").select(F.col("cid").alias("a"), F.col("least").alias("b")))
    counts = found.groupBy("cid").agg(F.sum("n").alias("n"))
    known = classes.select("cid", "k1", "k2", "least", "copies")
    known = known.join(counts, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    known = materialize(known.where("n > 0 or copies > 1"), "known")
    least = known.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("members"))
    facts = join_unique(known, least, ["root"], "members").select("k1", "k2", "copies", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component")
    done = left_join_unique(base.drop("label", "vector"), materialize(facts, "facts"), ["k1", "k2"], "copies")
    component = F.coalesce("component", "id")
    return done.select("row", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, component.isNull()).alias("kept"))


def near_duplicates(rows: DataFrame, threshold: float = 0.98, target_recall: float = 0.999, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Every row with n_links (other rows linked directly), component_id (least id reachable) and kept (whether it has that id).

    ``target_recall`` bounds the share of pairs found among those at exactly the threshold, the hardest; closer ones are
    found more surely. No pair below the threshold is linked.
    """
    done = judged(rows, threshold, target_recall, key, vector, label)
    own = [F.col(f"row.`{c}`").alias(c) for c in rows.columns if c.lower() not in RESULTS]
    return done.select(*own, *RESULTS)


def keep_one(rows: DataFrame, **options) -> DataFrame:
    """The rows that have the least id of their component."""
    given = {"threshold": 0.98, "target_recall": 0.999, "key": "vec_id", "vector": "embedding", "label": "label"} | options
    return judged(rows, **given).where("kept").select("row.*")
