"""Compression classifier: which of two zstandard dictionaries shortens a text more, as a calibrated score.

One dictionary is trained on texts labelled good, one on texts labelled bad. A text is compressed with both, whole;
the difference of the two sizes, normalised by the text's length and by their sum, goes through a logistic curve fitted
on labelled texts that neither dictionary has seen. Only the text's bytes are looked at.

The model is fitted on a bounded sample of labelled rows: for the dictionaries, ``sample_rows`` of each label with
``sample_bytes`` in all, read whole in one task for each label; for the curve, twice as many rows, whose features are
made from whole texts where the rows are. The driver gets two dictionaries and seven numbers a row. Scoring is one
narrow pass over whole texts.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import bounded_batches, discard, materialize
from .textbatch import slices


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    level: int = 3


class Sizes:
    """Compressors of both dictionaries, made once per task."""

    def __init__(self, good: bytes, bad: bytes, level: int):
        import zstandard

        def compressor(raw: bytes):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=level)
            return zstandard.ZstdCompressor(dict_data=d, level=level, write_checksum=False)

        self.good, self.bad = compressor(good), compressor(bad)

    def features(self, texts: pa.Array) -> np.ndarray:
        raw = pc.fill_null(texts, "").cast(pa.binary())
        sizes = np.array([(len(b), len(self.good.compress(b)), len(self.bad.compress(b))) for b in raw.to_pylist()], np.float64).reshape(-1, 3)
        n, good, bad = sizes.T
        by_length, by_sum, log = (bad - good) / (n + 20), (bad - good) / (bad + good), np.log1p(n)
        least = np.minimum(good, bad) / (n + 20)
        return np.stack([by_length, by_sum, by_sum * log, log, least, least * log], axis=1)


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton's method on standardised features; weights (bias first), means and scales."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    p = np.c_[np.ones(len(x)), (x - mean) / scale]
    w = np.zeros(p.shape[1])
    for _ in range(60):
        s = 1 / (1 + np.exp(-np.clip(p @ w, -30, 30)))
        h = (p.T * (s * (1 - s))) @ p + ridge * np.eye(len(w))
        step = np.linalg.solve(h, p.T @ (y - s) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w, mean, scale


def score_features(model: Model, x: np.ndarray) -> np.ndarray:
    z = np.c_[np.ones(len(x)), (x - np.array(model.mean)) / np.array(model.scale)] @ np.array(model.weights)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


FEATURES = [f"x{i}" for i in range(6)]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, sample_rows: int = 1500, sample_bytes: int = 16 << 20, dictionary_bytes: int = 112 << 10, level: int = 3) -> Model:
    """Fit on labelled rows outside the held-out fold (crc32 of the doc_id as text, modulo ``folds``, is not 0).

    Samples are the first rows by a hash of the id: at most ``sample_rows`` of each label for the dictionaries, and
    twice as many rows, in the labels' own proportion, for the curve. A label's dictionary rows are taken, whole and whatever
    their length, until their sum reaches ``sample_bytes``; texts are never cut. Rows with equal doc_id are one. A null label or doc_id is left out, null texts are empty. Without rows of
    both labels there is no model to fit: an error. Other columns are ignored.
    """
    own = labels.where(F.col(label).isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % folds != 0)).groupBy("doc_id").agg(F.max(label).alias("y"))
    own = own.withColumn("deal", F.xxhash64("doc_id", F.lit(11)))
    pick = own.where("pmod(deal, 2) = 0 and y = 1").orderBy("deal").limit(sample_rows).unionByName(own.where("pmod(deal, 2) = 0 and y = 0").orderBy("deal").limit(sample_rows))
    pick = pick.unionByName(own.where("pmod(deal, 2) = 1").orderBy("deal").limit(2 * sample_rows))
    #: Bounded by the three limits; so a broadcast is safe, and the documents are not shuffled.
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(pick), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"), F.min("deal").alias("deal"))
    sample = bounded_batches(materialize(rows.where("y in (0, 1)"), "labelled-sample"))
    sized = sample.where("pmod(deal, 2) = 0").select("deal", "y", F.octet_length("text").alias("size")).where("size > 0")
    chosen = sized.withColumn("sum", F.sum("size").over(Window.partitionBy("y").orderBy("deal"))).where(f"sum - size < {sample_bytes}").select("deal")  # 2 x sample_rows narrow rows
    texts = sample.join(F.broadcast(chosen), "deal").select("y", F.encode("text", "UTF-8").alias("text"), "deal")
    found = {r.y: r for r in texts.groupBy("y").applyInArrow(dictionary_maker(dictionary_bytes), "y int, raw binary, trained boolean").collect()}
    if set(found) != {0, 1}:
        raise ValueError(f"documents with {label} 0 and 1 are needed outside the held-out fold")
    if not all(r.trained for r in found.values()):
        warnings.warn("too few labelled texts to train a dictionary; the texts themselves serve as one", stacklevel=2)
    good, bad = bytes(found[1].raw), bytes(found[0].raw)
    table = sample.where("pmod(deal, 2) = 1").select("text", "y").mapInArrow(feature_maker(good, bad, level), ", ".join(f"{n} double" for n in FEATURES) + ", y double").toPandas()
    if table["y"].nunique() < 2:
        raise ValueError(f"documents with {label} 0 and 1 are needed outside the held-out fold")
    w, mean, scale = fit_curve(table[FEATURES].to_numpy(), table["y"].to_numpy())
    discard(sample)
    return Model(good, bad, tuple(w), tuple(mean), tuple(scale), level)


def dictionary_maker(size: int):
    """From one label's sample: its dictionary, or of too few texts for training, their last bytes as they are."""

    def make(rows: pa.Table) -> pa.Table:
        import zstandard

        rows = rows.sort_by("deal")
        texts = rows.column("text").to_pylist()
        try:
            raw, trained = zstandard.train_dictionary(size, texts).as_bytes(), True
        except zstandard.ZstdError:
            raw, trained = b"\n".join(texts)[-size:], False
        return pa.table({"y": pa.array([rows.column("y")[0].as_py()], pa.int32()), "raw": pa.array([raw], pa.binary()), "trained": [trained]})

    return make


def feature_maker(good: bytes, bad: bytes, level: int):
    """Features and label of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(good, bad, level)
        for batch in batches:
            for part in slices(batch):
                x = sizes.features(part.column("text"))
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), part.column("y").cast(pa.float64())], [*FEATURES, "y"])

    return run


def classify(docs: DataFrame, model: Model, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 if score >= ``threshold``).

    Null texts score as empty ones do. A null doc_id is held out of nothing (false); repeated rows are scored each for
    itself; an empty table gives an empty result; other columns are ignored. The model is fixed in size (two
    dictionaries), so it travels with the tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good, model.bad, model.level)
        for batch in batches:
            for part in slices(batch):
                score = score_features(model, sizes.features(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array(score >= threshold).cast(pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    return bounded_batches(docs).select(F.col("doc_id").cast("long"), "text", held.alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
