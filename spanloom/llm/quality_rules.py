"""Quality rules as a short-circuit cascade.

Each rule rejects a document from a few counts of its whole text. A bounded sample tells each rule's cost (seconds a
document, counts included) and selectivity; the rules then run in the order of rejections per second, each only on
the documents that all before it have passed. The order changes the work, never a verdict: a document is kept if no
rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import bounded_batches
from .textbatch import Words, byte_view, slices, span_sums

SYMBOLS = b"#*$%&|<>"


class Counts:
    """Counts of each text in a batch, each made when first asked for."""

    def __init__(self, texts: pa.Array):
        self.texts = pc.fill_null(texts, "")
        self.made: dict[str, np.ndarray] = {}

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self.made:
            self.made[name] = getattr(self, f"count_{name}")()
        return self.made[name]

    @property
    def words(self) -> Words:
        if "words" not in self.made:
            self.made["words"] = Words(self.texts)
        return self.made["words"]

    def count_n_words(self) -> np.ndarray:
        return np.diff(self.words.offsets)

    def count_word_chars(self) -> np.ndarray:
        sizes = pc.utf8_length(self.words.distinct).to_numpy(zero_copy_only=False).astype(np.int64)
        return self.words.per_text(sizes[self.words.index] if len(sizes) else self.words.index)

    def count_n_symbols(self) -> np.ndarray:
        data, offsets = byte_view(self.texts)
        table = np.zeros(256, np.bool_)
        table[list(SYMBOLS)] = True
        return span_sums(table[data], offsets)

    def count_n_caps(self) -> np.ndarray:
        """Words of two capitals or more and no small letter."""
        loud = pc.and_(pc.match_substring_regex(self.words.distinct, r"\p{Lu}.*\p{Lu}"), pc.invert(pc.match_substring_regex(self.words.distinct, r"\p{Ll}"))).to_numpy(zero_copy_only=False)
        return self.words.per_text(loud[self.words.index] if len(loud) else self.words.index)

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each text: its lines with a word, and how many of them equal an earlier one."""
        lists = pc.split_pattern(self.texts, "\n")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        texts = len(self.texts)
        full = pc.not_equal(pc.ascii_trim_whitespace(coded.dictionary), "").to_numpy(zero_copy_only=False)
        text = np.repeat(np.arange(texts), np.diff(offsets))
        keep = full[index] if len(full) else np.zeros(0, np.bool_)
        text, index = text[keep], index[keep]
        n = np.bincount(text, minlength=texts)
        first = np.unique(text * max(1, len(full)) + index) // max(1, len(full))
        return n, n - np.bincount(first, minlength=texts)

    def count_n_lines(self) -> np.ndarray:
        n, self.made["n_dup_lines"] = self.lines()
        return n

    def count_n_dup_lines(self) -> np.ndarray:
        self.made["n_lines"], n = self.lines()
        return n

    def count_n_repeat_words(self) -> np.ndarray:
        """Words in a 3-word window that the text has twice or more, first included."""
        w, owner, d = self.words, self.words.owner(), max(1, len(self.words.distinct))
        inside = np.zeros(len(w.index), np.bool_)
        at = np.flatnonzero(owner[2:] == owner[:-2]) if len(owner) > 2 else np.zeros(0, np.int64)
        if len(at):
            _, key = np.unique(w.index[at] * d + w.index[at + 1], return_inverse=True)
            _, key = np.unique(key * d + w.index[at + 2], return_inverse=True)
            _, key, times = np.unique(key * len(self.texts) + owner[at], return_inverse=True, return_counts=True)
            twice = at[times[key] > 1]
            for k in range(3):
                inside[twice + k] = True
        return w.per_text(inside)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Counts], np.ndarray]


#: The first two are the base; the others are the method's own. Empty texts fail the first.
RULES = (
    Rule("few_words", lambda c: c["n_words"] < 50),
    Rule("repeated_words", lambda c: 100 * c["n_repeat_words"] > 50 * c["n_words"]),
    Rule("symbols", lambda c: 100 * c["n_symbols"] > 10 * c["n_words"]),
    Rule("duplicate_lines", lambda c: 100 * c["n_dup_lines"] > 50 * c["n_lines"]),
    Rule("word_length", lambda c: (c["word_chars"] < 2 * c["n_words"]) | (c["word_chars"] > 20 * c["n_words"])),
    Rule("capitals", lambda c: 100 * c["n_caps"] > 30 * c["n_words"]),
)
BASE = {"few_words", "repeated_words"}


def cascade(texts: pa.Array, rules: tuple[Rule, ...]) -> np.ndarray:
    """Which texts no rule rejects; each rule sees only what the rules before it passed."""
    alive = np.arange(len(texts))
    counts = Counts(texts)
    for rule in rules:
        if not len(alive):
            break
        out = rule.rejects(counts)
        if out.any():
            alive = alive[~out]
            counts = Counts(texts.take(pa.array(alive)))
    kept = np.zeros(len(texts), np.bool_)
    kept[alive] = True
    return kept


def plan_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 512) -> tuple[Rule, ...]:
    """Order rules by rejections per second, estimated on the ``sample_rows`` rows whose ids and places have the least hashes.

    Whole texts are timed where they are, each rule by the best of three tries; the driver gets a few numbers a task.
    The sample only holds for this estimate, which no verdict depends on.
    """
    deal = F.xxhash64("doc_id", F.monotonically_increasing_id(), F.lit(5))  # null and repeated ids are sampled like others
    least = docs.select(deal.alias("deal")).orderBy("deal").limit(sample_rows).agg(F.max("deal")).first()[0]
    if least is None:
        return rules

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                seconds, rejected = zip(*(timed(rule, part.column("text")) for rule in rules))
                yield pa.RecordBatch.from_arrays([pa.array(range(len(rules)), pa.int32()), pa.array(seconds), pa.array(rejected, pa.int64())], ["rule", "seconds", "rejected"])

    seen = bounded_batches(docs).withColumn("deal", deal).where(F.col("deal") <= least).select("text").mapInArrow(run, "rule int, seconds double, rejected long")
    rate = {r.rule: (r.rejected + 0.5) / r.seconds for r in seen.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected")).collect()}
    return tuple(rules[i] for i in sorted(range(len(rules)), key=lambda i: (-rate[i], i)))


def timed(rule: Rule, texts: pa.Array) -> tuple[float, int]:
    """Seconds that a rule takes, counts included, and how many texts it rejects."""
    best = float("inf")
    for _ in range(3):
        began = time.perf_counter()
        out = int(rule.rejects(Counts(texts)).sum())
        best = min(best, time.perf_counter() - began)
    return best, out


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with all its columns, without the documents that a rule rejects (verdicts only, short-circuited).

    Null and empty texts have no word and go. Nulls in other columns stay, repeated rows are judged alike.
    """
    order = plan_order(docs, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(cascade(part.column("text"), order)))

    return bounded_batches(docs).mapInArrow(run, docs.schema)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document with its base counts, base_failed, and kept (no rule rejects it).

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept. The cascade of the other
    rules runs on what the base has passed, in the planned order. A null text counts as empty (0 words, failed); rows
    with equal doc_id are judged each for itself; an empty table gives an empty result; other columns are ignored.
    """
    order = tuple(r for r in plan_order(docs, rules) if r.name not in BASE)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                counts = Counts(part.column("text"))
                failed = np.zeros(part.num_rows, np.bool_)
                for rule in rules:
                    if rule.name in BASE:
                        failed |= rule.rejects(counts)
                passed = np.flatnonzero(~failed)
                kept = np.zeros(part.num_rows, np.bool_)
                kept[passed] = cascade(part.column("text").take(pa.array(passed)), order)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(counts[n], pa.int64()) for n in names), pa.array(failed), pa.array(kept)], ["doc_id", *names, "base_failed", "kept"])

    return bounded_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")
