"""Token counts with the whole-token shortcut.

A vocabulary string that provably encodes alone as one token never has to be merged: wherever it stands as a
pre-token, it counts one. The proof is made once per worker by giving every word-final vocabulary string to the
library. What is left of a text's pre-tokens is merged by the library itself, each distinct string once per cache
generation. No pre-token of this tokenizer spans white space, so equal strings between white space share one lookup.

Every text is handled in one narrow pass (``mapInArrow``): no shuffle, bounded memory, nothing collected.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import bounded_batches
from .textbatch import Words, slices

#: Texts of these characters only are cut into pre-tokens here; in all others, the library cuts what stands between
#: white space. None of them changes under NFC, and each has one character as its lower case.
NOT_PLAIN = r"[^\t-\r -~À-ÖØ-öø-ÿ]"
#: The tokenizer's own split (fixed by its file) on lower-cased plain text, but for runs of letters.
CUTS = r"('(?:s|t|re|ve|m|ll|d)|[!-/:-@\[-`{-~]+|[0-9])"
LETTERS = re.compile("[a-zß-öø-ÿ]+")
#: What these stand for (fixed by the tokenizer's file): how it normalises, and how it splits.
NORMALISERS = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def pre_tokens(texts: pa.Array, special: tuple[str, ...]) -> Words:
    """Strings whose encodings, one after another, are the encoding of each text."""
    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, NOT_PLAIN)
    for s in special:
        odd = pc.or_(odd, pc.match_substring(texts, s))
    return Words(pc.if_else(odd, texts, pc.replace_substring_regex(pc.utf8_lower(texts), CUTS, r" \1 ")))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest for letters from 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def prove_whole_tokens(tokenizer) -> dict[str, int]:
    """Vocabulary strings (as plain text) whose encoding alone is exactly their own one token."""
    letters = byte_letters()
    claims = {}
    for piece, number in tokenizer.get_vocab().items():
        if piece.endswith("</w>"):
            try:
                text = bytes(letters[c] for c in piece[:-4]).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if text and not any(c.isspace() for c in text):
                claims[text] = number
    texts = list(claims)
    return {t: claims[t] for t, e in zip(texts, tokenizer.encode_batch_fast(texts, add_special_tokens=False)) if e.ids == [claims[t]]}


def require_known_split(tokenizer) -> None:
    """Refuse a tokenizer that cuts texts in another way than ``pre_tokens`` does."""
    parts = [json.loads(p.__getstate__()) if p else {} for p in (tokenizer.normalizer, tokenizer.pre_tokenizer)]
    names = [n["type"] for n in parts[0].get("normalizers", ())]
    splits = [p["pattern"].get("Regex") for p in parts[1].get("pretokenizers", ()) if p["type"] == "Split"]
    if names != NORMALISERS or splits != [SPLIT]:
        raise ValueError("the whole-token shortcut knows the split of word_bpe_49k.json only")


class TokenTable:
    """Token ids of strings without white space, filled as new ones come. Bounded: it starts anew when full."""

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        require_known_split(self.tokenizer)
        self.whole = prove_whole_tokens(self.tokenizer)
        self.limit = limit
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.start, self.length = array("I"), array("q"), array("i")
        for text, number in self.whole.items():
            self.index[text] = self.put((number,))

    def put(self, ids) -> int:
        self.start.append(len(self.flat))
        self.length.append(len(ids))
        self.flat.extend(ids)
        return len(self.start) - 1

    def rows(self, strings: list[str], fixed: tuple[int, ...] = ()) -> np.ndarray:
        """Row of each distinct string, then one row for the ids of ``fixed``."""
        if len(self.index) > self.limit:
            self.clear()
        have = self.index
        if new := [s for s in strings if s not in have]:
            self.merge([s for s in new if LETTERS.fullmatch(s)])
            other = [s for s in new if s not in have]
            for s, e in zip(other, self.tokenizer.encode_batch(other, add_special_tokens=False)):
                have[s] = self.put(e.ids)
        return np.array([*map(have.__getitem__, strings), *([self.put(fixed)] if fixed else [])], np.int64)

    def merge(self, letters: list[str], at_once: int = 256) -> None:
        """Let the library merge runs of letters, many to a call: between spaces, each stays a word of its own."""
        for i in range(0, len(letters), at_once):
            group = letters[i : i + at_once]
            e = self.tokenizer.encode(" ".join(group), add_special_tokens=False)
            sizes = np.bincount(e.word_ids, minlength=len(group))
            first = len(self.flat) + np.cumsum(sizes) - sizes
            self.index.update(zip(group, range(len(self.start), len(self.start) + len(group))))
            self.start.extend(first.tolist())
            self.length.extend(sizes.tolist())
            self.flat.extend(e.ids)

    def lengths(self) -> np.ndarray:
        return np.array(self.length, np.int64)

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows one after another, and how many each has."""
        n, first, flat = self.lengths()[rows], np.array(self.start, np.int64)[rows], np.array(self.flat, np.uint32)
        end = np.cumsum(n)
        return flat[np.repeat(first - (end - n), n) + np.arange(end[-1] if len(end) else 0)], n


@lru_cache(maxsize=2)
def token_table(path: str) -> TokenTable:
    """One table per worker process; Python workers are used again by later tasks."""
    return TokenTable(path)


def count_tokens(docs: DataFrame, max_tokens: int = 2048, vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than ``max_tokens`` tokens).

    Null and empty texts have 0 bytes and 0 tokens. A null doc_id stays null. Special strings inside a text are
    special tokens, as the library has it by default. Repeated rows are counted each for itself; other columns are
    ignored; an empty table gives an empty result.
    """
    path = tokenizer_path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(path)
        for batch in batches:
            for part in slices(batch):
                words = pre_tokens(part.column("text"), table.special)
                rows = table.rows(words.distinct.to_pylist())
                n = words.per_text(table.lengths()[rows][words.index] if len(rows) else words.index)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64()), pa.array(n > max_tokens)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = bounded_batches(docs).select(F.col("doc_id").cast("long"), F.col("text"), F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long")).alias("n_bytes"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
