"""Arrow and numpy helpers that the Python-side operators share: words of whole batches at once."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once. A single longer text still goes through whole.
SLICE_BYTES = 2 << 20


def slices(batch: pa.RecordBatch, column: str = "text", max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``max_bytes`` of text (one row at least)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(sizes) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        yield batch.slice(lo, hi - lo)
    give_back_memory()


@lru_cache(maxsize=1)
def c_library():
    """The C library, if it can give freed memory back to the system."""
    found = ctypes.CDLL(None)
    return found if hasattr(found, "malloc_trim") else None


def give_back_memory() -> None:
    """Python workers live on between tasks: what a batch has freed goes back to the system, Arrow's and numpy's."""
    pa.default_memory_pool().release_unused()
    if c_library():
        c_library().malloc_trim(0)


class Words:
    """Words of each text as indices into one dictionary of distinct words.

    ``index``: dictionary position of each word, texts one after another; ``offsets``: first word of each text,
    with the end; ``distinct``: the dictionary as an Arrow array. White space is ASCII (0x20, 0x09-0x0D).
    """

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        offsets = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        self.distinct = coded.dictionary
        index = coded.indices.to_numpy(zero_copy_only=False)
        offsets = offsets - offsets[0]
        blank = pc.index(self.distinct, "").as_py()
        if blank >= 0:  # what leading and trailing white space leaves
            keep = index != blank
            offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
            index = index[keep]
        self.index, self.offsets = index.astype(np.int64), offsets.astype(np.int64)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value per word over each text."""
        return span_sums(values, self.offsets)

    def owner(self) -> np.ndarray:
        """Number of the text that each word is in."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def span_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``offsets``."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offset of each (with the end). Nulls count as empty."""
    raw = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8)
    data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] is not None and raw.buffers()[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
