"""Sequence packing: first-fit decreasing with a tournament tree of bin capacities.

Each document's ids, with the end id, are cut at multiples of the sequence length; full pieces are sequences of
their own, the rests are packed by first-fit decreasing, independently in randomised groups of documents. Only
narrow piece rows are shuffled, never ids or texts. A group holds ``group_pieces`` rests at most, so that the work of
a task is a run of bounded groups whatever the keys are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import bounded_batches
from .textbatch import slices
from .token_counts import pre_tokens, token_table, tokenizer_path

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_documents(docs: DataFrame, seq_len: int = 4096, end_id: int = 2, vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    """Pieces of each document's ids plus ``end_id``: full ones of ``seq_len``, then what is left."""
    path = tokenizer_path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(path)
        for batch in batches:
            for part in slices(batch):
                words = pre_tokens(part.column("text"), table.special)
                rows = table.rows(words.distinct.to_pylist(), fixed=(end_id,))
                ends = words.offsets[1:]
                ids, n = table.gather(np.insert(rows[words.index], ends, rows[-1]))
                total = np.concatenate(([0], np.cumsum(n)))
                bound = total[np.concatenate(([0], ends + np.arange(1, len(ends) + 1)))]
                size = np.diff(bound)
                pieces = -(-size // seq_len)
                doc = np.repeat(np.arange(len(size)), pieces)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * seq_len
                length = np.minimum(seq_len, size[doc] - start)
                at = (bound[doc] + start) * 4
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[a : a + 4 * k]) for a, k in zip(at.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(doc)), *(pa.array(x, pa.int64()) for x in (start, length, crc, size[doc]))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return bounded_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECE)


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, largest items first, each into the first bin with room.

    The tree's leaves are the bins' free room, each inner node the larger of its two: the first bin with room is
    found from the root by going left whenever the left half has room.
    """
    leaves = 1 << max(0, int(len(sizes) - 1).bit_length())
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    order = np.argsort(-sizes, kind="stable")
    for item, size in zip(order.tolist(), sizes[order].tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - room[node]
        room[node] -= size
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return bins, offsets


def pack(pieces: DataFrame, seq_len: int = 4096, group_pieces: int = 16_384, seed: int = 7) -> DataFrame:
    """Add sequence_id and offset to pieces of at most ``seq_len``.

    Pieces are dealt to partitions at random (by a seeded hash) and, in the order of that hash, to groups; each
    group is packed alone. The order is fixed, so that a task that runs again deals the same ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40

        def packed(group: pa.Table, first: int):
            bins, offsets = first_fit_decreasing(group.column("length").to_numpy(), seq_len)
            out = group.append_column("sequence_id", pa.array(first + bins)).append_column("offset", pa.array(offsets))
            return out.to_batches(), first + (int(bins.max()) + 1 if len(bins) else 0)

        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            batch = batch.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            while n + batch.num_rows >= group_pieces:
                take = group_pieces - n
                done, first = packed(pa.Table.from_batches([*held, batch.slice(0, take)]), first)
                yield from done
                held, n, batch = [], 0, batch.slice(take)
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
        if n:
            done, first = packed(pa.Table.from_batches(held), first)
            yield from done

    #: A row's place is part of the hash: equal rows, and those without id, are dealt like others.
    dealt = pieces.withColumn("deal", F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id(), F.lit(seed)))
    return dealt.repartition("deal").sortWithinPartitions("deal", "doc_id", "start", "ids_crc32").mapInArrow(run, PIECE + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, seq_len: int = 4096) -> DataFrame:
    """Pack whole documents into sequences of at most ``seq_len`` ids; one row per piece.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null or empty text is the end id alone; rows
    with equal doc_id are packed each for itself; an empty table gives an empty result. Other columns are ignored.
    """
    return pack(cut_documents(docs, seq_len), seq_len)
