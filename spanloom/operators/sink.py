"""Rows to tables: JSON lines, appends, and greedy batches under row and byte limits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir


def json_line(columns: list[str]) -> Column:
    """A row as compact JSON, without absent columns."""
    return F.to_json(F.struct(*(F.col(f"`{c}`") for c in columns)))


def append(rows: DataFrame, path: str) -> None:
    """Append to a Parquet table."""
    rows.write.mode("append").parquet(path)


def append_ndjson(rows: DataFrame, path: str) -> None:
    rows.select(json_line(rows.columns).alias("value")).write.mode("append").text(path)


#: A key of more rows, and of more than one in LARGE_KEYS of all rows, is packed by many tasks, in chunks of CHUNK rows.
CHUNK, LARGE_KEYS = 65_536, 10_000


def pack_batches(rows: DataFrame, key: str, order: list[str], bytes_column: str, max_rows: int = 8000, max_bytes: int = 4 << 20, chunk: int = CHUNK) -> DataFrame:
    """``rows`` with batch, its number among those of its key (from 0); null for a row that alone exceeds the limit.

    Greedy in the order of ``order`` within each ``key`` (as a rule, the request that rows came with): a batch ends
    before the row that would exceed ``max_rows`` or ``max_bytes``. Batches never cross keys, so they are the same
    whatever the partitions are; rows that ``order`` doesn't tell apart may change places. Rows are written once to the shared
    folder, as they are read several times. Keys of few rows are streamed, many in a task; a key of very many is packed in
    parallel, with the same batches (see ``pack_chunks``).
    """
    rows = written(rows)
    counts = rows.groupBy(key).agg(F.count("*").alias(ROWS))
    least = max(chunk, (counts.agg(F.sum(ROWS)).first()[0] or 0) // LARGE_KEYS)
    large = counts.where(F.col(ROWS) > least).select(F.col(key).alias(KEY))  # LARGE_KEYS of them at most
    if not large.limit(1).count():
        return stream_batches(rows, key, order, bytes_column, max_rows, max_bytes)
    large = written(large.withColumn(NUMBER, F.monotonically_increasing_id()))
    same = F.col(key).eqNullSafe(F.col(KEY))
    few = stream_batches(rows.join(F.broadcast(large), same, "left_anti"), key, order, bytes_column, max_rows, max_bytes)
    many = pack_chunks(rows.join(F.broadcast(large), same).drop(KEY), order, bytes_column, max_rows, max_bytes, max(chunk, max_rows))
    return few.unionByName(many)


KEY, NUMBER, ROWS, PART = (f"__{n}" for n in ("key", "number", "rows", "part"))


def written(rows: DataFrame) -> DataFrame:
    """Rows that are read several times, from a folder that all executors share."""
    path = scratch_dir(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def stream_batches(rows: DataFrame, key: str, order: list[str], bytes_column: str, max_rows: int, max_bytes: int) -> DataFrame:
    """Batches of keys that one task each goes through; its state is a key and two counters."""
    schema = T.StructType([*rows.schema.fields, T.StructField("batch", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, last, number, n, size = False, None, 0, 0, 0
        for part in batches:
            weight, keys = part.column(bytes_column).to_pylist(), part.column(key).to_pylist()
            out = np.full(len(weight), -1, np.int64)
            for i, (k, w) in enumerate(zip(keys, weight)):
                if not started or k != last:
                    started, last, number, n, size = True, k, 0, 0, 0
                if w > max_bytes:
                    continue
                if n and (n == max_rows or size + w > max_bytes):
                    number, n, size = number + 1, 0, 0
                out[i], n, size = number, n + 1, size + w
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.int64(), mask=out < 0)], [*part.schema.names, "batch"])

    return rows.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def pack_chunks(rows: DataFrame, order: list[str], bytes_column: str, max_rows: int, max_bytes: int, chunk: int) -> DataFrame:
    """The same batches of keys (NUMBER) with very many rows, each over many tasks; work follows the rows.

    Rows are sorted over ranges, a task each, and written in chunks. What a range does to the batches depends only on which of its
    first ``max_rows`` rows begins the first batch in it. Its task follows all of these at once, and writes beside each chunk
    what is open before it and how many batches have begun, for each of them. One pass over the ends of the ranges, of which
    there are as many as tasks (and keys), tells which row it is; then chunks are numbered, each by itself.
    """
    # helpers are local, as workers know no module of this package
    plain = T.StructType([f for f in rows.schema.fields if f.name != NUMBER])
    longs = T.ArrayType(T.LongType())
    kinds = {NUMBER: T.LongType(), PART: T.LongType(), "seen": T.LongType(), "open_rows": longs, "open_size": longs, "begun": longs, "sums": longs, "rows": T.ArrayType(plain)}

    def begins(sums: np.ndarray, rows: np.ndarray, size: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """The first row that begins a batch, given what is open before it (``rows`` of ``size`` bytes), or ``entry`` where nothing is."""
        return np.where(rows > 0, np.minimum(np.searchsorted(sums[1:], max_bytes - size, side="right"), max_rows - rows), entry)

    def ends(sums: np.ndarray) -> np.ndarray:
        """For each row, the row before which a batch that begins at it ends; the number of rows if it doesn't end among these."""
        fits = np.searchsorted(sums[1:], sums[:-1] + max_bytes, side="right")
        return np.minimum(fits, np.arange(len(fits)) + max_rows)

    class Followed:
        """What is open after the rows of a range so far, for each of the first ``max_rows`` rows that its first batch may begin at."""

        def __init__(self):
            self.seen, self.sums = 0, np.zeros(1, np.int64)
            self.rows, self.size, self.begun = (np.zeros(max_rows, np.int64) for _ in range(3))

        def record(self, number: int, part: int, last: bool, rows: pa.Array | None) -> dict:
            return {NUMBER: number, PART: part, "seen": self.seen, "open_rows": self.rows, "open_size": self.size, "begun": self.begun, "sums": self.sums[1:] if last else None, "rows": rows}

        def go_through(self, weight: np.ndarray) -> None:
            n = len(weight)
            sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(weight)])
            self.sums = np.concatenate([self.sums, self.sums[-1] + sums[1 : max_rows - len(self.sums) + 2]]) if len(self.sums) <= max_rows else self.sums
            at = begins(sums, self.rows, self.size, np.arange(max_rows) - self.seen)
            end = ends(sums)
            to, begun = np.where(end < n, end, np.arange(n)), (end < n).astype(np.int64)
            while not np.array_equal(further := to[to], to):  # each time twice as far, to the last batch that begins here
                to, begun = further, begun + begun[to]
            here = at < n
            last, at = to[at[here]], at[here]
            pending = (self.rows == 0) & ~here
            self.rows, self.size = np.where(pending, 0, self.rows + n), np.where(pending, 0, self.size + sums[n])
            self.rows[here], self.size[here] = n - last, sums[n] - sums[last]
            self.begun = self.begun.copy()
            self.begun[here] += begun[at] + 1
            self.seen += n

    def fitting(weight: pa.Array) -> np.ndarray:
        """Sizes, and -1 for rows that are in no batch."""
        size = pc.fill_null(weight.cast(pa.int64()), max_bytes + 1).to_numpy(zero_copy_only=False)
        return np.where(size > max_bytes, -1, size)

    def lists(values: list, kind: pa.DataType) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum([0 if v is None else len(v) for v in values])])
        parts = [v if isinstance(v, pa.Array) else pa.array(v, kind) for v in values if v is not None]
        flat = pa.concat_arrays(parts) if parts else pa.array([], kind)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat, mask=pa.array([v is None for v in values]))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, followed, held, full, kind = TaskContext.get().partitionId(), None, None, [], [], None

        def chunk_of_held() -> None:
            if held:
                whole = pa.concat_arrays(held)
                full.append(followed.record(number, part, False, whole))
                weight = fitting(whole.field(bytes_column))
                followed.go_through(weight[weight >= 0])
                held.clear()

        def end_of_key() -> None:
            chunk_of_held()
            if followed:
                full.append(followed.record(number, part, True, None))

        def records() -> pa.RecordBatch:
            column = lambda c: [r[c] for r in full]
            out = [pa.array(column(c), pa.int64()) if k == T.LongType() else lists(column(c), kind if c == "rows" else pa.int64()) for c, k in kinds.items()]
            full.clear()
            return pa.RecordBatch.from_arrays(out, list(kinds))

        for batch in batches:
            numbers = batch.column(NUMBER).to_numpy()
            table = pa.RecordBatch.from_arrays([batch.column(n) for n in plain.names], plain.names).to_struct_array()
            kind, at = table.type, 0
            while at < len(numbers):
                if number != numbers[at]:
                    end_of_key()
                    number, followed = int(numbers[at]), Followed()
                stop = min(int(np.searchsorted(numbers, number, side="right")), at + chunk - sum(map(len, held)))
                held.append(table.slice(at, stop - at))
                at = stop
                if sum(map(len, held)) == chunk:
                    chunk_of_held()
            if full:
                yield records()
        end_of_key()
        if full:
            yield records()

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n, size, begun = None, 0, 0, 0
        for batch in batches:
            out = []
            for i, (number, part, seen) in enumerate(zip(*(batch.column(c).to_pylist() for c in (NUMBER, PART, "seen")))):
                if number != last:
                    last, n, size, begun = number, 0, 0, 0
                sums, *after = (batch.column(c)[i].values.to_numpy() for c in ("sums", "open_rows", "open_size", "begun"))
                entry = min(int(np.searchsorted(sums, max_bytes - size, side="right")), max_rows - n) if n else 0
                out.append((number, part, entry, begun))
                if entry < seen:
                    n, size, begun = int(after[0][entry]), int(after[1][entry]), begun + int(after[2][entry])
                else:
                    n, size = n + seen, size + (int(sums[-1]) if seen else 0)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], [NUMBER, PART, "entry", "before"])

    def number_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, stops = batch.column("rows").flatten(), np.cumsum(batch.column("rows").value_lengths().to_numpy())
            weight, out = fitting(flat.field(bytes_column)), np.full(len(flat), -1, np.int64)
            start = 0
            for stop, n, size, entry, before in zip(stops, *(batch.column(c).to_numpy() for c in ("n", "size", "entry", "before"))):
                fits = weight[start:stop] >= 0
                sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(weight[start:stop][fits])])
                begin, end = np.zeros(len(sums) - 1, np.int64), ends(sums).tolist()
                i = int(begins(sums, n, size, entry))
                while i < len(end):
                    begin[i] = 1
                    i = end[i]
                out[start:stop][fits] = before - 1 + np.cumsum(begin)
                start = stop
            yield pa.RecordBatch.from_arrays([*flat.flatten(), pa.array(out, pa.int64(), mask=out < 0)], [*plain.names, "batch"])

    in_order = rows.repartitionByRange(NUMBER, *order).sortWithinPartitions(NUMBER, *order)
    dealt = written(in_order.mapInArrow(deal, T.StructType([T.StructField(c, k) for c, k in kinds.items()])))
    ranges = dealt.where("sums is not null").drop("rows").repartition(NUMBER).sortWithinPartitions(NUMBER, PART)
    ranges = ranges.mapInArrow(resolve, f"{NUMBER} long, {PART} long, entry long, before long")
    chunks = dealt.where("sums is null").join(F.broadcast(ranges), [NUMBER, PART])  # a row for each task, and for each key in it
    entered = lambda c: F.get(c, F.col("entry").cast("int"))
    chunks = chunks.select(entered("open_rows").alias("n"), entered("open_size").alias("size"), (F.col("entry") - F.col("seen")).alias("entry"), (F.col("before") + entered("begun")).alias("before"), "rows")
    return chunks.mapInArrow(number_rows, T.StructType([*plain.fields, T.StructField("batch", T.LongType())]))


def export_json(rows: DataFrame) -> DataFrame:
    """Rows as JSON text in ``value``: integers exact, numbers that are not finite as null, objects as JSON.

    Refuses repeated column names.
    """
    names = [f.name for f in rows.schema.fields]
    if len(set(names)) < len(names):
        raise ValueError(f"column names repeat: {sorted({n for n in names if names.count(n) > 1})}")
    real = {f.name for f in rows.schema.fields if f.dataType.typeName() in ("double", "float")}
    shown = [F.when(~F.isnan(n) & (F.abs(F.col(n)) != float("inf")), F.col(n)).alias(n) if n in real else F.col(n) for n in names]
    return rows.select(F.to_json(F.struct(*shown), {"ignoreNullFields": "false"}).alias("value"))
