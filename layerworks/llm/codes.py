"""Vector codes by product quantisation, trained with adaptive distance bounds.

Vectors of integers are cut into equal parts, and each part position has a codebook of a few
entries, trained by rounds of k-means (nearest entry, then the floor of the mean).  What a
part has learned of its codebook is persisted between rounds as a row's ``state``: its entry
with an upper bound on the distance, the ``b`` next closest entries in order, each with a lower
bound, and one outer lower bound for all others.  When entries move, the bounds move by as
much; the bound at a place in the order becomes the least of those from there on, so places
whose bound is not above the upper bound are a prefix.  An empty prefix settles the part
without a distance; else only the entry and the prefix are compared, and all entries only if
the outer bound is in doubt.  ``b`` starts at a quarter of the entries and falls, for each
round, to what the round before has needed, but not under an eighth.

Bounds are floating point, rounded outwards, and only ever settle what they separate strictly; all
else is verified in 64-bit integers, ties to the lower index, so that the result is exact.

Each round is one pass over the rows, without a shuffle of them: a task writes the new states
and, as one more row, its sums for each part and entry, which Spark then adds up.  Codebooks
(parts x entries x width integers) are all that the driver holds.  A round's table is deleted
once the next one is written.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerworks.llm.common import forget, written

LIMIT = 1 << 27  # of a scaled component: squared distances of 2**8 of them fit in 64 bits
ROWS = 1 << 14  # that a task works on at a time


class Compressed(NamedTuple):
    """``rows``: vec_id, label, code (a byte for each part), error (long); ``codebooks``:
    integers by part, entry, place."""

    rows: DataFrame
    codebooks: np.ndarray


class State(NamedTuple):
    """Of n parts: ``entry``, an upper bound on its distance; ``ids`` (n x b) of the next
    closest entries with ``lower`` bounds; ``outer`` bounds the rest."""

    entry: np.ndarray
    upper: np.ndarray
    ids: np.ndarray
    lower: np.ndarray
    outer: np.ndarray

    def pack(self, parts: int) -> pa.Array:
        """One binary for each row of ``parts`` parts."""
        n, b = len(self.entry) // parts, self.ids.shape[1]
        up = np.nextafter(self.upper.astype("<f4"), np.float32(np.inf))
        down = [np.nextafter(x.astype("<f4"), np.float32(-np.inf)) for x in (self.lower, self.outer)]
        fields = [self.entry.astype("u1"), up, self.ids.astype("u1"), *down]
        flat = np.concatenate([np.frombuffer(np.ascontiguousarray(x).tobytes(), "u1").reshape(n, parts * size) for x, size in zip(fields, (1, 4, b, 4 * b, 4), strict=True)], 1)
        return fixed(flat)

    @staticmethod
    def unpack(column: pa.Array, parts: int) -> State:
        raw = np.frombuffer(column.buffers()[2], "u1")
        offsets = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + len(column) + 1]
        flat = raw[offsets[0] : offsets[-1]].reshape(len(column), -1)
        b = (flat.shape[1] // parts - 9) // 5
        out, at = [], 0
        for kind, many in (("u1", 1), ("<f4", 1), ("u1", b), ("<f4", b), ("<f4", 1)):
            size = parts * many * np.dtype(kind).itemsize
            x = np.ascontiguousarray(flat[:, at : at + size]).view(kind).reshape(len(column) * parts, many)
            out.append(x.astype(np.int64 if kind == "u1" else np.float64))
            at += size
        return State(out[0][:, 0], out[1][:, 0], out[2], out[3], out[4][:, 0])


def fixed(flat: np.ndarray) -> pa.Array:
    """Rows of bytes as Arrow binaries."""
    n, size = flat.shape
    offsets = pa.py_buffer((np.arange(n + 1, dtype="<i4") * size).tobytes())
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(np.ascontiguousarray(flat).tobytes())])


def squared(x: np.ndarray, part: np.ndarray, entries: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Exact squared distances (n x m) of parts to the entries named for each."""
    out = np.empty(entries.shape, np.int64)
    for j in range(entries.shape[1]):
        out[:, j] = ((x - books[part, entries[:, j]]) ** 2).sum(1)
    return out


def assign(x: np.ndarray, part: np.ndarray, books: np.ndarray, before: State | None, drift: np.ndarray, b: int) -> tuple[State, np.ndarray]:
    """The state with ``b`` ordered entries after entries moved by ``drift`` (by part and
    entry), and how many parts needed 0, 1, ... places of the order (last: all entries)."""
    n, k = len(x), books.shape[1]
    b = min(b, k - 1)
    if before is None:
        have = b
        entry, upper, ids, lower, outer = np.zeros(n, np.int64), np.zeros(n), np.zeros((n, b), np.int64), np.zeros((n, b)), np.zeros(n)
        every, needed = np.arange(n), np.zeros(k + 1, np.int64)
    else:
        have = before.ids.shape[1]
        entry, upper = before.entry.copy(), before.upper + drift[part, before.entry]
        ids, lower = before.ids.copy(), before.lower - drift[part[:, None], before.ids]
        bounds = np.concatenate([lower, (before.outer - drift.max(1)[part])[:, None]], 1)
        bounds = np.minimum.accumulate(bounds[:, ::-1], 1)[:, ::-1]
        lower, outer = bounds[:, :-1].copy(), bounds[:, -1].copy()
        doubt = np.flatnonzero(bounds[:, 0] <= upper)
        own = squared(x[doubt], part[doubt], entry[doubt, None], books)[:, 0]
        upper[doubt] = np.nextafter(np.sqrt(own), np.inf)
        prefix = np.zeros(n, np.int64)
        prefix[doubt] = (bounds[doubt] <= upper[doubt, None]).sum(1)
        needed = np.bincount(np.where(prefix > have, k, prefix), minlength=k + 1)
        for z in range(1, have + 1):
            some = np.flatnonzero(prefix == z)
            if not len(some):
                continue
            near = np.concatenate([entry[some, None], ids[some, :z]], 1)
            d = squared(x[some], part[some], near, books)
            order = np.lexsort((near, d), axis=1)
            near, d = np.take_along_axis(near, order, 1), np.sqrt(np.take_along_axis(d, order, 1))
            entry[some], upper[some] = near[:, 0], np.nextafter(d[:, 0], np.inf)
            ids[some, :z], lower[some, :z] = near[:, 1:], np.nextafter(d[:, 1:], -np.inf)
        every = np.flatnonzero(prefix > have)
        if b < have:
            outer = np.minimum(outer, lower[:, b:].min(1))
            ids, lower = ids[:, :b], lower[:, :b]
    if len(every):
        d = squared(x[every], part[every], np.broadcast_to(np.arange(k), (len(every), k)), books)
        order = np.argsort(d, 1, kind="stable")
        d = np.sqrt(np.take_along_axis(d, order, 1))
        entry[every], upper[every] = order[:, 0], np.nextafter(d[:, 0], np.inf)
        ids[every], lower[every] = order[:, 1 : b + 1], np.nextafter(d[:, 1 : b + 1], -np.inf)
        outer[every] = np.nextafter(d[:, b + 1], -np.inf) if b + 1 < k else np.inf
    return State(entry, upper, ids, lower, outer), needed


def adapted(b: int, needed: np.ndarray, least: int, over: float = 0.01) -> int:
    """The smallest length of the order, from ``least`` to ``b``, which all but a share
    ``over`` of the parts would not have exceeded."""
    beyond = needed.sum() - np.cumsum(needed)
    return next((z for z in range(least, b) if beyond[z] <= over * needed.sum()), b)


def integers(df: DataFrame, vec_id: str, embedding: str, label: str, scale: int) -> DataFrame:
    """(vec_id, label, dim, x: floor(scale * component) as 32-bit integers) of the rows whose vector
    is given and holds finite components only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("x").is_valid())
            v = batch.column("x")
            sizes = v.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null component turns to NaN
            ends = np.cumsum(sizes)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            good = bad[ends] == bad[ends - sizes]
            whole = np.floor(scale * flat[np.repeat(good, sizes)])
            if len(whole) and np.abs(whole).max() >= LIMIT:
                raise ValueError(f"a component of magnitude {LIMIT // scale} or more: squared distances would not fit in a long")
            offsets = np.concatenate([[0], np.cumsum(4 * sizes[good])]).astype("<i4")
            x = pa.Array.from_buffers(pa.binary(), int(good.sum()), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(whole.astype("<i4").tobytes())])
            kept = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([kept.column("vec_id"), kept.column("label"), pa.array(sizes[good].astype(np.int32)), x], names=["vec_id", "label", "dim", "x"])

    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("x"))
    return rows.mapInArrow(run, f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, dim int, x binary")


def first_vectors(rows: DataFrame, many: int) -> list[np.ndarray]:
    """Vectors of the ``many`` smallest ids in order (a null id comes last); of rows that
    share an id, that with the smallest bytes.  A task passes on ``many`` rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int | None, bytes] = {}
        rank = lambda i: (i is None, i or 0)
        for batch in batches:
            ids = batch.column("vec_id")
            order = np.lexsort((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))
            for at in order:
                i = ids[int(at)].as_py()
                if i not in best and len(best) >= many and rank(i) > max(map(rank, best)):
                    break
                x = batch.column("x")[int(at)].as_py()
                best[i] = min(best.get(i, x), x)
                if len(best) > many:
                    del best[max(best, key=rank)]
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int64()), pa.array(list(best.values()), pa.binary())], names=["vec_id", "x"])

    found = rows.select("vec_id", "x").mapInArrow(run, "vec_id long, x binary").groupBy("vec_id").agg(F.min("x").alias("x"))
    return [np.frombuffer(r.x, "<i4").astype(np.int64) for r in found.orderBy(F.col("vec_id").asc_nulls_last()).limit(many).collect()]


def compress(
    df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096
) -> Compressed:
    """Codes of all rows of ``df`` whose vector is given and finite, and the codebooks.

    Codebooks start as the parts of the ``entries`` smallest ids' vectors (fewer, if there are
    fewer ids; see ``first_vectors`` for nulls and repeated ids).  Rows with a null id or label take
    part; repeated rows count as often as they occur.  All vectors are cut alike: rows whose dimension is not that
    of the first vector, or not a multiple of ``parts``, take no part.  A component whose scaled
    magnitude reaches ``LIMIT`` is an error.  An empty table gives no rows and empty codebooks."""
    rows = written(integers(df, vec_id, embedding, label, scale), "integers")
    spark, label_type = df.sparkSession, rows.schema["label"].dataType.simpleString()
    first = first_vectors(rows, entries)
    dim = len(first[0]) if first else 0
    first = [v for v in first if len(v) == dim]
    if not dim or dim % parts:
        empty = spark.createDataFrame([], f"vec_id long, label {label_type}, code binary, error long")
        return Compressed(empty, np.zeros((parts, 0, 0), np.int64))
    width = dim // parts
    books = np.stack(first).reshape(len(first), parts, width).swapaxes(0, 1).copy()
    k = len(first)
    b, least, drift = max(1, k // 4), max(1, k // 8), np.zeros((parts, k))
    table = rows.filter(F.col("dim") == dim).select("vec_id", "label", "x", F.lit(None).cast("binary").alias("state"))
    source = rows
    for r in range(rounds + 1):
        moved = table.mapInArrow(_round(parts, books, drift, b, last=r == rounds), f"vec_id long, label {label_type}, x binary, state binary, error long, sums binary")
        now = written(moved, f"round{r}")
        forget(source)
        source = now
        table = now.filter(F.col("sums").isNull()).select("vec_id", "label", "x", "state")
        if r < rounds:
            count, total, needed = _added(now, parts, k, width)
            new = np.where(count[..., None] > 0, total // np.maximum(count, 1)[..., None], books)
            drift = np.nextafter(np.sqrt(((new - books) ** 2).sum(2)), np.inf)
            books = new
            b = adapted(b, needed, least) if r else b
    return Compressed(now.filter(F.col("sums").isNull()).select("vec_id", "label", F.col("state").alias("code"), "error"), books)


def _round(parts: int, books: np.ndarray, drift: np.ndarray, b: int, last: bool):
    """One round over a task's rows: their new states, and a row with the task's sums; in the
    last round a row's code and error instead."""
    k, width = books.shape[1:]
    names = ["vec_id", "label", "x", "state", "error", "sums"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, needed, kind = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64), np.zeros(k + 1, np.int64), None
        for whole in batches:
            kind = whole.schema.field("label").type
            for at in range(0, len(whole), ROWS):
                batch = whole.slice(at, ROWS)
                n = len(batch)
                x = np.frombuffer(b"".join(batch.column("x").to_pylist()), "<i4").astype(np.int64).reshape(n * parts, width)
                part = np.tile(np.arange(parts), n)
                state, used = assign(x, part, books, None if batch.column("state").null_count else State.unpack(batch.column("state"), parts), drift, b)
                cell = part * k + state.entry
                if last:
                    error = squared(x, part, state.entry[:, None], books).reshape(n, parts).sum(1)
                    kept, code, out = pa.nulls(n, pa.binary()), fixed(state.entry.astype("u1").reshape(n, parts)), pa.array(error)
                else:
                    count += np.bincount(cell, minlength=parts * k).reshape(parts, k)
                    order = np.argsort(cell, kind="stable")
                    starts = np.flatnonzero(np.diff(cell[order], prepend=-1))
                    total.reshape(parts * k, width)[cell[order][starts]] += np.add.reduceat(x[order], starts, 0)
                    needed += used
                    kept, code, out = batch.column("x"), state.pack(parts), pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), kept, code, out, pa.nulls(n, pa.binary())], names=names)
        if kind is not None and not last:
            sums = np.concatenate([count.ravel(), total.ravel(), needed]).astype("<i8").tobytes()
            nulls = [pa.nulls(1, t) for t in (pa.int64(), kind, pa.binary(), pa.binary(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*nulls, pa.array([sums], pa.binary())], names=names)

    return run


def _added(table: DataFrame, parts: int, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, sums and needed places over all tasks' rows of sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for s in batch.column("sums").to_pylist():
                s = np.frombuffer(s, "<i8")
                total = s if total is None else total + s
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "s"])

    found = table.filter(F.col("sums").isNotNull()).select("sums").mapInArrow(run, "i int, s long").groupBy("i").agg(F.sum("s").alias("s")).collect()
    flat = np.zeros(parts * k * (width + 1) + k + 1, np.int64)
    for r in found:
        flat[r.i] = r.s
    count, total, needed = np.split(flat, [parts * k, parts * k * (width + 1)])
    return count.reshape(parts, k), total.reshape(parts, k, width), needed


def label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` and label_error: the errors of all rows with the same label, nulls together."""
    sums = written(rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label_errors")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
