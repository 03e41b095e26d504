"""Nearest neighbours by stable projections: a tiny index, searched until a chi-square test.

Vectors are projected to ``PROJECTED`` dimensions by Gaussian (2-stable) directions: for a
difference v, |projected v|^2 / |v|^2 follows a chi-square law with that many degrees of freedom,
whatever the original dimension.  Projections are indexed by a kd-tree.  A query takes its leaves in
order of projected distance, verifies their rows on the original vectors, and stops when a row as near as its
k-th best so far would, with probability ``confidence``, have been met already.

The tree has two levels.  Its top is fitted on a bounded sample (``SAMPLE`` rows of smallest hash): at
most ``SAMPLE / 16`` cells, of about ``BLOCK_ROWS`` rows where that many suffice.  All rows are dealt to cells, a cell's rows
to blocks by hash (equal vectors fill as many as they need), and each block has a tree of its own with leaves
of ``LEAF`` rows.  Queries go to their nearest cell first, then in rounds to the next 4, 16, ... of
their order whose box passes the test at the k-th best score so far; a query that no cell passes for is done.
Boxes of cells are the only part of the index that the driver holds.

Inner products become distances by one more coordinate: with M the largest norm, row x gets
sqrt(M^2 - |x|^2), and query q is scaled to norm M and gets 0; then |q - x|^2 falls as the
product grows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerworks.llm.chisquare import chi2_quantile
from layerworks.llm.common import forget, written

PROJECTED = 8
LEAF = 16
BLOCK_ROWS = 4096
CHUNK = 512
SAMPLE = 20_000
TURN = 16  # leaves that a query takes between two tests
GROWTH = 4
CONFIDENCE = 0.5


def directions(dim: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim + 1, PROJECTED))


def projected(vectors: np.ndarray, most: float) -> np.ndarray:
    """Projections of rows with their further coordinate."""
    rest = np.sqrt(np.maximum(most**2 - (vectors**2).sum(1), 0))
    return np.column_stack([vectors, rest]) @ directions(vectors.shape[1])


def asked_at(queries: np.ndarray, most: float) -> np.ndarray:
    """Projections of queries scaled to the largest norm."""
    return (queries * (most / np.sqrt((queries**2).sum(1)))[:, None]) @ directions(queries.shape[1])[:-1]


def gaps(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared projected distances of queries to boxes."""
    return (np.maximum(np.maximum(low[None] - at[:, None], at[:, None] - high[None]), 0) ** 2).sum(2)


def reach(queries: np.ndarray, kth: np.ndarray, most: float, confidence: float) -> np.ndarray:
    """Squared projected distance up to which boxes are worth a visit, given k-th best scores."""
    far = 2 * most**2 - 2 * most / np.sqrt((queries**2).sum(1)) * np.where(np.isfinite(kth), kth, 0)
    return np.where(np.isfinite(kth), chi2_quantile(confidence, PROJECTED) * np.maximum(far, 0), np.inf)


def leaves(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """Rows of a kd-tree's leaves: the widest dimension is halved at its median, again and again."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        p = points[rows]
        axis = int(np.argmax(p.max(0) - p.min(0)))
        order = np.argpartition(p[:, axis], len(rows) // 2)
        todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return out


class Top(NamedTuple):
    """Splits of the tree's top: node n halves ``axis`` at ``cut``; its sides are nodes, or cells as ~cell."""

    axis: np.ndarray
    cut: np.ndarray
    sides: np.ndarray

    def cells(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64) if len(self.axis) else np.full(len(points), -1)
        while (at >= 0).any():
            some = np.flatnonzero(at >= 0)
            n = at[some]
            at[some] = self.sides[n, (points[some, self.axis[n]] >= self.cut[n]).astype(int)]
        return ~at


def top_of(points: np.ndarray, cells: int) -> Top:
    """A tree of ``cells`` cells at most, largest node first, over a sample of projections."""
    axes, cuts, sides, todo, made = [], [], [], [(np.arange(len(points)), -1, 0)], 0
    while todo:
        todo.sort(key=lambda x: len(x[0]))
        rows, parent, side = todo.pop()
        p = points[rows]
        axis = int(np.argmax(p.max(0) - p.min(0))) if len(rows) else 0
        cut = np.median(p[:, axis]) if len(rows) else 0.0
        right = p[:, axis] >= cut if len(rows) else np.zeros(0, bool)
        if made + len(todo) + 1 < cells and right.any() and not right.all():
            node = len(axes)
            axes.append(axis), cuts.append(cut), sides.append([0, 0])
            todo += [(rows[~right], node, 0), (rows[right], node, 1)]
        else:
            node, made = ~made, made + 1
        if parent >= 0:
            sides[parent][side] = node
    return Top(np.array(axes, np.int64), np.array(cuts), np.array(sides, np.int64).reshape(-1, 2))


class Block:
    """Rows of one block with the kd-tree of their projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, most: float):
        self.ids, self.vectors, self.most = ids, vectors, most
        self.repeated = len(np.unique(ids)) < len(ids)
        points = projected(vectors, most)
        found = leaves(points)
        self.low = np.stack([points[r].min(0) for r in found])
        self.high = np.stack([points[r].max(0) for r in found])
        width = max(map(len, found))
        self.rows = np.full((len(found), width), -1)
        for i, r in enumerate(found):
            self.rows[i, : len(r)] = np.sort(r)
        self.leaves = vectors[self.rows]
        self.visited = 0

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, confidence: float, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query index, vec_id, score) of the best k rows found for each query, its own id left
        out; ``floor``: scores below which nothing is asked for any more."""
        n, width = len(queries), self.rows.shape[1]
        floor = np.full(n, -np.inf) if floor is None else floor
        box = gaps(asked_at(queries, self.most), self.low, self.high)
        order = np.argsort(box, 1, kind="stable")
        best = np.full((n, k), -np.inf)
        who = np.full((n, k), -1)
        live = np.arange(n)
        for r in range(0, order.shape[1], TURN):
            leaf = order[live, r : r + TURN]
            go = box[live[:, None], leaf] < reach(queries[live], np.maximum(best[live, -1], floor[live]), self.most, confidence)[:, None]
            live, leaf, go = live[go[:, 0]], leaf[go[:, 0]], go[go[:, 0]]
            if not len(live):
                break
            score = np.full((*leaf.shape, width), -np.inf)
            q, t = np.nonzero(go)
            turn = np.argsort(leaf[q, t], kind="stable")  # queries that take the same leaf share a product
            for part in np.split(turn, np.flatnonzero(np.diff(leaf[q, t][turn])) + 1):
                # einsum adds in one order for every pair, so equal vectors tie exactly
                score[q[part], t[part]] = np.einsum("qd,ld->ql", queries[live[q[part]]], self.leaves[leaf[q[part[0]], t[part[0]]]])
            self.visited += len(q)
            rows = self.rows[leaf].reshape(len(live), -1)
            score = score.reshape(len(live), -1)
            score[(rows < 0) | (self.ids[rows] == ids[live][:, None])] = -np.inf
            better = (score >= np.maximum(best[live, -1], floor[live])[:, None]).any(1)
            some, new = live[better], score[better]
            all_score = np.concatenate([best[some], new], 1)
            all_rows = np.concatenate([who[some], rows[better]], 1)
            all_ids = np.where(all_rows < 0, np.iinfo(np.int64).max, self.ids[all_rows])
            if self.repeated:  # an id's best row stands for it; its other rows take no place among the k
                by = np.lexsort((-all_score, all_ids), axis=1)
                sorted_ids = np.take_along_axis(all_ids, by, 1)
                again = np.zeros(all_ids.shape, bool)
                np.put_along_axis(again, by[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], 1)
                all_score = np.where(again, -np.inf, all_score)
            rank = np.lexsort((all_ids, -all_score), axis=1)[:, :k]
            best[some] = np.take_along_axis(all_score, rank, 1)
            who[some] = np.take_along_axis(all_rows, rank, 1)
        q, j = np.nonzero(np.isfinite(best) & (best >= floor[:, None]))
        return q, self.ids[who[q, j]], best[q, j]


def usable(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v array<double>) of rows that take part: id and vector given, all components
    finite, not all zero; rows equal in both count once."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    return rows.dropDuplicates()


def _flat(batch: pa.RecordBatch, column: str, dim: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), dim)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        yield int(dim), batch.filter(pa.array(dims == dim))


_P = [f"p{i}" for i in range(PROJECTED)]


def _with_points(rows: DataFrame, most: dict[int, float], tops: dict[int, Top] | None) -> DataFrame:
    """Rows with their projections, or with their cells as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, b in _by_dim(batch):
                points = projected(_flat(b, "v", dim), most[dim])
                columns = [pa.array(points[:, i]) for i in range(PROJECTED)]
                cell = [] if tops is None else [pa.array(tops[dim].cells(points))]
                yield pa.RecordBatch.from_arrays([*map(b.column, ("dim", "vec_id", "v")), *columns, *cell], names=["dim", "vec_id", "v", *_P, *(["cell"] if cell else [])])

    schema = "dim int, vec_id long, v array<double>, " + ", ".join(f"{p} double" for p in _P)
    return rows.select("dim", "vec_id", "v").mapInArrow(run, schema + ("" if tops is None else ", cell long"))


def _pack_rows(rows: DataFrame) -> DataFrame:
    """One row for each (dim, cell, part): ids and vectors as bytes."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        ids, flat = table.column("vec_id").to_numpy(), table.column("v").combine_chunks().flatten().to_numpy()
        return pa.table({"dim": [key[0].as_py()], "cell": [key[1].as_py()], "part": [key[2].as_py()], "ids": [ids.astype("<i8").tobytes()], "vectors": [flat.astype("<f8").tobytes()]}, schema=pa.schema([("dim", pa.int32()), ("cell", pa.int64()), ("part", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())]))

    return rows.groupBy("dim", "cell", "part").applyInArrow(pack, "dim int, cell long, part long, ids binary, vectors binary")


def _next_cells(state: DataFrame, boxes: dict[int, tuple], most: dict[int, float], start: int, many: int, confidence: float) -> DataFrame:
    """(dim, cell, query_id, hash, v, kth) for the cells at places start.. of each query's order whose
    box is within its reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, b in _by_dim(batch):
                if dim not in boxes or start >= len(boxes[dim][0]):
                    continue
                cells, low, high = boxes[dim]
                for at in range(0, len(b), CHUNK):
                    part = b.slice(at, CHUNK)
                    queries, kth = _flat(part, "v", dim), part.column("kth").to_numpy(zero_copy_only=False)
                    box = gaps(asked_at(queries, most[dim]), low, high)
                    order = np.argsort(box, 1, kind="stable")[:, start : start + many]
                    near = np.take_along_axis(box, order, 1) < reach(queries, kth, most[dim], confidence)[:, None]
                    q, t = np.nonzero(near)
                    out = part.take(pa.array(q))
                    yield pa.RecordBatch.from_arrays([out.column("dim"), pa.array(cells[order[q, t]]), *map(out.column, ("query_id", "hash", "v", "kth"))], names=["dim", "cell", "query_id", "hash", "v", "kth"])

    return state.mapInArrow(run, "dim int, cell long, query_id long, hash long, v array<double>, kth double")


def _pack_asked(asked: DataFrame, chunks: int) -> DataFrame:
    """Queries of a cell in chunks of about ``CHUNK``, as bytes."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("query_id", "ascending"), ("hash", "ascending")])
        flat = table.column("v").combine_chunks().flatten().to_numpy()
        fields = [table.column("query_id").to_numpy().astype("<i8"), table.column("hash").to_numpy().astype("<i8"), flat.astype("<f8"), table.column("kth").to_numpy().astype("<f8")]
        return pa.table({"dim": [key[0].as_py()], "cell": [key[1].as_py()], **{n: [f.tobytes()] for n, f in zip(("q_ids", "q_hashes", "q_vectors", "q_kth"), fields, strict=True)}}, schema=pa.schema([("dim", pa.int32()), ("cell", pa.int64()), ("q_ids", pa.binary()), ("q_hashes", pa.binary()), ("q_vectors", pa.binary()), ("q_kth", pa.binary())]))

    dealt = asked.withColumn("chunk", F.pmod(F.xxhash64("query_id", "hash"), F.lit(chunks)))
    return dealt.groupBy("dim", "cell", "chunk").applyInArrow(pack, "dim int, cell long, q_ids binary, q_hashes binary, q_vectors binary, q_kth binary")


def _found(sent: DataFrame, index: DataFrame, most: dict[int, float], k: int, confidence: float) -> DataFrame:
    """(query_id, hash, vec_id, score) of the best in each block that a chunk of queries is sent to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for b in batches:
            for i in range(len(b)):
                r = {c: b.column(c)[i].as_py() for c in ("dim", "cell", "part", "q_ids", "q_hashes", "q_vectors", "q_kth")}
                if key != (r["dim"], r["cell"], r["part"]):
                    ids, vectors = (b.column(c)[i].as_py() for c in ("ids", "vectors"))
                    key, block = (r["dim"], r["cell"], r["part"]), Block(np.frombuffer(ids, "<i8"), np.frombuffer(vectors, "<f8").reshape(-1, r["dim"]), most[r["dim"]])
                ids, hashes, kth = np.frombuffer(r["q_ids"], "<i8"), np.frombuffer(r["q_hashes"], "<i8"), np.frombuffer(r["q_kth"], "<f8")
                q, found, score = block.search(ids, np.frombuffer(r["q_vectors"], "<f8").reshape(-1, r["dim"]), k, confidence, kth)
                yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(hashes[q]), pa.array(found), pa.array(score)], names=["query_id", "hash", "vec_id", "score"])

    return sent.join(index, ["dim", "cell"]).mapInArrow(run, "query_id long, hash long, vec_id long, score double")


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The best k of each query with their ranks; a vec_id counts once, by its best score."""
    each = found.groupBy(*by, "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(df: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", confidence: float = CONFIDENCE) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): for each row of ``queries`` the ``k`` rows of
    ``df`` with the largest inner product that were found, ties to the smaller id.

    Rows with a null id, or a vector that is null, zero or holds null or non-finite
    components, take no part; so do rows of another dimension than the query's.  Rows with the query's id are its own.
    Repeated rows count once; an id with several vectors counts once, by its best score (an asked id's vectors
    are all asked); an empty table gives an empty result.  There are few dimensions in a table: the
    top of the tree is fitted, and its boxes are held, for each."""
    rows = written(usable(df, vec_id, embedding).withColumn("dim", F.size("v")), "vectors")
    asked = usable(queries, vec_id, embedding).select(F.size("v").alias("dim"), F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("hash"), "v")
    state = written(asked.withColumn("kth", F.lit(float("-inf"))), "asked")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    sizes = {r.dim: r for r in rows.join(state.select("dim").distinct(), "dim", "left_semi").groupBy("dim").agg(F.max(norm).alias("most"), F.count("*").alias("n")).collect()}
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return df.sparkSession.createDataFrame([], schema)
    rows = rows.filter(F.col("dim").isin(list(sizes)))
    most = {dim: r.most for dim, r in sizes.items()}
    chosen = rows.withColumn("_n", F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("vec_id", "v"), "vec_id"))).filter(F.col("_n") <= SAMPLE)
    sample: dict[int, list] = {}
    for r in _with_points(chosen, most, None).select("dim", *_P).collect():  # SAMPLE rows of PROJECTED numbers for each dimension
        sample.setdefault(r.dim, []).append(r[1:])
    tops = {dim: top_of(np.array(sample[dim]), min(-(-sizes[dim].n // BLOCK_ROWS), max(1, SAMPLE // 16))) for dim in sizes}
    dealt = written(_with_points(rows, most, tops), "dealt")
    boxes = dealt.groupBy("dim", "cell").agg(F.count("*").alias("n"), *[F.min(p).alias(f"low_{p}") for p in _P], *[F.max(p).alias(f"high_{p}") for p in _P]).collect()
    held: dict[int, tuple] = {}
    for dim in sizes:
        own = sorted((b for b in boxes if b.dim == dim), key=lambda b: b.cell)
        held[dim] = np.array([b.cell for b in own]), np.array([[b[f"low_{p}"] for p in _P] for b in own]), np.array([[b[f"high_{p}"] for p in _P] for b in own])
    parts = df.sparkSession.createDataFrame([(b.dim, b.cell, -(-b.n // BLOCK_ROWS)) for b in boxes], "dim int, cell long, parts long")
    # one row for each cell, at most SAMPLE / 16 for each dimension
    placed = dealt.join(F.broadcast(parts), ["dim", "cell"]).select("dim", "cell", "vec_id", "v", F.pmod(F.xxhash64("vec_id", "v"), "parts").alias("part"))
    index = written(_pack_rows(placed), "index")
    forget(dealt)
    chunks = max(1, -(-state.count() // CHUNK))
    best, start, many = None, 0, 1
    while start < max(len(h[0]) for h in held.values()):
        sent = written(_next_cells(state, held, most, start, many, confidence), "sent")
        if sent.isEmpty():
            break
        found = _found(_pack_asked(sent, chunks), index, most, k, confidence)
        found = found if best is None else found.unionByName(best.drop("rank"))
        best = written(_best(found, ["query_id", "hash"], k), "best")
        kth = best.filter(F.col("rank") == k).select("query_id", "hash", F.col("score").alias("kth"))
        state = written(state.drop("kth").join(kth, ["query_id", "hash"], "left").select("dim", "query_id", "hash", "v", F.coalesce("kth", F.lit(float("-inf"))).alias("kth")), "state")
        start, many = start + many, many * GROWTH
    return _best(best, ["query_id"], k).select("query_id", "rank", "vec_id", "score")
