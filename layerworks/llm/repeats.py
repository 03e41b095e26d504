"""Long repeated spans of words, by compacting the De Bruijn graph of their windows.

Every ``window`` consecutive words are an edge of the graph.  An edge's label is the
smallest hash among its shorter k-mers (k = window // 3), which equal edges share; a run
of consecutive edges whose label sits on the same words is a path, and travels as one row
(label, hash of its edges, source, first edge, number of edges) instead of one per edge.

1. Labels that occur once belong to edges that occur once: such paths go (join on labels).
2. Paths found twice or more are repeated as a whole: the nonbranching case, settled
   without looking at their edges.
3. Where a label has a path found once beside others, the graph branches: one source of
   each distinct path is unrolled into its edges, which are counted one by one; a path's
   multiplicity counts for each of its edges.
4. Source coordinates (document, first word, length) of all repeated edges are gathered
   per document, and the words they cover are removed.

Edges are compared by 128 bits (label and edge hash); step 3 checks a path's hash anew
at its source before using it.  Rows of a hot label are joined, never grouped in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerworks.llm.common import row_key, signed, span_hash, text_slices, window_hashes, word_table, written

KEY = ["_llm_id", "_llm_th"]


def labels(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(label, place of its leftmost k-mer) of every window of ``window`` words."""
    k = window // 3
    value = window_hashes(words, k)
    place = np.arange(len(value))
    span, width = 1, window - k + 1
    while span < width:
        step = min(span, width - span)
        left = value[:-step] <= value[step:]
        value, place = np.where(left, value[:-step], value[step:]), np.where(left, place[:-step], place[step:])
        span += step
    return value, place


def paths(row: np.ndarray, words: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(row, label, path hash, first word of the first window, number of windows) of all paths."""
    n = len(words) - window + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z.astype(np.uint64), z, z
    label, place = labels(words, window)
    edge = window_hashes(words, window)
    whole = row[:n] == row[window - 1 :]  # windows do not cross texts
    at = np.flatnonzero(whole)
    new = np.ones(len(at), bool)
    new[1:] = (place[at[1:]] != place[at[:-1]]) | (at[1:] != at[:-1] + 1)
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(at)))
    first = at[start]
    return row[first], label[first], span_hash(edge, first, first + size), first, size


def _spread(out: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def repeated_spans(df: DataFrame, window: int = 35) -> DataFrame:
    """(_llm_id, _llm_th, _llm_spans): for each row key of ``df`` (see ``common.row_key``; column
    ``text``) with repeated windows, structs (start, n) of words to remove."""
    docs = df.select(*KEY, "text")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole):
                row, words, _, _ = word_table(b.column("text"))
                r, label, path, first, size = paths(row, words, window)
                base = np.searchsorted(row, r)  # a text's first word in the table
                key = [b.column(k).take(pa.array(r)) for k in KEY]
                yield pa.RecordBatch.from_arrays(
                    [signed(label), signed(path), *key, pa.array((first - base).astype(np.int32)), pa.array(size.astype(np.int32))],
                    names=["label", "path", *KEY, "first", "n"],
                )

    found = docs.mapInArrow(emit, "label long, path long, _llm_id long, _llm_th long, first int, n int")
    # counts are written before a join needs them: a side that is a plain shuffle of its rows
    # lets Spark split a hot label among tasks, an aggregate beside it would not
    twice = written(found.groupBy("label").agg(F.count("*").alias("_c")).filter("_c > 1").select("label"), "twice")
    held = written(found.join(twice, "label"), "paths")

    kinds = written(
        held.groupBy("label", "path").agg(F.count("*").alias("times"), F.min(F.struct(*KEY, "first", "n")).alias("at")), "kinds"
    )
    branching = written(kinds.groupBy("label").agg(F.min("times").alias("_m")).filter("_m = 1").select("label"), "branching")
    unroll = (
        kinds.join(branching, "label")
        .select("label", "path", "times", "at.*")
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("first", "n", "label", "path", "times")).alias("asked"))
    )
    unroll = written(unroll, "unroll")  # so that rows equal in id and text, which meet it, can be split

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole):
                row, words, _, _ = word_table(b.column("text"))
                edge = window_hashes(words, window)
                base = np.searchsorted(row, np.arange(len(b)))
                asked = b.column("asked")
                of = asked.flatten()
                col = {c: of.field(c).to_numpy(zero_copy_only=False) for c in ("first", "n", "label", "path", "times")}
                owner = np.repeat(np.arange(len(b)), np.diff(asked.offsets.to_numpy()))
                first, size = base[owner] + col["first"], col["n"].astype(np.int64)
                same = first + size <= len(edge)
                same[same] &= span_hash(edge, first[same], (first + size)[same]).view(np.int64) == col["path"][same]
                first, size, owner = first[same], size[same], owner[same]
                step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                at, who = np.repeat(first, size) + step, np.repeat(owner, size)
                key = [b.column(k).take(pa.array(who)) for k in KEY]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(col["label"][same], size)),
                        signed(edge[at]),
                        pa.array(np.repeat(col["times"][same], size)),
                        *key,
                        pa.array((at - base[who]).astype(np.int32)),
                    ],
                    names=["label", "edge", "times", *KEY, "first"],
                )

    single = written(
        docs.join(unroll, KEY).select(*KEY, "text", "asked").mapInArrow(edges, "label long, edge long, times long, _llm_id long, _llm_th long, first int"),
        "edges",
    )
    often = written(single.groupBy("label", "edge").agg(F.sum("times").alias("_c")).filter("_c > 1").select("label", "edge"), "often")
    by_edge = single.filter("times = 1").join(often, ["label", "edge"]).select(*KEY, "first", F.lit(1).alias("n"))
    by_path = held.join(kinds.filter("times > 1").select("label", "path"), ["label", "path"]).select(*KEY, "first", "n")
    spans = by_path.unionByName(by_edge).select(*KEY, F.struct(F.col("first").alias("start"), (F.col("n") + window - 1).alias("n")).alias("span"))
    return written(spans.groupBy(*KEY).agg(F.collect_set("span").alias("_llm_spans")), "spans")


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 35) -> DataFrame:
    """Adds ``n_words``, ``n_removed`` and ``kept`` (kept words joined by one space) to the
    rows of ``df``; its own columns of these names are replaced, all others stay.

    A word goes if a window of ``window`` words that covers it starts anywhere else too, the
    same text included; all is judged on the input, so a passage goes everywhere it stands.
    Null or empty text has no words and an empty ``kept``.  Texts shorter than a window keep
    all words.  Repeated rows are texts of their own (each repeats the other).  Null ids are
    ids like any other.  Texts of any length are read whole; an empty table stays empty."""
    new = ("n_words", "n_removed", "kept")
    base = df.drop(*[c for c in df.columns if c in new])
    keyed = base.select("*", *row_key(base, doc_id, text))
    spans = repeated_spans(keyed.select(*KEY, F.col(text).alias("text")), window)
    own = base.columns

    def strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, text):
                counts, removed, kept = [], [], []
                for t, s in zip(b.column(text).to_pylist(), b.column("_llm_spans").to_pylist(), strict=True):
                    words = (t or "").encode().split()
                    counts.append(len(words))
                    if s:
                        edge = np.zeros(len(words) + 1, np.int64)
                        for p in s:
                            edge[p["start"]] += 1
                            edge[p["start"] + p["n"]] -= 1
                        words = list(compress(words, np.cumsum(edge[:-1]) == 0))
                    removed.append(counts[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [*map(b.column, own), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=[*own, *new]
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema) + ", n_words long, n_removed long, kept string"
    return keyed.join(spans, KEY, "left").select(*own, "_llm_spans").mapInArrow(strike, schema)
