"""Near-duplicate lines by deletion neighbourhoods over words.

Lines are compared as word sequences (white space does not count).  Equal lines are
counted first.  Two lines of ``min_words`` words or more are near duplicates if one
inserted, deleted or replaced word makes them equal; shorter ones must be equal.

1. One such edit leaves the first or the last half of both lines equal.  Only a distinct
   line that shares a half with another goes on; none within the bound is lost.
2. Those emit all variants within the bound: the line without each one of its words, as
   128-bit keys.  Lines of equal length that share a variant at the same place differ
   in that word; a variant equal to a whole line is one word longer than it.
3. Each key is resolved by aggregation to its earliest line, so a key of any size gives
   as many links as it has members.  Links are verified on the words themselves.

A line goes if an earlier line is equal or near; the order is document id (null last), then
line number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerworks.llm.common import _OVER_WORDS, mix, signed, span_hash, tag_hash, text_bytes, text_slices, word_table, written

KEY = ["_llm_id", "_llm_th"]
LINE = ["k1", "k2"]
_SECOND = np.uint64(0xA5A5_1234_9E37_79B9)


def _second(words: np.ndarray) -> np.ndarray:
    """Independent word hashes for the keys' other 64 bits."""
    return mix(words ^ _SECOND)


def line_table(text: pa.Array) -> tuple[np.ndarray, ...]:
    """(row, line number, word hashes, first word, end word) of all lines with a word."""
    data, offsets = text_bytes(text)
    row, words, start, _ = word_table(text)
    breaks = np.flatnonzero(data == 10)
    before = np.searchsorted(breaks, start)
    number = before - np.searchsorted(breaks, offsets[row])
    new = np.ones(len(words), bool)
    new[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1])
    first = np.flatnonzero(new)
    return row[first], number[first], words, first, np.append(first[1:], len(words))


def halves(words: np.ndarray, first: np.ndarray, end: np.ndarray, min_words: int) -> pa.Array:
    """Per line, keys of its first and last h words, for h of its own and of a partner one
    word shorter; none for lines below ``min_words``."""
    n = end - first
    h1, h2 = n // 2, (n - 1) // 2
    sets = []
    for h, ok in ((h1, n >= min_words), (h2, (n > min_words) & (h2 != h1))):
        h = np.minimum(h, n)
        sets += [(tag_hash(span_hash(words, first, first + h), 2 * h), ok), (tag_hash(span_hash(words, end - h, end), 2 * h + 1), ok)]
    keys, use = np.stack([s[0] for s in sets], 1), np.stack([s[1] for s in sets], 1)
    offsets = np.append(0, np.cumsum(use.sum(1))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), signed(keys[use]))


def variants(words: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each line without one of its words, one for each word of the table; equals
    ``span_hash`` of the shortened line."""
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _OVER_WORDS.up(len(words)), out=sums[1:])
    down = _OVER_WORDS.down(len(words) + 1)
    size = end - first
    i = np.arange(len(words)) if len(words) else np.zeros(0, np.int64)
    s, e = np.repeat(first, size), np.repeat(end, size)
    left = (sums[i] - sums[s]) * down[s]
    right = (sums[e] - sums[i + 1]) * down[s] * np.uint64(_OVER_WORDS.inverse)
    return mix(left + right + (e - s - 1).astype(np.uint64))


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether one inserted, deleted or replaced word, or none, turns a into b."""
    if abs(len(a) - len(b)) > 1:
        return False
    n = min(len(a), len(b))
    head = next((i for i in range(n) if a[i] != b[i]), n)
    tail = next((i for i in range(n - head) if a[-1 - i] != b[-1 - i]), n - head)
    return head + tail >= max(len(a), len(b)) - 1


def duplicate_lines(df: DataFrame, min_words: int = 10) -> DataFrame:
    """(_llm_id, _llm_th, _llm_gone): for each row key of ``df`` (columns _llm_id, _llm_th, text) with lines to
    remove, the sorted numbers of those lines."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole):
                row, number, words, first, end = line_table(b.column("text"))
                other = _second(words)
                keys = [b.column(k).take(pa.array(row)) for k in KEY]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array(number.astype(np.int32)), signed(span_hash(words, first, end)), signed(span_hash(other, first, end)), halves(words, first, end, min_words)],
                    names=[*KEY, "line", *LINE, "halves"],
                )

    docs = df.select(*KEY, "text")
    lines = written(docs.mapInArrow(emit, "_llm_id long, _llm_th long, line int, k1 long, k2 long, halves array<long>"), "lines")
    place = F.struct("_llm_id", "line", "_llm_th").alias("place")
    distinct = written(lines.groupBy(*LINE).agg(F.min(place).alias("place"), F.any_value("halves").alias("halves")), "distinct")

    half = distinct.select(*LINE, F.explode("halves").alias("half"))
    # aggregates are written before a join needs them: a side that is a plain shuffle of its
    # rows lets Spark split a hot key among tasks, an aggregate or join beside it would not
    shared = written(half.groupBy("half").agg(F.count("*").alias("_c")).filter("_c > 1").select("half"), "shared")
    near = half.join(shared, "half").select(*LINE).distinct()
    asked = (
        distinct.join(near, LINE)
        .groupBy(F.col("place._llm_id").alias("_llm_id"), F.col("place._llm_th").alias("_llm_th"))
        .agg(F.collect_list(F.struct(F.col("place.line").alias("line"), *LINE)).alias("asked"))
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole):
                out = []
                for i, t, wanted in zip(b.column("_llm_id").to_pylist(), b.column("text").to_pylist(), b.column("asked").to_pylist(), strict=True):
                    parts = t.encode().split(b"\n")
                    out += [(w["k1"], w["k2"], i, w["line"], b" ".join(parts[w["line"]].split()).decode()) for w in wanted]
                yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*out, strict=True), strict=True)) if out else {n: [] for n in names}, schema=kinds)

    names = [*LINE, "at", "line", "words"]
    kinds = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int64()), ("line", pa.int32()), ("words", pa.string())])
    # written, so that rows equal in id and text, which meet it, can be split
    some = docs.join(written(asked, "asked"), KEY).select("_llm_id", "text", "asked").mapInArrow(read, "k1 long, k2 long, at long, line int, words string")
    # rows equal in id and text bring the same line twice
    some = written(some.dropDuplicates(LINE), "near")

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "words"):
                row, words, _, _ = word_table(b.column("words"))
                first = np.searchsorted(row, np.arange(len(b)))
                end = np.append(first[1:], len(words))
                keys = [b.column(k).take(pa.array(row)) for k in (*LINE, "at", "line")]
                v1, v2 = variants(words, first, end), variants(_second(words), first, end)
                yield pa.RecordBatch.from_arrays(
                    [*keys, signed(v1), signed(v2), pa.array((np.arange(len(words)) - first[row]).astype(np.int32)), pa.array((end - first)[row].astype(np.int32))],
                    names=[*LINE, "at", "line", "v1", "v2", "pos", "n"],
                )

    cut = some.mapInArrow(shorten, "k1 long, k2 long, at long, line int, v1 long, v2 long, pos int, n int")
    cut = written(cut.filter(F.col("n") >= min_words), "variants")
    me = F.struct(F.col("at").alias("_llm_id"), "line", *LINE)
    same = ["v1", "v2", "pos", "n"]
    least = written(cut.groupBy(*same).agg(F.min(me).alias("first"), F.count("*").alias("_c")).filter("_c > 1").drop("_c"), "least")
    replaced = cut.join(least, same).select(me.alias("b"), F.col("first").alias("a")).filter("a <> b")
    shorter = some.select(F.col("k1").alias("v1"), F.col("k2").alias("v2"), me.alias("s"))
    longer = cut.filter(F.col("n") > min_words).join(shorter, ["v1", "v2"]).select(me.alias("b"), F.col("s").alias("a"))
    pairs = replaced.unionByName(longer).distinct()
    text = some.select(F.struct(*LINE).alias("k"), "words")
    both = (
        pairs.select("a", "b", F.struct("a.k1", "a.k2").alias("ka"), F.struct("b.k1", "b.k2").alias("kb"))
        .join(text.select(F.col("k").alias("ka"), F.col("words").alias("wa")), "ka")
        .join(text.select(F.col("k").alias("kb"), F.col("words").alias("wb")), "kb")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = [within_one(x.encode().split(), y.encode().split()) for x, y in zip(b.column("wa").to_pylist(), b.column("wb").to_pylist(), strict=True)]
            yield b.select(["k1", "k2"]).filter(pa.array(good, pa.bool_()))

    later = F.greatest("a", "b")
    late = both.select("wa", "wb", later["k1"].alias("k1"), later["k2"].alias("k2")).mapInArrow(verify, "k1 long, k2 long").distinct()
    known = written(distinct.select(*LINE, "place").join(late.withColumn("near", F.lit(True)), LINE, "left"), "known")
    gone = lines.select(*KEY, "line", *LINE).join(known, LINE).filter("near or _llm_id <> place._llm_id or line <> place.line")
    return written(gone.groupBy(*KEY).agg(F.sort_array(F.collect_set("line")).alias("_llm_gone")), "gone")


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 10, keep_text: bool = True) -> DataFrame:
    """Adds ``n_lines`` (``\\n``-split pieces), ``n_removed``, ``removed`` (their numbers, from 0)
    and ``kept`` (the text without them) to the rows of ``df``; its own columns of these names
    are replaced.

    ``keep_text=False`` leaves out the text and ``kept``, and so does not move texts for them.

    Lines without a word always stay, as does the first of each class.  Null text: no lines,
    null ``kept``; empty text: one line without a word.  Rows that share an id and text are the same place (both keep what
    is first there); rows that share an id only are ordered by line number, and equal line
    numbers of theirs count as one place.  Null ids come last.  Texts and lines of any length are read whole; an
    empty table stays empty."""
    new = ("n_lines", "n_removed", "removed", "kept")
    base = df.drop(*[c for c in df.columns if c in new])
    key = [F.coalesce(F.col(doc_id), F.lit(2**63 - 1)).alias("_llm_id"), F.xxhash64(F.col(text)).alias("_llm_th")]
    keyed = base.select("*", *key)
    gone = duplicate_lines(keyed.select(*KEY, F.col(text).alias("text")), min_words)
    found = keyed.join(gone, KEY, "left").withColumn("removed", F.coalesce("_llm_gone", F.array().cast("array<int>")))
    counted = found.withColumns(
        {
            "n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.length(text) - F.length(F.translate(text, "\n", "")) + 1).cast("long"),
            "n_removed": F.size("removed").cast("long"),
        }
    )
    own = [*[c for c in base.columns if keep_text or c != text], *new[:3]]
    if not keep_text:
        return counted.select(*own)
    counted = counted.select(*own)

    def strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, text):
                kept = []
                for t, r in zip(b.column(text).to_pylist(), b.column("removed").to_pylist(), strict=True):
                    drop = set(r)
                    kept.append("\n".join(x for i, x in enumerate(t.split("\n")) if i not in drop) if drop else t)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(kept, pa.string())], names=[*own, "kept"])

    return counted.mapInArrow(strike, T.StructType([*counted.schema.fields, T.StructField("kept", T.StringType())]))
