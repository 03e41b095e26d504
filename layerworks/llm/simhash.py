"""Near duplicates by SimHash: fingerprints, and links of at most ``radius`` differing bits.

Fingerprints are split into blocks; two that differ in ``radius`` bits at most agree in
all but ``radius`` blocks, so they meet in a bucket keyed by some choice of
blocks - ``radius`` blocks.  A bucket holds distinct fingerprints only, which agree in
the key's bits: with 64 bits in 6 blocks and radius 2 some 42 bits are fixed and a bucket
has 2**22 members at most, however many copies a text has.

Inside a bucket members stand vertically: one bit plane per bit position, 64 members to a
word.  A member is compared with all at once: planes are XORed with its bit and added to
counters held as bit slices (carry-save: ones, twos, and an overflow that sticks).  A block
of members is given up as soon as each of its members has overflowed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerworks.llm.common import text_slices, written
from layerworks.llm.components import components

BITS = 64
BLOCKS = 6


def fingerprint(text: str | None, width: int = 3) -> int:
    """Majority of the XXH64 (seed 42) bits of a text's word shingles, A-Z in lower case."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, 42) for s in shingles], np.uint64)
    return majority(h)


def majority(h: np.ndarray) -> int:
    """Bits set in more than half of the values; counted in slices of bounded memory."""
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 1 << 14):
        part = np.ascontiguousarray(h[i : i + (1 << 14)].astype("<u8")).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * counts > len(h)))


def fingerprints(df: DataFrame, text: str = "text", width: int = 3) -> DataFrame:
    """All columns but the text, and ``_fp`` (the fingerprint's 64 bits as a signed long)."""
    kept = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, text):
                fps = np.array([fingerprint(t, width) for t in batch.column(text).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(fps.view(np.int64))], names=[*kept, "_fp"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept)
    return df.mapInArrow(run, schema + ", _fp long")


def bit_planes(values: np.ndarray) -> np.ndarray:
    """planes[b] holds bit b of all values, 64 values to an unsigned word."""
    n = -(-len(values) // 64) * 64
    padded = np.zeros(n, "<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def within(planes: np.ndarray, value: int, radius: int, start: int = 0, span: int = 256) -> np.ndarray:
    """Mask (64 members to a word) of members at most ``radius`` bits from ``value``, from
    word ``start`` on; blocks of ``span`` words stop once all their members exceed the radius."""
    digits = int(radius + 1).bit_length()
    width = planes.shape[1]
    out = np.zeros(width, np.uint64)
    for a in range(start, width, span):
        b = min(width, a + span)
        count = [np.zeros(b - a, np.uint64) for _ in range(digits)]
        over = np.zeros(b - a, np.uint64)
        for i in range(BITS):
            carry = ~planes[i, a:b] if value >> i & 1 else planes[i, a:b].copy()
            for d in range(digits):
                count[d], carry = count[d] ^ carry, count[d] & carry
            over |= carry
            if i % 8 == 7:
                exceeds = over | _above(count, radius)
                if not (~exceeds).any():
                    break
        out[a:b] = ~exceeds
    return out


def _above(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Members whose bit-sliced count is greater than ``radius``."""
    more, same = np.zeros_like(count[0]), ~np.zeros_like(count[0])
    for d in reversed(range(len(count))):
        if radius >> d & 1:
            same &= count[d]
        else:
            more |= same & count[d]
            same &= ~count[d]
    return more


def bucket_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect the members of one bucket as all its pairs within ``radius``
    would: a spanning forest, found by growing each class from a member not yet reached."""
    if len(values) <= 48:  # direct comparison: planes would be mostly padding
        x = values[:, None] ^ values[None, :]
        near = np.bitwise_count(x) <= radius
    else:
        near = None
        planes = bit_planes(values)
    links: list[tuple[int, int]] = []
    left = np.ones(len(values), bool)
    for s in range(len(values)):
        if not left[s]:
            continue
        left[s] = False
        grow = [s]
        while grow:
            i = grow.pop()
            if near is not None:
                mask = near[i]
            else:
                words = within(planes, int(values[i]), radius)
                mask = np.unpackbits(words.view(np.uint8), bitorder="little")[: len(values)].astype(bool)
            for j in np.flatnonzero(mask & left):
                left[j] = False
                links.append((int(values[i]), int(values[j])))
                grow.append(int(j))
    return links


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b) links between distinct fingerprints (column ``_fp``) whose classes are those
    of all pairs within ``radius`` bits."""
    edges = np.linspace(0, BITS, BLOCKS + 1).round().astype(int)
    blocks = [((1 << int(b)) - (1 << int(a))) for a, b in zip(edges, edges[1:], strict=False)]
    if radius >= BLOCKS:
        raise ValueError(f"radius must be below {BLOCKS}")
    masks = [sum(c) for c in combinations(blocks, BLOCKS - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("m"), F.col("_fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(signed)])
    buckets = (
        distinct.select("_fp", F.explode(keys).alias("key"))
        .groupBy("key")
        .agg(F.collect_list("_fp").alias("members"))
        .filter(F.size("members") > 1)
        .select("members")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: list[tuple[int, int]] = []
            for members in b.column("members"):
                found += bucket_links(np.sort(members.values.to_numpy(zero_copy_only=False).view(np.uint64)), radius)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return buckets.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """One row per row of ``df``: doc_id, fingerprint (16 hex digits), component_id (the
    smallest id reachable over links, its own included).

    Null and empty text: fingerprint zero, linked like any other.  Rows whose id is null
    take part; a component of nulls only has a null component_id.  Repeated rows are kept.  Whole texts of any
    length are read; an empty table stays empty."""
    prints = written(fingerprints(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", width), "fingerprints")
    classes = rooted(written(prints.groupBy("_fp").agg(F.min("doc_id").alias("least")), "distinct"), radius)
    least = written(classes.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    known = classes.join(least, "root").select("_fp", "component_id")
    return prints.join(known, "_fp").select("doc_id", F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id")


def rooted(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """The rows of ``distinct`` (one for each fingerprint ``_fp``) and ``root``, which names their component."""
    reach = components(links(distinct, radius))
    found = distinct.join(reach, distinct["_fp"] == reach["node"], "left").select(*distinct.columns, F.coalesce("root", "_fp").alias("root"))
    return written(found, "classes")


def first_rows(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """One row of ``df`` for each component: that with the smallest (id, fingerprint, hash of all
    columns), rows without an id last; of rows equal in all columns one."""
    # the hash passes over nulls, so they are hashed as flags
    row = F.xxhash64(*[F.col(c) for c in df.columns], *[F.col(c).isNull() for c in df.columns])
    key = F.coalesce(F.col(doc_id), F.lit(-(2**63)))
    prints = fingerprints(df.select(F.col(doc_id).alias("doc_id"), row.alias("_row"), F.col(text).alias("text")), "text", width)
    place = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "_fp", "_row")
    classes = rooted(written(prints.groupBy("_fp").agg(F.min(place).alias("place")), "distinct"), radius)
    places = classes.groupBy("root").agg(F.min("place").alias("p")).select(F.coalesce("p.doc_id", F.lit(-(2**63))).alias("_llm_key"), F.col("p._row").alias("_llm_row"))
    kept = df.withColumns({"_llm_key": key, "_llm_row": row}).join(written(places, "places"), ["_llm_key", "_llm_row"], "left_semi")
    return kept.dropDuplicates(["_llm_key", "_llm_row"]).select(*df.columns)
