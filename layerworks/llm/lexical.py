"""Ranked lexical search by presence masks.

An item's score of a document sums, over the item's terms, a weight times a factor of the term's
occurrences and the document's length, all in 64-bit integers.  Documents are indexed once, in
blocks of similar length that hold only the postings of terms some item has: for each term the places of its
documents and their occurrences.  For an item, the bitmaps of its terms in a block are
turned on their side, which gives each document the mask of the terms it holds.  Documents with one
mask form a group whose highest possible score follows from the mask alone: each term's most
occurrences in the block at the group's least length.  Groups are scored exactly in descending order of that bound
until it falls below the item's k-th best score so far, which a task carries from block to
block; equal bounds are still scored, as a tie may go to a smaller id.

Spark deals the documents to tasks, adds up the counts, and ranks the k best that each
task has for each item.  Items go in groups of bounded text size, each against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerworks.llm.common import forget, text_slices, word_table, written

GROUP_BYTES = 64 << 20  # of item texts searched at a time
BLOCK_DOCS = 4096
HELD_POSTINGS = 1 << 21  # that a task gathers before it sorts documents by length into blocks
CHUNK = 128  # documents scored at least before the bound is looked at again

#: Bytes that end a term: ASCII but digits and letters.
BETWEEN = np.ones(256, bool)
BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

INDEX = "docs long, terms long, ids binary, null_ids binary, lengths binary, term binary, df binary, places binary, tf binary"


class Items:
    """Distinct terms of a group of items by hash, and each item's terms with repeats counted."""

    def __init__(self, texts: list[str | None]):
        row, h, _, _ = word_table(pa.array(texts, pa.large_string()), lower=True, space=BETWEEN)
        self.hashes, code = np.unique(h, return_inverse=True)
        pairs, times = np.unique(row * max(len(self.hashes), 1) + code, return_counts=True)
        ends = np.searchsorted(pairs, np.arange(len(texts) + 1) * max(len(self.hashes), 1))
        self.terms = [(pairs[a:b] % max(len(self.hashes), 1), times[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def index(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """Rows of ``INDEX``: blocks of documents (columns doc_id, text) with the postings of the terms
    ``hashes``, and in ``docs`` and ``terms`` how many documents with a term, and terms, a task has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        docs, terms, many = 0, 0, 0
        for whole in batches:
            for batch in text_slices(whole):
                row, h, _, _ = word_table(batch.column("text"), lower=True, space=BETWEEN)
                length = np.bincount(row, minlength=len(batch))
                docs, terms = docs + int((length > 0).sum()), terms + len(row)
                at = np.minimum(np.searchsorted(hashes, h), max(len(hashes) - 1, 0))
                known = hashes[at] == h if len(hashes) else np.zeros(len(h), bool)
                pair, tf = np.unique(row[known] * max(len(hashes), 1) + at[known], return_counts=True)
                row, term = np.divmod(pair, max(len(hashes), 1))
                found, row = np.unique(row, return_inverse=True)
                ids = batch.column("doc_id")
                held.append((ids.fill_null(0).to_numpy()[found], ids.is_null().to_numpy(zero_copy_only=False)[found], length[found], row, term, tf))
                many += len(pair)
                if many >= HELD_POSTINGS:
                    yield _blocks(held, docs, terms)
                    held, docs, terms, many = [], 0, 0, 0
        if held:
            yield _blocks(held, docs, terms)

    return docs.mapInArrow(run, INDEX)


def _blocks(held: list[tuple], docs: int, terms: int) -> pa.RecordBatch:
    """The documents gathered, shortest first, in blocks; the counts stand in the first."""
    starts = np.cumsum([0, *[len(h[0]) for h in held]])
    ids, nulls, length = (np.concatenate([h[i] for h in held]) for i in range(3))
    row = np.concatenate([h[3] + s for h, s in zip(held, starts, strict=False)])
    term, tf = (np.concatenate([h[i] for h in held]) for i in (4, 5))
    order = np.argsort(length, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    row = place[row]
    by = np.lexsort((row, term, row // BLOCK_DOCS))
    row, term, tf = row[by], term[by], tf[by]
    out: list[list] = [[] for _ in range(9)]
    for a in range(0, max(len(order), 1), BLOCK_DOCS):
        these = order[a : a + BLOCK_DOCS]
        x, y = np.searchsorted(row // BLOCK_DOCS, [a // BLOCK_DOCS, a // BLOCK_DOCS + 1])
        distinct, df = np.unique(term[x:y], return_counts=True)
        fields = (ids[these], "<i8"), (nulls[these], "u1"), (length[these], "<i8"), (distinct, "<i4"), (df, "<i4"), (row[x:y] - a, "<i4"), (tf[x:y], "<i4")
        for column, value in zip(out, (0 if a else docs, 0 if a else terms, *(v.astype(kind).tobytes() for v, kind in fields)), strict=True):
            column.append(value)
    kinds = [pa.int64()] * 2 + [pa.binary()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=[c.split()[0] for c in INDEX.split(", ")])


def document_counts(blocks: DataFrame, terms: int) -> np.ndarray:
    """How many documents hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for b in batches:
            for t, n in zip(b.column("term"), b.column("df"), strict=True):
                total[np.frombuffer(t.as_buffer(), "<i4")] += np.frombuffer(n.as_buffer(), "<i4")
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["term", "df"])

    out = np.zeros(terms, np.int64)
    for r in blocks.select("term", "df").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = r.df
    return out


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def norms(lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    """m of documents of these lengths; exact also where 25 * n * N leaves 64 bits."""
    if len(lengths) and 25 * int(lengths.max()) * n >= 1 << 63:
        return np.array([75 + 25 * int(x) * n // total for x in lengths], np.int64)
    return 75 + 25 * lengths * n // max(total, 1)


def factor(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Block:
    """A block of the index, opened for search."""

    def __init__(self, row: dict, n: int, total: int):
        take = lambda c, kind: np.frombuffer(row[c], kind).astype(np.int64)
        self.ids, self.nulls, self.m = take("ids", "<i8"), take("null_ids", "u1"), norms(take("lengths", "<i8"), n, total)
        self.term, self.places, self.tf = take("term", "<i4"), take("places", "<i4"), take("tf", "<i4")
        self.ends = np.concatenate([[0], np.cumsum(take("df", "<i4"))])
        self.most = np.maximum.reduceat(self.tf, self.ends[:-1]) if len(self.term) else self.tf
        self.bitmaps: dict[int, np.ndarray] = {}

    def bitmap(self, t: int) -> np.ndarray:
        """Bits of the documents that hold the block's t-th term; items share them."""
        if t not in self.bitmaps:
            bits = np.zeros(len(self.ids), bool)
            bits[self.places[self.ends[t] : self.ends[t + 1]]] = True
            self.bitmaps[t] = np.packbits(bits)
        return self.bitmaps[t]

    def groups(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(masks as rows of bits, documents ordered by mask, starts of each mask's documents),
        without documents that hold none of the block's ``terms``."""
        planes = np.unpackbits(np.stack([self.bitmap(t) for t in terms]), axis=1, count=len(self.ids))
        packed = np.packbits(planes, axis=0)
        words = np.zeros((-(-len(packed) // 8) * 8, len(self.ids)), np.uint8)
        words[: len(packed)] = packed
        words = np.ascontiguousarray(words.T).view("<u8")
        docs = np.flatnonzero(words.any(1))
        docs = docs[np.lexsort(words[docs].T)]
        starts = np.flatnonzero(np.concatenate([[True], (words[docs[1:]] != words[docs[:-1]]).any(1)])) if len(docs) else docs
        return planes[:, docs[starts]].T, docs, starts

    def scores(self, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of documents over the block's ``terms``."""
        out = np.zeros(len(docs), np.int64)
        for t, w in zip(terms, weights, strict=True):
            a, b = self.ends[t], self.ends[t + 1]
            at = np.minimum(a + np.searchsorted(self.places[a:b], docs), b - 1)
            held = np.flatnonzero(self.places[at] == docs)
            out[held] += w * factor(self.tf[at[held]], self.m[docs[held]])
        return out

    def search(self, terms: np.ndarray, weights: np.ndarray, best: tuple, k: int) -> tuple[tuple, int]:
        """``best`` (scores, null flags, ids; best first) with this block's documents, and how
        many documents were scored."""
        at = np.searchsorted(self.term, terms)
        here = at < len(self.term)
        here[here] = self.term[at[here]] == terms[here]
        at, weights = at[here], weights[here]
        if not len(at):
            return best, 0
        masks, docs, starts = self.groups(at)
        if not len(docs):
            return best, 0
        sizes = np.diff(np.append(starts, len(docs)))
        shortest = np.minimum.reduceat(self.m[docs], starts)
        bound = np.zeros(len(starts), np.int64)
        for j, (t, w) in enumerate(zip(at, weights, strict=True)):
            bound += masks[:, j] * w * factor(self.most[t], shortest)
        order = np.argsort(-bound, kind="stable")
        bound, sizes, starts = bound[order], sizes[order], starts[order]
        ends, done, scored = np.cumsum(sizes), 0, 0
        while done < len(order):
            if len(best[0]) == k:
                live = int(np.searchsorted(-bound, -best[0][-1], "right"))  # groups whose bound is not below the k-th best
                if live <= done:
                    break
            else:
                live = len(order)
            to = min(live, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + CHUNK)) + 1)
            many = sizes[done:to]
            some = docs[np.repeat(starts[done:to] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())]
            found = self.scores(some, at, weights)
            scored += len(some)
            keep = found >= max(1, best[0][-1] if len(best[0]) == k else 1)
            some, found = some[keep], found[keep]
            joined = [np.concatenate(x) for x in zip(best, (found, self.nulls[some], self.ids[some]), strict=True)]
            top = np.lexsort((joined[2], joined[1], -joined[0]))[:k]
            best = tuple(x[top] for x in joined)
            done = to
        return best, scored


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank from 1, doc_id, score): for each item the ``k`` documents with the highest
    score above 0, ties to the smaller id, a null id last.

    Items equal in id and text count once; items of one id with different texts are ranked apart.
    Documents equal in all are ranked each.  Null and empty texts hold no terms; items without a
    term that some document has give no rows, and so do empty tables."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).filter(F.length("text") > 0).distinct()
    groups = max(1, -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // GROUP_BYTES))
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "item_id long, rank int, doc_id long, score long"
    out = None
    for g in range(groups):
        part = asked.filter(F.pmod(F.xxhash64("item_id", "text", F.lit(groups)), F.lit(groups)) == g) if groups > 1 else asked
        rows = part.collect()  # GROUP_BYTES of text, as ids and texts are dealt by their hash
        if not rows:
            continue
        found = _search(read, [r.item_id for r in rows], Items([r.text for r in rows]), k)
        found = found if groups == 1 else written(found, "ranked")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def _search(docs: DataFrame, item_ids: list[int | None], items: Items, k: int) -> DataFrame:
    blocks = written(index(docs, items.hashes), "index")
    n, total = blocks.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    df = document_counts(blocks, len(items.hashes))
    weights = np.array([weight(n, int(d)) for d in df], np.int64)
    asked = [(t[w > 0], (w * times)[w > 0]) for t, times in items.terms for w in [weights[t]]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        best = [(none, none, none)] * len(asked)
        for b in batches:
            for i in range(len(b)):
                block = Block({c: b.column(c)[i].as_buffer() for c in ("ids", "null_ids", "lengths", "term", "df", "places", "tf")}, n, total)
                for j, (terms, w) in enumerate(asked):
                    best[j] = block.search(terms, w, best[j], k)[0]
        item = np.repeat(np.arange(len(asked), dtype=np.int32), [len(x[0]) for x in best])
        score, null, ids = (np.concatenate(x) if x else none for x in zip(*best, strict=True))
        known = [pa.array(np.array(item_ids, object)[item].tolist(), pa.int64()), pa.array(item), pa.array(ids, mask=null.astype(bool)), pa.array(score)]
        yield pa.RecordBatch.from_arrays(known, names=["item_id", "item", "doc_id", "score"])

    top = blocks.drop("docs", "terms").mapInArrow(run, "item_id long, item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = top.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
