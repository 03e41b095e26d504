"""Best-fit packing of token sequences under several capacities at once.

A sequence (bin) has three capacities: tokens, documents and attention cost (the sum
of squared piece lengths, as each piece attends within itself).  Pieces are placed
longest first.  Among the open bins that can take a piece under *every* capacity, the
rule picks one: ``norm`` the bin whose residual after placing has the smallest weighted
norm, ``dot`` the one with the largest weighted dot product of demand and residual.

Pieces are dealt to groups of about ``group_pieces`` by a hash; each group is packed in
one task on (length) columns only, so texts never move and a group never grows with the
input.  A group leaves about one bin part-filled.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerworks.llm.bpe import byte_symbols
from layerworks.llm.common import text_slices, written

CACHE = 200_000
# Of residual tokens, documents and attention cost in the choice of a bin.  With all three the
# number of sequences stays at the least that tokens allow on the given documents.
WEIGHTS = (1.0, 0.5, 0.5)
_OTHER = re.compile("[^\t-\r -~\xa0-ſ]")
# The byte-level pattern over those characters, with its classes spelled out.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼½¾", "\t-\r \xa0"
_SPLIT = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class _PieceCache(dict):
    """pre-token -> its ids as little-endian unsigned 32-bit bytes; two generations bound its size."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, word: str) -> bytes:
        if (found := self.old.get(word)) is None:
            found = np.array(self.encode(word), "<u4").tobytes()
        self[word] = found
        return found

    def trim(self) -> None:
        if len(self) > CACHE:
            self.old = dict(self)
            self.clear()


class ByteEncoder:
    """Ids of byte-level BPE as packed bytes.  Common texts are split here and their pre-tokens
    merged once and cached; a text with rarer characters or a special token goes to the library whole."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # ids follow the order of merges in such files, so they are the ranks of the same merges
        shown = {c: b for b, c in byte_symbols().items()}
        vocab = self.library.get_vocab(with_added_tokens=False)
        ranks = {bytes(map(shown.__getitem__, t)): i for t, i in vocab.items() if t not in self.special}
        words = tiktoken.Encoding("words", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cache = _PieceCache(words.encode_ordinary)

    def encode(self, text: str) -> bytes:
        if _OTHER.search(text) or any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        out = b"".join(map(self.cache.__getitem__, _SPLIT.findall(text)))
        self.cache.trim()
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


def token_pieces(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", max_tokens: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces of every document's ids followed by ``end_id``: doc_id, piece, start, length,
    ids_crc32, and ``ids`` (packed unsigned 32-bit).  Only a document of more than
    ``max_tokens`` is cut, its first piece being the shorter one.  Null text: empty, which
    gives one piece holding ``end_id``."""
    end = np.array([end_id], "<u4").tobytes()
    names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
    kinds = pa.schema(list(zip(names, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for whole in batches:
            for batch in text_slices(whole, "text"):
                rows = []
                for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    ids = enc.encode(t or "") + end
                    n = len(ids) // 4
                    edges = [0, *range(n % max_tokens or min(n, max_tokens), n + 1, max_tokens)]
                    for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                        part = ids[4 * a : 4 * b]
                        rows.append((d, i, a, b - a, zlib.crc32(part), part))
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, PIECES + ", ids binary")


def best_fit(lengths: np.ndarray, capacity: tuple[float, float, float], weights: tuple[float, float, float], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece.  Longest first; ties in the order given.  A piece that
    no empty bin could take is an error.  Scores within 1e-12 count as equal: lowest bin."""
    if rule not in ("norm", "dot"):
        raise ValueError(f"rule must be 'norm' or 'dot', not {rule!r}")
    cap, w = np.array(capacity, float), np.array(weights, float)
    n = len(lengths)
    order = np.argsort(-lengths, kind="stable")
    need = np.stack([lengths, np.ones(n), lengths.astype(float) ** 2], 1)
    if n and (need > cap).any():
        raise ValueError("a piece exceeds a capacity of an empty sequence")
    least = need.min(0) if n else need.sum(0)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    # open bins: residual capacities as columns, and their numbers; grown by doubling
    rest, number, used = np.zeros((3, 1024)), np.zeros(1024, np.int64), np.zeros(1024, np.int64)
    top = made = 0
    for k in order:
        d = need[k]
        after = rest[:, :top] - d[:, None]
        fits = (after >= 0).all(0)
        if fits.any():
            if rule == "norm":
                score = (w[:, None] * (after / cap[:, None]) ** 2).sum(0)
            else:
                score = -((w * d / cap)[:, None] * (rest[:, :top] / cap[:, None])).sum(0)
            at = int(np.argmin(np.where(fits, score, np.inf)))
        else:
            if top == len(number):
                rest, number, used = np.concatenate([rest, rest * 0], 1), np.concatenate([number, number * 0]), np.concatenate([used, used * 0])
            at, top = top, top + 1
            rest[:, at], number[at], used[at] = cap, made, 0
            made += 1
        bins[k], offsets[k] = number[at], used[at]
        rest[:, at] -= d
        used[at] += lengths[k]
        if (rest[:, at] < least).any():  # no piece fits any more: the last open bin takes its place
            top -= 1
            rest[:, at], number[at], used[at] = rest[:, top], number[top], used[top]
    return bins, offsets


def pack(
    pieces: DataFrame,
    max_tokens: int = 2048,
    max_documents: int | None = None,
    max_cost: float | None = None,
    weights: tuple[float, float, float] = WEIGHTS,
    rule: str = "norm",
    group_pieces: int = 16384,
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with columns doc_id, piece, start, length, ids_crc32.

    ``max_documents`` and ``max_cost`` default to bounds that tokens alone imply
    (``max_tokens`` pieces, ``max_tokens`` squared), which leaves the fewest sequences; the residuals of
    all three choose the bin by ``weights`` in any case.  Repeated rows are packed each for itself, however many there
    are: a row's place in the written pieces deals it to a group.  Ties go to the bin opened first; an empty
    table gives no sequences."""
    capacity = (max_tokens, max_documents or max_tokens, max_cost or float(max_tokens) ** 2)
    held = written(pieces.drop("ids") if "ids" in pieces.columns else pieces, "pieces")
    groups = max(1, -(-held.count() // group_pieces))
    extra = [c for c in held.columns]

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece"], kind="stable", ignore_index=True)
        bins, offsets = best_fit(rows["length"].to_numpy(), capacity, weights, rule)
        return rows[extra].assign(sequence_id=(int(key[0]) << 32) + bins, offset=offsets)

    # pieces that are equal in all, such as empty texts without ids, are dealt apart by their places
    dealt = held.withColumn("_place", F.monotonically_increasing_id())
    dealt = dealt.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "_place"), F.lit(groups))).drop("_place")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in held.schema) + ", sequence_id long, offset long"
    return dealt.groupBy("_group").applyInPandas(place, schema)


def pack_documents(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", max_tokens: int = 2048, **options) -> DataFrame:
    """Packs the documents of ``df`` (see ``token_pieces`` and ``pack``)."""
    return pack(token_pieces(df, path, doc_id, text, max_tokens), max_tokens, **options)
