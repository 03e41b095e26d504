"""Byte-pair encoding and decoding, exact to the merge list of a tokenizer file.

Ordinary words are merged once and kept in a bounded cache.  Long unsplit text (a
pre-token of more than ``LEAF`` symbols) is encoded by tree concatenation: its
leaves are encoded apart, then neighbours are joined pairwise.  A join re-encodes a
window of tokens around the border and doubles it until the window's first and last
token are those that the two sides have there already.  From then on all adjacent
tokens of the result are pairs that stay apart when encoded alone, which makes the
result the encoding of the whole (a merge over a border depends only on the two
tokens beside it).

Documents longer than ``long_text`` characters are dealt to the cluster as pieces, so
one very long text keeps many tasks busy; the pieces' tokens meet again per document.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerworks.llm.common import text_slices

LEAF = 256
LONG_TEXT = 1 << 16
PIECE = 1 << 14
CACHE = 150_000

# Characters on which this module's own splitting is used; texts with any other go
# through the tokenizer file's normalizer and pre-tokenizer.
_OTHER = re.compile("[^\t-\r -~\xa0-ſ]")
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Merges:
    """Merge list of a vocabulary: encodes symbol sequences and joins encodings."""

    def __init__(self, model: dict):
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.token = {i: t for t, i in vocab.items()}
        self.ids = vocab
        self.into: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, ...]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.into.setdefault((x, y), (rank, z))
            self.parts.setdefault(z, self.parts.get(x, (x,)) + self.parts.get(y, (y,)))

    def symbols(self, text: str, last: bool = True) -> list[int]:
        """Base symbols of byte-level text; ``last``: it ends its word."""
        out = [self.ids[c] for c in text]
        if last and self.suffix and text:
            out[-1] = self.ids[text[-1] + self.suffix]
        return out

    def merge(self, symbols: list[int]) -> list[int]:
        """Lowest rank first, leftmost among equals, until no pair merges."""
        if len(symbols) > 48:
            return self._merge_by_heap(symbols)
        into, out = self.into, list(symbols)
        while len(out) > 1:
            best = None
            for i in range(len(out) - 1):
                m = into.get((out[i], out[i + 1]))
                if m is not None and (best is None or m[0] < best[0]):
                    best, at = m, i
            if best is None:
                break
            out[at : at + 2] = [best[1]]
        return out

    def _merge_by_heap(self, symbols: list[int]) -> list[int]:
        into, sym, n = self.into, list(symbols), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, sym[i], sym[i + 1]) for i in range(n - 1) if (m := into.get((sym[i], sym[i + 1])))]
        heapify(heap)
        while heap:
            _, i, a, b = heappop(heap)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = into[a, b][1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if m := into.get((sym[i], sym[k])):
                    heappush(heap, (m[0], i, sym[i], sym[k]))
            if (h := before[i]) >= 0 and (m := into.get((sym[h], sym[i]))):
                heappush(heap, (m[0], h, sym[h], sym[i]))
        return [s for s in sym if s >= 0]

    def _apart(self, tokens: list[int]) -> list[int]:
        return [s for t in tokens for s in self.parts.get(t, (t,))]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of a text from those of its two halves."""
        width = 4
        while True:
            i, j = max(0, len(left) - width), min(len(right), width)
            window = self.merge(self._apart(left[i:]) + self._apart(right[:j]))
            if (i == 0 or window[0] == left[i]) and (j == len(right) or window[-1] == right[j - 1]):
                return left[:i] + window + right[j:]
            width *= 2

    def concatenate(self, parts: list[list[int]]) -> list[int]:
        """Joins neighbours pairwise, level by level."""
        while len(parts) > 1:
            parts = [self.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0] if parts else []

    def encode(self, text: str, last: bool = True) -> list[int]:
        """Ids of one pre-token, given in byte-level characters."""
        symbols = self.symbols(text, last)
        if len(symbols) <= LEAF:
            return self.merge(symbols)
        return self.concatenate([self.merge(symbols[i : i + LEAF]) for i in range(0, len(symbols), LEAF)])


class _Cache(dict):
    """word -> ids in decimal, joined by spaces; two generations bound its size."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, word: str) -> str:
        if (found := self.old.get(word)) is None:
            found = self.make(word)
        self[word] = found
        return found

    def trim(self) -> None:
        if len(self) > CACHE:
            self.old = dict(self)
            self.clear()


class WordTokenizer:
    """Encoder and decoder of a tokenizer file whose white space is dropped and whose
    words end in a suffix; special tokens in a text count as such."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.merges = Merges(spec["model"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)))
        self._marks = tuple({t[0] + t[1:2] for t in self.special})
        library = Tokenizer.from_file(path)
        self._normalizer, self._pre = library.normalizer, library.pre_tokenizer
        self._bytes = byte_symbols()
        self.token = self.merges.token | {i: t for t, i in self.special.items()}
        self.ids_of = _Cache(lambda w: " ".join(map(str, self.merges.encode(self.shown(w)))))
        self.decoded_of = _Cache(lambda w: self.decode(self.ids_of[w]))

    def shown(self, word: str) -> str:
        """Byte-level characters of a word; a leading NUL marks a word given as such."""
        return word[1:] if word[0] == "\0" else "".join(map(self._bytes.__getitem__, word.encode()))

    def _plain(self, text: str) -> list[str]:
        if _OTHER.search(text) is None:
            return _SPLIT.findall(text.lower())
        return ["\0" + w for w, _ in self._pre.pre_tokenize_str(self._normalizer.normalize_str(text))]

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a whole text; a special token is given as its decimal id after two NULs."""
        if not any(m in text for m in self._marks):
            return self._plain(text)
        out, at = [], 0
        for m in self._special.finditer(text):
            out += self._plain(text[at : m.start()]) if m.start() > at else []
            out.append(f"\0\0{self.special[m[0]]}")
            at = m.end()
        return out + (self._plain(text[at:]) if at < len(text) else [])

    def encode_words(self, words: list[str]) -> str:
        """Decimal ids of pre-tokens, joined by spaces."""
        of = self.ids_of
        return " ".join([w[2:] if w[:2] == "\0\0" else of[w] for w in words] if any(w[:2] == "\0\0" for w in words) else map(of.__getitem__, words))

    def decode(self, ids: str) -> str:
        """Text of decimal ids, as a decoder-less tokenizer gives it: tokens joined by spaces."""
        return " ".join([self.token[int(i)] for i in ids.split()])

    def encode(self, text: str) -> tuple[str, str]:
        """(decimal ids, decoded text) of a whole text."""
        words = self.words(text)
        if "\0\0" in "".join(w[:2] for w in words if w[0] == "\0"):
            ids = self.encode_words(words)
            return ids, self.decode(ids)
        ids, decoded = " ".join(map(self.ids_of.__getitem__, words)), " ".join(map(self.decoded_of.__getitem__, words))
        self.ids_of.trim()
        self.decoded_of.trim()
        return ids, decoded

    def pieces(self, text: str) -> Iterator[tuple[bool, bool, str]]:
        """(continues the piece before, ends its word, JSON of pre-tokens) such that a
        piece holds about PIECE characters; a longer pre-token is cut into several."""
        held: list[str] = []
        size = 0
        words = self.words(text)
        for w in words:
            if len(w) > PIECE:
                if held:
                    yield False, True, json.dumps(held)
                    held, size = [], 0
                shown = self.shown(w)
                for i in range(0, len(shown), PIECE):
                    yield i > 0, i + PIECE >= len(shown), json.dumps(["\0" + shown[i : i + PIECE]])
                continue
            held.append(w)
            size += len(w) + 1
            if size >= PIECE:
                yield False, True, json.dumps(held)
                held, size = [], 0
        if held or not words:
            yield False, True, json.dumps(held)

    def encode_piece(self, joins: bool, last: bool, words: list[str]) -> str:
        if joins or not last:
            return " ".join(map(str, self.merges.encode(words[0][1:], last)))
        return self.encode_words(words)

    def rejoin(self, pieces: list[tuple[bool, str]]) -> str:
        """Ids of a document from those of its pieces in order."""
        out: list[str] = []
        run: list[list[int]] = []
        for joins, ids in [*pieces, (False, "")]:
            if not joins and run:
                out.append(" ".join(map(str, self.merges.concatenate(run))))
                run = []
            run.append([int(i) for i in ids.split()])
        return " ".join(x for x in out if x)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _count(ids: str) -> int:
    return ids.count(" ") + 1 if ids else 0


def encode_documents(df: DataFrame, path: str, text: str = "text", long_text: int = LONG_TEXT, keep_text: bool = True) -> DataFrame:
    """Adds ``n_tokens`` (long), ``ids`` (decimal, joined by one space) and ``decoded``
    to the rows of ``df``; columns of these names that it has already are replaced.
    ``keep_text=False`` leaves the text column out.

    Null and empty text: no tokens, empty strings.  Repeated rows and null or repeated
    ids are encoded row by row, since no key is needed for texts of up to ``long_text``
    characters; longer ones are regrouped by a key made of all their row (equal rows
    give equal results).
    """
    new = ("n_tokens", "ids", "decoded")
    base = df.drop(*[c for c in df.columns if c in new])
    kept = [c for c in base.columns if keep_text or c != text]
    schema = T.StructType(
        [f for f in base.schema.fields if f.name in kept]
        + [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.StringType()), T.StructField("decoded", T.StringType())]
    )

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for whole in batches:
            for batch in text_slices(whole, text):
                pairs = [t.encode(x or "") for x in batch.column(text).to_pylist()]
                added = [
                    pa.array([_count(i) for i, _ in pairs], pa.int64()),
                    pa.array([i for i, _ in pairs], pa.string()),
                    pa.array([d for _, d in pairs], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*map(batch.column, kept), *added], names=[*kept, *new])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for whole in batches:
            for batch in text_slices(whole, text):
                for row, x in zip(batch.column("_llm_row").to_pylist(), batch.column(text).to_pylist(), strict=True):
                    found = [(row, i, *p) for i, p in enumerate(t.pieces(x))]
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(("_llm_row", "i", "joins", "last", "words"), p, strict=True)) for p in found],
                        schema=pa.schema([("_llm_row", pa.int64()), ("i", pa.int32()), ("joins", pa.bool_()), ("last", pa.bool_()), ("words", pa.string())]),
                    )

    def piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for b in batches:
            c = b.to_pydict()
            ids = [t.encode_piece(j, e, json.loads(w)) for j, e, w in zip(c["joins"], c["last"], c["words"], strict=True)]
            yield pa.RecordBatch.from_pydict({"_llm_row": c["_llm_row"], "i": c["i"], "joins": c["joins"], "ids": ids}, schema=pa.schema([("_llm_row", pa.int64()), ("i", pa.int32()), ("joins", pa.bool_()), ("ids", pa.string())]))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for b in batches:
            for row, parts in zip(b.column("_llm_row").to_pylist(), b.column("parts").to_pylist(), strict=True):
                ids = t.rejoin([(p["joins"], p["ids"]) for p in sorted(parts, key=lambda p: p["i"])])
                yield pa.RecordBatch.from_pydict({"_llm_row": [row], "n_tokens": [_count(ids)], "ids": [ids], "decoded": [t.decode(ids)]}, schema=pa.schema([("_llm_row", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.string())]))

    size = F.coalesce(F.length(text), F.lit(0))
    done = base.filter(size <= long_text).mapInArrow(short, schema)
    rest = base.filter(size > long_text).withColumn("_llm_row", F.xxhash64(F.col(text)))
    # equal texts have equal pieces: each distinct long text is cut once
    cuts = rest.select("_llm_row", text).dropDuplicates(["_llm_row"]).mapInArrow(cut, "_llm_row long, i int, joins boolean, last boolean, words string")
    coded = cuts.repartition("_llm_row", "i").mapInArrow(piece, "_llm_row long, i int, joins boolean, ids string")
    # a document's tokens fit one row, as its text did
    docs = coded.groupBy("_llm_row").agg(F.collect_list(F.struct("i", "joins", "ids")).alias("parts"))
    docs = docs.mapInArrow(whole, "_llm_row long, n_tokens long, ids string, decoded string")
    far = rest.join(docs, "_llm_row").select(*kept, *new)
    return done.unionByName(far)
