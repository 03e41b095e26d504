"""Language-model scores from an n-gram trie in Elias-Fano levels.

Words get numbers by the order of their 64-bit hashes.  Each level of the trie is a store in the shared
folder, cut into files that lie side by side in it, each written by one task:

* words (level 1), by ranges of hashes: word hashes (Elias-Fano) and counts;
* each further level, by ranges of (context, word), a context being an entry's number one level up:
  pointers from each context to its range of successors (Elias-Fano), the successors' numbers, made
  monotone by adding the value that ends the range before (Elias-Fano), and a code of 12 bits
  each for the discounted probability and the context's back-off weight.  A file's contexts are the entries of a file one
  level up, but a context with more tokens than a file is meant for has its successors in as many files as it
  needs, cut by the successor's number, which is a hash's rank.

An n-gram is found by its context's range: the range's base plus the successor's number is
searched among the values that share its high part; its place is the context of the next level.
Smoothing is interpolated absolute discounting, with D of each level from its entries that occur once and twice; the
lowest order is (c + 1) / (N + V + 1), which leaves 1 / (N + V + 1) to any unknown word.

Counting: each task combines its own counts before any shuffle; counts of a level travel as sorted
differences in byte planes, one row for each task and file.  The number of files follows
the number of tokens, so a file is merged in bounded memory.  Scoring tasks memory-map the
levels and look up all n-grams of a slice of texts at once, in whichever files they are, so the time for a text does not
grow with the number of files; texts and tokens are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerworks.llm.common import shared_folder, signed, text_slices, word_table, written
from layerworks.llm.elias_fano import LEVELS, EliasFano, Layout, quantise, shapes

END = np.uint64(0x3C2F733E3C2F733E)
SHARD_TOKENS = 2_000_000
HELD = 2_000_000  # entries that a task combines before it passes them on
ORDER = 2  # a third level takes more of an executor than 3 GB allow, see the README
NARROW = 1 << 32  # contexts that fit beside a word in 64 bits
SENT_BYTES = 1 << 22  # of rows that go to Spark together


def token_table(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all tokens: a text's words, A-Z in lower case, then one end."""
    row, words, _, _ = word_table(text, lower=True)
    n = len(text)
    place = np.arange(len(words)) + row  # one end before, for each row that is done
    ends = np.cumsum(np.bincount(row, minlength=n) + 1) - 1
    out, who = np.empty(len(words) + n, np.uint64), np.empty(len(words) + n, np.int64)
    out[place], who[place] = words, row
    out[ends], who[ends] = END, np.arange(n)
    return who, out


Counts = tuple[np.ndarray, np.ndarray, np.ndarray]  # files, keys, counts


def _combine(parts: list[Counts]) -> Counts:
    """Entries of all parts by (file, key), counts of equal ones added."""
    file, keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((keys, file)) if (file != file[:1]).any() else np.argsort(keys, kind="stable")
    file, keys, counts = file[order], keys[order], counts[order]
    first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (file[1:] != file[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return file[first], keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _gather(parts: Iterator[Counts]) -> Iterator[Counts]:
    """Combined entries of the parts, whenever enough have come together."""
    held: list[Counts] = []
    size = 0
    for part in parts:
        held.append(part)
        size += len(part[1])
        if size >= HELD:
            merged = _combine(held)
            if len(merged[1]) >= HELD // 2:
                yield merged
                held, size = [], 0
            else:
                held, size = [merged], len(merged[1])
    if held:
        yield _combine(held)


def _planes(values: np.ndarray) -> bytes:
    """Bytes of the values, all first bytes, then all second bytes and so on (compresses well)."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def _from_planes(raw: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


class Level:
    """Files of one order from 2 on.  ``context`` and ``word`` are the least keys of the files in order (a word other than 0 only
    where a context has several files), ``begins`` the number of the first entry in each, and of all, ``tops`` the largest
    successor in each, as they are stored."""

    def __init__(self, order: int, context: np.ndarray, word: np.ndarray, contexts: int, begins: np.ndarray | None = None, tops: np.ndarray | None = None, discount: float = 0.0):
        self.order, self.context, self.word, self.contexts = order, context, word, contexts
        self.begins, self.tops, self.discount = begins, tops, discount

    def __reduce__(self):
        return Level, (self.order, self.context, self.word, self.contexts, self.begins, self.tops, self.discount)

    @classmethod
    def cut(cls, order: int, begins: np.ndarray, hot: dict[int, int], types: int) -> Level:
        """Files by those one level up, whose entries begin at ``begins``; ``hot``: files of a context."""
        keys = {(int(c), 0) for c in begins[:-1]} | {(c, j * types // n) for c, n in hot.items() for j in range(n)} | {(c + 1, 0) for c in hot}
        keys = sorted(k for k in keys if k[0] < begins[-1])
        return cls(order, np.array([c for c, _ in keys], np.int64), np.array([w for _, w in keys], np.int64), int(begins[-1]))

    def files(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The file of each key; an unknown word (-1) has its context's first."""
        last = np.searchsorted(self.context, context, "right") - 1
        if not self.word.any():
            return last
        first = np.minimum(np.searchsorted(self.context, context), last)
        word = np.maximum(word, 0)
        go = np.flatnonzero(first < last)
        while len(go):  # the last file of the context's that begins at the word or before
            mid = (first[go] + last[go] + 1) >> 1
            before = self.word[mid] <= word[go]
            first[go[before]], last[go[~before]] = mid[before], mid[~before] - 1
            go = go[first[go] < last[go]]
        return first

    def keys(self, file: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Keys within their files: the context's place there, and the word."""
        return (context - self.context[file]).astype(np.uint64) << np.uint64(32) | word.astype(np.uint64)

    def own(self, file: int) -> int:
        """How many contexts a file has."""
        if file + 1 == len(self.context):
            return self.contexts - int(self.context[file])
        return int(self.context[file + 1] - self.context[file]) + (self.word[file + 1] > 0)

    @cached_property
    def firsts(self) -> np.ndarray:
        """Where each file's contexts begin among those of all files, and their number."""
        return np.append(0, np.cumsum([self.own(f) for f in range(len(self.context))], dtype=np.int64))

    @cached_property
    def pointers(self) -> np.ndarray:
        return shapes(np.diff(self.firsts) + 1, np.diff(self.begins))

    @cached_property
    def successors(self) -> np.ndarray:
        return shapes(np.diff(self.begins), self.tops)

    @cached_property
    def layout(self) -> Layout:
        n, own = np.diff(self.begins), np.diff(self.firsts)
        books = np.full(len(n), LEVELS)
        codes = {"codes": ("<u2", n), "book": ("<f8", books), "back": ("<u2", own), "back_book": ("<f8", books)}
        return Layout(Layout.sequences(self.pointers, "p_") | Layout.sequences(self.successors, "s_") | codes)


class Words:
    """Where the words lie: ``begins`` is the first number in each file, and the number of words; a file has the hashes
    of one value in their first ``bits`` bits."""

    def __init__(self, bits: int, begins: np.ndarray):
        self.bits, self.top = bits, (1 << (64 - bits)) - 1
        self.shape = shapes(np.diff(begins), np.full(len(begins) - 1, self.top, np.uint64))
        self.shape[np.diff(begins) == 0, 1:] = 0  # not written
        self.layout = Layout(Layout.sequences(self.shape) | {"counts": ("<i8", np.diff(begins))})

    def split(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The file of each hash, and the hash's value there."""
        file = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        return file, hashes & np.uint64(self.top)

    def write(self, folder: str, file: int, hashes: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(hashes)
        values = self.split(hashes[order])[1]
        before, words = self.shape[:file, [0, 3]].sum(axis=0)
        self.layout.write(folder, "words", file, EliasFano.build(values, "", self.top, before, words) | {"counts": counts[order]})


class Trie:
    """Reads the trie of a folder; levels are mapped when first needed."""

    def __init__(self, folder: str, bits: int, begins: np.ndarray, tokens: int, levels: list[Level] | None = None):
        """``begins``: the first number in each word file, and the number of words."""
        self.folder, self.bits, self.begins = folder, bits, begins
        self.tokens, self.types = tokens, int(begins[-1])
        self.levels = levels or []
        self._levels: dict[int, dict] = {}

    def __reduce__(self):
        return Trie, (self.folder, self.bits, self.begins, self.tokens, self.levels)

    @cached_property
    def words(self) -> Words:
        return Words(self.bits, self.begins)

    @cached_property
    def _words(self) -> tuple[EliasFano, np.ndarray]:
        a = self.words.layout.map(self.folder, "words")
        return EliasFano(a, "", self.words.shape), a["counts"]

    def level(self, level: Level) -> dict:
        if level.order not in self._levels:
            a = level.layout.map(self.folder, f"level{level.order}")
            self._levels[level.order] = a | {"pointers": EliasFano(a, "p_", level.pointers), "successors": EliasFano(a, "s_", level.successors)}
        return self._levels[level.order]

    def file(self, order: int, file: int) -> dict:
        """The sequences of one file alone, for a look into it."""
        t, out = self.level(self.levels[order - 2]), {}
        for name in ("pointers", "successors"):
            n = int(t[name].each[file])
            out[name] = EliasFano(EliasFano.build(t[name].get(np.arange(n), np.full(n, file))))
        return out

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, count) of word hashes; number -1 and count 0 where unknown."""
        number, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        if self.types:
            index, counts = self._words
            file, values = self.words.split(hashes)
            at = index.find(values, file)
            ok = np.flatnonzero(at >= 0)
            number[ok] = self.begins[file[ok]] + at[ok]
            count[ok] = counts[number[ok]]
        return number, count

    def entries(self, level: Level, context: np.ndarray, word: np.ndarray, scores: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number, discounted probability, the context's back-off weight) of a level's entries; (-1, 0, weight) where
        the context has no such successor, (-1, 0, 1) where it is unknown itself.  Without ``scores`` numbers only."""
        number, p, back = np.full(len(context), -1, np.int64), np.zeros(len(context)), np.ones(len(context))
        known = np.flatnonzero(context >= 0)
        if not len(known):
            return number, p, back
        context, word = context[known], word[known]
        # sorted, so that a context's range is read once, and neighbours lie near each other
        by = np.argsort(context.astype(np.uint64) << np.uint64(32) | (word + 1).astype(np.uint64)) if level.contexts < NARROW else np.lexsort((word, context))
        known, context, word = known[by], context[by], word[by]
        file = level.files(context, word)
        new = np.append(True, (context[1:] != context[:-1]) | (file[1:] != file[:-1]))
        same, first = np.cumsum(new) - 1, np.flatnonzero(new)
        t, f = self.level(level), file[first]
        one = context[first] - level.context[f]
        begin, end = (t["pointers"].get(x, f).astype(np.int64) for x in (one, one + 1))
        base = np.zeros(len(one), np.uint64)
        some = np.flatnonzero(begin)
        base[some] = t["successors"].get(begin[some] - 1, f[some])
        if scores:
            back[known] = t["back_book"][f * LEVELS + t["back"][level.firsts[f] + one]][same]
        ask = np.flatnonzero(word >= 0)
        of = same[ask]
        at = t["successors"].find(base[of] + word[ask].astype(np.uint64) + np.uint64(1), file[ask])
        ok = np.flatnonzero((at >= begin[of]) & (at < end[of]))
        f, to = file[ask[ok]], known[ask[ok]]
        number[to] = level.begins[f] + at[ok]
        if scores:
            p[to] = t["book"][f * LEVELS + t["codes"][number[to]]]
        return number, p, back

    def known(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which distinct token each one is, and the distinct ones' numbers and counts (see ``lookup``)."""
        distinct, which = np.unique(tokens, return_inverse=True)
        return which, *self.lookup(distinct)

    def ngrams(self, row: np.ndarray, tokens: np.ndarray, levels: list[Level | None], scores: bool = True, known: tuple | None = None) -> Iterator[tuple[Level | None, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per level: (level, places of tokens with a full context, which distinct n-gram stands there, the distinct ones' context and
        word numbers, probabilities, weights); None in the last place of ``levels`` gives n-grams that are not looked up.  ``known``: of the tokens, where the caller has it."""
        which, number, _ = known or self.known(tokens)
        at, local, context_of = np.arange(len(tokens)), which, number
        for level in levels:
            place = at[1:][(row[at[1:]] == row[at[1:] - 1]) & (np.diff(at) == 1)]
            before = local[np.searchsorted(at, place - 1)]
            grams, gram = np.unique((before.astype(np.int64) << 32) | which[place], return_inverse=True)
            context, word = context_of[grams >> 32], number[grams & 0xFFFFFFFF]
            found, p, back = self.entries(level, context, word, scores) if level else (None, None, None)
            yield level, place, gram, context, word, p, back
            at, local, context_of = place, gram, found


def _write_file(folder: str, level: Level, file: int, keys: np.ndarray, counts: np.ndarray, whole: dict[int, tuple[int, int]]) -> None:
    """keys: sorted and distinct (see ``Level.keys``); ``whole``: successors and tokens that have one, of contexts
    in several files."""
    own = level.own(file)
    first = (keys >> np.uint64(32)).astype(np.int64)
    second = keys & np.uint64(0xFFFFFFFF)
    fan = np.bincount(first, minlength=own)
    pointers = np.append(0, np.cumsum(fan))
    last = second[pointers[1:][fan > 0] - 1] + np.uint64(1)
    base = np.zeros(own, np.uint64)  # what ends the range before
    base[fan > 0] = np.append(np.zeros(1, np.uint64), np.cumsum(last)[:-1])
    successors = base[first] + second + np.uint64(1)
    seen = np.bincount(first, counts, own)  # tokens that have a successor
    if (low := int(level.context[file])) in whole:
        fan[0], seen[0] = whole[low]
    seen = np.maximum(seen, 1)
    codes, book = quantise((counts - level.discount) / seen[first])
    back, back_book = quantise(np.where(fan > 0, level.discount * fan / seen, 1.0))
    before = [(int(x[:file, 0].sum()), int(x[:file, 3].sum())) for x in (level.pointers, level.successors)]
    arrays = EliasFano.build(pointers, "p_", None, *before[0]) | EliasFano.build(successors, "s_", None, *before[1])
    level.layout.write(folder, f"level{level.order}", file, arrays | {"codes": codes, "book": book, "back": back, "back_book": back_book})


def train(df: DataFrame, text: str = "text", shard_tokens: int = SHARD_TOKENS, order: int = ORDER) -> Trie:
    """Counts all n-grams up to ``order`` of ``df``'s texts and writes their trie to the shared folder."""
    spark = df.sparkSession
    docs = df.select(F.col(text).alias("text"))
    folder = shared_folder(spark)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slices() -> Iterator[Counts]:
            for whole in batches:
                for b in text_slices(whole):
                    keys, counts = np.unique(token_table(b.column("text"))[1], return_counts=True)
                    yield np.zeros(len(keys), np.int8), keys, counts

        for _, keys, counts in _gather(slices()):
            yield pa.RecordBatch.from_arrays([signed(keys), pa.array(counts.astype(np.int64))], names=["h", "c"])

    words = written(docs.mapInArrow(count_words, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "words")
    tokens = words.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    bits = max(0, (-(-tokens // shard_tokens) - 1).bit_length())
    shards = 1 << bits
    shard = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")
    sharded = words.withColumn("shard", shard)
    fill = np.zeros(shards, np.int64)  # one number for each shard
    for r in sharded.groupBy("shard").agg(F.count("*").alias("n")).collect():
        fill[r.shard] = r.n
    trie = Trie(folder, bits, np.append(0, np.cumsum(fill)), int(tokens))
    if trie.types >= 1 << 32:
        raise ValueError("over 2**32 distinct words")

    def save_words(key: tuple, table: pa.Table) -> pa.Table:
        trie.words.write(folder, key[0].as_py(), table.column("h").to_numpy().view(np.uint64), table.column("c").to_numpy())
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64())})

    sharded.groupBy("shard").applyInArrow(save_words, "shard long").count()

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(trie.lookup(b.column("h").to_numpy().view(np.uint64))[0]), b.column("c")], names=["w", "c"])

    often = words.filter(F.col("c") > shard_tokens).mapInArrow(numbers, "w long, c long").collect()  # fewer than there are files
    begins, hot = trie.begins, {r.w: -(-r.c // shard_tokens) for r in often}
    for n in range(2, order + 1):
        level, hot = _train_level(docs, trie, Level.cut(n, begins, hot, trie.types), hot, shard_tokens)
        begins = level.begins
        trie = Trie(folder, bits, trie.begins, trie.tokens, [*trie.levels, level])
    return trie


def _train_level(docs: DataFrame, trie: Trie, level: Level, hot: dict[int, int], shard_tokens: int) -> tuple[Level, dict[int, int]]:
    """Counts the level's n-grams and writes its files; the level, complete, and how many files each
    of its entries needs one level down that needs several."""
    spark, files = docs.sparkSession, len(level.context)
    # where context and word fit into one number, entries are sorted by it, else by file and key
    narrow = level.contexts < NARROW
    bounds = level.context.astype(np.uint64) << np.uint64(32) | level.word.astype(np.uint64) if narrow else None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slices() -> Iterator[Counts]:
            for whole in batches:
                for b in text_slices(whole):
                    row, tokens = token_table(b.column("text"))
                    *_, (_, _, gram, context, word, _, _) = trie.ngrams(row, tokens, [*trie.levels, None], False)
                    n = np.bincount(gram, minlength=len(context))
                    if narrow:
                        yield np.zeros(len(n), np.int8), context.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64), n
                    else:
                        file = level.files(context, word)
                        yield file, level.keys(file, context, word), n

        for file, keys, counts in _gather(slices()):
            edge = np.append(np.searchsorted(keys, bounds), len(keys)) if narrow else np.searchsorted(file, np.arange(files + 1))
            some = np.flatnonzero(np.diff(edge))
            steps = np.diff(keys, prepend=np.uint64(0))
            first = edge[some]
            steps[first] = keys[first] - (level.context[some].astype(np.uint64) << np.uint64(32) if narrow else np.uint64(0))
            counts = counts.astype("<u4")
            # rows of several files at once, as there may be many small ones
            sent = (edge[some + 1] - edge[0]) * 12 // SENT_BYTES
            for part in np.split(some, np.flatnonzero(np.diff(sent)) + 1) if len(some) else ():
                rows = [[_planes(x[edge[f] : edge[f + 1]]) for f in part] for x in (steps, counts)]
                yield pa.RecordBatch.from_arrays([pa.array(part), *(pa.array(x, pa.binary()) for x in rows)], names=["file", "keys", "counts"])

    def merge(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([np.cumsum(_from_planes(k, "<u8"), dtype=np.uint64) for k in table.column("keys").to_pylist()])
        counts = np.concatenate([_from_planes(c, "<u4") for c in table.column("counts").to_pylist()])
        if len(table) == 1:
            return keys, counts.astype(np.int64)
        order = np.argsort(keys, kind="stable")  # of sorted runs
        keys, counts = keys[order], counts[order]
        del order
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[first], np.add.reduceat(counts, first, dtype=np.int64)

    numbers = ("once", "twice", "n", "seen", "top")
    large = pa.list_(pa.int64())

    def combine(key: tuple, table: pa.Table) -> pa.Table:
        keys, counts = merge(table)
        over = np.flatnonzero(counts > shard_tokens)
        steps = np.append(keys[:1], np.diff(keys))
        row = {"file": [key[0].as_py()], "keys": [_planes(steps)], "counts": [_planes(counts.astype("<u4"))]}
        row |= {"once": [int((counts == 1).sum())], "twice": [int((counts == 2).sum())], "n": [len(keys)], "seen": [int(counts.sum())], "at": [over.tolist()], "over": [counts[over].tolist()]}
        ends = keys[np.append(np.flatnonzero(keys[1:] >> np.uint64(32) != keys[:-1] >> np.uint64(32)), len(keys) - 1)]
        row["top"] = [int(((ends & np.uint64(0xFFFFFFFF)) + np.uint64(1)).sum())]  # as _write_file adds them up
        return pa.table(row, schema=pa.schema([("file", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), *[(c, pa.int64()) for c in numbers], ("at", large), ("over", large)]))

    schema = "file long, keys binary, counts binary, " + ", ".join(f"{c} long" for c in numbers) + ", at array<long>, over array<long>"
    held = written(docs.mapInArrow(count, "file long, keys binary, counts binary").groupBy("file").applyInArrow(combine, schema), f"level{level.order}")
    # numbers of each file, and its entries with more tokens than a file is meant for: fewer than files
    found = {r.file: r for r in held.drop("keys", "counts").collect()}
    once, twice = (sum(r[c] for r in found.values()) for c in ("once", "twice"))
    discount = once / (once + 2 * twice) if once and twice else 0.5
    n, tops = (np.array([found[f][c] if f in found else 0 for f in range(files)], np.int64) for c in ("n", "top"))
    begins = np.append(0, np.cumsum(n))
    level = Level(level.order, level.context, level.word, level.contexts, begins, tops, discount)
    whole: dict[int, tuple[int, int]] = {}
    for f, r in found.items():
        if (c := int(level.context[f])) in hot and (level.own(f) == 1):
            n, seen = whole.get(c, (0, 0))
            whole[c] = n + r.n, seen + r.seen

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                _write_file(trie.folder, level, b.column("file")[i].as_py(), *merge(pa.Table.from_batches([b.slice(i, 1)])), whole)
            yield b.select(["file"])

    empty = F.lit(b"")
    full = spark.range(files).select(F.col("id").alias("file")).join(held, "file", "left").select("file", F.coalesce("keys", empty).alias("keys"), F.coalesce("counts", empty).alias("counts"))
    full.mapInArrow(save, "file long").count()
    return level, {int(begins[f]) + at: -(-c // shard_tokens) for f, r in found.items() for at, c in zip(r.at, r.over, strict=True)}


def score(df: DataFrame, trie: Trie, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Adds n_tokens, n_known (tokens that training has), train_tokens, base_score (log10 of
    the add-one unigram probability) and score (log10 probability by the trie; the first
    tokens by the orders that their contexts allow) to the rows of ``df``; columns of these names are replaced.

    Null and empty texts hold the end alone.  With an empty training set every token is
    unknown and both scores are its only probability, 1 / (0 + 0 + 1).  Repeated rows are scored alike, and
    count in training as often as they occur; whole texts of any length are read; an empty table stays empty."""
    new = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    base = df.drop(*[c for c in df.columns if c in new])
    own = [c for c in base.columns if keep_text or c != text]
    total = trie.tokens + trie.types + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, text, 2 << 20):
                n = len(b)
                row, tokens = token_table(b.column(text))
                known = trie.known(tokens)
                count = known[2][known[0]]
                uni = (count + 1) / total
                model = uni.copy()
                for _, place, gram, _, _, p, weight in trie.ngrams(row, tokens, trie.levels, known=known):
                    model[place] = p[gram] + weight[gram] * model[place]
                sums = [np.bincount(row, np.log10(x), n) for x in (uni, model)]
                added = [np.bincount(row, minlength=n), np.bincount(row, count > 0, n).astype(np.int64), np.full(n, trie.tokens), *sums]
                yield pa.RecordBatch.from_arrays([*map(b.column, own), *map(pa.array, added)], names=[*own, *new])

    fields = [f for f in base.schema.fields if f.name in own]
    kinds = [T.StructField(c, T.DoubleType() if c.endswith("score") else T.LongType()) for c in new]
    return base.mapInArrow(run, T.StructType([*fields, *kinds]))


def held_out(doc_id: str = "doc_id", parts: int = 7, part: int = 2) -> Column:
    """Whether a row is outside training: crc32 of its id's text; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))
