import math
import zlib
from collections import Counter

import numpy as np
import pytest
from tests.llm.helpers import CASES, cases, documents, small, words

from layerworks.llm import elias_fano, lm
from layerworks.llm.elias_fano import EliasFano, Layout, map_arrays, pack_bits, quantise, select_in_word, shapes, unpack_bits, write_arrays


def tokens(text):
    return [*words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), "</end>"]


def brute(train, pairs, order=2):
    count = [Counter() for _ in range(order + 1)]
    for t in train:
        w = tokens(t)
        for m in range(1, order + 1):
            count[m].update(zip(*(w[i:] for i in range(m))))
    n, v = sum(count[1].values()), len(count[1])
    fan = [Counter(k[:-1] for k in c) for c in count]
    after = [Counter() for _ in count]
    for m in range(2, order + 1):
        for k, c in count[m].items():
            after[m][k[:-1]] += c

    def discount(c):
        once, twice = sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values())
        return once / (once + 2 * twice) if once and twice else 0.5

    d = [discount(c) for c in count]

    def p(w, i, m):
        if m == 1 or i < m - 1:
            return (count[1][w[i],] + 1) / (n + v + 1) if m == 1 else p(w, i, m - 1)
        c, lower = tuple(w[i - m + 1 : i]), p(w, i, m - 1)
        if not after[m][c]:
            return lower
        k = count[m][(*c, w[i])]
        return (k - d[m]) / after[m][c] * (k > 0) + d[m] * fan[m][c] / after[m][c] * lower

    out = []
    for i, t in pairs:
        w = tokens(t)
        out.append((i, len(w), sum(count[1][x,] > 0 for x in w), n, sum(math.log10(p(w, j, 1)) for j in range(len(w))), sum(math.log10(p(w, j, order)) for j in range(len(w)))))
    return sorted(out, key=str)


def compare(df, pairs, shard_tokens, order=lm.ORDER):
    trie = lm.train(df.filter(~lm.held_out()), shard_tokens=shard_tokens, order=order)
    train = [t for d, t in pairs if d is None or zlib.crc32(str(d).encode()) % 7 != 2]
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm.score(df, trie).collect()), key=str)
    for a, b in zip(got, brute(train, pairs, order), strict=True):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], rel=1e-9)
        assert a[5] == pytest.approx(b[5], rel=2e-3)


def test_documents(spark):
    compare(small(spark), documents(), 4_000_000)
    compare(small(spark), documents(), 3000)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_other_orders(spark, order):
    compare(small(spark), documents(), 20_000, order)
    compare(cases(spark), CASES, 500, order)


def test_awkward(spark):
    compare(cases(spark), CASES, 500)
    trie = lm.train(cases(spark).limit(0))
    out = lm.score(cases(spark), trie).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0 for r in out)
    assert lm.score(cases(spark).limit(0), trie).count() == 0


def test_elias_fano(tmp_path):
    rng = np.random.default_rng(3)
    for n, top in ((0, 1), (1, 5), (7, 7), (1000, 1 << 40), (5000, 6000), (70000, 1 << 63)):
        values = np.unique(rng.integers(0, top + 1, n, dtype=np.uint64))
        write_arrays(str(tmp_path), f"x{n}", EliasFano.build(values))
        e = EliasFano(map_arrays(str(tmp_path), f"x{n}"))
        assert (e.get(np.arange(len(values))) == values).all()
        asked = np.concatenate([values, rng.integers(0, (1 << 64) - 1, 500, dtype=np.uint64), values + np.uint64(1)])
        want = {int(v): i for i, v in enumerate(values)}
        assert e.find(asked).tolist() == [want.get(int(a), -1) for a in asked]
    pointers = np.sort(rng.integers(0, 50, 300)).astype(np.uint64)
    assert (EliasFano(EliasFano.build(pointers)).get(np.arange(300)) == pointers).all()


def test_select():
    rng = np.random.default_rng(0)
    words = np.concatenate([rng.integers(1, 1 << 64, 3000, dtype=np.uint64), np.array([1, 1 << 63, (1 << 64) - 1], np.uint64)])
    ones = np.bitwise_count(words).astype(int)
    for rank in (ones * 0, ones - 1, (ones - 1) // 2):
        assert select_in_word(words, rank).tolist() == [[i for i in range(64) if int(w) >> i & 1][r] for w, r in zip(words, rank)]


def test_bits_and_codes():
    rng = np.random.default_rng(3)
    for width in (1, 7, 20, 33, 63):
        v = rng.integers(0, 1 << width, 70001, dtype=np.uint64)
        assert (unpack_bits(pack_bits(v, width), np.arange(len(v)), width) == v).all()
    x = rng.random(10000)
    code, book = quantise(x)
    assert np.abs(book[code] - x).max() < 0.01


def test_frequent_words_have_their_pairs_in_several_files(spark):
    """One word is a third of all tokens: its successors are cut by number, and scores stay those of one file."""
    rng = np.random.default_rng(5)
    pairs = [(i, " ".join(w for x in rng.integers(0, 400, 60) for w in ("the", f"w{x}", f"v{x % 7}"))) for i in range(120)]
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    trie = lm.train(df, shard_tokens=1000)
    level = trie.levels[0]
    several = level.context[np.flatnonzero(level.word)]
    assert len(set(several.tolist())) >= 1 and len(level.context) > len(trie.begins)
    the = max(set(several.tolist()), key=several.tolist().count)
    sizes = [trie.file(2, f)["successors"].n for f in np.flatnonzero(level.context == the)]
    assert len(sizes) >= 6 and sum(sizes) == 400 and max(sizes) < 200
    compare(df, pairs, 1000)
    compare(df, pairs, 100)
    compare(df, pairs, 100, 3)
    # a pair that is a third of all: its successors are in several files of the third level
    pairs = [(i, " ".join(w for x in rng.integers(0, 300, 50) for w in ("of", "the", f"w{x}"))) for i in range(90)]
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    third = lm.train(df, shard_tokens=500, order=3).levels[1]
    assert third.word.any()
    compare(df, pairs, 500, 3)


@pytest.mark.parametrize("order", [2, 3])
def test_unknown_words_after_frequent_contexts(spark, order):
    """Held-out texts put words that training lacks after contexts whose successors are in several files."""
    rng = np.random.default_rng(7)
    unseen = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(150)]
    pairs = [(i, " ".join(w for x in rng.integers(0, 300, 50) for w in ("of", "the", f"w{x}", *(["of", "the", f"new{i}-{x}"] if unseen[i] else [])))) for i in range(150)]
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    compare(df, pairs, 500, order)


def test_contexts_beyond_32_bits(spark, monkeypatch):
    """The way that keys go where context and word do not fit into one number."""
    monkeypatch.setattr(lm, "NARROW", 0)
    compare(small(spark), documents(), 20_000, 3)


@pytest.mark.parametrize("order", [2, 3])
def test_lookups_do_not_grow_with_files(spark, monkeypatch, order):
    """A slice of texts is looked up in all files of a level at once: calls of a search are as many for any number of files."""
    rng = np.random.default_rng(11)
    pairs = [(i, " ".join(w for x in rng.integers(0, 900, 60) for w in ("the", f"w{x}"))) for i in range(60)]
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    calls, found = [], []
    for name in ("find", "get"):
        monkeypatch.setattr(EliasFano, name, lambda *a, f=getattr(EliasFano, name): calls.append(f) or f(*a))
    who, words = lm.token_table(df.select("text").toArrow().column("text").combine_chunks())
    for shard_tokens in (1_000_000, 50):
        trie = lm.train(df, shard_tokens=shard_tokens, order=order)
        calls.clear()
        found.append([(x[4].tolist(), (x[5] > 0).tolist()) for x in trie.ngrams(who, words, trie.levels)])
        files = len(trie.begins) - 1 + sum(len(x.context) for x in trie.levels)
        assert len(calls) <= 2 + 5 * len(trie.levels)  # each find gets what it found
    assert files > 100 and found[0] == found[1]
    assert all(any(ok) for _, ok in found[0])


def test_files_of_frequent_contexts_are_found_together():
    rng = np.random.default_rng(13)
    level = lm.Level.cut(2, np.array([0, 40, 40, 90, 200]), {7: 9, 40: 3, 41: 2, 199: 5}, 1000)
    keys = [*zip(level.context.tolist(), level.word.tolist(), strict=True)]
    context, word = rng.integers(0, 200, 5000), rng.integers(-1, 1000, 5000)
    context[:1000] = rng.choice([7, 40, 41, 199, 8, 0], 1000)
    want = [max(f for f, k in enumerate(keys) if k <= (c, max(w, 0))) for c, w in zip(context.tolist(), word.tolist(), strict=True)]
    assert level.files(context, word).tolist() == want


@pytest.mark.parametrize("local", [True, False])
def test_sequences_side_by_side(tmp_path, monkeypatch, local):
    """Parts of one file, written in any order and one of them twice, empty ones among them; in a folder, and as objects of a store."""
    rng = np.random.default_rng(17)
    parts = [np.unique(rng.integers(0, top, n, dtype=np.uint64)) for n, top in ((0, 9), (1, 1), (700, 1 << 62), (0, 9), (3000, 4000), (64, 64), (0, 9))]
    shape = shapes([len(x) for x in parts], [x[-1] if len(x) else 0 for x in parts])
    layout = Layout(Layout.sequences(shape) | {"more": ("<u2", np.array([len(x) + 3 for x in parts]))})
    folder = str(tmp_path / "a")
    if not local:
        folder = f"file://{folder}"
        monkeypatch.setattr(elias_fano, "_local", lambda path: None if path.startswith("file:") else path)
    for k in (4, 2, 6, 0, 1, 5, 3, 2):
        built = EliasFano.build(parts[k], "", None, int(shape[:k, 0].sum()), int(shape[:k, 3].sum()))
        layout.write(folder, "x", k, built | {"more": np.full(len(parts[k]), k)})
    arrays = layout.map(folder, "x")
    assert arrays["more"].tolist() == [v for k, x in enumerate(parts) for v in [k] * len(x) + [0] * 3]
    index = EliasFano(arrays, "", shape)
    some = [(k, i) for k, x in enumerate(parts) for i in range(len(x))]
    rng.shuffle(some)
    part, i = np.array(some).T
    assert index.get(i, part).tolist() == [int(parts[k][j]) for k, j in some]
    value = np.concatenate([*parts, rng.integers(0, 5000, 3000, dtype=np.uint64), np.array([0, (1 << 64) - 1], np.uint64)])
    for k, x in enumerate(parts):
        want = {int(v): n for n, v in enumerate(x)}
        assert index.find(value, np.full(len(value), k)).tolist() == [want.get(int(v), -1) for v in value]
    if local:
        with pytest.raises(ValueError, match="part 1"):
            layout.write(folder, "x", 1, EliasFano.build(parts[2]) | {"more": np.zeros(1)})
