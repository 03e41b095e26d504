import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from tests.llm.helpers import CASES, SF, cases

from layerworks.llm import lexical
from layerworks.llm.queries import SQL, op12_lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        found = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n // total if b else 0
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t, times in Counter(terms(text)).items() if t in b)
            if score > 0:
                found.append((-score, i is None, i, score))
        found.sort(key=lambda x: (*x[:2], x[2] or 0))
        out += [(item, rank + 1, i, score) for rank, (_, _, i, score) in enumerate(found[:k])]
    return sorted(out, key=lambda x: (x[0] is None, x[0] or 0, x[1], x[3]))


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1], x[3]))


def test_awkward(spark):
    items = [(1, "the quick brown FOX, fox!"), (2, None), (3, ""), (4, "... !"), (5, "é <|endoftext|> a b c c c"), (None, "words w5x5 naïve"), (6, "nowhere-to-be-found zzz"),
             (7, " ".join(f"w{i}x{i % 31}" for i in range(977)) + " one two a"), (8, "a a a b"), (8, "a a a b"), (9, "Été İstanbul ΣΑΣ 你好世界")]
    asked = spark.createDataFrame([(*i, 1, "x") for i in items], "item_id long, text string, score int, rank string")
    docs = cases(spark).repartition(3)
    assert rows(lexical.search(docs, asked, 3)) == brute(CASES, items, 3)
    assert rows(lexical.search(docs, asked, 20)) == brute(CASES, items, 20)
    assert lexical.search(docs.limit(0), asked).collect() == [] == lexical.search(docs, asked.limit(0)).collect()


@pytest.mark.parametrize("block", [64, 4096])
def test_blocks_groups_and_ties(spark, monkeypatch, block):
    """Many blocks and item groups, copies that tie across tasks, frequent terms."""
    rng = np.random.default_rng(1)
    words = np.array([f"t{i}" for i in range(300)])
    p = 1 / np.arange(1, 301)
    texts = [" ".join(rng.choice(words, rng.integers(1, 120), p=p / p.sum())) for _ in range(1500)]
    docs = [(int(i), texts[j % 700] if j % 3 else texts[5]) for j, i in enumerate(rng.permutation(1500))]
    items = [(i, " ".join(rng.choice(words, rng.integers(1, 150)))) for i in range(25)] + [(25, texts[5])]
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "HELD_POSTINGS", 3000)
    if block == 64:
        monkeypatch.setattr(lexical, "GROUP_BYTES", 2000)
    found = lexical.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(found) == brute(docs, items)


def test_most_documents_are_never_scored():
    rng = np.random.default_rng(2)
    n, v = 4000, 60
    tf = np.where(rng.random((n, v)) < 0.2, rng.integers(1, 4, (n, v)), 0)
    doc, term = np.nonzero(tf)
    batch = lexical._blocks([(np.arange(n), np.zeros(n, bool), 10 + tf.sum(1), doc, term, tf[doc, term])], n, int(tf.sum()))
    block = lexical.Block({c: batch.column(c)[0].as_py() for c in batch.schema.names[2:]}, n, int(tf.sum()) + 10 * n)
    none = np.zeros(0, np.int64)
    asked, w = np.arange(12), rng.integers(500, 3000, 12)
    best, scored = block.search(asked, w, (none, none, none), 20)
    places = {int(i): p for p, i in enumerate(block.ids)}
    every = sorted(((-int(sum(w[t] * lexical.factor(tf[i, t], block.m[places[i]]) for t in range(12) if tf[i, t])), i) for i in range(n)))[:20]
    assert [(-s, i) for s, i in zip(best[0], best[2])] == every and scored < n / 2


def test_norms_beyond_64_bits():
    lengths = np.array([10**7, 5], np.int64)
    n, total = 6 * 10**10, 10**13
    assert lexical.norms(lengths, n, total).tolist() == [75 + 25 * int(x) * n // total for x in lengths]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(SQL["op12_lexical_search"]).fetchall()
    assert sorted(map(tuple, op12_lexical_search(spark, SF).collect())) == sorted(want)
