from collections import Counter
from itertools import combinations

import numpy as np
from tests.llm.helpers import CASES, cases, documents, small, words

from layerworks.llm import quality
from layerworks.llm.chisquare import chi2_cdf, chi2_quantile, consistency


def plain(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    times = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i, k in enumerate(zip(w, w[1:], w[2:])):
        if times[k] > 1:
            hit |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_statistics(spark):
    for df, pairs in ((small(spark), documents()), (cases(spark), CASES)):
        out = quality.quality_rules(df).collect()
        want = sorted(((d, *plain(t)) for d, t in pairs), key=str)
        assert sorted(((r.doc_id, *(r[c] for c in quality.STATS)) for r in out), key=str) == want
        for r in out:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.base_failed and r.kept)
    assert quality.quality_rules(cases(spark).limit(0)).count() == 0


def test_outliers_go_and_the_bulk_stays(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(900):
        n = int(np.exp(rng.normal(5, 0.3))) + 50
        t = " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(n))
        if i % 30 == 0:
            t = t.replace(" ", "### ")
        if i % 30 == 1:
            t = " ".join("q" * 60 + str(j) for j in range(n))
        rows.append((i, t, "en", "a" if i % 2 else "b"))
    out = {r.doc_id: r.kept for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(out[i] for i in range(900) if i % 30 < 2)
    assert np.mean([out[i] for i in range(900) if i % 30 > 1]) > 0.99


def test_chi_square():
    assert abs(chi2_cdf(3.841459, 1) - 0.95) < 1e-6
    assert abs(chi2_quantile(0.99, 5) - 15.08627) < 1e-4


def exact_mcd(x, share):
    """The least determinant over all subsets, floors and consistency as in the operator."""
    h = int(np.ceil(share * len(x)))
    floor, factor = np.diag(np.array(quality.FLOOR) ** 2), consistency(share, 5)
    best = None
    for some in combinations(range(len(x)), h):
        part = x[list(some)]
        value = np.linalg.slogdet(np.cov(part.T, bias=True) * factor + floor)[1]
        if best is None or value < best[0]:
            best = value, part.mean(0)
    return best


def test_estimates_come_near_the_exact_least_determinant(spark):
    """Groups of 14 rows with outliers: all subsets of 11 rows against the operator's, before reweighting."""
    rng = np.random.default_rng(7)
    rows, want = [], {}
    for g in range(6):
        x = rng.standard_normal((14, 5)) * np.array([1, 0.3, 0.4, 1, 1]) + g
        x[:3] += rng.choice([-6, 6], (3, 5))
        rows += [((0, str(g), ""), *map(float, r)) for r in x]
        want[str(g)] = exact_mcd(x, 0.75)
    df = spark.createDataFrame(rows, "g struct<level:int,a:string,b:string>, x0 double, x1 double, x2 double, x3 double, x4 double")
    for r in quality.mcd(df).collect():
        assert r.n == 14 and np.abs(np.array(r.mu) - want[r.g.a][1]).max() < 0.8  # reweighting takes a few rows more
