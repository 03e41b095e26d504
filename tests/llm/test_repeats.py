from collections import Counter

from tests.llm.helpers import CASES, cases, documents, small, words

from layerworks.llm import repeats


def brute(pairs, window):
    split = [words(t) for _, t in pairs]
    times = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(pairs, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if times[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def got(df, **options):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in repeats.remove_repeats(df, **options).collect()), key=str)


def test_documents(spark):
    for window in (35, 9):
        assert got(small(spark), window=window) == brute(documents(), window)


def test_awkward(spark):
    for window in (35, 6, 3):
        assert got(cases(spark), window=window) == brute(CASES, window)
    assert got(cases(spark).limit(0)) == []


def test_periodic_and_overlapping(spark):
    rows = [(i, " ".join("ab"[(j * j + i) % (2 + i % 3) % 2] for j in range(90))) for i in range(12)]
    rows += [(20, "z " * 36), (21, "p q r " * 13), (22, " ".join(map(str, range(60)))), (23, " ".join(map(str, range(20, 90))))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for window in (35, 12):
        assert got(df, window=window) == brute(rows, window)
