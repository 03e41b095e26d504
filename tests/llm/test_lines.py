import random

from tests.llm.helpers import CASES, cases, documents, small

from layerworks.llm import lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def brute(pairs, min_words):
    places, first = [], {}
    for d, t in pairs:
        for i, line in enumerate((t.split("\n") if t is not None else [])):
            w = tuple(line.encode().split())
            if w:
                at = (2**63 - 1 if d is None else d, i)
                places.append((d, t, w, at))
                first[w] = min(first.get(w, at), at)
    kinds = sorted(first.items(), key=lambda x: x[1])
    near = set()
    for k, (w, at) in enumerate(kinds):
        if len(w) >= min_words:
            for v, before in kinds[:k]:
                if len(v) >= min_words and abs(len(v) - len(w)) < 2 and before < at and distance(v, w) <= 1:
                    near.add(w)
                    break
    out = []
    for d, t in pairs:
        gone = sorted(a[1] for x, y, w, a in places if (x, y) == (d, t) and (w in near or first[w] != a))
        parts = t.split("\n") if t is not None else []
        out.append((d, len(parts), len(set(gone)), sorted(set(gone)), None if t is None else "\n".join(x for i, x in enumerate(parts) if i not in gone)))
    return sorted(out, key=str)


def got(df, **options):
    return sorted(((r.doc_id, r.n_lines, r.n_removed, r.removed, r.kept) for r in lines.dedup_lines(df, **options).collect()), key=str)


def test_documents(spark):
    assert got(small(spark)) == brute(documents(), 10)


def test_awkward(spark):
    assert got(cases(spark), min_words=2) == brute(CASES, 2)
    assert got(cases(spark).limit(0)) == []


def test_edits(spark):
    rng = random.Random(3)
    base = [[rng.choice("abcdef") * rng.randrange(1, 3) for _ in range(rng.randrange(4, 9))] for _ in range(12)]
    rows = []
    for i in range(90):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w))
            w[at : at + rng.randrange(2)] = [rng.choice("abcxyz")] * rng.randrange(2)
        rows.append((i, "top line\n" + "  ".join(w) + "\n\nlast"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, min_words=4) == brute(rows, 4)
    assert got(df, min_words=3) == brute(rows, 3)
