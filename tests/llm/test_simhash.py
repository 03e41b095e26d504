import random

import numpy as np
import xxhash
from tests.llm.helpers import CASES, cases, documents, small, words

from layerworks.llm import simhash
from layerworks.llm.components import components


def plain_fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(values, ids, radius=2):
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(values))]


def brute(pairs):
    f = [plain_fingerprint(t) for _, t in pairs]
    c = classes(f, [d for d, _ in pairs])
    return sorted(((d, f"{x:016x}", y) for (d, _), x, y in zip(pairs, f, c)), key=str)


def got(df):
    return sorted((tuple(r) for r in simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_documents(spark):
    assert got(small(spark)) == brute(documents())


def test_awkward(spark):
    assert got(cases(spark)) == brute(CASES)
    assert got(cases(spark).limit(0)) == []


def test_links_find_every_class(spark):
    rng = random.Random(9)
    values = set()
    for _ in range(40):
        v = rng.getrandbits(64)
        for _ in range(30):
            values.add(v)
            for _ in range(rng.randrange(1, 4)):
                v ^= 1 << rng.randrange(64)
    values = sorted(values)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "_fp long")
    roots = {r.node % 2**64: r.root for r in components(simhash.links(df)).collect()}
    want = classes(values, range(len(values)))
    seen = {}
    for v, w in zip(values, want):
        assert seen.setdefault(w, roots.get(v, v - (1 << 64) if v >> 63 else v)) == roots.get(v, v - (1 << 64) if v >> 63 else v)
    assert len(set(seen.values())) == len(seen)


def test_bit_sliced_mask_equals_popcount():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, dtype=np.uint64)
    values = base ^ (np.uint64(1) << rng.integers(0, 64, 700, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 700, dtype=np.uint64))
    values = np.concatenate([values, rng.integers(0, 1 << 63, 2000, dtype=np.uint64)])
    planes = simhash.bit_planes(values)
    for radius in (0, 1, 2, 3, 5):
        for v in values[:40]:
            mask = np.unpackbits(simhash.within(planes, int(v), radius, span=4).view(np.uint8), bitorder="little")[: len(values)]
            assert (mask == (np.bitwise_count(values ^ v) <= radius)).all()
    links = simhash.bucket_links(np.unique(values), 2)
    assert len(set(b for _, b in links)) == len(links)


def test_components_of_a_chain(spark):
    rows = [(i, i + 1) for i in range(0, 200)] + [(500, 501), (501, 500), (7, 7)]
    found = dict((r.node, r.root) for r in components(spark.createDataFrame(rows, "a long, b long")).collect())
    assert found == {i: 0 for i in range(201)} | {500: 500, 501: 500}
