import numpy as np

from layerworks.llm import ann
from layerworks.llm.queries import op8_nearest_neighbours

SF = "/root/testdata/sf0.01"


def brute(ids, v, queries, k):
    out = {}
    for q in queries:
        s = v @ v[ids.index(q)]
        order = sorted((-x, i) for x, i in zip(s, ids) if i != q)[:k]
        out[q] = [(i, -x) for x, i in order]
    return out


def test_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, v = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    want = brute(ids, v, [i for i in ids if i % 20 == 0], 20)
    got = {}
    for r in op8_nearest_neighbours(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
        assert abs(r.score - float(v[ids.index(r.query_id)] @ v[ids.index(r.vec_id)])) < 1e-12
    assert got.keys() == want.keys() and all(len(g) == 20 for g in got.values())
    hit = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    print("recall", np.mean(hit) / 20)
    assert np.mean(hit) / 20 >= 0.9
    for q in got:
        assert [(-s, i) for i, s in got[q]] == sorted((-s, i) for i, s in got[q])


def test_recall_over_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    v = rng.standard_normal((3000, 24)) * rng.uniform(0.2, 3, (3000, 1))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "BLOCK_ROWS", 700)
    got = {}
    for r in ann.search(df, df.filter("vec_id % 50 = 0"), 10).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(list(range(3000)), v, range(0, 3000, 50), 10)
    assert np.mean([len(got[q] & {i for i, _ in want[q]}) for q in want]) / 10 >= 0.9


def test_awkward(spark):
    rows = [
        (0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
        (6, [None, 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (40, []), (9, [-1.0, 0.5]), (60, [0.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "vec_id long, embedding array<double>, score double, rank string")
    out = ann.search(df, df.filter("vec_id % 20 = 0"), 3).collect()
    found = {}
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found == {0: [(1, 2.0), (2, 2.0), (20, 1.0)], 20: [(1, 2.0), (2, 2.0), (0, 1.0)]}
    assert ann.search(df.limit(0), df.limit(0)).count() == 0


def test_equal_vectors_tie_by_id():
    rng = np.random.default_rng(5)
    v = rng.standard_normal((1500, 64))
    v[rng.choice(1500, 700, replace=False)] = v[7]
    ids = rng.permutation(5000)[:1500]
    b = ann.Block(ids, v, float(np.sqrt((v**2).sum(1)).max()))
    queries = np.concatenate([v[7:8], v[7:8] + 0.01 * rng.standard_normal((40, 64))])
    q, found, score = b.search(np.arange(10000, 10041), queries, 20, 0.97)
    same = sorted(ids[(v == v[7]).all(1)])[:20]
    for i in range(41):
        assert found[q == i].tolist() == same and len(set(score[q == i])) == 1


def test_ids_with_several_vectors(spark, monkeypatch):
    """An id takes one place, with its best score, in one block and over several."""
    rows = [(0, [1.0, 0.0])] + [(1, [5.0 - i / 100, 1.0]) for i in range(300)] + [(2, [2.0, 0.0]), (2, [0.5, 0.0]), (3, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block in (4096, 100):
        monkeypatch.setattr(ann, "BLOCK_ROWS", block)
        out = ann.search(df, df.filter("vec_id = 0"), 3).orderBy("rank").collect()
        assert [(r.vec_id, r.score) for r in out] == [(1, 5.0), (2, 2.0), (3, 1.0)]
    rng = np.random.default_rng(4)
    v = rng.standard_normal((900, 6))
    rows = [(int(i), x.tolist()) for i, x in zip(rng.integers(0, 200, 900), v)]
    out = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), spark.createDataFrame(rows, "vec_id long, embedding array<double>").filter("vec_id % 20 = 0"), 10).collect()
    got = {}
    for r in out:
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    ids, s = np.array([i for i, _ in rows]), v @ v.T
    for q in got:
        best = {int(i): max(s[a, b] for a in np.flatnonzero(ids == q) for b in np.flatnonzero(ids == i)) for i in set(ids.tolist()) - {q}}
        want = dict(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:10])
        assert len(got[q]) == 10 and all(abs(best[i] - x) < 1e-12 for i, x in got[q].items()) and len(got[q].keys() & want.keys()) >= 9


def test_cells_of_the_tree_hold_all_rows():
    rng = np.random.default_rng(1)
    points = rng.standard_normal((3000, ann.PROJECTED))
    for cells in (1, 2, 7, 64):
        found = ann.top_of(points[:1000], cells).cells(points)
        assert set(found) == set(range(cells)) and np.bincount(found).max() < 3 * 3000 / cells
    same = np.ones((500, ann.PROJECTED))
    assert set(ann.top_of(same, 8).cells(same)) == {0} and set(ann.top_of(points[:0], 4).cells(points)) == {0}


def test_clusters_are_searched_in_few_cells(spark, monkeypatch):
    """Tight clusters over many blocks: most cells and leaves are never visited."""
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((60, 32))
    v = centres[rng.integers(0, 60, 20_000)] + 0.05 * rng.standard_normal((20_000, 32))
    v[:6000] = v[6000]  # a third of all rows are one vector
    v /= np.linalg.norm(v, axis=1)[:, None]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "BLOCK_ROWS", 512)
    sent = []
    plain = ann._next_cells

    def counted(*a, **b):
        out = ann.written(plain(*a, **b), "counted")
        sent.append(out.count())
        return out

    monkeypatch.setattr(ann, "_next_cells", counted)
    asked = df.filter("vec_id % 100 = 50 and vec_id >= 6000")
    got = {}
    for r in ann.search(df, asked, 10).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(list(range(20_000)), v, sorted(got), 10)
    assert len(got) == 140 and np.mean([len(got[q] & {i for i, _ in want[q]}) for q in want]) / 10 >= 0.9
    print("cells sent to", sum(sent), "of", 140 * 40)
    assert sum(sent) < 0.3 * 140 * 40


def test_given_vectors_with_production_constants(spark):
    """All vectors of the larger table against exact search, and the share of leaves visited."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    block = ann.Block(ids, v, float(np.sqrt((v**2).sum(1)).max()))
    asked = np.flatnonzero(ids % 20 == 0)
    q, found, _ = block.search(ids[asked], v[asked], 20, ann.CONFIDENCE)
    want = brute(ids.tolist(), v, ids[asked].tolist(), 20)
    recall = np.mean([len(set(found[q == i].tolist()) & {x for x, _ in want[ids[asked][i]]}) for i in range(len(asked))]) / 20
    share = block.visited / (len(asked) * len(block.rows))
    print("recall", recall, "leaves visited", share)
    assert recall >= 0.9 and share < 1
