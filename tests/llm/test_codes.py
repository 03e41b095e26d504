import hashlib

import duckdb
import numpy as np
import pytest

from layerworks.llm import codes
from layerworks.llm.queries import SQL, op11_vector_codes

SF = "/root/testdata/sf0.01"


def brute(rows, parts=8, entries=16, rounds=6):
    """(id, label, code, error) of each kept row and the codebooks, by comparing all with all."""
    kept = [(i, np.floor(4096 * np.array(v, float)).astype(int), label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    first = {}
    for i, v, _ in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1].astype("<i4").tobytes())):
        first.setdefault(i, v)
    x = np.stack([v for _, v, _ in kept]).reshape(len(kept), parts, -1)
    books = np.stack(list(first.values())[:entries]).reshape(-1, parts, x.shape[2]).swapaxes(0, 1).copy()
    for r in range(rounds + 1):
        d = ((x[:, :, None] - books[None]) ** 2).sum(3)
        near = d.argmin(2)
        if r < rounds:
            for p in range(parts):
                for e in set(near[:, p]):
                    books[p, e] = x[near[:, p] == e, p].sum(0) // (near[:, p] == e).sum()
    return [(i, label, bytes(c.tolist()), int(s)) for (i, _, label), c, s in zip(kept, near, d.min(2).sum(1))], books


def key(row):
    return tuple((x is not None, x) if x is not None else (False, 0) for x in row)


@pytest.mark.parametrize("parts,entries,rounds", [(8, 16, 6), (4, 40, 9), (2, 3, 2), (8, 1, 3)])
def test_equals_plain_rounds(spark, parts, entries, rounds):
    rng = np.random.default_rng(parts)
    centres = rng.standard_normal((30, 16))
    v = centres[rng.integers(0, 30, 1500)] + 0.2 * rng.standard_normal((1500, 16))
    v[400:800] = v[7]
    rows = [(int(i), x.tolist(), int(i) % 5 or None) for i, x in zip(rng.permutation(3000)[:1500], v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    found = codes.compress(df, parts=parts, entries=entries, rounds=rounds)
    want, books = brute(rows, parts, entries, rounds)
    assert np.array_equal(found.codebooks, books)
    assert sorted(((r.vec_id, r.label, bytes(r.code), r.error) for r in found.rows.collect()), key=key) == sorted(want, key=key)


def test_bounds_settle_most_parts():
    rng = np.random.default_rng(3)
    x = np.floor(4096 * (rng.standard_normal((12, 8))[rng.integers(0, 12, 4000)] + 0.05 * rng.standard_normal((4000, 8)))).astype(np.int64)
    part, books = np.zeros(4000, np.int64), x[None, :16].copy()
    state, drift, b, used = None, np.zeros((1, 16)), 4, []
    for r in range(6):
        state, needed = codes.assign(x, part, books, state, drift, b)
        d = ((x[:, None] - books[0]) ** 2).sum(2)
        assert np.array_equal(state.entry, d.argmin(1))
        assert (state.upper >= np.sqrt(d.min(1))).all()
        for z in range(state.ids.shape[1]):
            rest = np.ones_like(d, bool)
            rest[np.arange(4000), state.entry] = False
            np.put_along_axis(rest, state.ids[:, :z], False, 1)
            assert (np.minimum(state.lower[:, z:].min(1), state.outer) <= np.sqrt(np.where(rest, d, np.inf).min(1))).all()
        new = np.stack([x[state.entry == e].sum(0) // (state.entry == e).sum() if (state.entry == e).any() else books[0, e] for e in range(16)])[None]
        drift, books = np.sqrt(((new - books) ** 2).sum(2)) * (1 + 1e-12), new
        if r:
            used.append(needed)
            b = codes.adapted(b, needed, 2)
    assert b == 2 and used[-1][0] > 0.8 * 4000 and used[-1][16] < 100


def test_state_round_trip():
    rng = np.random.default_rng(0)
    for b in (0, 1, 4):
        s = codes.State(rng.integers(0, 16, 24), rng.random(24), rng.integers(0, 16, (24, b)), rng.random((24, b)), rng.random(24))
        t = codes.State.unpack(s.pack(8).slice(1), 8)
        assert (t.entry == s.entry[8:]).all() and (t.ids == s.ids[8:]).all()
        assert (t.upper >= s.upper[8:]).all() and (t.lower <= s.lower[8:]).all() and (t.outer <= s.outer[8:]).all()
        assert np.allclose(t.upper, s.upper[8:]) and np.allclose(t.lower, s.lower[8:])


def test_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [0.5, -0.5], None), (3, [0.25, 0.1], 1), (3, [0.25, -0.1], 1), (3, [0.25, -0.1], 1), (None, [9.0, 9.0], 2), (1, None, 1), (2, [None, 1.0], 1), (4, [nan, 1.0], 1),
            (6, [inf, 1.0], 1), (7, [1.0, -inf], None), (8, [-0.00001, 0.0], None)]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<float>, label int, code string, error double")
    want, books = brute([(i, v and [x if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows], 2, 3, 4)
    found = codes.compress(df, parts=2, entries=3, rounds=4)
    assert np.array_equal(found.codebooks, books)
    assert sorted(((r.vec_id, r.label, bytes(r.code), r.error) for r in found.rows.collect()), key=key) == sorted(want, key=key)
    out = codes.label_errors(found.rows).collect()
    assert len(out) == 6
    for r in out:
        assert r.label_error == sum(e for _, label, _, e in want if label == r.label)


def test_empty_odd_and_large(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(1, None, 1)], [(1, [1.0, 2.0, 3.0], 1)], [(1, [], 1)]):
        found = codes.compress(spark.createDataFrame(rows, schema))
        assert found.rows.collect() == [] and found.codebooks.size == 0 and codes.label_errors(found.rows).collect() == []
    found = codes.compress(spark.createDataFrame([(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)], schema))
    assert [(r.vec_id, r.error) for r in found.rows.collect()] == [(1, 0)]
    with pytest.raises(Exception, match="would not fit"):
        codes.compress(spark.createDataFrame([(1, [1e30] * 8, 1)], schema))


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.execute(SQL["op11_vector_codes"]).df()
    got = op11_vector_codes(spark, SF)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.itertuples(index=False, name=None))
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    books = brute(rows)[1]
    assert want.codebooks_sha256[0] == hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
