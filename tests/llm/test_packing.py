import zlib

import numpy as np
import pytest
from tests.llm.helpers import CASES, cases, documents, small
from tokenizers import Tokenizer

from layerworks.llm import packing
from layerworks.llm.queries import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


def check(rows, pairs, limit):
    t = Tokenizer.from_file(PATH)
    wanted = []
    for d, text in pairs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % limit or limit
        edges = [0, *range(first, len(ids) + 1, limit)] if len(ids) > limit else [0, len(ids)]
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            wanted.append((d, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    key = lambda x: str(x)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(wanted, key=key)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= limit
    return bins


def test_documents(spark):
    rows = packing.pack_documents(small(spark), PATH).collect()
    bins = check(rows, documents(), 2048)
    least = -(-sum(r.length for r in rows) // 2048)
    assert len(bins) <= least * 1.05 + 1


def test_awkward_and_small_groups(spark):
    check(packing.pack_documents(cases(spark), PATH, max_tokens=64, group_pieces=100).collect(), CASES, 64)
    assert packing.pack_documents(cases(spark).limit(0), PATH).count() == 0


def test_ids_equal_the_library_on_any_mix_of_common_characters():
    rng = np.random.default_rng(3)
    e = packing.encoder(PATH)
    chars = [*map(chr, [*range(9, 14), *range(32, 127), *range(160, 384)]), " ", " ", "\n", "'s", "'re", " a", "x"]
    for _ in range(400):
        text = "".join(rng.choice(chars, 60))
        assert e.encode(text) == np.array(e.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 60, 500)
    bins, offsets = packing.best_fit(lengths, (100, 6, 4000), (1, 0.5, 0.5), rule)
    for b in np.unique(bins):
        some = lengths[bins == b]
        assert some.sum() <= 100 and len(some) <= 6 and (some**2).sum() <= 4000


def test_default_weights_leave_the_fewest_sequences():
    """All three residuals have weight, and as few sequences come out as by tokens alone."""
    rng = np.random.default_rng(2)
    lengths = np.minimum(2048, rng.lognormal(6, 1.2, 6000).astype(int) + 1)
    capacity = (2048, 2048, 2048.0**2)
    plain, ours = (len(set(packing.best_fit(lengths, capacity, w, "norm")[0].tolist())) for w in ((1, 0, 0), packing.WEIGHTS))
    assert min(packing.WEIGHTS) > 0 and ours <= plain <= -(-int(lengths.sum()) // 2048) + 3
    # the sequence with more documents or the one with fewer tokens left, by what has weight
    for weights, with_piece in (((1, 0, 0), 0), ((0, 1, 0), 1), ((0.1, 1, 0), 1)):
        bins, _ = packing.best_fit(np.array([70, 31, 31, 10]), (100, 6, 10_000), weights, "norm")
        assert bins[3] == bins[with_piece]


def test_rows_equal_in_all_are_spread_over_groups(spark):
    df = spark.range(5000).selectExpr("cast(null as long) as doc_id", "cast(null as string) as text")
    out = packing.pack_documents(df, PATH, max_tokens=64, group_pieces=500)
    rows = out.collect()
    assert len(rows) == 5000 and len({r.sequence_id >> 32 for r in rows}) == 10
    check(rows, [(None, None)] * 5000, 64)
