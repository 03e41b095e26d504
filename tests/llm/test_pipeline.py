import corpus_pipeline
from tests.llm import test_lines, test_packing, test_repeats, test_simhash
from tests.llm.helpers import CASES, SF, cases

from layerworks.llm.common import read_documents, written


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def check_stages(spark, docs):
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    clean = written(steps["toxicity"](spark, docs, SF))
    assert clean.columns == columns
    lines = written(steps["line_dedup"](spark, clean, SF))
    want = [(d, t) for d, _, _, _, t in test_lines.brute(pairs(clean), 10)]
    assert lines.columns == columns and sorted(pairs(lines), key=str) == sorted(want, key=str)
    near = written(steps["simhash_near_dedup"](spark, lines, SF))
    keep = {d for d, _, c in test_simhash.brute(pairs(lines)) if d == c}
    assert near.columns == columns and sorted(pairs(near), key=str) == sorted((p for p in pairs(lines) if p[0] in keep), key=str)
    cut = written(steps["substring_dedup"](spark, near, SF))
    assert cut.columns == columns
    assert sorted(pairs(cut), key=str) == sorted(((d, t) for d, _, _, t in test_repeats.brute(pairs(near), 35)), key=str)
    if "n_chars" in columns:
        assert all(r.n_chars == len(r.text) for r in cut.collect())
    test_packing.check(steps["best_fit_packing"](spark, cut, SF).collect(), pairs(cut), 2048)


def test_stages_against_brute_force(spark):
    check_stages(spark, read_documents(spark, SF))


def test_awkward(spark):
    check_stages(spark, cases(spark))


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert len(CASES)


def test_one_row_stays_of_each_near_duplicate_group(spark):
    own = [" ".join(f"{name}{i}" for i in range(60)) for name in ("a", "b", "c", "d")]
    rows = [
        (1, own[0], "en", None),  # repeated whole, and with another source
        (1, own[0], "en", None),
        (1, own[0], None, "en"),
        (None, own[0], "en", None),  # a copy without an id
        (2, own[0], "en", None),
        (1, own[1], "en", None),  # the kept id of another group, in one with a smaller id
        (0, own[1], "en", None),
        (None, own[2], "en", None),  # a group without ids
        (None, own[2], "en", None),
        (1, own[3], "en", None),  # two groups whose smallest id is 1
        (3, own[3], "en", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    near = written(corpus_pipeline.drop_near_duplicates(spark, docs, SF))
    assert sorted(pairs(near), key=str) == sorted([(1, own[0]), (0, own[1]), (None, own[2]), (1, own[3])], key=str)
    # no passage is lost to a copy of itself
    assert sorted(pairs(corpus_pipeline.drop_repeats(spark, near, SF)), key=str) == sorted(pairs(near), key=str)


def test_near_dedup_against_brute_force_groups(spark):
    from layerworks.llm.simhash import fingerprint

    docs = cases(spark).union(cases(spark))
    prints = [(d, t, fingerprint(t)) for d, t in CASES]
    groups: list[list] = []
    for r in prints:
        linked = [g for g in groups if any((r[2] ^ x[2]).bit_count() <= 2 for x in g)]
        groups = [g for g in groups if g not in linked] + [[r, *[x for g in linked for x in g]]]
    least = sorted((min((r[0] is None, r[0] or 0) for r in g) for g in groups))
    got = pairs(corpus_pipeline.drop_near_duplicates(spark, docs, SF))
    assert sorted((d is None, d or 0) for d, _ in got) == least
