import numpy as np
from tests.llm.helpers import CASES, cases

from layerworks.llm import toxicity
from layerworks.llm.queries import op3_toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    scores = {r.doc_id: r for r in op3_toxicity(spark, SF).collect()}
    marks = [(scores[r.doc_id], r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    held = [(s, y) for s, y in marks if s.held_out]
    one, zero = [s.score for s, y in held if y], [s.score for s, y in held if not y]
    auc = np.mean([[a > b for b in zero] for a in one])
    print("auc", auc, "recall", np.mean([s.predicted for s, y in held if y]), "false", np.mean([s.predicted for s, y in held if not y]))
    assert auc > 0.93


def test_misspelling_shares_vectors():
    rng = np.random.default_rng(1)
    plain = "table chair window garden river mountain paper music".split()
    texts, labels = [], []
    for i in range(400):
        w = list(rng.choice(plain, 12))
        if i % 2:
            w[int(rng.integers(12))] = "worthless"
        texts.append(" ".join(w))
        labels.append(i % 2)
    s = toxicity.Scorer(*toxicity.train(texts, np.array(labels), max_share=0.6).folded())
    clean = s.score(" ".join(plain))
    assert s.score("table chair wurthless garden river") > clean
    assert s.score("table chair worthless garden river") > 0.5 > clean


def test_awkward(spark):
    labels = spark.createDataFrame([(1, 0, 1), (5, 1, 0), (5, 1, 1), (None, 1, 1), (6, 1, None), (7, 0, 0)], "doc_id long, toxic int, other int")
    model = toxicity.fit(cases(spark), labels)
    out = toxicity.score(cases(spark), model).collect()
    assert len(out) == len(CASES) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(cases(spark).limit(0), model).count() == 0
    none = toxicity.fit(cases(spark).limit(0), labels.limit(0))
    assert len({r.score for r in toxicity.score(cases(spark), none).collect()}) >= 1


def test_frequent_and_rare_words_of_toxic_texts_are_learned():
    """With the defaults: a word in nearly all toxic texts, and one in 6 of 1,000 texts."""
    rng = np.random.default_rng(1)
    plain = "table chair window garden river mountain paper music".split()
    texts, labels = [], []
    for i in range(1000):
        w = list(rng.choice(plain, 12))
        if i % 2:
            w[int(rng.integers(12))] = "despicable" if i < 12 else "worthless"
        texts.append(" ".join(w))
        labels.append(i % 2)
    s = toxicity.Scorer(*toxicity.train(texts, np.array(labels)).folded())
    for word in ("worthless", "wurthless", "despicable"):
        assert s.score(f"table chair {word} garden river") > 0.5 > s.score("table chair garden river")


def test_sample_is_bounded_in_rows_and_bytes(spark):
    """Repeated rows of an id count once, and long texts stop the sample at its bytes."""
    rows = [(1, f"bad words {i}") for i in range(10_000)] + [(2, f"good words {i}") for i in range(10_000)] + [(i, "x" * 1000) for i in range(3, 103)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] + [(i, 0) for i in range(2, 103)], "doc_id long, toxic int")
    one = toxicity._known(labels, "doc_id", "toxic")
    sample = toxicity.labelled_sample(docs, one, "doc_id", "text", 2500, 10_050).collect()
    assert [r._y for r in sample].count(1) == 1 and 9 <= [r._y for r in sample].count(0) <= 11
    assert sum(len(r.text) for r in sample if r._y == 0) <= 10_050
    assert len(toxicity.labelled_sample(docs, one, "doc_id", "text", 40, 1 << 30).collect()) == 41


def test_rows_at_the_threshold():
    """A text whose log odds are those of 0.3 scores 0.3 or the next numbers beside it."""
    s = toxicity.Scorer(np.zeros(toxicity.BUCKETS), float(np.log(0.3 / 0.7)))
    assert abs(s.score("any text at all") - 0.3) < 1e-15 and s.score("") == s.score(None)
