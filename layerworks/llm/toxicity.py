"""Toxicity: bags of subword embeddings, averaged, into a linear softmax.

A word's vector is the mean of the vectors of its hashed character n-grams (of the word
between marks, and the whole of it); a text's vector is the mean over its distinct words; two logits
follow.  Embeddings and softmax are trained jointly in numpy (Adam).  A misspelling
that was never seen shares n-grams with words that were.

The fit uses at most ``max_per_label`` labelled texts of each label, those with the smallest
hash of the id, and of them at most ``max_bytes``: a bounded sample of labelled rows, the only thing that
reaches the driver.  Scoring is linear in a text's words: embeddings and softmax fold to one number for
each bucket, sent to the tasks as an array of fixed size.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from layerworks.llm.common import mix, text_slices

BUCKETS = 1 << 17
DIM = 4
CACHE = 200_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams_of(words: list[str], low: int = 3, high: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """(word index, bucket) of all character n-grams of the words between marks, and of each
    whole word; for all words at once, from hashes that grow by a character."""
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    end = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    room = np.repeat(end, sizes) - np.arange(len(codes))  # characters from here to the word's end
    whole = np.add.reduceat(mix(codes + room.astype(np.uint64) * _STEP), end - sizes) if len(words) else codes
    who, out = [np.arange(len(words))], [mix(whole)]
    h = codes * _STEP
    for n in range(2, high + 1):
        h = h[:-1] * _STEP + codes[n - 1 :] if len(h) > 1 else h[:0]
        if n >= low:
            inside = room[: len(h)] >= n
            who.append(owner[: len(h)][inside])
            out.append(mix(h[inside] + np.uint64(n)))
    return np.concatenate(who), (np.concatenate(out) % np.uint64(BUCKETS)).astype(np.int32)


class Model:
    """Trained arrays: ``embedding`` (BUCKETS x DIM), ``softmax`` (DIM x 2), ``bias`` (2)."""

    def __init__(self, embedding: np.ndarray, softmax: np.ndarray, bias: np.ndarray):
        self.embedding, self.softmax, self.bias = embedding, softmax, bias

    def folded(self) -> tuple[np.ndarray, float]:
        """(one number per bucket, offset): a text's log odds are their mean plus the offset."""
        return (self.embedding @ (self.softmax[:, 1] - self.softmax[:, 0])).astype(np.float64), float(self.bias[1] - self.bias[0])


def _bags(texts: list[str], min_texts: int, max_share: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, weights) of each text: a bucket's share in the mean over distinct words.  Buckets
    in fewer than ``min_texts`` texts are left out, and those in more than ``max_share`` of them."""
    number: dict[str, int] = {}
    docs = [np.array([number.setdefault(w, len(number)) for w in sorted(set(words_of(t)) or {""})]) for t in texts]
    if not number:
        return []
    flats, sizes, words = [], [], list(number)
    for i in range(0, len(words), 10_000):  # the hashes of all words at once would take far more room
        who, grams = grams_of(words[i : i + 10_000])
        flats.append(grams[np.argsort(who, kind="stable")])
        sizes.append(np.bincount(who))
    flat, size = np.concatenate(flats), np.concatenate(sizes)
    begin = np.cumsum(size) - size
    bags = []
    often = np.zeros(BUCKETS, np.int64)
    for d in docs:
        n = size[d]
        at = np.repeat(begin[d], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ids, inverse = np.unique(flat[at], return_inverse=True)
        bags.append((ids, np.bincount(inverse, np.repeat(1 / (len(d) * n), n)).astype(np.float32)))
        often[ids] += 1
    use = (often >= min_texts) & (often <= max(min_texts, max_share * len(texts)))
    for i, (ids, share) in enumerate(bags):
        bags[i] = ids[use[ids]], share[use[ids]]
    return bags


def train(
    texts: list[str], labels: np.ndarray, prior: float | None = None, steps: int = 700, batch: int = 64, rate: float = 0.02, scale: float = 30.0, penalty: float = 0.1, min_texts: int = 3, max_share: float = 1.0, seed: int = 7
) -> Model:
    """Joint fit of embeddings and softmax by Adam, with a proximal step on each embedding's norm
    (a group penalty, so that n-grams of single texts stay at zero).  Labels are balanced by
    weights; ``prior`` (share of label 1 where texts come from, else that of ``labels``) then
    shifts the offset by half its log odds, between a balanced and a calibrated rule.

    N-grams of three texts are learned from, however many texts there are, and none is too
    frequent: one that stands in most texts of one label and in none of the other tells most."""
    rng = np.random.default_rng(seed)
    bags = _bags(texts, min_texts, max_share)
    emb, soft, bias = np.zeros((BUCKETS, DIM), np.float32), rng.choice([-0.5, 0.5], (DIM, 1)) * np.array([[-1.0, 1.0]]), np.zeros(2)
    mean, square = np.zeros_like(emb), np.zeros_like(emb)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (soft, bias)]
    share = float(labels.mean()) if len(labels) else 0.0
    if not 0 < share < 1:
        return Model(emb, soft, bias)
    weights = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    step = 0
    epochs = max(8, min(60, -(-steps * batch // len(bags))))
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        r = rate * (1.05 - epoch / epochs)
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            who = np.repeat(np.arange(len(some)), [len(bags[i][0]) for i in some])
            part = np.concatenate([bags[i][1] for i in some])
            rows, local = np.unique(np.concatenate([bags[i][0] for i in some]), return_inverse=True)
            e = emb[rows]
            doc = scale * np.stack([np.bincount(who, e[local, d] * part, len(some)) for d in range(DIM)], 1)
            logits = doc @ soft + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(some)), labels[some]] -= 1
            g = p * weights[some][:, None] / len(some)
            back = scale * g @ soft.T
            grad = np.stack([np.bincount(local, back[who, d] * part, len(rows)) for d in range(DIM)], 1)
            step += 1
            fix1, fix2 = 1 - 0.9**step, 1 - 0.99**step
            mean[rows] = 0.9 * mean[rows] + 0.1 * grad
            square[rows] = 0.99 * square[rows] + 0.01 * grad**2
            e = e - r * (mean[rows] / fix1) / (np.sqrt(square[rows] / fix2) + 1e-6)
            norm = np.linalg.norm(e, axis=1, keepdims=True)
            emb[rows] = e * np.maximum(0, 1 - r * penalty * DIM**0.5 / np.maximum(norm, 1e-12))
            for (m, v), param, grad in zip(state, (soft, bias), (doc.T @ g, g.sum(0)), strict=True):
                m[:] = 0.9 * m + 0.1 * grad
                v[:] = 0.99 * v + 0.01 * grad**2
                param -= 0.3 * r * (m / fix1) / (np.sqrt(v / fix2) + 1e-8)
    prior = min(max(share if prior is None else prior, 1e-6), 1 - 1e-6)
    return Model(emb * scale, soft, bias + 0.5 * np.log([1 - prior, prior]))


class Scorer:
    """Scores texts with a folded model; a word's number is kept in a bounded cache."""

    def __init__(self, weights: np.ndarray, offset: float):
        self.weights, self.offset = weights, offset
        self.cache: dict[str, float] = {}
        self.old: dict[str, float] = {}

    def _learn(self, words: set[str]) -> None:
        """Puts the numbers of words into the cache; those in use lately come from the last one."""
        if len(self.cache) > CACHE:
            self.cache, self.old = {}, self.cache
        missing = []
        for w in words:
            if w not in self.cache:
                if (x := self.old.get(w)) is not None:
                    self.cache[w] = x
                else:
                    missing.append(w)
        if missing:
            who, grams = grams_of(missing)
            n = len(missing)
            self.cache.update(zip(missing, (np.bincount(who, self.weights[grams], n) / np.bincount(who, minlength=n)).tolist(), strict=True))

    def scores(self, texts: list[str | None]) -> list[float]:
        words = [set(words_of(t or "")) or {""} for t in texts]
        self._learn(set().union(*words))
        get = self.cache.__getitem__
        odds = [self.offset + math.fsum(map(get, w)) / len(w) for w in words]
        return (1 / (1 + np.exp(-np.clip(odds, -500, 500)))).tolist()

    def score(self, text: str | None) -> float:
        return self.scores([text])[0]


def _known(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """(_id, _y) of ids with one label; rows without an id or label, and ids with both, do not count."""
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y")).filter("_y in (0, 1) and _id is not null")
    return known.groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_z")).filter("_y = _z").drop("_z")


def labelled_sample(df: DataFrame, one: DataFrame, doc_id: str, text: str, max_per_label: int, max_bytes: int) -> DataFrame:
    """(text, label): for each label the ids of ``one`` with the smallest hashes, at most
    ``max_per_label`` (chosen on ids; texts are fetched for those alone) with one text each, that of the smallest
    hash; of these, in the same order, those whose texts add up to ``max_bytes`` at most."""
    chosen = None
    for y in (0, 1):
        part = one.filter(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(max_per_label)
        chosen = part if chosen is None else chosen.unionByName(part)
    # 2 * max_per_label rows of two numbers: broadcast, so that texts stay where they are
    rows = df.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), "_id")
    each = rows.groupBy("_id", "_y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least")).select("_id", "_y", "least.text")
    order = Window.partitionBy("_y").orderBy(F.xxhash64("_id"), "_id").rowsBetween(Window.unboundedPreceding, 0)
    return each.withColumn("_bytes", F.sum(F.octet_length("text")).over(order)).filter(F.col("_bytes") <= max_bytes).select("text", "_y")


def fit(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_per_label: int = 2500, max_bytes: int = 48 << 20, **options) -> Model:
    """Trains on ``labels`` (doc_id, label) of ``df``.  Without two labels the model scores all texts alike.

    The sample is bounded in rows and bytes for each label, whatever the tables hold; an id counts
    once, however many rows have it, and null texts count as empty."""
    one = _known(labels, doc_id, label)
    prior = one.agg(F.avg("_y")).first()[0]
    rows = labelled_sample(df, one, doc_id, text, max_per_label, max_bytes).toPandas()
    rows = rows.sort_values(["_y", "text"], ignore_index=True)  # the fit does not depend on how rows came
    return train(rows["text"].tolist(), rows["_y"].to_numpy(np.int64), prior, **options)


def score(df: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Adds ``score`` (0 to 1) to the rows of ``df``; null and empty texts get the score of a
    text without words.  A column of this name is replaced.

    Whole texts of any length are scored, repeated rows alike; an empty table stays empty.  A score equal to a
    caller's threshold is that caller's to decide (``op3_toxicity`` predicts 1 from 0.3 on)."""
    base = df.drop("score")
    own = [c for c in base.columns if keep_text or c != text]
    weights, offset = model.folded()
    sent = df.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value.astype(np.float64), offset)
        for whole in batches:
            for b in text_slices(whole, text):
                found = scorer.scores(b.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([*map(b.column, own), pa.array(found, pa.float64())], names=[*own, "score"])

    fields = [f for f in base.schema.fields if f.name in own]
    return base.mapInArrow(run, T.StructType([*fields, T.StructField("score", T.DoubleType())]))
