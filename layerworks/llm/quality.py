"""Quality rules: robust multivariate outliers among documents' statistics.

Each document that passes the base rule gives a vector of five transformed statistics
(log words, mean word length, and the square roots of symbol, duplicate-line and repeated-
word shares).  For each (language, source) the minimum-covariance-determinant estimate is
found by concentration steps over *all* its rows: distances to the current centre, their
``share`` quantile, then centre and covariance of the rows below it, all as Spark
aggregates, so that a source with a third of the rows is as cheap per row as any other.
Two deterministic starts are followed (medians with MADs; spatial signs), the smaller
determinant wins, and one reweighting follows.  A document is rejected when its squared
Mahalanobis distance exceeds the chi-square quantile at ``confidence``.

Each (language, source) is fitted, and so are each language and the whole table; a
group below ``min_rows`` uses the next wider one, and if none is large enough all are kept.
Covariances get a floor per statistic (``FLOOR`` squared), as a share that is zero in
nearly all documents would have no spread at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerworks.llm.chisquare import chi2_quantile, consistency, symmetric, upper_triangle
from layerworks.llm.common import tag_hash, text_bytes, text_slices, window_hashes, word_table, written

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"
FLOOR = (0.25, 0.04, 0.05, 0.15, 0.15)
K = len(FLOOR)
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in SYMBOLS]] = 1
_CHAR = np.array([(b & 0xC0 != 0x80) and b != 0x20 and not 9 <= b <= 13 for b in range(256)], np.int64)


def text_statistics(text: pa.Array) -> dict[str, np.ndarray]:
    """The five counts (and the number of lines with a word) of each text; null counts as empty."""
    data, offsets = text_bytes(text)
    row, words, _, _ = word_table(text)
    n = len(text)

    def per_text(values: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(values))
        return sums[offsets[1:]] - sums[offsets[:-1]]

    out = {"n_words": np.bincount(row, minlength=n), "word_chars": per_text(_CHAR[data]), "n_symbols": per_text(_SYMBOL[data])}
    lines, dup = np.zeros(n, np.int64), np.zeros(n, np.int64)
    raw = data.tobytes()
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        full = [x for x in raw[a:b].split(b"\n") if x.strip()]
        lines[i], dup[i] = len(full), len(full) - len(set(full))
    repeated = np.zeros(len(words), bool)
    if len(words) >= 3:
        whole = np.flatnonzero(row[:-2] == row[2:])
        _, which, times = np.unique(tag_hash(window_hashes(words, 3)[whole], row[whole]), return_inverse=True, return_counts=True)
        at = whole[times[which] > 1]
        for i in range(3):
            repeated[at + i] = True
    return out | {"n_dup_lines": dup, "n_repeat_words": np.bincount(row[repeated], minlength=n), "n_lines": lines}


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns but the text, the five counts and ``n_lines``, all long."""
    own = [c for c in df.columns if c != text]
    names = (*STATS, "n_lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, text):
                found = text_statistics(b.column(text))
                yield pa.RecordBatch.from_arrays([*map(b.column, own), *[pa.array(found[c].astype(np.int64)) for c in names]], names=[*own, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in own)
    return df.mapInArrow(run, schema + "".join(f", {c} long" for c in names))


def base_failed() -> Column:
    """The rule before the estimate: too few words, or over half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def transformed() -> list[Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)).cast("double"))
    return [F.log(words), F.col("word_chars") / words / 10, share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")]


def _levels() -> Column:
    """A row's groups, from (language, source) to the whole table."""
    lang, source = F.coalesce(F.col("lang").cast("string"), F.lit("")), F.coalesce(F.col("source").cast("string"), F.lit(""))
    level = lambda i, *x: F.struct(F.lit(i).alias("level"), *[v.alias(n) for v, n in zip(x, ("a", "b"), strict=True)])
    return F.array(level(0, lang, source), level(1, lang, F.lit("")), level(2, F.lit(""), F.lit("")))


def _distance() -> Column:
    """Squared Mahalanobis distance of x0..x4 from ``mu`` by the upper triangle ``inv``."""
    d = [F.col(f"x{i}") - F.col("mu")[i] for i in range(K)]
    return sum((d[i] * d[j] * F.col("inv")[n] * (1 if i == j else 2) for n, (i, j) in enumerate(upper_triangle(K))), F.lit(0.0))


def _moments(rows: DataFrame, by: list[str]) -> DataFrame:
    """Count, sums and products of x0..x4; one row for each group."""
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in range(K)]
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{n}") for n, (i, j) in enumerate(upper_triangle(K))]
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.array(*sums).alias("s"), F.array(*products).alias("p"))


_FIT = "g struct<level:int,a:string,b:string>, start int, n long, mu array<double>, inv array<double>, logdet double"


def _estimates(moments: DataFrame, share: float) -> DataFrame:
    """Centre, inverse covariance and its determinant from each group's moments."""
    factor = consistency(share, K)
    floor = np.diag(np.array(FLOOR) ** 2)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            mu, inv, det = [], [], []
            for n, s, p in zip(b["n"], b["s"], b["p"], strict=True):
                m = np.array(s) / n
                cov = (symmetric(np.array(p), K) / n - np.outer(m, m)) * factor
                values, vectors = np.linalg.eigh(cov)  # rounding may leave tiny negative values
                cov = (vectors * np.maximum(values, 0)) @ vectors.T + floor
                back = np.linalg.inv(cov)
                mu.append(m.tolist())
                inv.append([float(back[i, j]) for i, j in upper_triangle(K)])
                det.append(float(np.linalg.slogdet(cov)[1]))
            yield b[["g", "start", "n"]].assign(mu=mu, inv=inv, logdet=det)

    return moments.mapInPandas(run, _FIT)


def mcd(rows: DataFrame, share: float = 0.75, settled: float = 0.01, steps: int = 50, min_rows: int = 1) -> DataFrame:
    """Reweighted minimum-covariance-determinant estimate of each group ``g`` of ``rows``
    (columns g, x0..x4) with ``min_rows`` rows or more: g, n (all its rows), mu, inv.

    Three deterministic starts; C-steps go on for each group and start until the log determinant moves
    by less than ``settled`` (the quantiles in a step are approximate, so it need not come to rest
    exactly); ``steps`` only guards against an endless cycle, and reaching it is an error."""
    xs = [f"x{i}" for i in range(K)]
    rows = rows.select("g", *xs)
    # a row for each group is written before rows join it: small tables are then sent to the
    # rows, and where they are not, a large group's rows can be split
    halves = written(rows.groupBy("g").agg(F.count("*").alias("rows"), F.array(*[F.percentile_approx(x, 0.5, 2000) for x in xs]).alias("mid")).filter(F.col("rows") >= min_rows), "middles")
    away = rows.join(halves, "g").select("g", *[F.abs(F.col(x) - F.col("mid")[i]).alias(x) for i, x in enumerate(xs)])
    spread = away.groupBy("g").agg(F.array(*[F.greatest(1.4826 * F.percentile_approx(x, 0.5, 2000), F.lit(FLOOR[i])) for i, x in enumerate(xs)]).alias("mad"))
    scale = written(halves.join(spread, "g"), "scale")
    # start 0: medians and MADs
    diagonal = F.array(*[F.lit(0.0) if i != j else 1 / F.col("mad")[i] ** 2 for i, j in upper_triangle(K)])
    fit0 = scale.select("g", F.lit(0).alias("start"), F.col("rows").alias("n"), F.col("mid").alias("mu"), diagonal.alias("inv"), F.lit(0.0).alias("logdet"))
    # start 1: covariance of spatial signs about the medians, scaled back by the MADs
    z = [(F.col(x) - F.col("mid")[i]) / F.col("mad")[i] for i, x in enumerate(xs)]
    length = F.sqrt(sum((v * v for v in z), F.lit(1e-12)))
    signs = rows.join(scale, "g").select("g", "mid", "mad", *[(v / length * F.col("mad")[i] * K**0.5).alias(xs[i]) for i, v in enumerate(z)])
    around = _moments(signs.withColumn("start", F.lit(1)), ["g", "start"])
    fit1 = _estimates(around, 1.0).drop("mu").join(scale.select("g", F.col("mid").alias("mu")), "g").select("g", "start", "n", "mu", "inv", "logdet")
    # start 2: the half of the rows that is nearest to the medians, in MADs
    ranked = rows.join(scale, "g").select("g", *xs, length.alias("d"))
    middle = written(ranked.groupBy("g").agg(F.percentile_approx("d", 0.5, 2000).alias("limit")), "nearest")
    inner = ranked.join(middle, "g").filter("d <= limit").withColumn("start", F.lit(2))
    fit2 = _estimates(_moments(inner, ["g", "start"]), 0.5).select(*fit1.columns)
    start = written(fit0.unionByName(fit1).unionByName(fit2), "start")
    done, moving = None, start
    for step in range(steps + 1):
        if step == steps:
            raise RuntimeError(f"C-steps have not settled after {steps}")
        near = rows.join(moving.select("g", "start", "mu", "inv"), "g").select("g", "start", *xs, _distance().alias("d2"))
        limit = written(near.groupBy("g", "start").agg(F.percentile_approx("d2", share, 2000).alias("limit")), "limit")
        kept = near.join(limit, ["g", "start"]).filter("d2 <= limit")
        fit = _estimates(_moments(kept, ["g", "start"]), share)
        fit = written(fit.join(moving.select("g", "start", F.col("logdet").alias("before")), ["g", "start"]), "step")
        # the starts' determinants are of other things than a share of the rows
        rests = F.abs(F.col("logdet") - F.col("before")) < settled if step else F.lit(False)
        rest = fit.filter(rests).drop("before")
        done = rest if done is None else done.unionByName(rest)
        moving = fit.filter(~rests).drop("before")
        if moving.isEmpty():
            break
    fit = done
    best = written(fit.groupBy("g").agg(F.min_by(F.struct("mu", "inv"), F.struct("logdet", "start")).alias("f")).select("g", "f.*"), "best")
    near = rows.join(best, "g").select("g", *xs, _distance().alias("d2")).filter(F.col("d2") <= chi2_quantile(0.975, K))
    final = _estimates(_moments(near.withColumn("start", F.lit(0)), ["g", "start"]), 0.975)
    return written(final.join(scale.select("g", "rows"), "g").select("g", F.col("rows").alias("n"), "mu", "inv"), "fit")


def quality_rules(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", confidence: float = 1 - 1e-6, min_rows: int = 200, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``df``: the columns ``keep``, the five counts, base_failed, d2 (squared
    Mahalanobis distance; null if base_failed or no group is large enough) and kept.

    Null text is empty text: no words, base_failed.  Null language or source is a group of
    its own.  Repeated rows and null ids count as rows.  A distance equal to the cutoff is kept; texts of any length
    are read whole; an empty table stays empty; other columns of ``df`` are read only if ``keep`` names them."""
    given = [F.col(c) for c in keep]
    stats = statistics(df.select(*given, F.col(lang).alias("_lang"), F.col(source).alias("_source"), F.col(text).alias("text")))
    stats = written(stats.withColumn("base_failed", base_failed()), "statistics")
    vectors = [v.alias(f"x{i}") for i, v in enumerate(transformed())]
    rows = stats.withColumnsRenamed({"_lang": "lang", "_source": "source"})
    fits = mcd(rows.filter(~F.col("base_failed")).select(F.explode(_levels()).alias("g"), *vectors), min_rows=min_rows)
    # a group's widening is settled on group names, which are few beside the rows
    groups = rows.select(_levels().alias("gs")).distinct().select(F.col("gs")[0].alias("own"), F.explode("gs").alias("g"))
    fits = written(groups.join(fits, "g").groupBy("own").agg(F.min_by(F.struct("mu", "inv"), "g").alias("f")).select("own", "f.*"), "fits")
    judged = rows.select("*", *vectors, _levels()[0].alias("own")).join(fits, "own", "left")
    d2 = F.when(~F.col("base_failed"), _distance())
    limit = chi2_quantile(confidence, K)
    return judged.select(*keep, *STATS, "base_failed", d2.alias("d2")).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= limit)
    )
