"""The operators' queries over the given tables, and their SQL where SQL can express them.

Each query is thin: it applies an operator with production parameters to its whole table and
derives the contract's columns from what the operator returns.
"""

from __future__ import annotations

import hashlib
import importlib.util
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from layerworks.llm import ann, bpe, codes, html, lexical, lines, lm, packing, pii, quality, repeats, simhash, toxicity
from layerworks.llm.common import read_documents
from layerworks.llm.oracle import SQL  # noqa: F401 - registered with the queries


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file; the folder can be named by TOKENIZERS_DIR."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if not folder:
        spec = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(spec.origin)
    return os.path.join(folder, name)


def op1_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    out = bpe.encode_documents(docs, tokenizer_path("word_bpe_49k.json"), keep_text=False)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), max_tokens=2048)


def _outside(doc_id: str, parts: int, part: int):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~_outside("doc_id", 4, 2))
    out = toxicity.score(docs, toxicity.fit(docs, labels), keep_text=False)
    return out.select("doc_id", _outside("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(read_documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(read_documents(spark, sf_dir).select("doc_id", "text"), keep_text=False)
    return out.select("doc_id", "n_lines", "n_removed", F.array_join(F.transform("removed", lambda i: i.cast("string")), ",").alias("removed"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(read_documents(spark, sf_dir))
    return out.select("doc_id", *quality.STATS, "base_failed", "kept")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    trie = lm.train(docs.filter(~lm.held_out()))
    out = lm.score(docs, trie, keep_text=False)
    return out.select("doc_id", lm.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return ann.search(rows, rows.filter(F.col("vec_id") % 20 == 0), k=20)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_documents(spark, sf_dir).select("doc_id", "text"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))
    books = hashlib.sha256(",".join(map(str, found.codebooks.ravel().tolist())).encode()).hexdigest()
    out = codes.label_errors(found.rows)
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books).alias("codebooks_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=20)


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts are of base spans, whose digest they go with."""
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    out = pii.find(docs, pii.fit(docs), keep_text=False)
    base = F.filter("spans", lambda s: s["base"])
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", *map(count, pii.KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe_encode_decode,
        op2_best_fit_packing,
        op3_toxicity,
        op4_substring_dedup,
        op5_line_dedup,
        op6_quality_rules,
        op7_lm_scoring,
        op8_nearest_neighbours,
        op9_html_extraction,
        op10_simhash_near_dedup,
        op11_vector_codes,
        op12_lexical_search,
        op13_personal_data,
        pipeline,
    )
}
