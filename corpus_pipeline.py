"""A training corpus from documents: toxicity, line dedup, near dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all
but the last return the columns of ``documents``.  ``run`` writes each stage's rows as Parquet
in the shared folder and reads them again for the next one.

What every stage does with awkward rows: null and empty texts stay (they score as a text without words,
hold no lines, link by fingerprint zero, so that one of them stays, and pack as a single end token); rows without an id are
kept like others, but give way to rows with one in near dedup; repeated rows leave one in near dedup; texts of any length
are read whole; a score equal to TOXIC_AT goes; further columns are carried along; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerworks.llm import lines, packing, repeats, simhash, toxicity
from layerworks.llm.common import read_documents, written

TOXIC_AT = 0.3
TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below TOXIC_AT.  The model learns from the labelled rows
    of ``docs`` (a bounded sample, see ``toxicity.fit``)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs.select(*docs.columns), model).filter(F.col("score") < TOXIC_AT).select(*docs.columns)


def _with_text(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """``changed`` with its column ``kept`` as the text, and n_chars counted anew."""
    text = F.col("kept")
    others = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {"text": text}
    return changed.withColumns(others).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that an earlier one has (equal or one word away)."""
    return _with_text(docs, lines.dedup_lines(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints: that with the smallest doc_id, a row
    without an id only if no row of its group has one.  Rows that share an id are told apart by
    fingerprint and content; of repeated rows one stays."""
    return simhash.first_rows(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without words covered by a window of 35 words that starts elsewhere too."""
    return _with_text(docs, repeats.remove_repeats(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 2048 tokens."""
    from layerworks.llm.queries import tokenizer_path

    return packing.pack_documents(docs, tokenizer_path(TOKENIZER), max_tokens=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeats),
    ("best_fit_packing", pack),
]

# Learned scores, edit distances, components and packing are beyond SQL: tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
