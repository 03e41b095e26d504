"""Bronze landing: raw text files in as all-text rows with provenance.

Every value lands as a string with provenance attached, so a malformed value is
kept as evidence and only conformed in silver.  The CSV reader binds by header
name (``enforceSchema=false``) so a file whose columns are swapped fails
instead of loading swapped values, and keeps short or over-long lines in
``_corrupt_record`` instead of padding or truncating them silently.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config

CORRUPT_COLUMN = "_corrupt_record"


def batch_id_now(now: dt.datetime | None = None) -> str:
    """Batch id ``YYYYmmddTHHMMSSZ`` for a run."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.astimezone(dt.timezone.utc).strftime(config.BATCH_ID_FORMAT)


def clock_now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def text_schema(ddl: str) -> T.StructType:
    """All-string read schema plus the corrupt-record column."""
    schema = T._parse_datatype_string(ddl)
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])


def read_csv_text(spark: SparkSession, path: str, ddl: str, multi_line: bool = False) -> DataFrame:
    """Header CSV, PERMISSIVE, explicit all-string schema, header checked.  ``multi_line``
    lets quoted values hold line breaks; such files are not split among tasks."""
    return (
        spark.read.schema(text_schema(ddl))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("multiLine", multi_line)
        .csv(path)
    )


def header_report(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Per file of a folder its first line, whether that is the header of ``ddl`` (names in order,
    any case or quoting), and its number of lines: what to look at before landing."""
    names = ",".join(f.name.lower() for f in T._parse_datatype_string(ddl))
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place")
    )
    per_file = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"), F.count(F.lit(1)).alias("num_lines"))
    return per_file.withColumn("header_ok", F.lower(F.regexp_replace("header", '["\\s]', "")) == names)


def stamp_provenance(
    df: DataFrame,
    source_file: str | None,
    role: str,
    batch_id: str,
    clock: str,
    source_key: str | None = None,
    file_column: str | None = None,
) -> DataFrame:
    """Attach file name, role, batch id, ingest time and source position.

    ``source_file=None`` takes the real file name of each row from the scan's
    ``_metadata`` (multi-file input), or from ``file_column`` when the name
    was captured earlier (streaming micro-batches); that column is consumed.
    ``clock`` is an argument so reruns are reproducible; the batch id and
    clock are the same for every source landed in one run.  When the frame
    has no ``_source_key``/``_source_line`` yet (text files) the position is
    ``monotonically_increasing_id()`` (split index in the high bits, row
    ordinal within the split below): a total order for tie-breaks.
    """
    cols = df.columns
    if file_column is not None:
        file_col = F.col(file_column)
    elif source_file is None:
        file_col = F.col("_metadata.file_name")
    else:
        file_col = F.lit(source_file)
    if "_source_key" not in cols:
        key_col = (
            F.col(source_key).cast("bigint")
            if source_key
            else F.monotonically_increasing_id()
        )
        df = df.withColumn("_source_key", key_col)
    if "_source_line" not in df.columns:
        df = df.withColumn("_source_line", F.lit(0))
    data_cols = [c for c in df.columns if c not in ("_source_key", "_source_line", file_column)]
    return df.select(
        *data_cols,
        file_col.alias("_source_file"),
        F.lit(role).alias("_source_role"),
        F.lit(batch_id).alias("_ingest_batch"),
        F.lit(clock).cast("timestamp_ntz").alias("_ingested_at"),
        F.col("_source_key").cast("bigint").alias("_source_key"),
        F.col("_source_line").cast("int").alias("_source_line"),
    )


@dataclass(frozen=True)
class SourceSpec:
    """One raw source: where it is, its text schema and its role."""

    name: str
    path: str
    ddl: str
    role: str = config.ROLE_PRIMARY
    optional: bool = False


def ingest(spark: SparkSession, spec: SourceSpec, batch_id: str, clock: str | None = None) -> DataFrame | None:
    """Read one source as bronze text.  Optional sources may be absent."""
    try:
        raw = read_csv_text(spark, spec.path, spec.ddl)
        raw.schema  # resolve now: a missing path raises here
    except Exception as error:  # noqa: BLE001 - only "path does not exist" is tolerated
        if spec.optional and "PATH_NOT_FOUND" in str(error):
            return None
        raise
    return stamp_provenance(raw, None, spec.role, batch_id, clock or clock_now())
