"""Incremental bronze landing with Structured Streaming (file source).

New raw files in a folder are landed as bronze text by a streaming query with
``trigger(availableNow=True)``: each run processes exactly the files not seen
before (tracked in the checkpoint on shared storage), then stops.  Every
micro-batch is stamped with a batch id made of the query's id and the epoch and
written with dynamic partition overwrite on ``_ingest_batch``, so a micro-batch
replayed after a failure replaces its own earlier partial output instead of
duplicating it.  The query's id lives in its checkpoint: another folder's query, or
the same folder's after its checkpoint was reset, never shares a batch id with it.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.ingest import CORRUPT_COLUMN, clock_now, stamp_provenance, text_schema
from ..sources.warehouse import Warehouse

FILE_PATH = "_file_path"


def read_text_stream(spark: SparkSession, folder: str, ddl: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming CSV scan with the bronze rules (all text, header checked)."""
    reader = (
        spark.readStream.schema(text_schema(ddl))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(folder)
    return stream.select("*", F.col("_metadata.file_name").alias(FILE_PATH))


def epoch_batch_id(prefix: str, query_id: str, epoch_id: int) -> str:
    return f"{prefix}-{query_id}-{epoch_id:010d}"


def land_stream(
    spark: SparkSession,
    folder: str,
    ddl: str,
    warehouse: Warehouse,
    table: str,
    role: str,
    checkpoint_location: str,
    batch_prefix: str = "stream",
    clock: str | None = None,
) -> StreamingQuery:
    """Start an available-now landing query; call ``awaitTermination()`` on it."""

    known = threading.Event()
    query_id: list[str] = []

    def land(batch: DataFrame, epoch_id: int) -> None:
        if not known.wait(60):  # set as soon as start() has returned
            raise TimeoutError("the streaming query's id did not become known")
        stamped = stamp_provenance(
            batch,
            source_file=None,
            file_column=FILE_PATH,
            role=role,
            batch_id=epoch_batch_id(batch_prefix, query_id[0], epoch_id),
            clock=clock or clock_now(),
        )
        warehouse.land(stamped, table)

    query = (
        read_text_stream(spark, folder, ddl)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    query_id.append(str(query.id))
    known.set()
    return query
