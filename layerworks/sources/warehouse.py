"""Path-addressed Parquet tables on shared storage: landing, appends, new folders.

Layout under ``root`` (a folder every executor can reach):

* ``<name>/_ingest_batch=<id>/``  landed batches (bronze).  Landing a batch id again
  replaces that batch only, so a replayed batch is not duplicated.  Ids stay the strings
  they are ("01" and "1" are two batches); which there are is known from folder names.
* ``<name>/run=<n>/``  replaced tables (silver, dimensions, aggregate): a run writes
  each of its tables whole into a new folder, and nobody reads it before its run is listed.
* ``<name>/run=<n>/_bucket=<b>/``  tables in key buckets (fact): a run writes the buckets that its
  batch touches; a run's table is, for each bucket, the newest folder up to that run.
* ``<name>/_batch/``  the batch that is being merged into a bucketed table; gone once it is.
* ``_runs/``  one row for each published run of a layer.  Readers take the newest run, or an
  older one by number; an unlisted folder left by a failed attempt is written over.

This is no table format: one writer, folders replaced whole, no row-level files, no list of
files.  Where these do not suffice, write the same DataFrames to a format that has them.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import CHANGE, CHANGES, merge_upsert
from .tables import assert_same_schema

RUN_SCHEMA = "layer string, run int, source_run int, published_at timestamp_ntz, num_rows long, inserted long, updated long, kept long"
BUCKET = "_bucket"
PART = "_part"
# Rows of a bucket that one part of it holds in a merge, about.
PART_ROWS = 500_000
STAGED = "_batch"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key: rows of a key meet in one, and many keys share each."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


@contextmanager
def joined_as_dealt(spark: SparkSession) -> Iterator[None]:
    """Within, a join takes rows as they lie if both sides are dealt by some of its keys.  Otherwise Spark
    deals them anew by all of them, lest few values make large tasks."""
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _files(self, path: str):
        """The file system of a path, and the path as it knows it."""
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(context._jsc.hadoopConfiguration()), folder

    def _or_none(self, path: str, read) -> DataFrame | None:
        files, folder = self._files(path)
        if not files.exists(folder):
            return None
        try:
            return read(path)
        except AnalysisException as error:
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return None
            raise

    # --- appends ----------------------------------------------------------------

    def stored_schema(self, name: str) -> T.StructType | None:
        """Columns and types of an appended table's first write."""
        stored = self._or_none(f"{self.path(name)}/_schema", self.spark.read.text)
        return None if stored is None else T.StructType.fromJson(json.loads(stored.first()[0]))

    def _enforce_schema(self, df: DataFrame, name: str) -> None:
        """An append must match the columns and types of the table's first write, which
        are kept as one JSON line beside the data (no data file is listed for it)."""
        stored = self.stored_schema(name)
        if stored is None:
            self.spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.text(f"{self.path(name)}/_schema")
        else:
            assert_same_schema(df.schema, stored)

    def land(self, df: DataFrame, name: str, by: str = "_ingest_batch") -> int:
        """Append rows partitioned by ``by``; a value landed again replaces its own rows.
        Returns the rows written, observed during the write."""
        self._enforce_schema(df, name)
        seen = Observation()
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(self.path(name))
        return int(seen.get["rows"])

    def append(self, df: DataFrame, name: str) -> int:
        """Append rows (schema-checked); returns the rows written."""
        self._enforce_schema(df, name)
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(self.path(name))
        return int(seen.get["rows"])

    def replace_part(self, df: DataFrame, name: str, by: str, value: int) -> int:
        """The rows of one value of ``by`` replaced by ``df``, which may be empty (a partitioned
        overwrite replaces only values that get rows); returns the rows written."""
        self._enforce_schema(df.withColumn(by, F.lit(value)), name)
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{self.path(name)}/{by}={value}")
        return int(seen.get["rows"])

    def read_landed(self, name: str) -> DataFrame | None:
        """All rows of an appended table, None before its first append.  Its stored schema is
        given to the reader, which would else take partition values such as "01" for numbers."""
        schema = self.stored_schema(name)
        if schema is None:
            return None
        return self._or_none(self.path(name), lambda path: self.spark.read.schema(schema).parquet(path).select(*schema.names))

    def _folders(self, path: str, by: str) -> list[str]:
        """Values of ``by`` among the folders ``<by>=<value>`` of a path, without opening files."""
        files, folder = self._files(path)
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        return [unquote(n.partition("=")[2]) for n in names if n.startswith(f"{by}=")]

    def landed_values(self, name: str, by: str = "_ingest_batch") -> list[str]:
        """The values of ``by`` that have been landed, as they were given."""
        return sorted(self._folders(self.path(name), by))

    # --- replaced tables ---------------------------------------------------------

    def write_run(
        self,
        df: DataFrame,
        name: str,
        run: int,
        partition_by: Sequence[str] = (),
        cluster_by: Sequence[str] = (),
        change: str | None = None,
        compression: str | None = None,
    ) -> tuple[DataFrame, dict[str, int]]:
        """Write a table whole into its folder of ``run``; (the rows read again, their counts).

        ``cluster_by`` (K1) deals the rows by ranges of these columns (bounds are sampled) and sorts them
        inside, so that each file spans a small range and a lookup skips most.  ``change`` names a
        column of ``merge_upsert`` that is counted by value while writing, and not written."""
        path = f"{self.path(name)}/run={run}"
        counts = [F.count(F.lit(1)).alias("rows")]
        if change:
            counts += [F.count_if(F.col(change) == kind).alias(kind) for kind in CHANGES]
        seen = Observation()
        if cluster_by:
            df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        df = df.observe(seen, *counts)  # above the range exchange, whose sampling also reads what is below
        df = df.drop(change) if change else df
        writer = df.write.mode("overwrite")
        writer = writer.option("compression", compression) if compression else writer
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        rows = self.spark.read.schema(df.schema).parquet(path).select(*df.columns)
        return rows, {k: int(v) for k, v in seen.get.items()}

    def _bucket_paths(self, name: str, run: int, layer: str, only: set[int] | None = None) -> list[str]:
        """For each bucket its newest folder among published runs up to ``run``, and ``run`` itself."""
        found: dict[int, str] = {}
        listed = {r.run for r in self.runs(layer).filter(F.col("run") < run).select("run").collect()} | {run}
        for n in sorted(listed, reverse=True):
            for b in map(int, self._folders(f"{self.path(name)}/run={n}", BUCKET)):
                if only is None or b in only:
                    found.setdefault(b, f"{self.path(name)}/run={n}/{BUCKET}={b}")
        return [found[b] for b in sorted(found)]

    def read_buckets(self, name: str, run: int, layer: str, schema: T.StructType | None = None, only: set[int] | None = None) -> DataFrame | None:
        """A bucketed table as of ``run``, or only some of its buckets; None if it has none."""
        paths = self._bucket_paths(name, run, layer, only)
        if not paths:
            return None if schema is None else self.spark.createDataFrame([], schema)
        return (self.spark.read if schema is None else self.spark.read.schema(schema)).parquet(*paths)

    def _stage(self, batch: DataFrame, name: str) -> tuple[DataFrame, int]:
        """A batch written beside its table, so that it is computed once; (its rows read again, their
        number).  The next batch of the table is written over it."""
        path, seen = f"{self.path(name)}/{STAGED}", Observation()
        batch.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(batch.schema).parquet(path), int(seen.get["rows"])

    def merge_run(
        self, batch: DataFrame, name: str, run: int, layer: str, keys: Sequence[str], buckets: int, derived: dict[str, Column] | None = None
    ) -> tuple[DataFrame, dict[str, int]]:
        """V6 + J7: ``batch`` upserted into a bucketed table; (its rows as of ``run``, counts).

        Only buckets that the batch touches are read, merged and written anew; the files of all others
        stay.  The table's row count is that of the last run and what was inserted.  The merged
        rows are dealt by bucket, large buckets to several files, and sorted by key inside.

        ``derived``: columns of the table that are functions of its others.  They cross no shuffle, but
        are derived as the rows are written.  The rows of table and batch are dealt once, by bucket
        and part of it: the join on these and the key, and the writer, take them as they lie."""
        derived, last = derived or {}, self.last_run(layer)
        before = 0 if last is None else last.num_rows or 0
        slim = batch.drop(*derived).withColumn(BUCKET, bucket_of(keys, buckets))
        if last is None:
            merged = merge_upsert(None, slim, keys, validate_source=False, change=CHANGE).hint("rebalance", F.col(BUCKET))
        else:
            staged, rows = self._stage(slim, name)
            touched = {r[0] for r in staged.select(BUCKET).distinct().collect()}  # <= buckets
            target = self.read_buckets(name, last.run, layer, batch.schema, touched).drop(*derived).withColumn(BUCKET, bucket_of(keys, buckets))
            parts = 1 + int((before / buckets + rows / max(1, len(touched))) // PART_ROWS)
            part = F.pmod(F.hash(*keys), F.lit(parts))
            old, new = (rows.withColumn(PART, part).repartition(BUCKET, PART) for rows in (target, staged))
            merged = merge_upsert(old, new, [BUCKET, PART, *keys], validate_source=False, change=CHANGE)
        dealt = merged.sortWithinPartitions(BUCKET, *keys).withColumns(derived).select(*batch.columns, BUCKET, CHANGE)
        with joined_as_dealt(self.spark):
            _, counts = self.write_run(dealt, name, run, [BUCKET], change=CHANGE, compression="zstd")
        if last is not None:
            files, folder = self._files(f"{self.path(name)}/{STAGED}")
            files.delete(folder, True)
        counts |= {"rows": before + counts["inserted"], "kept": before - counts["updated"]}
        return self.read_buckets(name, run, layer, batch.schema), counts

    def runs(self, layer: str, limit: int | None = None) -> DataFrame:
        """K3: published runs of a layer, newest first."""
        found = self._or_none(self.path("_runs"), self.spark.read.schema(RUN_SCHEMA).parquet)
        if found is None:
            found = self.spark.createDataFrame([], RUN_SCHEMA)
        newest = found.filter(F.col("layer") == layer).orderBy(F.desc("run"))
        return newest.limit(limit) if limit else newest

    def last_run(self, layer: str) -> Row | None:
        """V1: the newest published run of a layer."""
        return self.runs(layer, 1).first()

    def next_run(self, layer: str) -> int:
        last = self.last_run(layer)
        return 0 if last is None else last.run + 1

    def publish(self, layer: str, run: int, source_run: int | None = None, counts: dict[str, int] | None = None) -> None:
        """List a run: all tables that it wrote become visible together.  ``source_run``: the
        run of the layer before; ``counts``: rows, inserted, updated, kept of what it merged."""
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        metrics = [(counts or {}).get(k) for k in ("rows", *CHANGES)]
        self.spark.createDataFrame([(layer, run, source_run, now, *metrics)], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(self.path("_runs"))

    def history(self, layer: str) -> DataFrame:
        """V3: per published run its operation and what the merge did, as observed while writing."""
        return self.runs(layer).select(
            F.col("run").alias("version"),
            F.when(F.col("run") == 0, F.lit("WRITE")).otherwise(F.lit("MERGE")).alias("operation"),
            (F.col("inserted") + F.col("updated")).alias("num_written"),
            F.col("inserted").alias("num_inserted"),
            F.col("updated").alias("num_updated"),
            F.col("num_rows"),
        )

    def read(self, name: str, run: int) -> DataFrame:
        """V2: a table as ``run`` wrote it."""
        return self.spark.read.parquet(f"{self.path(name)}/run={run}")

    def read_or_none(self, name: str, run: int) -> DataFrame | None:
        """A table as ``run`` wrote it, None if it did not."""
        return self._or_none(f"{self.path(name)}/run={run}", self.spark.read.parquet)
