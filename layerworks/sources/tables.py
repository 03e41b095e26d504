"""Reading source tables (S2, S3) and the schema listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table by logical name; projections and filters reach the scan.
    The folder is listed anew for each call, so files that came since are read."""
    return spark.read.parquet(table_path(sf_dir, name))


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, simpleString type, NULL count.

    The names and types come from the schema; the NULL counts from ONE
    aggregation over the whole frame (partial aggregation per task), turned
    into rows by exploding a literal-labelled array of structs.
    """
    fields = df.schema.fields
    counts = df.agg(*[F.count_if(F.col(f.name).isNull()).alias(f"_n{i}") for i, f in enumerate(fields)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"_n{i}").alias("null_count"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counts.select(F.explode(rows).alias("c")).select("c.*")


def schema_changes(incoming: DataFrame, target: T.StructType) -> DataFrame:
    """S10 as rows: columns of ``incoming`` that keep it from being appended to ``target``.

    change: missing, extra, or retyped; num_values: what an append by force would cost, as
    the rows left without a value, the values dropped, the values that do not convert.  One
    aggregation over the whole batch."""
    have = {f.name: f.dataType.simpleString() for f in incoming.schema}
    want = {f.name: f.dataType.simpleString() for f in target}
    found = [(c, "missing", None, t, F.count(F.lit(1))) for c, t in want.items() if c not in have]
    found += [(c, "extra", t, None, F.count(F.col(c))) for c, t in have.items() if c not in want]
    found += [
        (c, "retyped", t, want[c], F.count_if(F.col(c).isNotNull() & F.col(c).cast("string").try_cast(want[c]).isNull())) for c, t in have.items() if c in want and t != want[c]
    ]
    counts = incoming.agg(*[n.alias(f"_n{i}") for i, (*_, n) in enumerate(found)] or [F.count(F.lit(1)).alias("_n0")])
    text = lambda x: F.lit(x).cast("string")
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(change).alias("change"), text(a).alias("incoming_type"), text(b).alias("table_type"), F.col(f"_n{i}").alias("num_values"))
        for i, (c, change, a, b, _) in enumerate(found)
    ]
    if not rows:
        return counts.select(text(None).alias("column_name"), text(None).alias("change"), text(None).alias("incoming_type"), text(None).alias("table_type"), F.col("_n0").alias("num_values")).limit(0)
    return counts.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def assert_same_schema(incoming: DataFrame | T.StructType, target: T.StructType) -> None:
    """Append-time schema enforcement (S10): same column names, order and
    types.  Nullability is not compared: parquet reads every column back as
    nullable."""
    schema = incoming.schema if isinstance(incoming, DataFrame) else incoming
    got = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in target.fields]
    if got != want:
        missing = [c for c in want if c not in got]
        extra = [c for c in got if c not in want]
        raise ValueError(f"schema mismatch on append: missing={missing} extra={extra}")
