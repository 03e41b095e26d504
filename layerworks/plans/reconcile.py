"""Row-count reconciliation of the silver layer.

input = feed + corrections; input - superseded = latest;
latest = invalid + orphans + silver.

One grouped pass gives each key's latest row and its number of records; the
catalogue is probed once for each key, and all counts are sums of that.  Map-side combination
leaves one row for each task and key, so a hot key does not meet in one task.  Rows with
a NULL key supersede nothing: each is a latest row, and invalid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.routing import mark_known
from .silver import has_key, keyed_states, valid_state


def reconcile_counts(typed: DataFrame, catalogue: DataFrame) -> DataFrame:
    keys = mark_known(keyed_states(typed).withColumn("valid", valid_state("now")).drop("now", "before"), catalogue, "movie_id")
    records = F.col("feed_rows") + F.col("correction_rows")
    latest = F.when(has_key(), F.lit(1)).otherwise(records)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    counts = keys.agg(
        total("feed_rows").alias("feed_rows"),
        total("correction_rows").alias("correction_rows"),
        total(records).alias("input_rows"),
        total(records - latest).alias("superseded_rows"),
        total(latest).alias("latest_rows"),
        total(F.when(~F.col("valid"), latest)).alias("invalid_rows"),
        total(F.when(F.col("valid") & ~F.col("_known"), latest)).alias("orphan_rows"),
        total(F.when(F.col("valid") & F.col("_known"), latest)).alias("silver_rows"),
    )
    return counts.withColumn(
        "balanced",
        (F.col("input_rows") == F.col("feed_rows") + F.col("correction_rows"))
        & (F.col("input_rows") - F.col("superseded_rows") == F.col("latest_rows"))
        & (F.col("latest_rows") == F.col("invalid_rows") + F.col("orphan_rows") + F.col("silver_rows")),
    )
