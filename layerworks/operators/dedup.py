"""Latest-record-wins and natural-key dedup.

``row_number() = 1`` over a key window is planned by Spark 4 as a partial
``WindowGroupLimit`` before the shuffle and a final one after it: each map task
keeps only its newest row per key, so even a key holding a third of all rows
sends one row per map partition through the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "_rn"


def _order(order: Sequence[Column | str]) -> list[Column]:
    def one(c: Column | str) -> Column:
        if not isinstance(c, str):
            return c
        name, _, way = c.partition(" ")
        return F.col(name).asc_nulls_last() if way == "asc" else F.col(name).desc()

    return [one(c) for c in order]


def latest_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (strings mean DESC, "name asc" ASC).

    DESC puts NULLs last, so a row with an unparsed timestamp never wins over
    one with a value.  Pass a total order (end with source-position columns)
    for a deterministic result.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def dedup_natural_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str] = ("_ingested_at", "_ingest_batch", "_source_file", "_source_key", "_source_line"),
) -> DataFrame:
    """One row per natural key, the most recently landed one (deterministic)."""
    return latest_wins(df, keys, order)
