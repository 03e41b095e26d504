"""Split one flagged set into kept and quarantined rows.

Quarantine is a *route*, not a delete: every input row ends in exactly one
output.  The catalogue check probes the reference table once with a left join
and a marker column (instead of an anti join plus a semi join), and the size
of the catalogue decides the join strategy at plan time and again under AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUTE = "_route"
ROUTE_CLEAN = "clean"
ROUTE_INVALID = "invalid"
ROUTE_ORPHAN = "orphan"
_KNOWN = "_known"


def mark_known(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Add ``_known``: does ``key`` exist in ``reference``?  One probe per row.

    ``reference`` is reduced to its distinct keys first, so the join never
    multiplies rows.  A NULL key is never known.
    """
    ref = reference.select(key).distinct().withColumn(_KNOWN, F.lit(True))
    return df.join(ref, on=key, how="left").withColumn(_KNOWN, F.coalesce(F.col(_KNOWN), F.lit(False)))


def anti_reference(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Rows whose key is absent from the reference (J1: orphans)."""
    return df.join(reference.select(key), on=key, how="left_anti")


def semi_reference(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Rows whose key exists in the reference; left columns only."""
    return df.join(reference.select(key), on=key, how="left_semi")


def attach_reason(df: DataFrame, reason: str | Column, clock: str) -> DataFrame:
    """Reason text and the (argument) time of quarantining."""
    reason_col = F.lit(reason) if isinstance(reason, str) else reason
    return df.withColumn("quarantine_reason", reason_col).withColumn(
        "quarantined_at", F.lit(clock).cast("timestamp_ntz")
    )
