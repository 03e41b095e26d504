"""Key-based MERGE as DataFrame operators.

Parquet has no row-level update, so a merge is computed as the new table
state, from one join that reads each operand once:

* upsert (update-all on match, insert-all otherwise, never delete):
  ``target FULL JOIN batch``, the batch row where present.  Operands that are
  partitioned by the key already (say by a latest-wins window) are not shuffled again;
* guarded upsert: the same join, the batch row unless it is older on ``guard_col``;
* update-only (unmatched batch rows ignored): ``target LEFT JOIN batch`` and
  take the batch value where present.

For a *stored* batch that is small beside the target, ``small_batch=True`` computes an upsert as
``target ANTI JOIN batch-keys UNION ALL batch``, or for a guard as a left join plus the
batch's new keys: the planner can then broadcast the batch and stream the target.

The batch must be unique on the key (a MERGE with several source rows per
target row is ambiguous); ``validate_source`` checks that with one distributed
aggregation before the merge is planned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# What a merge did to a row, in the column that ``change`` names.
CHANGE = "_change"
CHANGES = ("inserted", "updated", "kept")


class DuplicateSourceKeys(ValueError):
    pass


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A4: keys occurring more than once, with their multiplicity ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    if duplicate_keys(df, keys).limit(1).count() > 0:
        raise DuplicateSourceKeys(f"merge source has several rows for some key {tuple(keys)}")


def _align(source: DataFrame, target: DataFrame) -> DataFrame:
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        raise ValueError(f"merge source lacks target columns {missing}")
    return source.select(*target.columns)


def merge_upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    guard_col: str | None = None,
    validate_source: bool = True,
    small_batch: bool = False,
    change: str | None = None,
) -> DataFrame:
    """New state after an upsert of ``source`` into ``target``.

    ``target=None`` is the first run (create = the source itself).  With
    ``guard_col`` a matched row is replaced only when the source value of that
    column is >= the target's (a replayed older batch cannot revert newer facts).
    ``change`` names a column to add that tells what became of each row (one of ``CHANGES``).
    """
    keys = list(keys)
    if small_batch and change:
        raise ValueError("changes are told by the full join only")
    if validate_source:
        require_unique(source, keys)
    if target is None:
        return source.withColumn(change, F.lit(CHANGES[0])) if change else source
    src = _align(source, target)
    values = [c for c in target.columns if c not in keys]
    if small_batch:
        if guard_col is None:
            return target.join(src.select(*keys), on=keys, how="left_anti").unionByName(src)
        fresh = src.join(target.select(*keys), on=keys, how="left_anti")
        return _picked(target, src, keys, values, guard_col, "left", target.columns).unionByName(fresh)
    return _picked(target, src, keys, values, guard_col, "full", target.columns, change)


def _picked(
    target: DataFrame, src: DataFrame, keys: list[str], values: list[str], guard_col: str | None, how: str, columns: list[str], change: str | None = None
) -> DataFrame:
    """Rows of the join, each with the source's values where the source wins."""
    t = target.select(*keys, F.struct(*values).alias("_t"), F.lit(True).alias("_in_t"))
    s = src.select(*keys, F.struct(*values).alias("_s"), F.lit(True).alias("_in_s"))
    wins = F.col("_in_s").isNotNull()
    if guard_col is not None:
        newer = F.col("_t")[guard_col].isNull() | F.coalesce(F.col("_s")[guard_col] >= F.col("_t")[guard_col], F.lit(False))
        wins = wins & (F.col("_in_t").isNull() | newer)
    row = F.when(wins, F.col("_s")).otherwise(F.col("_t"))
    inserted, updated, kept = map(F.lit, CHANGES)
    told = [F.when(F.col("_in_t").isNull(), inserted).when(wins, updated).otherwise(kept).alias(change)] if change else []
    return t.join(s, on=keys, how=how).withColumn("_row", row).select(*[c if c in keys else F.col("_row")[c].alias(c) for c in columns], *told)


def merge_update_only(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    validate_source: bool = True,
) -> DataFrame:
    """Replace matched target rows by their source row; ignore the rest."""
    keys = list(keys)
    if validate_source:
        require_unique(source, keys)
    src = _align(source, target)
    values = [c for c in target.columns if c not in keys]
    renamed = src.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_src_{c}") for c in values])
    joined = target.join(renamed, on=keys, how="left")
    return joined.select(
        *[
            F.col(c)
            if c in keys
            else F.when(F.col("_hit"), F.col(f"_src_{c}")).otherwise(F.col(c)).alias(c)
            for c in target.columns
        ]
    )
