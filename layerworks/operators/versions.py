"""Table versions over a changelog (V1-V5).

A changelog holds, per version, the rows that version wrote (inserted or
updated), with an integer ``version`` column.  For a sequence of upserts
(each batch unique on the key, no deletes) the table state at version n is
"for every key, its row from the highest version <= n that contains it", so
time travel, history and diffs are plain DataFrame queries:

* ``snapshot_as_of``: filter ``version <= n`` (partition pruning when the
  changelog is stored partitioned by version) + newest row per key;
* ``version_history``: per version, rows written / inserted / updated and the
  running table size, from each key's set of versions (one shuffle, no sort);
* ``version_diff``: one grouped pass computing each key's state at both
  versions (partial aggregation, so a hot key is combined map-side).

All three also take raw batches with several rows per key and version: ``order``
then says which of them the version wrote, and no changelog is staged before.

Update-only merges and guarded merges must record only the rows they actually
wrote (``ChangelogTable.merge`` does) to keep the same invariant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedup import latest_wins

VERSION = "version"


def stage_versions(
    rows: DataFrame,
    keys: Sequence[str],
    version: Column,
    order: Sequence[Column | str],
) -> DataFrame:
    """Changelog from raw batches: tag each row with its version, keep the
    newest row per (key, version) under ``order``."""
    tagged = rows.withColumn(VERSION, version.cast("int"))
    return latest_wins(tagged, [*keys, VERSION], order)


def snapshot_as_of(
    changelog: DataFrame, keys: Sequence[str], n: int | None = None, order: Sequence[Column | str] = (), since: int | None = None
) -> DataFrame:
    """V2: table state at version ``n`` (``None`` = current), in one window: per key the first
    row under (version DESC, *order).  ``since`` keeps versions from there on (a batch of
    later versions).  Version bounds apply before the shuffle."""
    if n is not None:
        changelog = changelog.filter(F.col(VERSION) <= F.lit(n))
    if since is not None:
        changelog = changelog.filter(F.col(VERSION) >= F.lit(since))
    return latest_wins(changelog, list(keys), [VERSION, *order])


def current_version(changelog: DataFrame) -> DataFrame:
    """V1: one row, the highest committed version (NULL for an empty table)."""
    return changelog.agg(F.max(VERSION).alias("current_version"))


def version_history(changelog: DataFrame, keys: Sequence[str]) -> DataFrame:
    """V3: per version: operation, rows written, inserted, updated, table size.

    One shuffle of the changelog: each key's set of versions (bounded by the number of
    commits), whose least is the insert and whose others are updates.  What follows has one
    row for each task and version; the running total is a window over one row per version.
    """
    seen = changelog.groupBy(*keys).agg(F.sort_array(F.collect_set(VERSION)).alias("_versions"))
    per_version = (
        seen.select(F.posexplode("_versions").alias("_pos", VERSION))
        .groupBy(VERSION)
        .agg(F.count(F.lit(1)).alias("num_written"), F.count_if(F.col("_pos") == 0).alias("num_inserted"))
    )
    ordered = Window.orderBy(VERSION).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.min(VERSION).over(Window.partitionBy(F.lit(0)))
    return per_version.select(
        F.col(VERSION),
        F.when(F.col(VERSION) == first, F.lit("WRITE")).otherwise(F.lit("MERGE")).alias("operation"),
        F.col("num_written"),
        F.col("num_inserted"),
        (F.col("num_written") - F.col("num_inserted")).alias("num_updated"),
        F.sum("num_inserted").over(ordered).alias("num_rows"),
    )


def version_diff(
    changelog: DataFrame,
    keys: Sequence[str],
    a: int,
    b: int | None,
    value: str,
    order: Sequence[str] = (),
) -> DataFrame:
    """V4: each key's state at versions ``a`` and ``b`` (None = current) and the change class.

    change: inserted (absent at a), updated (a different version wrote it),
    unchanged (same writing version), deleted (absent at b; impossible for
    upsert-only histories but reported if the changelog says so).  ``order`` names the
    columns, greatest first, that pick a version's row where several are given.
    """
    lo, hi = (a, b) if b is None else (min(a, b), max(a, b))
    scoped = changelog if hi is None else changelog.filter(F.col(VERSION) <= F.lit(hi))
    place = F.struct(VERSION, *[c for c in order if c != VERSION])
    at_lo = F.when(F.col(VERSION) <= F.lit(lo), place)
    per_key = scoped.groupBy(*keys).agg(
        F.max(at_lo)[VERSION].alias("version_before"),
        F.max_by(F.col(value), at_lo).alias(f"{value}_before"),
        F.max(VERSION).alias("version_after"),
        F.max_by(F.col(value), place).alias(f"{value}_after"),
    )
    change = (
        F.when(F.col("version_before").isNull(), F.lit("inserted"))
        .when(F.col("version_after").isNull(), F.lit("deleted"))
        .when(F.col("version_before") != F.col("version_after"), F.lit("updated"))
        .otherwise(F.lit("unchanged"))
    )
    return per_key.withColumn("change", change)


def fact_not_in_stage(fact: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """V5: keys the fact still holds but the current stage no longer has."""
    return fact.select(*keys).join(stage.select(*keys), on=list(keys), how="left_anti")


def keys_lost(rows: DataFrame, keys: Sequence[str], invalid: Column, place: Column) -> DataFrame:
    """Both sides of V5 from the raw rows at once: keys with a valid row (the fact has them),
    and ``_kept``: whether the row that is last by ``place`` is valid (a stage keeps them)."""
    flags = rows.groupBy(*keys).agg(F.bool_or(~invalid).alias("_held"), F.max_by(~invalid, place).alias("_kept"))
    return flags.filter("_held").drop("_held")
