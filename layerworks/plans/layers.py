"""Stage order bronze -> silver -> gate -> gold -> gate, write-audit-publish.

Each run of a layer writes its tables into new folders (the fact: the buckets of keys that
changed), is audited by its quality gate on what it wrote, and only then listed.  A failing gate leaves the previous run
visible everywhere and raises ``GateBlocked``; check results and this run's rejected rows
are stored before that, pass or fail.  A run that finds nothing new writes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators.routing import ROUTE, ROUTE_CLEAN
from ..sources.ingest import CORRUPT_COLUMN, SourceSpec, batch_id_now, clock_now, ingest
from ..sources.warehouse import Warehouse
from . import gold, quality, silver

BRONZE_RATINGS = "bronze_ratings"
BRONZE_ITEMS = "bronze_movies"
BRONZE_CORRECTIONS = "bronze_rating_corrections"
SILVER_BATCHES = "silver_batches"
SILVER_RATINGS = "silver_ratings"
SILVER_ITEMS = "silver_movies"
QUARANTINE = "quarantine_ratings"
DIM_ITEM = "dim_movie"
DIM_USER = "dim_user"
FACT = "fct_rating"
MONTHLY = "agg_monthly_movie_ratings"
DQ_RESULTS = "dq_results"
SILVER, GOLD = "silver", "gold"
_RUN = "_run"
BATCHES_SCHEMA = "table string, batch string, first_run int"
FACT_IDS = ["movie_id", "user_id"]
# Key buckets of the fact: fixed for a warehouse's life, at most some GB of the fact each.  A run
# rewrites those that its batch touches.
FACT_BUCKETS = 64


@dataclass
class RunReport:
    batch_id: str
    published: dict[str, int] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    checks: dict[str, list[dict]] = field(default_factory=dict)


def land_bronze(wh: Warehouse, ratings: DataFrame, items: DataFrame, corrections: DataFrame | None) -> None:
    """B1: append the three sources (already stamped with one batch id)."""
    wh.land(ratings, BRONZE_RATINGS)
    wh.land(items, BRONZE_ITEMS)
    if corrections is not None:
        wh.land(corrections, BRONZE_CORRECTIONS)


def land_files(
    spark: SparkSession,
    wh: Warehouse,
    ratings_csv: str,
    items_csv: str,
    corrections_csv: str | None = None,
    batch_id: str | None = None,
    clock: str | None = None,
) -> str:
    """B1 from raw CSV files; the corrections file is optional."""
    batch_id = batch_id or batch_id_now()
    clock = clock or clock_now()
    ratings = ingest(spark, SourceSpec("ratings", ratings_csv, config.RATINGS_TEXT_DDL), batch_id, clock)
    items = ingest(spark, SourceSpec("movies", items_csv, config.ITEMS_TEXT_DDL), batch_id, clock)
    corr = None
    if corrections_csv:
        corr = ingest(
            spark,
            SourceSpec("corrections", corrections_csv, config.RATINGS_TEXT_DDL, config.ROLE_CORRECTIONS, optional=True),
            batch_id,
            clock,
        )
    land_bronze(wh, ratings, items, corr)
    return batch_id


def _gate(wh: Warehouse, layer: str, **tables) -> list[dict]:
    return quality.run_gate(wh.spark, layer, wh.path(DQ_RESULTS), **tables)


def read_fact(wh: Warehouse, run: int | None = None) -> DataFrame:
    """V2: the fact as of a gold run (the newest by default)."""
    return wh.read_buckets(FACT, wh.last_run(GOLD).run if run is None else run, GOLD)


def read_silver(wh: Warehouse, run: int | None = None) -> DataFrame:
    """The kept rows of a silver run (the newest by default)."""
    run = wh.last_run(SILVER).run if run is None else run
    routed = wh.read(SILVER_RATINGS, run)
    return routed.filter(F.col(ROUTE) == ROUTE_CLEAN).select(*silver.SILVER_COLUMNS)


Batches = dict[str, list[str]]  # ids by bronze table


def landed_batches(wh: Warehouse) -> Batches:
    """Ids of all landed batches, from folder names alone."""
    return {name: wh.landed_values(name) for name in (BRONZE_RATINGS, BRONZE_CORRECTIONS, BRONZE_ITEMS)}


def rows_of(table: DataFrame | None, batches: list[str]) -> DataFrame | None:
    """Bronze rows of the given batches: a filter on partition values, by which the scan skips the
    folders of all others."""
    return None if table is None else table.drop(CORRUPT_COLUMN).filter(F.col("_ingest_batch").isin(batches))


def of_batches(rows: DataFrame, batches: Batches) -> DataFrame:
    """Rating rows that came with the given batches; feed and corrections may share batch ids."""
    corrected = F.col("rating_source") == config.SOURCE_CORRECTION
    batch = F.col("_ingest_batch")
    return rows.filter((corrected & batch.isin(batches[BRONZE_CORRECTIONS])) | (~corrected & batch.isin(batches[BRONZE_RATINGS])))


def batches_since(wh: Warehouse, run: int, since: int | None) -> Batches:
    """Batches that silver runs after ``since`` and up to ``run`` were the first to read."""
    out: Batches = {BRONZE_RATINGS: [], BRONZE_CORRECTIONS: [], BRONZE_ITEMS: []}
    listed = wh.read(SILVER_BATCHES, run)
    for r in (listed if since is None else listed.filter(F.col("first_run") > since)).collect():  # one row for each landing
        out[r.table].append(r.batch)
    return out


def run_silver(
    spark: SparkSession,
    wh: Warehouse,
    clock: str,
    expect_quarantine: bool = True,
    report: RunReport | None = None,
    incremental: bool = True,
) -> None:
    """B2 + B3 + gate: catalogue first, then the routed ratings, then publish.

    Incremental by default: the routed rows of the previous run (every key's latest
    record, rejected winners included) are the state, and only batches of each bronze table
    that no run before has read are added, whatever their ingest times: each run lists the
    batches that its state holds.  A run without such a list is followed by a full one.
    Latest-wins is associative, so latest(state + new) equals latest(all) exactly; validity
    and the catalogue probe are evaluated again for every latest row.  Re-landing a batch
    with *different* content needs ``incremental=False``.

    The quarantine gets the rejected rows among those this run has newly read, in its own
    partition, before the gate: a second attempt replaces them, also by none.
    """
    last = wh.last_run(SILVER) if incremental else None
    read = None if last is None else wh.read_or_none(SILVER_BATCHES, last.run)
    last = None if read is None else last
    known = set() if read is None else {(r.table, r.batch) for r in read.collect()}  # one row for each landing
    unread = {name: [b for b in ids if (name, b) not in known] for name, ids in landed_batches(wh).items()}
    if read is not None and not any(unread.values()):
        if report is not None:
            report.rows.update({QUARANTINE: 0})
        return
    run = wh.next_run(SILVER)
    first = spark.createDataFrame([(name, b, run) for name, ids in unread.items() for b in ids], BATCHES_SCHEMA)
    wh.write_run(first if read is None else first.unionByName(read), SILVER_BATCHES, run)
    new = {name: rows_of(wh.read_landed(name), ids) for name, ids in unread.items()}

    previous_items = wh.read(SILVER_ITEMS, last.run) if last is not None else None
    items, counts = wh.write_run(silver.silver_catalogue(new[BRONZE_ITEMS], previous_items), SILVER_ITEMS, run)
    n_items = counts["rows"]

    # Malformed source lines stay rows (their NULL fields route them to quarantine); the
    # raw-line column itself is bronze-only evidence.
    typed = silver.typed_ratings(new[BRONZE_RATINGS], new[BRONZE_CORRECTIONS])
    if last is not None:
        typed = wh.read(SILVER_RATINGS, last.run).select(*typed.columns).unionByName(typed)
    routed = silver.enrich(silver.route_ratings(typed, items)).select(*silver.SILVER_COLUMNS, ROUTE)
    # ONE write of every latest row, partitioned by route: the clean partition is silver, and
    # the whole folder is the next run's state.  Clustered by ranges of (route, key), so that a point
    # lookup opens the few files whose range holds it.
    routed, _ = wh.write_run(routed, SILVER_RATINGS, run, [ROUTE], cluster_by=[ROUTE, "movie_id", "user_id"])
    rejected = silver.quarantine_from_routed(routed, clock)
    fresh = rejected if last is None else of_batches(rejected, unread)
    n_quarantined = wh.replace_part(fresh, QUARANTINE, _RUN, run)

    kept = routed.filter(F.col(ROUTE) == ROUTE_CLEAN).select(*silver.SILVER_COLUMNS)
    results = _gate(wh, SILVER, silver=kept, catalogue=items, quarantine=rejected, expect_quarantine=expect_quarantine)
    wh.publish(SILVER, run)
    if report is not None:
        n_silver = next(r["observed"] for r in results if r["name"] == quality.NOT_EMPTY.name)
        report.rows.update({SILVER_ITEMS: n_items, SILVER_RATINGS: n_silver, QUARANTINE: n_quarantined})
        report.checks[SILVER] = results
        report.published[SILVER] = run


def run_gold(spark: SparkSession, wh: Warehouse, expect_corrections: bool = True, report: RunReport | None = None) -> None:
    """B4-B7 + gate: dimensions, fact merge, monthly aggregate of the merged fact.

    The fact keeps natural ids beside its nine columns, so the merge joins on 8-byte keys.  Merged are the
    silver rows of batches that silver has read since the last gold run (all, if the catalogue
    has changed: rows parked before may be known now), into the buckets of their keys.
    A silver run that is merged already is not merged again: nothing is written."""
    source, last = wh.last_run(SILVER), wh.last_run(GOLD)
    if last is not None and last.source_run == source.run:
        if report is not None:
            report.rows.update({FACT: 0})
        return
    run = wh.next_run(GOLD)
    ratings = read_silver(wh, source.run)
    items = gold.dim_item(wh.read(SILVER_ITEMS, source.run))
    dim_item, n_dim_item = wh.write_run(items, DIM_ITEM, run, cluster_by=["movie_natural_key"])
    _, n_dim_user = wh.write_run(gold.dim_user(ratings), DIM_USER, run)

    new = batches_since(wh, source.run, None if last is None else last.source_run)
    batch = ratings if last is None or new[BRONZE_ITEMS] else of_batches(ratings, new)
    fact, counts = wh.merge_run(gold.fact_stage(batch, keep_natural=True), FACT, run, GOLD, FACT_IDS, FACT_BUCKETS, gold.fact_keys())
    results = _gate(wh, GOLD, fact=fact, expect_corrections=expect_corrections)
    _, n_monthly = wh.write_run(gold.monthly_agg(fact, dim_item), MONTHLY, run)
    wh.publish(GOLD, run, source_run=source.run, counts=counts)
    n_dim_item, n_dim_user, n_fact, n_monthly = n_dim_item["rows"], n_dim_user["rows"], counts["rows"], n_monthly["rows"]
    if report is not None:
        report.rows.update({DIM_ITEM: n_dim_item, DIM_USER: n_dim_user, FACT: n_fact, MONTHLY: n_monthly})
        report.checks[GOLD] = results
        report.published[GOLD] = run


def run_layers(
    spark: SparkSession,
    wh: Warehouse,
    clock: str | None = None,
    expect_quarantine: bool = True,
    expect_corrections: bool = True,
    batch_id: str = "",
) -> RunReport:
    """Silver -> gate -> gold -> gate over what is landed in bronze."""
    clock = clock or clock_now()
    report = RunReport(batch_id)
    run_silver(spark, wh, clock, expect_quarantine, report)
    run_gold(spark, wh, expect_corrections, report)
    return report
