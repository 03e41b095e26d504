"""Registered queries: every operator of the layers run over the test tables.

``QUERIES[name](spark, sf_dir)`` returns a lazy DataFrame.  All of them read
``lineitem`` / ``part`` through the domain mapping in ``sources.fixtures`` and
run over whole tables.  Array columns are flattened to text (and counts) in
query outputs so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import decade, invalid_rating, item_key, user_key
from ..operators.dedup import dedup_natural_key
from ..operators.merge import duplicate_keys, merge_update_only, merge_upsert
from ..operators.routing import ROUTE, ROUTE_INVALID, ROUTE_ORPHAN, attach_reason, mark_known, semi_reference
from ..operators.versions import (
    VERSION,
    keys_lost,
    snapshot_as_of,
    stage_versions,
    version_diff,
    version_history,
)
from ..session import scratch_folder
from ..sources import fixtures
from ..sources.ingest import CORRUPT_COLUMN, header_report, read_csv_text
from ..sources.tables import schema_changes, schema_report
from ..sources.warehouse import Warehouse
from . import gold, quality, silver
from .corrections import generate_corrections
from .reconcile import reconcile_counts

# Version of a staged batch = calendar year of its event time minus this base,
# so the feed (1995..2001) is versions 0..6 and corrections come later.
VERSION_BASE_YEAR = 1995
FEED_LAST_VERSION = 6
AS_OF_VERSION = 3
# (movie_id, user_id): the grain key, most selective column first for sorts.
KEYS = ["movie_id", "user_id"]
FACT_BUCKETS = 64
SECOND_BATCH = "20240116T000000Z"
SECOND_CLOCK = "2024-01-16 00:00:00"


class Domain:
    """Lazily built DataFrames of the layers for one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    # bronze
    @cached_property
    def feed_text(self) -> DataFrame:
        return fixtures.feed_text(self.spark, self.sf_dir)

    @cached_property
    def corrections_text(self) -> DataFrame:
        return fixtures.corrections_text(self.spark, self.sf_dir)

    @cached_property
    def catalogue_text(self) -> DataFrame:
        return fixtures.catalogue_text(self.spark, self.sf_dir)

    # silver
    @cached_property
    def unioned(self) -> DataFrame:
        return silver.union_sources(self.feed_text, self.corrections_text)

    @cached_property
    def typed(self) -> DataFrame:
        return silver.conform_types(self.unioned)

    @cached_property
    def catalogue(self) -> DataFrame:
        return silver.silver_catalogue(self.catalogue_text)

    @cached_property
    def catalogue_ids(self) -> DataFrame:
        return silver.catalogue_ids(self.catalogue_text)

    @cached_property
    def routed(self) -> DataFrame:
        # existence probe: the id set is all it needs (no dedup window)
        return silver.route_ratings(self.typed, self.catalogue_ids)

    @cached_property
    def silver(self) -> DataFrame:
        # no rejected row is needed: those without a key are left out before the window
        return silver.silver_from_routed(silver.route_ratings(self.typed, self.catalogue_ids, keyless=False))

    @cached_property
    def quarantine(self) -> DataFrame:
        return silver.quarantine_from_routed(self.routed, fixtures.FIXTURE_CLOCK)

    # gold
    @cached_property
    def dim_item(self) -> DataFrame:
        return gold.dim_item(self.catalogue)

    @cached_property
    def dim_user(self) -> DataFrame:
        return gold.dim_user(self.silver)

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fact_stage(self.silver)

    @cached_property
    def states(self) -> DataFrame:
        """The latest row of each key now, and before the corrections."""
        return silver.keyed_states(self.typed)

    @cached_property
    def merged(self) -> DataFrame:
        """Rows of the fact after two runs: that of the feed alone, then that of feed and
        corrections, merged into it.  Keys that left silver in the second run stay."""
        return semi_reference(gold.merged_states(self.states), self.catalogue_ids, "movie_id")

    # versions
    def versioned(self, upto: int | None = None, since: int | None = None) -> DataFrame:
        """Valid typed rows of versions since..upto, whose scans are pruned by event time."""
        rows = fixtures.typed_ratings(
            self.spark,
            self.sf_dir,
            None if since is None else f"{VERSION_BASE_YEAR + since}-01-01",
            None if upto is None else f"{VERSION_BASE_YEAR + upto + 1}-01-01",
        )
        return rows.filter(~invalid_rating()).withColumn(VERSION, (F.year("event_ts") - VERSION_BASE_YEAR).cast("int"))

    @cached_property
    def changelog(self) -> DataFrame:
        staged = stage_versions(self.versioned(), KEYS, F.col(VERSION), silver.LATEST_ORDER)
        return staged.select(*KEYS, "rating", "event_ts", "rating_source", VERSION)

    def _state(self, upto: int | None = None, since: int | None = None) -> DataFrame:
        state = snapshot_as_of(self.versioned(upto, since), KEYS, upto, silver.LATEST_ORDER, since)
        return state.select(*KEYS, "rating", "event_ts", "rating_source", VERSION)

    def snapshot(self, n: int | None) -> DataFrame:
        """State at version ``n``: equal to ``snapshot_as_of(self.changelog, n)``
        (see tests), computed from the batches in one window."""
        return self._state(upto=n)

    def batch(self, lo: int, hi: int | None = None) -> DataFrame:
        """Staged rows of versions in [lo, hi], one per key (newest version)."""
        return self._state(upto=hi, since=lo)


STATE_COLUMNS = [*KEYS, "rating", "event_ts", "rating_source", VERSION]


def _d(spark: SparkSession, sf_dir: str) -> Domain:
    return Domain(spark, sf_dir)


def _flat_genres(df: DataFrame) -> DataFrame:
    return df.withColumn("genre_list", F.array_join("genres", "|")).withColumn("genre_count", F.size("genres"))


# --- bronze / conformance ------------------------------------------------------


def q_bronze_as_text(spark, sf_dir):
    return _d(spark, sf_dir).feed_text


def q_bronze_stamp(spark, sf_dir):
    d = _d(spark, sf_dir)
    cols = ["_source_file", "_source_role", "_ingest_batch", "_ingested_at"]
    landed = d.feed_text.select(*cols).unionByName(d.corrections_text.select(*cols)).unionByName(
        d.catalogue_text.select(*cols)
    )
    return landed.groupBy(*cols).agg(F.count(F.lit(1)).alias("row_count"))


def q_union_corrections(spark, sf_dir):
    return _d(spark, sf_dir).unioned.drop("_ingested_at")


def q_conform_types(spark, sf_dir):
    return _d(spark, sf_dir).typed.select("user_id", "movie_id", "rating", "rating_source", "_source_key", "_source_line")


def q_epoch_to_timestamp(spark, sf_dir):
    d = _d(spark, sf_dir)
    from ..functions import epoch_seconds_to_ts

    return d.unioned.select(
        "rating_source", "_source_key", "_source_line", "event_ts_raw", epoch_seconds_to_ts("event_ts_raw").alias("event_ts")
    )


def q_corrections_generate(spark, sf_dir):
    return generate_corrections(fixtures.feed_typed(spark, sf_dir))


# --- latest wins / validity / quarantine ------------------------------------------

_LATEST_COLS = ["user_id", "movie_id", "rating", "event_ts", "rating_source", "_source_key", "_source_line"]


def q_latest_wins(spark, sf_dir):
    return silver.latest_per_pair(_d(spark, sf_dir).typed).select(*_LATEST_COLS)


def q_latest_valid_wins(spark, sf_dir):
    return silver.latest_valid_per_pair(_d(spark, sf_dir).typed).select(*_LATEST_COLS)


def q_validity_flag(spark, sf_dir):
    latest = silver.latest_per_pair(_d(spark, sf_dir).typed)
    return latest.select("user_id", "movie_id", "rating", invalid_rating().alias("is_invalid"))


_Q_COLS = ["user_id", "movie_id", "rating", "event_ts", "rating_source", "quarantine_reason", "quarantined_at"]


def q_quarantine_invalid(spark, sf_dir):
    d = _d(spark, sf_dir)
    rows = d.routed.filter(F.col(ROUTE) == ROUTE_INVALID)
    return attach_reason(rows, config.REASON_INVALID, fixtures.FIXTURE_CLOCK).select(*_Q_COLS)


def q_quarantine_orphans(spark, sf_dir):
    d = _d(spark, sf_dir)
    rows = d.routed.filter(F.col(ROUTE) == ROUTE_ORPHAN)
    return attach_reason(rows, config.REASON_ORPHAN, fixtures.FIXTURE_CLOCK).select(*_Q_COLS)


def q_quarantine_all(spark, sf_dir):
    return _d(spark, sf_dir).quarantine.select(*_Q_COLS)


def q_ref_integrity_semi(spark, sf_dir):
    d = _d(spark, sf_dir)
    valid = silver.latest_keyed(d.typed).filter(~invalid_rating())
    kept = semi_reference(valid, d.catalogue_ids, "movie_id")
    return kept.select("movie_id", "user_id", "rating", "event_ts", "rating_source")


def q_rating_tier(spark, sf_dir):
    return _d(spark, sf_dir).silver.select("user_id", "movie_id", "rating", "rating_tier")


def q_month_bucket(spark, sf_dir):
    return _d(spark, sf_dir).silver.select("user_id", "movie_id", "event_ts", "rated_month")


def q_silver_feed(spark, sf_dir):
    return _d(spark, sf_dir).silver.select(
        "user_id", "movie_id", "rating", "event_ts", "rating_source", "rating_tier", "rated_month", "_source_role", "_ingest_batch"
    )


# --- catalogue ----------------------------------------------------------------


def q_genres_flat(spark, sf_dir):
    cat = _d(spark, sf_dir).catalogue
    return cat.select("movie_id", F.posexplode("genres").alias("pos", "genre")).select(
        "movie_id", (F.col("pos") + 1).alias("genre_pos"), "genre"
    )


def q_primary_genre(spark, sf_dir):
    return _d(spark, sf_dir).catalogue.select("movie_id", "primary_genre")


def q_release_year(spark, sf_dir):
    return _d(spark, sf_dir).catalogue.select("movie_id", "title", "release_year")


def q_dedup_natural_key(spark, sf_dir):
    first = fixtures.catalogue_text(spark, sf_dir)
    second = fixtures.catalogue_text(spark, sf_dir, batch_id=SECOND_BATCH, clock=SECOND_CLOCK)
    landed_twice = first.unionByName(second).withColumn("movie_id", F.col("movieId").try_cast("bigint"))
    return dedup_natural_key(landed_twice, ["movie_id"]).select("movie_id", "title", "_ingest_batch")


def q_silver_catalogue(spark, sf_dir):
    cat = _flat_genres(_d(spark, sf_dir).catalogue)
    return cat.select("movie_id", "title", "genre_list", "genre_count", "primary_genre", "release_year")


# --- star -----------------------------------------------------------------------


def q_surrogate_key(spark, sf_dir):
    s = _d(spark, sf_dir).silver
    return s.select("user_id", "movie_id", user_key("user_id").alias("user_key"), item_key("movie_id").alias("movie_key"))


def q_decade(spark, sf_dir):
    return _d(spark, sf_dir).catalogue.select("movie_id", "release_year", decade("release_year").alias("decade"))


def q_dim_item(spark, sf_dir):
    dim = _flat_genres(_d(spark, sf_dir).dim_item)
    return dim.select("movie_key", "movie_natural_key", "title", "primary_genre", "genre_list", "release_year", "decade")


def q_dim_user(spark, sf_dir):
    return _d(spark, sf_dir).dim_user


def q_fact_stage(spark, sf_dir):
    return _d(spark, sf_dir).fact


def q_monthly_agg(spark, sf_dir):
    d = _d(spark, sf_dir)
    # the join with the dimension leaves out items that are not catalogued
    return gold.monthly_agg(gold.merged_states(d.states), d.dim_item)


def q_fact_merged(spark, sf_dir):
    """The fact after its second run: all nine columns, one row per (user_key, movie_key)."""
    return gold.fact_stage(_d(spark, sf_dir).merged)


# --- merges and versions --------------------------------------------------------


def q_merge_upsert(spark, sf_dir):
    """Correction batch (versions after the feed) upserted into the feed state."""
    d = _d(spark, sf_dir)
    target = d.snapshot(FEED_LAST_VERSION).select(*STATE_COLUMNS)
    source = d.batch(FEED_LAST_VERSION + 1).select(*STATE_COLUMNS)
    return merge_upsert(target, source, KEYS, validate_source=False)


def q_merge_guarded(spark, sf_dir):
    """Replay of an old batch plus the corrections, guarded on event time."""
    d = _d(spark, sf_dir)
    target = d.snapshot(FEED_LAST_VERSION).select(*STATE_COLUMNS)
    replay = d.versioned(AS_OF_VERSION, AS_OF_VERSION).unionByName(d.versioned(since=FEED_LAST_VERSION + 1))
    source = snapshot_as_of(replay, KEYS, order=silver.LATEST_ORDER).select(*STATE_COLUMNS)
    return merge_upsert(target, source, KEYS, guard_col="event_ts", validate_source=False)


def q_merge_update_only(spark, sf_dir):
    d = _d(spark, sf_dir)
    target = d.snapshot(FEED_LAST_VERSION).select(*STATE_COLUMNS)
    source = d.batch(FEED_LAST_VERSION + 1).select(*STATE_COLUMNS)
    return merge_update_only(target, source, KEYS, validate_source=False)


# Columns by which the greatest row of a key is its latest one: LATEST_ORDER for max_by.
_PLACE = ["event_ts", "_ingested_at", "_correction", "_ingest_batch", "_source_file", "_source_key", "_source_line", "rating"]


def _placed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_correction", (F.col("rating_source") == config.SOURCE_CORRECTION).cast("int"))


def q_fact_not_in_stage(spark, sf_dir):
    """Keys the fact holds (some version had a valid row) whose latest row silver rejects."""
    d = _d(spark, sf_dir)
    rows = fixtures.typed_ratings(spark, sf_dir)
    keys = keys_lost(_placed(rows), KEYS, invalid_rating(), F.struct(*_PLACE))
    known = mark_known(keys, d.catalogue_ids, "movie_id")
    return known.filter(~(F.col("_kept") & F.col("_known"))).select(*KEYS)


def q_snapshot_as_of(spark, sf_dir):
    return _d(spark, sf_dir).snapshot(AS_OF_VERSION).select(*STATE_COLUMNS)


def q_version_history(spark, sf_dir):
    return version_history(_d(spark, sf_dir).versioned(), KEYS)


def q_version_diff(spark, sf_dir):
    return version_diff(_placed(_d(spark, sf_dir).versioned()), KEYS, AS_OF_VERSION, None, "rating", _PLACE)


# --- aggregates, lookups ------------------------------------------------------------


def q_grain_duplicates(spark, sf_dir):
    return duplicate_keys(_d(spark, sf_dir).typed, KEYS)


def q_event_range(spark, sf_dir):
    s = _d(spark, sf_dir).silver
    return s.agg(F.min("event_ts").alias("first_event_ts"), F.max("event_ts").alias("last_event_ts"))


def _top1(df: DataFrame, order: list[str]) -> DataFrame:
    return df.filter(F.col("rating") < config.CORRECTION_SPLIT).orderBy(*order).limit(1)


def q_top1_lowest(spark, sf_dir):
    fact = _d(spark, sf_dir).fact
    return _top1(fact, ["rating", "movie_key", "user_key"]).select("user_key", "movie_key", "rating", "event_ts", "rating_source")


def q_point_lookup(spark, sf_dir):
    """History of the lowest-rated pair of the feed state across all versions."""
    d = _d(spark, sf_dir)
    pair = _top1(d.snapshot(FEED_LAST_VERSION), ["rating", "movie_id", "user_id"]).select(*KEYS)
    # One row by construction (limit 1): a proven bound for the broadcast.  The key meets the
    # rows before the window, so that only its own rows are sorted.
    rows = d.versioned().join(F.broadcast(pair), on=KEYS, how="left_semi")
    hits = stage_versions(rows, KEYS, F.col(VERSION), silver.LATEST_ORDER)
    return hits.select(VERSION, *KEYS, "rating", "event_ts", "rating_source")


def q_point_before_after(spark, sf_dir):
    """One key before and after the corrections are merged without inserts: the first
    corrected pair, its rating at both versions, and the table's row counts, which agree.

    A pair's row at either version comes from one grouped pass over the raw batches, from which the
    pair and the counts are one aggregate more."""
    rows = _placed(_d(spark, sf_dir).versioned())
    place = F.struct(VERSION, *_PLACE)
    in_feed = F.col(VERSION) <= FEED_LAST_VERSION
    pairs = rows.groupBy(*KEYS).agg(
        F.max_by("rating", F.when(in_feed, place)).alias("rating_before"),
        F.max_by("rating", F.when(~in_feed, place)).alias("rating_corrected"),
        F.bool_or(in_feed).alias("held"),
    )
    held = pairs.filter("held").withColumn("rating_after", F.coalesce("rating_corrected", "rating_before"))
    pick = F.struct(*KEYS, "rating_before", "rating_after")
    first = held.agg(
        F.min(F.when(F.col("rating_before") != F.col("rating_after"), pick)).alias("r"),
        F.count(F.lit(1)).alias("rows_before"),
        F.count("rating_after").alias("rows_after"),
    )
    return first.select("r.*", "rows_before", "rows_after")


def q_reconcile_counts(spark, sf_dir):
    d = _d(spark, sf_dir)
    return reconcile_counts(d.typed, d.catalogue_ids)


# --- quality ------------------------------------------------------------------------

_DQ_COLS = ["name", "layer", "passed", "observed", "expectation", "blocking"]


def _silver_tables(d: Domain) -> dict:
    return {"silver": d.silver, "catalogue": d.catalogue, "quarantine": d.quarantine}


def _dq(select_name: str, layer: str):
    def run(spark, sf_dir):
        d = _d(spark, sf_dir)
        tables = _silver_tables(d) if layer == "silver" else {"fact": gold.fact_stage(d.merged)}
        groups = dict(quality.check_groups(layer, **tables))
        # Build only the group that owns the check (row checks share one scan).
        frame = groups[select_name]() if select_name in groups else groups["silver_rows"]()
        return frame.filter(F.col("name") == select_name).select(*_DQ_COLS)

    return run


def q_dq_report(spark, sf_dir):
    """All checks as one lazy plan over one grouped pass: both states of a key, hence its silver
    row, its row of the merged fact and its rejected rows."""
    d = _d(spark, sf_dir)
    return quality.report(mark_known(d.states, d.catalogue_ids, "movie_id"), KEYS).select(*_DQ_COLS)


def q_csv_lines(spark, sf_dir):
    """The feed as CSV text, some lines short, long or broken, parsed with corrupt lines kept."""
    return fixtures.parsed_lines(spark, sf_dir)


def q_csv_files(spark, sf_dir):
    """S1 end to end: the feed's CSV files scanned, short and long lines kept as corrupt, quoted
    values and line breaks read, each row with the folder that its file is in."""
    path = scratch_folder(spark, "csv")
    fixtures.write_csv_files(spark, sf_dir, path)
    columns = ["userId", "movieId", "rating", "timestamp", CORRUPT_COLUMN]
    folder = F.regexp_extract("_metadata.file_path", "/folder=([a-z]+)/", 1).alias("folder")
    plain, breaks = (read_csv_text(spark, f"{path}/folder={name}", config.RATINGS_TEXT_DDL, name == "breaks").select(*columns, folder) for name in ("plain", "breaks"))
    return plain.unionByName(breaks)


def q_csv_headers(spark, sf_dir):
    """The headers of the feed's CSV files before they are read, and how many lines follow."""
    path = scratch_folder(spark, "csv")
    fixtures.write_csv_files(spark, sf_dir, path)
    files = header_report(spark, path, config.RATINGS_TEXT_DDL)
    folder = F.regexp_extract("file", "/folder=([a-z]+)/", 1).alias("folder")
    return files.groupBy(folder, "header", "header_ok").agg(F.sum(F.col("num_lines") - 1).alias("num_lines"))


def q_append_relanded(spark, sf_dir):
    """Batches "01" and "1" landed, then "01" again an hour later: its rows are
    replaced, those of "1" stay, and both ids stay as they are."""
    d = _d(spark, sf_dir)
    wh = Warehouse(spark, scratch_folder(spark, "append"))
    stamped = lambda rows, batch, clock: rows.withColumns({"_ingest_batch": F.lit(batch), "_ingested_at": F.lit(clock).cast("timestamp_ntz")})
    for rows, batch, clock in ((d.feed_text, "01", fixtures.FIXTURE_CLOCK), (d.corrections_text, "1", fixtures.FIXTURE_CLOCK), (d.feed_text, "01", SECOND_CLOCK)):
        wh.land(stamped(rows, batch, clock), "ratings")
    landed = wh.read_landed("ratings").groupBy("_ingest_batch", "_source_role", "_ingested_at")
    return landed.agg(F.count(F.lit(1)).alias("row_count"), F.sum("_source_key").alias("key_sum"))


def q_append_schema_changes(spark, sf_dir):
    """A batch with a column too many, one too few and one of another type is not appended;
    the differences, and the values they concern, are the result."""
    d = _d(spark, sf_dir)
    wh = Warehouse(spark, scratch_folder(spark, "append"))
    wh.land(d.corrections_text, "ratings")
    odd = F.col("_source_key") % 2 == 1
    batch = d.feed_text.drop("timestamp").withColumns(
        {"device": F.when(odd, "phone"), "_source_key": F.when(odd, F.concat(F.lit("key "), "_source_key")).otherwise(F.col("_source_key").cast("string"))}
    )
    try:
        wh.land(batch, "ratings")
    except ValueError:
        return schema_changes(batch, wh.stored_schema("ratings"))
    raise AssertionError("a batch of another schema was appended")


HISTORY_BOUNDS = ((0, AS_OF_VERSION), (AS_OF_VERSION + 1, FEED_LAST_VERSION), (FEED_LAST_VERSION + 1, None))


def q_run_history(spark, sf_dir):
    """K3, V1, V3, D3: three batches of versions merged by as many runs of a stored table, the first
    of which creates it; the history is what the merges observed while writing."""
    d = _d(spark, sf_dir)
    wh = Warehouse(spark, scratch_folder(spark, "history"))
    for run, (low, high) in enumerate(HISTORY_BOUNDS):
        _, counts = wh.merge_run(d.batch(low, high), "state", run, "gold", KEYS, FACT_BUCKETS)
        wh.publish("gold", run, counts=counts)
    current = wh.last_run("gold").run
    return wh.history("gold").withColumn("is_current", F.col("version") == current)


def q_fact_bucketed(spark, sf_dir):
    """The fact of the feed stored in key buckets, then the corrected rows of silver merged
    into the buckets that they touch."""
    d = _d(spark, sf_dir)
    wh = Warehouse(spark, scratch_folder(spark, "fact"))
    before = silver.silver_from_routed(silver.route_ratings(silver.typed_ratings(d.feed_text), d.catalogue_ids, keyless=False))
    corrected = d.silver.filter(F.col("rating_source") == config.SOURCE_CORRECTION)
    for run, rows in enumerate((before, corrected)):
        fact, counts = wh.merge_run(gold.fact_stage(rows, keep_natural=True), "fact", run, "gold", KEYS, FACT_BUCKETS, gold.fact_keys())
        wh.publish("gold", run, counts=counts)
    return fact.select(*gold.FACT_COLUMNS)


def q_schema_report(spark, sf_dir):
    return schema_report(_d(spark, sf_dir).silver)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_as_text": q_bronze_as_text,
    "bronze_stamp": q_bronze_stamp,
    "conform_types": q_conform_types,
    "epoch_to_timestamp": q_epoch_to_timestamp,
    "union_corrections": q_union_corrections,
    "corrections_generate": q_corrections_generate,
    "latest_wins": q_latest_wins,
    "latest_valid_wins": q_latest_valid_wins,
    "validity_flag": q_validity_flag,
    "quarantine_invalid": q_quarantine_invalid,
    "quarantine_orphans": q_quarantine_orphans,
    "quarantine_all": q_quarantine_all,
    "ref_integrity_semi": q_ref_integrity_semi,
    "rating_tier": q_rating_tier,
    "month_bucket": q_month_bucket,
    "silver_feed": q_silver_feed,
    "genres_flat": q_genres_flat,
    "primary_genre": q_primary_genre,
    "release_year": q_release_year,
    "dedup_natural_key": q_dedup_natural_key,
    "silver_catalogue": q_silver_catalogue,
    "surrogate_key": q_surrogate_key,
    "decade": q_decade,
    "dim_item": q_dim_item,
    "dim_user": q_dim_user,
    "fact_stage": q_fact_stage,
    "merge_upsert": q_merge_upsert,
    "merge_guarded": q_merge_guarded,
    "merge_update_only": q_merge_update_only,
    "fact_not_in_stage": q_fact_not_in_stage,
    "snapshot_as_of": q_snapshot_as_of,
    "version_history": q_version_history,
    "version_diff": q_version_diff,
    "monthly_agg": q_monthly_agg,
    "fact_merged": q_fact_merged,
    "point_before_after": q_point_before_after,
    "csv_lines": q_csv_lines,
    "grain_duplicates": q_grain_duplicates,
    "event_range": q_event_range,
    "top1_lowest": q_top1_lowest,
    "point_lookup": q_point_lookup,
    "reconcile_counts": q_reconcile_counts,
    "dq_not_empty": _dq(quality.NOT_EMPTY.name, "silver"),
    "dq_silver_grain": _dq(quality.SILVER_GRAIN.name, "silver"),
    "dq_in_range": _dq(quality.IN_RANGE.name, "silver"),
    "dq_not_null": _dq(quality.NOT_NULL.name, "silver"),
    "dq_event_ts_not_null": _dq(quality.TS_NOT_NULL.name, "silver"),
    "dq_date_range": _dq(quality.DATE_RANGE.name, "silver"),
    "dq_fk_exists": _dq(quality.FK_EXISTS.name, "silver"),
    "dq_quarantine_kept": _dq(quality.QUARANTINE_KEPT.name, "silver"),
    "dq_fact_grain": _dq(quality.FACT_GRAIN.name, "gold"),
    "dq_corrections_applied": _dq(quality.CORRECTIONS_APPLIED.name, "gold"),
    "dq_report": q_dq_report,
    "csv_files": q_csv_files,
    "csv_headers": q_csv_headers,
    "append_relanded": q_append_relanded,
    "append_schema_changes": q_append_schema_changes,
    "run_history": q_run_history,
    "fact_bucketed": q_fact_bucketed,
    "schema_report": q_schema_report,
}
