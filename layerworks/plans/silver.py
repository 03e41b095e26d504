"""Silver: conformed, latest-wins, validated rows with a quarantine.

The whole ratings layer is ONE logical plan: union -> types -> latest per key
-> validity -> catalogue probe -> route.  Each deduplicated row carries a
``_route`` of clean / invalid / orphan, so the kept rows and the quarantined
rows come out of a single pass (write it once partitioned by route, or filter
it lazily for a query).  Nothing is counted or collected along the way.

Semantics kept from the layered design: dedup happens *before* validation, so
a newer invalid record evicts an older valid one and the key leaves silver
(it is quarantined with the newer record).  Deliberate deviations:

* rows with a NULL key pass through the window one by one and reach quarantine (nothing
  vanishes before the split); what needs no rejected row leaves them out before it;
* the latest-wins order is total (event time, ingest time, corrections before the
  feed, batch, file, source position), so reruns pick the same winner;
* catalogue dedup keeps the most recently landed row per item, not any row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import (
    epoch_seconds_to_ts,
    genres_array,
    invalid_rating,
    month_bucket,
    primary_genre,
    rating_tier,
    release_year,
    to_double,
    to_long,
)
from ..operators.dedup import dedup_natural_key, latest_wins
from ..operators.routing import ROUTE, ROUTE_CLEAN, ROUTE_INVALID, ROUTE_ORPHAN, attach_reason, mark_known

PROVENANCE = list(config.PROVENANCE)
# Total over all sources: a correction beats the feed at the same event and ingest time
# ("correction" sorts before "primary"); source positions count within one file only.
LATEST_ORDER = (
    "event_ts", "_ingested_at", "rating_source asc", "_ingest_batch", "_source_file", "_source_key", "_source_line", "rating",
)
# Window partition key, most selective column first: the sort before the
# (partial and final) top-1 uses the first key as its prefix, so fewer prefix
# ties means fewer full-row comparisons.
WINDOW_KEYS = ["movie_id", "user_id"]


# --- ratings: text -> typed ---------------------------------------------------


def rename_raw(bronze: DataFrame) -> DataFrame:
    """Raw names -> ``*_raw`` so the typed columns can take the clean names."""
    return bronze.withColumnsRenamed(
        {"userId": "user_id_raw", "movieId": "movie_id_raw", "timestamp": "event_ts_raw"}
    )


def tag_source(df: DataFrame, source: str) -> DataFrame:
    """Literal origin of each row."""
    return df.withColumn("rating_source", F.lit(source))


def union_sources(feed: DataFrame, corrections: DataFrame | None) -> DataFrame:
    """Primary feed UNION ALL corrections, by name, strict schema."""
    primary = tag_source(rename_raw(feed), config.SOURCE_PRIMARY)
    if corrections is None:
        return primary
    return primary.unionByName(tag_source(rename_raw(corrections), config.SOURCE_CORRECTION))


def conform_types(unioned: DataFrame) -> DataFrame:
    """Text -> long ids, double rating, epoch-seconds -> timestamp."""
    return unioned.select(
        to_long("user_id_raw").alias("user_id"),
        to_long("movie_id_raw").alias("movie_id"),
        to_double("rating").alias("rating"),
        epoch_seconds_to_ts("event_ts_raw").alias("event_ts"),
        "rating_source",
        *PROVENANCE,
    )


def typed_ratings(feed: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    return conform_types(union_sources(feed, corrections))


# --- ratings: latest wins + routing -------------------------------------------


def has_key():
    return F.col("user_id").isNotNull() & F.col("movie_id").isNotNull()


_ALONE = "_alone"


def latest_per_pair(typed: DataFrame) -> DataFrame:
    """Newest record per (user_id, movie_id); rows with a NULL key all stay.

    Each of these is a window partition of its own, told apart by a row id that is NULL for all others:
    one reading of the input serves both, and however many they are, they are dealt evenly."""
    alone = typed.withColumn(_ALONE, F.when(~has_key(), F.monotonically_increasing_id()))
    return latest_wins(alone, [*WINDOW_KEYS, _ALONE], LATEST_ORDER).drop(_ALONE)


def latest_keyed(typed: DataFrame) -> DataFrame:
    """W1 without rows that have a NULL key: partitioned by exactly the key for what follows."""
    return latest_wins(typed.filter(has_key()), WINDOW_KEYS, LATEST_ORDER)


def latest_valid_per_pair(typed: DataFrame) -> DataFrame:
    """Alternative order: validate first, then keep the newest *valid* record."""
    valid = typed.filter(~invalid_rating())
    return latest_wins(valid, WINDOW_KEYS, LATEST_ORDER)


def enrich(df: DataFrame) -> DataFrame:
    """Tier and month bucket."""
    return df.withColumn("rating_tier", rating_tier()).withColumn("rated_month", month_bucket())


def route_ratings(typed: DataFrame, catalogue: DataFrame, keyless: bool = True) -> DataFrame:
    """Every deduplicated row with ``_route`` in {clean, invalid, orphan}.

    Invalid wins over orphan (validity is checked first); orphan = a valid row
    whose movie_id is not in the catalogue.  ``keyless=False`` leaves out rows with a NULL
    key: no clean row is lost, and the others stay partitioned by their key.
    """
    latest = latest_per_pair(typed) if keyless else latest_keyed(typed)
    probed = mark_known(latest, catalogue.select("movie_id"), "movie_id")
    route = (
        F.when(invalid_rating(), F.lit(ROUTE_INVALID))
        .when(~F.col("_known"), F.lit(ROUTE_ORPHAN))
        .otherwise(F.lit(ROUTE_CLEAN))
    )
    return probed.withColumn(ROUTE, route).drop("_known")


def keyed_states(typed: DataFrame) -> DataFrame:
    """Per (movie_id, user_id) the latest row of all records (``now``) and of the primary feed alone
    (``before``, NULL without one), and how many records of either source there were.

    One grouped pass, combined in each map task: a merge of two states, its checks and
    its reconciliation read the input once.  Rows with a NULL key meet in groups whose counts count."""
    correction = F.col("rating_source") == config.SOURCE_CORRECTION
    place = F.struct("event_ts", "_ingested_at", correction.alias("_correction"), "_ingest_batch", "_source_file", "_source_key", "_source_line", "rating")
    row = F.struct("rating", "event_ts", "rating_source", "_source_role", "_ingest_batch")
    return typed.groupBy(*WINDOW_KEYS).agg(
        F.max_by(row, place).alias("now"),
        F.max_by(row, F.when(~correction, place)).alias("before"),
        F.count_if(~correction).alias("feed_rows"),
        F.count_if(correction).alias("correction_rows"),
    )


def valid_state(state: str):
    """Whether a state of ``keyed_states`` holds a valid row."""
    return F.col(state).isNotNull() & ~invalid_rating("user_id", "movie_id", F.col(state)["rating"])


def silver_from_routed(routed: DataFrame) -> DataFrame:
    return enrich(routed.filter(F.col(ROUTE) == ROUTE_CLEAN)).select(*SILVER_COLUMNS)


def quarantine_from_routed(routed: DataFrame, clock: str) -> DataFrame:
    rejected = routed.filter(F.col(ROUTE) != ROUTE_CLEAN)
    reason = F.when(F.col(ROUTE) == ROUTE_INVALID, F.lit(config.REASON_INVALID)).otherwise(
        F.lit(config.REASON_ORPHAN)
    )
    return attach_reason(rejected, reason, clock).select(*QUARANTINE_COLUMNS)


SILVER_COLUMNS = [
    "user_id",
    "movie_id",
    "rating",
    "event_ts",
    "rating_source",
    "rating_tier",
    "rated_month",
    *PROVENANCE,
]

# One quarantine schema for both reasons (no helper flag column leaks in).
QUARANTINE_COLUMNS = [
    "user_id",
    "movie_id",
    "rating",
    "event_ts",
    "rating_source",
    *PROVENANCE,
    "quarantine_reason",
    "quarantined_at",
]


def silver_ratings(feed: DataFrame, corrections: DataFrame | None, catalogue: DataFrame) -> DataFrame:
    """The silver ratings layer (kept rows only)."""
    return silver_from_routed(route_ratings(typed_ratings(feed, corrections), catalogue, keyless=False))


# --- catalogue ----------------------------------------------------------------


def conform_items(bronze_items: DataFrame) -> DataFrame:
    """Typed catalogue rows (one per landed record, not yet deduplicated)."""
    typed = bronze_items.select(
        F.trim("title").alias("title"),
        genres_array(F.col("genres")).alias("genres"),
        *PROVENANCE,
        to_long("movieId").alias("movie_id"),
    )
    return typed.withColumn("primary_genre", primary_genre("genres")).withColumn("release_year", release_year("title"))


def silver_catalogue(bronze_items: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """B2: typed items with a genre array, primary genre and release year.

    One row per movie_id: the most recently landed record wins.  With
    ``previous`` (the last published catalogue) only new bronze rows need to
    be passed: keeping the newest record per key is associative.
    """
    rows = conform_items(bronze_items)
    if previous is not None:
        rows = previous.select(*rows.columns).unionByName(rows)
    return dedup_natural_key(rows, ["movie_id"])


def catalogue_ids(bronze_items: DataFrame) -> DataFrame:
    """The set of known movie_ids, without choosing a winning row per id.

    Deduplication keeps exactly one row per id, so the *set* of ids is the
    same with or without it; consumers that only test existence or derive the
    surrogate key (which depends on the id alone) use this hash aggregation
    instead of the catalogue's sort-based dedup window.
    """
    return bronze_items.select(to_long("movieId").alias("movie_id")).filter(F.col("movie_id").isNotNull()).distinct()
