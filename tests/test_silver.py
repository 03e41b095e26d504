"""Silver semantics: latest wins, routing, quarantine, catalogue."""

from pyspark.sql import functions as F

from layerworks import config
from layerworks.operators.routing import ROUTE
from layerworks.plans import silver
from layerworks.plans.reconcile import reconcile_counts
from layerworks.sources.ingest import stamp_provenance

from .conftest import rows

RATINGS = "userId string, movieId string, rating string, timestamp string, _source_key long, _source_line int"
ITEMS = "movieId string, title string, genres string, _source_key long, _source_line int"


def bronze(spark, data, role="primary", batch="b1", clock="2024-01-15 00:00:00", schema=RATINGS, file="f.csv"):
    return stamp_provenance(spark.createDataFrame(data, schema), file, role, batch, clock)


def catalogue(spark, ids):
    data = [(str(i), f"Title {i} (1999)", "Drama|Comedy", i, 0) for i in ids]
    return silver.silver_catalogue(bronze(spark, data, schema=ITEMS))


def test_correction_wins_and_two_corrections_resolve_to_latest(spark):
    feed = bronze(spark, [("1", "10", "3.0", "1000", 1, 1), ("1", "11", "2.0", "1000", 2, 1)])
    corr = bronze(
        spark,
        [("1", "10", "5.0", "2000", 9, 1), ("1", "10", "1.0", "3000", 9, 2)],
        role=config.ROLE_CORRECTIONS,
    )
    out = silver.silver_ratings(feed, corr, catalogue(spark, [10, 11]))
    got = rows(out, "user_id", "movie_id", "rating", "rating_source")
    assert got == [(1, 10, 1.0, "correction"), (1, 11, 2.0, "primary")]


def test_ties_on_time_break_by_source_position(spark):
    # same key, same event time, same ingest time: the later source position wins
    feed = bronze(spark, [("1", "10", "3.0", "1000", 5, 1), ("1", "10", "4.0", "1000", 5, 2), ("1", "10", "2.0", "1000", 4, 9)])
    out = silver.latest_per_pair(silver.typed_ratings(feed, None))
    assert rows(out, "rating") == [(4.0,)]


def test_unparsed_time_loses(spark):
    feed = bronze(spark, [("1", "10", "3.0", "abc", 9, 9), ("1", "10", "4.0", "1000", 1, 1)])
    out = silver.latest_per_pair(silver.typed_ratings(feed, None))
    assert rows(out, "rating") == [(4.0,)]


def test_dedup_before_validation_evicts_valid_row(spark):
    feed = bronze(spark, [("1", "10", "3.0", "1000", 1, 1)])
    corr = bronze(spark, [("1", "10", "9.9", "2000", 2, 1)], role=config.ROLE_CORRECTIONS)
    typed = silver.typed_ratings(feed, corr)
    routed = silver.route_ratings(typed, catalogue(spark, [10]))
    assert rows(routed, ROUTE, "rating") == [("invalid", 9.9)]
    # the alternative order keeps the older valid record
    assert rows(silver.latest_valid_per_pair(typed), "rating") == [(3.0,)]


def test_null_keys_are_never_collapsed(spark):
    feed = bronze(
        spark,
        [("abc", "10", "3.0", "1000", 1, 1), ("xyz", "10", "3.0", "1000", 2, 1), ("1", None, "3.0", "1000", 3, 1)],
    )
    routed = silver.route_ratings(silver.typed_ratings(feed, None), catalogue(spark, [10]))
    assert rows(routed, ROUTE) == [("invalid",)] * 3
    q = silver.quarantine_from_routed(routed, "2024-01-15 00:00:00")
    assert q.count() == 3
    assert set(q.columns) == set(silver.QUARANTINE_COLUMNS)


def test_orphans_and_invalid_get_their_reason(spark):
    feed = bronze(spark, [("1", "10", "3.0", "1000", 1, 1), ("1", "99", "3.0", "1000", 2, 1), ("1", "11", "0.1", "1000", 3, 1)])
    routed = silver.route_ratings(silver.typed_ratings(feed, None), catalogue(spark, [10, 11]))
    q = silver.quarantine_from_routed(routed, "2024-01-15 00:00:00")
    assert rows(q, "movie_id", "quarantine_reason") == [
        (11, config.REASON_INVALID),
        (99, config.REASON_ORPHAN),
    ]
    assert rows(silver.silver_from_routed(routed), "movie_id", "rating_tier", "rated_month") == [(10, "medium", "1970-01")]


def test_every_input_row_is_kept_superseded_or_quarantined(spark):
    # 3 users x 4 movies x 2 times; the newest record of a pair is valid unless
    # movie 1 (rating 6.0 = invalid); movie 3 is not in the catalogue (orphan).
    data = []
    for u in range(3):
        for m in range(4):
            for t in (1, 2):
                r = "6.0" if (m == 1 and t == 2) else f"{1 + t}.0"
                data.append((str(u), str(m), r, str(1000 + t), len(data), 0))
    typed = silver.typed_ratings(bronze(spark, data), None)
    routed = silver.route_ratings(typed, catalogue(spark, [0, 1, 2]))
    n_in = typed.count()
    superseded = n_in - silver.latest_per_pair(typed).count()
    by_route = dict(routed.groupBy(ROUTE).count().collect())
    assert (n_in, superseded) == (24, 12)
    assert by_route == {"clean": 6, "invalid": 3, "orphan": 3}
    assert sum(by_route.values()) + superseded == n_in


def test_rerun_is_idempotent(spark):
    data = [("1", "10", "3.0", "1000", 1, 1), ("2", "10", "4.0", "1000", 2, 1)]
    once = bronze(spark, data, batch="b1", clock="2024-01-15 00:00:00")
    twice = once.unionByName(bronze(spark, data, batch="b2", clock="2024-01-16 00:00:00"))
    cat = catalogue(spark, [10])
    a = rows(silver.silver_ratings(once, None, cat), "user_id", "movie_id", "rating")
    b = rows(silver.silver_ratings(twice, None, cat), "user_id", "movie_id", "rating")
    assert a == b


def test_catalogue_latest_landing_wins(spark):
    first = bronze(spark, [("1", "Old (1990)", "A", 1, 0)], batch="b1", clock="2024-01-15 00:00:00", schema=ITEMS)
    second = bronze(spark, [("1", "New (1991)", "B|C", 1, 0)], batch="b2", clock="2024-01-16 00:00:00", schema=ITEMS)
    cat = silver.silver_catalogue(first.unionByName(second))
    assert rows(cat, "movie_id", "title", "primary_genre", "release_year") == [(1, "New (1991)", "B", 1991)]


def test_union_requires_same_columns(spark):
    feed = bronze(spark, [("1", "10", "3.0", "1000", 1, 1)])
    corr = bronze(spark, [("1", "10", "3.0", "1000", 1, 1)]).withColumn("extra", F.lit(1))
    try:
        silver.union_sources(feed, corr).collect()
    except Exception as error:  # noqa: BLE001
        assert "NUM_COLUMNS_MISMATCH" in str(error) or "UNION" in str(error).upper()
    else:
        raise AssertionError("union by name accepted an extra column")


def test_a_correction_wins_a_full_tie_whatever_the_union_order(spark):
    feed = silver.tag_source(silver.rename_raw(bronze(spark, [("1", "10", "1.0", "1000", 0, 0)], file="a.csv")), config.SOURCE_PRIMARY)
    corr = silver.tag_source(silver.rename_raw(bronze(spark, [("1", "10", "5.0", "1000", 0, 0)], file="b.csv")), config.SOURCE_CORRECTION)
    for both in (feed.unionByName(corr), corr.unionByName(feed)):
        out = silver.latest_per_pair(silver.conform_types(both))
        assert rows(out, "rating", "rating_source") == [(5.0, "correction")]


def test_rows_with_null_keys_stay_one_by_one_and_spread(spark):
    """A third of all rows without a key: each stays, equal rows too, and none decides for another."""
    rows = [(None, 7, 4.0)] * 300 + [(5, None, 4.0)] * 300 + [(None, None, None)] * 300 + [(u, 1, 3.0) for u in range(300)] * 2
    raw = spark.createDataFrame(rows, "u long, m long, r double").select(
        F.col("u").cast("string").alias("userId"), F.col("m").cast("string").alias("movieId"), F.col("r").cast("string").alias("rating"), F.lit("964982703").alias("timestamp")
    )
    typed = silver.typed_ratings(stamp_provenance(raw.withColumn("_source_key", F.lit(1)), "f", "primary", "b", "2024-01-15 00:00:00"))
    latest = silver.latest_per_pair(typed)
    assert latest.count() == 900 + 300 and "_alone" not in latest.columns
    ids = spark.createDataFrame([(1,)], "movie_id long")
    routed = silver.route_ratings(typed, ids)
    assert {r._route: r["count"] for r in routed.groupBy("_route").count().collect()} == {"invalid": 900, "clean": 300}
    assert silver.route_ratings(typed, ids, keyless=False).count() == 300
    counts = reconcile_counts(typed, ids).first()
    assert (counts.input_rows, counts.superseded_rows, counts.latest_rows, counts.invalid_rows, counts.silver_rows, counts.balanced) == (1500, 300, 1200, 900, 300, True)
