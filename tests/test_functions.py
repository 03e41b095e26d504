"""Scalar rules: conformance, validity, enrichment, keys, exact means."""

import datetime as dt
import hashlib
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerworks import functions as LF


def test_text_to_numbers_never_raises_under_ansi(spark):
    df = spark.createDataFrame([("abc",), ("1,00",), ("",), (" 12 ",), ("NaN",), ("12.7",), (None,)], "t string")
    out = df.select("t", LF.to_long("t").alias("l"), LF.to_double("t").alias("d")).collect()
    by = {r.t: (r.l, r.d) for r in out}
    assert by["abc"] == (None, None)
    assert by["1,00"] == (None, None)
    assert by[""] == (None, None)
    assert by[" 12 "][0] == 12
    assert by["12.7"][0] is None and by["12.7"][1] == 12.7
    assert by["NaN"][1] != by["NaN"][1]  # NaN parses to NaN
    assert by[None] == (None, None)


def test_epoch_seconds_text_to_utc_wallclock(spark):
    df = spark.createDataFrame([("1700000000",), ("abc",), ("1576822419",)], "t string")
    got = [r[0] for r in df.select(LF.epoch_seconds_to_ts("t")).collect()]
    assert got[0] == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert got[1] is None
    assert got[2] == dt.datetime(2019, 12, 20, 6, 13, 39)
    assert dict(df.select(LF.epoch_seconds_to_ts("t").alias("x")).dtypes)["x"] == "timestamp_ntz"


def test_epoch_round_trip(spark):
    df = spark.createDataFrame([(dt.datetime(1995, 1, 2),), (dt.datetime(2001, 11, 4, 5, 6, 7),)], "ts timestamp_ntz")
    back = df.select(LF.epoch_seconds_to_ts(LF.ts_to_epoch_seconds("ts").cast("string")).alias("b"), "ts")
    assert all(r.b == r.ts for r in back.collect())


def test_validity_flag_bounds_nulls_nan(spark):
    data = [
        (1, 1, 0.5, False),
        (1, 1, 5.0, False),
        (1, 1, 4.2, False),  # not on a 0.5 step, still valid
        (1, 1, 0.4, True),
        (1, 1, 5.1, True),
        (1, 1, float("nan"), True),
        (None, 1, 3.0, True),
        (1, None, 3.0, True),
        (1, 1, None, True),
    ]
    df = spark.createDataFrame(data, "user_id long, movie_id long, rating double, want boolean")
    for r in df.select(LF.invalid_rating().alias("got"), "want").collect():
        assert r.got is r.want


def test_tier_month_decade(spark):
    df = spark.createDataFrame(
        [(4.5, dt.datetime(2000, 3, 4), 1999), (3.0, dt.datetime(1999, 12, 31, 23, 59), 2000), (2.9, None, None)],
        "rating double, event_ts timestamp_ntz, release_year int",
    )
    out = df.select(LF.rating_tier().alias("t"), LF.month_bucket().alias("m"), LF.decade().alias("d")).collect()
    assert [tuple(r) for r in out] == [("high", "2000-03", 1990), ("medium", "1999-12", 2000), ("low", None, None)]


def test_genres_and_primary(spark):
    df = spark.createDataFrame(
        [("a||b",), ("",), ("(no genres listed)",), ("Comedy|Drama",), (None,)], "genres_raw string"
    )
    out = df.select(LF.genres_array().alias("g")).select("g", LF.primary_genre("g").alias("p")).collect()
    assert [(r.g, r.p) for r in out] == [
        (["a", "b"], "a"),
        ([], None),
        (["Unknown"], "Unknown"),
        (["Comedy", "Drama"], "Comedy"),
        (None, None),
    ]


def test_release_year_at_end_only(spark):
    df = spark.createDataFrame(
        [("X (1995) (2001)",), ("Toy Story (1995)   ",), ("No Year",), ("Year (1995) inside",), ("(12345)",)], "title string"
    )
    got = [r[0] for r in df.select(LF.release_year()).collect()]
    assert got == [2001, 1995, None, None, None]


def test_surrogate_key_matches_md5_and_keeps_null(spark):
    df = spark.createDataFrame([(1,), (None,)], "id long")
    got = [r[0] for r in df.select(LF.item_key("id")).collect()]
    assert got[0] == hashlib.md5(b"movie|1").hexdigest()
    assert got[1] is None


def _expected_mean(values):
    total = sum(Decimal(str(v)) for v in values)
    return float((total / len(values)).quantize(Decimal("0.001"), rounding=ROUND_HALF_UP))


def test_mean_half_up_tie(spark):
    # 151 x 2.8 + 49 x 2.7: mean exactly 2.7755 -> 2.776 whatever the order
    tie = [2.8] * 151 + [2.7] * 49
    for parts in (1, 7):
        df = spark.createDataFrame([(v,) for v in tie], "rating double").repartition(parts)
        assert df.agg(LF.mean_half_up("rating")).first()[0] == 2.776


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=50), min_size=1, max_size=40))
def test_mean_half_up_is_exact(spark, tenths):
    vals = [t / 10.0 for t in tenths]
    df = spark.createDataFrame([(v,) for v in vals], "rating double")
    assert df.agg(LF.mean_half_up("rating")).first()[0] == _expected_mean(vals)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([4.25, 3.333, 2.0005, 0.5]), st.integers(0, 5000).map(lambda t: t / 1000)), min_size=1, max_size=30))
def test_mean_half_up_off_the_grid(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "rating double")
    assert df.agg(LF.mean_half_up("rating")).first()[0] == _expected_mean(vals)


def test_mean_half_up_of_two_decimals(spark):
    df = spark.createDataFrame([(4.25,), (4.25,)], "rating double")
    assert df.agg(LF.mean_half_up("rating")).first()[0] == 4.25


def test_an_overlong_epoch_is_null(spark):
    texts = ["964982703", "99999999999999999", "1700000000000000", "1700000000000000000", "-99999999999999999", "abc", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(LF.epoch_seconds_to_ts("t")).collect()]
    assert got == [dt.datetime(2000, 7, 30, 18, 45, 3)] + [None] * 6


def test_mean_half_up_ignores_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, None)], "k int, rating double")
    got = dict(df.groupBy("k").agg(LF.mean_half_up("rating").alias("m")).collect())
    assert got == {1: 1.0, 2: None}


def test_within_dates_half_open(spark):
    df = spark.createDataFrame(
        [(dt.datetime(1990, 1, 1),), (dt.datetime(2029, 12, 31, 23),), (dt.datetime(2030, 1, 1),), (dt.datetime(1989, 12, 31),)],
        "ts timestamp_ntz",
    )
    got = [r[0] for r in df.select(LF.is_within_dates("ts", "1990-01-01", "2030-01-01")).collect()]
    assert got == [True, True, False, False]
    assert F is not None


def test_correction_sample_is_nested_and_deterministic(spark):
    from layerworks.plans.corrections import generate_corrections
    from layerworks.sources.fixtures import feed_typed

    feed = feed_typed(spark, "/root/testdata/sf0.001")
    a = generate_corrections(feed).collect()
    b = generate_corrections(feed).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    kinds = {}
    for r in a:
        kinds.setdefault(r.kind, set()).add((r._source_key, r._source_line))
    assert kinds["out_of_range"] <= kinds["re_rating"] and kinds["unknown_item"] <= kinds["re_rating"]
    assert all(r.rating == 9.9 for r in a if r.kind == "out_of_range")
    assert all(r.movie_id == 99999999 for r in a if r.kind == "unknown_item")
    every = generate_corrections(feed, rerate_fraction=1.0)
    assert every.filter("kind = 're_rating'").count() == feed.count()
    # a wider unknown-item slice than the re-rating slice still yields its rows
    wide = generate_corrections(feed, rerate_fraction=0.001, unknown_fraction=0.01, out_of_range_fraction=0.0)
    assert wide.filter("kind = 'unknown_item'").count() > wide.filter("kind = 're_rating'").count()


def test_recommended_conf_scales_with_input():
    from layerworks.session import recommended_conf

    small = recommended_conf(10 * 1024**2, total_cores=8)
    big = recommended_conf(100 * 1024**4, total_cores=8000)
    assert small["spark.sql.shuffle.partitions"] == "24"
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (256 * 1024**2)
