"""Randomised properties against brute-force Python models (hypothesis)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from layerworks.operators.merge import merge_update_only, merge_upsert
from layerworks.operators.routing import ROUTE
from layerworks.plans import silver
from layerworks.sources.ingest import stamp_provenance

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

KEYS = st.integers(min_value=0, max_value=6)
ROWS = st.lists(st.tuples(KEYS, st.integers(min_value=0, max_value=99)), max_size=12, unique_by=lambda r: r[0])


def as_df(spark, rows):
    return spark.createDataFrame(rows, "k long, v long")


@SETTINGS
@given(target=ROWS, source=ROWS)
def test_upsert_and_update_only_match_a_dict_model(spark, target, source):
    t, s = dict(target), dict(source)
    upsert = {**t, **s}
    update_only = {k: s.get(k, v) for k, v in t.items()}
    tdf = as_df(spark, target) if target else spark.createDataFrame([], "k long, v long")
    sdf = as_df(spark, source) if source else spark.createDataFrame([], "k long, v long")
    assert dict(merge_upsert(tdf, sdf, ["k"]).collect()) == upsert
    assert dict(merge_update_only(tdf, sdf, ["k"]).collect()) == update_only


@SETTINGS
@given(
    target=st.lists(st.tuples(KEYS, st.integers(0, 9), st.integers(0, 5)), max_size=10, unique_by=lambda r: r[0]),
    source=st.lists(st.tuples(KEYS, st.integers(0, 9), st.integers(0, 5)), max_size=10, unique_by=lambda r: r[0]),
)
def test_guarded_upsert_matches_model(spark, target, source):
    schema = "k long, v long, ts long"
    model = {k: (v, ts) for k, v, ts in target}
    for k, v, ts in source:
        if k not in model or ts >= model[k][1]:
            model[k] = (v, ts)
    tdf = spark.createDataFrame(target, schema)
    sdf = spark.createDataFrame(source, schema)
    got = {r.k: (r.v, r.ts) for r in merge_upsert(tdf, sdf, ["k"], guard_col="ts").collect()}
    assert got == model


RAW = st.tuples(
    st.one_of(st.none(), st.sampled_from(["1", "2", "x"])),  # user
    st.one_of(st.none(), st.sampled_from(["10", "11", "12"])),  # movie (12 not in catalogue)
    st.sampled_from(["0.1", "0.5", "3.0", "5.0", "5.5", "NaN", "abc"]),  # rating text
    st.sampled_from(["1000", "2000", "2000", "abc"]),  # epoch text (ties on purpose)
)


def _model(rows):
    """Brute force: latest per non-NULL key by (time desc, position desc);
    NULL keys alone; then validity, then catalogue {10, 11}."""

    def num(x, cast):
        try:
            return cast(x)
        except (TypeError, ValueError):
            return None

    groups = {}
    for pos, (u, m, r, t) in enumerate(rows):
        uid, mid = num(u, int), num(m, int)
        key = (uid, mid) if uid is not None and mid is not None else ("solo", pos)
        rank = (num(t, int) is not None, num(t, int) or 0, pos)
        if key not in groups or rank > groups[key][0]:
            groups[key] = (rank, uid, mid, num(r, float))
    routes = {"clean": 0, "invalid": 0, "orphan": 0}
    for _, uid, mid, rating in groups.values():
        bad = uid is None or mid is None or rating is None or math.isnan(rating) or not (0.5 <= rating <= 5.0)
        routes["invalid" if bad else ("clean" if mid in (10, 11) else "orphan")] += 1
    return routes


@SETTINGS
@given(rows=st.lists(RAW, min_size=1, max_size=15))
def test_routing_partitions_latest_rows_like_the_model(spark, rows):
    data = [(u, m, r, t, i, 0) for i, (u, m, r, t) in enumerate(rows)]
    feed = stamp_provenance(
        spark.createDataFrame(data, "userId string, movieId string, rating string, timestamp string, _source_key long, _source_line int"),
        "f.csv",
        "primary",
        "b1",
        "2024-01-15 00:00:00",
    )
    catalogue = spark.createDataFrame([(10,), (11,)], "movie_id long")
    routed = silver.route_ratings(silver.typed_ratings(feed, None), catalogue)
    got = {"clean": 0, "invalid": 0, "orphan": 0}
    got.update(dict(routed.groupBy(ROUTE).count().collect()))
    assert got == _model(rows)
