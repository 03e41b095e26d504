"""End-to-end: land -> silver -> gate -> gold -> gate, re-runs, gate failures."""

import os

import pytest
from pyspark.sql import functions as F

from layerworks import config
from layerworks.plans import gold, layers, quality, silver
from layerworks.plans.queries import Domain
from layerworks.sources import fixtures
from layerworks.sources.ingest import stamp_provenance
from layerworks.sources.warehouse import Warehouse

from .conftest import SF_SMALL, rows

CLOCK = "2024-01-15 00:00:00"


def land_fixture(spark, wh, with_corrections=True, batch=fixtures.FIXTURE_BATCH, clock=CLOCK):
    layers.land_bronze(
        wh,
        fixtures.feed_text(spark, SF_SMALL, batch, clock),
        fixtures.catalogue_text(spark, SF_SMALL, batch, clock),
        fixtures.corrections_text(spark, SF_SMALL, batch, clock) if with_corrections else None,
    )


def test_full_run_matches_queries_and_reruns_write_nothing(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    land_fixture(spark, wh)
    report = layers.run_layers(spark, wh, clock=CLOCK)
    assert all(r["passed"] for r in report.checks["silver"] + report.checks["gold"])

    d = Domain(spark, SF_SMALL)
    kept = layers.read_silver(wh)
    assert report.rows[layers.SILVER_RATINGS] == kept.count() == d.silver.count()
    assert report.rows[layers.QUARANTINE] == wh.read_landed(layers.QUARANTINE).count() == d.quarantine.count()
    assert kept.filter(F.col("event_ts").isNull()).count() == 0
    first, last = kept.agg(F.min("event_ts"), F.max("event_ts")).first()
    assert first.year == 1995 and 2001 <= last.year <= 2030
    fact = layers.read_fact(wh, 0)
    assert report.rows[layers.FACT] == fact.count() == d.fact.count()
    assert wh.read(layers.MONTHLY, 0).count() == d.fact.groupBy("movie_key", "rated_month").count().count()

    # nothing new: no fact row, no quarantined row, no run
    again = layers.run_layers(spark, wh, clock=CLOCK)
    assert again.rows == {layers.QUARANTINE: 0, layers.FACT: 0} and not again.published
    assert wh.read_landed(layers.QUARANTINE).count() == report.rows[layers.QUARANTINE]
    assert wh.last_run(layers.GOLD).run == 0
    assert spark.read.parquet(wh.path(layers.DQ_RESULTS)).count() == 8 + 2


def test_second_gold_run_merges_and_keeps_keys_that_left_silver(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    land_fixture(spark, wh, with_corrections=False)
    layers.run_layers(spark, wh, clock=CLOCK, expect_corrections=False, expect_quarantine=False)
    corrections = fixtures.corrections_text(spark, SF_SMALL, "20240116T000000Z", "2024-01-16 00:00:00")
    wh.land(corrections, layers.BRONZE_CORRECTIONS)
    layers.run_layers(spark, wh, clock=CLOCK)
    fact, d = layers.read_fact(wh, 1), Domain(spark, SF_SMALL)
    want = gold.fact_stage(d.merged).drop("_ingest_batch")
    got = fact.select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert fact.count() > layers.read_silver(wh).count()  # rejected winners left silver, not the fact
    assert fact.groupBy(*config.FACT_KEYS).count().filter("count > 1").count() == 0
    # the run before is still readable, and both are listed
    assert layers.read_fact(wh, 0).filter("rating_source = 'correction'").count() == 0
    assert [r.run for r in wh.runs(layers.GOLD).collect()] == [1, 0]
    assert [r.run for r in wh.runs(layers.GOLD, 1).collect()] == [1]


def test_relanding_the_feed_keeps_silver_stable(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    land_fixture(spark, wh)
    layers.run_silver(spark, wh, CLOCK)
    n1 = layers.read_silver(wh).count()
    land_fixture(spark, wh, batch="20240116T000000Z", clock="2024-01-16 00:00:00")
    layers.run_silver(spark, wh, CLOCK)
    assert layers.read_silver(wh).count() == n1
    assert wh.last_run(layers.SILVER).run == 1


def test_failing_gold_gate_publishes_nothing(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    land_fixture(spark, wh, with_corrections=False)
    layers.run_silver(spark, wh, CLOCK, expect_quarantine=False)
    with pytest.raises(quality.GateBlocked) as info:
        layers.run_gold(spark, wh, expect_corrections=True)
    assert [f["name"] for f in info.value.failures] == ["corrections_applied"]
    assert wh.last_run(layers.GOLD) is None
    # results were persisted before the raise
    assert spark.read.parquet(wh.path(layers.DQ_RESULTS)).filter(~F.col("passed")).count() == 1
    layers.run_gold(spark, wh, expect_corrections=False)
    assert wh.last_run(layers.GOLD).run == 0


def test_failing_silver_gate_keeps_the_rejected_rows(spark, tmp_root):
    # a catalogue that knows none of the rated items: every rating is an orphan, silver would
    # be empty, nothing is published, and the rejected rows can be read
    foreign_items = fixtures.catalogue_text(spark, SF_SMALL).withColumn(
        "movieId", (F.col("movieId").cast("bigint") + 10**9).cast("string")
    )
    wh = Warehouse(spark, tmp_root)
    layers.land_bronze(wh, fixtures.feed_text(spark, SF_SMALL), foreign_items, None)
    for _ in range(2):  # a second attempt replaces the rows of the first
        with pytest.raises(quality.GateBlocked) as info:
            layers.run_silver(spark, wh, CLOCK)
        assert "silver_ratings_not_empty" in [f["name"] for f in info.value.failures]
        assert wh.last_run(layers.SILVER) is None
        parked = wh.read_landed(layers.QUARANTINE)
        assert parked.count() == silver.latest_per_pair(Domain(spark, SF_SMALL).typed.filter("rating_source = 'primary'")).count()


def test_pipeline_from_csv_files(spark, tmp_root):
    def write(name, text):
        path = os.path.join(tmp_root, name)
        with open(path, "w", encoding="utf-8") as fh:
            fh.write(text)
        return path

    ratings = write(
        "ratings.csv",
        "userId,movieId,rating,timestamp\n1,1,4.0,964982703\n1,2,3.5,964982703\n2,1,abc,964982703\n2,2,5.0,964982703\n",
    )
    movies = write(
        "movies.csv",
        'movieId,title,genres\n1,Toy Story (1995),Adventure|Animation\n2,"Heat, The (1995)",(no genres listed)\n',
    )
    corrections = write("rating_corrections.csv", "userId,movieId,rating,timestamp\n1,1,1.0,1700000000\n1,99999999,4.0,1700000900\n")
    wh = Warehouse(spark, os.path.join(tmp_root, "wh"))
    layers.land_files(spark, wh, ratings, movies, corrections, batch_id="b1", clock=CLOCK)
    layers.run_layers(spark, wh, clock=CLOCK)
    kept = {(r.user_id, r.movie_id): (r.rating, r.rating_source) for r in layers.read_silver(wh).collect()}
    assert kept == {(1, 1): (1.0, "correction"), (1, 2): (3.5, "primary"), (2, 2): (5.0, "primary")}
    reasons = sorted(r.quarantine_reason for r in wh.read_landed(layers.QUARANTINE).collect())
    assert reasons == sorted([config.REASON_INVALID, config.REASON_ORPHAN])
    dim = {r.movie_natural_key: (r.primary_genre, r.release_year, r.decade) for r in wh.read(layers.DIM_ITEM, 0).collect()}
    assert dim == {1: ("Adventure", 1995, 1990), 2: ("Unknown", 1995, 1990)}
    # no corrections file at all is allowed at ingest
    wh2 = Warehouse(spark, os.path.join(tmp_root, "wh2"))
    layers.land_files(spark, wh2, ratings, movies, os.path.join(tmp_root, "missing.csv"), batch_id="b1", clock=CLOCK)
    layers.run_layers(spark, wh2, clock=CLOCK, expect_corrections=False)
    assert layers.read_silver(wh2).count() == 3


def test_report_counts_come_from_the_writes(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    land_fixture(spark, wh)
    report = layers.run_layers(spark, wh, clock=CLOCK)
    d = Domain(spark, SF_SMALL)
    assert report.rows[layers.SILVER_RATINGS] == d.silver.count()
    assert report.rows[layers.QUARANTINE] == d.quarantine.count()
    assert report.rows[layers.DIM_USER] == d.dim_user.count()
    assert report.published == {"silver": 0, "gold": 0}


def test_append_with_another_schema_is_rejected(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    wh.append(spark.createDataFrame([(1, "a")], "id long, name string"), "t")
    with pytest.raises(ValueError):
        wh.append(spark.createDataFrame([(1, "a", 2)], "id long, name string, extra int"), "t")
    assert wh.append(spark.createDataFrame([(2, "b")], "id long, name string"), "t") == 1


def test_command_line_runs_all_stages_and_signals_a_gate_failure(spark, tmp_root):
    from layerworks.__main__ import main

    def write(name, text):
        path = os.path.join(tmp_root, name)
        with open(path, "w", encoding="utf-8") as fh:
            fh.write(text)
        return path

    ratings = write("ratings.csv", "userId,movieId,rating,timestamp\n1,1,4.0,964982703\n2,1,9.0,964982703\n")
    movies = write("movies.csv", "movieId,title,genres\n1,Toy Story (1995),Adventure\n")
    root = os.path.join(tmp_root, "wh")
    # no corrections: the gold gate's corrections check must block publication
    assert main(["--root", root, "--ratings", ratings, "--movies", movies]) == 2
    from layerworks.session import get_session

    s = get_session()
    assert Warehouse(s, root).last_run(layers.SILVER).run == 0
    assert Warehouse(s, root).last_run(layers.GOLD) is None
    assert main(["--root", root, "--stage", "gold", "--no-expect-corrections"]) == 0


def test_incremental_silver_equals_a_full_rebuild(spark, tmp_root):
    cols = ["user_id", "movie_id", "rating", "event_ts", "rating_source", "_ingest_batch"]
    feed = fixtures.feed_text(spark, SF_SMALL, "b1", "2024-01-15 00:00:00")
    corr = fixtures.corrections_text(spark, SF_SMALL, "b2", "2024-01-16 00:00:00")
    items = fixtures.catalogue_text(spark, SF_SMALL, "b1", "2024-01-15 00:00:00")

    inc = Warehouse(spark, tmp_root + "/inc")
    layers.land_bronze(inc, feed, items, None)
    layers.run_silver(spark, inc, CLOCK, expect_quarantine=False)
    first = layers.read_silver(inc).count()
    # the corrections arrive, and the catalogue is re-landed with new titles
    items2 = fixtures.catalogue_text(spark, SF_SMALL, "b2", "2024-01-16 00:00:00").withColumn(
        "title", F.concat(F.lit("New "), F.col("title"))
    )
    layers.land_bronze(inc, feed.limit(0), items2, corr)
    layers.run_silver(spark, inc, CLOCK)

    full = Warehouse(spark, tmp_root + "/full")
    layers.land_bronze(full, feed, items, corr)
    full.land(items2, layers.BRONZE_ITEMS)
    layers.run_silver(spark, full, CLOCK, incremental=False)
    item_cols = ["movie_id", "title", "primary_genre", "release_year", "_ingest_batch"]
    got_items = inc.read(layers.SILVER_ITEMS, 1).select(*item_cols)
    want_items = full.read(layers.SILVER_ITEMS, 0).select(*item_cols)
    assert got_items.exceptAll(want_items).count() == 0 and want_items.exceptAll(got_items).count() == 0
    assert got_items.filter(F.col("title").startswith("New ")).count() == got_items.count()

    got = layers.read_silver(inc).select(*cols)
    want = layers.read_silver(full).select(*cols)
    assert got.count() == want.count() != first
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # each rejected row is parked once, by the run that read it
    parked = [w.read_landed(layers.QUARANTINE).select(*cols) for w in (inc, full)]
    assert parked[1].exceptAll(parked[0]).count() == 0
    # a run with nothing new keeps silver unchanged
    layers.run_silver(spark, inc, CLOCK)
    assert wh_runs(inc) == [1, 0]
    assert layers.read_silver(inc).select(*cols).exceptAll(want).count() == 0


def wh_runs(wh):
    return [r.run for r in wh.runs(layers.SILVER).collect()]


def test_batches_with_older_or_equal_ingest_times_are_read(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)

    def land(table, batch, clock, values):
        names = "userId string, movieId string, rating string, timestamp string" if table != layers.BRONZE_ITEMS else "movieId string, title string, genres string"
        raw = spark.createDataFrame(values, names).withColumns({layers.CORRUPT_COLUMN: F.lit(None).cast("string"), "_source_key": F.lit(0)})
        wh.land(stamp_provenance(raw, "f.csv", "primary", batch, clock), table)

    def run():
        layers.run_silver(spark, wh, CLOCK, expect_quarantine=False)
        return {(r.user_id, r.movie_id) for r in layers.read_silver(wh).collect()}

    def parked():
        return sorted(r.user_id for r in wh.read_landed(layers.QUARANTINE).collect())

    land(layers.BRONZE_RATINGS, "b0", "2024-01-15 10:01:00", [("1", "1", "4.0", "964982703"), ("2", "1", "9.0", "964982703")])
    land(layers.BRONZE_ITEMS, "b2", "2024-01-15 10:05:00", [("1", "Toy Story (1995)", "Adventure")])
    assert run() == {(1, 1)} and parked() == [2]
    # stamped before what the first run read, finished after it, and of a batch id it knows from another table
    land(layers.BRONZE_RATINGS, "b1", "2024-01-15 10:00:00", [("3", "1", "4.0", "964982703"), ("4", "1", "9.0", "964982703")])
    land(layers.BRONZE_CORRECTIONS, "b0", "2024-01-15 10:01:00", [("1", "1", "5.0", "964982709"), ("6", "1", "9.0", "964982703")])
    assert run() == {(1, 1), (3, 1)} and parked() == [2, 4, 6]
    # a second landing in the same second
    land(layers.BRONZE_RATINGS, "b3", "2024-01-15 10:05:00", [("5", "1", "4.0", "964982703")])
    assert run() == {(1, 1), (3, 1), (5, 1)} and parked() == [2, 4, 6]
    assert run() == {(1, 1), (3, 1), (5, 1)} and wh_runs(wh) == [2, 1, 0]


def rating_rows(spark, batch, values, clock="2024-01-15 10:00:00"):
    raw = spark.createDataFrame(values, "userId string, movieId string, rating string, timestamp string")
    raw = raw.withColumns({layers.CORRUPT_COLUMN: F.lit(None).cast("string"), "_source_key": F.lit(0)})
    return stamp_provenance(raw, "f.csv", "primary", batch, clock)


def item_rows(spark, batch, ids, clock="2024-01-15 10:00:00"):
    raw = spark.createDataFrame([(str(i), f"Item {i} (1995)", "Drama") for i in ids], "movieId string, title string, genres string")
    raw = raw.withColumns({layers.CORRUPT_COLUMN: F.lit(None).cast("string"), "_source_key": F.lit(0)})
    return stamp_provenance(raw, "i.csv", "primary", batch, clock)


def test_batch_ids_stay_strings_and_every_batch_is_read(spark, tmp_root):
    """Ids that a reader would take for equal numbers or dates are batches of their own."""
    wh = Warehouse(spark, tmp_root)
    wh.land(item_rows(spark, "i", [1]), layers.BRONZE_ITEMS)
    ids = ["1", "01", "0012", "12", "1e3", "1000.0", "2024-01-15", "-0", "a b/c=d%e", "20240115T000000Z"]
    for user, batch in enumerate(ids):
        wh.land(rating_rows(spark, batch, [(str(user), "1", "4.0", "964982703")]), layers.BRONZE_RATINGS)
        layers.run_silver(spark, wh, CLOCK, expect_quarantine=False)
        kept = {(r.user_id, r._ingest_batch) for r in layers.read_silver(wh).collect()}
        assert kept == set(enumerate(ids[: user + 1]))
    assert wh.landed_values(layers.BRONZE_RATINGS) == sorted(ids)
    assert {r._ingest_batch for r in wh.read_landed(layers.BRONZE_RATINGS).collect()} == set(ids)


def test_second_attempt_without_rejected_rows_leaves_none(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    wh.land(item_rows(spark, "i", [2]), layers.BRONZE_ITEMS)
    wh.land(rating_rows(spark, "b", [("1", "1", "4.0", "964982703")]), layers.BRONZE_RATINGS)
    with pytest.raises(quality.GateBlocked):  # silver would be empty
        layers.run_silver(spark, wh, CLOCK)
    assert wh.read_landed(layers.QUARANTINE).count() == 1
    wh.land(item_rows(spark, "i", [1, 2]), layers.BRONZE_ITEMS)
    layers.run_silver(spark, wh, CLOCK, expect_quarantine=False)
    assert wh.read_landed(layers.QUARANTINE).count() == 0 and layers.read_silver(wh).count() == 1


def files_of(root, name):
    found = {}
    for folder, _, names in os.walk(os.path.join(root, name)):
        found |= {os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


def test_fact_merge_rewrites_touched_buckets_only(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    wh.land(item_rows(spark, "i", range(1, 40)), layers.BRONZE_ITEMS)
    wh.land(rating_rows(spark, "b0", [(str(u), str(m), "4.0", "964982703") for u in range(1, 20) for m in range(1, 40)]), layers.BRONZE_RATINGS)

    def run():
        layers.run_layers(spark, wh, clock=CLOCK, expect_quarantine=False, expect_corrections=False)

    run()
    before = files_of(tmp_root, layers.FACT)
    assert len({os.path.dirname(f) for f in before}) == layers.FACT_BUCKETS
    wh.land(rating_rows(spark, "b1", [("1", "1", "2.0", "964982999"), ("99", "2", "5.0", "964982999"), ("1", "2", "9.0", "964982999")]), layers.BRONZE_RATINGS)
    run()
    after = files_of(tmp_root, layers.FACT)
    assert all(after[f] == t for f, t in before.items())
    new = {os.path.basename(os.path.dirname(f)) for f in after.keys() - before.keys()}
    assert 1 <= len(new) <= 2  # the buckets of (1, 1) and (2, 99); the rejected row touches none
    fact = {(r.user_id, r.movie_id): r.rating for r in layers.read_fact(wh).collect()}
    assert len(fact) == 19 * 39 + 1 and fact[1, 1] == 2.0 and fact[99, 2] == 5.0 and fact[1, 2] == 4.0
    assert {(r.user_id, r.movie_id): r.rating for r in layers.read_fact(wh, 0).collect()}[1, 1] == 4.0
    history = [(r.version, r.operation, r.num_inserted, r.num_updated, r.num_rows) for r in wh.history(layers.GOLD).collect()]
    assert history == [(1, "MERGE", 1, 1, 742), (0, "WRITE", 741, 0, 741)]
    assert [r.kept for r in wh.runs(layers.GOLD).collect()] == [740, 0]
    # an attempt whose gate fails is not listed, and the next one writes over it
    wh.land(rating_rows(spark, "b2", [("7", "7", "1.0", "964983999")]), layers.BRONZE_RATINGS)
    layers.run_silver(spark, wh, CLOCK, expect_quarantine=False)
    with pytest.raises(quality.GateBlocked):
        layers.run_gold(spark, wh)
    assert {(r.user_id, r.movie_id): r.rating for r in layers.read_fact(wh).collect()} == fact
    layers.run_gold(spark, wh, expect_corrections=False)
    assert {(r.user_id, r.movie_id): r.rating for r in layers.read_fact(wh).collect()} == {**fact, (7, 7): 1.0}
    # a catalogue batch makes rows of older batches known: they are merged as well
    wh.land(rating_rows(spark, "b3", [("5", "77", "3.0", "964983999")]), layers.BRONZE_RATINGS)
    layers.run_silver(spark, wh, CLOCK)
    layers.run_gold(spark, wh, expect_corrections=False)
    wh.land(item_rows(spark, "i2", [77]), layers.BRONZE_ITEMS)
    run()
    assert layers.read_fact(wh).filter("movie_id = 77").count() == 1


def test_buckets_of_a_corrected_feed_equal_the_whole_merge(spark, tmp_root):
    from layerworks.plans.queries import QUERIES

    got, want = QUERIES["fact_bucketed"](spark, SF_SMALL), QUERIES["fact_merged"](spark, SF_SMALL)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def written_plans(monkeypatch):
    """The plans of what ``write_run`` is given from now on, as they are when it is."""
    plans, write = [], Warehouse.write_run

    def spy(self, df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, *args, **kwargs)

    monkeypatch.setattr(Warehouse, "write_run", spy)
    return plans


def test_merge_computes_its_batch_once_and_deals_each_side_once(spark, tmp_root, monkeypatch):
    wh, plans, seen = Warehouse(spark, tmp_root), written_plans(monkeypatch), spark.sparkContext.accumulator(0)

    def counted(movie_id):
        seen.add(1)
        return movie_id >= 0

    def batch(low, high, rating):
        return spark.range(low, high).select(F.col("id").alias("movie_id"), (F.col("id") % 7).alias("user_id"), F.lit(rating).alias("rating"))

    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(setting)
    monkeypatch.setattr("layerworks.sources.warehouse.PART_ROWS", 5, raising=False)
    _, counts = wh.merge_run(batch(0, 100, 1.0), "t", 0, "gold", layers.FACT_IDS, 8)
    wh.publish("gold", 0, counts=counts)
    changed = batch(90, 110, 2.0).filter(F.udf(counted, "boolean")("movie_id"))
    table, counts = wh.merge_run(changed, "t", 1, "gold", layers.FACT_IDS, 8)
    assert seen.value == 20  # it was computed a second time for the buckets that it touches
    assert counts == {"rows": 110, "inserted": 10, "updated": 10, "kept": 90}
    assert plans[1].count("Exchange ") == plans[1].count("Exchange hashpartitioning(_bucket") == 2
    assert {(r.movie_id, r.user_id): r.rating for r in table.collect()} == {(m, m % 7): 1.0 if m < 90 else 2.0 for m in range(110)}
    assert spark.conf.get(setting) == before and not os.path.exists(os.path.join(tmp_root, "t", "_batch"))


def test_hashed_keys_of_the_fact_cross_no_shuffle_of_its_merge(spark, monkeypatch):
    from layerworks.plans.queries import QUERIES

    plans = written_plans(monkeypatch)
    got = QUERIES["fact_bucketed"](spark, SF_SMALL)
    assert len(plans) == 2
    for plan in plans:
        written, dealt = plan.split("Exchange ", 1)
        assert "user_key" in written and "movie_key" in written
        assert "user_key" not in dealt and "movie_key" not in dealt
    from layerworks.functions import item_key, user_key

    want = Domain(spark, SF_SMALL).merged.select(user_key("user_id").alias("user_key"), item_key("movie_id").alias("movie_key"), "rating")
    assert got.select(*want.columns).exceptAll(want).count() == 0 and want.exceptAll(got.select(*want.columns)).count() == 0


def test_merge_run_takes_null_and_repeated_keys_as_the_full_join_does(spark, tmp_root):
    from layerworks.operators.merge import merge_upsert

    wh, schema = Warehouse(spark, tmp_root), "movie_id long, user_id long, rating double"
    old = spark.createDataFrame([(1, 1, 1.0), (1, 1, 2.0), (2, 1, 3.0), (None, 1, 4.0), (3, None, 5.0), (4, 4, None)], schema)
    new = spark.createDataFrame([(1, 1, 6.0), (2, 1, 7.0), (2, 1, 7.5), (None, 1, 8.0), (5, 5, None)], schema)
    for run, batch in enumerate((old, new, new.limit(0))):
        table, counts = wh.merge_run(batch, "t", run, "gold", layers.FACT_IDS, 4)
        wh.publish("gold", run, counts=counts)
        if run == 1:
            assert counts["inserted"] == 2 and counts["updated"] == 4
    assert rows(table) == rows(merge_upsert(old, new, layers.FACT_IDS, validate_source=False))


def test_run_history_equals_the_history_of_versions(spark):
    from layerworks.operators.versions import version_history
    from layerworks.plans import queries

    d = Domain(spark, SF_SMALL)
    runs = F.when(F.col("version") <= queries.AS_OF_VERSION, 0).when(F.col("version") <= queries.FEED_LAST_VERSION, 1).otherwise(2)
    want = version_history(d.versioned().withColumn("version", runs), queries.KEYS).collect()
    got = queries.QUERIES["run_history"](spark, SF_SMALL).drop("is_current").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_clustered_files_are_skipped_by_point_lookups(spark, tmp_root):
    import pyarrow.parquet as pq

    wh = Warehouse(spark, tmp_root)
    rows = spark.range(40_000).select(F.pmod(F.xxhash64("id"), F.lit(5000)).alias("movie_id"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(900)).alias("user_id"), F.lit(1.0).alias("rating"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        back, counts = wh.write_run(rows, "t", 0, cluster_by=["movie_id", "user_id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert counts == {"rows": 40_000} and back.count() == 40_000
    spans = []
    for f in files_of(tmp_root, "t"):
        column = pq.read_table(f, columns=["movie_id"]).column(0).to_numpy()
        assert (column[1:] >= column[:-1]).all()
        spans.append((column.min(), column.max()))
    assert len(spans) >= 8
    for movie in (3, 2500, 4999):
        assert sum(a <= movie <= b for a, b in spans) <= 2
