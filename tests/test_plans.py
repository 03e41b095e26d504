"""Physical-plan properties the scale design relies on (checked on sf0.001)."""

import re

from layerworks.plans import gold, layers, silver
from layerworks.plans.queries import QUERIES, Domain
from layerworks.sources import fixtures
from layerworks.sources.warehouse import Warehouse

from .conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_wins_limits_before_the_shuffle(spark):
    plan = plan_of(silver.latest_per_pair(Domain(spark, SF_SMALL).typed))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    # exactly one shuffle of the rating rows
    assert len(re.findall(r"Exchange hashpartitioning\(movie_id#\d+L, user_id", plan)) == 1


def test_catalogue_is_probed_by_one_join(spark):
    plan = plan_of(Domain(spark, SF_SMALL).routed)
    joins = re.findall(r"(\w+HashJoin|SortMergeJoin) .*?(Inner|LeftOuter|LeftAnti|LeftSemi)", plan)
    assert [kind for _, kind in joins] == ["LeftOuter"]


def test_monthly_aggregate_joins_attributes_after_aggregating(spark):
    d = Domain(spark, SF_SMALL)
    plan = plan_of(gold.monthly_agg(d.silver, d.dim_item))
    top_join = plan.index("Join")
    first_agg = plan.index("HashAggregate")
    assert first_agg > top_join  # the aggregate sits below (inside) the attribute join
    # the wide title column is not part of any aggregation key
    for keys in re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", plan):
        assert "title" not in keys


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = plan_of(QUERIES["silver_feed"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all("l_extendedprice" not in s and "l_comment" not in s for s in lineitem)


def test_no_unbounded_broadcast_hint(spark):
    # only the limit(1) pair of point_lookup is hinted; every other broadcast
    # comes from the planner's size threshold
    for name in ("silver_feed", "fact_stage", "monthly_agg", "merge_upsert", "dq_report"):
        df = QUERIES[name](spark, SF_SMALL)
        logical = df._jdf.queryExecution().logical().toString()
        assert "broadcast" not in logical.lower(), name


def test_count_distinct_reuses_the_window_partitioning(spark):
    """Rows that the latest-wins window has dealt by (movie_id, user_id) are not dealt again for
    the distinct users of each month; the one shuffle more carries a row for each task and month."""
    d = Domain(spark, SF_SMALL)
    plan = plan_of(gold.monthly_agg(d.silver, d.dim_item))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert sum("rated_month" in e for e in exchanges) == 1
    assert not any("_key" in e for e in exchanges)


RATING_SHUFFLE = r"Exchange hashpartitioning\(movie_id#\d+L, user_id"


def test_time_travel_prunes_its_scan_and_calls_one_window(spark):
    plan = plan_of(QUERIES["snapshot_as_of"](spark, SF_SMALL))
    assert "LessThan(l_shipdate,1999-01-01" in plan
    assert len(re.findall(RATING_SHUFFLE, plan)) == 1


def test_merges_compute_each_operand_once_and_shuffle_it_once(spark):
    for name in ("merge_upsert", "merge_guarded", "merge_update_only"):
        plan = plan_of(QUERIES[name](spark, SF_SMALL))
        assert len(re.findall(RATING_SHUFFLE, plan)) == 2, name  # the two operands' windows, no more
        assert "GreaterThanOrEqual(l_shipdate" in plan, name
    # no window above the join of a guarded merge
    guarded = plan_of(QUERIES["merge_guarded"](spark, SF_SMALL))
    assert guarded.index("Join") < guarded.index("Window")


def test_point_lookup_filters_keys_below_the_window(spark):
    plan = plan_of(QUERIES["point_lookup"](spark, SF_SMALL))
    assert plan.index("Window") < plan.index("LeftSemi")


def test_history_and_diff_shuffle_the_rows_once(spark):
    for name in ("version_history", "version_diff", "fact_not_in_stage"):
        plan = plan_of(QUERIES[name](spark, SF_SMALL))
        assert len(re.findall(RATING_SHUFFLE, plan)) == 1, name


def scans(plan: str, prefix: str) -> int:
    return len(re.findall(r"FileScan parquet \[[^\]]*" + prefix, plan))


def test_rejected_rows_come_from_one_reading_of_the_input(spark):
    """Feed and the corrections derived from it: two scans, with rows of NULL keys and without."""
    for name in ("latest_wins", "validity_flag", "quarantine_invalid", "quarantine_all", "ref_integrity_semi", "dq_quarantine_kept"):
        plan = plan_of(QUERIES[name](spark, SF_SMALL))
        assert scans(plan, "l_") == 2, name
        assert plan.count("WindowGroupLimit") == 2 and len(re.findall(RATING_SHUFFLE, plan)) == 1, name


def test_two_states_come_from_one_grouped_pass(spark):
    for name, parts in (("dq_report", 1), ("reconcile_counts", 1), ("monthly_agg", 1), ("fact_merged", 1), ("point_before_after", 0)):
        plan = plan_of(QUERIES[name](spark, SF_SMALL))
        assert scans(plan, "l_") == 2 and scans(plan, "p_") == parts, name
        assert len(re.findall(RATING_SHUFFLE, plan)) == 1, name
    assert len(re.findall("Exchange hashpartitioning", plan_of(QUERIES["monthly_agg"](spark, SF_SMALL)))) <= 4
    assert len(re.findall("Exchange hashpartitioning", plan_of(QUERIES["dq_report"](spark, SF_SMALL)))) <= 2


def test_new_batches_are_chosen_by_partition_filters(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    for batch in ("01", "1", "02"):
        wh.land(fixtures.feed_text(spark, SF_SMALL, batch), layers.BRONZE_RATINGS)
    plan = plan_of(layers.rows_of(wh.read_landed(layers.BRONZE_RATINGS), ["01", "02"]))
    assert re.search(r"PartitionFilters: \[[^\]]*_ingest_batch#\d+ IN \(01,02\)", plan)
