"""MERGE operators, changelog tables, time travel, history and diffs."""

import pytest
from pyspark.sql import functions as F

from layerworks.operators.merge import DuplicateSourceKeys, merge_update_only, merge_upsert
from layerworks.operators.versions import snapshot_as_of, version_diff, version_history

from .conftest import rows

PEOPLE = "id long, name string, amount long"


def people(spark, data):
    return spark.createDataFrame(data, PEOPLE)


def test_upsert_operator_matches_full_outer_semantics(spark):
    target = people(spark, [(1, "alice", 10), (2, "bob", 20), (3, "carol", 30)])
    source = people(spark, [(1, "alice", 999), (4, "dave", 40)])
    got = rows(merge_upsert(target, source, ["id"]))
    assert got == [(1, "alice", 999), (2, "bob", 20), (3, "carol", 30), (4, "dave", 40)]
    assert rows(merge_upsert(None, source, ["id"])) == rows(source)


def test_duplicate_source_keys_are_rejected(spark):
    target = people(spark, [(1, "alice", 10)])
    dup = people(spark, [(1, "a", 1), (1, "b", 2)])
    with pytest.raises(DuplicateSourceKeys):
        merge_upsert(target, dup, ["id"])


def test_guard_keeps_newer_target(spark):
    target = spark.createDataFrame([(1, 5.0, 200), (2, 3.0, 100)], "id long, v double, ts long")
    replay = spark.createDataFrame([(1, 1.0, 150), (2, 4.0, 100), (3, 2.0, 50)], "id long, v double, ts long")
    guarded = rows(merge_upsert(target, replay, ["id"], guard_col="ts"))
    assert guarded == [(1, 5.0, 200), (2, 4.0, 100), (3, 2.0, 50)]
    unguarded = rows(merge_upsert(target, replay, ["id"]))
    assert unguarded == [(1, 1.0, 150), (2, 4.0, 100), (3, 2.0, 50)]


def test_small_batch_forms_equal_the_full_join(spark):
    schema = "id long, v double, ts long"
    target = spark.createDataFrame([(1, 5.0, 200), (2, 3.0, None), (3, 1.0, 10), (None, 7.0, 1)], schema)
    batch = spark.createDataFrame([(1, 1.0, 150), (2, 4.0, 100), (3, 2.0, None), (9, 9.0, 9), (None, 8.0, 2)], schema)
    for guard in (None, "ts"):
        one = merge_upsert(target, batch, ["id"], guard_col=guard)
        two = merge_upsert(target, batch, ["id"], guard_col=guard, small_batch=True)
        assert rows(one) == rows(two)
        assert one.columns == target.columns


def test_update_only_ignores_unmatched(spark):
    target = people(spark, [(1, "alice", 10), (2, "bob", 20)])
    source = people(spark, [(2, "bob", 99), (7, "zed", 70)])
    assert rows(merge_update_only(target, source, ["id"])) == [(1, "alice", 10), (2, "bob", 99)]


def test_merge_fold_equals_sequential_merges(spark):
    """Newest version per key == folding every batch with merge_upsert."""
    batches = [
        [(1, "a", 1), (2, "b", 2)],
        [(2, "b", 20), (3, "c", 3)],
        [(1, "a", 100), (4, "d", 4)],
        [(3, "c", 300)],
    ]
    state = None
    changelog = None
    for v, b in enumerate(batches):
        df = people(spark, b)
        state = merge_upsert(state, df, ["id"])
        tagged = df.withColumn("version", F.lit(v))
        changelog = tagged if changelog is None else changelog.unionByName(tagged)
        snap = snapshot_as_of(changelog, ["id"], v).drop("version")
        assert rows(snap) == rows(state)
    # a later version does not change an earlier snapshot
    assert rows(snapshot_as_of(changelog, ["id"], 1).drop("version")) == [(1, "a", 1), (2, "b", 20), (3, "c", 3)]


def test_history_and_diff_operators(spark):
    changelog = spark.createDataFrame(
        [(1, 10.0, 0), (2, 20.0, 0), (1, 11.0, 1), (3, 30.0, 1), (2, 22.0, 2)], "id long, v double, version int"
    )
    hist = [tuple(r) for r in version_history(changelog, ["id"]).orderBy("version").collect()]
    assert hist == [(0, "WRITE", 2, 2, 0, 2), (1, "MERGE", 2, 1, 1, 3), (2, "MERGE", 1, 0, 1, 3)]
    diff = {r.id: (r.change, r.v_before, r.v_after) for r in version_diff(changelog, ["id"], 0, 1, "v").collect()}
    assert diff == {1: ("updated", 10.0, 11.0), 2: ("unchanged", 20.0, 20.0), 3: ("inserted", None, 30.0)}


def test_current_version_operator(spark):
    from layerworks.operators.versions import current_version

    changelog = spark.createDataFrame([(1, 0), (1, 3), (2, 2)], "id long, version int")
    assert current_version(changelog).first()[0] == 3
    assert current_version(changelog.limit(0)).first()[0] is None


def test_fused_snapshot_equals_changelog_snapshot(spark):
    from layerworks.plans.queries import KEYS, Domain

    d = Domain(spark, "/root/testdata/sf0.001")
    for n in (0, 3, 6, None):
        fused = d.snapshot(n)
        staged = snapshot_as_of(d.changelog, KEYS, n).select(*fused.columns)
        assert fused.exceptAll(staged).count() == 0 and staged.exceptAll(fused).count() == 0
