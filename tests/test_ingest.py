"""Bronze landing from CSV text: malformed lines, headers, optional sources."""

import os

import pytest

from layerworks import config
from layerworks.sources.ingest import SourceSpec, batch_id_now, ingest, read_csv_text
from layerworks.sources.tables import assert_same_schema, schema_report
from layerworks.sources.warehouse import Warehouse


def write(root, name, text):
    path = os.path.join(root, name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_short_long_and_quoted_lines_are_kept(spark, tmp_root):
    path = write(
        tmp_root,
        "ratings.csv",
        'userId,movieId,rating,timestamp\n1,10,4.0,964982703\n2,20\n3,30,1.0,964982703,extra\n"4",40,"3,5",964982703\n',
    )
    df = read_csv_text(spark, path, config.RATINGS_TEXT_DDL).collect()
    assert len(df) == 4
    by_user = {r.userId: r for r in df}
    assert by_user["1"]._corrupt_record is None
    assert by_user["2"].rating is None and by_user["2"]._corrupt_record == "2,20"
    assert by_user["3"]._corrupt_record == "3,30,1.0,964982703,extra"
    assert by_user["4"].rating == "3,5"  # quoted comma is one value, bad as a number later


def test_swapped_header_fails_instead_of_loading_swapped(spark, tmp_root):
    path = write(tmp_root, "swapped.csv", "movieId,userId,rating,timestamp\n10,1,4.0,964982703\n")
    with pytest.raises(Exception) as info:
        read_csv_text(spark, path, config.RATINGS_TEXT_DDL).collect()
    assert "FAILED_READ_FILE" in str(info.value) or "header" in str(info.value).lower()


def test_optional_source_may_be_missing(spark, tmp_root):
    spec = SourceSpec("corrections", os.path.join(tmp_root, "nope.csv"), config.RATINGS_TEXT_DDL, optional=True)
    assert ingest(spark, spec, "b1", "2024-01-15 00:00:00") is None
    with pytest.raises(Exception):
        ingest(spark, SourceSpec("r", os.path.join(tmp_root, "nope.csv"), config.RATINGS_TEXT_DDL), "b1")


def test_provenance_and_idempotent_landing(spark, tmp_root):
    path = write(tmp_root, "ratings.csv", "userId,movieId,rating,timestamp\n1,10,4.0,964982703\n2,20,3.0,964982703\n")
    wh = Warehouse(spark, tmp_root)
    df = ingest(spark, SourceSpec("ratings", path, config.RATINGS_TEXT_DDL), "b1", "2024-01-15 00:00:00")
    row = df.collect()[0]
    assert row._source_file == "ratings.csv" and row._source_role == "primary" and row._ingest_batch == "b1"
    wh.land(df, "bronze")
    wh.land(df, "bronze")  # same batch again: replaced, not duplicated
    assert wh.read_landed("bronze").count() == 2
    wh.land(ingest(spark, SourceSpec("ratings", path, config.RATINGS_TEXT_DDL), "b2", "2024-01-16 00:00:00"), "bronze")
    assert wh.read_landed("bronze").count() == 4


def test_batch_id_format():
    import datetime as dt

    assert batch_id_now(dt.datetime(2024, 1, 15, 1, 2, 3, tzinfo=dt.timezone.utc)) == "20240115T010203Z"


def test_schema_enforcement_and_report(spark):
    a = spark.createDataFrame([(1, "x")], "id long, name string")
    b = spark.createDataFrame([(1, "x", 3)], "id long, name string, extra int")
    assert_same_schema(a, a.schema)
    with pytest.raises(ValueError):
        assert_same_schema(b, a.schema)
    c = spark.createDataFrame([(1, None, 3), (2, "y", None), (3, None, None)], "id long, name string, extra int")
    rep = [tuple(r) for r in schema_report(c).collect()]
    assert rep == [(1, "id", "bigint", 0), (2, "name", "string", 2), (3, "extra", "int", 2)]
