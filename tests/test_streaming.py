"""Incremental landing: available-now file stream into bronze, exactly once per file."""

import os

from layerworks import config
from layerworks.sources.warehouse import Warehouse
from layerworks.streaming.landing import land_stream


def test_available_now_lands_each_file_once(spark, tmp_root):
    inbox = os.path.join(tmp_root, "inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "part-1.csv"), "w") as fh:
        fh.write("userId,movieId,rating,timestamp\n1,10,4.0,964982703\n2,10,3.0,964982703\n")
    wh = Warehouse(spark, os.path.join(tmp_root, "wh"))
    ckpt = os.path.join(tmp_root, "ckpt")

    def run():
        q = land_stream(spark, inbox, config.RATINGS_TEXT_DDL, wh, "bronze_ratings", "primary", ckpt, clock="2024-01-15 00:00:00")
        q.awaitTermination(120)

    run()
    landed = wh.read_landed("bronze_ratings")
    assert landed.count() == 2
    assert {r._source_file for r in landed.collect()} == {"part-1.csv"}
    run()  # nothing new: nothing landed twice
    assert wh.read_landed("bronze_ratings").count() == 2
    with open(os.path.join(inbox, "part-2.csv"), "w") as fh:
        fh.write("userId,movieId,rating,timestamp\n3,10,5.0,964982704\n")
    run()
    landed = wh.read_landed("bronze_ratings")
    assert landed.count() == 3
    assert landed.select("_ingest_batch").distinct().count() == 2


def test_two_folders_and_a_reset_checkpoint_never_share_a_batch(spark, tmp_root):
    wh = Warehouse(spark, os.path.join(tmp_root, "wh"))

    def land(folder, n, checkpoint):
        inbox = os.path.join(tmp_root, folder)
        os.makedirs(inbox, exist_ok=True)
        with open(os.path.join(inbox, "part.csv"), "w") as fh:
            fh.write("userId,movieId,rating,timestamp\n" + "".join(f"{i},10,4.0,964982703\n" for i in range(n)))
        q = land_stream(spark, inbox, config.RATINGS_TEXT_DDL, wh, "t", "primary", os.path.join(tmp_root, checkpoint), clock="2024-01-15 00:00:00")
        q.awaitTermination(120)

    land("a", 10, "ckpt-a")
    land("b", 3, "ckpt-b")
    assert wh.read_landed("t").count() == 13
    land("a", 10, "ckpt-c")  # a new checkpoint reads the folder again: rows are added, none replaced
    assert wh.read_landed("t").count() == 23
