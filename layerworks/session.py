"""Session factory.

One place sets the settings every job relies on: UTC session clock (all
timestamps are wall-clock UTC), AQE with partition coalescing and skew-join
splitting, a bounded automatic broadcast threshold (the planner's size check
decides what is broadcast; nothing is hinted blindly) and ANSI mode left on, so
dirty text goes through explicit ``try_*`` conversions.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that are part of the semantics or of the scale story.  Sizes are
# per-partition targets, so they hold from local[8] to a 1000-executor cluster.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    # The planner broadcasts a join side only when its estimated size is below
    # this bound; AQE re-checks with the real shuffle size at runtime.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    app_name: str = "layerworks",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session (checked for UTC) or build one."""
    active = SparkSession.getActiveSession()
    if active is not None:
        require_utc(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z"):
        raise RuntimeError(f"session time zone must be UTC, found {zone!r}")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.  Only a
    ``local`` session without that setting gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="layerworks-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def recommended_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 * 1024**2) -> dict[str, str]:
    """Scale-dependent settings for a cluster run over ``input_bytes``.

    Shuffle partitions start at about one per ``partition_bytes`` of input
    (at least 3 waves of the cores) so no reducer's share has to spill badly;
    AQE then coalesces small ones.  Scan splits stay at 256 MB.
    """
    shuffle = max(3 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
    }


def local_session(cores: int | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark on one machine."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    return get_session(
        "layerworks-local",
        master=f"local[{cores}]",
        shuffle_partitions=shuffle_partitions,
        extra_conf={"spark.driver.memory": "8g"},
    )
