"""Deterministic late-correction batch, generated on Spark.

A seeded sample of feed records is re-issued later in time:

* re-ratings: a sampled record re-rated (below the split -> top value, else
  bottom value), dated ``shift_days`` later, so latest-wins must pick it;
* unknown item: the first slice of the sample re-issued for a movie_id that is
  not in any catalogue, so referential integrity has something to catch;
* out of range: the first slice again with an impossible rating dated even
  later, so it masks the re-rating and validity has something to catch.

The sample is a hash threshold: the first 8 hex digits of
``md5(seed|source_key|source_line)`` compared with a fraction of 2**32.  It
is reproducible everywhere md5 exists, needs no ordering, no driver state and
no global sort, and the three slices are nested prefixes of one random order
(as in "the first n of a seeded shuffle").  Rows are sampled, never capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config

RERATE_FRACTION = 0.02
UNKNOWN_ITEM_FRACTION = 0.002
OUT_OF_RANGE_FRACTION = 0.001
RERATE_SHIFT_DAYS = 3650
OUT_OF_RANGE_SHIFT_DAYS = 7300


def in_sample(hash_prefix, fraction: float):
    """Whether an 8-hex-digit prefix falls in the first ``fraction`` of all prefixes;
    a fraction of 1 keeps every row."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    if fraction == 1.0:
        return F.lit(True)
    return hash_prefix < format(int(fraction * 2**32), "08x")


def sample_hash(seed: str = config.CORRECTION_SEED):
    return F.substring(
        F.md5(
            F.concat_ws(
                "|",
                F.lit(seed),
                F.col("_source_key").cast("string"),
                F.col("_source_line").cast("string"),
            )
        ),
        1,
        8,
    )


def generate_corrections(
    feed: DataFrame,
    seed: str = config.CORRECTION_SEED,
    rerate_fraction: float = RERATE_FRACTION,
    unknown_fraction: float = UNKNOWN_ITEM_FRACTION,
    out_of_range_fraction: float = OUT_OF_RANGE_FRACTION,
) -> DataFrame:
    """Typed correction rows (user_id, movie_id, rating, event_ts, kind, position).

    ``feed`` must have user_id, movie_id, rating, event_ts, _source_key,
    _source_line.  One scan of the feed; the three kinds are one ``explode``
    of the matching slices (NULL slots dropped), so no branch re-reads the
    input and every expression stays inside whole-stage codegen.
    """
    h = sample_hash(seed)
    rerate = F.struct(
        F.lit("re_rating").alias("kind"),
        F.col("movie_id").alias("movie_id"),
        F.when(F.col("rating") < config.CORRECTION_SPLIT, F.lit(config.CORRECTED_LOW))
        .otherwise(F.lit(config.CORRECTED_HIGH))
        .alias("rating"),
        F.lit(RERATE_SHIFT_DAYS).alias("shift"),
    )
    unknown = F.struct(
        F.lit("unknown_item").alias("kind"),
        F.lit(config.UNKNOWN_ITEM_ID).cast("bigint").alias("movie_id"),
        F.lit(config.UNKNOWN_ITEM_RATING).alias("rating"),
        F.lit(RERATE_SHIFT_DAYS).alias("shift"),
    )
    out_of_range = F.struct(
        F.lit("out_of_range").alias("kind"),
        F.col("movie_id").alias("movie_id"),
        F.lit(config.OUT_OF_RANGE_RATING).alias("rating"),
        F.lit(OUT_OF_RANGE_SHIFT_DAYS).alias("shift"),
    )
    widest = max(rerate_fraction, unknown_fraction, out_of_range_fraction)
    sampled = feed.withColumn("_h", h).filter(in_sample(F.col("_h"), widest))
    kinds = F.array(
        F.when(in_sample(F.col("_h"), rerate_fraction), rerate),
        F.when(in_sample(F.col("_h"), unknown_fraction), unknown),
        F.when(in_sample(F.col("_h"), out_of_range_fraction), out_of_range),
    )
    exploded = sampled.select(
        "user_id", "event_ts", "_source_key", "_source_line", F.explode(kinds).alias("c")
    ).filter(F.col("c").isNotNull())
    return exploded.select(
        "user_id",
        F.col("c.movie_id").alias("movie_id"),
        F.col("c.rating").alias("rating"),
        (F.col("event_ts") + F.make_dt_interval(days=F.col("c.shift"))).alias("event_ts"),
        F.col("c.kind").alias("kind"),
        "_source_key",
        "_source_line",
    )
