"""Domain views over the driver's test tables.

The rating feed, its late corrections and the item catalogue are derived from
``lineitem`` and ``part`` by a fixed mapping, so every query's work grows with
those tables:

* feed.user_id = l_suppkey, feed.movie_id = l_partkey,
  feed.rating = l_quantity / 10.0, feed.event_ts = l_shipdate;
  (l_orderkey, l_linenumber) locate the record in its source.
* catalogue = all part rows; title = "<p_name> (<1950+p_size>)";
  genres = p_name with blanks as '|', or the no-genre sentinel for ECONOMY parts.
* corrections: the Spark job in ``plans.corrections`` (seeded hash sample).

Bronze holds text: every value rendered as a string, timestamps as
epoch-seconds text, plus provenance columns.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import ts_to_epoch_seconds
from .ingest import stamp_provenance
from .tables import read_table

# Deterministic batch id and clock for the registered queries; a production
# run passes its own (see ``sources.ingest.batch_id_now``).
FIXTURE_BATCH = "20240115T000000Z"
FIXTURE_CLOCK = "2024-01-15 00:00:00"
CATALOGUE_YEAR_BASE = 1950
NO_GENRE_TYPE = "ECONOMY"


def feed_typed(spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """The primary rating feed as typed rows (user_id, movie_id, rating, event_ts), with
    event times in [since, until) where given: literals, so that the scan skips row groups."""
    li = read_table(spark, sf_dir, "lineitem")
    if since is not None:
        li = li.filter(F.col("l_shipdate") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        li = li.filter(F.col("l_shipdate") < F.lit(until).cast("timestamp_ntz"))
    return li.select(
        F.col("l_suppkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        (F.col("l_quantity") / 10.0).alias("rating"),
        F.col("l_shipdate").alias("event_ts"),
        F.col("l_orderkey").alias("_source_key"),
        F.col("l_linenumber").alias("_source_line"),
    )


def typed_ratings(spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Feed and corrections as ``silver.typed_ratings`` has them, with event times in
    [since, until), without the way through text.  Corrections come 10 or 20 years after the
    record they re-issue, so the bounds, moved back, prune their scan as well."""
    from ..plans.corrections import OUT_OF_RANGE_SHIFT_DAYS, RERATE_SHIFT_DAYS, generate_corrections

    def back(day: str | None, days: int) -> str | None:
        return None if day is None else str(dt.date.fromisoformat(day) - dt.timedelta(days=days))

    feed = feed_typed(spark, sf_dir, since, until)
    origin = feed_typed(spark, sf_dir, back(since, OUT_OF_RANGE_SHIFT_DAYS), back(until, RERATE_SHIFT_DAYS))
    corrections = generate_corrections(origin).drop("kind")
    for bound, keep in ((since, F.col("event_ts").__ge__), (until, F.col("event_ts").__lt__)):
        if bound is not None:
            corrections = corrections.filter(keep(F.lit(bound).cast("timestamp_ntz")))
    tagged = []
    for rows, source, file, role in (
        (feed, config.SOURCE_PRIMARY, "lineitem.parquet", config.ROLE_PRIMARY),
        (corrections, config.SOURCE_CORRECTION, "rating_corrections", config.ROLE_CORRECTIONS),
    ):
        stamped = stamp_provenance(rows, source_file=file, role=role, batch_id=FIXTURE_BATCH, clock=FIXTURE_CLOCK)
        tagged.append(
            stamped.withColumn("rating_source", F.lit(source)).select("user_id", "movie_id", "rating", "event_ts", "rating_source", *config.PROVENANCE)
        )
    return tagged[0].unionByName(tagged[1])


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed rendered as lines of CSV text and parsed as text columns (S1).  Lines whose
    order key ends in 7 lack their last field, in 8 have one too many, in 9 an unclosed
    quote; such lines stay, with the whole line in ``_corrupt``."""
    feed = feed_typed(spark, sf_dir)
    last = F.col("_source_key") % 10
    fields = [F.col(c).cast("string") for c in ("user_id", "movie_id", "rating")]
    when = ts_to_epoch_seconds("event_ts").cast("string")
    line = (
        F.when(last == 7, F.concat_ws(",", *fields))
        .when(last == 8, F.concat_ws(",", *fields, when, F.lit("extra")))
        .when(last == 9, F.concat_ws(",", F.concat(F.lit('"'), fields[0]), *fields[1:], when))
        .otherwise(F.concat_ws(",", *fields, when))
    )
    schema = "userId string, movieId string, rating string, timestamp string, _corrupt string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    rows = feed.select("_source_key", "_source_line", line.alias("line"))
    return rows.select("_source_key", "_source_line", F.from_csv("line", schema, options).alias("r")).select("_source_key", "_source_line", "r.*")


CSV_HEADER = "userId,movieId,rating,timestamp"
CSV_FOLDERS = ("plain", "breaks", "swapped")


def write_csv_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The feed as CSV files with headers (S1), in folders by the order key's last digit: ``breaks`` (9)
    holds ratings with a quoted line break, ``swapped`` (5) has its first two columns the other way
    round, ``plain`` all others, of which 6 is quoted, 7 lacks its last field and 8 has one too many."""
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    feed = feed_typed(spark, sf_dir)
    last = F.col("_source_key") % 10
    u, m, r = (F.col(c).cast("string") for c in ("user_id", "movie_id", "rating"))
    t = ts_to_epoch_seconds("event_ts").cast("string")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    line = (
        F.when(last == 5, F.concat_ws(",", m, u, r, t))
        .when(last == 6, F.concat_ws(",", quoted(u), quoted(m), quoted(r), t))
        .when(last == 7, F.concat_ws(",", u, m, r))
        .when(last == 8, F.concat_ws(",", u, m, r, t, F.lit("extra")))
        .when(last == 9, F.concat_ws(",", u, m, quoted(F.concat(r, F.lit("\nstars"))), t))
        .otherwise(F.concat_ws(",", u, m, r, t))
    )
    folder = F.when(last == 9, "breaks").when(last == 5, "swapped").otherwise("plain")
    part = F.pmod(F.xxhash64("_source_key", "_source_line"), F.lit(files))
    rows = feed.select(folder.alias("folder"), part.alias("part"), F.lit(1).alias("place"), line.alias("line"))
    swapped = ",".join([*reversed(CSV_HEADER.split(",")[:2]), *CSV_HEADER.split(",")[2:]])
    headers = spark.range(files).select(F.explode(F.array(*map(F.lit, CSV_FOLDERS))).alias("folder"), F.col("id").alias("part"), F.lit(0).alias("place"))
    headers = headers.withColumn("line", F.when(F.col("folder") == "swapped", swapped).otherwise(CSV_HEADER))
    # one file for each folder and part, its header first
    dealt = rows.unionByName(headers).repartition("folder", "part").sortWithinPartitions("folder", "part", "place")
    dealt.drop("place").write.partitionBy("folder", "part").text(path)


def ratings_as_text(typed: DataFrame) -> DataFrame:
    """Render typed rating rows in the raw text layout of the source files."""
    return typed.select(
        F.col("user_id").cast("string").alias("userId"),
        F.col("movie_id").cast("string").alias("movieId"),
        F.col("rating").cast("string").alias("rating"),
        ts_to_epoch_seconds("event_ts").cast("string").alias("timestamp"),
        "_source_key",
        "_source_line",
    )


def feed_text(
    spark: SparkSession,
    sf_dir: str,
    batch_id: str = FIXTURE_BATCH,
    clock: str = FIXTURE_CLOCK,
) -> DataFrame:
    """Bronze rows of the primary feed: text values + provenance."""
    return stamp_provenance(
        ratings_as_text(feed_typed(spark, sf_dir)),
        source_file="lineitem.parquet",
        role=config.ROLE_PRIMARY,
        batch_id=batch_id,
        clock=clock,
    )


def corrections_text(
    spark: SparkSession,
    sf_dir: str,
    batch_id: str = FIXTURE_BATCH,
    clock: str = FIXTURE_CLOCK,
) -> DataFrame:
    """Bronze rows of the correction batch generated from the feed."""
    from ..plans.corrections import generate_corrections

    corr = generate_corrections(feed_typed(spark, sf_dir))
    return stamp_provenance(
        ratings_as_text(corr),
        source_file="rating_corrections",
        role=config.ROLE_CORRECTIONS,
        batch_id=batch_id,
        clock=clock,
    )


def catalogue_text(
    spark: SparkSession,
    sf_dir: str,
    batch_id: str = FIXTURE_BATCH,
    clock: str = FIXTURE_CLOCK,
) -> DataFrame:
    """Bronze rows of the item catalogue: movieId, title, genres as text."""
    part = read_table(spark, sf_dir, "part")
    text = part.select(
        F.col("p_partkey").cast("string").alias("movieId"),
        F.concat(
            F.trim("p_name"),
            F.lit(" ("),
            (F.col("p_size") + CATALOGUE_YEAR_BASE).cast("string"),
            F.lit(")"),
        ).alias("title"),
        F.when(F.col("p_type") == NO_GENRE_TYPE, F.lit(config.GENRE_SENTINEL))
        .otherwise(F.regexp_replace("p_name", " ", "|"))
        .alias("genres"),
        F.col("p_partkey").alias("_source_key"),
        F.lit(0).alias("_source_line"),
    )
    return stamp_provenance(
        text,
        source_file="part.parquet",
        role=config.ROLE_PRIMARY,
        batch_id=batch_id,
        clock=clock,
    )
