"""Gold: star schema, fact stage and the monthly serving aggregate.

Plan choices that matter at scale:

* Dimension joins carry no broadcast hints: the planner broadcasts a side only
  when its estimated size is under ``autoBroadcastJoinThreshold`` and AQE
  re-checks with real sizes, so a dimension that grows past the bound falls
  back to a shuffle join instead of exhausting executor memory.
* The user dimension is a GROUP BY of the same silver rows, so every silver
  user is in it and joining back only recomputes ``md5('user|' || id)``.  The
  fact stage derives that key directly and skips a full shuffle of the fact.
* The monthly aggregate groups the fact on (movie_key, rated_month) *before*
  attaching item attributes (title etc. depend on movie_key alone), so wide
  strings never go through the aggregation shuffle and the dimension is joined
  against the already reduced result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import decade, item_key, mean_half_up, user_key
from .silver import enrich, valid_state

# --- fixed values: columns of the tables, in order ----------------------------------
DIM_ITEM_COLUMNS = ["movie_key", "movie_natural_key", "title", "primary_genre", "genres", "release_year", "decade"]
DIM_USER_COLUMNS = ["user_key", "user_natural_key", "rating_count", "first_rating_at", "last_rating_at", "avg_rating_given"]
MONTHLY_COLUMNS = ["movie_key", "rated_month", "title", "primary_genre", "release_year", "rating_count", "avg_rating", "distinct_raters"]
FACT_COLUMNS = [
    "user_key",
    "movie_key",
    "rating",
    "rating_tier",
    "event_ts",
    "rated_month",
    "rating_source",
    "_source_role",
    "_ingest_batch",
]
# --- end of fixed values -----------------------------------------------------


def dim_item(catalogue: DataFrame) -> DataFrame:
    """Item dimension (Type 1) with a hashed surrogate key and decade."""
    keyed = catalogue.withColumns({"movie_key": item_key("movie_id"), "movie_natural_key": F.col("movie_id"), "decade": decade("release_year")})
    return keyed.select(*DIM_ITEM_COLUMNS)


def item_keys(ids: DataFrame) -> DataFrame:
    """(movie_key, movie_natural_key) for a set of ids: the part of the item
    dimension a fact join needs (the key is a function of the id alone)."""
    return ids.select(item_key("movie_id").alias("movie_key"), F.col("movie_id").alias("movie_natural_key"))


def dim_user(silver: DataFrame) -> DataFrame:
    """User dimension (Type 1) with lifetime stats; mean rounded exactly."""
    agg = silver.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("rating_count"),
        F.min("event_ts").alias("first_rating_at"),
        F.max("event_ts").alias("last_rating_at"),
        mean_half_up("rating").alias("avg_rating_given"),
    )
    return agg.withColumns({"user_key": user_key("user_id"), "user_natural_key": F.col("user_id")}).select(*DIM_USER_COLUMNS)


def attach_key(df: DataFrame, dim: DataFrame, fact_col: str, natural_col: str, key_col: str) -> DataFrame:
    """Inner join on ``df[fact_col] == dim[natural_col]`` bringing ``key_col``."""
    d = dim.select(key_col, natural_col)
    return df.join(d, df[fact_col] == d[natural_col], "inner").drop(natural_col)


def merged_states(states: DataFrame) -> DataFrame:
    """Rows of a fact that held the feed's state when all records' state was upserted into it,
    from ``silver.keyed_states``: the row of now if it is valid, else that of before if that one
    is.  The fact's keys are functions of the natural ones, so merging on these gives the same rows.  Items
    that are not catalogued are still among them."""
    row = F.when(valid_state("now"), F.col("now")).otherwise(F.col("before"))
    held = states.filter(valid_state("now") | valid_state("before")).withColumn("_row", row)
    return enrich(held.select("movie_id", "user_id", "_row.*"))


def fact_keys() -> dict[str, Column]:
    """The fact's keys as functions of the natural ones: 32 letters each, which a stored merge derives
    as it writes rather than have them cross its shuffles."""
    return {"user_key": user_key("user_id"), "movie_key": item_key("movie_id")}


def fact_stage(
    silver: DataFrame, items: DataFrame | None = None, users: DataFrame | None = None, keep_natural: bool = False
) -> DataFrame:
    """Silver rows keyed for the fact (grain: user_key x movie_key).

    ``items`` and ``users`` are joined (inner) only when given.  By default both keys are
    derived, which is exact for routed silver: its rows have passed the catalogue probe, and
    the user dimension is built from them.  ``keep_natural`` adds movie_id and user_id.
    """
    if items is None:
        staged = silver.filter(F.col("movie_id").isNotNull()).withColumn("movie_key", item_key("movie_id"))
    else:
        staged = attach_key(silver, items, "movie_id", "movie_natural_key", "movie_key")
    if users is None:
        staged = staged.filter(F.col("user_id").isNotNull()).withColumn("user_key", user_key("user_id"))
    else:
        staged = attach_key(staged, users, "user_id", "user_natural_key", "user_key")
    return staged.select(*FACT_COLUMNS, *(["movie_id", "user_id"] if keep_natural else []))


def monthly_agg(fact: DataFrame, items: DataFrame) -> DataFrame:
    """One row per (movie, month) with count, exact mean, distinct raters.

    ``fact`` holds movie_key and user_key, or the natural movie_id and user_id in their place:
    8-byte ids then cross the shuffles, and keys come from the dimension afterwards."""
    natural = "movie_id" in fact.columns
    movie, user = ("movie_id", "user_id") if natural else ("movie_key", "user_key")
    per_month = fact.groupBy(movie, "rated_month").agg(
        F.count(F.lit(1)).alias("rating_count"),
        mean_half_up("rating").alias("avg_rating"),
        F.countDistinct(user).alias("distinct_raters"),
    )
    attrs = items.select("movie_key", F.col("movie_natural_key").alias("movie_id"), "title", "primary_genre", "release_year")
    return per_month.join(attrs, movie, "inner").select(*MONTHLY_COLUMNS)
