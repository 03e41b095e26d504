"""Fixed values and defaults in one place.

The values under "fixed values" must stay as they are for results to match the
layered-table semantics this package reproduces (bounds, reason texts, key
salts, sentinel, tier edges, date window).
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
RATING_MIN = 0.5
RATING_MAX = 5.0
TIER_HIGH_FROM = 4.5
TIER_MEDIUM_FROM = 3.0
TIER_HIGH = "high"
TIER_MEDIUM = "medium"
TIER_LOW = "low"
MONTH_FORMAT = "yyyy-MM"
GENRE_SENTINEL = "(no genres listed)"
GENRE_SENTINEL_REPLACEMENT = "Unknown"
GENRE_DELIMITER_REGEX = "\\|"
YEAR_AT_END_REGEX = r"\((\d{4})\)\s*$"
ITEM_KEY_SALT = "movie|"
USER_KEY_SALT = "user|"
SOURCE_PRIMARY = "primary"
SOURCE_CORRECTION = "correction"
ROLE_PRIMARY = "primary"
ROLE_CORRECTIONS = "corrections"
REASON_INVALID = "rating outside [0.5, 5.0], or null user_id/movie_id/rating"
REASON_ORPHAN = "movie_id not present in the movie catalogue"
SANE_DATE_FROM = "1990-01-01"
SANE_DATE_UNTIL = "2030-01-01"
BATCH_ID_FORMAT = "%Y%m%dT%H%M%SZ"
CORRECTION_SEED = "20240115"
UNKNOWN_ITEM_ID = 99999999
CORRECTED_LOW = 5.0
CORRECTED_HIGH = 1.0
CORRECTION_SPLIT = 4.0
UNKNOWN_ITEM_RATING = 4.0
OUT_OF_RANGE_RATING = 9.9
# --- end of fixed values ----------------------------------------------------

# Raw text schemas: every column lands as a string (bronze keeps evidence).
RATINGS_TEXT_DDL = "userId string, movieId string, rating string, timestamp string"
ITEMS_TEXT_DDL = "movieId string, title string, genres string"

# Grain keys.
FEED_KEYS = ("user_id", "movie_id")
FACT_KEYS = ("user_key", "movie_key")

# Provenance columns stamped on every landed row.  ``_source_key`` and
# ``_source_line`` locate the record inside its source and make every
# "latest wins" ordering total.
PROVENANCE = (
    "_source_file",
    "_source_role",
    "_ingest_batch",
    "_ingested_at",
    "_source_key",
    "_source_line",
)
