"""Native column expressions for conformance, validity, enrichment and keys."""

from .columns import (  # noqa: F401
    decade,
    epoch_seconds_to_ts,
    genres_array,
    invalid_rating,
    is_within_dates,
    item_key,
    mean_half_up,
    month_bucket,
    primary_genre,
    rating_tier,
    release_year,
    surrogate_key,
    to_double,
    to_int,
    to_long,
    ts_to_epoch_seconds,
    user_key,
)
