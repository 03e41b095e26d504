"""Column expressions: every scalar rule of the layers as a native Column.

All of these stay inside whole-stage codegen (no Python per row).  Text is
converted with ``try_*`` forms so dirty values become NULL under ANSI mode
instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- conformance (P3, P4) -----------------------------------------------------


def to_long(text: Column | str) -> Column:
    """Text -> BIGINT; unparseable text (``abc``, ``1,00``, ``12.7``) -> NULL."""
    return col(text).try_cast("bigint")


def to_double(text: Column | str) -> Column:
    """Text -> DOUBLE; unparseable text -> NULL (``NaN`` parses to NaN)."""
    return col(text).try_cast("double")


def to_int(text: Column | str) -> Column:
    return col(text).try_cast("int")


# 0001-01-01 00:00:00 and 9999-12-31 23:59:59
EPOCH_RANGE = (-62_135_596_800, 253_402_300_799)


def epoch_seconds_to_ts(text: Column | str) -> Column:
    """Epoch-seconds text -> wall-clock UTC timestamp (TIMESTAMP_NTZ).

    Two steps on purpose: text -> integer seconds -> timestamp.  Parsing the
    text directly as a timestamp literal yields NULL for every epoch value.
    NULL outside the years 1 to 9999: an epoch in milli-, micro- or nanoseconds
    must neither end the job nor pass for a date.
    """
    seconds = to_long(text)
    return F.when(seconds.between(*EPOCH_RANGE), F.timestamp_seconds(seconds)).cast("timestamp_ntz")


def ts_to_epoch_seconds(ts: Column | str) -> Column:
    """Wall-clock UTC timestamp (NTZ or LTZ) -> epoch seconds (BIGINT)."""
    return F.unix_seconds(col(ts).cast("timestamp"))


# --- validity (P6) ------------------------------------------------------------


def invalid_rating(
    user_id: Column | str = "user_id",
    item_id: Column | str = "movie_id",
    rating: Column | str = "rating",
    low: float = config.RATING_MIN,
    high: float = config.RATING_MAX,
) -> Column:
    """True when a key or the rating is NULL or the rating is outside [low, high].

    Bounds are valid (inclusive).  NaN compares greater than every number, so a
    NaN rating is invalid.  The coalesce makes the flag total: it is never NULL.
    """
    r = col(rating)
    return F.coalesce(
        col(user_id).isNull() | col(item_id).isNull() | r.isNull() | (r < low) | (r > high),
        F.lit(True),
    )


# --- enrichment (P8, P9, P10, P12) --------------------------------------------


def rating_tier(rating: Column | str = "rating") -> Column:
    r = col(rating)
    return (
        F.when(r >= config.TIER_HIGH_FROM, F.lit(config.TIER_HIGH))
        .when(r >= config.TIER_MEDIUM_FROM, F.lit(config.TIER_MEDIUM))
        .otherwise(F.lit(config.TIER_LOW))
    )


def month_bucket(ts: Column | str = "event_ts") -> Column:
    return F.date_format(col(ts), config.MONTH_FORMAT)


def decade(year: Column | str = "release_year") -> Column:
    """Truncating decade: 1999 -> 1990; NULL stays NULL."""
    return (col(year) / 10).cast("int") * 10


def genres_array(raw: Column | str = "genres_raw") -> Column:
    """Delimited genre text -> array, sentinel -> ['Unknown'], empty tokens removed."""
    r = col(raw)
    replaced = F.when(r == config.GENRE_SENTINEL, F.lit(config.GENRE_SENTINEL_REPLACEMENT)).otherwise(r)
    return F.array_remove(F.split(replaced, config.GENRE_DELIMITER_REGEX), "")


def primary_genre(genres: Column | str = "genres") -> Column:
    """First genre, NULL for an empty or NULL array."""
    return F.try_element_at(col(genres), F.lit(1))


def release_year(title: Column | str = "title") -> Column:
    """Four digits in parentheses at the very end of the (trimmed) title."""
    return F.regexp_extract(F.trim(col(title)), config.YEAR_AT_END_REGEX, 1).try_cast("int")


# --- keys (surrogate_key) -------------------------------------------------------


def surrogate_key(natural_key: Column | str, salt: str) -> Column:
    """32-hex md5 of ``salt || natural_key``; a NULL natural key gives NULL."""
    return F.md5(F.concat(F.lit(salt), col(natural_key).cast("string")))


def item_key(item_id: Column | str = "movie_id") -> Column:
    return surrogate_key(item_id, config.ITEM_KEY_SALT)


def user_key(user_id: Column | str = "user_id") -> Column:
    return surrogate_key(user_id, config.USER_KEY_SALT)


# --- exact rounded mean (T30) -------------------------------------------------


def mean_half_up(value: Column | str, digits: int = 9, out_digits: int = 3) -> Column:
    """Mean rounded half-up to ``out_digits`` places, exactly and order-free.

    Values are taken as decimals of ``digits`` places, so the sum is exact in any order; the
    mean is one ratio of integers, rounded once: ``floor((2 * t * 10**out + n * 10**digits) /
    (2 * n * 10**digits))`` with ``t`` the sum in units of the last place and ``n`` the
    non-NULL count.  For values of at most 10**10 and 10**13 rows.  Non-negative values only.
    Aggregate expression; use inside ``agg``.
    """
    v = col(value)
    unit = F.lit(10**digits).cast(f"decimal({digits + 1},0)")
    places = (v.cast(f"decimal({digits + 11},{digits})") * unit).cast(f"decimal({digits + 11},0)")
    total = F.sum(places).cast("decimal(33,0)")
    n = F.count(v).cast("decimal(14,0)")
    ratio_top = (total * F.lit(2 * 10**out_digits).cast("decimal(4,0)") + n * unit).cast("decimal(38,0)")
    ratio_bottom = (n * F.lit(2 * 10**digits).cast(f"decimal({digits + 1},0)")).cast("decimal(38,0)")
    # taking off the remainder first leaves a quotient without a fraction
    whole = ((ratio_top - ratio_top % ratio_bottom) / ratio_bottom).cast("bigint")
    return F.when(F.count(v) > 0, whole.cast("double") / (10**out_digits))


def is_within_dates(ts: Column | str, start: str, until: str) -> Column:
    """``start <= date(ts) < until`` (half-open, date granularity)."""
    d = F.to_date(col(ts))
    return (d >= F.lit(start).cast("date")) & (d < F.lit(until).cast("date"))
