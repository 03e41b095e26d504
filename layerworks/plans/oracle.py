"""Independent SQL statements of every registered query (DuckDB dialect).

Each statement is written from the semantics, not from the Spark plan: merges
are FULL/LEFT JOINs with COALESCE-by-presence, version state is "row of the
highest version per key", counts are ``count(*) FILTER``.  They read the same
parquet tables (``lineitem``, ``part``) through the same domain mapping.
"""

from __future__ import annotations

from .. import config
from ..sources import fixtures
from .queries import AS_OF_VERSION, FEED_LAST_VERSION, SECOND_BATCH, SECOND_CLOCK, VERSION_BASE_YEAR

BATCH = fixtures.FIXTURE_BATCH
CLOCK = fixtures.FIXTURE_CLOCK
LO, HI = config.RATING_MIN, config.RATING_MAX

INVALID = f"coalesce(user_id IS NULL OR movie_id IS NULL OR rating IS NULL OR rating < {LO} OR rating > {HI}, true)"

def _first(fraction: float) -> str:
    """The first ``fraction`` of all 8-digit hash prefixes, compared as numbers."""
    return f"CAST('0x' || h AS BIGINT) < {int(fraction * 2**32)}"


BASE = f"""
feed AS (
    SELECT l_suppkey AS user_id, l_partkey AS movie_id, l_quantity / 10.0 AS rating,
           l_shipdate AS event_ts, l_orderkey AS src_key, l_linenumber AS src_line
    FROM lineitem
),
sampled AS (
    SELECT *, substr(md5(concat_ws('|', '{config.CORRECTION_SEED}', CAST(src_key AS VARCHAR),
                                   CAST(src_line AS VARCHAR))), 1, 8) AS h
    FROM feed
),
corr AS (
    SELECT user_id, movie_id,
           CAST(CASE WHEN rating < {config.CORRECTION_SPLIT} THEN {config.CORRECTED_LOW} ELSE {config.CORRECTED_HIGH} END AS DOUBLE) AS rating,
           event_ts + INTERVAL 3650 DAY AS event_ts, 're_rating' AS kind, src_key, src_line
    FROM sampled WHERE {_first(0.02)}
    UNION ALL
    SELECT user_id, CAST({config.UNKNOWN_ITEM_ID} AS BIGINT), CAST({config.UNKNOWN_ITEM_RATING} AS DOUBLE),
           event_ts + INTERVAL 3650 DAY, 'unknown_item', src_key, src_line
    FROM sampled WHERE {_first(0.002)}
    UNION ALL
    SELECT user_id, movie_id, CAST({config.OUT_OF_RANGE_RATING} AS DOUBLE),
           event_ts + INTERVAL 7300 DAY, 'out_of_range', src_key, src_line
    FROM sampled WHERE {_first(0.001)}
),
ratings AS (
    SELECT user_id, movie_id, rating, event_ts, 'primary' AS rating_source, 'primary' AS source_role,
           'lineitem.parquet' AS source_file, src_key, src_line
    FROM feed
    UNION ALL
    SELECT user_id, movie_id, rating, event_ts, 'correction', 'corrections', 'rating_corrections', src_key, src_line
    FROM corr
),
latest AS (
    SELECT * FROM ratings
    QUALIFY row_number() OVER (PARTITION BY user_id, movie_id
                               ORDER BY event_ts DESC, src_key DESC, src_line DESC) = 1
),
items AS (
    SELECT p_partkey AS movie_id,
           trim(p_name) || ' (' || CAST(p_size + 1950 AS VARCHAR) || ')' AS title,
           CASE WHEN p_type = 'ECONOMY' THEN '{config.GENRE_SENTINEL}' ELSE replace(p_name, ' ', '|') END AS genres_raw
    FROM part
),
catalogue AS (
    SELECT movie_id, trim(title) AS title,
           list_filter(string_split(CASE WHEN genres_raw = '{config.GENRE_SENTINEL}' THEN 'Unknown'
                                         ELSE genres_raw END, '|'), lambda g: g <> '') AS genres,
           TRY_CAST(regexp_extract(trim(title), '\\((\\d{{4}})\\)\\s*$', 1) AS INTEGER) AS release_year
    FROM items
),
catalogue_full AS (
    SELECT *, genres[1] AS primary_genre FROM catalogue
),
flagged AS (
    SELECT *, {INVALID} AS is_invalid FROM latest
),
routed AS (
    SELECT f.*,
           CASE WHEN is_invalid THEN 'invalid'
                WHEN NOT EXISTS (SELECT 1 FROM catalogue c WHERE c.movie_id = f.movie_id) THEN 'orphan'
                ELSE 'clean' END AS route
    FROM flagged f
),
silver AS (
    SELECT user_id, movie_id, rating, event_ts, rating_source, source_role, source_file, src_key, src_line,
           CASE WHEN rating >= 4.5 THEN 'high' WHEN rating >= 3.0 THEN 'medium' ELSE 'low' END AS rating_tier,
           strftime(event_ts, '%Y-%m') AS rated_month
    FROM routed WHERE route = 'clean'
),
dim_item AS (
    SELECT md5('movie|' || CAST(movie_id AS VARCHAR)) AS movie_key, movie_id AS movie_natural_key, title,
           primary_genre, genres, release_year, CAST(floor(release_year / 10) AS INTEGER) * 10 AS decade
    FROM catalogue_full
),
before AS (
    SELECT user_id, movie_id, rating, event_ts, src_key, src_line, {INVALID} AS is_invalid FROM feed
    QUALIFY row_number() OVER (PARTITION BY user_id, movie_id ORDER BY event_ts DESC, src_key DESC, src_line DESC) = 1
),
held AS (
    SELECT user_id, movie_id, rating, event_ts, 'primary' AS rating_source, 'primary' AS source_role,
           CASE WHEN rating >= 4.5 THEN 'high' WHEN rating >= 3.0 THEN 'medium' ELSE 'low' END AS rating_tier,
           strftime(event_ts, '%Y-%m') AS rated_month
    FROM before WHERE NOT is_invalid AND movie_id IN (SELECT movie_id FROM catalogue)
),
merged AS (
    SELECT user_id, movie_id, rating, event_ts, rating_source, source_role, rating_tier, rated_month FROM silver
    UNION ALL
    SELECT user_id, movie_id, rating, event_ts, rating_source, source_role, rating_tier, rated_month FROM held h
    WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.user_id = h.user_id AND s.movie_id = h.movie_id)
),
fact_merged AS (
    SELECT md5('user|' || CAST(s.user_id AS VARCHAR)) AS user_key, d.movie_key, s.rating, s.rating_tier,
           s.event_ts, s.rated_month, s.rating_source, s.source_role AS _source_role, '{BATCH}' AS _ingest_batch
    FROM merged s JOIN dim_item d ON s.movie_id = d.movie_natural_key
),
fact AS (
    SELECT md5('user|' || CAST(s.user_id AS VARCHAR)) AS user_key, d.movie_key, s.rating, s.rating_tier,
           s.event_ts, s.rated_month, s.rating_source, s.source_role AS _source_role, '{BATCH}' AS _ingest_batch
    FROM silver s JOIN dim_item d ON s.movie_id = d.movie_natural_key
),
changelog AS (
    SELECT user_id, movie_id, rating, event_ts, rating_source,
           CAST(year(event_ts) - {VERSION_BASE_YEAR} AS INTEGER) AS version
    FROM ratings
    WHERE NOT {INVALID}
    QUALIFY row_number() OVER (PARTITION BY user_id, movie_id, year(event_ts)
                               ORDER BY event_ts DESC, src_key DESC, src_line DESC) = 1
)
"""


def _with(*extra: str) -> str:
    ctes = BASE.strip()
    if extra:
        ctes += ",\n" + ",\n".join(extra)
    return "WITH " + ctes + "\n"


def _snapshot(name: str, where: str) -> str:
    return (
        f"{name} AS (SELECT user_id, movie_id, rating, event_ts, rating_source, version FROM changelog "
        f"WHERE {where} QUALIFY row_number() OVER (PARTITION BY user_id, movie_id ORDER BY version DESC) = 1)"
    )


def _mean_half_up(col: str) -> str:
    """Exact: the values as DECIMAL, their sum in billionths, one integer division."""
    t = f"CAST(CAST(sum(CAST({col} AS DECIMAL(18, 9))) AS DECIMAL(38, 9)) * 1000000000 AS HUGEINT)"
    n = f"CAST(count({col}) AS HUGEINT)"
    return f"CAST(CAST(2000 * {t} + 1000000000 * {n} AS HUGEINT) // (2000000000 * {n}) AS DOUBLE) / 1000"


def _dq(name: str, layer: str, passes: str, expectation: str, observed_sql: str) -> str:
    return (
        f"SELECT '{name}' AS name, '{layer}' AS layer, coalesce(observed {passes}, false) AS passed, observed, "
        f"'{expectation}' AS expectation, true AS blocking FROM (SELECT CAST(({observed_sql}) AS BIGINT) AS observed)"
    )


DQ = {
    "dq_not_empty": ("silver_ratings_not_empty", "silver", "> 0", "at least one row", "SELECT count(*) FROM silver"),
    "dq_silver_grain": (
        "silver_ratings_grain_unique",
        "silver",
        "= 0",
        "every (user_id, movie_id) once",
        "SELECT count(*) FROM (SELECT user_id, movie_id FROM silver GROUP BY 1, 2 HAVING count(*) > 1)",
    ),
    "dq_in_range": (
        "ratings_in_range",
        "silver",
        "= 0",
        "all ratings within [0.5, 5.0]",
        "SELECT count(*) FROM silver WHERE rating < 0.5 OR rating > 5.0",
    ),
    "dq_not_null": (
        "ratings_not_null",
        "silver",
        "= 0",
        "no NULL among user_id, movie_id, rating",
        "SELECT count(*) FROM silver WHERE user_id IS NULL OR movie_id IS NULL OR rating IS NULL",
    ),
    "dq_event_ts_not_null": (
        "ratings_event_ts_not_null",
        "silver",
        "= 0",
        "no NULL event time",
        "SELECT count(*) FROM silver WHERE event_ts IS NULL",
    ),
    "dq_date_range": (
        "ratings_in_sane_date_range",
        "silver",
        "= 0",
        "event dates since 1990-01-01 and before 2030-01-01",
        "SELECT count(*) FROM silver WHERE event_ts < TIMESTAMP '1990-01-01' OR event_ts >= TIMESTAMP '2030-01-01'",
    ),
    "dq_fk_exists": (
        "fk_movie_exists",
        "silver",
        "= 0",
        "every movie_id is catalogued",
        "SELECT count(*) FROM silver r ANTI JOIN catalogue m ON r.movie_id = m.movie_id",
    ),
    "dq_quarantine_kept": (
        "quarantine_retained_bad_rows",
        "silver",
        "> 0",
        "rejected rows are kept",
        "SELECT count(*) FROM routed WHERE route <> 'clean'",
    ),
    "dq_fact_grain": (
        "gold_fact_grain_unique",
        "gold",
        "= 0",
        "every (user_key, movie_key) once",
        "SELECT count(*) FROM (SELECT user_key, movie_key FROM fact_merged GROUP BY 1, 2 HAVING count(*) > 1)",
    ),
    "dq_corrections_applied": (
        "corrections_applied",
        "gold",
        "> 0",
        "some rows come from corrections",
        "SELECT count(*) FROM fact_merged WHERE rating_source = 'correction'",
    ),
}

Q_COLS = "user_id, movie_id, rating, event_ts, rating_source"
QUARANTINED_AT = f"TIMESTAMP '{CLOCK}' AS quarantined_at"

SQL: dict[str, str] = {
    "bronze_as_text": _with()
    + f"""SELECT CAST(user_id AS VARCHAR) AS userId, CAST(movie_id AS VARCHAR) AS movieId,
       CAST(rating AS VARCHAR) AS rating, CAST(CAST(epoch(event_ts) AS BIGINT) AS VARCHAR) AS "timestamp",
       'lineitem.parquet' AS _source_file, 'primary' AS _source_role, '{BATCH}' AS _ingest_batch,
       TIMESTAMP '{CLOCK}' AS _ingested_at, src_key AS _source_key, src_line AS _source_line
FROM feed""",
    "bronze_stamp": _with()
    + f"""SELECT 'lineitem.parquet' AS _source_file, 'primary' AS _source_role, '{BATCH}' AS _ingest_batch,
       TIMESTAMP '{CLOCK}' AS _ingested_at, (SELECT count(*) FROM feed) AS row_count
UNION ALL SELECT 'rating_corrections', 'corrections', '{BATCH}', TIMESTAMP '{CLOCK}', (SELECT count(*) FROM corr)
UNION ALL SELECT 'part.parquet', 'primary', '{BATCH}', TIMESTAMP '{CLOCK}', (SELECT count(*) FROM items)""",
    "conform_types": _with()
    + "SELECT user_id, movie_id, rating, rating_source, src_key AS _source_key, src_line AS _source_line FROM ratings",
    "epoch_to_timestamp": _with()
    + """SELECT rating_source, src_key AS _source_key, src_line AS _source_line,
       CAST(CAST(epoch(event_ts) AS BIGINT) AS VARCHAR) AS event_ts_raw, event_ts FROM ratings""",
    "union_corrections": _with()
    + f"""SELECT CAST(user_id AS VARCHAR) AS user_id_raw, CAST(movie_id AS VARCHAR) AS movie_id_raw,
       CAST(rating AS VARCHAR) AS rating, CAST(CAST(epoch(event_ts) AS BIGINT) AS VARCHAR) AS event_ts_raw,
       source_file AS _source_file, source_role AS _source_role, '{BATCH}' AS _ingest_batch,
       src_key AS _source_key, src_line AS _source_line, rating_source
FROM ratings""",
    "corrections_generate": _with()
    + "SELECT user_id, movie_id, rating, event_ts, kind, src_key AS _source_key, src_line AS _source_line FROM corr",
    "latest_wins": _with()
    + f"SELECT {Q_COLS}, src_key AS _source_key, src_line AS _source_line FROM latest",
    "latest_valid_wins": _with()
    + f"""SELECT {Q_COLS}, src_key AS _source_key, src_line AS _source_line FROM ratings
WHERE NOT {INVALID}
QUALIFY row_number() OVER (PARTITION BY user_id, movie_id ORDER BY event_ts DESC, src_key DESC, src_line DESC) = 1""",
    "validity_flag": _with() + "SELECT user_id, movie_id, rating, is_invalid FROM flagged",
    "quarantine_invalid": _with()
    + f"SELECT {Q_COLS}, '{config.REASON_INVALID}' AS quarantine_reason, {QUARANTINED_AT} FROM routed WHERE route = 'invalid'",
    "quarantine_orphans": _with()
    + f"SELECT {Q_COLS}, '{config.REASON_ORPHAN}' AS quarantine_reason, {QUARANTINED_AT} FROM routed WHERE route = 'orphan'",
    "quarantine_all": _with()
    + f"""SELECT {Q_COLS},
       CASE route WHEN 'invalid' THEN '{config.REASON_INVALID}' ELSE '{config.REASON_ORPHAN}' END AS quarantine_reason,
       {QUARANTINED_AT}
FROM routed WHERE route <> 'clean'""",
    "ref_integrity_semi": _with()
    + """SELECT movie_id, user_id, rating, event_ts, rating_source FROM flagged f
WHERE NOT is_invalid AND movie_id IN (SELECT movie_id FROM catalogue)""",
    "rating_tier": _with() + "SELECT user_id, movie_id, rating, rating_tier FROM silver",
    "month_bucket": _with() + "SELECT user_id, movie_id, event_ts, rated_month FROM silver",
    "silver_feed": _with()
    + f"""SELECT user_id, movie_id, rating, event_ts, rating_source, rating_tier, rated_month,
       source_role AS _source_role, '{BATCH}' AS _ingest_batch FROM silver""",
    "genres_flat": _with()
    + """SELECT movie_id, CAST(generate_subscripts(genres, 1) AS INTEGER) AS genre_pos, unnest(genres) AS genre
FROM catalogue""",
    "primary_genre": _with() + "SELECT movie_id, primary_genre FROM catalogue_full",
    "release_year": _with() + "SELECT movie_id, title, release_year FROM catalogue",
    "dedup_natural_key": _with(
        f"""landed AS (
    SELECT movie_id, title, '{BATCH}' AS batch, TIMESTAMP '{CLOCK}' AS ingested_at FROM items
    UNION ALL
    SELECT movie_id, title, '{SECOND_BATCH}', TIMESTAMP '{SECOND_CLOCK}' FROM items
)"""
    )
    + """SELECT movie_id, title, batch AS _ingest_batch FROM landed
QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY ingested_at DESC, batch DESC) = 1""",
    "silver_catalogue": _with()
    + """SELECT movie_id, title, array_to_string(genres, '|') AS genre_list, CAST(len(genres) AS INTEGER) AS genre_count,
       primary_genre, release_year FROM catalogue_full""",
    "surrogate_key": _with()
    + """SELECT user_id, movie_id, md5('user|' || CAST(user_id AS VARCHAR)) AS user_key,
       md5('movie|' || CAST(movie_id AS VARCHAR)) AS movie_key FROM silver""",
    "decade": _with()
    + "SELECT movie_id, release_year, CAST(floor(release_year / 10) AS INTEGER) * 10 AS decade FROM catalogue",
    "dim_item": _with()
    + """SELECT movie_key, movie_natural_key, title, primary_genre, array_to_string(genres, '|') AS genre_list,
       release_year, decade FROM dim_item""",
    "dim_user": _with()
    + f"""SELECT md5('user|' || CAST(user_id AS VARCHAR)) AS user_key, user_id AS user_natural_key,
       count(*) AS rating_count, min(event_ts) AS first_rating_at, max(event_ts) AS last_rating_at,
       {_mean_half_up('rating')} AS avg_rating_given
FROM silver GROUP BY user_id""",
    "fact_stage": _with() + "SELECT * FROM fact",
    "monthly_agg": _with()
    + f"""SELECT f.movie_key, f.rated_month, d.title, d.primary_genre, d.release_year,
       count(*) AS rating_count, {_mean_half_up('f.rating')} AS avg_rating,
       count(DISTINCT f.user_key) AS distinct_raters
FROM fact_merged f JOIN dim_item d ON f.movie_key = d.movie_key
GROUP BY f.movie_key, f.rated_month, d.title, d.primary_genre, d.release_year""",
    "fact_merged": _with() + "SELECT * FROM fact_merged",
    "point_before_after": _with(
        _snapshot("tgt", f"version <= {FEED_LAST_VERSION}"),
        _snapshot("src", f"version > {FEED_LAST_VERSION}"),
        """both_sides AS (
    SELECT t.user_id, t.movie_id, t.rating AS rating_before,
           CASE WHEN s.user_id IS NOT NULL THEN s.rating ELSE t.rating END AS rating_after
    FROM tgt t LEFT JOIN src s ON t.user_id = s.user_id AND t.movie_id = s.movie_id
)""",
    )
    + """SELECT movie_id, user_id, rating_before, rating_after, (SELECT count(*) FROM tgt) AS rows_before,
       (SELECT count(*) FROM both_sides) AS rows_after
FROM both_sides WHERE rating_before <> rating_after ORDER BY movie_id, user_id, rating_before, rating_after LIMIT 1""",
    "csv_files": _with(
        """lines AS (
    SELECT src_key % 10 AS kind, CAST(user_id AS VARCHAR) AS u, CAST(movie_id AS VARCHAR) AS m,
           CAST(rating AS VARCHAR) AS r, CAST(CAST(epoch(event_ts) AS BIGINT) AS VARCHAR) AS t
    FROM feed WHERE src_key % 10 <> 5
)"""
    )
    + """SELECT u AS "userId", m AS "movieId", CASE WHEN kind = 9 THEN r || chr(10) || 'stars' ELSE r END AS rating,
       CASE WHEN kind = 7 THEN NULL ELSE t END AS "timestamp",
       CASE kind WHEN 7 THEN u || ',' || m || ',' || r WHEN 8 THEN u || ',' || m || ',' || r || ',' || t || ',extra' END AS _corrupt_record,
       CASE WHEN kind = 9 THEN 'breaks' ELSE 'plain' END AS folder
FROM lines""",
    "csv_headers": """SELECT folder, CASE WHEN folder = 'swapped' THEN 'movieId,userId,rating,timestamp' ELSE 'userId,movieId,rating,timestamp' END AS header,
       folder <> 'swapped' AS header_ok, CAST(sum(n) AS BIGINT) AS num_lines
FROM (SELECT CASE l_orderkey % 10 WHEN 9 THEN 'breaks' WHEN 5 THEN 'swapped' ELSE 'plain' END AS folder,
             CASE WHEN l_orderkey % 10 = 9 THEN 2 ELSE 1 END AS n FROM lineitem)
GROUP BY folder""",
    "append_relanded": _with()
    + f"""SELECT '01' AS _ingest_batch, 'primary' AS _source_role, TIMESTAMP '{SECOND_CLOCK}' AS _ingested_at,
       count(*) AS row_count, CAST(sum(src_key) AS BIGINT) AS key_sum FROM feed
UNION ALL SELECT '1', 'corrections', TIMESTAMP '{CLOCK}', count(*), CAST(sum(src_key) AS BIGINT) FROM corr""",
    "append_schema_changes": _with()
    + """SELECT 'timestamp' AS column_name, 'missing' AS change, NULL::VARCHAR AS incoming_type, 'string' AS table_type, (SELECT count(*) FROM feed) AS num_values
UNION ALL SELECT 'device', 'extra', 'string', NULL, (SELECT count(*) FROM feed WHERE src_key % 2 = 1)
UNION ALL SELECT '_source_key', 'retyped', 'string', 'bigint', (SELECT count(*) FROM feed WHERE src_key % 2 = 1)""",
    "run_history": _with(
        f"""batches AS (
    SELECT DISTINCT user_id, movie_id,
           CASE WHEN version <= {AS_OF_VERSION} THEN 0 WHEN version <= {FEED_LAST_VERSION} THEN 1 ELSE 2 END AS run
    FROM changelog
)""",
        """firsts AS (SELECT *, min(run) OVER (PARTITION BY user_id, movie_id) AS first FROM batches)""",
        """counts AS (
    SELECT run, count(*) AS num_written, count(*) FILTER (WHERE run = first) AS num_inserted FROM firsts GROUP BY run
)""",
    )
    + """SELECT CAST(run AS INTEGER) AS version, CASE WHEN run = 0 THEN 'WRITE' ELSE 'MERGE' END AS operation, num_written, num_inserted,
       num_written - num_inserted AS num_updated, CAST(sum(num_inserted) OVER (ORDER BY run) AS BIGINT) AS num_rows,
       run = max(run) OVER () AS is_current
FROM counts""",
    "fact_bucketed": _with() + "SELECT * FROM fact_merged",
    "csv_lines": _with(
        """lines AS (
    SELECT src_key, src_line, src_key % 10 AS kind, CAST(user_id AS VARCHAR) AS u, CAST(movie_id AS VARCHAR) AS m,
           CAST(rating AS VARCHAR) AS r, CAST(CAST(epoch(event_ts) AS BIGINT) AS VARCHAR) AS t
    FROM feed
)"""
    )
    + """SELECT src_key AS _source_key, src_line AS _source_line,
       CASE WHEN kind = 9 THEN u || ',' || m || ',' || r || ',' || t ELSE u END AS "userId",
       CASE WHEN kind = 9 THEN NULL ELSE m END AS "movieId",
       CASE WHEN kind = 9 THEN NULL ELSE r END AS rating,
       CASE WHEN kind IN (7, 9) THEN NULL ELSE t END AS "timestamp",
       CASE kind WHEN 7 THEN u || ',' || m || ',' || r WHEN 8 THEN u || ',' || m || ',' || r || ',' || t || ',extra'
                 WHEN 9 THEN '"' || u || ',' || m || ',' || r || ',' || t END AS _corrupt
FROM lines""",
    "merge_upsert": _with(
        _snapshot("tgt", f"version <= {FEED_LAST_VERSION}"),
        _snapshot("src", f"version > {FEED_LAST_VERSION}"),
    )
    + """SELECT coalesce(s.user_id, t.user_id) AS user_id, coalesce(s.movie_id, t.movie_id) AS movie_id,
       CASE WHEN s.user_id IS NOT NULL THEN s.rating ELSE t.rating END AS rating,
       CASE WHEN s.user_id IS NOT NULL THEN s.event_ts ELSE t.event_ts END AS event_ts,
       CASE WHEN s.user_id IS NOT NULL THEN s.rating_source ELSE t.rating_source END AS rating_source,
       CASE WHEN s.user_id IS NOT NULL THEN s.version ELSE t.version END AS version
FROM tgt t FULL JOIN src s ON t.user_id = s.user_id AND t.movie_id = s.movie_id""",
    "merge_guarded": _with(
        _snapshot("tgt", f"version <= {FEED_LAST_VERSION}"),
        _snapshot("src", f"version = {AS_OF_VERSION} OR version > {FEED_LAST_VERSION}"),
        """pick AS (
    SELECT t.*, s.user_id AS s_user_id, s.movie_id AS s_movie_id, s.rating AS s_rating, s.event_ts AS s_event_ts,
           s.rating_source AS s_rating_source, s.version AS s_version,
           (t.user_id IS NULL OR (s.user_id IS NOT NULL AND (t.event_ts IS NULL OR s.event_ts >= t.event_ts))) AS take_src
    FROM tgt t FULL JOIN src s ON t.user_id = s.user_id AND t.movie_id = s.movie_id
)""",
    )
    + """SELECT CASE WHEN take_src THEN s_user_id ELSE user_id END AS user_id,
       CASE WHEN take_src THEN s_movie_id ELSE movie_id END AS movie_id,
       CASE WHEN take_src THEN s_rating ELSE rating END AS rating,
       CASE WHEN take_src THEN s_event_ts ELSE event_ts END AS event_ts,
       CASE WHEN take_src THEN s_rating_source ELSE rating_source END AS rating_source,
       CASE WHEN take_src THEN s_version ELSE version END AS version
FROM pick""",
    "merge_update_only": _with(
        _snapshot("tgt", f"version <= {FEED_LAST_VERSION}"),
        _snapshot("src", f"version > {FEED_LAST_VERSION}"),
    )
    + """SELECT t.user_id, t.movie_id,
       CASE WHEN s.user_id IS NOT NULL THEN s.rating ELSE t.rating END AS rating,
       CASE WHEN s.user_id IS NOT NULL THEN s.event_ts ELSE t.event_ts END AS event_ts,
       CASE WHEN s.user_id IS NOT NULL THEN s.rating_source ELSE t.rating_source END AS rating_source,
       CASE WHEN s.user_id IS NOT NULL THEN s.version ELSE t.version END AS version
FROM tgt t LEFT JOIN src s ON t.user_id = s.user_id AND t.movie_id = s.movie_id""",
    "fact_not_in_stage": _with(_snapshot("cur", "true"))
    + """SELECT c.user_id, c.movie_id FROM cur c
WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.user_id = c.user_id AND s.movie_id = c.movie_id)""",
    "snapshot_as_of": _with(_snapshot("snap", f"version <= {AS_OF_VERSION}")) + "SELECT * FROM snap",
    "version_history": _with(
        """written AS (SELECT version, count(*) AS num_written FROM changelog GROUP BY version)""",
        """firsts AS (SELECT v AS version, count(*) AS num_inserted
            FROM (SELECT min(version) AS v FROM changelog GROUP BY user_id, movie_id) GROUP BY v)""",
    )
    + """SELECT w.version,
       CASE WHEN w.version = min(w.version) OVER () THEN 'WRITE' ELSE 'MERGE' END AS operation,
       w.num_written, coalesce(f.num_inserted, 0) AS num_inserted,
       w.num_written - coalesce(f.num_inserted, 0) AS num_updated,
       CAST(sum(coalesce(f.num_inserted, 0)) OVER (ORDER BY w.version) AS BIGINT) AS num_rows
FROM written w LEFT JOIN firsts f ON w.version = f.version""",
    "version_diff": _with()
    + f"""SELECT user_id, movie_id, version_before, rating_before, version_after, rating_after,
       CASE WHEN version_before IS NULL THEN 'inserted'
            WHEN version_after IS NULL THEN 'deleted'
            WHEN version_before <> version_after THEN 'updated' ELSE 'unchanged' END AS change
FROM (
    SELECT user_id, movie_id,
           max(version) FILTER (WHERE version <= {AS_OF_VERSION}) AS version_before,
           arg_max(rating, version) FILTER (WHERE version <= {AS_OF_VERSION}) AS rating_before,
           max(version) AS version_after,
           arg_max(rating, version) AS rating_after
    FROM changelog GROUP BY user_id, movie_id
)""",
    "grain_duplicates": _with()
    + "SELECT user_id, movie_id, count(*) AS n FROM ratings GROUP BY user_id, movie_id HAVING count(*) > 1",
    "event_range": _with() + "SELECT min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts FROM silver",
    "top1_lowest": _with()
    + f"""SELECT user_key, movie_key, rating, event_ts, rating_source FROM fact
WHERE rating < {config.CORRECTION_SPLIT} ORDER BY rating, movie_key, user_key LIMIT 1""",
    "point_lookup": _with(
        _snapshot("feed_state", f"version <= {FEED_LAST_VERSION}"),
        f"""pair AS (SELECT user_id, movie_id FROM feed_state WHERE rating < {config.CORRECTION_SPLIT}
                  ORDER BY rating, movie_id, user_id LIMIT 1)""",
    )
    + """SELECT c.version, c.user_id, c.movie_id, c.rating, c.event_ts, c.rating_source
FROM changelog c JOIN pair p ON c.user_id = p.user_id AND c.movie_id = p.movie_id""",
    "reconcile_counts": _with(
        """ranked AS (
    SELECT r.*, row_number() OVER (PARTITION BY user_id, movie_id
                                   ORDER BY event_ts DESC, src_key DESC, src_line DESC) AS rk,
           EXISTS (SELECT 1 FROM catalogue c WHERE c.movie_id = r.movie_id) AS known
    FROM ratings r
)""",
    )
    + f"""SELECT feed_rows, correction_rows, input_rows, superseded_rows, latest_rows, invalid_rows, orphan_rows,
       silver_rows,
       (input_rows - superseded_rows = latest_rows AND latest_rows = invalid_rows + orphan_rows + silver_rows) AS balanced
FROM (
    SELECT count(*) FILTER (WHERE rating_source = 'primary') AS feed_rows,
           count(*) FILTER (WHERE rating_source = 'correction') AS correction_rows,
           count(*) AS input_rows,
           count(*) FILTER (WHERE rk > 1) AS superseded_rows,
           count(*) FILTER (WHERE rk = 1) AS latest_rows,
           count(*) FILTER (WHERE rk = 1 AND {INVALID}) AS invalid_rows,
           count(*) FILTER (WHERE rk = 1 AND NOT {INVALID} AND NOT known) AS orphan_rows,
           count(*) FILTER (WHERE rk = 1 AND NOT {INVALID} AND known) AS silver_rows
    FROM ranked
)""",
}

for _key, _check in DQ.items():
    SQL[_key] = _with() + _dq(*_check)

SQL["dq_report"] = _with() + "\nUNION ALL\n".join(_dq(*c) for c in DQ.values())

# Silver's columns and their Spark type names (fixed by the silver schema).
SILVER_SCHEMA = [
    ("user_id", "bigint"),
    ("movie_id", "bigint"),
    ("rating", "double"),
    ("event_ts", "timestamp_ntz"),
    ("rating_source", "string"),
    ("rating_tier", "string"),
    ("rated_month", "string"),
    ("_source_file", "string"),
    ("_source_role", "string"),
    ("_ingest_batch", "string"),
    ("_ingested_at", "timestamp_ntz"),
    ("_source_key", "bigint"),
    ("_source_line", "int"),
]
_SILVER_AS_LAYER = f"""silver_layer AS (
    SELECT user_id, movie_id, rating, event_ts, rating_source, rating_tier, rated_month,
           source_file AS _source_file, source_role AS _source_role, '{BATCH}' AS _ingest_batch,
           TIMESTAMP '{CLOCK}' AS _ingested_at, src_key AS _source_key, src_line AS _source_line
    FROM silver
)"""
SQL["schema_report"] = _with(_SILVER_AS_LAYER) + "\nUNION ALL\n".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{name}' AS column_name, '{typ}' AS data_type, "
    f"count(*) FILTER (WHERE {name} IS NULL) AS null_count FROM silver_layer"
    for i, (name, typ) in enumerate(SILVER_SCHEMA, start=1)
)
