"""The registered queries in ANSI SQL over the same tables, written for DuckDB."""

from __future__ import annotations


def _even(expression: str, places: int = 6) -> str:
    scale = f"1e{places}"
    return f"round_even(({expression}) * {scale}, 0) / {scale}"


def _avg(column: str) -> str:
    return _even(f"avg({column})")


RAW = """
keyed AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) AS batch
  FROM events
),
raw AS (
  SELECT event_id AS ingest_seq,
         CAST(user_id AS VARCHAR) AS id,
         CAST(user_id AS VARCHAR) AS user_id,
         'user_' || CAST(user_id AS VARCHAR) AS user_login,
         CASE WHEN user_id % 10 = 0 THEN 'üser' ELSE 'User' END || CAST(user_id AS VARCHAR)
           AS user_name,
         event_type AS game_id,
         CASE WHEN k % 20 <> 7 THEN event_type END AS game_name,
         'live' AS type,
         props AS title,
         CASE WHEN k = 50 THEN 'n/a' ELSE CAST(CAST(floor(value * value) AS BIGINT) AS VARCHAR) END
           AS viewer_count,
         CASE WHEN k <> 99 THEN batch - to_minutes((k - 2) * 10) END AS started_at,
         CASE k % 6 WHEN 0 THEN 'en' WHEN 1 THEN 'es' WHEN 2 THEN 'pt' WHEN 3 THEN 'de'
                    WHEN 4 THEN 'zh-cn' END AS language,
         CAST(NULL AS VARCHAR) AS thumbnail_url,
         CAST(NULL AS VARCHAR) AS tag_ids,
         CASE k % 4 WHEN 1 THEN 'a' WHEN 2 THEN 'a, b' WHEN 3 THEN ' , a,,b , ' END AS tags,
         CASE k % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'false' ELSE '' END AS is_mature,
         batch AS collected_at
  FROM keyed
)"""

CLEAN = RAW + """,
cleaned AS (
  SELECT ingest_seq, id, user_id, user_login, user_name, game_id,
         coalesce(game_name, 'Unknown') AS game_name, type, coalesce(title, '') AS title,
         coalesce(TRY_CAST(viewer_count AS BIGINT), 0) AS viewer_count, started_at,
         coalesce(language, 'unknown') AS language, thumbnail_url, tag_ids,
         coalesce(tags, '') AS tags, coalesce(lower(trim(is_mature)) = 'true', false) AS is_mature,
         collected_at
  FROM raw
)"""

UNIQUE = CLEAN + """,
uniq AS (
  SELECT * EXCLUDE (nth)
  FROM (SELECT *, row_number() OVER (PARTITION BY id, collected_at ORDER BY ingest_seq) AS nth
        FROM cleaned)
  WHERE nth = 1
)"""

MINUTES = _even(
    "greatest((epoch_us(collected_at) - epoch_us(started_at)) / 1e6 / 60.0, 0.0)", 1
)
GAP = _even("(epoch_us(collected_at) - epoch_us(previous_collected_at)) / 1e6 / 60.0", 1)

ENRICHED = UNIQUE + f""",
timed AS (
  SELECT *, CASE WHEN started_at IS NOT NULL THEN {MINUTES} END AS stream_duration_minutes
  FROM uniq
),
featured AS (
  SELECT *,
         {_even("stream_duration_minutes / 60.0", 2)} AS stream_duration_hours,
         strftime(collected_at, '%Y-%m-%d') AS snapshot_date,
         CAST(hour(collected_at) AS INTEGER) AS snapshot_hour_utc,
         dayname(collected_at) AS snapshot_weekday,
         isodow(collected_at) >= 6 AS is_weekend,
         strftime(started_at, '%Y-%m-%d') AS started_date,
         CAST(hour(started_at) AS INTEGER) AS started_hour_utc,
         CAST(length(title) AS INTEGER) AS title_length,
         CAST(len(list_filter(string_split(tags, ','), lambda x: trim(x) <> '')) AS INTEGER)
           AS tags_count,
         CAST(dense_rank() OVER (PARTITION BY collected_at ORDER BY viewer_count DESC) AS INTEGER)
           AS viewer_rank_in_snapshot,
         lag(viewer_count) OVER stream AS previous_viewer_count,
         lag(collected_at) OVER stream AS previous_collected_at,
         CAST(row_number() OVER stream AS INTEGER) AS stream_snapshot_number
  FROM timed
  WINDOW stream AS (PARTITION BY id ORDER BY collected_at)
),
changed AS (
  SELECT *, tags_count > 0 AS has_tags, {GAP} AS minutes_since_last_snapshot,
         coalesce(CAST(viewer_count - previous_viewer_count AS DOUBLE), 0.0) AS viewer_count_delta
  FROM featured
),
enriched AS (
  SELECT *,
         coalesce({_even("viewer_count_delta / nullif(previous_viewer_count, 0) * 100.0", 2)}, 0.0)
           AS viewer_count_pct_change,
         CASE WHEN viewer_count_delta > 0 THEN 'up' WHEN viewer_count_delta < 0 THEN 'down'
              ELSE 'stable' END AS viewer_trend,
         CASE WHEN viewer_count <= -1 THEN NULL WHEN viewer_count <= 100 THEN '0-100'
              WHEN viewer_count <= 1000 THEN '101-1K' WHEN viewer_count <= 10000 THEN '1K-10K'
              WHEN viewer_count <= 50000 THEN '10K-50K' ELSE '50K+' END AS viewer_count_bucket,
         CASE WHEN stream_duration_minutes IS NULL THEN NULL
              WHEN stream_duration_minutes <= 30 THEN '0-30 min'
              WHEN stream_duration_minutes <= 120 THEN '30-120 min'
              WHEN stream_duration_minutes <= 360 THEN '2-6 hours'
              WHEN stream_duration_minutes <= 720 THEN '6-12 hours'
              ELSE '12+ hours' END AS stream_age_bucket
  FROM changed
)"""

GAME_HOURLY = f"""
  SELECT game_name, snapshot_hour_utc, count(id) AS snapshots,
         count(DISTINCT user_id) AS unique_streamers,
         CAST(sum(viewer_count) AS BIGINT) AS total_viewers, {_avg("viewer_count")} AS avg_viewers,
         max(viewer_count) AS peak_viewers
  FROM enriched GROUP BY game_name, snapshot_hour_utc"""

LANGUAGE_HOURLY = GAME_HOURLY.replace("game_name", "language")

DISPLAY = "CASE WHEN regexp_matches(user_name, '[^\\x00-\\x7F]') THEN user_login ELSE user_name END"

# Fixed values, written out here so that the SQL does not rest on the code that it checks.
NAMES = """
  ('en', 'English'), ('es', 'Spanish'), ('pt', 'Portuguese'), ('de', 'German'), ('fr', 'French'),
  ('ru', 'Russian'), ('ja', 'Japanese'), ('ko', 'Korean'), ('zh', 'Chinese'),
  ('zh-cn', 'Chinese (Simplified)'), ('zh-tw', 'Chinese (Traditional)'), ('pl', 'Polish'),
  ('sk', 'Slovak'), ('cs', 'Czech'), ('it', 'Italian'), ('tr', 'Turkish'), ('uk', 'Ukrainian'),
  ('nl', 'Dutch'), ('sv', 'Swedish'), ('fi', 'Finnish'), ('da', 'Danish'), ('no', 'Norwegian'),
  ('hu', 'Hungarian'), ('asl', 'American Sign Language'), ('el', 'Greek')"""

FACT = ENRICHED + """,
fact AS (
  SELECT id, user_id, user_login, user_name, game_id, game_name, title, viewer_count, started_at,
         collected_at, language, is_mature,
         CAST(coalesce(stream_duration_minutes, 0.0) AS FLOAT) AS stream_duration_minutes,
         CAST(coalesce(stream_duration_hours, 0.0) AS FLOAT) AS stream_duration_hours,
         CAST(snapshot_hour_utc AS SMALLINT) AS snapshot_hour_utc,
         CAST(viewer_count_delta AS FLOAT) AS viewer_count_delta,
         CAST(viewer_count_pct_change AS FLOAT) AS viewer_count_pct_change, viewer_trend
  FROM enriched
)"""


def _label(code: str) -> str:
    # Every code of the test data but "unknown" is listed; that one has a single run of letters.
    return (
        f"{code} || ' - ' || coalesce(name, upper(substr({code}, 1, 1)) || substr({code}, 2))"
    )


def _with(cte: str, body: str) -> str:
    return f"WITH {cte.strip()}\n{body.strip()}"


def _mode(column: str, name: str) -> str:
    return f""",
{name}_mode AS (
  SELECT user_id, {column} AS {name}
  FROM (SELECT user_id, {column},
               row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, {column}) AS nth
        FROM enriched GROUP BY user_id, {column})
  WHERE nth = 1
)"""


HISTOGRAM = """
  SELECT CAST(i AS INTEGER) AS bin, lo + i * w AS left_edge, lo + (i + 1) * w AS right_edge,
         count(viewer_count) AS count
  FROM (SELECT min(viewer_count) AS lo, max(viewer_count) AS hi,
               (max(viewer_count) - min(viewer_count)) / 30.0 AS w FROM uniq) AS spread
  CROSS JOIN range(30) AS bins(i)
  LEFT JOIN uniq
    ON viewer_count >= lo + i * w AND (viewer_count < lo + (i + 1) * w OR i = 29)
  GROUP BY i, lo, w"""

DENSITY = f"""
spread AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, CAST(min(viewer_count) AS DOUBLE) AS lo,
         CAST(max(viewer_count) AS DOUBLE) AS hi,
         stddev_samp(viewer_count) * pow(count(*), -0.2) AS h
  FROM uniq
),
curve AS (
  SELECT CAST(i AS INTEGER) AS point, lo + i * ((hi - lo) / 199) AS x,
         sum(exp(-0.5 * pow((viewer_count - lo - i * ((hi - lo) / 199)) / h, 2)))
           / (n * h * sqrt(2.0 * pi())) AS density,
         n * (hi - lo) / 30 AS area
  FROM uniq CROSS JOIN spread CROSS JOIN range(200) AS grid(i)
  GROUP BY i, lo, hi, n, h
)
SELECT point, {_even("x")} AS x, {_even("density", 12)} AS density,
       {_even("density * area")} AS scaled
FROM curve"""


def statements() -> dict[str, str]:
    full = "SELECT collected_at FROM uniq GROUP BY collected_at HAVING count(*) >= 15"
    tracked = f"""
  SELECT user_name, user_login, max(viewer_count) AS peak_viewers, count(id) AS snapshots,
         {DISPLAY} AS streamer_display
  FROM uniq GROUP BY user_name, user_login HAVING count(id) >= 10
  ORDER BY peak_viewers DESC, snapshots DESC, user_name, user_login LIMIT 10"""
    avg_viewers, avg_delta = _avg("viewer_count"), _avg("viewer_count_delta")
    return {
        "enrich_base": _with(ENRICHED, "SELECT * FROM enriched"),
        "dedupe_snapshots": _with(
            UNIQUE,
            "SELECT ingest_seq, id, user_login, user_name, game_name, title, viewer_count, "
            "started_at, language, tags, is_mature, collected_at FROM uniq",
        ),
        "dedupe_unreadable_times": _with(
            CLEAN,
            """
SELECT id, CASE WHEN ingest_seq % 7 <= 1 THEN TIMESTAMP '2026-01-01' ELSE collected_at END
         AS collected_at, ingest_seq, viewer_count
FROM (SELECT *, row_number() OVER (
        PARTITION BY id, CASE WHEN ingest_seq % 7 = 0 THEN 'bad ' || (ingest_seq % 3)
                              WHEN ingest_seq % 7 <> 1 THEN CAST(collected_at AS VARCHAR) END
        ORDER BY ingest_seq) AS nth
      FROM cleaned)
WHERE nth = 1""",
        ),
        "durations": _with(
            ENRICHED,
            "SELECT id, collected_at, stream_duration_minutes, stream_duration_hours FROM enriched",
        ),
        "raw_durations": _with(
            CLEAN,
            "SELECT id, collected_at, started_at, "
            + _even("(epoch_us(collected_at) - epoch_us(started_at)) / 1e6 / 3600.0")
            + " AS stream_duration_hours FROM cleaned",
        ),
        "calendar_features": _with(
            ENRICHED,
            "SELECT id, collected_at, snapshot_date, snapshot_hour_utc, snapshot_weekday, "
            "is_weekend, started_date, started_hour_utc FROM enriched",
        ),
        "text_features": _with(
            ENRICHED, "SELECT id, collected_at, title_length, tags_count, has_tags FROM enriched"
        ),
        "display_labels": _with(
            UNIQUE,
            f"SELECT id, collected_at, {_label('language')} AS language_display, "
            f"{DISPLAY} AS streamer_display "
            f"FROM uniq LEFT JOIN (VALUES {NAMES}) AS names(code, name) ON language = code",
        ),
        "viewer_rank": _with(
            ENRICHED,
            "SELECT id, collected_at, viewer_count, viewer_rank_in_snapshot FROM enriched",
        ),
        "stream_history": _with(
            ENRICHED,
            "SELECT id, collected_at, viewer_count, previous_viewer_count, previous_collected_at, "
            "stream_snapshot_number FROM enriched",
        ),
        "viewer_trend": _with(
            ENRICHED,
            "SELECT id, collected_at, minutes_since_last_snapshot, viewer_count_delta, "
            "viewer_count_pct_change, viewer_trend FROM enriched",
        ),
        "buckets": _with(
            ENRICHED,
            "SELECT id, collected_at, viewer_count_bucket, stream_age_bucket FROM enriched",
        ),
        "top_games_summary": _with(
            ENRICHED,
            f"SELECT game_name, count(id) AS snapshots, {avg_viewers} AS avg_viewers, "
            f"max(viewer_count) AS peak_viewers, {_avg('stream_duration_hours')} "
            "AS avg_stream_duration_hours FROM enriched GROUP BY game_name",
        ),
        "streamer_summary": _with(
            ENRICHED + _mode("language", "language") + _mode("game_name", "primary_game"),
            f"""
SELECT user_id, user_login, user_name, any_value(m.language) AS language,
       any_value(g.primary_game) AS primary_game, count(id) AS snapshots,
       min(collected_at) AS first_seen_at, max(collected_at) AS last_seen_at,
       {avg_viewers} AS avg_viewers, max(viewer_count) AS peak_viewers, {avg_delta} AS avg_delta,
       min(viewer_rank_in_snapshot) AS best_rank,
       {_even("(epoch_us(max(collected_at)) - epoch_us(min(collected_at))) / 1e6 / 3600.0", 2)}
         AS hours_observed
FROM enriched JOIN language_mode AS m USING (user_id) JOIN primary_game_mode AS g USING (user_id)
GROUP BY user_id, user_login, user_name""",
        ),
        "language_summary": _with(
            ENRICHED,
            f"SELECT language, count(id) AS snapshots, {avg_viewers} AS avg_viewers, "
            f"max(viewer_count) AS peak_viewers, {avg_delta} AS avg_delta "
            "FROM enriched GROUP BY language",
        ),
        "language_hourly_summary": _with(ENRICHED, LANGUAGE_HOURLY),
        "language_hourly_folded": _with(ENRICHED, LANGUAGE_HOURLY),
        "game_hourly_summary": _with(ENRICHED, GAME_HOURLY),
        "hourly_summary": _with(
            ENRICHED,
            f"SELECT snapshot_hour_utc, count(id) AS snapshots, {avg_viewers} AS avg_viewers, "
            "max(viewer_count) AS peak_viewers FROM enriched GROUP BY snapshot_hour_utc",
        ),
        "maturity_summary": _with(
            ENRICHED,
            f"SELECT is_mature, count(id) AS snapshots, {avg_viewers} AS avg_viewers, "
            f"max(viewer_count) AS peak_viewers, {avg_delta} AS avg_delta "
            "FROM enriched GROUP BY is_mature",
        ),
        "collection_health_summary": _with(
            ENRICHED,
            "SELECT collected_at, count(id) AS rows_collected, "
            "count(DISTINCT user_id) AS unique_streamers, "
            "count(DISTINCT game_name) AS unique_games, "
            "CAST(sum(viewer_count) AS BIGINT) AS total_viewers, "
            f"min(viewer_count) AS min_viewers, {avg_viewers} AS avg_viewers, "
            f"max(viewer_count) AS max_viewers, {_avg('minutes_since_last_snapshot')} "
            "AS avg_minutes_since_last_snapshot FROM enriched GROUP BY collected_at",
        ),
        "fastest_growing_streams": _with(
            ENRICHED,
            "SELECT collected_at, user_name, game_name, language, viewer_count, "
            "viewer_count_delta, viewer_count_pct_change, viewer_trend FROM enriched "
            "ORDER BY viewer_count_delta DESC, collected_at, user_name, game_name, language, "
            "viewer_count LIMIT 50",
        ),
        "games_by_streamers": _with(
            UNIQUE,
            "SELECT game_name, count(DISTINCT user_id) AS unique_streamers, "
            f"max(viewer_count) AS peak_viewers, {avg_viewers} AS avg_viewers FROM uniq "
            "GROUP BY game_name ORDER BY unique_streamers DESC, game_name LIMIT 12",
        ),
        "languages_by_streamers": _with(
            UNIQUE,
            f"SELECT language, unique_streamers, peak_viewers, {_label('language')} "
            "AS language_display FROM (SELECT language, "
            "count(DISTINCT user_id) AS unique_streamers, max(viewer_count) AS peak_viewers "
            "FROM uniq GROUP BY language ORDER BY unique_streamers DESC, language LIMIT 10) "
            f"LEFT JOIN (VALUES {NAMES}) AS names(code, name) ON language = code",
        ),
        "audience_split": _with(
            UNIQUE,
            "SELECT CASE WHEN is_mature THEN 'Mature' ELSE 'Not Mature' END AS audience_type, "
            "count(DISTINCT user_id) AS unique_streamers, max(viewer_count) AS peak_viewers "
            "FROM uniq GROUP BY ALL",
        ),
        "top_streamers": _with(
            UNIQUE,
            f"SELECT user_name, user_login, max(viewer_count) AS peak_viewers, {avg_viewers} "
            f"AS avg_viewers, count(id) AS snapshots, {DISPLAY} AS streamer_display FROM uniq "
            "GROUP BY user_name, user_login ORDER BY peak_viewers DESC, user_name, user_login "
            "LIMIT 12",
        ),
        "full_batch_rows": _with(
            UNIQUE,
            f"SELECT id, collected_at, viewer_count FROM uniq WHERE collected_at IN ({full})",
        ),
        "full_batch_timeline": _with(
            UNIQUE,
            "SELECT collected_at, CAST(sum(viewer_count) AS BIGINT) AS total_viewers FROM uniq "
            f"WHERE collected_at IN ({full}) GROUP BY collected_at",
        ),
        "tracked_streamers": _with(UNIQUE, tracked),
        "tracked_timeline": _with(
            UNIQUE + f",\ntracked AS ({tracked})",
            "SELECT u.collected_at, t.streamer_display, max(u.viewer_count) AS viewer_count "
            "FROM uniq AS u JOIN tracked AS t ON u.user_name IS NOT DISTINCT FROM t.user_name "
            "GROUP BY u.collected_at, t.streamer_display",
        ),
        "top_games_hourly": _with(
            ENRICHED + f",\nhourly AS ({GAME_HOURLY})",
            "SELECT * FROM hourly WHERE game_name IN (SELECT game_name FROM hourly "
            "GROUP BY game_name ORDER BY sum(total_viewers) DESC, game_name LIMIT 5)",
        ),
        "games_by_total": _with(
            UNIQUE,
            "SELECT game_name, CAST(sum(viewer_count) AS BIGINT) AS viewer_count FROM uniq "
            "GROUP BY game_name ORDER BY 2 DESC, game_name LIMIT 15",
        ),
        "languages_by_total": _with(
            UNIQUE,
            "SELECT upper(coalesce(nullif(language, ''), 'unknown')) AS language, "
            "CAST(sum(u.viewer_count) AS BIGINT) AS viewer_count FROM uniq AS u "
            "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
        ),
        "viewer_describe": _with(
            UNIQUE,
            f"SELECT count(viewer_count) AS count, {avg_viewers} AS mean, "
            f"{_even('stddev_samp(viewer_count)')} AS std, min(viewer_count) AS min, "
            + ", ".join(
                f"{_even(f'quantile_cont(viewer_count, {p})')} AS {name}"
                for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
            )
            + f", max(viewer_count) AS max, {_even('median(viewer_count)')} AS median FROM uniq",
        ),
        "viewer_histogram": _with(
            UNIQUE,
            f"SELECT bin, {_even('left_edge')} AS left_edge, {_even('right_edge')} AS right_edge, "
            f"count FROM ({HISTOGRAM})",
        ),
        "viewer_density": _with(UNIQUE + ",", DENSITY),
        "mature_split": _with(
            UNIQUE,
            "SELECT CASE WHEN is_mature THEN 'Mature' ELSE 'Not Mature' END AS mature_label, "
            f"CAST(sum(viewer_count) AS BIGINT) AS total_viewers, {avg_viewers} AS avg_viewers, "
            "count(*) AS stream_count FROM uniq GROUP BY 1",
        ),
        "fact_rows": _with(FACT, "SELECT * FROM fact"),
        "fact_count": _with(UNIQUE, "SELECT count(*) AS row_count FROM uniq"),
        "top_snapshots": _with(
            UNIQUE,
            "SELECT collected_at, user_name, game_name, viewer_count FROM uniq "
            "ORDER BY viewer_count DESC, collected_at, user_name, game_name LIMIT 10",
        ),
        "hourly_rounded": _with(
            UNIQUE,
            "SELECT CAST(hour(collected_at) AS SMALLINT) AS snapshot_hour_utc, "
            f"count(*) AS snapshots, {_even('avg(viewer_count)', 2)} AS avg_viewers, "
            "max(viewer_count) AS peak_viewers FROM uniq GROUP BY 1",
        ),
        "games_rounded": _with(
            UNIQUE,
            f"SELECT game_name, count(*) AS snapshots, {_even('avg(viewer_count)', 2)} "
            "AS avg_viewers, max(viewer_count) AS peak_viewers FROM uniq GROUP BY game_name "
            "ORDER BY avg_viewers DESC, game_name LIMIT 15",
        ),
        "profile": _with(
            UNIQUE,
            "SELECT (SELECT count(*) FROM raw) AS raw_rows, count(*) AS processed_rows, "
            "count(DISTINCT id) AS streams, count(DISTINCT game_name) AS games, "
            "count(DISTINCT language) AS languages, max(viewer_count) AS peak_viewers FROM uniq",
        ),
        "latest_batch": _with(
            FACT,
            "SELECT * FROM fact WHERE collected_at = (SELECT max(collected_at) FROM fact)",
        ),
        "missing_batches": _with(
            UNIQUE,
            f"SELECT collected_at, count(*) AS rows FROM uniq WHERE collected_at NOT IN ({full}) "
            "GROUP BY collected_at",
        ),
    }
