"""Row-level features of one snapshot, as SQL expressions over column names."""

from __future__ import annotations

from airwave.functions.numeric import clip_low_sql, even_sql, right_closed_sql, seconds_sql

# Bin edges (right-closed) and labels.
VIEWER_BINS = [(100, "0-100"), (1_000, "101-1K"), (10_000, "1K-10K"), (50_000, "10K-50K")]
VIEWER_TOP = "50K+"
AGE_BINS = [(30, "0-30 min"), (120, "30-120 min"), (360, "2-6 hours"), (720, "6-12 hours")]
AGE_TOP = "12+ hours"


def duration_minutes(collected: str, started: str) -> str:
    return even_sql(clip_low_sql(f"{seconds_sql(collected, started)} / 60D", "0D"), 1)


def duration_hours(minutes: str) -> str:
    """From the rounded minutes, so both columns agree."""
    return even_sql(f"{minutes} / 60D", 2)


def raw_duration_hours(collected: str, started: str) -> str:
    """Neither clipped nor rounded."""
    return f"{seconds_sql(collected, started)} / 3600D"


def hours_observed(last_seen: str, first_seen: str) -> str:
    return even_sql(f"{seconds_sql(last_seen, first_seen)} / 3600D", 2)


def day_text(instant: str) -> str:
    return f"date_format({instant}, 'yyyy-MM-dd')"


def weekday_name(instant: str) -> str:
    return f"date_format({instant}, 'EEEE')"


def on_weekend(instant: str) -> str:
    return f"weekday({instant}) >= 5"


def tag_count(tags: str) -> str:
    """Comma-separated pieces that hold something other than white space."""
    return rf"regexp_count({tags}, r'(?U)[^,\s][^,]*')"


def gap_minutes(collected: str, previous: str) -> str:
    return even_sql(f"{seconds_sql(collected, previous)} / 60D", 1)


def delta(current: str, previous: str) -> str:
    return f"coalesce(CAST({current} - {previous} AS DOUBLE), 0D)"


def pct_change(change: str, previous: str) -> str:
    """Zero where the previous count is 0 or unknown."""
    return f"coalesce({even_sql(f'try_divide({change}, CAST({previous} AS DOUBLE)) * 100D', 2)}, 0D)"


def trend(change: str) -> str:
    return f"CASE WHEN {change} > 0 THEN 'up' WHEN {change} < 0 THEN 'down' ELSE 'stable' END"


def viewer_bucket(viewers: str) -> str:
    return right_closed_sql(viewers, -1, VIEWER_BINS, VIEWER_TOP)


def age_bucket(minutes: str) -> str:
    return right_closed_sql(minutes, -1, AGE_BINS, AGE_TOP)
