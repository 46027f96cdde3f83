from datetime import datetime

import pytest
from pyspark.sql import functions as F

from airwave.plans.enrich import enrich
from airwave.plans.summaries import (
    build_summaries,
    collection_health_summary,
    fastest_growing_streams,
    measures,
    pre_aggregate,
    prepare,
    streamer_summary,
)

RUN = "2026-01-09T00:00:00Z"


def row(id, minute, viewers, **more):
    base = {"id": id, "user_id": f"u{id}", "user_login": f"l{id}", "user_name": f"N{id}",
            "collected_at": f"2026-01-02T00:{minute:02d}:00Z", "viewer_count": viewers,
            "started_at": "2026-01-01T22:00:00Z", "game_name": "chess", "language": "en"}
    return {**base, **more}


@pytest.fixture
def enriched(raw):
    return enrich(
        raw(
            row(1, 0, 10, language="b", game_name="go"),
            row(1, 10, 20, language="a", game_name="chess"),
            row(1, 20, 5, language="b", game_name="go"),
            row(1, 30, 5, language="a"),
            row(2, 0, 100, is_mature="true"),
            row(2, 30, 300, is_mature="true"),
            row(3, 30, 7, user_id=None, user_login=None, user_name=None),
        ),
        RUN,
    ).cache()


def test_all_nine_tables(enriched):
    tables = build_summaries(enriched)
    assert list(tables) == [
        "top_games_summary", "streamer_summary", "language_summary", "language_hourly_summary",
        "game_hourly_summary", "hourly_summary", "maturity_summary", "collection_health_summary",
        "fastest_growing_streams",
    ]
    totals = {
        name: table.agg(F.sum(column)).first()[0]
        for name, table in tables.items()
        for column in ("snapshots", "rows_collected")
        if column in table.columns
    }
    assert set(totals.values()) == {7} and len(totals) == 8


def test_folded_rows_give_the_same_tables(enriched):
    direct = build_summaries(enriched)
    folded = build_summaries(enriched, pre_aggregate(measures(prepare(enriched))))
    for name in direct:
        assert direct[name].collect() == folded[name].collect(), name


def test_streamer_profile(enriched, local):
    rows = local(build_summaries(enriched)["streamer_summary"])
    assert [r["user_id"] for r in rows] == ["u2", "u1", None]
    one = rows[1]
    # Two of each language and of each game: the smaller value wins.
    assert (one["language"], one["primary_game"]) == ("a", "chess")
    assert (one["snapshots"], one["peak_viewers"], one["avg_viewers"]) == (4, 20, 10.0)
    assert one["avg_delta"] == pytest.approx(-1.25) and one["best_rank"] == 1
    assert one["hours_observed"] == 0.5
    assert one["first_seen_at"] == datetime(2026, 1, 2) and rows[2]["hours_observed"] == 0.0


def test_mode_of_nothing_is_unknown(enriched, local):
    emptied = enriched.withColumn("language", F.lit(None).cast("string"))
    rows = local(streamer_summary(measures(prepare(emptied))))
    assert {r["language"] for r in rows} == {"Unknown"}


def test_order_puts_largest_first_and_keeps_null_keys(enriched, local):
    tables = build_summaries(enriched)
    assert [r["game_name"] for r in local(tables["top_games_summary"])] == ["chess", "go"]
    assert [r["is_mature"] for r in local(tables["maturity_summary"])] == [True, False]
    unnamed = enriched.withColumn("game_name", F.when(F.col("game_name") == "go", None).otherwise("x"))
    assert [r["game_name"] for r in local(build_summaries(unnamed)["game_hourly_summary"])] == [
        "x", None,
    ]


def test_health(enriched, local):
    first = local(build_summaries(enriched)["collection_health_summary"])[0]
    assert first["rows_collected"] == 2 and first["unique_streamers"] == 2
    assert first["unique_games"] == 2 and first["total_viewers"] == 110
    assert (first["min_viewers"], first["max_viewers"]) == (10, 100)
    assert first["avg_minutes_since_last_snapshot"] is None


def test_fastest_growing_includes_falls_when_few_gained(enriched, local):
    rows = local(fastest_growing_streams(prepare(enriched), 50))
    assert [r["viewer_count_delta"] for r in rows] == [200.0, 10.0, 0.0, 0.0, 0.0, 0.0, -15.0]
    assert len(local(fastest_growing_streams(prepare(enriched), 2))) == 2


def test_text_input_and_absent_columns(spark, local):
    schema = ("id string, user_id string, viewer_count string, stream_duration_hours string, "
              "snapshot_hour_utc string, is_mature string")
    text = spark.createDataFrame(
        [("1", "u", "bad", "", "3", "TRUE"), ("2", "u", "8", "1.5", "3", "no")], schema
    )
    tables = build_summaries(text)
    hourly = local(tables["hourly_summary"])
    assert hourly == [{"snapshot_hour_utc": 3, "snapshots": 2, "avg_viewers": 4.0,
                       "peak_viewers": 8}]
    games = local(tables["top_games_summary"])
    assert games[0]["avg_stream_duration_hours"] == 1.5
    assert {r["is_mature"]: r["avg_viewers"] for r in local(tables["maturity_summary"])} == {
        True: 0.0, False: 8.0,
    }


def test_no_rows_give_no_groups(enriched):
    for name, table in build_summaries(enriched.limit(0)).items():
        assert table.isEmpty(), name


def test_health_counts_distinct_values_without_multiplying_rows(enriched):
    health = build_summaries(enriched)["collection_health_summary"]
    assert "Expand" not in health._jdf.queryExecution().executedPlan().toString()
    rough = collection_health_summary(prepare(enriched), approximate=True)
    assert rough.columns == health.columns
    assert sorted(map(repr, rough.collect())) == sorted(map(repr, health.collect()))
