"""Summaries that follow the incremental table, sketches, and the incremental pipeline."""

import math
import os

import pytest
from pyspark.sql import functions as F

from airwave.plans import explore, sketches
from airwave.plans.enrich import enrich
from airwave.plans.fact import to_fact
from airwave.plans.pipeline import Paths, follow_pipeline
from airwave.plans.summaries import build_summaries, measures, pre_aggregate, prepare
from airwave.sources.snapshots import read_raw, read_summary
from airwave.streaming.enrich import changes_stream, enrich_batch, read_incremental
from airwave.streaming.health import read_health
from airwave.streaming.summaries import (
    read_approximate,
    read_summaries,
    summaries_stream,
    update_partials,
)
from test_manifest import files, random_frames
from test_streaming import RUN, finish, land, page


def rounded(df):
    """Rows as sorted text; sums of doubles depend on the order of addition."""
    return sorted(
        repr([round(v, 9) if isinstance(v, float) else v for v in r.asDict().values()])
        for r in df.collect()
    )


def assert_same_tables(got, enriched):
    want = build_summaries(enriched)
    assert list(got) == list(want)
    for name, table in want.items():
        assert got[name].columns == table.columns, name
        assert rounded(got[name]) == rounded(table), name


def test_summaries_follow_late_split_and_replayed_batches(spark, raw, tmp_path):
    out, path = str(tmp_path / "out"), str(tmp_path / "partials")
    names = {"user_id": "id", "user_login": "id", "user_name": "id"}
    whole = None
    for epoch, frame in enumerate(random_frames(raw, 7, 6)):
        frame = frame.withColumns({c: F.col(s) for c, s in names.items()}).withColumn(
            "game_name", F.when(F.col("viewer_count") > 4, "go").otherwise("chess")
        )
        whole = frame if whole is None else whole.unionByName(frame)
        enrich_batch(frame, epoch, out, RUN, fan=2)
        if epoch in (1, 4):
            enrich_batch(frame, epoch, out, RUN, fan=2)
        if epoch % 2:
            changes = changes_stream(spark, out)
            finish(summaries_stream(changes, out, path, str(tmp_path / "c")))
    assert_same_tables(read_summaries(spark, path), enrich(whole, RUN))
    # A repeated update changes nothing.
    days = [r[0] for r in read_incremental(spark, out).select(F.to_date("collected_at")).distinct().collect()]
    update_partials(spark, out, path, days)
    assert_same_tables(read_summaries(spark, path), enrich(whole, RUN))


def test_unchanged_days_are_not_read(spark, raw, tmp_path):
    out, path = str(tmp_path / "out"), str(tmp_path / "partials")
    frames = [raw({"id": f"s{d}", "user_id": "u", "collected_at": f"2026-01-0{d}T10:00:00Z", "viewer_count": d})
              for d in (1, 2)]
    for epoch, frame in enumerate(frames):
        enrich_batch(frame, epoch, out, RUN)
    finish(summaries_stream(changes_stream(spark, out), out, path, str(tmp_path / "c")))
    for file in files(f"{out}/rows"):
        if "_day=2026-01-01" in file:
            os.remove(file)
    late = raw({"id": "new", "user_id": "v", "collected_at": "2026-01-02T10:00:00Z", "viewer_count": 9})
    enrich_batch(late, 2, out, RUN)
    finish(summaries_stream(changes_stream(spark, out), out, path, str(tmp_path / "c")))
    whole = frames[0].unionByName(frames[1]).unionByName(late)
    assert_same_tables(read_summaries(spark, path), enrich(whole, RUN))
    with pytest.raises(FileNotFoundError):
        read_summaries(spark, str(tmp_path / "none"))


def test_sketches_merge_and_stay_within_their_bound(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 20_011).cast("string").alias("user_id"),
        F.lit("l").alias("user_login"), F.lit("n").alias("user_name"), F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, "en").when(F.col("id") % 3 == 1, "de").alias("language"),
        F.when(F.col("id") % 1000 == 0, "rare").otherwise("go").alias("game_name"),
        (F.col("id") % 4).cast("int").alias("snapshot_hour_utc"), (F.col("id") % 2 == 0).alias("is_mature"),
        F.timestamp_seconds(F.col("id") * 60).alias("collected_at"), (F.col("id") % 77).alias("viewer_count"),
    )
    folded = pre_aggregate(measures(prepare(rows)))
    halves = [sketches.sketch_aggregate(folded.where(w)) for w in ("snapshot_hour_utc < 2", "snapshot_hour_utc >= 2")]
    sketched = halves[0].unionByName(halves[1]).cache()
    exact = build_summaries(rows)
    pairs = {
        "language_hourly_summary": exact["language_hourly_summary"],
        "game_hourly_summary": exact["game_hourly_summary"],
        "games_by_streamers": explore.games_by_streamers(rows),
        "languages_by_streamers": explore.languages_by_streamers(rows),
        "audience_split": explore.audience_split(rows),
    }
    for name, want in pairs.items():
        got = sketches.TABLES[name](sketched)
        assert got.columns == want.columns, name
        assert rounded(got.drop("unique_streamers").orderBy("peak_viewers")) == rounded(
            want.drop("unique_streamers").orderBy("peak_viewers")
        ), name
        keys = [c for c in want.columns if c in ("language", "game_name", "snapshot_hour_utc", "audience_type")]
        counts = {tuple(r[k] for k in keys): r["unique_streamers"] for r in want.collect()}
        for r in got.collect():
            n = counts[tuple(r[k] for k in keys)]
            assert math.isclose(r["unique_streamers"], n, rel_tol=sketches.BOUND), name
            # Small counts are exact.
            assert n > 100 or r["unique_streamers"] == n


def test_follow_pipeline_equals_the_recomputing_one(spark, tmp_path):
    table = "follow_facts"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    paths = Paths.under(str(tmp_path))
    steps = [
        [page("2026-01-01T10:00:00Z", 1, [("a", "chess", 5), ("b", "go", 9)]),
         page("2026-01-01T10:00:00Z", 2, [("b", "go", 10)], None)],
        # The second run lands in two parts, and a run of the day before comes late.
        [page("2026-01-02T10:00:00Z", 1, [("a", "chess", 8)]),
         page("2025-12-31T10:00:00Z", 1, [("a", "go", 1), ("c", "go", 2)], None)],
        [page("2026-01-02T10:00:00Z", 2, [("c", "chess", 3)], None)],
    ]
    for pages in steps:
        land(tmp_path / "landing", *pages)
        done = follow_pipeline(spark, paths, RUN, table)
    assert len(done) == 9
    # Nothing new: nothing changes.
    assert follow_pipeline(spark, paths, RUN, table) == done
    out = f"{paths.enriched}.incremental"
    want = enrich(read_raw(spark, f"{out}/raw").drop("batch_id"), RUN)
    assert rounded(read_incremental(spark, f"{out}/table").select(*want.columns)) == rounded(want)
    assert rounded(spark.table(table).select(*to_fact(want).columns)) == rounded(to_fact(want))
    for name, expected in build_summaries(want).items():
        assert rounded(read_summary(spark, paths.summaries, name)) == rounded(expected), name
    health = build_summaries(want)["collection_health_summary"]
    assert rounded(read_health(spark, f"{out}/health")) == rounded(health)
    rough = read_approximate(spark, f"{out}/partials")
    assert rounded(rough["audience_split"]) == rounded(explore.audience_split(want))
