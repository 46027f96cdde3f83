"""Time the headline queries; prints one JSON line.

Each query is built and run to completion once to warm up and then timed; the time includes building
and planning.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from airwave.checks.queries import registered  # noqa: E402
from airwave.session import build_session  # noqa: E402

HEADLINE = [
    "enrich_base",
    "dedupe_snapshots",
    "viewer_rank",
    "stream_history",
    "top_games_summary",
    "streamer_summary",
    "language_summary",
    "language_hourly_summary",
    "game_hourly_summary",
    "hourly_summary",
    "maturity_summary",
    "collection_health_summary",
    "fastest_growing_streams",
    "games_by_streamers",
    "languages_by_streamers",
    "audience_split",
    "top_streamers",
    "full_batch_timeline",
    "tracked_timeline",
    "top_games_hourly",
    "games_by_total",
    "languages_by_total",
    "viewer_describe",
    "viewer_histogram",
    "viewer_density",
    "mature_split",
    "fact_count",
    "top_snapshots",
    "hourly_rounded",
    "games_rounded",
    "latest_batch",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, directory).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in HEADLINE:
        run(name)
    seconds = {name: run(name) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(directory).name.removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
