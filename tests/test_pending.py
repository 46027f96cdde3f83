"""Runs whose pages land over several triggers."""

import os

from airwave.sources.payload import raw_projection, read_pages, snapshot_rows
from airwave.sources.snapshots import read_raw
from airwave.streaming.ingest import ingest_stream, take_runs
from test_streaming import finish, land, page, same

R1, R2, R3 = (f"2026-01-01T{h}:00Z" for h in ("10:00", "10:10", "11:00"))


def ids(spark, raw):
    if not os.path.exists(raw):
        return []
    try:
        return sorted(r["id"] for r in read_raw(spark, raw).collect())
    except ValueError:
        return []


def test_a_run_split_over_three_triggers_equals_the_batch_result(spark, tmp_path):
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")
    # The last page lands first, a page after the end second, the pages between last.
    steps = [
        [page(R1, 3, [("c", "go", 3)], None)],
        [page(R1, 4, [("z", "go", 9)]), page(R1, 1, [("a", "go", 1)])],
        [page(R1, 2, [("b", "go", 2)])],
    ]
    seen = []
    for pages in steps:
        land(landing, *pages)
        finish(ingest_stream(spark, str(landing), raw, str(tmp_path / "c")))
        seen.append(ids(spark, raw))
    assert seen == [[], [], ["a", "b", "c"]]
    want = snapshot_rows(read_pages(spark, str(landing)))
    assert same(raw_projection(want), read_raw(spark, raw))
    # What still lands after the end stays out.
    land(landing, page(R1, 5, [("y", "go", 9)]))
    finish(ingest_stream(spark, str(landing), raw, str(tmp_path / "c")))
    assert ids(spark, raw) == ["a", "b", "c"]


def test_incomplete_runs_are_taken_after_the_waiting_time(spark, tmp_path):
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")

    def step(*pages, **settings):
        land(landing, *pages)
        finish(ingest_stream(spark, str(landing), raw, str(tmp_path / "c"), **settings))
        return ids(spark, raw)

    assert step(page(R1, 1, [("a", "go", 1)])) == []
    # Ten minutes later is not late enough; a run without a readable time does not wait.
    assert step(page(R2, 1, [("b", "go", 1)], None), page("x", 1, [("u", "go", 1)])) == ["b", "u"]
    assert step(page(R3, 1, [("c", "go", 1)])) == ["a", "b", "u"]
    # The rest of the first run comes after it was taken.
    assert step(page(R1, 2, [("a2", "go", 1)], None), page(R1, 3, [("a3", "go", 1)])) == ["a", "a2", "b", "u"]
    # Enough pages make a run complete.
    assert step(page(R3, 2, [("c2", "go", 1)]), max_pages=2) == ["a", "a2", "b", "c", "c2", "u"]
    assert len(os.listdir(f"{raw}.pending")) <= 2 and len(os.listdir(f"{raw}.runs")) <= 2


def test_a_repeated_micro_batch_replaces_itself(spark, tmp_path):
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")
    land(landing / "0", page(R1, 1, [("a", "go", 1)]))
    land(landing / "1", page(R1, 2, [("b", "go", 1)], None), page(R2, 1, [("c", "go", 1)]))
    land(landing / "2", page(R2, 2, []))
    for epoch in (0, 1, 1, 2, 2):
        take_runs(read_pages(spark, str(landing / str(epoch))), epoch, raw)
    assert ids(spark, raw) == ["a", "b", "c"]
    assert same(read_raw(spark, raw), read_raw(spark, raw).distinct())
