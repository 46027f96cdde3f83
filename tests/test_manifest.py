"""Live folders of the incremental table: merges, pruned reads, recovery, random orders of arrival."""

import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from airwave.plans.enrich import enrich
from airwave.streaming.enrich import changes_stream, enrich_batch, read_incremental
from airwave.streaming.manifest import Folder, due, read_manifest, rows_of
from test_streaming import RUN, batch_result, finish, same, snapshot


def files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_merges_keep_folders_few_and_in_order():
    live, written = [], 0
    for epoch in range(300):
        live.append(Folder("2026-01-01", epoch, 0, f"r{epoch}"))
        for old in due(live, 8).values():
            assert old == sorted(live)[-len(old):]
            written += len(old)
            live = [f for f in live if f not in old]
            live.append(Folder("2026-01-01", epoch, max(f.level for f in old) + 1, f"m{epoch}"))
        assert len(live) <= 7 * 3
        levels = [f.level for f in sorted(live, key=lambda f: f.epoch)]
        assert levels == sorted(levels, reverse=True)
    assert written < 350
    assert due([Folder("a", 1, 0, "x"), Folder("b", 2, 0, "y")], 2) == {}


def random_frames(raw, seed, number):
    """Micro-batches over four days: late, split and repeated rows, null ids, times that cannot be read."""
    draw = random.Random(seed)
    frames, seq = [], 0
    for step in range(number):
        rows = []
        for _ in range(draw.randrange(1, 9)):
            day = min(4, max(1, 1 + step * 4 // number + draw.choice([-2, -1, 0, 0, 0])))
            time = f"2026-01-0{day}T{draw.choice([0, 6, 23]):02d}:00:00Z"
            time = draw.choice([time] * 8 + ["junk", None])
            rows.append({"id": draw.choice(["a", "b", "c", None]), "collected_at": time,
                         "viewer_count": draw.randrange(9), "title": f"t{draw.randrange(99)}"})
        frame = raw(*rows).withColumn("ingest_seq", F.col("ingest_seq") + seq)
        seq += 100
        frames.append(frame)
    return frames


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_equals_one_run(spark, raw, tmp_path, seed):
    frames = random_frames(raw, seed, 9)
    out = str(tmp_path / "out")
    for epoch, frame in enumerate(frames):
        enrich_batch(frame, epoch, out, RUN, compact_every=4, fan=2, kept=2)
        if epoch == 5:
            enrich_batch(frame, epoch, out, RUN, compact_every=4, fan=2, kept=2)
    assert same(batch_result(frames), read_incremental(spark, out))
    # Live folders only, but for those that the manifest before still names, or the last merges replaced.
    last = read_manifest(spark, out)
    named = {f.path for m in (last, read_manifest(spark, out, 8)) for f in m.folders} | {*last.replaced}
    found = {os.path.relpath(os.path.dirname(f), out) for f in files(f"{out}/rows") + files(f"{out}/merged")}
    assert found == named
    assert sorted(os.listdir(f"{out}/manifest")) == ["epoch=7", "epoch=8"]
    assert len(os.listdir(f"{out}/state")) <= 2


def test_a_micro_batch_reads_files_of_touched_days_only(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    frames = [snapshot(raw, f"2026-01-0{d}T10:00:00Z", {f"s{d}": d, "long": 5 + d}, 100 * d)
              for d in range(1, 6)]
    for epoch, frame in enumerate(frames):
        enrich_batch(frame, epoch, out, RUN)
    # Nothing of the other days can be read any more, not even a footer.
    for file in files(f"{out}/rows"):
        if "_day=2026-01-03" not in file:
            os.remove(os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc"))
            with open(file, "wb") as damaged:
                damaged.write(b"PAR1 no footer PAR1")
    late = snapshot(raw, "2026-01-03T10:00:00Z", {"s3": 9, "new": 7}, 900)
    enrich_batch(late, 5, out, RUN)
    day = [date(2026, 1, 3)]
    want = enrich(frames[2].unionByName(late), RUN).where("id <> 'long'")
    got = read_incremental(spark, out, day)
    assert same(want, got.where("id <> 'long'"))
    row = got.where("id = 'long'").first()
    # Its history was kept, its rank is new: 9 and 7 are above it... the counts are 8, 3 (first landed) and 7.
    assert (row["previous_viewer_count"], row["stream_snapshot_number"]) == (7, 3)
    assert row["viewer_rank_in_snapshot"] == 1
    listed = rows_of(spark, out, read_manifest(spark, out), day).inputFiles()
    assert listed and all("_day=2026-01-03" in f for f in listed)
    assert read_incremental(spark, out, [date(2025, 1, 1)]).isEmpty()


def test_unfinished_micro_batches_are_not_seen(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    first = snapshot(raw, "2026-01-01T10:00:00Z", {"a": 1})
    second = snapshot(raw, "2026-01-01T11:00:00Z", {"a": 2}, 100)
    enrich_batch(first, 0, out, RUN)
    enrich_batch(second, 1, out, RUN)
    os.remove(f"{out}/manifest/epoch=1/_SUCCESS")
    assert same(batch_result([first]), read_incremental(spark, out))
    enrich_batch(second, 1, out, RUN)
    assert same(batch_result([first, second]), read_incremental(spark, out))


def test_tables_from_before_manifests_go_on(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    first = snapshot(raw, "2026-01-01T10:00:00Z", {"a": 1, "b": 2})
    second = snapshot(raw, "2026-01-01T11:00:00Z", {"a": 2}, 100)
    third = snapshot(raw, "2026-01-01T10:00:00Z", {"c": 3, "b": 4}, 200)
    for epoch, frame in enumerate([first, second]):
        enrich_batch(frame, epoch, out, RUN)
    for epoch in (-1, 0, 1):
        for name in os.listdir(f"{out}/manifest/epoch={epoch}"):
            os.remove(f"{out}/manifest/epoch={epoch}/{name}")
        os.rmdir(f"{out}/manifest/epoch={epoch}")
    assert same(batch_result([first, second]), read_incremental(spark, out))
    enrich_batch(third, 2, out, RUN)
    assert same(batch_result([first, second, third]), read_incremental(spark, out))


def test_changes_name_the_touched_batches(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    enrich_batch(snapshot(raw, "2026-01-01T10:00:00Z", {"a": 1, "b": 2}), 0, out, RUN)
    enrich_batch(snapshot(raw, "2026-01-01T11:00:00Z", {"a": 2}, 100), 1, out, RUN)
    # A late row of `a` changes the history of its later row, and the batch it belongs to.
    enrich_batch(snapshot(raw, "2026-01-01T09:00:00Z", {"a": 3}, 200), 2, out, RUN)
    seen = {}

    def note(batch, _):
        for r in batch.collect():
            seen.setdefault(r["batch_id"], set()).add(r["collected_at"].hour)

    stream = changes_stream(spark, out).writeStream.foreachBatch(note)
    finish(stream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    assert seen == {0: {10}, 1: {11}, 2: {9, 10, 11}}
