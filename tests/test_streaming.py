import json

from pyspark.sql import functions as F

from airwave.plans.enrich import enrich
from airwave.sources.snapshots import read_raw
from airwave.streaming.enrich import enrich_batch, enrich_stream, read_incremental
from airwave.plans.fact import to_fact
from airwave.plans.summaries import collection_health_summary, prepare
from airwave.streaming.health import health_stream, read_health
from airwave.streaming.ingest import ingest_stream, raw_stream
from airwave.streaming.load import load_stream

RUN = "2026-01-09T00:00:00Z"


def page(run_ts, page_no, rows, cursor="next"):
    data = [{"id": i, "user_id": f"u{i}", "user_login": f"l{i}", "user_name": f"N{i}",
             "game_name": g, "viewer_count": v, "language": "en", "tags": ["a", "b"],
             "is_mature": False, "started_at": "2026-01-01T00:00:00Z"} for i, g, v in rows]
    return {"run_ts": run_ts, "page_no": page_no, "data": data, "pagination": {"cursor": cursor}}


def land(folder, *pages):
    folder.mkdir(parents=True, exist_ok=True)
    for p in pages:
        name = f"{p['run_ts']}-{p['page_no']}".replace(":", "")
        (folder / f"{name}.json").write_text(json.dumps(p))


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None


def same(a, b):
    """Equal as multisets of rows; each side runs once."""
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))


def snapshot(raw, time, counts, start=0):
    df = raw(*[{"id": i, "collected_at": time, "viewer_count": n} for i, n in counts.items()])
    return df.withColumn("ingest_seq", F.col("ingest_seq") + start)


STEPS = [
    ("2026-01-01T23:40:00Z", {"a": 5, "b": 9}),
    ("2026-01-01T23:50:00Z", {"a": 7, "c": 1}),
    ("2026-01-02T00:00:00Z", {"b": 3, "c": 1, "d": 8}),
    ("2026-01-03T00:00:00Z", {"a": 2, "b": 2}),
]


def steps(raw):
    return [snapshot(raw, t, counts, 100 * i) for i, (t, counts) in enumerate(STEPS)]


def batch_result(frames):
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return enrich(whole, RUN)


def run(frames, out, compact_every=2):
    for epoch, frame in enumerate(frames):
        enrich_batch(frame, epoch, out, RUN, compact_every)


def test_in_order_batches_equal_one_run(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    frames = steps(raw)
    run(frames, out)
    assert same(batch_result(frames), read_incremental(spark, out))
    # Nothing was worked out twice.
    assert spark.read.parquet(f"{out}/rows").count() == sum(len(counts) for _, counts in STEPS)


def test_late_split_and_repeated_rows_equal_one_run(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    first, second, third, last = steps(raw)
    # A row for a batch already seen, by a stream already newer, that displaces ranks and deltas,
    # and a repeat that landed before the row it repeats.
    late = snapshot(raw, STEPS[1][0], {"b": 6, "a": 70}, 50)
    frames = [first, third, second, last, late]
    run(frames, out)
    assert same(batch_result(frames), read_incremental(spark, out))


def test_unreadable_times_of_several_batches_equal_one_run(spark, raw, tmp_path):
    frames = [snapshot(raw, t, {"a": i, "b": 5}, 100 * i)
              for i, t in enumerate(["junk", "n/a", "junk", "2026-01-09T01:00:00Z"])]
    for epoch, frame in enumerate(frames):
        enrich_batch(frame, epoch, str(tmp_path), RUN)
    found = read_incremental(spark, str(tmp_path))
    assert found.count() == 6 and "_unread" not in found.columns
    assert same(found, batch_result(frames))


def test_replay_replaces_its_own_output(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    frames = steps(raw)
    run(frames[:3], out)
    enrich_batch(frames[2], 2, out, RUN, 2)
    enrich_batch(frames[2].limit(0), 3, out, RUN, 2)
    enrich_batch(frames[2].limit(0), 4, out, RUN, 2)
    enrich_batch(frames[3], 5, out, RUN, 2)
    assert same(batch_result(frames), read_incremental(spark, out))


def test_streams_end_to_end(spark, tmp_path):
    landing, rawp, out = tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "out")
    runs = [
        [page("2026-01-01T10:00:00Z", 1, [("a", "chess", 5), ("b", "go", 9)]),
         page("2026-01-01T10:00:00Z", 2, [("b", "go", 10), ("c", None, 1)], None),
         page("2026-01-01T10:00:00Z", 3, [("z", "go", 1)])],
        [page("2026-01-01T10:10:00Z", 1, [("a", "chess", 8), ("c", "go", 1)]),
         page("2026-01-01T10:10:00Z", 2, [])],
    ]
    table = "stream_fact_test"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    for pages in runs:
        land(landing, *pages)
        finish(ingest_stream(spark, str(landing), rawp, str(tmp_path / "c1")))
        finish(enrich_stream(raw_stream(spark, rawp), out, str(tmp_path / "c2"), RUN))
        schema = spark.read.parquet(f"{out}/rows").schema
        rows = spark.readStream.schema(schema).parquet(f"{out}/rows")
        finish(load_stream(rows, out, table, str(tmp_path / "c3")))
    assert same(enrich(read_raw(spark, rawp).drop("batch_id"), RUN), read_incremental(spark, out))
    loaded = spark.table(table).groupBy("collected_at").count().orderBy("collected_at").collect()
    assert [r["count"] for r in loaded] == [3, 2]
    # Another stream over the same rows changes nothing.
    rows = spark.readStream.schema(schema).parquet(f"{out}/rows")
    finish(load_stream(rows, out, table, str(tmp_path / "c4")))
    assert spark.table(table).count() == 5

    health = str(tmp_path / "health")
    finish(health_stream(rows, out, health, str(tmp_path / "c5")))
    found = read_health(spark, health).orderBy("collected_at").collect()
    assert [(r["rows_collected"], r["unique_streamers"], r["max_viewers"]) for r in found] == [
        (3, 3, 9), (2, 2, 8),
    ]


def test_load_and_health_follow_late_and_split_batches(spark, raw, tmp_path):
    """After every micro-batch, fact table and health equal the batch result of all rows so far."""
    out, health, table = str(tmp_path / "out"), str(tmp_path / "health"), "stream_fact_late"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    first, second, third, _ = steps(raw)
    half = second.where("id = 'a'")
    rest = second.where("id <> 'a'")
    late = snapshot(raw, STEPS[0][0], {"a": 70, "z": 4}, 50)
    seen = []
    for epoch, frame in enumerate([first, half, third, rest, late]):
        seen.append(frame)
        enrich_batch(frame, epoch, out, RUN, 2)
        schema = spark.read.parquet(f"{out}/rows").schema
        for start, number in ((load_stream, "c1"), (health_stream, "c2")):
            rows = spark.readStream.schema(schema).parquet(f"{out}/rows")
            place = str(tmp_path / number)
            finish(start(rows, out, table if start is load_stream else health, place))
    want = batch_result(seen)
    assert same(want, read_incremental(spark, out))
    assert same(to_fact(want), spark.table(table))
    assert same(collection_health_summary(prepare(want)), read_health(spark, health))


def test_new_fields_reach_the_incremental_table(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    first, second, *_ = steps(raw)
    frames = [first, second.withColumn("mood", F.lit("calm"))]
    run(frames, out)
    found = {(r["id"], r["viewer_count"]): r["mood"] for r in read_incremental(spark, out).collect()}
    assert found == {("a", 5): None, ("b", 9): None, ("a", 7): "calm", ("c", 1): "calm"}
