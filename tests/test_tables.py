import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airwave.operators.dedupe import drop_duplicate_snapshots, union_growing
from airwave.plans.enrich import enrich
from airwave.plans.fact import (
    fact_count,
    latest_batch,
    load_latest_batch,
    newest,
    run_sql,
    to_fact,
    top_snapshots,
)
from airwave.plans.pipeline import (
    Paths,
    enrich_job,
    ingest_job,
    load_latest_batch_job,
    run_pipeline,
)
from airwave.schema import FACT, PAYLOAD_STREAM, RAW_COLUMNS, SNAPSHOT_ORDER
from airwave.sinks import fact as fact_sink
from airwave.sinks.fact import ensure_table, insert_batch
from airwave.sinks.tables import append_raw, write_enriched, write_json, write_summaries
from airwave.plans.summaries import build_summaries
from airwave.sources.payload import read_categories, read_pages, snapshot_rows
from airwave.sources.snapshots import (
    csv_layouts,
    enriched_days,
    preview,
    read_enriched,
    read_raw,
    read_raw_csv,
    read_summary,
    reorder,
    require_rows,
)
from airwave.streaming.ingest import ingest_stream
from test_ledger import spoil
from test_streaming import finish, land, page, same

RUN = "2026-01-09T00:00:00Z"
T1, T2 = "2026-01-01T23:50:00Z", "2026-01-02T00:00:00Z"


def test_pages_stop_at_the_first_empty_or_last_page(spark, tmp_path, local):
    land(
        tmp_path / "in",
        page("2026-01-01T10:00:00Z", 1, [("a", "go", 5)]),
        page("2026-01-01T10:00:00Z", 2, []),
        page("2026-01-01T10:00:00Z", 3, [("b", "go", 5)]),
        page("2026-01-01T11:00:00Z", 1, [("c", "go", 5), ("d", "go", 6)]),
        page("2026-01-01T11:00:00Z", 2, [("e", "go", 5)], None),
        page("2026-01-01T11:00:00Z", 3, [("f", "go", 5)]),
        *[page("2026-01-01T12:00:00Z", i, [(f"p{i}", "go", i)]) for i in range(1, 5)],
    )
    pages = read_pages(spark, str(tmp_path / "in"))
    rows = local(snapshot_rows(pages, 3), "ingest_seq")
    assert [r["id"] for r in rows] == ["a", "c", "d", "e", "p1", "p2", "p3"]
    assert rows[0]["collected_at"] == "2026-01-01T10:00:00Z" and rows[0]["tags"] == "a, b"
    assert rows[0]["tag_ids"] is None and len({r["ingest_seq"] for r in rows}) == 7


def test_landed_pages_are_all_read(spark, tmp_path, local):
    time = "2026-01-01T10:00:00Z"
    land(tmp_path / "in", *[page(time, i, [(f"p{i}", "go", i)]) for i in range(1, 13)])
    # Runs without a time cannot be told apart, so none ends another.
    for i, cursor in ((1, None), (2, "next")):
        one = {**page("x", i, [(f"q{i}", "go", i)], cursor), "run_ts": None}
        (tmp_path / "in" / f"unknown{i}.json").write_text(json.dumps(one))
    rows = local(snapshot_rows(read_pages(spark, str(tmp_path / "in"))))
    assert {r["id"] for r in rows} == {f"p{i}" for i in range(1, 13)} | {"q1", "q2"}


def test_broken_pages_and_overlapping_numbers_are_errors(spark, tmp_path):
    land(tmp_path / "in", page("2026-01-01T10:00:00Z", 1, [("a", "go", 5)]))
    (tmp_path / "in" / "half.json").write_text('{"run_ts": "2026-01-01T10:00:00Z", "page_no": 2, "da')
    with pytest.raises(Exception, match="(?i)malformed"):
        snapshot_rows(read_pages(spark, str(tmp_path / "in"))).collect()
    land(tmp_path / "far", page("2026-01-01T10:00:00Z", 1 << 15, [("a", "go", 5)]))
    with pytest.raises(Exception, match="page_no is not between"):
        snapshot_rows(read_pages(spark, str(tmp_path / "far"))).collect()


def test_csv_files_with_different_headers(spark, tmp_path, local):
    (tmp_path / "a.csv").write_text("id,title,viewer_count\n1,one,5\n")
    (tmp_path / "b.csv").write_text("title,id,viewer_count,mood\ntwo,2,6,calm\n")
    for multi_line in (True, False):
        rows = local(read_raw_csv(spark, str(tmp_path), multi_line), "id")
        assert [(r["id"], r["title"], r["viewer_count"], r["mood"]) for r in rows] == [
            ("1", "one", "5", None), ("2", "two", "6", "calm")
        ]
        assert len({r["ingest_seq"] for r in rows}) == 2


def test_page_without_a_readable_time_keeps_its_rows(spark, tmp_path, local):
    land(tmp_path / "in", {**page("x", 1, [("a", "go", 5)], None), "run_ts": None})
    rows = local(snapshot_rows(read_pages(spark, str(tmp_path / "in"))))
    assert [(r["id"], r["collected_at"]) for r in rows] == [("a", None)]


def test_new_api_fields_grow_the_raw_table(spark, tmp_path, local):
    wider = T.StructType([*PAYLOAD_STREAM.fields, T.StructField("mood", T.StringType())])
    old, new = page("2026-01-01T10:00:00Z", 1, [("a", "go", 5)], None), page(
        "2026-01-01T11:00:00Z", 1, [("b", "go", 6)], None
    )
    new["data"][0]["mood"] = "calm"
    land(tmp_path / "one", old)
    land(tmp_path / "two", new)
    raw = str(tmp_path / "raw")
    assert append_raw(snapshot_rows(read_pages(spark, str(tmp_path / "one"))), raw) == 1
    assert append_raw(snapshot_rows(read_pages(spark, str(tmp_path / "two"), wider)), raw) == 1
    rows = local(read_raw(spark, raw, merge_schema=True), "id")
    assert [r["mood"] for r in rows] == [None, "calm"]
    # New fields reach the enriched table.
    enriched = enrich_job(spark, raw, str(tmp_path / "enriched"), RUN)
    moods = local(read_enriched(spark, enriched), "id")
    assert [r["mood"] for r in moods] == [None, "calm"]
    known = read_raw(spark, raw)
    assert known.columns == [*RAW_COLUMNS, "ingest_seq"] and known.count() == 2


def test_empty_batches(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    nothing = raw({"id": 1}).limit(0)
    with pytest.raises(ValueError):
        append_raw(nothing, path)
    assert append_raw(nothing, path, on_empty="skip") == 0
    with pytest.raises(FileNotFoundError):
        read_raw(spark, path)
    with pytest.raises(ValueError):
        append_raw(nothing, path, on_empty="maybe")
    with pytest.raises(ValueError):
        require_rows(nothing, "it")


def test_csv_with_quotes_commas_and_line_breaks(spark, tmp_path, local):
    text = (
        "id,title,game_name,collected_at,viewer_count\n"
        '1,"a ""q"", b\nc",NA,2026-01-01T00:00:00Z,5\n'
        '2,,null,2026-01-01T00:00:00Z,"6"\n'
    )
    (tmp_path / "raw.csv").write_text(text)
    rows = local(read_raw_csv(spark, str(tmp_path / "raw.csv")), "ingest_seq")
    assert rows[0]["title"] == 'a "q", b\nc' and rows[0]["game_name"] == "NA"
    assert rows[1]["title"] is None and rows[1]["game_name"] == "null"
    (tmp_path / "empty.csv").write_text("id,title\n")
    with pytest.raises(ValueError):
        read_raw_csv(spark, str(tmp_path / "empty.csv"))
    with pytest.raises(FileNotFoundError):
        read_raw_csv(spark, str(tmp_path / "none.csv"))


def test_enriched_and_summaries_survive_storage(spark, raw, tmp_path):
    source = raw(
        {"id": 1, "collected_at": T1, "viewer_count": 5, "title": 'a "b", c', "user_name": "x"},
        {"id": 2, "collected_at": T1, "viewer_count": 9},
        {"id": 1, "collected_at": T2, "viewer_count": 8},
    )
    df = enrich(source, RUN).cache()
    path = write_enriched(df, str(tmp_path / "enriched"))
    assert same(df, read_enriched(spark, path))
    assert write_enriched(df.limit(1), path) == path and read_enriched(spark, path).count() == 1

    export = str(tmp_path / "export")
    df.write.options(header="true", escape='"').csv(export)
    as_text = read_enriched(spark, export, "csv").select("id", "viewer_rank_in_snapshot", "title")
    assert sorted(map(tuple, as_text.collect())) == [
        ("1", 1, None), ("1", 2, 'a "b", c'), ("2", 1, None)
    ]

    tables = build_summaries(df)
    paths = write_summaries(tables, str(tmp_path / "out"))
    assert [p.rsplit("/", 1)[1] for p in paths] == list(tables)
    for name, table in tables.items():
        again = read_summary(spark, str(tmp_path / "out"), name)
        assert again.columns == table.columns
        assert sorted(map(repr, again.collect())) == sorted(map(repr, table.collect())), name


def test_categories_and_json(spark, tmp_path, local):
    names = ["go", "chess", "日本"]
    document = {"data": [{"id": str(i), "name": n, "box_art_url": "u"} for i, n in enumerate(names)]}
    (tmp_path / "top.json").write_text(json.dumps(document, indent=2))
    top = read_categories(spark, str(tmp_path / "top.json"), 2)
    assert [r["name"] for r in local(top, "position")] == ["go", "chess"]
    everything = read_categories(spark, str(tmp_path / "top.json"))
    path = write_json(everything, str(tmp_path / "dump"))
    assert [r["name"] for r in local(spark.read.json(path), "position")] == names
    (tmp_path / "half.json").write_text('{"data": [{"id": "1", "na')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_categories(spark, str(tmp_path / "*.json")).collect()


def test_reorder_preview_union_and_keyless_dedupe(spark):
    df = spark.createDataFrame([(1, 2, 3)], "zzz int, collected_at int, id int")
    assert reorder(df, SNAPSHOT_ORDER).columns == ["id", "collected_at", "zzz"]
    assert preview(spark.range(9)).count() == 5
    other = spark.createDataFrame([(4, 5)], "id int, extra int")
    assert union_growing(df, other).columns == ["zzz", "collected_at", "id", "extra"]
    twice = spark.createDataFrame([(1,), (1,)], "v int")
    assert drop_duplicate_snapshots(twice, [F.col("v")]).count() == 2
    only_time = spark.createDataFrame([(1, 5), (1, 3)], "collected_at int, v int")
    assert drop_duplicate_snapshots(only_time, [F.col("v")]).collect()[0]["v"] == 3


def test_fact_rows(spark, local):
    text = spark.createDataFrame(
        [("1", "2026-01-01T00:00:00.7Z", "x", "yes", "1.26", "bad"), ("2", "junk", "1", "1", "", "")],
        "id string, collected_at string, viewer_count string, is_mature string, "
        "stream_duration_minutes string, snapshot_hour_utc string",
    )
    fact = to_fact(text)
    assert fact.schema.fieldNames() == FACT.fieldNames()
    assert [f.dataType for f in fact.schema] == [f.dataType for f in FACT]
    row = local(fact)[0]
    assert fact.count() == 1 and row["collected_at"] == datetime(2026, 1, 1)
    assert row["viewer_count"] == 0 and row["is_mature"] is False and row["user_name"] == ""
    assert row["stream_duration_minutes"] == pytest.approx(1.26) and row["started_at"] is None
    assert row["snapshot_hour_utc"] is None and row["viewer_count_delta"] == 0.0
    with pytest.raises(ValueError):
        latest_batch(text.where("id = '2'"))


def test_load_is_idempotent_and_can_fill_gaps(spark, raw):
    table, database = "facts", "load_test_db"
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    rows = [{"id": i, "collected_at": t, "viewer_count": i} for i in range(3) for t in (T1, T2)]
    df = enrich(raw(*rows), RUN).cache()
    first = load_latest_batch(spark, df, table, database)
    assert first == {"status": "inserted", "rows": 3, "table": f"{database}.{table}",
                     "collected_at": "2026-01-02T00:00:00+00:00"}
    again = load_latest_batch(spark, df, table, database)
    assert (again["status"], again["rows"]) == ("skipped", 3)
    stored = spark.table(f"{database}.{table}")
    assert stored.count() == 3
    filled = load_latest_batch(spark, df, table, database, mode="all_missing")
    assert (filled["status"], filled["rows"]) == ("inserted", 3)
    assert load_latest_batch(spark, df, table, database, mode="all_missing")["rows"] == 0
    stored = spark.table(f"{database}.{table}")
    assert [str(r["collected_date"]) for r in
            stored.select("collected_date").distinct().orderBy("collected_date").collect()] == [
        "2026-01-01", "2026-01-02"]
    want = to_fact(df)
    assert stored.select(*want.columns).exceptAll(want).isEmpty()
    assert fact_count(spark, stored).first()["row_count"] == 6
    assert [r["viewer_count"] for r in top_snapshots(spark, stored).collect()] == [2, 2, 1, 1, 0, 0]
    picked = run_sql(spark, "SELECT id FROM {fact} WHERE viewer_count >= :least", stored, least=2)
    assert picked.count() == 2
    assert newest(stored).count() == 3
    assert ensure_table(spark, table, database) == f"{database}.{table}"
    with pytest.raises(ValueError):
        load_latest_batch(spark, df, table, database, mode="some")


def test_pipeline(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS pipeline_facts")
    paths = Paths.under(str(tmp_path))
    land(
        tmp_path / "landing",
        page("2026-01-01T10:00:00Z", 1, [("a", "chess", 5), ("b", "go", 9)]),
        page("2026-01-01T10:00:00Z", 2, [("b", "go", 10)], None),
        page("2026-01-01T10:10:00Z", 1, [("a", "chess", 8)], None),
    )
    done = run_pipeline(spark, paths, RUN, "pipeline_facts")
    assert done["ingested"] == 4 and len(done["summaries"]) == 9
    assert done["loaded"]["status"] == "inserted" and done["loaded"]["rows"] == 1
    games = read_summary(spark, paths.summaries, "top_games_summary").collect()
    assert [(r["game_name"], r["snapshots"], r["avg_viewers"]) for r in games] == [
        ("go", 1, 9.0), ("chess", 2, 6.5),
    ]
    # Landing the same pages again changes nothing downstream.
    done = run_pipeline(spark, paths, RUN, "pipeline_facts")
    assert done["ingested"] == 0 and read_raw(spark, paths.raw).count() == 4
    assert read_enriched(spark, paths.enriched).count() == 3
    # Runs without a time share their landing numbers, yet none takes the other's place.
    for name in "xy":
        one = {**page("x", 1, [(name, "go", 5)], None), "run_ts": None}
        land(tmp_path / f"later{name}", {**one, "run_ts": "none"})
        (tmp_path / f"later{name}" / "none-1.json").write_text(json.dumps(one))
        assert ingest_job(spark, str(tmp_path / f"later{name}"), str(tmp_path / "other")) == 1
    assert read_raw(spark, str(tmp_path / "other")).count() == 2
    # A new run is added alone, and one layout holds what batch and stream write.
    land(tmp_path / "landing", page("2026-01-01T10:20:00Z", 1, [("c", "go", 1)], None))
    assert ingest_job(spark, paths.landing, paths.raw) == 1
    finish(ingest_stream(spark, paths.landing, paths.raw, str(tmp_path / "c")))
    assert read_raw(spark, paths.raw).count() == 5 + 5
    assert done["loaded"]["status"] == "skipped"


def test_half_written_batches_are_replaced_and_whole_ones_committed(spark, raw):
    table = "commit_facts"
    for name in (table, f"{table}_commits"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = [{"id": i, "collected_at": t, "viewer_count": i} for i in range(4) for t in (T1, T2)]
    df = enrich(raw(*rows), RUN).cache()
    want = to_fact(df)
    ensure_table(spark, table)
    # A load of the newest batch stopped between two files; the one of the batch before did not.
    for t, kept in ((T2, "id < '2'"), (T1, "true")):
        part = want.where(F.col("collected_at") == t.rstrip("Z")).where(kept)
        assert insert_batch(part, table) == part.count()
    assert load_latest_batch(spark, df, table)["status"] == "replaced"
    spark.catalog.refreshTable(table)
    assert same(want, spark.table(table))
    assert load_latest_batch(spark, df, table) == {
        "status": "skipped", "rows": 4, "table": table, "collected_at": "2026-01-02T00:00:00+00:00"}
    # All rows are there, so only the commit is missing.
    assert load_latest_batch(spark, df, table, mode="all_missing")["status"] == "skipped"
    found = spark.table(f"{table}_commits").orderBy("collected_at").collect()
    assert [(str(r["collected_at"]), r["rows"]) for r in found] == [
        ("2026-01-01 23:50:00", 4), ("2026-01-02 00:00:00", 4)]
    assert same(want, spark.table(table))


def test_a_stopped_load_is_repeated(spark, raw, monkeypatch):
    table = "stopped_facts"
    for name in (table, f"{table}_commits"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = enrich(raw(*[{"id": i, "collected_at": T1, "viewer_count": i} for i in range(6)]), RUN).cache()
    real = fact_sink.insert_batch

    def half(fact, name):
        real(fact.where("viewer_count < 3"), name)
        raise RuntimeError("stopped between files")

    monkeypatch.setattr(fact_sink, "insert_batch", half)
    with pytest.raises(RuntimeError):
        load_latest_batch(spark, df, table)
    monkeypatch.setattr(fact_sink, "insert_batch", real)
    assert spark.table(table).count() == 3
    assert load_latest_batch(spark, df, table)["rows"] == 6
    spark.catalog.refreshTable(table)
    assert same(to_fact(df), spark.table(table))


def test_the_load_job_opens_files_of_the_newest_day_only(spark, raw, tmp_path):
    for name in ("day_facts", "day_facts_commits"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    times = [f"2026-01-0{d}T10:00:00Z" for d in (1, 2, 3)]
    df = enrich(raw(*[{"id": 1, "collected_at": t, "viewer_count": 5} for t in times]), RUN)
    path = write_enriched(df, str(tmp_path / "enriched"))
    for day in ("2026-01-01", "2026-01-02"):
        spoil(f"{path}/snapshot_date={day}", ".parquet")
    assert enriched_days(spark, path) == ["2026-01-01", "2026-01-02", "2026-01-03"]
    done = load_latest_batch_job(spark, path, "day_facts")
    assert (done["status"], done["rows"]) == ("inserted", 1)
    rows = read_enriched(spark, path, days=["2026-01-03"])
    batch, _ = latest_batch(rows, day="2026-01-03")
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_csv_headers_of_many_files_are_read_in_one_job(spark, tmp_path, local):
    context = spark.sparkContext
    jobs = {}
    for number in (3, 60):
        folder = tmp_path / str(number)
        folder.mkdir()
        for i in range(number):
            names = "id,title" if i % 2 else "title,id,mood"
            row = f"{i},t" if i % 2 else f"t,{i},calm"
            (folder / f"f{i:03d}.csv").write_text(f"\n{names}\n{row}\n")
        context.setJobGroup(f"csv{number}", "")
        rows = read_raw_csv(spark, str(folder))
        jobs[number] = len(context.statusTracker().getJobIdsForGroup(f"csv{number}"))
        context.setLocalProperty("spark.jobGroup.id", None)
        assert sorted(int(r["id"]) for r in rows.collect()) == list(range(number))
        assert {r["mood"] for r in rows.collect()} == {None, "calm"}
    assert jobs[60] <= jobs[3] + 2
    # Only the file whose fields hold line breaks is not split.
    (tmp_path / "3" / "more.csv").write_text('id,title\n9,"a\nb"\n8,"say ""x"""\n')
    found = {r["id"]: r["title"] for r in read_raw_csv(spark, str(tmp_path / "3")).collect()}
    assert found["9"] == "a\nb" and found["8"] == 'say "x"' and found["1"] == "t"
    layouts = csv_layouts(spark, str(tmp_path / "3")).where("line_breaks").collect()
    assert [r["file"].rsplit("/", 1)[1] for r in layouts] == ["more.csv"]
