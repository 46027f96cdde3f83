"""Ingest once: the ledger of landed pages."""

import os

import pytest

from airwave.plans import pipeline
from airwave.plans.pipeline import ingest_job
from airwave.sinks import ledger
from airwave.sources.snapshots import read_raw
from test_streaming import land, page


def spoil(folder, end):
    """Replace the content of files by as many bytes that cannot be read."""
    for d, _, names in os.walk(folder):
        for name in names:
            if name.endswith(end):
                path = os.path.join(d, name)
                with open(path, "rb") as f:
                    size = len(f.read())
                crc = os.path.join(d, f".{name}.crc")
                if os.path.exists(crc):
                    os.remove(crc)
                with open(path, "wb") as f:
                    f.write(b"{" * size)


def counts(spark, raw):
    rows = read_raw(spark, raw).groupBy("id").count().collect()
    return {r["id"]: r["count"] for r in rows}


def test_a_new_run_reads_neither_old_pages_nor_raw_rows(spark, tmp_path):
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")
    runs = [f"2026-01-01T{h:02d}:{m:02d}:00Z" for h in range(10) for m in range(0, 60, 10)]
    land(landing, *[page(run, 1, [(f"s{i}", "go", i)], None) for i, run in enumerate(runs)])
    assert ingest_job(spark, str(landing), raw) == len(runs)
    spoil(landing, ".json")
    spoil(raw, ".parquet")
    assert ingest_job(spark, str(landing), raw) == 0
    land(landing, page("2026-01-02T00:00:00Z", 1, [("new", "go", 1), ("more", "go", 2)], None))
    assert ingest_job(spark, str(landing), raw) == 2
    assert ingest_job(spark, str(landing), raw) == 0


def test_run_ends_are_remembered_and_pages_under_other_names_are_known(spark, tmp_path):
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")
    run = "2026-01-01T10:00:00Z"
    land(landing, page(run, 1, [("a", "go", 1)]), page(run, 2, [("b", "go", 2)], None))
    assert ingest_job(spark, str(landing), raw) == 2
    # A page after the run's end, then a known page in another file with one more row.
    land(landing, page(run, 3, [("z", "go", 3)]))
    land(landing / "..", page(run, 1, [("a", "go", 1), ("late", "go", 4)]))
    os.rename(tmp_path / f"{run}-1.json".replace(":", ""), landing / "again.json")
    assert ingest_job(spark, str(landing), raw) == 1
    assert counts(spark, raw) == {"a": 1, "b": 1, "late": 1}
    assert ingest_job(spark, str(landing), raw) == 0


def test_an_unfinished_write_is_repeated(spark, tmp_path):
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")
    land(landing, page("2026-01-01T10:00:00Z", 1, [("a", "go", 1)], None))
    assert ingest_job(spark, str(landing), raw) == 1
    land(landing, page("2026-01-01T11:00:00Z", 1, [("b", "go", 1)], None))

    def stopped(rows, path, on_empty="error", number=None):
        raise RuntimeError("stopped before the rows were written")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pipeline, "append_raw", stopped)
        with pytest.raises(RuntimeError):
            ingest_job(spark, str(landing), raw)
    assert len(os.listdir(ledger.ledger_of(raw))) == 2
    assert ingest_job(spark, str(landing), raw) == 1
    assert counts(spark, raw) == {"a": 1, "b": 1}


def test_tables_older_than_their_ledger_and_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pipeline, "MANY_FILES", 1)
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")
    first = [page(f"2026-01-01T1{i}:00:00Z", 1, [(f"a{i}", "go", 1)], None) for i in range(3)]
    land(landing, *first)
    assert ingest_job(spark, str(landing), raw) == 3
    os.rename(ledger.ledger_of(raw), tmp_path / "gone")
    land(landing, page("2026-01-01T20:00:00Z", 1, [("b", "go", 1)], None),
         page("2026-01-01T21:00:00Z", 1, [("c", "go", 1)], None))
    assert ingest_job(spark, str(landing), raw) == 2
    assert counts(spark, raw) == {"a0": 1, "a1": 1, "a2": 1, "b": 1, "c": 1}
    assert ingest_job(spark, str(landing), raw) == 0


def test_entries_are_put_together(spark, tmp_path):
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")
    for i in range(4):
        land(landing, page(f"2026-01-01T1{i}:00:00Z", 1, [(f"a{i}", "go", 1)], None))
        assert ingest_job(spark, str(landing), raw) == 1
    ledger.settle(spark, raw, -5, many=3)
    assert os.listdir(ledger.ledger_of(raw)) == ["settled=-5"]
    assert ledger.read_ledger(spark, raw).count() == 4
    assert ingest_job(spark, str(landing), raw) == 0


def test_empty_pages(spark, tmp_path):
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")
    land(landing, page("2026-01-01T10:00:00Z", 1, []))
    with pytest.raises(ValueError):
        ingest_job(spark, str(landing), raw)
    assert ingest_job(spark, str(landing), raw, on_empty="skip") == 0
