from datetime import datetime

import pytest
from pyspark.sql import functions as F

from airwave.functions.coerce import run_instant
from airwave.operators.ordered import in_slices, stream_history
from airwave.plans.enrich import clean, enrich, history_keys, in_report_order
from airwave.schema import DERIVED, RAW_COLUMNS

RUN = "2026-01-09T10:00:00.9Z"
T0 = "2026-01-02T00:00:00Z"


def at(text):
    return datetime.fromisoformat(text)


def test_duplicate_keeps_first_landed(raw, local):
    df = raw(
        {"id": 1, "collected_at": T0, "viewer_count": 5},
        {"id": 1, "collected_at": T0, "viewer_count": 9},
    )
    assert [r["viewer_count"] for r in local(enrich(df, RUN))] == [5]


def test_two_spellings_of_one_instant_are_one_row(raw, local):
    df = raw(
        {"id": 1, "collected_at": "2026-01-01T00:00:00Z", "viewer_count": 1},
        {"id": 1, "collected_at": "2026-01-01 00:00:00+00:00", "viewer_count": 2},
    )
    assert [r["viewer_count"] for r in local(enrich(df, RUN))] == [1]


def test_null_ids_are_one_series_and_equal_keys(raw, local):
    df = raw(
        {"collected_at": "2026-01-01T00:00:00Z", "viewer_count": 4},
        {"collected_at": "2026-01-01T00:00:00Z", "viewer_count": 6},
        {"collected_at": "2026-01-05T00:00:00Z", "viewer_count": 7},
        {"id": "", "collected_at": "2026-01-05T00:00:00Z", "viewer_count": 8},
    )
    rows = local(enrich(df, RUN).where("id IS NULL"), "collected_at")
    assert [(r["stream_snapshot_number"], r["previous_viewer_count"]) for r in rows] == [
        (1, None),
        (2, 4),
    ]


def by_case(raw, local, field, values, **fixed):
    """One enriched row per value of `field`, in order, from a single run."""
    rows = [{"id": i, "collected_at": T0, field: v, **fixed} for i, v in enumerate(values)]
    found = local(enrich(raw(*rows), RUN))
    return [r for r in sorted(found, key=lambda r: int(r["id"]))]


def test_bad_time_becomes_run_time_in_whole_seconds(raw, local):
    rows = by_case(raw, local, "collected_at", ["junk", None, "12:30:00", "2026"])
    assert {r["collected_at"] for r in rows} == {at("2026-01-09T10:00:00")}


def test_rows_with_different_unreadable_times_are_kept(raw, local):
    times = ["junk", "n/a", "junk", None, None, RUN[:19] + "Z", ""]
    df = raw(*[{"id": 1, "collected_at": t, "viewer_count": 9 - i} for i, t in enumerate(times)])
    rows = local(enrich(df, RUN), "ingest_seq")
    assert {r["collected_at"] for r in rows} == {at("2026-01-09T10:00:00")}
    assert [r["ingest_seq"] for r in rows] == [0, 1, 3, 5, 6]
    # They follow each other as landed.
    assert [r["stream_snapshot_number"] for r in rows] == [1, 2, 3, 4, 5]
    assert [r["previous_viewer_count"] for r in rows] == [None, 9, 8, 6, 4]
    assert "_unread" not in rows[0]


def test_viewer_count_coercion(raw, local):
    cases = {"x": 0, "": 0, None: 0, "NaN": 0, "inf": 0, "12d": 0, "0x1p3": 0, "12.5": 12,
             " 7 ": 7, "1e3": 1000, "9007199254740993": 9007199254740993}
    rows = by_case(raw, local, "viewer_count", cases)
    assert [r["viewer_count"] for r in rows] == list(cases.values())


def test_boolean(raw, local):
    cases = {" TRUE ": True, "\ttrue\n": True, "False": False, "yes": False, "1": False,
             None: False}
    rows = by_case(raw, local, "is_mature", cases)
    assert [r["is_mature"] for r in rows] == list(cases.values())


def test_changes(raw, local):
    cases = [((0, 7), 7.0, 0.0, "up"), ((8, 9), 1.0, 12.5, "up"), ((9, 3), -6.0, -66.67, "down"),
             ((4, 4), 0.0, 0.0, "stable")]
    rows = []
    for i, (counts, *_) in enumerate(cases):
        for time, n in zip(("2026-01-01T23:50:00Z", "2026-01-02T00:00:15Z"), counts):
            rows.append({"id": i, "collected_at": time, "viewer_count": n})
    found = local(enrich(raw(*rows), RUN), "id", "collected_at")
    for i, (_, delta, pct, trend) in enumerate(cases):
        first, second = found[2 * i : 2 * i + 2]
        assert (first["viewer_count_delta"], first["viewer_count_pct_change"]) == (0.0, 0.0)
        assert first["viewer_trend"] == "stable" and first["minutes_since_last_snapshot"] is None
        assert second["viewer_count_delta"] == delta
        assert second["viewer_count_pct_change"] == pct
        assert second["viewer_trend"] == trend
        # 10.25 minutes: the half goes to the even neighbour.
        assert second["minutes_since_last_snapshot"] == 10.2
        assert second["previous_collected_at"] == at("2026-01-01T23:50:00")


def test_durations(raw, local):
    cases = {
        "2026-01-01T23:59:45Z": (0.2, 0.0, "0-30 min"),
        "2026-01-01T23:59:07Z": (0.9, 0.02, "0-30 min"),
        "2026-01-02T01:00:00Z": (0.0, 0.0, "0-30 min"),
        "2026-01-01T23:29:00Z": (31.0, 0.52, "30-120 min"),
        "2026-01-01T18:00:00Z": (360.0, 6.0, "2-6 hours"),
        "2026-01-01T12:00:00Z": (720.0, 12.0, "6-12 hours"),
        "2026-01-01T11:59:00Z": (721.0, 12.02, "12+ hours"),
        None: (None, None, None),
        "junk": (None, None, None),
    }
    names = ("stream_duration_minutes", "stream_duration_hours", "stream_age_bucket")
    rows = by_case(raw, local, "started_at", cases)
    assert [tuple(r[n] for n in names) for r in rows] == list(cases.values())


def test_viewer_bins(raw, local):
    cases = {-1: None, 0: "0-100", 100: "0-100", 101: "101-1K", 1000: "101-1K", 1001: "1K-10K",
             10000: "1K-10K", 50000: "10K-50K", 50001: "50K+"}
    rows = by_case(raw, local, "viewer_count", cases)
    assert [r["viewer_count_bucket"] for r in rows] == list(cases.values())


def test_dense_rank(raw, local):
    df = raw(
        {"id": 1, "collected_at": T0, "viewer_count": 9},
        {"id": 2, "collected_at": T0, "viewer_count": 9},
        {"id": 3, "collected_at": T0, "viewer_count": 5},
        {"id": 4, "collected_at": T0, "viewer_count": 3_000_000_000},
    )
    ranks = [r["viewer_rank_in_snapshot"] for r in local(enrich(df, RUN), "id")]
    assert ranks == [2, 2, 3, 1]


def test_calendar(raw, local):
    cases = [("2026-01-02", "Friday", False), ("2026-01-03", "Saturday", True),
             ("2026-01-04", "Sunday", True), ("2026-01-05", "Monday", False)]
    df = raw(*[{"id": 1, "collected_at": f"{day}T13:05:00Z",
                "started_at": f"{day}T02:00:00+02:00"} for day, *_ in cases])
    for row, (day, name, weekend) in zip(local(enrich(df, RUN), "collected_at"), cases):
        assert (row["snapshot_date"], row["snapshot_hour_utc"]) == (day, 13)
        assert (row["snapshot_weekday"], row["is_weekend"]) == (name, weekend)
        assert (row["started_date"], row["started_hour_utc"]) == (day, 0)


def test_tags(raw, local):
    cases = {None: 0, "": 0, " , ": 0, "a": 1, "a, b": 2, " , a,,b , ": 2, "a ,   ,b c": 2,
             "\u2003,x": 1}
    rows = by_case(raw, local, "tags", cases)
    assert [r["tags_count"] for r in rows] == list(cases.values())
    assert [r["has_tags"] for r in rows] == [n > 0 for n in cases.values()]


def test_text_defaults_and_title_length(raw, local):
    row = local(enrich(raw({"id": 1, "collected_at": T0, "title": "h😀é"}), RUN))[0]
    assert row["title_length"] == 3
    assert (row["tags"], row["language"], row["game_name"]) == ("", "unknown", "Unknown")
    # Words that text readers like to take for null stay what they are.
    row = local(enrich(raw({"id": 1, "collected_at": T0, "game_name": "NA"}), RUN))[0]
    assert row["game_name"] == "NA"


def test_absent_columns(raw, local):
    row = local(enrich(raw({"id": 1}, columns=["id"]), RUN))[0]
    assert row["collected_at"] == at("2026-01-09T10:00:00") and row["started_at"] is None
    assert (row["title"], row["tags"], row["language"]) == ("", "", "unknown")
    assert (row["viewer_count"], row["is_mature"]) == (0, False)


def test_no_id_column(raw, local):
    columns = ["collected_at", "viewer_count"]
    df = raw(
        {"collected_at": T0, "viewer_count": 3},
        {"collected_at": T0, "viewer_count": 4},
        {"collected_at": "2026-01-02T00:10:00Z", "viewer_count": 5},
        columns=columns,
    )
    rows = local(enrich(df, RUN), "collected_at")
    assert [r["viewer_count"] for r in rows] == [3, 5]
    for row in rows:
        assert row["previous_viewer_count"] is None and row["minutes_since_last_snapshot"] is None
        assert row["stream_snapshot_number"] == 1 and row["viewer_trend"] == "stable"
        assert row["viewer_count_delta"] == 0.0 and row["viewer_count_pct_change"] == 0.0


def test_columns_and_types(raw):
    df = enrich(raw({"id": 1, "collected_at": T0}), RUN)
    assert df.columns == [*RAW_COLUMNS, "ingest_seq", *DERIVED.fieldNames()]
    assert {f.name: f.dataType for f in df.schema if f.name in DERIVED.fieldNames()} == {
        f.name: f.dataType for f in DERIVED
    }


def test_report_order(raw):
    df = raw(
        {"id": 1, "collected_at": "2026-01-02T00:10:00Z", "viewer_count": 1},
        {"id": 2, "collected_at": T0, "viewer_count": 1},
        {"id": 3, "collected_at": T0, "viewer_count": 8},
    )
    assert [r["id"] for r in in_report_order(enrich(df, RUN)).collect()] == ["3", "2", "1"]


def _wide(spark, rows=4000):
    """A third of the rows in one stream, a third in one batch, copies of both."""
    return spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 97).cast("string")).alias("id"),
        F.when(F.col("id") % 3 == 1, F.lit("2026-02-01T00:00:00Z"))
        .otherwise(F.concat(F.lit("2026-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"),
                            F.lit("T"), F.lpad((F.col("id") % 24).cast("string"), 2, "0"),
                            F.lit(":00:00Z")))
        .alias("collected_at"),
        F.when(F.col("id") % 5 == 0, "0").otherwise((F.hash("id") % 5_000_000).cast("string"))
        .alias("viewer_count"),
        F.col("id").alias("ingest_seq"),
    )


def test_split_rank_and_history_equal_brute_force(spark):
    pandas = pytest.importorskip("pandas")
    source = _wide(spark)
    got = enrich(source, RUN).toPandas().sort_values(["id", "collected_at"]).reset_index(drop=True)
    df = clean(source, RUN).select("id", "collected_at", "viewer_count", "ingest_seq").toPandas()
    df = df.sort_values("ingest_seq").drop_duplicates(["id", "collected_at"])
    df["rank"] = df.groupby("collected_at")["viewer_count"].rank(method="dense", ascending=False)
    df = df.sort_values(["id", "collected_at"]).reset_index(drop=True)
    groups = df.groupby("id")
    assert list(got["id"]) == list(df["id"])
    assert list(got["viewer_count"]) == list(df["viewer_count"])
    assert list(got["viewer_rank_in_snapshot"]) == list(df["rank"].astype(int))
    assert list(got["stream_snapshot_number"]) == list(groups.cumcount() + 1)
    previous = groups["viewer_count"].shift(1)
    pandas.testing.assert_series_equal(
        got["previous_viewer_count"].astype(float), previous, check_names=False
    )
    pandas.testing.assert_series_equal(
        got["previous_collected_at"], groups["collected_at"].shift(1), check_names=False
    )


def test_enriching_again_changes_nothing(spark):
    once = enrich(_wide(spark, 600), RUN).cache()
    raw_again = once.select("id", "collected_at", "viewer_count", "ingest_seq", "title", "language",
                            "game_name", "tags", "is_mature", "started_at")
    twice = enrich(raw_again, RUN).select(*once.columns)
    assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))


def test_numbers_are_dense_and_deltas_telescope(spark):
    per_id = (
        enrich(_wide(spark, 900), RUN)
        .groupBy("id")
        .agg(
            F.count("*").alias("n"),
            F.max("stream_snapshot_number").alias("last"),
            F.count_distinct("stream_snapshot_number").alias("numbers"),
            F.sum("viewer_count_delta").alias("moved"),
            (F.max_by("viewer_count", "collected_at") - F.min_by("viewer_count", "collected_at"))
            .cast("double")
            .alias("span"),
        )
    )
    assert per_id.where("n <> last OR n <> numbers OR moved <> span").isEmpty()


def test_without_landing_order_the_choice_is_still_fixed(raw, local):
    rows = [{"id": 1, "collected_at": T0, "viewer_count": n} for n in (9, 5)]
    for order in (rows, rows[::-1]):
        df = raw(*order).drop("ingest_seq")
        assert [r["viewer_count"] for r in local(enrich(df, RUN))] == [5]


def _unread(spark, rows, instant=RUN):
    """A null id whose times mostly cannot be read, around and at the run time, and two other streams."""
    return spark.range(rows).select(
        F.when(F.col("id") % 50 == 49, "other").when(F.col("id") % 50 == 48, "more").alias("id"),
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("2026-01-0"), (F.col("id") % 3 + 8).cast("string"),
                                               F.lit("T0"), (F.col("id") % 10).cast("string"),
                                               F.lit(":00:00Z")))
        .when(F.col("id") == 7, instant)
        .otherwise(F.concat(F.lit("bad "), F.col("id").cast("string"))).alias("collected_at"),
        (F.hash("id") % 1000).cast("string").alias("viewer_count"),
        (F.col("id") * 37 % rows * 900).alias("ingest_seq"),
    )


def test_shared_instants_are_cut_and_equal_a_plain_window(spark):
    from pyspark.sql import Window

    keys = history_keys(clean(_unread(spark, 5000), RUN))
    order = ["collected_at", "ingest_seq", "viewer_count", "_unread"]
    plain = Window.partitionBy("_series").orderBy(*order)
    want = keys.select(
        "_series", "collected_at", "_unread", F.lag("viewer_count").over(plain).alias("previous_viewer_count"),
        F.lag("collected_at").over(plain).alias("previous_collected_at"),
        F.row_number().over(plain).alias("stream_snapshot_number"),
    )
    instants = [run_instant(RUN), run_instant("2026-01-08T00:00:00Z")]
    for shared in (instants[:1], instants, None):
        got = stream_history(keys, shared).select(*want.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_many_unreadable_times_of_one_stream_fill_many_slices(spark):
    keys = history_keys(clean(_unread(spark, 20_000), RUN))
    sliced, cut = in_slices(keys, [run_instant(RUN)])
    sizes = [r["count"] for r in sliced.groupBy("_series", *cut).count().collect()]
    # 4096 landing numbers a slice, of which every 900th is taken here.
    assert max(sizes) <= 4096 and len(sizes) > 1000
