import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from airwave.operators.joins import batches_not_in, full_batches, join_top, keep_top
from airwave.operators.ordered import running_total
from airwave.plans import explore as Q


@pytest.fixture
def counts(spark):
    def build(values):
        return spark.createDataFrame([(v,) for v in values], "viewer_count bigint")

    return build


SAMPLES = [
    [5, 1, 1, 9, 200, 31, 31, 8, 7, 77, 1000, 0],
    [3_000_000, 12, 2_000_000, 2_000_000, 12, 1_048_576, 1_048_575],
]


@pytest.mark.parametrize("values", SAMPLES)
def test_describe_equals_numpy(counts, values):
    got = Q.viewer_describe(counts([*values, None])).first().asDict()
    assert got["count"] == len(values) and (got["min"], got["max"]) == (min(values), max(values))
    assert got["mean"] == pytest.approx(np.mean(values))
    assert got["std"] == pytest.approx(np.std(values, ddof=1))
    for name, p in (("p25", 25), ("p50", 50), ("p75", 75), ("median", 50)):
        assert got[name] == pytest.approx(np.percentile(values, p)), name


def test_describe_of_little(counts):
    one = Q.viewer_describe(counts([7])).first()
    assert (one["count"], one["std"], one["p25"], one["median"]) == (1, None, 7.0, 7.0)
    none = Q.viewer_describe(counts([None])).first()
    assert none["count"] == 0 and none["mean"] is None and none["median"] is None


@pytest.mark.parametrize("values", [*SAMPLES, [4, 4, 4], list(range(0, 301, 10))])
def test_histogram_equals_numpy(spark, counts, values):
    got = Q.viewer_histogram(spark, counts(values)).collect()
    expected, edges = np.histogram(values, bins=30)
    assert [r["count"] for r in got] == list(expected)
    assert [r["left_edge"] for r in got] == pytest.approx(list(edges[:-1]))
    assert [r["right_edge"] for r in got] == pytest.approx(list(edges[1:]))


def test_histogram_of_nothing(spark, counts):
    assert Q.viewer_histogram(spark, counts([None])).collect() == []


def test_density_equals_direct_sum(counts):
    values = SAMPLES[0]
    got = Q.viewer_density(counts(values), points=50).orderBy("point").collect()
    h = np.std(values, ddof=1) * len(values) ** -0.2
    grid = np.linspace(min(values), max(values), 50)
    expected = [
        sum(math.exp(-0.5 * ((x - v) / h) ** 2) for v in values)
        / (len(values) * h * math.sqrt(2 * math.pi))
        for x in grid
    ]
    assert [r["x"] for r in got] == pytest.approx(list(grid))
    assert [r["density"] for r in got] == pytest.approx(expected)
    width = (max(values) - min(values)) / 30
    assert got[0]["scaled"] == pytest.approx(expected[0] * len(values) * width)


@pytest.mark.parametrize("values", [[4, 4, 4], [4], [None]])
def test_no_density_without_spread(counts, values):
    assert Q.viewer_density(counts(values), points=5).collect() == []


@pytest.mark.parametrize("descending", [False, True])
def test_running_total_equals_plain_window(spark, descending):
    from pyspark.sql import Window

    values = spark.range(500).select(
        (F.col("id") % 3).alias("g"),
        (F.col("id") * 104_729 % 9_000_017).alias("v"),
        (F.col("id") % 7).alias("w"),
    )
    order = F.col("v").desc() if descending else F.col("v")
    plain = values.withColumn("running", F.sum("w").over(Window.partitionBy("g").orderBy(order)))
    split = running_total(values, ["g"], "v", "w", descending).select(*plain.columns)
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()


def test_null_keys_meet_in_joins(spark, local):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    top = spark.createDataFrame([(None, "x"), ("a", "y")], "k string, label string")
    rows = local(join_top(left, top, ["k"]), "v")
    assert rows == [{"k": "a", "v": 1, "label": "y"}, {"k": None, "v": 2, "label": "x"}]
    assert [r["v"] for r in local(keep_top(left, top, "k"), "v")] == [1, 2]


def snapshots(spark, rows):
    return spark.createDataFrame(
        rows, "collected_at string, user_name string, user_login string, viewer_count bigint, id string"
    ).withColumn("collected_at", F.to_timestamp("collected_at"))


T1, T2 = "2026-01-01T00:00:00Z", "2026-01-01T00:10:00Z"


def test_full_batches_and_timeline_agree(spark, local):
    df = snapshots(spark, [(T1, "a", "a", 1, "1"), (T1, "b", "b", 2, "2"), (T2, "a", "a", 4, "1"),
                           (None, "c", "c", 9, "3"), (None, "c", "c", 9, "3")])
    assert full_batches(df, 2).count() == 2
    assert full_batches(df, 2).columns == df.columns
    assert [r["total_viewers"] for r in local(Q.full_batch_timeline(df, 2))] == [3]


def test_anti_join_keeps_columns_and_unloaded_batches(spark):
    df = snapshots(spark, [(T1, "a", "a", 1, "1"), (T2, "a", "a", 4, "1")])
    left = batches_not_in(df, df.where("viewer_count = 1"))
    assert left.columns == df.columns and [r["viewer_count"] for r in left.collect()] == [4]


def test_tracked_minimum_and_shared_names(spark, local):
    rows = [(T1, "Sam", "sam1", 10, "1"), (T2, "Sam", "sam1", 12, "1"),
            (T1, "Sam", "sam2", 50, "2"), (T2, "Sam", "sam2", 40, "2"),
            (T1, "Ünal", "unal", 99, "3"), (T1, None, "x", 3, None), (T2, None, "x", 4, None)]
    df = snapshots(spark, rows)
    tracked = local(Q.tracked_streamers(df, 10, 2))
    # A null id does not count as a snapshot, so the unnamed streamer has none.
    assert [(r["user_login"], r["snapshots"]) for r in tracked] == [("sam2", 2), ("sam1", 2)]
    shared = local(Q.tracked_timeline(df, 10, 2))
    assert [r["viewer_count"] for r in shared] == [50, 40]
    assert [r["viewer_count"] for r in local(Q.tracked_timeline(df, 1, 2))] == [50, 40]
    apart = Q.tracked_timeline(df.where("user_login = 'sam1' OR user_login = 'unal'"), 10, 1,
                               on=("user_name", "user_login"))
    assert [(r["streamer_display"], r["viewer_count"]) for r in local(apart)] == [
        ("Sam", 10), ("unal", 99), ("Sam", 12),
    ]


def test_top_lists(spark, local):
    df = spark.createDataFrame(
        [("go", "en", True, 5, "u1"), ("go", "", False, 7, "u2"), ("chess", None, None, 9, "u1"),
         (None, "de", True, 100, "u3")],
        "game_name string, language string, is_mature boolean, viewer_count bigint, user_id string",
    )
    assert [r["game_name"] for r in local(Q.games_by_streamers(df, 2))] == ["go", "chess"]
    assert [r["game_name"] for r in local(Q.games_by_total(df))] == ["go", "chess"]
    assert [(r["language"], r["viewer_count"]) for r in local(Q.languages_by_total(df))] == [
        ("DE", 100), ("UNKNOWN", 16), ("EN", 5),
    ]
    assert [r["mature_label"] for r in local(Q.mature_split(df))] == ["Mature", "Not Mature"]
    assert [r["audience_type"] for r in local(Q.audience_split(df))] == [
        "Mature", "Not Mature", None,
    ]
    shown = {r["language"]: r["language_display"] for r in local(Q.languages_by_streamers(df))}
    assert shown == {"en": "en - English", "de": "de - German", "": " - ", None: None}
