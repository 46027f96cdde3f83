from pyspark.sql import functions as F

from airwave.functions import labels, numeric


def over(spark, kind, values, build):
    """The results of `build(column)` for each value, in order, in one run."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r["x"] for r in rows.orderBy("i").select(build(F.col("v")).alias("x")).collect()]


def test_round_even(spark):
    values = [0.25, 0.35, -0.25, None]
    assert over(spark, "double", values, lambda c: numeric.round_even(c, 1)) == [
        0.2, 0.4, -0.2, None,
    ]
    as_sql = F.expr(numeric.even_sql("v", 1))
    assert over(spark, "double", values, lambda c: as_sql) == [0.2, 0.4, -0.2, None]


def test_clip_keeps_null(spark):
    clip = F.expr(numeric.clip_low_sql("v", "0D"))
    assert over(spark, "double", [None, -3.0, 2.0], lambda c: clip) == [
        None, 0.0, 2.0,
    ]


def test_ratio_by_zero_is_null(spark):
    assert over(spark, "int", [0, 4, None], lambda c: numeric.ratio(F.lit(2), c)) == [
        None, 0.5, None,
    ]


def test_language_label(spark):
    codes = ["en", "zh-hk", "other", "asl", None]
    assert over(spark, "string", codes, labels.language_label) == [
        "en - English", "zh-hk - Zh-Hk", "other - Other", "asl - American Sign Language", None,
    ]


def test_display_name(spark):
    names = ["plain", "üser", "名前", None, ""]
    shown = over(spark, "string", names, lambda c: labels.display_name(c, F.lit("login")))
    assert shown == ["plain", "login", "login", None, ""]


def test_audience(spark):
    assert over(spark, "boolean", [True, False, None], labels.audience_label) == [
        "Mature", "Not Mature", None,
    ]


def test_clean_language(spark):
    assert over(spark, "string", [None, "", "en"], labels.clean_language) == [
        "UNKNOWN", "UNKNOWN", "EN",
    ]
