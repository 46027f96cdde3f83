"""Exploration queries over the enriched table. Ties in every top list are broken by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave.functions.features import raw_duration_hours
from airwave.functions.labels import (
    audience_label,
    clean_language,
    display_name,
    language_label,
)
from airwave.functions.numeric import ratio
from airwave.operators.joins import join_top, keep_top
from airwave.operators.ordered import running_total
from airwave.plans.summaries import down, up

STREAMER_NAME = ["user_name", "user_login"]


def games_by_streamers(df: DataFrame, k: int = 12) -> DataFrame:
    return (
        df.groupBy("game_name")
        .agg(
            F.count_distinct("user_id").alias("unique_streamers"),
            F.max("viewer_count").alias("peak_viewers"),
            F.avg("viewer_count").alias("avg_viewers"),
        )
        .orderBy(down("unique_streamers"), up("game_name"))
        .limit(k)
    )


def languages_by_streamers(df: DataFrame, k: int = 10) -> DataFrame:
    return (
        df.groupBy("language")
        .agg(
            F.count_distinct("user_id").alias("unique_streamers"),
            F.max("viewer_count").alias("peak_viewers"),
        )
        .orderBy(down("unique_streamers"), up("language"))
        .limit(k)
        .withColumn("language_display", language_label(F.col("language")))
    )


def audience_split(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(audience_label(F.col("is_mature")).alias("audience_type"))
        .agg(
            F.count_distinct("user_id").alias("unique_streamers"),
            F.max("viewer_count").alias("peak_viewers"),
        )
        .orderBy(up("audience_type"))
    )


def _with_display(df: DataFrame) -> DataFrame:
    name, login = (F.col(c) for c in STREAMER_NAME)
    return df.withColumn("streamer_display", display_name(name, login))


def top_streamers(df: DataFrame, k: int = 12) -> DataFrame:
    top = (
        df.groupBy(*STREAMER_NAME)
        .agg(
            F.max("viewer_count").alias("peak_viewers"),
            F.avg("viewer_count").alias("avg_viewers"),
            F.count("id").alias("snapshots"),
        )
        .orderBy(down("peak_viewers"), *[up(c) for c in STREAMER_NAME])
        .limit(k)
    )
    return _with_display(top)


def full_batch_timeline(df: DataFrame, threshold: int = 900) -> DataFrame:
    """Total viewers of each full batch; size and total come from one grouping."""
    return (
        df.where(F.col("collected_at").isNotNull())
        .groupBy("collected_at")
        .agg(F.count(F.lit(1)).alias("_size"), F.sum("viewer_count").alias("total_viewers"))
        .where(F.col("_size") >= threshold)
        .select("collected_at", "total_viewers")
        .orderBy("collected_at")
    )


def tracked_streamers(df: DataFrame, k: int = 10, min_snapshots: int = 10) -> DataFrame:
    top = (
        df.groupBy(*STREAMER_NAME)
        .agg(F.max("viewer_count").alias("peak_viewers"), F.count("id").alias("snapshots"))
        .where(F.col("snapshots") >= min_snapshots)
        .orderBy(down("peak_viewers"), down("snapshots"), *[up(c) for c in STREAMER_NAME])
        .limit(k)
    )
    return _with_display(top)


def tracked_timeline(
    df: DataFrame,
    k: int = 10,
    min_snapshots: int = 10,
    on: tuple[str, ...] = ("user_name",),
) -> DataFrame:
    """Largest count of each tracked streamer in each batch.

    Joined on the name alone, two logins that share a name share their values; pass
    `on=("user_name", "user_login")` to keep them apart.
    """
    tracked = tracked_streamers(df, k, min_snapshots).select(*on, "streamer_display")
    return (
        join_top(df.select("collected_at", "viewer_count", *on), tracked, list(on))
        .groupBy("collected_at", "streamer_display")
        .agg(F.max("viewer_count").alias("viewer_count"))
        .orderBy(up("collected_at"), up("streamer_display"))
    )


def top_games_hourly(game_hourly: DataFrame, k: int = 5) -> DataFrame:
    """Hourly rows of the k games with the largest totals."""
    top = (
        game_hourly.groupBy("game_name")
        .agg(F.sum("total_viewers").alias("_total"))
        .orderBy(down("_total"), up("game_name"))
        .limit(k)
    )
    return keep_top(game_hourly, top, "game_name").orderBy(
        up("snapshot_hour_utc"), up("game_name")
    )


def _top_by_total(df: DataFrame, key: str, k: int) -> DataFrame:
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sum("viewer_count").alias("viewer_count"))
        .orderBy(down("viewer_count"), up(key))
        .limit(k)
    )


def games_by_total(df: DataFrame, k: int = 15) -> DataFrame:
    return _top_by_total(df, "game_name", k)


def languages_by_total(df: DataFrame, k: int = 10) -> DataFrame:
    return _top_by_total(df.withColumn("language", clean_language(F.col("language"))), "language", k)


def mature_split(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("mature_label", audience_label(F.col("is_mature")))
        .where(F.col("mature_label").isNotNull())
        .groupBy("mature_label")
        .agg(
            F.sum("viewer_count").alias("total_viewers"),
            F.avg("viewer_count").alias("avg_viewers"),
            F.count(F.lit(1)).alias("stream_count"),
        )
        .orderBy("mature_label")
    )


def stream_hours(df: DataFrame) -> DataFrame:
    """Running time of each stream at collection, neither clipped nor rounded."""
    hours = f"{raw_duration_hours('collected_at', 'started_at')} AS stream_duration_hours"
    return df.selectExpr("id", "collected_at", "started_at", hours)


# Distribution of viewer counts. All three queries work on distinct counts with their number of
# rows, which combine before the shuffle; no query gathers the column or sorts it on one task.


def _value_counts(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["viewer_count"]).groupBy("viewer_count").agg(
        F.count(F.lit(1)).alias("n")
    )


def _scalars(row: DataFrame) -> Column:
    """A one-row frame as a struct-valued scalar subquery, run once whatever reads its fields."""
    return row.select(F.struct(*row.columns).alias("fields")).scalar()


def _percentile(running: str, value: str, fraction: float, total: str) -> Column:
    """Linear interpolation between the two neighbouring ranks, as an aggregate.

    `total` is a column with the number of values, the same in every row.
    """
    position = (F.col(total) - 1) * fraction
    below = F.min(F.when(F.col(running) > F.floor(position), F.col(value)))
    above = F.min(F.when(F.col(running) > F.ceil(position), F.col(value)))
    return below + (above - below) * F.max(position - F.floor(position))


def viewer_describe(df: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles, maximum and median, in one row."""
    counts = _value_counts(df)
    value, n = F.col("viewer_count"), F.col("n")
    moments = counts.agg(
        F.sum("n").alias("total"), ratio(F.sum(value * n), F.sum(n)).alias("mean")
    )
    ranked = running_total(counts, [], "viewer_count", "n")
    # Read once into a column, so that the plan holds one copy of the subquery.
    ranked = ranked.withColumn("_moments", _scalars(moments)).withColumns(
        {"_total": F.col("_moments.total"), "_gap": value - F.col("_moments.mean")}
    )
    squares = F.sum(n * F.col("_gap") * F.col("_gap"))
    return ranked.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("count"),
        ratio(F.sum(value * n), F.sum(n)).alias("mean"),
        F.sqrt(ratio(squares, F.sum(n) - 1)).alias("std"),
        F.min(value).alias("min"),
        *[
            _percentile("running", "viewer_count", p, "_total").alias(name)
            for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
        ],
        F.max(value).alias("max"),
        _percentile("running", "viewer_count", 0.5, "_total").alias("median"),
    )


def viewer_histogram(spark: SparkSession, df: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed on the right.

    Empty bins are listed. When all values are equal the range widens by half on either side.
    """
    counts = _value_counts(df)
    spread = counts.agg(F.min("viewer_count").alias("lo"), F.max("viewer_count").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    edges = spread.select(
        (F.col("lo") - F.when(flat, 0.5).otherwise(0.0)).alias("lo"),
        (F.col("hi") + F.when(flat, 0.5).otherwise(0.0)).alias("hi"),
    )
    found = _scalars(edges)
    lo, hi = found["lo"], found["hi"]
    placed = counts.withColumns({"_lo": lo, "_width": (hi - lo) / bins})

    def edge(index: Column) -> Column:
        return F.col("_lo") + index * F.col("_width")

    value = F.col("viewer_count")
    guess = F.least(F.floor((value - F.col("_lo")) / F.col("_width")), F.lit(bins - 1))
    placed = placed.withColumn("_guess", guess)
    guess = F.col("_guess")
    # The quotient can round across an edge, so compare with the edges themselves.
    settled = (
        guess
        - F.when(value < edge(guess), 1).otherwise(0)
        + F.when((value >= edge(guess + 1)) & (guess < bins - 1), 1).otherwise(0)
    )
    filled = placed.groupBy(settled.alias("bin")).agg(F.sum("n").alias("n"))
    # Both sides have at most `bins` rows.
    return (
        spark.range(bins)
        .withColumnRenamed("id", "bin")
        .join(F.broadcast(filled), "bin", "left")
        .withColumns({"_lo": lo, "_width": (hi - lo) / bins})
        .where(F.col("_lo").isNotNull())
        .select(
            F.col("bin").cast("int").alias("bin"),
            edge(F.col("bin")).alias("left_edge"),
            edge(F.col("bin") + 1).alias("right_edge"),
            F.coalesce("n", F.lit(0)).alias("count"),
        )
        .orderBy("bin")
    )


def viewer_density(df: DataFrame, points: int = 200, bins: int = 30) -> DataFrame:
    """Gaussian kernel density on an even grid, and the curve scaled to a `bins`-bin histogram.

    The bandwidth is the sample deviation times n^(-1/5). Each distinct count is spread over the
    grid, whose size is fixed, and the sums by grid point combine in the same task: `points` rows
    leave it.
    A column without spread has no density and gives no rows.
    """
    counts = _value_counts(df)
    value, n = F.col("viewer_count"), F.col("n")
    mean = counts.agg(ratio(F.sum(value * n), F.sum(n)).alias("mean")).scalar()
    gap = F.col("_gap")
    spread = counts.withColumn("_gap", value - mean).agg(
        F.sum(n).cast("double").alias("n"),
        F.min(value).cast("double").alias("lo"),
        F.max(value).cast("double").alias("hi"),
        F.sqrt(ratio(F.sum(n * gap * gap), F.sum(n) - 1)).alias("std"),
    ).select("n", "lo", "hi", (F.col("std") * F.pow("n", F.lit(-0.2))).alias("h"))
    # Read once into a column, which the grid points carry along.
    part = {c: F.col(f"_part.{c}") for c in ("n", "lo", "hi", "h")}
    scaled = counts.withColumn("_part", _scalars(spread)).select(
        "_part",
        n.cast("double").alias("n"),
        ((value - part["lo"]) / F.nullif(part["h"], F.lit(0.0))).alias("z"),
        ((part["hi"] - part["lo"]) / (points - 1) / F.nullif(part["h"], F.lit(0.0))).alias("step"),
    ).where(F.col("z").isNotNull())
    grid = (
        scaled.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .groupBy("point")
        .agg(
            F.expr("sum(n * exp(-0.5D * pow(z - step * point, 2D)))").alias("mass"),
            F.first("_part").alias("_part"),
        )
    )
    density = F.col("mass") / (part["n"] * part["h"] * F.sqrt(F.lit(2.0) * F.pi()))
    grid = grid.select(
        "point",
        (part["lo"] + F.col("point") * ((part["hi"] - part["lo"]) / (points - 1))).alias("x"),
        density.alias("density"),
        "_part",
    )
    width = (part["hi"] - part["lo"]) / bins
    grid = grid.withColumn("scaled", F.col("density") * part["n"] * width).drop("_part")
    return grid.orderBy("point")


def profile(raw: DataFrame, enriched: DataFrame) -> DataFrame:
    """One row of data-set figures: raw and processed rows, distinct keys, highest count."""
    # Folded first, so that the distinct counts multiply folded rows only.
    folded = enriched.groupBy("id", "game_name", "language").agg(
        F.count(F.lit(1)).alias("rows"), F.max("viewer_count").alias("viewer_count")
    )
    figures = folded.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("processed_rows"),
        F.count_distinct("id").alias("streams"),
        F.count_distinct("game_name").alias("games"),
        F.count_distinct("language").alias("languages"),
        F.max("viewer_count").alias("peak_viewers"),
    )
    raw_rows = raw.agg(F.count(F.lit(1)).alias("n")).scalar()
    return figures.select(raw_rows.alias("raw_rows"), *figures.columns)
