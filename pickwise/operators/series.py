"""Early-match operators over minute series and event tables.

Each series becomes ONE aggregate per match: the value at the cut-off minute,
extremes, mean, sample stddev, sample count, and first/last value as the
min/max of struct(minute, value) — no windows, no self-joins.  Time filters are
plain comparisons on stored columns so they reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EARLY_GAME_MINUTES = 10


def series_early(series: DataFrame, value: str, prefix: str | None = None, minutes: int = EARLY_GAME_MINUTES) -> DataFrame:
    """Seven features per match over minutes ≤ ``minutes``:
    {p}_at_10min, {p}_max_10min, {p}_min_10min, {p}_avg_10min,
    {p}_volatility_10min (sample stddev), {p}_samples, {p}_trend_10min.

    ``at`` is NULL when the cut-off minute is missing and volatility is NULL for
    a single sample (the feature table fills both with 0); trend = last − first
    value, 0 when undefined.
    """
    p = prefix or value
    tag = f"{minutes}min"
    v = F.col(value)
    point = F.struct(F.col("minute").alias("m"), v.alias("v"))
    out = (
        series.where(F.col("minute") <= minutes)
        .groupBy("match_id")
        .agg(
            F.max(F.when(F.col("minute") == minutes, v)).alias(f"{p}_at_{tag}"),
            F.max(v).alias(f"{p}_max_{tag}"),
            F.min(v).alias(f"{p}_min_{tag}"),
            F.avg(v).alias(f"{p}_avg_{tag}"),
            F.stddev_samp(v).alias(f"{p}_volatility_{tag}"),
            F.count(F.lit(1)).alias(f"{p}_samples"),
            F.min(point).alias("_first"),
            F.max(point).alias("_last"),
        )
    )
    trend = F.coalesce(F.col("_last.v") - F.col("_first.v"), F.lit(0))
    return out.withColumn(f"{p}_trend_{tag}", trend).drop("_first", "_last")


def series_trend(series: DataFrame, value: str, minutes: int = EARLY_GAME_MINUTES) -> DataFrame:
    """(match_id, first_minute, first_value, last_minute, last_value, trend)."""
    point = F.struct(F.col("minute").alias("m"), F.col(value).alias("v"))
    agg = series.where(F.col("minute") <= minutes).groupBy("match_id").agg(
        F.min(point).alias("f"), F.max(point).alias("l")
    )
    return agg.select(
        "match_id",
        F.col("f.m").alias("first_minute"),
        F.col("f.v").alias("first_value"),
        F.col("l.m").alias("last_minute"),
        F.col("l.v").alias("last_value"),
        F.coalesce(F.col("l.v") - F.col("f.v"), F.lit(0)).alias("trend"),
    )


def objectives_early(objectives: DataFrame, minutes: int = EARLY_GAME_MINUTES, pattern: str = "%tower%") -> DataFrame:
    """(match_id, early_objective_count, tower_kills_10min) over events at ≤ minutes·60 s.

    ``time / 60 <= minutes`` is written as ``time <= minutes * 60`` (equal for
    integer seconds) so the predicate is pushed to the scan.  LIKE is
    case-sensitive: 'TOWER' does not match '%tower%'.
    """
    early = objectives.where(F.col("time") <= minutes * 60)
    return early.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("early_objective_count"),
        F.sum(F.when(F.col("type").like(pattern), F.lit(1)).otherwise(F.lit(0))).cast("long").alias(f"tower_kills_{minutes}min"),
    )


def teamfights_early(teamfights: DataFrame, minutes: int = EARLY_GAME_MINUTES) -> DataFrame:
    """(match_id, teamfights_count_10min): fights starting at ≤ minutes·60 s."""
    early = teamfights.where(F.col("start") <= minutes * 60)
    return early.groupBy("match_id").agg(F.count(F.lit(1)).alias(f"teamfights_count_{minutes}min"))
