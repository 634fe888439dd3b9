"""Match-table views derived from the driver's Parquet tables.

The driver ships TPC-H-style tables, not match exports, so every reference
table is a fixed, documented derivation of one of them (see FIXTURES.md §B).
The derivations are plain projections / aggregations: filters and column
pruning reach the Parquet scan, and every view grows with its source table.

Fixed values of the derivation (they must equal the DuckDB oracle's):
  hero pool size 40; split multiplier 7919, offset 42, train share 80 of 100;
  patch base year 1995; match id of an event = user_id * 31 + day of month;
  minute of an event = hour / 2; event second = hour * 30 + minute / 2;
  gold sign +1 for click, view, purchase; exp sign +1 for click, signup;
  objective type error -> 'tower_kill', purchase -> 'TOWER_DENY'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HERO_POOL = 40
SPLIT_MULTIPLIER = 7919
SPLIT_OFFSET = 42
TRAIN_SHARE = 80
PATCH_BASE_YEAR = 1995
GOLD_POSITIVE = ("click", "view", "purchase")
EXP_POSITIVE = ("click", "signup")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def picks_bans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """picks_bans: distinct (match_id, hero_id, team, order, is_pick) rows of lineitem."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("match_id"),
        (F.col("l_partkey") % HERO_POOL).cast("int").alias("hero_id"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).cast("int").alias("team"),
        F.col("l_linenumber").cast("int").alias("order"),
        (F.col("l_returnflag") != "R").alias("is_pick"),
    ).distinct()


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """main_metadata: one row per order; outcome from the order status."""
    o = table(spark, sf_dir, "orders")
    yr = F.year("o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("match_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit(True))
        .when(F.col("o_orderstatus") == "O", F.lit(False))
        .alias("radiant_win"),
        (F.col("o_custkey") % HERO_POOL).cast("int").alias("radiant_score"),
        (F.floor("o_totalprice") % HERO_POOL).cast("int").alias("dire_score"),
        (yr - PATCH_BASE_YEAR).cast("int").alias("patch"),
        yr.cast("int").alias("year"),
    )


def draft_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """draft_timings: one row per lineitem."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("match_id"),
        (F.col("l_returnflag") != "R").alias("pick"),
        F.col("l_quantity").cast("int").alias("total_time_taken"),
        F.round(F.col("l_discount") * 100).cast("int").alias("extra_time"),
    )


def _event_match_id() -> Column:
    return (F.col("user_id") * 31 + F.dayofmonth("ts")).cast("long")


def _signed(positive: tuple[str, ...], magnitude: Column) -> Column:
    return F.when(F.col("event_type").isin(*positive), magnitude).otherwise(-magnitude)


def _minute_series(spark: SparkSession, sf_dir: str, value_name: str, value: Column) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return (
        ev.select(
            _event_match_id().alias("match_id"),
            F.floor(F.hour("ts") / 2).cast("int").alias("minute"),
            value.alias("_v"),
        )
        .groupBy("match_id", "minute")
        .agg(F.sum("_v").cast("long").alias(value_name))
    )


def gold_adv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """radiant_gold_adv: (match_id, minute, gold), one row per match-minute."""
    mag = F.round(F.col("value") * 100).cast("long")
    return _minute_series(spark, sf_dir, "gold", _signed(GOLD_POSITIVE, mag))


def exp_adv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """radiant_exp_adv: (match_id, minute, exp), one row per match-minute."""
    mag = (F.col("event_id") % 997).cast("long")
    return _minute_series(spark, sf_dir, "exp", _signed(EXP_POSITIVE, mag))


def objectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """objectives: (match_id, time in seconds, type), one row per event."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        _event_match_id().alias("match_id"),
        (F.hour("ts") * 30 + F.floor(F.minute("ts") / 2)).cast("int").alias("time"),
        F.when(F.col("event_type") == "error", F.lit("tower_kill"))
        .when(F.col("event_type") == "purchase", F.lit("TOWER_DENY"))
        .otherwise(F.col("event_type"))
        .alias("type"),
    )


def teamfights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """teamfights: (match_id, start in seconds), one row per event."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        _event_match_id().alias("match_id"),
        (F.get_json_object("props", "$.k").cast("int") * 10).cast("int").alias("start"),
    )


def drafts(spark: SparkSession, sf_dir: str, picks: DataFrame | None = None) -> DataFrame:
    """Drafts for the recommender: every pick of every match.

    draft_id = match_id; team 0 rows are the allies, team 1 rows the enemies.
    """
    pb = picks if picks is not None else picks_bans(spark, sf_dir)
    return pb.filter(F.col("is_pick") & F.col("team").isin(0, 1)).select(F.col("match_id").alias("draft_id"), "team", "hero_id")


def split_flag(match_id: Column | str = "match_id") -> Column:
    """Keyed, partition-independent 80/20 split: true for training rows."""
    c = F.col(match_id) if isinstance(match_id, str) else match_id
    # remainders first: the product of a large key would overflow
    return F.pmod(F.pmod(c, F.lit(100)) * SPLIT_MULTIPLIER + SPLIT_OFFSET, F.lit(100)) < TRAIN_SHARE


def candidates(spark: SparkSession, sf_dir: str, picks: DataFrame | None = None) -> DataFrame:
    """Every hero that either side of a match picked or banned, as a candidate to
    score against that match's draft: (draft_id, hero_id)."""
    pb = picks if picks is not None else picks_bans(spark, sf_dir)
    rows = pb.filter(F.col("hero_id").isNotNull() & F.col("team").isin(0, 1))
    return rows.select(F.col("match_id").alias("draft_id"), "hero_id").distinct()
