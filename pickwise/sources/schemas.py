"""Declared schemas of the match tables (no schema inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

PICKS_BANS = T.StructType([
    T.StructField("match_id", T.LongType()),
    T.StructField("hero_id", T.IntegerType()),
    T.StructField("team", T.IntegerType()),
    T.StructField("order", T.IntegerType()),
    T.StructField("is_pick", T.BooleanType()),
    T.StructField("leagueid", T.LongType()),
])

MAIN_METADATA = T.StructType([
    T.StructField("match_id", T.LongType()),
    T.StructField("radiant_win", T.StringType()),  # "True", "1", "true" count as won: read by functions.exprs
    T.StructField("radiant_score", T.IntegerType()),
    T.StructField("dire_score", T.IntegerType()),
    T.StructField("patch", T.IntegerType()),
    T.StructField("leagueid", T.LongType()),
    T.StructField("start_time", T.LongType()),
])

DRAFT_TIMINGS = T.StructType([
    T.StructField("match_id", T.LongType()),
    T.StructField("pick", T.BooleanType()),
    T.StructField("total_time_taken", T.DoubleType()),
    T.StructField("extra_time", T.DoubleType()),
])

GOLD_ADV = T.StructType([
    T.StructField("match_id", T.LongType()),
    T.StructField("minute", T.IntegerType()),
    T.StructField("gold", T.LongType()),
])

EXP_ADV = T.StructType([
    T.StructField("match_id", T.LongType()),
    T.StructField("minute", T.IntegerType()),
    T.StructField("exp", T.LongType()),
])

OBJECTIVES = T.StructType([
    T.StructField("match_id", T.LongType()),
    T.StructField("time", T.IntegerType()),
    T.StructField("type", T.StringType()),
])

TEAMFIGHTS = T.StructType([
    T.StructField("match_id", T.LongType()),
    T.StructField("start", T.IntegerType()),
])

SCHEMAS = {
    "picks_bans": PICKS_BANS,
    "main_metadata": MAIN_METADATA,
    "draft_timings": DRAFT_TIMINGS,
    "radiant_gold_adv": GOLD_ADV,
    "radiant_exp_adv": EXP_ADV,
    "objectives": OBJECTIVES,
    "teamfights": TEAMFIGHTS,
}


def with_corrupt_column(schema: T.StructType, name: str = "_corrupt_record") -> T.StructType:
    """The schema plus a string column that receives unparsable records."""
    return T.StructType(list(schema.fields) + [T.StructField(name, T.StringType())])
