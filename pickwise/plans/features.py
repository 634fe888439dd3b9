"""Composite per-match feature tables.

Every block is an aggregate keyed by ``match_id``; the blocks are attached to
the base table with left joins on ``match_id``.  Because each block already
comes out hash-partitioned on ``match_id``, the joins are co-partitioned
(sort-merge without new exchanges, or broadcast when AQE measures a block
small); no block is recomputed and no window is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.functions import exprs as X
from pickwise.operators import draft as D
from pickwise.operators import pairs as P
from pickwise.operators import series as S

EARLY_FEATURES = [
    "radiant_picks", "dire_picks",
    "gold_at_10min", "gold_max_10min", "gold_min_10min", "gold_avg_10min",
    "gold_volatility_10min", "gold_samples", "gold_trend_10min",
    "exp_at_10min", "exp_max_10min", "exp_min_10min", "exp_avg_10min",
    "exp_volatility_10min", "exp_samples", "exp_trend_10min",
    "early_objective_count", "tower_kills_10min", "teamfights_count_10min",
    "is_radiant_ahead", "combined_advantage",
]


def early_features(
    picks: DataFrame,
    meta: DataFrame,
    gold: DataFrame,
    exp: DataFrame,
    objectives: DataFrame | None = None,
    teamfights: DataFrame | None = None,
    minutes: int = S.EARLY_GAME_MINUTES,
) -> DataFrame:
    """One row per match: match_id, label, patch and the 21 early features.

    Missing optional sources give 0 for their features (as does a match absent
    from a source); all numeric NULLs become 0.
    """
    base = D.dedupe_matches(meta.select("match_id", "radiant_win", "patch"), prefer=())
    base = base.select("match_id", X.label_from_text("radiant_win").alias("label"), "patch")
    out = (
        base.join(D.draft_counts(picks), "match_id", "left")
        .join(S.series_early(gold, "gold", minutes=minutes), "match_id", "left")
        .join(S.series_early(exp, "exp", minutes=minutes), "match_id", "left")
    )
    if objectives is not None:
        out = out.join(S.objectives_early(objectives, minutes), "match_id", "left")
    else:
        out = out.withColumn("early_objective_count", F.lit(0)).withColumn(f"tower_kills_{minutes}min", F.lit(0))
    if teamfights is not None:
        out = out.join(S.teamfights_early(teamfights, minutes), "match_id", "left")
    else:
        out = out.withColumn(f"teamfights_count_{minutes}min", F.lit(0))
    g = F.coalesce(F.col(f"gold_at_{minutes}min"), F.lit(0))
    e = F.coalesce(F.col(f"exp_at_{minutes}min"), F.lit(0))
    out = out.withColumn("is_radiant_ahead", F.when((g > 0) & (e > 0), F.lit(1)).otherwise(F.lit(0)))
    out = out.withColumn("combined_advantage", g / 1000.0 + e / 1000.0)
    return out.fillna(0)


def draft_features(
    picks: DataFrame,
    meta: DataFrame,
    timings: DataFrame | None = None,
    synergy_stats: DataFrame | None = None,
    hero_ids: Sequence[int] | None = None,
    min_games: int = P.MIN_GAMES_FOR_SYNERGY,
) -> DataFrame:
    """One row per labelled match: 4·H one-hot, 6 order, 5 timing, 3 synergy,
    1 patch feature, all cast to double, plus match_id and label (double).

    ``synergy_stats`` defaults to pair win rates over all of ``meta`` (the
    reference's behaviour); pass statistics fitted on training matches to keep
    test labels out of the features.
    """
    if synergy_stats is None:
        synergy_stats = P.pair_synergy_winrate(picks, meta, min_games)
    if hero_ids is None:
        hero_ids = D.collect_vocabulary(picks)
    blocks = D.draft_slots(picks, hero_ids)  # one-hot + pick order, one aggregate; laid out after the joins
    feats = blocks
    timing_cols: list[str] = []
    if timings is not None:
        timing = D.draft_timing(timings)
        timing_cols = [c for c in timing.columns if c != "match_id"]
        feats = feats.join(timing, "match_id", "left")
    feats = feats.join(P.match_synergy(picks, synergy_stats, all_matches=False), "match_id", "left")
    if "patch" in meta.columns:
        patch_name, patch_src, patch_default = "patch", "patch", 0
    elif "year" in meta.columns:
        patch_name, patch_src, patch_default = "patch_year", "year", X.DEFAULT_PATCH_YEAR
    else:
        patch_name = None
    meta_cols = [F.col("match_id"), X.label_from_bool("radiant_win").alias("label")]
    if patch_name:
        meta_cols.append(F.col(patch_src).alias("_patch"))
    names = ["match_id", "radiant_win"] + ([patch_src] if patch_name else [])
    feats = feats.join(D.dedupe_matches(meta.select(*names), prefer=()).select(*meta_cols), "match_id", "inner")

    # one projection: fills, derived synergy difference and double casts
    # (SQL expression strings: one driver call for a table of 4·H + 15 columns)
    syn = float(X.DEFAULT_SYNERGY)
    rs = f"coalesce(radiant_synergy, CAST({syn} AS DOUBLE))"
    ds = f"coalesce(dire_synergy, CAST({syn} AS DOUBLE))"
    out = ["match_id"]
    out += D.onehot_exprs(hero_ids, "DOUBLE")
    out += [f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in blocks.columns if c not in ("match_id", "_slots")]
    out += [f"CAST(coalesce(`{c}`, 0) AS DOUBLE) AS `{c}`" for c in timing_cols]
    out += [f"{rs} AS radiant_synergy", f"{ds} AS dire_synergy", f"{rs} - {ds} AS synergy_diff"]
    if patch_name:
        out.append(f"CAST(coalesce(_patch, {patch_default}) AS DOUBLE) AS `{patch_name}`")
    out.append("label")
    return feats.selectExpr(*out)


def draft_feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("match_id", "label")]
