"""Unit tests on tiny hand-made frames: every edge rule of FIXTURES.md §A."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from pickwise.functions import exprs as X
from pickwise.operators import draft as D
from pickwise.operators import pairs as P
from pickwise.operators import series as S
from pickwise.plans import features as FE

PICKS = "match_id long, hero_id int, team int, order int, is_pick boolean"
META = "match_id long, radiant_win boolean, radiant_score int, dire_score int, patch int, year int"


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


# ----------------------------------------------------------------- labels
def test_text_label_rules(spark):
    df = spark.createDataFrame([("True",), ("1",), ("true",), ("TRUE",), ("0",), (None,)], "radiant_win string")
    got = [r[0] for r in df.select(X.label_from_text("radiant_win")).collect()]
    assert got == [1, 1, 1, 0, 0, 0]


def test_bool_label_null_is_zero(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "match_id long, radiant_win boolean")
    assert rows(D.match_label(df)) == [(1, 1.0), (2, 0.0), (3, 0.0)]


def test_scores_tie_wins_for_neither(spark):
    df = spark.createDataFrame([(1, 10, 5), (2, 5, 10), (3, 7, 7)], "match_id long, radiant_score int, dire_score int")
    assert rows(D.label_from_scores(df)) == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]


def test_dedupe_keeps_deterministic_survivor(spark):
    df = spark.createDataFrame([(1, True, 2017), (1, False, 2018), (2, None, 2016), (1, True, 2018)], "match_id long, radiant_win boolean, year int")
    assert rows(D.dedupe_matches(df)) == [(1, True, 2018), (2, None, 2016)]


# ----------------------------------------------------------------- one-hot and order
def _picks(spark, data):
    return spark.createDataFrame(data, PICKS)


def test_onehot_presence_bans_only_and_duplicates(spark):
    pb = _picks(spark, [
        (1, 5, 0, 1, True), (1, 5, 0, 2, True),   # hero twice in one team: still 1
        (1, 7, 1, 3, False),
        (2, 9, 0, 1, False),                      # a match with bans only
        (3, 4, 0, 1, None),                       # NULL is_pick: no row
    ])
    oh = D.hero_onehot(pb, [4, 5, 7, 9])
    got = {r["match_id"]: r.asDict() for r in oh.collect()}
    assert set(got) == {1, 2}
    assert got[1]["radiant_pick_5"] == 1 and got[1]["dire_ban_7"] == 1 and got[1]["radiant_ban_5"] == 0
    assert got[2]["radiant_ban_9"] == 1 and sum(v for k, v in got[2].items() if k != "match_id") == 1


def test_onehot_row_sum_equals_distinct_heroes(spark, sf_small):
    from pickwise.sources import views as V

    pb = V.picks_bans(spark, sf_small)
    oh = D.hero_onehot(pb)
    cols = [c for c in oh.columns if c != "match_id"]
    s = oh.select("match_id", sum(F.col(c) for c in cols).alias("s"))
    expect = (
        pb.where(F.col("is_pick").isNotNull())
        .select("match_id", "team", "is_pick", "hero_id").distinct()
        .groupBy("match_id").count()
    )
    bad = s.join(expect, "match_id").where(F.col("s") != F.col("count")).count()
    assert bad == 0


def test_onehot_sparse_matches_wide(spark):
    pb = _picks(spark, [(1, 5, 0, 1, True), (1, 7, 1, 3, False), (2, 9, 0, 1, False)])
    ids = [5, 7, 9]
    wide = D.hero_onehot(pb, ids)
    sparse = D.hero_onehot_sparse(pb, ids)
    names = D.onehot_columns(ids)
    w = {r["match_id"]: [r[n] for n in names] for r in wide.collect()}
    s = {r["match_id"]: list(r["draft_onehot"].toArray().astype(int)) for r in sparse.collect()}
    assert w == s


def test_pick_order_avg_first_last_and_missing_side(spark):
    pb = _picks(spark, [
        (1, 30, 0, 4, True), (1, 10, 0, 2, True), (1, 20, 0, 2, True),  # tie in order -> hero_id
        (1, 50, 1, 1, False),                                            # ban does not count
        (2, 8, 1, 5, True),                                              # one pick, no radiant side
    ])
    got = {r["match_id"]: r.asDict() for r in D.pick_order(pb).collect()}
    assert got[1]["radiant_avg_pick_order"] == 2.0
    assert (got[1]["radiant_first_pick"], got[1]["radiant_last_pick"]) == (10, 30)
    assert (got[1]["dire_avg_pick_order"], got[1]["dire_first_pick"]) == (0.0, 0)
    assert got[2]["dire_avg_pick_order"] == 1.0 and got[2]["radiant_first_pick"] == 0


def test_timing_one_sample_stddev_is_zero(spark):
    t = spark.createDataFrame([(1, True, 10.0, 1.0), (1, False, 99.0, 9.0), (2, True, 3.0, 0.0), (2, True, 5.0, 2.0)],
                              "match_id long, pick boolean, total_time_taken double, extra_time double")
    got = {r["match_id"]: r for r in D.draft_timing(t).collect()}
    assert got[1]["std_pick_time"] == 0.0 and got[1]["avg_pick_time"] == 10.0
    assert got[2]["std_pick_time"] == pytest.approx(math.sqrt(2)) and got[2]["total_extra_time"] == 2.0


def test_patch_feature_branches(spark):
    feats = spark.createDataFrame([(1,), (2,)], "match_id long")
    meta = spark.createDataFrame([(1, None, 2018)], "match_id long, patch int, year int")
    assert rows(D.patch_feature(feats, meta)) == [(1, 0), (2, 0)]
    assert rows(D.patch_feature(feats, meta.drop("patch"))) == [(1, 2018), (2, 2020)]
    assert D.patch_feature(feats, meta.drop("patch", "year")).columns == ["match_id"]


# ----------------------------------------------------------------- pairs
def test_team_pairs_duplicate_hero_and_single_pick(spark):
    pb = _picks(spark, [
        (1, 5, 0, 1, True), (1, 5, 0, 2, True), (1, 3, 0, 3, True),  # 3,5,5 -> (3,5)x2, (5,5)x1
        (1, 9, 1, 1, True),                                          # one-pick side: no pairs
        (1, None, 0, 4, True),                                       # NULL hero ignored
    ])
    assert rows(P.team_pairs(pb)) == [(1, 0, 3, 5, 2), (1, 0, 5, 5, 1)]


def test_pair_stats_games_threshold_and_null_outcome(spark):
    data, meta = [], []
    for m in range(12):
        data += [(m, 1, 0, 1, True), (m, 2, 0, 2, True)]
        meta.append((m, True if m < 6 else (False if m < 9 else None), 0, 0, 0, 2020))
    data += [(100, 3, 0, 1, True), (100, 4, 0, 2, True)]
    meta.append((100, True, 0, 0, 0, 2020))
    st = P.pair_synergy_winrate(_picks(spark, data), spark.createDataFrame(meta, META))
    assert rows(st) == [(1, 2, 12, 6, 0.5)]  # NULL outcome is a loss; pair (3,4) has 1 game


def test_match_synergy_defaults_and_side_swap(spark):
    pb = _picks(spark, [(1, 1, 0, 1, True), (1, 2, 0, 2, True), (1, 3, 1, 1, True), (1, 4, 1, 2, True), (2, 5, 0, 1, True)])
    stats = spark.createDataFrame([(1, 2, 10, 7, 0.7), (3, 4, 10, 4, 0.4)], "hero1 int, hero2 int, games long, wins long, win_rate double")
    got = {r["match_id"]: r for r in P.match_synergy(pb, stats).collect()}
    assert got[1]["radiant_synergy"] == 0.7 and got[1]["dire_synergy"] == 0.4
    assert got[1]["synergy_diff"] == pytest.approx(0.3)
    assert (got[2]["radiant_synergy"], got[2]["dire_synergy"], got[2]["synergy_diff"]) == (0.5, 0.5, 0.0)
    swapped = pb.withColumn("team", 1 - F.col("team"))
    sw = {r["match_id"]: r for r in P.match_synergy(swapped, stats).collect()}
    assert sw[1]["synergy_diff"] == pytest.approx(-got[1]["synergy_diff"])
    empty = spark.createDataFrame([], "hero1 int, hero2 int, games long, wins long, win_rate double")
    assert {(r["radiant_synergy"], r["dire_synergy"], r["synergy_diff"]) for r in P.match_synergy(pb, empty).collect()} == {(0.5, 0.5, 0.0)}


def test_score_statistics_with_bans_and_duplicates(spark):
    pb = _picks(spark, [(1, 1, 0, 1, True), (1, 2, 0, 2, False), (1, 2, 0, 3, True), (1, 7, 1, 1, True)])
    md = spark.createDataFrame([(1, None, 10, 3, 0, 2020)], META)
    assert rows(P.pair_synergy_wins(pb, md)) == [(1, 2, 2)]           # bans count, pair weight 1*2
    assert rows(P.counter_wins(pb, md)) == [(7, 1, 0), (7, 2, 0)]
    meta = {r["hero_id"]: r for r in P.hero_meta(pb, md).collect()}
    assert meta[2]["pick_count"] == 2 and meta[2]["wins"] == 2 and meta[7]["wins"] == 0
    assert meta[1]["pick_rate"] == 1.0


# ----------------------------------------------------------------- early game
def test_series_missing_minute_single_sample_and_trend(spark):
    g = spark.createDataFrame([(1, 0, 100), (1, 5, -50), (1, 12, 999), (2, 10, 300), (3, 2, 7), (3, 10, 1)],
                              "match_id long, minute int, gold long")
    got = {r["match_id"]: r for r in S.series_early(g, "gold").collect()}
    assert got[1]["gold_at_10min"] is None and got[1]["gold_trend_10min"] == -150 and got[1]["gold_samples"] == 2
    assert got[2]["gold_volatility_10min"] is None and got[2]["gold_trend_10min"] == 0
    assert got[3]["gold_at_10min"] == 1 and got[3]["gold_max_10min"] == 7


def test_objectives_boundary_and_case(spark):
    o = spark.createDataFrame([(1, 600, "tower_kill"), (1, 601, "tower_kill"), (1, 30, "TOWER_DENY"), (1, 0, "roshan")],
                              "match_id long, time int, type string")
    r = S.objectives_early(o).collect()[0]
    assert (r["early_objective_count"], r["tower_kills_10min"]) == (3, 1)
    f = spark.createDataFrame([(1, 600), (1, 601)], "match_id long, start int")
    assert S.teamfights_early(f).collect()[0]["teamfights_count_10min"] == 1


def test_early_features_absent_sources_and_fill(spark):
    pb = _picks(spark, [(1, 1, 0, 1, True)])
    md = spark.createDataFrame([(1, True, 0, 0, None, 2020), (2, None, 0, 0, 3, 2020)], META)
    g = spark.createDataFrame([(1, 10, 2000)], "match_id long, minute int, gold long")
    e = spark.createDataFrame([(1, 10, 1000)], "match_id long, minute int, exp long")
    ef = FE.early_features(pb, md, g, e)
    assert len(FE.EARLY_FEATURES) == 21 and set(FE.EARLY_FEATURES) <= set(ef.columns)
    got = {r["match_id"]: r for r in ef.collect()}
    assert got[1]["is_radiant_ahead"] == 1 and got[1]["combined_advantage"] == 3.0 and got[1]["patch"] == 0
    assert got[2]["label"] == 0 and got[2]["gold_at_10min"] == 0 and got[2]["teamfights_count_10min"] == 0


# ----------------------------------------------------------------- expressions
def test_band_thresholds(spark):
    df = spark.createDataFrame([(0.66,), (0.65,), (0.5,), (0.4,), (0.35,)], "p double")
    got = [tuple(r) for r in df.select(X.band_strength("p")).collect()]
    assert [g[0] for g in got] == ["strong", "slight", "slight", "strong", "very strong"]


def test_text_report_sink(spark):
    from pickwise.operators import sinks as SK
    from pickwise.session import shared_dir

    rep = SK.RunReport()
    rep.add("load", 1.5, rows=3)
    path = SK.write_text(SK.report_text(rep.to_df(spark)), shared_dir(spark, "t-text"))
    assert "load" in spark.read.text(path).first()[0]


def test_a_match_listed_twice_counts_once(spark):
    from pickwise.operators import pairs as P
    from pickwise.operators import recommend as R
    from pickwise.plans import features as FE

    picks = spark.createDataFrame([(1, 5, 0, 1, True), (1, 6, 0, 2, True), (1, 7, 1, 3, True), (2, 5, 0, 1, True)], "match_id long, hero_id int, team int, order int, is_pick boolean")
    rows = [(1, True, 9, 3, 4), (2, False, 1, 2, 4)]
    schema = "match_id long, radiant_win boolean, radiant_score int, dire_score int, patch int"
    once, twice = spark.createDataFrame(rows, schema), spark.createDataFrame(rows + rows[:1], schema)
    for f in (
        lambda md: P.hero_meta(picks, md), lambda md: P.pair_synergy_wins(picks, md), lambda md: P.counter_wins(picks, md),
        lambda md: P.pair_synergy_winrate(picks, md, min_games=1), lambda md: R.score_lookups(picks, md),
        lambda md: FE.draft_features(picks, md, min_games=1, hero_ids=[5, 6, 7]),
    ):
        assert sorted(map(tuple, f(once).collect())) == sorted(map(tuple, f(twice).collect()))
