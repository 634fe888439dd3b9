"""Properties: input row order and partitioning do not change outputs; pair counts
obey their identities."""

from __future__ import annotations

from pyspark.sql import functions as F

from pickwise.operators import draft as D
from pickwise.operators import pairs as P
from pickwise.operators import recommend as R
from pickwise.sources import views as V


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_partitioning_and_order_do_not_change_outputs(spark, sf_small):
    pb, md = V.picks_bans(spark, sf_small), V.metadata(spark, sf_small)
    shuffled = pb.repartition(7).orderBy(F.rand(11))
    assert _same(P.hero_meta(pb, md), P.hero_meta(shuffled, md))
    assert _same(D.pick_order(pb), D.pick_order(shuffled.coalesce(1)))
    assert _same(P.pair_synergy_winrate(pb, md, 1), P.pair_synergy_winrate(shuffled, md, 1))
    dr = V.drafts(spark, sf_small)
    meta, lk = P.hero_meta(pb, md), R.score_lookups(pb, md)
    assert _same(R.recommend_topk(dr, meta, lookups=lk), R.recommend_topk(dr.repartition(3), meta, lookups=lk))


def test_pair_games_equal_sum_of_choose_two(spark, sf_small):
    pb = V.picks_bans(spark, sf_small)
    pairs = P.team_pairs(pb).agg(F.sum("pairs")).first()[0]
    sizes = (
        pb.where(F.col("is_pick") & F.col("hero_id").isNotNull())
        .groupBy("match_id", "team").count()
        .agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0]
    )
    assert pairs == sizes


def test_pair_wins_never_exceed_games(spark, sf_small):
    pb, md = V.picks_bans(spark, sf_small), V.metadata(spark, sf_small)
    st = P.pair_synergy_winrate(pb, md, 1)
    assert st.where((F.col("wins") > F.col("games")) | (F.col("wins") < 0)).count() == 0
