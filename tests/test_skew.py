"""A hot key: one match holding a third of all rows (many copies of a few heroes).
Results stay exact and the pair / multiset outputs stay bounded by the hero
vocabulary instead of the group size."""

from __future__ import annotations

from pyspark.sql import functions as F

from pickwise.operators import draft as D
from pickwise.operators import pairs as P
from pickwise.operators import recommend as R

PICKS = "match_id long, hero_id int, team int, order int, is_pick boolean"
META = "match_id long, radiant_win boolean, radiant_score int, dire_score int"


def _data(spark):
    rows = []
    for m in range(1, 401):  # 400 ordinary matches, 5 picks a side
        for i in range(5):
            rows.append((m, (m + i) % 20, 0, i, True))
            rows.append((m, (m + i + 7) % 20, 1, i, True))
    hot = [(0, h % 3, 0, i, True) for i, h in enumerate(range(2000))]  # 2000 rows, 3 heroes
    meta = [(m, m % 2 == 0, m % 7, m % 5) for m in range(0, 401)]
    return spark.createDataFrame(rows + hot, PICKS), spark.createDataFrame(meta, META), len(hot), len(rows)


def test_hot_match_pairs_bounded_and_exact(spark):
    picks, meta, n_hot, n_rest = _data(spark)
    assert n_hot >= (n_hot + n_rest) / 3
    tp = P.team_pairs(picks).where("match_id = 0").collect()
    # 3 distinct heroes -> 3 cross pairs + 3 self pairs, weights sum to C(2000, 2)
    assert len(tp) == 6 and sum(r["pairs"] for r in tp) == n_hot * (n_hot - 1) // 2
    hm = {r["hero_id"]: r for r in P.hero_meta(picks, meta).collect()}
    raw = picks.groupBy("hero_id").count().collect()
    assert all(hm[r["hero_id"]]["pick_count"] == r["count"] for r in raw)


def test_hot_draft_multiset_is_bounded(spark):
    drafts = spark.createDataFrame([(1, 0, h % 4) for h in range(3000)] + [(2, 1, 5)], "draft_id long, team int, hero_id int")
    pd = {r["draft_id"]: r for r in R.draft_multisets(drafts).collect()}
    assert len(pd[1]["allies"]) == 4 and pd[1]["n_ally"] == 3000 and sorted(pd[1]["used"]) == [0, 1, 2, 3]


def test_hot_match_onehot_and_order(spark):
    picks, _, _, _ = _data(spark)
    oh = D.hero_onehot(picks, list(range(20))).where("match_id = 0").first()
    assert [oh[f"radiant_pick_{h}"] for h in range(4)] == [1, 1, 1, 0]
    po = D.pick_order(picks).where("match_id = 0").first()
    assert po["radiant_avg_pick_order"] == (2000 + 1) / 2 and po["radiant_first_pick"] == 0
