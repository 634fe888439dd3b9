"""Plan tests: native expressions only, no cartesian / nested-loop joins, and the
exchange counts the structural rewrites promise."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from pickwise.operators import draft as D
from pickwise.operators import recommend as R
from pickwise.plans import features as FE
from pickwise.plans.guards import plan_text

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")
FITS = ("fit_", "draft_model", "model_", "run_report", "prediction_export", "best_model", "draft_baseline_gain")
PLAN_KEYS = [k for k in E.SQL_KEYS if not k.startswith(("src_", "sink_", *FITS)) and not k.endswith("_files")]


@pytest.mark.parametrize("key", PLAN_KEYS)
def test_no_python_udf_no_cartesian(spark, sf_small, key):
    txt = plan_text(E.queries()[key](spark, sf_small), "simple")
    for bad in FORBIDDEN:
        assert bad not in txt, (key, bad)


def _picks(spark):
    return spark.createDataFrame(
        [(1, 5, 0, 1, True), (1, 7, 1, 2, False), (2, 9, 0, 1, True)],
        "match_id long, hero_id int, team int, order int, is_pick boolean",
    )


def test_onehot_is_one_exchange(spark):
    assert plan_text(D.hero_onehot(_picks(spark), [5, 7, 9]), "simple").count("Exchange") == 1


def test_pick_order_is_one_exchange_no_window(spark):
    txt = plan_text(D.pick_order(_picks(spark)), "simple")
    assert txt.count("Exchange") == 1 and "Window" not in txt


def test_early_features_one_exchange_per_source(spark):
    pb = _picks(spark)
    md = spark.createDataFrame([(1, True, 3), (2, None, 4)], "match_id long, radiant_win boolean, patch int")
    g = spark.createDataFrame([(1, 10, 5)], "match_id long, minute int, gold long")
    x = spark.createDataFrame([(1, 10, 5)], "match_id long, minute int, exp long")
    o = spark.createDataFrame([(1, 30, "tower")], "match_id long, time int, type string")
    t = spark.createDataFrame([(1, 30)], "match_id long, start int")
    txt = plan_text(FE.early_features(pb, md, g, x, o, t), "simple")
    # base dedupe + draft counts + gold + exp + objectives + fights: the joins add none
    assert txt.count("Exchange") == 6
    assert "Window" not in txt


def test_recommender_no_shuffle_after_draft_multisets(spark):
    drafts = spark.createDataFrame([(1, 0, 5), (1, 1, 7)], "draft_id long, team int, hero_id int")
    meta = spark.createDataFrame([(5, 1, 1, 0.5, 0.1), (7, 1, 0, 0.0, 0.1), (9, 1, 1, 1.0, 0.1)],
                                 "hero_id int, pick_count long, wins long, win_rate double, pick_rate double")
    syn = spark.createDataFrame([(5, 9, 3)], "h1 int, h2 int, wins long")
    ctr = spark.createDataFrame([(9, 7, 2)], "counter_hero int, target_hero int, wins long")
    txt = plan_text(R.recommend_topk(drafts, meta, syn, ctr), "simple")
    head = txt.split("ObjectHashAggregate(keys=[draft_id")[0]
    assert "Exchange" not in head and "SortMergeJoin" not in head
    assert "BroadcastHashJoin" in head


def _without_static_broadcast(spark, make):
    """Formatted plan with the size-based broadcast off: what is left is hinted."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan_text(make(), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_pair_rows_are_never_shuffled_on_hero_keys(spark, sf_small):
    """Large size estimates must not turn the rate lookup into a shuffle of pair rows."""
    from pickwise.plans import queries as Q

    for key in ("match_synergy", "draft_features"):
        txt = _without_static_broadcast(spark, lambda: getattr(Q, key)(spark, sf_small))  # noqa: B023
        assert "BroadcastHashJoin [hero1" in txt
        assert not any("Exchange hashpartitioning(hero1" in line for line in txt.splitlines()), key


def test_hero_meta_scans_the_picks_once(spark, sf_small):
    txt = plan_text(E.queries()["hero_meta"](spark, sf_small), "simple")
    assert sum("FileScan parquet" in line and "l_orderkey" in line for line in txt.splitlines()) == 1
    assert sum("FileScan parquet" in line and "o_orderkey" in line for line in txt.splitlines()) == 1


def test_recommender_has_one_exchange_of_drafts(spark, sf_small):
    txt = plan_text(E.queries()["recommend_topk"](spark, sf_small), "simple")
    on_draft = [x for x in txt.splitlines() if "Exchange hashpartitioning(draft_id" in x and "team" not in x and "hero_id" not in x]
    assert len(on_draft) == 1


def test_drafts_hold_every_pick(spark, sf_small):
    from pickwise.sources import views as V

    picks = V.picks_bans(spark, sf_small).where("is_pick AND team IN (0, 1)").count()
    assert V.drafts(spark, sf_small).count() == picks


def test_lookup_beyond_its_bound_is_joined_by_salted_keys(spark):
    from pyspark.sql import functions as F

    from pickwise.plans.guards import SALTS, Lookup

    rows = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 50).alias("hero"))
    table = spark.range(50).select(F.col("id").alias("hero"), (F.col("id") * 2).alias("v"))
    small, large = Lookup(table), Lookup(table, max_bytes=10)
    for how in ("inner", "left"):
        a, b = small.join(rows, ["hero"], how), large.join(rows, ["hero"], how)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    txt = _without_static_broadcast(spark, lambda: large.join(rows, ["hero"]))
    assert "_salt" in txt and "BroadcastHashJoin" not in txt
    parts = large.join(rows, ["hero"]).where("hero = 1").select(F.pmod(F.xxhash64("id", "hero"), F.lit(SALTS)).alias("s")).distinct().count()
    assert parts == SALTS  # the hot key is spread over all salts


def test_negative_win_counts_fail(spark):
    syn = spark.createDataFrame([(5, 9, -3)], "h1 int, h2 int, wins long")
    ctr = spark.createDataFrame([(9, 7, 2)], "counter_hero int, target_hero int, wins long")
    with pytest.raises(Exception, match="negative win count"):
        R.lookup_table(syn, ctr).collect()


def test_cluster_without_shared_folder_is_refused(monkeypatch):
    from pickwise import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
