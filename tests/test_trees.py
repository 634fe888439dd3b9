"""Fitted models as tables: routed rows, certificates that a wrong fit breaks, owned files."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pickwise.operators import ml as M
from pickwise.operators import trees as TR
from pickwise.plans import models as MR
from pickwise.plans import workspace as W
from pickwise.plans.guards import materialize
from pickwise.session import shared_dir

SMALL = {"random_forest": {"numTrees": 7, "maxDepth": 4}, "gradient_boosting": {"maxIter": 6, "maxDepth": 3}}
NAMES = ["x1", "x2", "x3", "c"]


def table(spark, n=1500, seed=5, sign=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x1, x2, x3 = rnd.gauss(0, 1), rnd.gauss(0, 1), float(rnd.randint(0, 3))
        rows.append((i, float(sign * (2.0 * x1 - x2 + rnd.gauss(0, 1)) > 0), x1, x2, x3, 7.0))
    return spark.createDataFrame(rows, "match_id long, label double, x1 double, x2 double, x3 double, c double")


@pytest.fixture(scope="module")
def run(spark):
    made = MR.ModelRun(table(spark), NAMES, SMALL)
    yield made
    made.close()


@pytest.mark.parametrize(("name", "parts"), [("logistic_regression", 5), ("random_forest", 7), ("gradient_boosting", 6)])
def test_certificates_hold(run, name, parts):
    assert run.certificate(name) == {"parts": parts, "agreeing_rows": run.n_test, "faults": 0}


def test_wrong_fits_break_them(spark, run):
    other = MR.ModelRun(table(spark, sign=-1), NAMES, SMALL)  # the same rows, other labels
    try:
        for name in M.MODEL_ORDER:
            mixed = MR.ModelRun(table(spark), NAMES, SMALL)
            mixed.models[name] = other.model(name)
            assert mixed.certificate(name)["faults"] > 0, name
            mixed.close()
    finally:
        other.close()
    m = run.model("logistic_regression")
    off = TR.logreg_gradient(run.train, m.coefficients.toArray() * 1.001, m.intercept, m.getRegParam(), NAMES)
    assert off.where(F.abs("gradient") > M.GRADIENT_BOUND).count() > 0


def test_routing_in_several_passes(run):
    nodes = run.nodes("random_forest")
    whole = TR.routed(run.test, nodes, ["match_id"], 4)
    parts = TR.routed(run.test, nodes, ["match_id"], 4, most_bytes=2000)
    assert whole.count() == 7 * run.n_test and whole.exceptAll(parts).isEmpty() and parts.exceptAll(whole).isEmpty()


def test_routed_rows_are_not_multiplied_by_the_trees(run):
    nodes = run.nodes("random_forest")
    found = TR.reached(run.train, nodes, ["match_id", "label"], 4)
    assert found.count() == run.n_train and found.where("size(leaves) = 7 AND size(values) = 7").count() == run.n_train
    in_passes = TR.reached(run.train, nodes, ["match_id", "label"], 4, most_bytes=2000)
    assert found.exceptAll(in_passes).isEmpty()
    sums = {(r.tree, r.node): (r.found_rows, r.found_total) for r in TR.leaf_sums(nodes, found, False).collect()}
    long = TR.routed(run.train, nodes, ["label"], 4).groupBy("tree", "leaf").agg(F.count("*").alias("n"), F.sum("label").alias("ones")).collect()
    assert sums == {(r.tree, r.leaf): (r.n, r.ones) for r in long}


def test_tasks_of_a_fit_do_not_grow_with_every_row():
    assert [MR.partitions(n) for n in (1, 20_000, 20_001, 960_000)] == [1, 1, 2, 48]
    assert MR.partitions(7_200_000) == 48 and MR.partitions(43_200_000) == 87


@pytest.mark.parametrize("name", ["random_forest", "gradient_boosting"])
def test_importance_follows_from_the_nodes(run, name):
    theirs = run.model(name).featureImportances.toArray()
    ours = {r.feature: r.importance for r in TR.importance(run.nodes(name), each_tree=name == "random_forest").collect()}
    assert all(abs(theirs[i] - ours.get(i, 0.0)) <= 1e-12 for i in range(len(NAMES)))
    top = M.feature_importance(run.model(name), NAMES, top=2).collect()
    assert [r.feature for r in top] == ["x1", "x2"]


def files_below(spark, path):
    fs, where = W.file_system(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []


def test_a_closed_run_leaves_no_files(spark):
    base = shared_dir(spark, "x").rsplit("/", 1)[0]
    before = sorted(files_below(spark, base))
    run = MR.ModelRun(table(spark, 400), NAMES, SMALL)
    run.comparison().collect(), run.nodes("random_forest").count(), run.baseline_gain().collect(), run.save(run.work.folder("best"))
    assert sorted(files_below(spark, base)) != before and len(files_below(spark, run.work.root)) > 5
    run.close()
    assert sorted(files_below(spark, base)) == before
    with pytest.raises(ValueError, match="cannot train"):  # a failure cleans up too
        MR.ModelRun(table(spark, 400).where("match_id < 0"), NAMES, SMALL)
    assert sorted(files_below(spark, base)) == before


def test_workspace_owns_tables_only_while_active(spark):
    with pytest.raises(RuntimeError, match="stop"), W.Workspace(spark) as work:
        with work.active():
            t = materialize(spark.range(5))
            assert t.count() == 5 and W.current() is work
        assert W.current() is None and len(files_below(spark, work.root)) == 1
        raise RuntimeError("stop")
    assert files_below(spark, work.root) == []
    with pytest.raises(RuntimeError, match="closed"):
        work.folder("late")


def test_changed_files_give_a_new_run(spark, monkeypatch):
    made, folder = [], shared_dir(spark, "input")
    monkeypatch.setattr(MR, "_RUNS", {})

    def build():
        made.append(MR.ModelRun(table(spark, 200), NAMES, SMALL))
        return made[-1]

    spark.range(3).write.parquet(folder + "/a.parquet")
    first = MR._run(spark, folder, "t", None, build)
    assert MR._run(spark, folder, "t", None, build) is first
    spark.range(4).write.mode("overwrite").parquet(folder + "/a.parquet")
    second = MR._run(spark, folder, "t", None, build)
    assert second is not first and first.work.closed and not second.work.closed
    second.close()


def test_report_of_the_fitted_models(spark, sf_small):
    import __spark_entry__ as E

    lines = [r.value for r in E.queries()["report_text"](spark, sf_small).collect()]
    run = MR.early_run(spark, sf_small)
    for name in M.MODEL_ORDER:
        m = run.metrics(name)
        assert f"models | {name}: accuracy {m['accuracy']:.4f}, AUC {m['auc_roc']:.4f}, F1 {m['f1']:.4f}" in lines
    assert sum(line.startswith("top features | ") for line in lines) == 10
    rates = E.queries()["run_rates"](spark, sf_small).collect()
    assert [r.stage for r in rates][:2] == ["data_loading", "feature_engineering"] and all(r.rows_per_second > 0 for r in rates)
    top = E.queries()["feature_importance"](spark, sf_small).collect()
    assert [r["rank"] for r in top] == list(range(1, 21))
    assert len(E.queries()["fitted_comparison"](spark, sf_small).collect()) == 3
