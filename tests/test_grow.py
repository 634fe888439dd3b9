"""Trees grown over binned blocks: MLlib's own trees, whole certificates, bounded tasks."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pickwise.operators import grow as G
from pickwise.operators import ml as M
from pickwise.plans import models as MR
from test_trees import NAMES, SMALL, files_below, table


@pytest.fixture(scope="module")
def train(spark):
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(table(spark, 3000)).select("match_id", "label", "features").repartition(3).cache()


def test_boosting_is_that_of_mllib(train, monkeypatch):
    """Binned whole (3,000 rows are their own sample), in blocks of 500, margins kept twice."""
    monkeypatch.setattr(G, "BOOSTING_ROWS", 500)
    monkeypatch.setattr(G, "KEEP_EVERY", 3)
    monkeypatch.setattr(G, "GROUP", 64)
    boosting = GBTClassifier(maxIter=7, maxDepth=3, stepSize=0.1, seed=42)
    theirs, ours = boosting.fit(train), G.boosting(boosting, train, 3000)
    p = [m.transform(train).select("match_id", vector_to_array("probability")[1].alias(f"p{i}")) for i, m in enumerate((theirs, ours))]
    assert p[0].join(p[1], "match_id").agg(F.max(F.abs(F.col("p0") - F.col("p1")))).first()[0] < 1e-9
    assert np.allclose(theirs.featureImportances.toArray(), ours.featureImportances.toArray(), atol=1e-9)
    assert ours.treeWeights == theirs.treeWeights and ours.getMaxDepth() == 3


def test_forest_is_as_good_as_that_of_mllib(train, monkeypatch):
    monkeypatch.setattr(G, "FOREST_ROWS", 500)
    forest = RandomForestClassifier(numTrees=20, maxDepth=5, seed=42)
    theirs, ours = forest.fit(train), G.forest(forest, train, 3000)
    assert abs(M.auc_mllib(theirs.transform(train)) - M.auc_mllib(ours.transform(train))) < 0.01
    assert np.allclose(theirs.featureImportances.toArray(), ours.featureImportances.toArray(), atol=0.05)
    assert len(ours.trees) == 20 and ours.getMaxDepth() == 5 and ours.totalNumNodes > 20 * 20


def test_large_runs_are_grown_and_certified(spark, monkeypatch):
    used = []
    for name in ("forest", "boosting"):
        monkeypatch.setattr(G, name, lambda *a, _f=getattr(G, name), _n=name: used.append(_n) or _f(*a))
    monkeypatch.setattr(M, "GROWN_ROWS", 1000)
    run = MR.ModelRun(table(spark), NAMES, SMALL)
    try:
        for name, parts in (("random_forest", 7), ("gradient_boosting", 6)):
            assert run.certificate(name) == {"parts": parts, "agreeing_rows": run.n_test, "faults": 0}
        assert used == ["forest", "boosting"]
        assert run.save(run.work.folder("best"), "random_forest") and run.metrics("random_forest")["auc_roc"] > 0.8
    finally:
        run.close()


def test_nothing_stays_after_a_fit(spark, train):
    kept = lambda: (files_below(spark, spark.sparkContext.getCheckpointDir()), spark.sparkContext._jsc.getPersistentRDDs().size())
    train.count()
    G.shared_dir(spark)
    before = kept()
    G.forest(RandomForestClassifier(numTrees=2, maxDepth=2, seed=1), train, 3000)
    G.boosting(GBTClassifier(maxIter=2, maxDepth=2, seed=1), train, 3000)
    assert kept() == before
    with pytest.raises(Exception, match="labels other"):
        G.boosting(GBTClassifier(maxIter=2, maxDepth=2, seed=1), train.withColumn("label", F.col("label") * 2), 3000)
    assert kept() == before


def test_one_class_and_constant_features_give_leaves(train):
    alike = train.withColumn("label", F.lit(1.0))
    model = G.forest(RandomForestClassifier(numTrees=3, maxDepth=3, seed=1), alike, 3000)
    assert model.totalNumNodes == 3 and model.transform(alike).where("prediction = 1").count() == 3000
    model = G.boosting(GBTClassifier(maxIter=3, maxDepth=2, seed=1), alike, 3000)
    assert model.transform(alike).where("prediction = 1").count() == 3000


def test_thresholds_are_midpoints_or_strides():
    assert G.thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 32).tolist() == [1.5, 2.5] and len(G.thresholds(np.ones(5), 32)) == 0
    many = G.thresholds(np.arange(10_000.0), 32)
    assert len(many) == 31 and np.abs(np.diff(many) - 312.5).max() <= 1


def test_weights_of_a_forest_are_poisson():
    drawn = G.poisson(np.random.default_rng(3), 1_000_000, *G.poisson_table())
    assert abs(drawn.mean() - 1) < 0.005 and abs(drawn.var() - 1) < 0.01 and abs((drawn == 0).mean() - np.exp(-1)) < 0.002 and drawn.max() < 18


def test_features_counted_together_stay_within_the_bound():
    bins = np.array([2] * 160 + [32] * 14 + [1, 7])
    groups, of, shift, mask = G._layout(bins)
    assert sorted(f for g in groups for f in g) == list(range(len(bins))) and len(groups) <= 26
    assert all(1 << sum(G._bits(bins[f]) for f in g) <= G.GROUP for g in groups)
