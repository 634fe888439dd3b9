"""Fitted trees and regressions as tables, and what can be worked out from them again.

A fitted forest or boosting is written by MLlib and read back as a node table, one row
a node.  Rows are routed through it in Arrow batches: the nodes of the trees are broadcast
(at most ``trees * 2^(depth + 1)``, taken in several passes beyond the bound) and a batch
goes down a tree a level at a time, so that a row stays one row whatever the number of
trees.  From the routed rows follow the probabilities that ``model.transform`` must give,
the leaves that the training rows must have made (summed by leaf inside each task), and
from the nodes alone the importance of every feature.  A fitted
regression is certified by the gradient of its loss, one aggregate over the training
rows.  Nothing here calls the model itself, so a wrong fit or a wrong export shows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.core.broadcast import Broadcast
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickwise.plans.guards import MAX_BROADCAST_BYTES

NODE_BYTES = 64  # of one packed node: ids, threshold, children and value
AGREE = 1e-9  # recomputed values may differ from the model's by float rounding only
LEAF_AGREE = 1e-6  # the same for leaf means, sums of up to all training rows
LEAF_SUMS = "tree int, node int, n long, t double"


def node_table(model: Model, folder: str) -> DataFrame:
    """The nodes of a fitted forest or boosting, written to ``folder`` and read back:
    tree, node, feature, threshold, left, right (-1 in leaves), value, prediction,
    impurity, gain, weight and stats (class weights, or count, sum and sum of squares of
    a boosting's regression trees), rows.  ``value`` is what a leaf adds: the share of
    label 1, or the tree weight times the leaf's mean.  Features are continuous."""
    model.write().overwrite().save(folder)
    data = _spark().read.parquet(f"{folder}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    if isinstance(model, GBTClassificationModel):
        weight = F.get("impurityStats", F.lit(0))
        by_tree = F.array(*[F.lit(float(w)) for w in model.treeWeights])
        value = F.get(by_tree, F.col("tree")) * F.col("prediction")
    else:
        weight = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
        value = F.get("impurityStats", F.lit(1)) / weight
    return data.select(
        "tree", F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), value.alias("value"), "prediction",
        "impurity", "gain", weight.alias("weight"), F.col("impurityStats").alias("stats"), F.col("rawCount").alias("rows"),
    )


def importance(nodes: DataFrame, each_tree: bool = True) -> DataFrame:
    """(feature, importance) by feature index: the gains of its splits, weighted by rows,
    scaled to one.  In a forest every tree is scaled to one first (``each_tree``); in a
    boosting the trees keep their own gains."""
    gains = nodes.where("left >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("gain"))
    if each_tree:
        gains = gains.withColumn("gain", F.try_divide(F.col("gain"), F.sum("gain").over(Window.partitionBy("tree"))))  # a row a used feature
    by_feature = gains.groupBy("feature").agg(F.sum("gain").alias("gain"))
    total = F.sum("gain").over(Window.partitionBy())  # a row a feature
    return by_feature.select("feature", (F.col("gain") / total).alias("importance"))


def _router(trees: Broadcast, depth: int):
    """The function of a task that sends Arrow batches (..., x, leaves, values) down the broadcast trees."""

    def route(batches):
        import numpy as np
        import pyarrow as pa

        feature, threshold, child, value, roots = trees.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            first = np.arange(batch.num_rows) * (len(x) // batch.num_rows)  # where a row's features begin
            leaves, values = np.empty((len(roots), batch.num_rows), "int32"), np.empty((len(roots), batch.num_rows))
            for t, root in enumerate(roots):
                at = np.full(batch.num_rows, root)
                for _ in range(max(1, depth)):
                    lower = x[first + feature[at]] <= threshold[at]
                    at = child[2 * at + lower]
                leaves[t], values[t] = at - root, value[at]
            columns = dict(zip(batch.schema.names, batch.columns))
            for name, found, kind in (("leaves", leaves, pa.int32()), ("values", values, pa.float64())):
                old = columns[name].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                both = np.concatenate([old, found.T], axis=1)
                ends = np.arange(batch.num_rows + 1, dtype="int32") * both.shape[1]
                columns[name] = pa.ListArray.from_arrays(pa.array(ends), pa.array(both.ravel(), kind))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return route


def reached(rows: DataFrame, nodes: DataFrame, keep: Sequence[str], depth: int, vector: str = "features", most_bytes: int = MAX_BROADCAST_BYTES, then: tuple | None = None) -> DataFrame:
    """(*keep, leaves, values): the leaf that every row reaches in every tree of at most
    ``depth`` levels and what it adds, as two arrays in the order of the trees.  ``then``
    (function of the batches, schema of its rows) is applied in the tasks of the last pass."""
    size = nodes.agg(F.max("tree").alias("last"), F.count("*").alias("nodes")).first()
    if size["last"] is None:
        raise ValueError("a model without trees")
    trees = size["last"] + 1
    most = nodes.groupBy("tree").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    passes = -(-trees * most * NODE_BYTES // most_bytes)
    step = -(-trees // passes)
    out = rows.select(
        *keep, vector_to_array(F.col(vector)).alias("x"), F.array().cast("array<int>").alias("leaves"), F.array().cast("array<double>").alias("values")
    )
    for first in range(0, trees, step):
        some = nodes.where(F.col("tree").between(first, first + step - 1)).orderBy("tree", "node")
        some = some.select("tree", "feature", "threshold", "left", "right", "value").toPandas()
        roots = np.searchsorted(some["tree"], np.arange(first, min(first + step, trees)))  # a node's id is its place from there
        leaf, place = (some["left"] < 0).to_numpy(), np.arange(len(some))
        root = roots[some["tree"].to_numpy() - first]
        child = np.empty(2 * len(some), "int64")  # higher, lower; a leaf leads to itself
        child[0::2] = np.where(leaf, place, root + some["right"])
        child[1::2] = np.where(leaf, place, root + some["left"])
        packed = (np.where(leaf, 0, some["feature"]), some["threshold"].to_numpy(), child, some["value"].to_numpy(), roots)
        router = _router(_spark().sparkContext.broadcast(packed), depth)
        if then is not None and first + step >= trees:
            return out.mapInArrow(_chained(router, then[0]), then[1])
        out = out.mapInArrow(router, out.schema)
    return out.drop("x")


def _chained(first, second):
    return lambda batches: second(first(batches))


def routed(rows: DataFrame, nodes: DataFrame, keep: Sequence[str], depth: int, vector: str = "features", most_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(*keep, tree, leaf, value): :func:`reached` with one row a tree."""
    found = reached(rows, nodes, keep, depth, vector, most_bytes)
    found = found.select(*keep, "values", F.posexplode("leaves").alias("tree", "leaf"))
    return found.select(*keep, "tree", "leaf", F.get("values", F.col("tree")).alias("value"))


def probabilities(found: DataFrame, boosting: bool, keep: Sequence[str] = ("match_id",)) -> DataFrame:
    """(*keep, probability) from the values of the leaves that a row reached (:func:`reached`)."""
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x)
    return found.select(*keep, (1 / (1 + F.exp(-2 * total)) if boosting else total / F.size("values")).alias("probability"))


def agreeing(recomputed: DataFrame) -> int:
    """Rows (theirs, probability) in which the model's P(label = 1), ``theirs``, equals the
    recomputed probability."""
    return recomputed.where(F.abs(F.col("theirs") - F.col("probability")) <= AGREE).count()


def _summing(boosting: bool, label: str, trees: int, width: int):
    """The function of a task that adds up its rows by leaf."""

    def add(batches):
        import numpy as np
        import pyarrow as pa

        count, total = np.zeros(trees * width, "int64"), np.zeros(trees * width)
        first = np.arange(trees) * width
        for batch in batches:
            if not batch.num_rows:
                continue
            one = batch.column(label).cast(pa.float64()).to_numpy(zero_copy_only=False)
            keys = (batch.column("leaves").flatten().to_numpy(zero_copy_only=False).reshape(-1, trees) + first).ravel()
            target = np.repeat((one == 1).astype("float64"), trees)
            if boosting:
                values = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(-1, trees)
                sign = (2 * one - 1)[:, None]
                margin = np.cumsum(values, axis=1) - values
                with np.errstate(over="ignore"):  # a far margin: gradient zero
                    gradient = 4 * sign / (1 + np.exp(2 * sign * margin))
                gradient[:, 0] = sign[:, 0]
                target = gradient.ravel()
            count += np.bincount(keys, minlength=trees * width)
            total += np.bincount(keys, target, minlength=trees * width)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at // width, pa.int32()), pa.array(at % width, pa.int32()), pa.array(count[at]), pa.array(total[at])],
            ["tree", "node", "n", "t"],
        )

    return add


def leaf_sums(nodes: DataFrame, found: DataFrame, boosting: bool, label: str = "label") -> DataFrame:
    """(tree, node, found_rows, found_total) of every leaf that a row of ``found``
    (:func:`reached`) reaches: its rows, and the sum of their label (a forest) or of their
    negative gradients (a boosting).  Summed in each task before the one shuffle of leaves."""
    return _summed(found.select(label, "leaves", "values").mapInArrow(_summing(boosting, label, *_tables(nodes)), LEAF_SUMS))


def routed_sums(rows: DataFrame, nodes: DataFrame, boosting: bool, depth: int, label: str = "label", vector: str = "features") -> DataFrame:
    """:func:`leaf_sums` of rows that are routed in the same tasks: leaves of single rows
    stay in the task that finds them."""
    return _summed(reached(rows, nodes, [label], depth, vector, then=(_summing(boosting, label, *_tables(nodes)), LEAF_SUMS)))


def _tables(nodes: DataFrame) -> tuple[int, int]:
    return tuple(nodes.agg(F.max("tree") + 1, F.max("node") + 1).first())


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("tree", "node").agg(F.sum("n").alias("found_rows"), F.sum("t").alias("found_total"))


def wrong_boosting_leaves(nodes: DataFrame, found: DataFrame, label: str = "label") -> DataFrame:
    """(tree, node, rows, mean, found_rows, found_mean) of the leaves that the training
    rows (:func:`reached` or their :func:`leaf_sums`) contradict.  The first tree is fitted to the label as -1 or 1,
    every later one to the negative gradient of the log loss at the margin of the trees
    before it, and a leaf predicts the mean of its rows."""
    sums = found if "found_rows" in found.columns else leaf_sums(nodes, found, True, label)
    sums = sums.select("tree", "node", "found_rows", (F.col("found_total") / F.col("found_rows")).alias("found_mean"))
    leaves = nodes.where("left < 0").select("tree", "node", "rows", F.col("prediction").alias("mean"))
    both = leaves.join(sums, ["tree", "node"], "full")
    same = (F.col("rows") == F.col("found_rows")) & (F.abs(F.col("mean") - F.col("found_mean")) <= LEAF_AGREE)
    return both.where(~F.coalesce(same, F.lit(False)))


def wrong_forest_leaves(nodes: DataFrame, found: DataFrame, label: str = "label") -> DataFrame:
    """(tree, node, stats, zeros, ones) of the leaves that the training rows
    (:func:`reached` or their :func:`leaf_sums`) contradict.  A tree's sample draws training rows with repeats, so a
    leaf holds weight of a label only if a training row of that label reaches it."""
    ones = F.col("found_total").cast("long")
    sums = found if "found_rows" in found.columns else leaf_sums(nodes, found, False, label)
    sums = sums.select("tree", "node", (F.col("found_rows") - ones).alias("zeros"), ones.alias("ones"))
    leaves = nodes.where("left < 0").select("tree", "node", "stats").join(sums, ["tree", "node"], "left").fillna(0, ["zeros", "ones"])
    bad = lambda i, n: (F.get("stats", F.lit(i)) > 0) & (F.col(n) == 0)
    return leaves.where(bad(0, "zeros") | bad(1, "ones"))


# ---------------------------------------------------------------- regressions
def logreg_probabilities(rows: DataFrame, coefficients: Sequence[float], intercept: float, keep: Sequence[str] = ("match_id",), vector: str = "features") -> DataFrame:
    """(*keep, probability) from the coefficients alone."""
    return rows.select(*keep, _logistic(vector, coefficients, intercept).alias("probability"))


def _logistic(vector: str, coefficients: Sequence[float], intercept: float) -> Column:
    product = F.zip_with(vector_to_array(F.col(vector)), F.array(*[F.lit(float(c)) for c in coefficients]), lambda x, c: x * c)
    return 1 / (1 + F.exp(-(F.aggregate(product, F.lit(0.0), lambda a, x: a + x) + float(intercept))))


def logreg_gradient(train: DataFrame, coefficients: Sequence[float], intercept: float, penalty: float, names: Sequence[str], vector: str = "features", label: str = "label") -> DataFrame:
    """(feature, coefficient, gradient): the gradient of mean log loss plus
    penalty / 2 * |coefficients|^2 at the given values, the intercept last and not
    penalised.  All entries are zero at the optimum and nowhere else.  The features have
    unit variance, so MLlib's own scaling changes nothing."""
    error = _logistic(vector, coefficients, intercept) - F.col(label).cast("double")
    rows = train.select(error.alias("_e"), vector_to_array(F.col(vector)).alias("_x"))
    sums = rows.agg(*[F.avg(F.col("_e") * F.get("_x", F.lit(i))).alias(f"_{i}") for i in range(len(names))], F.avg("_e").alias("_last"))
    entry = lambda name, c, g: F.struct(F.lit(name).alias("feature"), F.lit(float(c)).alias("coefficient"), g.alias("gradient"))
    entries = [entry(n, c, F.col(f"_{i}") + penalty * float(c)) for i, (n, c) in enumerate(zip(names, coefficients, strict=True))]
    return sums.select(F.inline(F.array(*entries, entry("(intercept)", intercept, F.col("_last")))))


def _spark():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()
