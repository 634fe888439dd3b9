"""Forests and boostings of large tables, grown level by level over binned blocks of rows.

MLlib holds every training row as several objects (about 600 bytes of a forest of 100
trees) and updates their statistics one value at a time.  Here a task packs its rows into
blocks, one byte a value (its bin of at most 256), and adds up a block's statistics as
whole arrays.  The trees follow MLlib's rules: candidate thresholds from a sample of
about max(maxBins^2, 10,000) rows, all training rows in every statistic, Poisson weights
and random feature subsets in a forest, the negative gradient of the log loss in a
boosting, the same gain, stop and prune rules.  They become MLlib models by way of the
saved form of a model, so that scoring, saving and importances are MLlib's own.

A level is one pass over the blocks.  The statistics of a tree's (forest) or a node's
(boosting) rows are added up in each task, then by key in one shuffle, where the best
splits are found; only splits come back to the driver.  Functions that run in tasks are
shipped by value.
"""

from __future__ import annotations

import json
import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.plans.workspace import Workspace, file_system
from pickwise.session import shared_dir

FOREST_ROWS, BOOSTING_ROWS, BLOCK_BYTES = 32_768, 131_072, 16 << 20  # of one block at most
TASK_BYTES = 256 << 20  # of the blocks of one task at most
SAMPLE_ROWS = 10_000  # at least so many rows give the candidate thresholds
GROUP = 1_024  # most joint bins of the features that are counted together
KEEP_EVERY = 25  # trees of a boosting between two margins kept in the shared folder
EPSILON = 2.0 ** -52  # children of less impurity are leaves
LEAF = 255  # the cut of a node without children: every bin lies below
NODE = (
    "treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,"
    "leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>"
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ---------------------------------------------------------------- bins and blocks
def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` - 1 thresholds between the values of a feature's sample, by MLlib's
    rule: between all distinct values if they are few enough, else at equal strides of rows."""
    found, counts = np.unique(values, return_counts=True)
    middle = (found[:-1] + found[1:]) / 2.0
    if len(middle) <= most - 1:
        return middle
    stride, kept, reached = len(values) / most, [], np.cumsum(counts)
    target = stride
    for i in range(1, len(found)):
        if abs(reached[i - 1] - target) < abs(reached[i] - target):
            kept.append(middle[i - 1])
            target += stride
    return np.array(kept)


def _candidates(train: DataFrame, rows: int, vector: str, most: int, seed: int) -> list[np.ndarray]:
    share = max(most * most, SAMPLE_ROWS) / rows
    some = train.select(vector_to_array(F.col(vector)).alias("x"))
    sample = np.array([r.x for r in (some.sample(share, seed) if share < 1 else some).collect()])
    return [thresholds(sample[:, f], most) for f in range(sample.shape[1])]


def _packer(cuts: list[np.ndarray], size: int):
    """The function of a task that packs Arrow batches (x, y) into blocks (part, block, rows, x, y)."""

    def pack(batches):
        from pyspark import TaskContext

        part, made, xs, ys = TaskContext.get().partitionId(), 0, [], []

        def block():
            x, y = np.concatenate(xs, axis=1), np.concatenate(ys)
            names = ["part", "block", "rows", "x", "y"]
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([made], pa.int32()), pa.array([len(y)], pa.int32()), pa.array([x.tobytes()]), pa.array([y.tobytes()])], names)

        for batch in batches:
            for at in range(0, batch.num_rows, size):
                some = batch.slice(at, size)
                y = some.column("y").to_numpy(zero_copy_only=False)
                if not np.isin(y, (0.0, 1.0)).all():
                    raise ValueError("labels other than 0 and 1")
                x = some.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
                if sum(map(len, ys)) + len(y) > size:
                    yield block()
                    made, xs, ys = made + 1, [], []
                xs.append(np.stack([np.searchsorted(c, x[:, f]).astype("uint8") for f, c in enumerate(cuts)]))
                ys.append(y.astype("uint8"))
        if ys:
            yield block()

    return pack


def _unpack(r):
    y = np.frombuffer(r.y, "uint8")
    return r.part, r.block, np.frombuffer(r.x, "uint8").reshape(-1, r.rows), y


class _Blocks:
    """The training rows as a cached RDD of blocks; a lost block comes from the shared folder."""

    def __init__(self, train: DataFrame, rows: int, vector: str, label: str, most: int, seed: int, block_rows: int):
        self.spark, self.rows, self.kept = train.sparkSession, rows, []
        shared_dir(self.spark)  # makes sure a checkpoint directory is set
        self.cuts = _candidates(train, rows, vector, most, seed)
        self.bins = np.array([len(c) + 1 for c in self.cuts])
        size = max(1, min(block_rows, BLOCK_BYTES // len(self.cuts)))
        plain = train.select(vector_to_array(F.col(vector)).alias("x"), F.col(label).cast("double").alias("y"))
        packed = plain.mapInArrow(_packer(self.cuts, size), "part int, block int, rows int, x binary, y binary")
        # a pass is short beside the start of a Python task: one task a core
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-rows * len(self.cuts) // TASK_BYTES))
        self.data = self.keep(packed.repartition(tasks).rdd.map(_unpack))

    def keep(self, rdd: RDD, reliably: bool = True) -> RDD:
        rdd.persist(StorageLevel.MEMORY_AND_DISK)
        if reliably:
            rdd.checkpoint()
            rdd.count()
        self.kept.append(rdd)
        return rdd

    def drop(self, rdd: RDD) -> None:
        self.kept.remove(rdd)
        rdd.unpersist()
        if (path := rdd.getCheckpointFile()) is not None:
            fs, where = file_system(self.spark, path)
            fs.delete(where, True)

    def close(self) -> None:
        for rdd in list(self.kept):
            self.drop(rdd)


# ---------------------------------------------------------------- trees
def _impurity(s: np.ndarray) -> np.ndarray:
    """Gini impurity of class weights (..., 2), or variance of (count, sum, sum of squares) (..., 3)."""
    if s.shape[-1] == 2:
        n = s[..., 0] + s[..., 1]
        return 1.0 - (s[..., 0] / n) ** 2 - (s[..., 1] / n) ** 2
    return (s[..., 2] - s[..., 1] * s[..., 1] / s[..., 0]) / s[..., 0]


def _count(s: np.ndarray) -> np.ndarray:
    return s[..., 0] + s[..., 1] if s.shape[-1] == 2 else s[..., 0]


def best_splits(flat: np.ndarray, start: np.ndarray, bins: np.ndarray) -> tuple:
    """(slot, cut, gain, stats, left stats) of the best split of every node; the gain is
    -inf where no split parts the rows.  ``flat`` holds the statistics of the bins, those
    of a node's i-th feature from ``start[node, i]`` on, ``bins[node, i]`` of them."""
    width = max(2, int(bins.max()))
    at = np.arange(width)
    inside = at < bins[:, :, None]
    below = np.cumsum(np.where(inside[..., None], flat[np.where(inside, start[:, :, None] + at, 0)], 0.0), axis=2)
    total, left = below[:, :, -1:], below[:, :, :-1]
    right = total - left
    n, low, high = _count(total), _count(left), _count(right)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _impurity(total) - low / n * _impurity(left) - high / n * _impurity(right)
    parts = (at[:-1] < bins[:, :, None] - 1) & (low >= 1) & (high >= 1)
    gain = np.where(parts & (gain >= 0), gain, -np.inf).reshape(len(start), -1)
    best, nodes = gain.argmax(axis=1), np.arange(len(start))
    slot, cut = best // (width - 1), best % (width - 1)
    return slot, cut, gain[nodes, best], total[:, 0, 0], left[nodes, slot, cut]


def _down(x: np.ndarray, rows: np.ndarray, tree: tuple, levels: int) -> np.ndarray:
    """The node that every one of the given rows of a block reaches."""
    feature, cut, left = tree
    flat, first, at = x.reshape(-1), feature * x.shape[1], np.zeros(len(rows), "int64")
    for _ in range(levels):
        at = left.take(at) + (flat.take(first.take(at) + rows) > cut.take(at))
    return at


class Tree:
    """A tree while it grows; children follow each other, a node without children leads to itself."""

    def __init__(self, depth: int):
        self.depth, self.level = depth, 0
        self.feature, self.cut, self.left = [0], [LEAF], [0]
        self.gain, self.stats, self.parted = [-1.0], [None], [True]
        self.open = [0]

    def arrays(self) -> tuple:
        return np.array(self.feature), np.array(self.cut, "uint8"), np.array(self.left)

    def grow(self, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, stats: np.ndarray, lower: np.ndarray) -> None:
        """Splits the open nodes, one entry each; their children are the next open nodes."""
        upper, after = stats - lower, []
        pure = [(np.abs(_impurity(np.where(gain[:, None] > 0, s, 1.0))) < EPSILON) for s in (lower, upper)]
        for i, node in enumerate(self.open):
            self.stats[node], self.parted[node] = stats[i], bool(gain[i] >= 0)
            if gain[i] <= 0:
                continue
            child = len(self.feature)
            self.feature[node], self.cut[node], self.left[node], self.gain[node] = int(feature[i]), int(cut[i]), child, float(gain[i])
            for j, side in enumerate((lower[i], upper[i])):
                self.feature.append(0), self.cut.append(LEAF), self.left.append(child + j)
                self.gain.append(-1.0), self.stats.append(side), self.parted.append(True)
                if self.level + 1 < self.depth and not pure[j][i]:
                    after.append(child + j)
        self.open, self.level = after, self.level + 1

    def predictions(self) -> np.ndarray:
        """The label of the larger weight, or the mean, of every node."""
        s = np.array(self.stats)
        return (s[:, 1] > s[:, 0]).astype(float) if s.shape[1] == 2 else s[:, 1] / s[:, 0]

    def table(self, tree: int, cuts: list[np.ndarray]) -> list[tuple]:
        """The nodes as MLlib saves them: numbered from the root down, lower side first; two
        leaves of one prediction are one with their parent."""
        predicted, impurity, out = self.predictions(), _impurity(np.array(self.stats)), []
        merged = [self.left[i] == i for i in range(len(self.left))]
        for i in range(len(self.left) - 1, -1, -1):  # children come after their parent
            a = self.left[i]
            if a != i and merged[a] and merged[a + 1] and predicted[a] == predicted[a + 1]:
                merged[i] = True

        def put(i: int) -> int:
            at, s = len(out), self.stats[i]
            out.append(None)
            if merged[i]:
                kids, split, gain = (-1, -1), (-1, [], -1), -1.0
            else:
                kids = put(self.left[i]), put(self.left[i] + 1)
                split, gain = (self.feature[i], [float(cuts[self.feature[i]][self.cut[i]])], -1), self.gain[i]
            known = float(impurity[i]) if self.parted[i] else -1.0
            out[at] = (tree, (at, float(predicted[i]), known, [float(v) for v in s], round(float(_count(s))), gain, *kids, split))
            return at

        put(0)
        return out


# ---------------------------------------------------------------- forest
def poisson_table() -> tuple[np.ndarray, np.ndarray]:
    """(weights, distribution) of a Poisson law of mean 1: the weight of every 16-bit number,
    255 where the number's cell holds a step of the distribution."""
    steps = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])
    low, high = (np.searchsorted(steps, (np.arange(65_536) + i) / 65_536, side="right") for i in (0, 1))
    return np.where(low == high, low, 255).astype("uint8"), steps


def poisson(rng: np.random.Generator, n: int, table: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """``n`` draws: a 16-bit number each, and its further bits where they decide."""
    drawn = rng.integers(0, 65_536, n, dtype="uint16")
    weight = table.take(drawn)
    if len(open_ := np.flatnonzero(weight == 255)):
        weight[open_] = np.searchsorted(steps, (drawn[open_] + rng.random(len(open_))) / 65_536, side="right")
    return weight


def _forest_sums(trees, seed: int, whole: str):
    """The function of a task that adds up its rows by (tree, node, feature, bin, label)."""

    def add(blocks):
        sums, law = {}, poisson_table()
        for part, block, x, y in blocks:
            flat, n = x.reshape(-1), x.shape[1]
            for t, (tree, levels, place, feature, start, length) in trees.value.items():
                weight = poisson(np.random.default_rng([seed, part, block, t]), n, *law)
                rows = np.flatnonzero(weight != 0)
                node = place.take(_down(x, rows, tree, levels))
                if (node < 0).any():
                    rows, node = rows[node >= 0], node[node >= 0]
                w, ones = weight.take(rows).astype("float64"), y.take(rows)
                keys = np.empty((feature.shape[1], len(rows)), "int64")
                for key, of, begin in zip(keys, feature.T.copy() * n, start.T.copy() * 2):
                    at = of.take(node)
                    at += rows
                    bin_ = flat.take(at)
                    np.add(begin.take(node), ones, out=key)
                    key += bin_
                    key += bin_
                found = np.bincount(keys.ravel(), np.tile(w, len(keys)), minlength=2 * length)
                if t in sums:
                    sums[t] += found
                else:
                    sums[t] = found
        for t in list(sums):
            yield t, sums.pop(t).astype(whole)

    return add


def _forest_splits(trees, bins: np.ndarray):
    """The function of a task that adds up the sums of its trees and finds their splits."""

    def split(parts):
        sums = {}
        for t, found in parts:
            sums[t] = sums[t] + found if t in sums else found
        for t, found in sums.items():
            feature, start = trees.value[t][3:5]
            slot, *rest = best_splits(found.astype("float64").reshape(-1, 2), start, bins[feature])
            yield t, feature[np.arange(len(slot)), slot], *rest

    return split


def forest(estimator: Estimator, train: DataFrame, rows: int) -> Model:
    """``estimator`` (a random forest classifier) fitted on ``train`` of ``rows`` rows."""
    depth, count, seed = estimator.getMaxDepth(), estimator.getNumTrees(), estimator.getSeed()
    blocks = _Blocks(train, rows, estimator.getFeaturesCol(), estimator.getLabelCol(), estimator.getMaxBins(), seed, FOREST_ROWS)
    try:
        trees, width = [Tree(depth) for _ in range(count)], len(blocks.bins)
        some = math.ceil(math.sqrt(width)) if count > 1 else width
        whole = "int32" if rows < 1 << 29 else "int64"
        while any(t.open for t in trees):
            sent = {}
            for t, tree in enumerate(trees):
                if not tree.open:
                    continue
                feature = np.argsort(np.random.default_rng([seed, t, tree.level]).random((len(tree.open), width)), axis=1)[:, :some]
                ends = np.cumsum(blocks.bins[feature].ravel())
                place = np.full(len(tree.feature), -1)
                place[tree.open] = np.arange(len(tree.open))
                start = (ends - blocks.bins[feature].ravel()).reshape(feature.shape)
                sent[t] = tree.arrays(), tree.level, place, feature, start, int(ends[-1])
            shared = blocks.spark.sparkContext.broadcast(sent)
            sums = blocks.data.mapPartitions(_forest_sums(shared, seed, whole))
            parts = max(1, min(len(sent), 2 * blocks.spark.sparkContext.defaultParallelism))
            for t, *found in sums.partitionBy(parts).mapPartitions(_forest_splits(shared, blocks.bins)).collect():
                trees[t].grow(*found)
            shared.destroy()
        return _model(estimator, trees, [1.0] * count, blocks)
    finally:
        blocks.close()


# ---------------------------------------------------------------- boosting
def _residual(y: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    """What a tree is fitted to: the label as -1 or 1, later the negative gradient of the log loss."""
    sign = 2.0 * y - 1.0
    if margin is None:
        return sign
    with np.errstate(over="ignore"):  # a far margin: gradient zero
        return 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))


def joint_groups(bins: np.ndarray) -> list[list[int]]:
    """Features counted together: in order, as long as their joint bins are at most GROUP
    (each feature's bins rounded up to a power of two)."""
    groups, size = [[]], 1
    for f in np.argsort(bins, kind="stable"):
        if groups[-1] and size << _bits(bins[f]) > GROUP:
            groups.append([])
            size = 1
        groups[-1].append(int(f))
        size <<= _bits(bins[f])
    return groups


def _bits(n: int) -> int:
    return max(0, int(n) - 1).bit_length()


def _layout(bins: np.ndarray) -> tuple:
    """(groups, and by feature: its group, the place of its bits in the group's code, their mask)."""
    groups, of, shift = joint_groups(bins), np.zeros(len(bins), "int64"), np.zeros(len(bins), "int64")
    for g, members in enumerate(groups):
        at = 0
        for f in members:
            of[f], shift[f] = g, at
            at += _bits(bins[f])
    return groups, of, shift, np.array([(1 << _bits(n)) - 1 for n in bins])


def _coded(layout: tuple):
    """The function that turns a block's bins into the codes of its groups, without margins."""
    groups, _, shift, _ = layout

    def code(block):
        part, number, x, y = block
        codes = np.zeros((len(groups), len(y)), "uint16")
        for g, members in enumerate(groups):
            for f in members:
                codes[g] += x[f].astype("uint16") << np.uint16(shift[f])
        return part, number, codes, y, None

    return code


def _down_codes(codes: np.ndarray, tree: tuple, layout: tuple, levels: int) -> np.ndarray:
    """The node that every row of a block reaches."""
    (feature, cut, left), (_, of, shift, mask) = tree, layout
    n = codes.shape[1]
    flat, rows, at = codes.reshape(-1), np.arange(n), np.zeros(n, "int64")
    first, shift, mask = of[feature] * n, shift[feature].astype("uint16"), mask[feature].astype("uint16")
    for _ in range(levels):
        code = flat.take(first.take(at) + rows)
        at = left.take(at) + ((code >> shift.take(at)) & mask.take(at) > cut.take(at))
    return at


def _boosting_sums(tree: tuple, levels: int, place: np.ndarray, bins: np.ndarray, layout: tuple):
    """The function of a task that adds up its rows by (node, feature, bin)."""
    groups, _, shift, mask = layout
    start, nodes = np.cumsum(bins) - bins, int(place.max()) + 1
    sizes = [1 << sum(_bits(bins[f]) for f in g) for g in groups]

    def add(blocks):
        joint = [np.zeros((3, nodes * n)) for n in sizes]
        for _, _, codes, y, margin in blocks:
            target = _residual(y, margin)
            node = place.take(_down_codes(codes, tree, layout, levels))
            if (node < 0).any():
                rows = np.flatnonzero(node >= 0)
                node, target, codes = node[rows], target[rows], codes[:, rows]
            weights = (None, target, target * target)
            for code, n, total in zip(codes, sizes, joint):
                key = node * n + code
                for i, w in enumerate(weights):
                    total[i] += np.bincount(key, w, nodes * n)
        sums = np.zeros((nodes, int(bins.sum()), 3))
        for members, n, total in zip(groups, sizes, joint):
            cells = total.reshape(3, nodes, n)
            for f in members:
                bin_ = (np.arange(n) >> shift[f]) & mask[f]
                for b in range(bins[f]):
                    sums[:, start[f] + b] = cells[:, :, bin_ == b].sum(axis=2).T
        yield from enumerate(sums)

    return add


def _boosting_splits(bins: np.ndarray):
    """The function of a task that adds up the sums of its nodes and finds their splits."""

    def split(parts):
        sums = {}
        for i, found in parts:
            sums[i] = sums[i] + found if i in sums else found
        for i, found in sums.items():
            yield i, *(v[0] for v in best_splits(found, (np.cumsum(bins) - bins)[None], bins[None]))

    return split


def _add_tree(tree: tuple, levels: int, value: np.ndarray, layout: tuple):
    """The function that adds a tree's values to a block's margins."""

    def add(block):
        part, number, codes, y, margin = block
        more = value.take(_down_codes(codes, tree, layout, levels))
        return part, number, codes, y, more if margin is None else margin + more

    return add


def boosting(estimator: Estimator, train: DataFrame, rows: int) -> Model:
    """``estimator`` (a boosting classifier) fitted on ``train`` of ``rows`` rows."""
    depth, step = estimator.getMaxDepth(), estimator.getStepSize()
    blocks = _Blocks(train, rows, estimator.getFeaturesCol(), estimator.getLabelCol(), estimator.getMaxBins(), estimator.getSeed(), BOOSTING_ROWS)
    try:
        layout = _layout(blocks.bins)
        state, old, trees = blocks.data.map(_coded(layout)), [], []
        weights = [1.0] + [step] * (estimator.getMaxIter() - 1)
        for t, weight in enumerate(weights):
            tree = Tree(depth)
            while tree.open:
                place = np.full(len(tree.feature), -1)
                place[tree.open] = np.arange(len(tree.open))
                sums = state.mapPartitions(_boosting_sums(tree.arrays(), tree.level, place, blocks.bins, layout))
                found = sums.partitionBy(1).mapPartitions(_boosting_splits(blocks.bins))
                tree.grow(*(np.array(v) for v in list(zip(*sorted(found.collect(), key=lambda r: r[0])))[1:]))
                while old:  # the first pass over new margins has cached them
                    blocks.drop(old.pop())
            trees.append(tree)
            if t + 1 < len(weights):
                if t:
                    old.append(state)
                added = state.map(_add_tree(tree.arrays(), depth, weight * tree.predictions(), layout))
                state = blocks.keep(added, reliably=(t + 1) % KEEP_EVERY == 0)
        return _model(estimator, trees, weights, blocks)
    finally:
        blocks.close()


# ---------------------------------------------------------------- models
def _model(estimator: Estimator, trees: list[Tree], weights: list[float], blocks: _Blocks) -> Model:
    """The trees as a model of MLlib: the saved form of a small model of the estimator with
    its parameters, weights and nodes exchanged, loaded."""
    spark, width = blocks.spark, len(blocks.cuts)
    forest = estimator.hasParam("numTrees")
    count, own = ("numTrees" if forest else "maxIter"), {p.name: v for p, v in estimator.extractParamMap().items() if estimator.isSet(p)}
    names = [estimator.getFeaturesCol(), estimator.getLabelCol()]
    two = spark.createDataFrame([(Vectors.dense([float(y)] * width), float(y)) for y in (0, 1)], names).coalesce(1)
    with Workspace(spark, "model") as work:
        small = estimator.copy({estimator.getParam(count): 1, estimator.maxDepth: 1}).fit(two)
        small.write().overwrite().save(base := work.folder("small"))
        path = work.folder("grown")

        def with_own(text: str) -> dict:
            meta = json.loads(text)
            meta["paramMap"] |= {k: v for k, v in own.items() if k in meta["paramMap"]}
            return meta

        meta = with_own(spark.read.text(f"{base}/metadata").first()["value"]) | {"numTrees": len(trees)}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        one = spark.read.parquet(f"{base}/treesMetadata")
        each = json.dumps(with_own(one.first()[1]))
        spark.createDataFrame([(t, each, w) for t, w in enumerate(weights)], one.schema).coalesce(1).write.parquet(f"{path}/treesMetadata")
        nodes = [row for t, tree in enumerate(trees) for row in tree.table(t, blocks.cuts)]
        spark.createDataFrame(nodes, NODE).write.parquet(f"{path}/data")
        return type(small).load(path)
