import math
import random

import pytest
from pyspark.sql import functions as F

from pickwise.llm import hard_negatives as H

VECTORS = "vec_id bigint, embedding array<double>, label int"
INF = float("inf")


def brute(rows, is_anchor=lambda i: i % 100 == 0, positives=5, negatives=5):
    rows = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rows = list({(i, tuple(v), y) for i, v, y in rows})
    out = set()
    for i, v, y in rows:
        if i is None or not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=False)), INF if j is None else j, z) for j, w, z in rows]
        near = sorted({(s, j) for s, j, z in scored if z == y and j != i})[:positives]
        for s, j in near:
            fit = sorted({(t, k) for t, k, z in scored if z != y and 80 * -s <= 100 * -t <= 100 * -s})[:negatives]
            out |= {(i, None if j == INF else j, rank + 1, None if k == INF else k, -s, -t) for rank, (t, k) in enumerate(fit)}
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()), key=repr)


def vectors(n, dims, labels, seed, first=0):
    rnd = random.Random(seed)
    middle = [[rnd.gauss(0, 0.2) for _ in range(dims)] for _ in range(12)]
    return [(first + i, [m + rnd.gauss(0, 0.1) for m in rnd.choice(middle)], rnd.randrange(labels)) for i in range(n)]


def test_given_vectors_against_plain_code(spark, sf_small):
    given = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    moved = H.relabelled(given)
    rows = [(r.vec_id, r.embedding, r.label) for r in moved.collect()]
    labels = {r.vec_id: r.label for r in given.collect()}
    assert all(y == ((labels[i] + 1) % 10 if i % 7 == 0 else labels[i]) for i, _, y in rows)
    assert found(H.mine(moved)) == brute(rows)


@pytest.mark.parametrize("dims", [2, 48])
def test_parts_blocks_and_tiles_of_every_size(spark, monkeypatch, dims):
    monkeypatch.setattr(H, "TILE", 37)
    monkeypatch.setattr(H, "BLOCK", 5)
    rows = vectors(900, dims, 3, dims)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    assert found(H.mine(df, F.col("vec_id") % 20 == 0, 3, 4, part_bytes=20_000)) == brute(rows, lambda i: i % 20 == 0, 3, 4)


def test_awkward_rows(spark):
    rows = [(0, [0.5, 0.5], 1), (0, [0.5, 0.5], 1), (1, [0.5, 0.25], 1), (2, [0.25, 0.5], 2), (3, [0.25, 0.5], 2), (None, [0.5, 0.25], 1), (None, [0.25, 0.5], 2)]
    rows += [(4, None, 1), (5, [0.5, None], 2), (6, [0.5, float("nan")], 2), (7, [INF, 0.5], 2), (8, [0.5], None), (9, [], 2), (10, [0.4, 0.5, 0.9], 2), (11, [0.5], 1), (100, [], 2)]
    rows += [(200, [1.0] * 70, 5), (201, [-1.0] * 70, 5), (202, [1.0] * 70, 6)]  # a negative best score has no negatives
    rows += [(300, [0.1, 0.1], 8), (302, [0.1, 0.1], 8)]  # nobody of another label is near
    df = spark.createDataFrame([(*r, 1, 1, b"") for r in rows], f"{VECTORS}, part int, kind int, block binary")
    assert found(H.mine(df)) == brute(rows)
    assert H.mine(spark.createDataFrame([], VECTORS)).count() == 0


def test_scores_beyond_exact_doubles(spark):
    rows = [(0, [3e6, 1.0], 1), (1, [3e6, 2.0], 1), (2, [3e6, 1.0 - 2**-8], 2), (3, [3e6, 0.5], 2), (4, [2.9e6, 7.0], 2)]
    rows = [(i, [v[0], v[1], *[2e5] * 30], y) for i, v, y in rows]
    df = spark.createDataFrame(rows, VECTORS)
    assert found(H.mine(df)) == brute(rows)


def test_bounds_hold_and_drop_pairs(spark):
    import numpy as np

    rnd = np.random.default_rng(1)
    # segments of one sign: means say nearly all, so bounds drop most pairs
    whole = np.floor(256 * np.repeat(rnd.normal(size=(500, 8)), 8, axis=1) + rnd.normal(size=(500, 64)))
    rows = H.Rows(np.arange(500), np.zeros(500), whole)
    exact = whole @ whole.T
    for level in H.SEGMENTS:
        mean, spread = rows.segments(level)
        n = 64 // level
        middle, width = n * (mean @ mean.T), n * (spread @ spread.T)
        assert (exact <= middle + width + 1e-3).all() and (exact >= middle - width - 1e-3).all()
    least, high = np.sort(exact, 1)[:, -9].astype(np.int64), np.sort(exact, 1)[:, -3].astype(np.int64)
    filter_ = H.Filter()
    i, j, score = filter_.pairs(rows, rows, least, high, np.ones((500, 500), bool))
    assert not filter_.poor.get(8) and (score == exact[i, j]).all()
    want = np.nonzero((exact >= least[:, None]) & (exact <= high[:, None]))
    assert sorted(zip(i, j, strict=True)) == sorted(zip(*want, strict=True))
