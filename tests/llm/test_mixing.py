from collections import defaultdict

import numpy as np
import pyspark.sql.functions as F
from llm_cases import ROWS, awkward, documents, empty

from pickwise.llm import mixing as M
from pickwise.plans.guards import plan_text


def plain_targets(size):
    """Targets by filling in plain Python: {source: target}."""
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [s for s in size if s is None]
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(names)}
    out, open_, rest = {}, list(names), float(sum(size.values()))
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_} if open_ else {}
        full = [s for s in open_ if share[s] > 3 * size[s]]
        if not full:
            return out | share
        for s in full:
            out[s] = 3.0 * size[s]
            rest -= out[s]
        open_ = [s for s in open_ if s not in full]


def check(docs, rows, near):
    size, got = defaultdict(int), M.mixed_sources(docs).collect()
    for r in rows:
        size[r[1]] += len((r[0] or "").encode().split())
    want, taken = plain_targets(size), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        ratio = r.target / r.source_size if r.source_size else 0
        assert int(ratio + 1e-9) <= r.copies <= np.ceil(ratio - 1e-9) or r.size == 0 or not r.source_size
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= near(size[s])


def test_documents(spark, sf_small):
    docs = documents(spark, sf_small)
    check(docs, [(r.text, r.source) for r in docs.collect()], lambda n: 0.5 * n)
    big = documents(spark, "/root/testdata/sf0.01")
    check(big, [(r.text, r.source) for r in big.collect()], lambda n: 0.06 * n)


def test_levels_balance_tokens_and_documents(spark):
    """Small groups: documents pass several levels; totals stay near on both counts."""
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 60))), "s" + str(i % 3 if i % 7 else 0)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = M.mixed_sources(df.select("*"), group=64).collect()
    for s in ("s0", "s1", "s2"):
        own = [r for r in got if r.source == s]
        target, size = own[0].target, own[0].source_size
        assert abs(sum(r.taken for r in own) - target) <= 0.01 * target
        assert abs(sum(r.copies for r in own) - len(own) * target / size) <= 2


def test_reruns_and_partitions_agree(spark, sf_small):
    docs = documents(spark, sf_small)
    one = sorted(map(tuple, M.mix(docs).collect()))
    assert one == sorted(map(tuple, M.mix(docs.repartition(7)).collect()))


def test_one_move_keeps_both_totals():
    rng = np.random.default_rng(1)
    for _ in range(50):
        p, x = rng.random(200), rng.integers(1, 1000, 200).astype(float)
        q = M.flight(p, x, rng.integers(-(1 << 62), 1 << 62, 200))
        assert abs(q.sum() - p.sum()) < 1e-6 and abs(q @ x - p @ x) < 1e-3
        assert ((q > M.EPS) & (q < 1 - M.EPS)).sum() <= 2


def test_inclusion_probabilities_keep_their_expectation():
    p, x = np.array([0.2, 0.5, 0.7, 0.4, 0.9]), np.array([3.0, 8.0, 5.0, 1.0, 4.0])
    rng = np.random.default_rng(2)
    mean = np.mean([M.flight(p, x, rng.integers(-(1 << 62), 1 << 62, 5)) for _ in range(4000)], axis=0)
    assert np.abs(mean - p).max() < 0.03


def test_one_huge_document_is_settled_and_made_up_for():
    rng = np.random.default_rng(3)
    x = np.concatenate(([20000.0], rng.integers(20, 800, 300).astype(float)))
    p = np.concatenate(([0.3], rng.random(300)))
    first = []
    for _ in range(300):
        q = M.flight(p, x, rng.integers(-(1 << 62), 1 << 62, 301))
        assert abs(q @ x - p @ x) < 1e-3 and abs(q.sum() - p.sum()) < 1e-6
        assert q[0] < M.EPS or q[0] > 1 - M.EPS
        first.append(q[0])
    assert abs(np.mean(first) - 0.3) < 0.08


def test_awkward_rows(spark):
    check(awkward(spark), [(r[1], r[3]) for r in ROWS], lambda n: 3 * n + 60000)
    assert M.mix(empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")
    assert [(r.size, r.target, r.taken) for r in M.mix(blank).collect()] == [(0, 0.0, 0)] * 2


def test_source_table_broadcast_or_salted_gives_the_same_mix(spark):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 40}" if i % 3 else "hot") for i in range(900)] + [(901, "a b", None), (901, "a b", None), (None, None, "hot")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3, "doc_id")
    plain, salted = (M.mixed_sources(docs, group=64, most=m) for m in (M.MAX_BROADCAST_BYTES, 0))
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.collect()))
    table = spark.createDataFrame([("hot", 1), (None, 2), ("s1", 3)], "source string, x int")
    keyed = docs.withColumn("row", F.monotonically_increasing_id())
    count = lambda m: sorted((str(r.source), r.x, r["count"]) for r in M.by_source(keyed, table, m).groupBy("source", "x").count().collect())
    assert count(0) == count(1 << 20) == [("None", 2, 2), ("hot", 1, 301), ("s1", 3, sum(r[2] == "s1" for r in rows))]
    assert "BroadcastHashJoin" in plan_text(M.by_source(keyed, table)) and "BroadcastHashJoin" not in plan_text(M.by_source(keyed.hint("merge"), table, 0))
