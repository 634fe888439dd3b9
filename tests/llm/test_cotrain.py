import numpy as np
from llm_cases import awkward, documents, empty
from pyspark.sql import functions as F

from pickwise.llm import cotrain as C


def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, lab = documents(spark, sf_dir), labels(spark, sf_dir)
    model = C.learn(docs, lab.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 0))
    back = lab.filter(F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    rows = C.score(docs, model).join(back, "doc_id").select("quality", "keep").collect()
    assert len(rows) > 100
    assert np.mean([r.keep == bool(r.quality) for r in rows]) > 0.95
    good = [r.keep for r in rows if r.quality]
    assert np.mean(good) > 0.98


def test_accepted_rows_are_those_that_score_enough(spark, sf_small):
    docs = documents(spark, sf_small)
    model = C.learn(docs, labels(spark, sf_small))
    keep = {r.doc_id for r in C.score(docs, model).filter("keep").collect()}
    out = C.accepted(docs, model)
    assert {r.doc_id for r in out.collect()} == keep and out.columns == docs.columns


def test_views_exchange_labels():
    """The content view knows hardly any labels; the other view's pseudo-labels teach it."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 2040)
    noisy = (y[:, None] * 2 - 1 + rng.normal(0, 1.2, (2040, 12))).astype(np.float32)
    clear = (y[:, None] * 6 - 3 + rng.normal(0, 1, (2040, 1))).astype(np.float32)
    own, pool = slice(0, 40), slice(40, 1040)
    def exchange(model):
        out = []
        for to, by in ((0, 1), (1, 0)):
            x = (noisy[pool], clear[pool])
            w, (a, b) = model[by]
            p = C.sigmoid(a * C.logits(x[by], w) + b)
            sure = np.maximum(p, 1 - p) >= C.SURE
            out.append((x[to][sure], (p[sure] >= 0.5).astype(float), np.ones(sure.sum())) if sure.any() else None)
        return out

    few = C.cotrained(noisy[own], clear[own], y[own].astype(float), np.ones(40), exchange)
    alone = C.fitted(noisy[own], y[own].astype(float), np.ones(40))
    test = slice(1040, None)
    right = lambda z: np.mean((z > 0) == y[test])
    assert right(C.logits(noisy[test], few.content[0])) >= right(C.logits(noisy[test], alone))
    p = few.probabilities(noisy[test], clear[test])[2]
    assert np.mean((p > 0.5) == y[test]) > 0.98


def test_a_round_of_exchange_against_plain_code(spark, sf_small):
    """Over all unlabelled documents, whatever the sample: labels, counts, the least hashes."""
    docs, lab = documents(spark, sf_small), labels(spark, sf_small).select("doc_id").distinct()
    rows = C.vectors(docs)
    data = rows.toArrow()
    x = [C.unpacked(data.column(c)) for c in ("content", "metadata")]
    rng = np.random.default_rng(3)
    model = [(rng.normal(0, 1, v.shape[1] + 1).astype(np.float32), (0.7, 0.1)) for v in x]
    labelled = {r.doc_id for r in lab.collect()}
    want, sample = {}, 12
    for v, (w, (a, b)) in enumerate(model):
        p = C.sigmoid(a * (x[v] @ w[:-1] + w[-1]).astype(np.float64) + b)
        for i, doc in enumerate(data.column("doc_id").to_pylist()):
            if max(p[i], 1 - p[i]) >= C.SURE and doc not in labelled:
                want.setdefault((v, int(p[i] >= 0.5)), []).append((data.column("h")[i].as_py(), doc))
    chosen, counts = C.Exchange(rows, lab, sample).chosen(model)
    assert counts == {k: len(set(d)) for k, d in want.items()} and max(counts.values()) > sample
    got = {}
    for r in chosen.collect():
        got.setdefault((r.view, r.y), set()).add((r.h, r.doc_id))
    assert got == {k: set(sorted(set(d))[:sample]) for k, d in want.items()}
    given = C.Exchange(rows, lab, sample)(model)
    for v in (0, 1):
        xs, ys, share = given[1 - v]
        assert xs.shape == (sum(len(got.get((v, y), ())) for y in (0, 1)), x[1 - v].shape[1])
        assert all(abs(share[ys == y].sum() - counts.get((v, y), 0)) < 1e-6 for y in (0, 1))


def test_calibration_meets_the_share_of_labels():
    rng = np.random.default_rng(1)
    y = (rng.random(4000) < 0.2).astype(float)
    z = 9 * (y - 0.5) + rng.normal(0, 6, 4000)
    a, b = C.platt(z, y, np.ones(4000))
    assert abs(C.sigmoid(a * z + b).mean() - 0.2) < 0.02


def test_awkward_rows(spark):
    docs = awkward(spark)
    lab = lambda rows: spark.createDataFrame(rows, "doc_id bigint, quality int")
    for rows, share in (([], 1.0), ([(1, 1), (1, 1)], 1.0), ([(5, 0)], 0.0), ([(1, None), (None, 1)], 1.0)):
        got = C.score(docs, C.learn(docs, lab(rows))).collect()
        assert len(got) == 10 and all(r.score == share for r in got)
    model = C.learn(docs, lab([(1, 1), (6, 1), (7, 1), (5, 0), (5, 1), (8, 0), (2, 0), (3, 0), (4, 0), (99, 1)]))
    got = C.score(docs, model).collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    assert C.score(empty(spark), model).count() == 0 and C.accepted(docs, model).columns == docs.columns


def test_long_texts_in_parts_and_in_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(2)
    some = [b"word", b"two words", b"WORD.", b"12|34", b"!!", b"\n", b"\n\n", b"same line of text\n", "é．".encode(), b" ", b"."]
    chars = np.array([9000.0])
    for _ in range(5):
        text = b" ".join(some[i] for i in rng.integers(0, len(some), 1500))
        data, off = np.frombuffer(text, np.uint8), np.array([0, len(text)])
        whole = C.content_view(data, off), C.metadata_view(data, off, ["en"], ["a"], chars)
        for step in (64, 1000, 1 << 20):
            parts = C.views_of_long(data, "en", "a", chars, step)
            assert all(np.allclose(x, y, rtol=1e-5, atol=1e-6) for x, y in zip(whole, parts, strict=True))
    data = np.frombuffer(b" ".join(b"w%d" % i for i in rng.integers(0, 50_000, 8_000_000)) + b".\n", np.uint8)
    assert len(data) > 50_000_000
    tracemalloc.start()
    C.views_of_long(data, "en", "a", chars)
    assert tracemalloc.get_traced_memory()[1] < 600_000_000
    tracemalloc.stop()
