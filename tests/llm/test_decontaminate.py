import re

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import awkward, documents, empty

from pickwise.llm import decontaminate as D

WORD = re.compile(r"[^\W_]+")


def tokens(text):
    return WORD.findall((text or "").lower())


def plain_similarity(a, b):
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or [tuple(w)]
    from collections import Counter

    x, y = Counter(grams(a)), Counter(grams(b))
    shared = sum((x & y).values())
    return shared / (sum(x.values()) + sum(y.values()) - shared)


def best_of_all_stretches(item, w):
    """Greatest similarity of the item and any stretch of at least five words."""
    from collections import Counter

    own = Counter(tuple(item[i : i + 5]) for i in range(len(item) - 4))
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    best = 0.0
    for a in range(len(grams)):
        if grams[a] not in own:
            continue
        have, shared = Counter(), 0
        for b in range(a, min(len(grams), a + 2 * len(item))):
            have[grams[b]] += 1
            shared += have[grams[b]] <= own[grams[b]]
            best = max(best, shared / (own.total() + b - a + 1 - shared))
    return best


def items(spark, sf_dir):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]


def test_documents_against_all_windows(spark, sf_small):
    docs, bench = documents(spark, sf_small), items(spark, sf_small)
    got = {(r.doc_id, r.item_id): r.similarity for r in D.contaminated(docs, spark.read.parquet(f"{sf_small}/benchmark.parquet")).collect()}
    want = {}
    own = [(k, tokens(t)) for k, t in bench]
    shingles = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for _, w in own]
    for r in docs.collect():
        w = tokens(r.text)
        have = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        for (k, item), s in zip(own, shingles, strict=True):
            if len(s & have) >= 0.4 * len(s):  # a window of similarity 0.8 shares far more
                best = best_of_all_stretches(item, w)
                if best >= D.SIMILARITY:
                    want[r.doc_id, k] = best
    assert got.keys() == want.keys() and len(want) > 0
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def index(spark, sf_dir):
    return D.Index([(k, t.encode()) for k, t in items(spark, sf_dir)])


def test_edited_passages_are_found(spark, sf_small):
    bench, ix = items(spark, sf_small), index(spark, sf_small)
    rng, found, tried = np.random.default_rng(0), 0, 0
    for k, t in bench:
        w = tokens(t)
        if len(w) < 40:
            continue
        for _ in range(3):
            e = list(w)
            e[int(rng.integers(0, 3))] = "changed"  # one word near an end
            if plain_similarity(w, e) < D.SIMILARITY:
                continue
            text = " ".join(["lead", "in", "words", *e, "and", "more", "words", "after"] + tokens(bench[0][1])[:7])
            tried += 1
            found += any(ix.ids[x] == k for _, x in D.scan(ix, pa.array([text.encode()], pa.large_binary())))
    assert tried > 10 and found >= 0.9 * tried


def found_as(text, ix):
    return {ix.ids[x] for _, x in D.scan(ix, pa.array([text.encode()], pa.large_binary()))}


def test_passages_cut_where_the_text_begins_or_ends(spark, sf_small):
    bench, ix = items(spark, sf_small), index(spark, sf_small)
    tried = 0
    for k, t in bench:
        w = tokens(t)
        least = max((n for n in range(len(w) + 1) if plain_similarity(w, w[:n]) < D.SIMILARITY), default=0) + 1
        for n in {least, (least + len(w)) // 2, len(w) - 1}:
            if len(w) < 9 or n < least:
                continue
            more = "then other words that were never any part of it".split()
            for e in (w[:n], w[-n:], [*more, *w[:n]], [*w[-n:], *more], w[(len(w) - n) // 2 :][:n]):
                tried += 1
                assert k in found_as(" ".join(e), ix), (len(w), n, e)
    assert tried > 100


def test_passages_changed_within_are_found():
    rng = np.random.default_rng(4)
    more = "then other words that were never any part of it".split()
    for n, changed, runs in ((40, 1, 1), (80, 4, 1), (101, 6, 1), (101, 2, 2), (201, 17, 1), (201, 8, 2), (242, 22, 1), (242, 5, 5), (1000, 60, 4)):
        tried = 0
        for _ in range(60):
            w = [f"w{v}" for v in rng.integers(0, 2000, n)]
            e, cuts = list(w), sorted(rng.choice(np.arange(1, n - changed), runs, replace=False))
            for at in cuts:
                for i in range(at, at + max(1, changed // runs)):
                    e[i] = f"x{i}"
            if plain_similarity(w, e) >= D.SIMILARITY:
                tried += 1
                assert found_as(" ".join(more + e + more), D.Index([(1, " ".join(w).encode())])) == {1}, (n, changed, runs)
        assert tried


@pytest.mark.parametrize("kind", ["changed", "added", "dropped", "mixed"])
@pytest.mark.parametrize("n", [45, 100, 200, 400])
def test_passages_edited_as_far_as_the_similarity_allows(n, kind):
    """Single words changed, added or dropped all over the passage until its own similarity
    to the item would fall below the limit."""
    rng = np.random.default_rng(n)
    more, found, tried = "then other words that were never any part of it".split(), 0, 0
    for _ in range(40):
        w = [f"w{v}" for v in rng.integers(0, 2000, n)]
        e = list(w)
        while True:
            f, at = list(e), int(rng.integers(0, len(e)))
            what = kind if kind != "mixed" else ("changed", "added", "dropped")[int(rng.integers(0, 3))]
            f[at : at + (what != "added")] = [] if what == "dropped" else [f"x{rng.integers(0, 10**9)}"]
            if plain_similarity(w, f) < D.SIMILARITY:
                break
            e = f
        if e != w:
            tried += 1
            found += found_as(" ".join(more + e + more), D.Index([(1, " ".join(w).encode())])) == {1}
    assert tried > 4 and found >= 0.95 * tried, (found, tried)


def test_the_best_stretch_against_all_stretches():
    rng = np.random.default_rng(6)
    for _ in range(150):
        w = [f"w{v}" for v in rng.integers(0, 4, int(rng.integers(8, 30)))]  # few words: shingles repeat
        text = [f"w{v}" for v in rng.integers(0, 4, 8)] + list(w) + [f"w{v}" for v in rng.integers(0, 4, 8)]
        for _ in range(int(rng.integers(0, 3))):
            del text[int(rng.integers(0, len(text)))]
        ix = D.Index([(1, " ".join(w).encode())])
        h, _ = D.word_hashes(np.frombuffer(" ".join(text).encode(), np.uint8), np.array([0, len(" ".join(text))]))
        like, want = ix.best_stretch(0, D.shingles(h))[0], best_of_all_stretches(w, text)
        assert abs(like - (want if want >= D.SIMILARITY else 0.0)) < 1e-9


def test_every_fingerprint_within_the_radius_is_found(spark, sf_small):
    ix = index(spark, sf_small)
    rng = np.random.default_rng(1)
    for size, (own, *_) in ix.by_size.items():
        near = own[rng.integers(0, len(own), 200)]
        for i in range(200):
            for b in rng.choice(64, int(rng.integers(0, 12)), replace=False):
                near[i] ^= np.uint64(1 << int(b))
        pos, entry = ix.find(size, near)
        p, e = np.nonzero(np.bitwise_count(near[:, None] ^ own[None, :]) <= ix.radius)
        assert set(zip(pos.tolist(), entry.tolist(), strict=True)) == set(zip(p.tolist(), e.tolist(), strict=True))


def test_window_fingerprints_against_bit_counts():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2) + rng.integers(0, 2, 500).astype(np.uint64)
    for size in (1, 2, 7, 40, D.LARGEST):
        got = D.window_prints(D.counters(h), size)
        for i in (0, 3, len(got) - 1):
            ones = np.unpackbits(h[i : i + size].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0)
            assert got[i] == np.packbits(2 * ones.astype(int) > size, bitorder="little").view(np.uint64)[0]


def test_long_texts_in_parts(spark, sf_small):
    bench, ix = items(spark, sf_small), index(spark, sf_small)
    filler = "some other words that say nothing in particular "
    text = (filler * 900 + bench[3][1] + " " + filler * 700 + bench[5][1]).encode()
    whole = D.scan(ix, pa.array([text], pa.large_binary()))
    assert D.scan(ix, pa.array([text], pa.large_binary()), most=4000) == whole and len(whole) == 2


def test_awkward_rows(spark, sf_small):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog"), (2, None), (3, " !! "), (None, "çà et là"), (1, "quick brown fox jumps over the lazy dog")], "item_id bigint, text string")
    rows = D.contaminated(awkward(spark), bench).collect()
    assert sorted((str(r.doc_id), str(r.item_id)) for r in rows) == [("1", "1"), ("1", "1"), ("6", "None"), ("7", "1")]
    kept = D.without_contaminated(awkward(spark), bench)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "4", "5", "8", "None"] and kept.columns == awkward(spark).columns
    assert D.contaminated(empty(spark), bench).count() == 0
    assert D.contaminated(awkward(spark), bench.limit(0)).count() == 0 and D.without_contaminated(awkward(spark), bench.limit(0)).count() == 10
