import numpy as np
import xxhash
from llm_cases import ROWS, awkward, documents, empty

from pickwise.llm import near_dups as N


def plain_print(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(prints, radius=3):
    """Smallest index reachable, by comparing all pairs."""
    fp = np.array(prints, np.uint64)
    label = np.arange(len(fp))
    for i in range(len(fp)):
        for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= radius):
            a, b = label[i], label[j]
            if a != b:
                label[label == max(a, b)] = min(a, b)
    return label


def check(docs, rows):
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in N.near_duplicates(docs).collect() if r.doc_id is not None)
    fp = [plain_print(t) for _, t in rows]
    label = plain_components(fp)
    least = {}
    for (i, _), c in zip(rows, label, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    assert got == sorted((i, f"{f:016x}", least[c]) for (i, _), f, c in zip(rows, fp, label, strict=True) if i is not None)


def test_documents_against_all_pairs(spark, sf_small):
    docs = documents(spark, sf_small)
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_rows(spark):
    check(awkward(spark), [r[:2] for r in ROWS])
    assert N.near_duplicates(awkward(spark)).count() == len(ROWS)
    assert N.near_duplicates(empty(spark)).count() == 0
    kept = N.one_of_each(awkward(spark)).select("doc_id").collect()
    assert sorted(r[0] for r in kept if r[0] is not None) == [1, 2, 5, 6, 8]


def clustered(seed, n):
    """Fingerprints in clusters around random centres, some of them dense."""
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        c = int(rng.integers(0, 1 << 63))
        for _ in range(int(rng.integers(1, 8)) if k else 400):
            x = c
            for b in rng.integers(0, 64, int(rng.integers(0, 6))):
                x ^= 1 << int(b)
            out.append(x)
    return sorted(set(out))


def test_index_and_star_rounds_against_all_pairs(spark):
    prints = clustered(1, 60)
    nodes = spark.createDataFrame([(N.signed(x),) for x in prints], "fp bigint")
    want = plain_components(prints)
    for chunk in (2000, 40):  # 40: hot patterns are split into chunks
        edges = N.links(nodes, chunk=chunk)
        assert edges.count() <= 4 * 2 * len(prints) * (1 + len(prints) // chunk)  # forests, not all pairs
        found = {r.node & (2**64 - 1): r.root for r in N.components(edges).collect()}
        groups = {}
        for x, c in zip(prints, want, strict=True):
            groups.setdefault(c, set()).add(x)
        got = {}
        for x in prints:
            got.setdefault(found.get(x, ("own", x)), set()).add(x)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_tree_finds_every_pair():
    code = np.array(clustered(2, 40), np.uint64)
    code = code[np.argsort(N.gray_rank(code))]
    i, j = (np.concatenate(x) for x in zip(*N.tree_links(code, 3), strict=True))
    near = np.bitwise_count(code[:, None] ^ code[None, :]) <= 3
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(a, b) for a, b in zip(*np.nonzero(near), strict=True) if a < b}


def test_masks_cover_every_difference():
    for n in (10, 10**7, 10**10):
        blocks = N.blocks_for(n, 3)
        masks = N.masks(blocks, 3)
        rng = np.random.default_rng(n)
        for _ in range(300):
            diff = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
            assert any(not diff & m for m in masks)


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a bigint, b bigint")
    got = {r.node: r.root for r in N.components(edges).collect()}
    assert got == {i: 0 for i in range(301)}


def test_rows_of_one_id_with_different_texts_stay_apart(spark):
    a, b = "one two three four five six seven eight nine ten", "completely other words that share nothing with it at all"
    rows = [(5, a), (5, a), (5, b), (9, a), (None, b), (None, "alone without any id in a text of its own"), (None, "alone without any id in a text of its own")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, _id string").repartition(3)
    kept = sorted(((r.doc_id, r.text) for r in N.one_of_each(docs).collect()), key=repr)
    assert kept == sorted([(5, a), (5, b), rows[5], rows[6]], key=repr)
    assert N.one_of_each(docs).columns == docs.columns
