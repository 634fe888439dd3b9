import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from llm_cases import awkward, documents, empty

from pickwise.llm import langid as L
from pickwise.llm.common import flat, lowered


def plain_tree(texts):
    count = defaultdict(lambda: defaultdict(int))
    for t in texts:
        b = b"\n\n\n" + lowered(np.frombuffer(t.encode(), np.uint8)).tobytes()
        for i in range(3, len(b)):
            for k in range(4):
                count[b[i - k : i]][b[i]] += 1
    return count


def plain_bits(count, text):
    """Code length under method C, context by context."""
    b = b"\n\n\n" + lowered(np.frombuffer(text.encode(), np.uint8)).tobytes()
    total = 0.0
    for i in range(3, len(b)):
        bits = 0.0
        for k in (3, 2, 1, 0):
            seen = count.get(b[i - k : i])
            if not seen:
                continue
            n, d = sum(seen.values()), len(seen)
            if b[i] in seen:
                bits -= math.log2(seen[b[i]] / (n + d))
                break
            bits -= math.log2(d / (n + d))
        else:
            bits += 8
        total += bits
    return total


def test_code_lengths_against_plain_context_trees(spark):
    docs = {"en": ["The cat sat.", "a hat", "THE end"], "fr": ["été à la plage", "le chat"], "x": ["0101"]}
    rows = [(t, k) for k, v in docs.items() for t in v]
    model = L.tree(L.gram_counts(spark.createDataFrame(rows, "text string, lang string").repartition(2)))
    assert model.langs == ["en", "fr", "x"]
    trees = [plain_tree(docs[k]) for k in model.langs]
    for text in ("the chat sat à la", "zzz\t9", "0 1 É", ""):
        data, off = flat(pa.array([text.encode()], pa.large_binary()))
        assert np.allclose(model.lengths(data, off)[0], [plain_bits(c, text) for c in trees], rtol=1e-4, atol=1e-3)


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = documents(spark, sf_dir)
    rows = L.identify(docs, L.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and len(held) > 150
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_a_small_model_still_tells_languages_apart(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    small = L.learn(docs, model_bytes=400_000)
    assert sum(c.nbytes for c in small.cost) <= 400_000
    rows = L.identify(docs, small).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97


def test_many_languages_keep_every_context(spark, monkeypatch):
    rng = np.random.default_rng(3)
    docs = {}
    for i in range(60):
        chars = [chr(c) for c in rng.choice(np.arange(0x61, 0x2000), 40, replace=False) if c != 0x7F]
        docs[f"l{i:02}"] = ["".join(rng.choice(chars, 400 if i else 4000)) for _ in range(3)]
    rows = [(t, k) for k, v in docs.items() for t in v]
    model = L.tree(L.gram_counts(spark.createDataFrame(rows, "text string, lang string").repartition(2)))
    trees = [plain_tree(docs[k]) for k in model.langs]
    for text in (docs["l59"][0][:50], docs["l00"][1][:50] + docs["l30"][2][:50]):
        data, off = flat(pa.array([text.encode()], pa.large_binary()))
        assert np.allclose(model.lengths(data, off)[0], [plain_bits(c, text) for c in trees], rtol=1e-4, atol=1e-3)
    texts = spark.createDataFrame([(i, v[0][:20]) for i, v in enumerate(docs.values())], "doc_id bigint, text string")
    one = sorted(map(tuple, L.identify(texts, model).collect()))
    assert [r[2] for r in one] == list(docs)
    monkeypatch.setattr(L, "MODEL_BYTES", 100_000)
    assert len(model.blocks()) > 5 and sorted(map(tuple, L.identify(texts, model).collect())) == one


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = L.identify(docs, L.learn(docs)).collect()
    assert len(got) == 10
    for r in got:
        if r.doc_id in (2, 3, 4):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "fr", "de")
        assert r.held_out if r.doc_id is None else r.held_out is not None
    assert L.identify(empty(spark), L.learn(empty(spark))).count() == 0
    assert {r.lang_pred for r in L.identify(docs, None).collect()} == {"und"}
    one = spark.createDataFrame([(1, "123 é"), (2, "123")], "doc_id bigint, text string")
    assert [r.lang_pred != "und" for r in L.identify(one, L.learn(docs)).orderBy("doc_id").collect()] == [True, False]


def test_long_texts_in_parts():
    import numpy as np

    text = ("ÀÉ café, l'été — ΑΒΓ naïveté É" * 60).encode()
    data, off = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    whole = L.grams(data, off)
    for most in (1, 2, 3, 7, 100):
        assert (np.concatenate(list(L.gram_parts(data, off, most))) == whole).all()
