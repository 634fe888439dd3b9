from itertools import product

import numpy as np
from llm_cases import awkward, documents, empty

from pickwise.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def model_of(words):
    low = np.frombuffer((" ".join(words) + " ").encode(), np.uint8)
    s = T._CODE[low]
    pad = np.concatenate(([0, 0], s))
    code, n = np.unique((pad[:-2] * T.MODEL_SIZE + pad[1:-1]) * T.MODEL_SIZE + s, return_counts=True)
    return T.CharModel(code, n)


def restored(model, text):
    low = np.frombuffer(text.encode(), np.uint8)
    out, _, _ = T.restore(model, T.lowered(low), np.array([0, len(low)]))
    return out.tobytes().decode()


def test_disguises_are_undone_and_plain_text_stays():
    m = model_of(["idiot", "moron", "stupid", "the", "clown", "loser", "trash", "balloon", "see", "was"] * 50)
    for text, want in (
        ("the m0r0n was", "the moron was"), ("1d10t", "idiot"), ("stuuuupid!!", "stupid!!"), ("see m o r o n", "see moron"),
        ("c.l.o.w.n", "clown"), ("m.0.r.0.n", "moron"), ("see m 0 r 0 n", "see moron"), ("m  o  r  o  n", "moron"), ("mmoorroonn", "moron"), ("1 2 3", "1 2 3"), ("tr@$h, tr4sh", "trash, trash"), ("l-o-s-e-r", "loser"), ("balloon was 12 the", "balloon was 12 the"),
        ("the### see$$$", "the### see$$$"), ("", ""), ("4.0. 555-1234", "4.0. 555-1234"),
    ):
        assert restored(m, text) == want, text


def test_doubled_letters_and_loose_spelling():
    m = model_of(["idiot", "moron", "stupid", "the", "clown", "loser", "trash", "balloon", "see", "was", "committee"] * 50)
    for text, want in (
        ("the stuupid was", "the stupid was"), ("iddiot", "idiot"), ("iddioot!", "idiot!"), ("mmooron", "moron"), ("balloon, committee, see", "balloon, committee, see"),
        ("see m oo r o n", "see moron"), ("i d ddd i o t", "idiot"), ("i d d i o t", "idiot"), ("m/o/r/o/n", "moron"), ("m   o   r   o   n", "moron"), ("(m, o, rr, o, n)", "(moron)"),
        ("m / 0 / r / 0 / n", "moron"), ("m|o|r|o|n", "moron"), ("st/u/p/i/d", "stupid"), ("c~l~o~w~n the", "clown the"), ("m\no\n\n\nr\no\nn", "moron"),
        ("2 / 3, 4 / 5", "2 / 3, 4 / 5"), ("the/see, was", "the/see, was"), ("a 2 b 6 c", "a 2 b 6 c"),
    ):
        assert restored(m, text) == want, text


def test_stretches_stay_inside_their_texts():
    m = model_of(["moron", "the"] * 50)
    texts = [b"the m", b"o", b"r o n", b"", b"m/o/r/o/n", b"n m", b"o r"]
    low, off = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    out, new, n = T.restore(m, low, off)
    got = [out.tobytes()[a:b] for a, b in zip(new[:-1], new[1:], strict=True)]
    assert got[:2] == texts[:2] and got[3:] == [b"", b"moron", *texts[5:]]


def test_viterbi_against_all_paths():
    m = model_of(["idiot", "toil", "lie", "see", "boil"] * 20)
    for token in (b"1d10t", b"l1e", b"seeee", b"b0001l", b"t o 1 l"):
        units = T.lattice(token)

        def bits(path):
            a = b = 0
            total = 0.0
            for out, cost in [*path, (b" ", 0.0)]:
                total += cost
                for c in out:
                    total += float(m.bits[a, b, T._CODE[c]])
                    a, b = b, int(T._CODE[c])
            return total

        best = min(product(*units), key=bits)
        got = m.decode(units)
        assert got == b"".join(o for o, _ in best) or abs(bits(best) - min(bits(p) for p in product(*units) if b"".join(o for o, _ in p) == got)) < 1e-3


def test_held_out_rows_and_disguised_copies(spark):
    docs, lab = documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    model = T.char_counts(docs)
    judge = T.learn(docs, lab, model)
    rows = T.score(docs, model, judge).join(lab, "doc_id").filter("held_out").collect()
    bad, good = [r.predicted for r in rows if r.toxic], [r.predicted for r in rows if not r.toxic]
    assert len(bad) > 30 and np.mean(bad) > 0.75 and np.mean(good) < 0.01
    auc = np.mean([[a.score > b.score for b in rows if not b.toxic] for a in rows if a.toxic])
    assert auc > 0.95
    disguised = spark.createDataFrame([(1, "on the 1d1ot and in"), (2, "on the m o r o n and in"), (3, "the st.u.p.i.d of"), (4, "the tttrash of it"), (5, "the hat and in of it")], "doc_id bigint, text string")
    got = [r.predicted for r in T.score(disguised, model, judge).orderBy("doc_id").collect()]
    assert got == [1, 1, 1, 1, 0]


def test_character_counts_against_plain_counting(spark):
    docs = spark.createDataFrame([(1, "Abc ab"), (2, None), (3, ""), (4, "é1")], "doc_id bigint, text string")
    m = T.char_counts(docs)
    want = {}
    for text in ("abc ab", "é1"):
        s = [0, 0, *(int(T._CODE[b]) for b in text.encode())]
        for i in range(2, len(s)):
            want[tuple(s[i - 2 : i + 1])] = want.get(tuple(s[i - 2 : i + 1]), 0) + 1
    code = [(a * T.MODEL_SIZE + b) * T.MODEL_SIZE + c for a, b, c in want]
    assert np.allclose(m.bits, T.CharModel(np.array(code), np.array(list(want.values()))).bits)


def test_long_texts_in_parts_are_read_as_at_once():
    m = model_of(["idiot", "moron", "stupid", "the", "clown", "loser", "trash", "see", "was", "é"] * 50)
    words = ["the", "m0r0n", "m o r o n", "stuuupid", "i d d i o t", "see", "été", "a", "bb", "c/l/o/w/n", "ÀÉ", "aA", "3", "l-o-s-e-r!!", "\n", "", "x" * 40, "1d10t", "of"]
    rng = np.random.default_rng(5)
    for most in (3, 17, 64, 300):
        raw = " ".join(rng.choice(words, 400)).encode()
        data, off = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
        cut = list(T.parts(data, off, most))
        assert b"".join(p.tobytes() for p, _ in cut) == raw and len(cut) > 2
        whole, some = list(T.read(m, data, off, len(raw))), list(T.read(m, data, off, most))
        assert set(np.concatenate([h for h, _, _ in some])) == set(whole[0][0])
        assert sum(int(n[0]) for _, _, n in some) == int(whole[0][2][0])
        assert np.array_equal(np.concatenate(list(T.trigrams(data, off, most))), next(T.trigrams(data, off, len(raw))))
    several = np.frombuffer(b"the seethe m o r o n", np.uint8)
    assert len(list(T.parts(several, np.array([0, 7, 20]), 4))) == 1


def test_a_text_of_50_mb_stays_in_bounds():
    import tracemalloc

    m = model_of(["idiot", "moron", "the", "see"] * 50)
    text = (b"the m0r0n m o r o n " + b"see the cat sat on it again and again " * 60) * 21_800
    data, off = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    tracemalloc.start()
    found = [np.unique(h) for h, _, n in T.read(m, data, off)]
    for code in T.trigrams(data, off):
        assert len(code) <= T.PART
    assert tracemalloc.get_traced_memory()[1] < 600_000_000
    tracemalloc.stop()
    assert len(found) > 20


def test_a_long_stretch_is_decoded_unit_by_unit():
    import tracemalloc

    m = model_of(["idiot", "moron", "the", "see"] * 50)
    token = b"m0r0nthe3" * 20_000
    tracemalloc.start()
    out = m.restored(token)
    assert tracemalloc.get_traced_memory()[1] < 20_000_000 and token not in m.known
    tracemalloc.stop()
    assert out == m.decode(T.lattice(token)) and b"moron" in out


def test_awkward_rows(spark):
    docs = awkward(spark)
    lab = lambda rows: spark.createDataFrame(rows, "doc_id bigint, toxic int")
    for rows in ([], [(1, 1)], [(1, None), (None, 1)], [(1, 1), (1, 0), (5, 0), (6, 0), (7, 1), (8, 0), (99, 1)]):
        got = T.toxicity(docs, lab(rows)).collect()
        assert len(got) == 10 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
        blank = {r.score for r in got if r.doc_id in (2, 3, 4)}
        assert len(blank) == 1
    assert T.toxicity(empty(spark), lab([])).count() == 0
