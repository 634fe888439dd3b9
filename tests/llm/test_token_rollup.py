from collections import defaultdict

import pytest
import tiktoken  # noqa: F401
from llm_cases import DOCS, awkward, documents, empty

from pickwise.llm import token_rollup as R
from pickwise.session import shared_dir

CHANGE = "op string, source string, lang string, version string, tokens bigint, old_tokens bigint"


def changes(spark, rows):
    return spark.createDataFrame(rows, CHANGE)


def totals(ledger):
    return {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in ledger.totals().collect()}


def test_signed_changes_and_replays(spark):
    ledger = R.Ledger(spark, shared_dir(spark, "ledger"))
    assert totals(ledger) == {} and ledger.rollup().count() == 0
    first = changes(spark, [("insert", "a", "en", "v1", 10, None), ("insert", "a", "en", "v1", 5, None), ("insert", None, None, "v1", None, None), (None, "a", "en", "v1", 9, None), ("rename", "a", "en", "v1", 9, 1)])
    assert ledger.commit("one", first) and not ledger.commit("one", first)
    assert totals(ledger) == {("a", "en", "v1"): (2, 15), (None, None, "v1"): (1, 0)}
    ledger.commit("two", changes(spark, [("delete", "a", "en", "v1", 5, None), ("revise", "a", "en", "v1", 14, 10), ("insert", "a", "fr", "v2", 3, None)]))
    ledger.commit("none", changes(spark, []))
    assert not ledger.commit("none", changes(spark, []))
    for name, other in (("none", first), ("one", changes(spark, []))):
        with pytest.raises(ValueError, match="other content"):
            ledger.commit(name, other)
    assert ledger.committed() == ["none", "one", "two"]
    assert totals(ledger) == {("a", "en", "v1"): (1, 14), (None, None, "v1"): (1, 0), ("a", "fr", "v2"): (1, 3)}


def test_broken_commit_is_ignored_and_written_anew(spark):
    ledger = R.Ledger(spark, shared_dir(spark, "ledger"))
    ledger.commit("one", changes(spark, [("insert", "a", "en", "v1", 10, None)]))
    fs, path = ledger._files()
    fs.delete(path(f"{ledger.folder}/batch=one/_SUCCESS"), False)  # as if the writer had died
    assert totals(ledger) == {}
    assert ledger.commit("one", changes(spark, [("insert", "a", "en", "v1", 10, None)]))
    assert totals(ledger) == {("a", "en", "v1"): (1, 10)}


def test_corpus_history_against_plain_counting(spark, sf_small):
    docs = documents(spark, sf_small)
    got = {(r.source, r.lang, r.version, r.all_sources, r.all_langs): (r.docs, r.tokens) for r in R.corpus_history(spark, docs, shared_dir(spark, "ledger")).rollup().collect()}
    encoders = {}
    for v, f in R.VERSIONS.items():
        with open(f"{R.TOKENIZERS}/{f}", "rb") as file:
            encoders[v] = R.encoder(file.read())
    one, two = R.VERSIONS
    rows, want = docs.collect(), defaultdict(lambda: [0, 0])
    kept = {}
    for r in rows:
        kept[r.text] = min(kept.get(r.text, r.doc_id), r.doc_id)
    import re

    for r in rows:
        if kept[r.text] != r.doc_id:
            continue
        tidy = re.sub(r"[ \t\n\x0b\f\r]+", " ", r.text).strip(" ")
        for v, text in ((one, tidy), (two, r.text)):
            n = len(encoders[v].encode_ordinary(text))
            for key in ((r.source, r.lang, v, 0, 0), (r.source, None, v, 0, 1), (None, r.lang, v, 1, 0), (None, None, v, 1, 1)):
                want[key][0] += 1
                want[key][1] += n
    assert {k: v for k, v in got.items() if v != (0, 0)} == {k: tuple(v) for k, v in want.items()}


def test_awkward_rows(spark):
    rows = R.corpus_history(spark, awkward(spark), shared_dir(spark, "ledger")).rollup().collect()
    top = {r.version: r.docs for r in rows if r.all_sources and r.all_langs}
    # ten rows; 3 joins 2 as an empty text, 7 is a copy of 1, whose repeated row stays
    assert top == dict.fromkeys(R.VERSIONS, 8)
    assert R.corpus_history(spark, empty(spark), shared_dir(spark, "ledger")).rollup().count() == 0


def test_copies_without_an_id(spark):
    rows = [(1, "same text"), (None, "same text"), (None, "other text"), (None, "other text"), (2, "third")]
    docs = spark.createDataFrame([(i, t, "en", "a", None) for i, t in rows], DOCS)
    top = [r for r in R.corpus_history(spark, docs, shared_dir(spark, "ledger")).rollup().collect() if r.all_sources and r.all_langs]
    assert {r.docs for r in top} == {4}
