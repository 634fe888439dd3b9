import hashlib
import re
from collections import defaultdict

from llm_cases import CLASH, DOCS, awkward, documents, empty

from pickwise.llm import line_dedup as L


def key(line):
    return re.sub(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line).translate({c: c + 32 for c in range(65, 91)})


def brute(rows, least_docs=10, least_chars=1):
    seen = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            seen[key(line)].add(doc_id if doc_id is not None else "text:" + (text or ""))
    common = {k for k, d in seen.items() if len(k) >= least_chars and len(d) >= least_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in common]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=repr)


def test_whole_table_against_plain_code(spark, sf_small):
    docs = documents(spark, sf_small)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    assert sum(n for *_, n in want) > 0
    assert found(L.drop_common_lines(docs)) == want
    sha = {(r.doc_id, r.kept_sha256) for r in L.digests(L.drop_common_lines(docs)).collect()}
    assert sha == {(i, hashlib.sha256(t.encode()).hexdigest()) for i, t, *_ in want}


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for least in (1, 2, 3):
        assert found(L.drop_common_lines(docs, least)) == brute(rows, least)
    assert found(L.drop_common_lines(docs, 2, 60)) == brute(rows, 2, 60)
    clash = [c.split()[0] for c in CLASH.split(", ")][:3]
    assert L.drop_common_lines(docs, carry=tuple(clash)).columns == ["doc_id", "text", "n_lines", "n_dropped", *clash]
    assert L.drop_common_lines(empty(spark)).count() == 0


def test_one_document_is_counted_once(spark):
    line = "É same　line\x85"  # only ASCII white space is cut, only A-Z lowered
    rows = [(1, f"{line}\n{line}"), (1, f" {line.upper()[:1]}{line[1:]} "), (2, "x"), (None, f"a\n{line}"), (None, f"b\n{line}"), (None, f"b\n{line}")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    for least in (2, 3, 4):
        assert found(L.drop_common_lines(docs, least)) == brute(rows, least)


def test_a_hot_line_and_a_long_text(spark):
    many = "\n".join(f"line {i % 700}" for i in range(60_000))
    rows = [(i, f"own {i}\n  Common LINE\t\n\n\rend\x0b") for i in range(300)] + [(1000, many), (1001, many)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).repartition(7)
    assert found(L.drop_common_lines(docs, 2)) == brute(rows, 2)
    assert found(L.drop_common_lines(docs)) == brute(rows)


def test_large_tables_of_common_lines_are_joined_without_broadcast(spark, monkeypatch):
    import pickwise.llm.line_dedup as module

    plain = module.Lookup
    monkeypatch.setattr(module, "Lookup", lambda df: plain(df, max_bytes=0))
    rows = [(i, f"a\nb{i % 3}\n{i}") for i in range(40)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    assert found(L.drop_common_lines(docs)) == brute(rows)
