import hashlib
import re

from llm_cases import ROWS, awkward, documents, empty
from pyspark.sql import functions as F

from pickwise.llm import version_sketch as V


def pieces(text):
    parts = [p.strip(" ") for p in re.split(r"[\n.!?]+", text)]
    return {p[i : i + V.PIECE_MOST] for p in parts for i in range(0, len(p), V.PIECE_MOST)}


def dice(a, b):
    a, b = pieces(a), pieces(b)
    return 1.0 if not a and not b else 2 * len(a & b) / (len(a) + len(b))


def edited(text, after):
    k = len(text) // 4
    return text[: len(text) - k] + after[:k]


def check(df, rows, bucket):
    got = {r.doc_id: r for r in V.fingerprints(df, bucket).collect()}
    rows = sorted(rows)
    assert len(got) == len(rows)
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        r, new = got[i], edited(text, after)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert abs(r.near_edited - dice(text, new)) < 1e-12 and abs(r.near_next - dice(text, after)) < 1e-12
        assert (r.fingerprint == r.edited_fingerprint) == (pieces(text) == pieces(new))


def test_documents_against_plain_sets(spark, sf_small):
    df = documents(spark, sf_small)
    check(df, [(r.doc_id, r.text) for r in df.collect()], 17)


def test_range_borders_and_gaps(spark):
    rows = [(i * i * 7 - 50, "é." * (i % 5) + f"part {i}. tail {i}\nline {i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for bucket in (1, 3, 1000):
        check(df, rows, bucket)


def test_one_document_and_none(spark):
    rows = [(5, "one two. three four. five")]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), rows, 10)
    assert V.fingerprints(empty(spark)).count() == 0


def test_equal_texts_have_equal_fingerprints(spark, sf_small):
    rows = V.fingerprints(documents(spark, sf_small)).join(documents(spark, sf_small), "doc_id").select("text", "fingerprint").collect()
    by = {}
    for r in rows:
        by.setdefault(r.text, set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by.values())


def xx(*parts):
    """Spark's xxhash64 of integers, chained."""
    import numpy as np
    import xxhash

    seed = 42
    for width, x in parts:
        seed = xxhash.xxh64_intdigest(np.array([x], f"<i{width}").tobytes(), seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def decode(text):
    """The digests of a fingerprint string, by peeling its cells alone."""
    out, side, shards = set(), *text.split("/")
    assert len(shards.split("|")) == int(side) ** 2
    for part in shards.split("|"):
        width, cells = part.split(":")
        width = int(width)
        cells = [(int(c[:2], 16), int(c[2:18], 16), int(c[18:], 16)) if c else (0, 0, 0) for c in cells.split(",")] if cells else []
        if not width:
            out |= {d for _, d, _ in cells}
            continue
        while pure := [d for n, d, h in cells if n == 1 and xx((8, signed(d)), (4, -1)) % 2**64 == h]:
            d = pure[0]
            out.add(d)
            x = xx((8, signed(d)), (4, width))
            for t in range(3):
                at = (x >> 20 * t) % width + t * width
                n, e, h = cells[at]
                cells[at] = (n - 1, e ^ d, h ^ xx((8, signed(d)), (4, -1)) % 2**64)
        assert not any(n or d or h for n, d, h in cells)
    return out


def signed(d):
    return d - (1 << 64) if d >> 63 else d


def test_likeness_follows_from_the_fingerprint_strings(spark, sf_small):
    rows = sorted(V.fingerprints(documents(spark, sf_small)).collect(), key=lambda r: r.doc_id)
    for r, after in zip(rows, rows[1:] + rows[:1], strict=True):
        a, b, c = decode(r.fingerprint), decode(r.edited_fingerprint), decode(after.fingerprint)
        share = lambda x, y: 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0
        assert abs(r.near_edited - share(a, b)) < 1e-12 and abs(r.near_next - share(a, c)) < 1e-12


def some(n, m):
    return F.transform(F.sequence(F.lit(n), F.lit(m)), lambda i: F.xxhash64(i, "id"))


def test_overfull_sketches_are_made_wider_or_plain(spark, monkeypatch):
    monkeypatch.setattr(V, "LOAD", 30)
    found = spark.range(40).select(V.shard(some(1, 30)).alias("x")).select("x.width", F.size("x.cells").alias("cells")).collect()
    assert all(r.width > 4 and r.cells == 3 * r.width for r in found)
    monkeypatch.setattr(V, "WIDTHS", (1, 2))
    found = spark.range(40).select(V.shard(some(1, 30)).alias("x")).select("x.width", F.size("x.cells").alias("cells")).collect()
    assert all(r.width == 0 and r.cells == 30 for r in found)
    prints = spark.range(5).select(some(1, 50).alias("d")).select("d", V.fingerprint(V.let(F.col("d"), V.sketched)).alias("f")).collect()
    assert all(decode(r.f) == {d % 2**64 for d in r.d} for r in prints)


def test_recovered_digests_are_those_that_differ(spark):
    df = spark.range(12).select(
        F.when(F.col("id") == 0, F.array().cast("array<bigint>")).when(F.col("id") < 6, some(1, 30)).otherwise(some(1, 400)).alias("a"),
        F.when(F.col("id") == 1, F.array().cast("array<bigint>")).when(F.col("id") < 6, some(21, 45)).otherwise(some(3, 402)).alias("b"),
    )
    made = df.select("a", "b", V.sketched(F.col("a")).alias("x"), V.sketched(F.col("b")).alias("y"))
    for r in made.select("a", "b", V.recovered(F.col("x"), F.col("y")).alias("d"), V.difference(F.col("x"), F.col("y")).alias("n")).collect():
        assert sorted(r.d.ours) == sorted(set(r.a) - set(r.b)) and sorted(r.d.theirs) == sorted(set(r.b) - set(r.a))
        assert (r.n.ours, r.n.theirs) == (len(r.d.ours), len(r.d.theirs))
    # few digests differ: every shard peels, none is decoded
    near = spark.range(20).select(some(1, 300).alias("a"), some(1, 302).alias("b"))
    cells = near.select(F.explode(F.arrays_zip(V.sketched(F.col("a"))["shards"].alias("x"), V.sketched(F.col("b"))["shards"].alias("y"))).alias("p"))
    minus = F.zip_with("p.x.cells", "p.y.cells", lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["d"].bitwiseXOR(y["d"]).alias("d"), x["h"].bitwiseXOR(y["h"]).alias("h")))
    peels = V.peeled(minus, F.lit(9), F.col("p.x.width")).isNotNull()
    r = cells.filter("p.x.width = p.y.width").agg(F.avg(peels.cast("int")).alias("share")).first()
    assert r.share > 0.99


def test_no_python_in_the_plan(spark, sf_small):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        V.fingerprints(documents(spark, sf_small)).explain()
    assert not re.search("Python|Pandas|Arrow", buf.getvalue())


def test_awkward_rows(spark):
    got = V.fingerprints(awkward(spark), 2).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert {r.n_chars for r in got if r.doc_id == 2} == {0}
    null = [r for r in got if r.doc_id is None][0]  # last: followed by the first row, id 1
    text, after = ROWS[5][1], ROWS[0][1]
    assert null.edited_sha256 == hashlib.sha256(edited(text, after).encode()).hexdigest()
