"""SimHash near duplicates through a hierarchical index in Gray order.

Each text becomes a 64-bit fingerprint of its word shingles.  Texts with equal
fingerprints are one node.  Two fingerprints within ``radius`` bits agree on at
least ``blocks - radius`` of ``blocks`` bit blocks, so every link shares one
(mask, pattern) pair: that pair is the top level of the index and the shuffle
key.  Below it the fingerprints lie in the order of their Gray rank, upper nodes
hold the bits that all their members share, and a pair of nodes is dropped as a
whole once its accumulated differences pass ``radius``.  Each group returns a
spanning forest of its links, never all pairs; the forests are joined by
alternating large-star and small-star rounds on Spark.

A pattern with more than ``chunk`` fingerprints is split by a hash into chunks;
each pair of chunks is a group of its own, so no task holds a hot pattern.

Defined results: a NULL or blank text has fingerprint zero and links like any
other; repeated rows come back once per input row; a NULL doc_id gets the
smallest non-NULL id of its component, or NULL if there is none; an empty table
gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import octets, persisted, slices

SHINGLE = 3
RADIUS = 3
CHUNK = 2000
LEAF = 16  # codes below one lowest node
FAN = 4
HASH_SEED = 42


def text_fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    """64-bit SimHash of each text: lower-cased A-Z words, shingles with repeats,
    XXH64 seed 42, a bit set when over half of the hashes have it."""
    from xxhash import xxh64_intdigest

    hashed = partial(xxh64_intdigest, seed=HASH_SEED)
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        w = text.lower().split()
        if not w:
            continue
        if len(w) < shingle:
            out[i] = hashed(b" ".join(w))
            continue
        n, ones = len(w) - shingle + 1, np.zeros(64, np.int64)
        for at in range(0, n, 1 << 15):
            part = w[at : at + (1 << 15) + shingle - 1]
            grams = map(b" ".join, zip(*(part[j:] for j in range(shingle)), strict=False))
            h = np.fromiter(map(hashed, grams), np.uint64)
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, t1, t2) for every row; fp holds the 64 bits as a signed bigint, t1 and t2
    are bits of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = text_fingerprints(octets(b.column(1)).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), b.column(2), b.column(3)], ["doc_id", "fp", "t1", "t2"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *text_bits())
    return rows.mapInArrow(run, "doc_id bigint, fp bigint, t1 bigint, t2 bigint")


def masks(blocks: int, radius: int) -> list[int]:
    """Every choice of ``blocks - radius`` of the bit blocks, as a 64-bit mask."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(c) for c in combinations(one, blocks - radius)]


def blocks_for(n: int, radius: int) -> int:
    """Fewest blocks with which evenly spread patterns hold 16 fingerprints or fewer."""
    blocks = radius + 1
    while blocks < 2 * radius + 4 and n > 16 * 2 ** (64 * (blocks - radius) // blocks):
        blocks += 1
    return blocks


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    r = code.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component under the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def tree_links(code: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of positions within ``radius`` bits, in batches, by walking pairs of
    index nodes.

    ``code`` is in Gray order.  Level 0 nodes hold LEAF codes, each further level
    FAN nodes.  A node keeps the bits on which all members agree; going down, only
    bits newly agreed on are compared and added to the pair's difference so far."""
    levels, width = [], LEAF
    while True:
        at = np.arange(0, len(code), width)
        both, any_ = np.bitwise_and.reduceat(code, at), np.bitwise_or.reduceat(code, at)
        levels.append((~(both ^ any_), both))
        if len(at) == 1:
            break
        width *= FAN
    a = b = np.zeros(1, np.int64)
    known, gap = np.zeros(1, np.uint64), np.zeros(1, np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        same, bits = levels[depth]
        if depth < len(levels) - 1:
            k = np.arange(FAN * FAN)
            a2, b2 = (a[:, None] * FAN + k // FAN).ravel(), (b[:, None] * FAN + k % FAN).ravel()
            ok = (a2 < len(same)) & (b2 < len(same)) & (a2 <= b2)
            a, b = a2[ok], b2[ok]
            known, gap = np.repeat(known, FAN * FAN)[ok], np.repeat(gap, FAN * FAN)[ok]
        agreed = same[a] & same[b]
        gap = gap + np.bitwise_count((bits[a] ^ bits[b]) & agreed & ~known)
        ok = gap <= radius
        a, b, known, gap = a[ok], b[ok], (known | agreed)[ok], gap[ok]
    k = np.arange(LEAF * LEAF)
    for at in range(0, len(a), 4096):  # bounded memory at the leaves
        i, j = (a[at : at + 4096, None] * LEAF + k // LEAF).ravel(), (b[at : at + 4096, None] * LEAF + k % LEAF).ravel()
        ok = (i < len(code)) & (j < len(code)) & (i < j)
        i, j = i[ok], j[ok]
        ok = np.bitwise_count(code[i] ^ code[j]) <= radius
        yield i[ok], j[ok]


def group_links(group: np.ndarray, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links (member, root) of the components inside each group; rows lie by
    group, then Gray rank."""
    n = len(code)
    start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(start, n))
    a, b, lag = [], [], 1
    small = np.repeat(size <= LEAF, size)
    while True:  # groups of one leaf: compare its codes directly
        i = np.flatnonzero(small[: n - lag] & (group[lag:] == group[: n - lag])) if lag < n else np.zeros(0, np.int64)
        if not len(i):
            break
        i = i[np.bitwise_count(code[i] ^ code[i + lag]) <= radius]
        a.append(i)
        b.append(i + lag)
        lag += 1
    for s, k in zip(start[size > LEAF], size[size > LEAF], strict=True):
        label = np.arange(k)
        for i, j in tree_links(code[s : s + k], radius):  # each batch shrinks to a forest at once
            label = forest(int(k), np.concatenate((i, np.arange(k))), np.concatenate((j, label)))
        i = np.flatnonzero(label != np.arange(k))
        a.append(s + i)
        b.append(s + label[i])
    if not a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    label = forest(n, np.concatenate(a), np.concatenate(b))
    i = np.flatnonzero(label != np.arange(n))
    return code[i], code[label[i]]


def links(nodes: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(a, b) links between the distinct fingerprints ``nodes.fp`` whose connected
    components are those of all links within ``radius`` bits."""
    blocks = blocks_for(nodes.count(), radius)
    pattern = F.explode(F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("pattern")) for i, m in enumerate(masks(blocks, radius))]))
    rows = nodes.select("fp", pattern.alias("k")).select("fp", "k.mask", "k.pattern")
    counts = rows.groupBy("mask", "pattern").count().filter("count > 1")
    counts = persisted(counts.select("mask", "pattern", F.ceil(F.col("count") / chunk).cast("int").alias("parts")))
    own = F.pmod(F.xxhash64("fp"), F.col("parts").cast("bigint")).cast("int")
    rows = rows.join(counts, ["mask", "pattern"]).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.withColumn("other", other).select("mask", "pattern", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp")
    key = ["mask", "pattern", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b"]

        def solved(t: pa.Table) -> pa.RecordBatch:
            cols = [t.column(k).to_numpy() for k in key]
            code = t.column("fp").to_numpy().view(np.uint64)
            new = np.zeros(len(code), bool)
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            group = np.cumsum(new)
            order = np.lexsort((gray_rank(code), group))
            a, b = group_links(group, code[order], radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names)

        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            last = np.ones(t.num_rows, bool)
            for k in key:
                c = t.column(k).to_numpy()
                last &= c == c[-1]
            cut = int(np.flatnonzero(last)[0])
            held = t.slice(cut)
            if cut:
                yield solved(t.slice(0, cut))
        if held is not None and held.num_rows:
            yield solved(held)

    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node
    reachable.  Alternating large-star and small-star rounds until nothing moves."""
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now, seen = persisted(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        near = both(now)
        low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = near.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("x"), F.col("m").alias("y")), F.struct(F.col("a").alias("x"), F.col("m").alias("y")))).alias("e"))
        now = persisted(small.select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).filter("a <> b").distinct())
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``."""
    rows = grouped(docs, shingle, radius, chunk)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def grouped(docs: DataFrame, shingle: int, radius: int, chunk: int) -> DataFrame:
    """(doc_id, fp, t1, t2, root, component_id) for every row: root names the group, t1 and
    t2 are 128 bits of the text."""
    marked = persisted(fingerprints(docs, shingle))
    nodes = persisted(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = persisted(components(links(nodes.select("fp"), radius, chunk)).withColumnRenamed("node", "fp"))
    smallest = linked.join(nodes, "fp").groupBy("root").agg(F.min("least").alias("component"))
    moved = linked.join(smallest, "root").select("fp", "root", "component")
    # written out, so that the last join is a plain one in which Spark splits a hot fingerprint
    named = persisted(nodes.join(moved, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component", "least").alias("component_id")))
    return marked.join(named, "fp")


def text_bits() -> list[Column]:
    """128 bits of the text, NULL as empty: XXH64 under two seeds."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one with the
    smallest doc_id; if that id has several texts in the group, the one with the least
    text hash.  Rows are told apart by doc_id and text, so rows of one id in different
    groups stay apart.  Rows whose whole group has NULL ids are left as they are."""
    rows = grouped(docs, shingle, radius, chunk)
    first = rows.filter("doc_id = component_id").groupBy("root").agg(F.min(F.struct("doc_id", "t1", "t2")).alias("x"))
    first = persisted(first.select(F.col("x.doc_id").alias("_id"), F.col("x.t1").alias("_t1"), F.col("x.t2").alias("_t2")))
    lone = persisted(rows.filter("component_id IS NULL").select(F.col("t1").alias("_t1"), F.col("t2").alias("_t2")).distinct())
    bits = [c.alias(n) for c, n in zip(text_bits(), ("_t1", "_t2"), strict=True)]
    ours = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("_id"), *bits)
    kept = ours.filter("_id IS NOT NULL").join(first, ["_id", "_t1", "_t2"], "left_semi").dropDuplicates(["_id", "_t1", "_t2"])
    return kept.unionByName(ours.filter("_id IS NULL").join(lone, ["_t1", "_t2"], "left_semi")).select("row.*")
