"""Mixing sources to target token weights by balanced (cube) sampling.

Sources, by code point with NULL last, get weights 1, 2, 3 in turn and share all
tokens by weight; a target stops at ``MOST`` times its source's size and the excess
goes to the others by weight until none is above.  With the ratio r = target / size
of its source every document is taken floor(r) times, and once more with inclusion
probability r - floor(r).  These choices are balanced by the cube method: the vector
of inclusion probabilities moves along the null space of the constraints (documents
and tokens of the source) until a coordinate is 0 or 1, three open documents at a
time, so each move keeps both totals exactly.

Documents of a source are spread by a hash of the id over groups of about ``GROUP``
rows, so no task holds a source.  A group keeps ``RESERVE`` documents out of its
flight; these and at most two others stay open and enter the next level, until one
group a source is left.  Its last open documents are the landing problem: of all
ways to settle them, the one with the document total next to its sum and the token
total nearest is taken.

Defined results: NULL and blank texts have size 0; a source whose size is 0 has
target 0 and takes nothing; NULL is a source of its own; repeated rows are chosen
one by one; an empty table gives an empty result; other columns are ignored.  The
choice depends only on the rows, not on partitions, except that equal rows
(id, source and size alike) may swap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import flat, is_space, mixed, octets, persisted, runs, slices
from pickwise.plans.guards import MAX_BROADCAST_BYTES, SALTS

WEIGHTS = (1, 2, 3)
MOST = 3
GROUP = 4096
RESERVE = 12
LARGE = 8  # times the mean size of a group
EPS = 1e-9


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words between ASCII white space in the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, off = flat(octets(b.column(2)))
            start, _ = runs(~is_space(data), off)
            n = np.bincount(np.searchsorted(off, start, side="right") - 1, minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n.astype(np.int64))], ["doc_id", "source", "size"])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id bigint, source string, size bigint")


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, size) rows."""
    spark = sized.sparkSession
    by = persisted(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    ranked = by.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], WEIGHTS[x[1] % len(WEIGHTS)]))
    ranked = persisted(spark.createDataFrame(ranked, "source string, source_size bigint, weight int"))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    full = F.lit(False)
    rest, weight = total, 0
    while True:  # each round stops the sources above their limit; whole numbers, so exact
        held, weight = ranked.agg(F.sum(F.when(full, F.col("source_size") * MOST).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        rest, weight = total - (held or 0), weight or 0
        if not weight:
            break
        above = full | (F.col("weight").cast("decimal(38,0)") * F.lit(rest) > F.col("source_size").cast("decimal(19,0)") * F.lit(MOST * weight))
        before = ranked.filter(full).count()
        ranked = persisted(ranked.select("source", "source_size", "weight", above.alias("full")))
        full = F.col("full")
        if ranked.filter(full).count() == before:
            break
    share = F.col("weight") * F.lit(float(rest)) / F.lit(float(weight or 1))
    target = F.when(full, F.col("source_size") * float(MOST)).otherwise(share)
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def flight(p: np.ndarray, x: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Moves probabilities along the null space of (1, x) until at most two are open.

    The way is drawn so that every probability keeps its expectation; the draw comes
    from the hash of the newest document, so reruns agree.  A document of more than
    LARGE times the mean size moves little in one step, so its way is drawn once, with
    its own probability, and held to until it is settled."""
    p, way = p.copy(), {}
    large = x > LARGE * x.mean() if len(x) else x > 0
    draw = (mixed(h.view(np.uint64)) >> np.uint64(11)) / float(1 << 53)
    held: list[int] = []
    for i in range(len(p)):
        if EPS < p[i] < 1 - EPS:
            held.append(i)
        if len(held) < 3:
            continue
        a, b, c = held
        u = (x[b] - x[c], x[c] - x[a], x[a] - x[b])  # sums to 0, and to 0 with the sizes
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min(((1 - p[k]) / v if v > 0 else p[k] / -v) for k, v in zip(held, u, strict=True) if v)
        down = min((p[k] / v if v > 0 else (1 - p[k]) / -v) for k, v in zip(held, u, strict=True) if v)
        k = max(range(3), key=lambda k: x[held[k]])
        if large[held[k]] and u[k]:
            rising = way.setdefault(held[k], draw[held[k]] < p[held[k]])
            step = up if rising == (u[k] > 0) else -down
        else:
            step = up if draw[i] * (up + down) < down else -down
        for k, v in zip(held, u, strict=True):
            p[k] = min(1.0, max(0.0, p[k] + step * v))
        held = [k for k in held if EPS < p[k] < 1 - EPS]
    return p


def landing(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Settles the last open documents (at most RESERVE + 2) by trying all ways."""
    p = p.copy()
    open_ = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    n = len(open_)
    if n:
        ways = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
        docs, tokens = p[open_].sum(), p[open_] @ x[open_]
        near = np.abs(ways.sum(1) - docs) < 1
        ways = ways[near]
        p[open_] = ways[np.argmin(np.abs(ways @ x[open_] - tokens))]
    return np.round(p)


def by_source(rows: DataFrame, table: DataFrame, most: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Rows (with a ``row`` number) joined with a written table of one row a source.  The table
    is broadcast up to ``most`` bytes; beyond, it is copied SALTS times and the rows of one
    source meet its copies in as many tasks."""
    size = table.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 8 * (len(table.columns) + 1)), F.lit(0))).first()[0]
    table = table.withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    if size <= most:
        return rows.join(F.broadcast(table), same).drop("_source")
    copies = table.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod("row", F.lit(SALTS)).cast("int"))
    return salted.join(copies, same & (F.col("_salt") == F.col("_copy"))).drop("_source", "_salt", "_copy")


def level(rows: DataFrame, groups: DataFrame, last: bool, most: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """One flight over (id, source, size, p, h), in groups of a source."""
    rows = by_source(rows, groups, most)
    rows = rows.withColumn("g", F.pmod(F.shiftright("h", 3), F.col("parts"))).select("source", "g", "h", "doc_id", "size", "row", "p")
    key = ["source", "g"]

    def settled(t: pa.Table) -> pa.RecordBatch:
        p, x, h = t.column("p").to_numpy(), t.column("size").to_numpy().astype(float), t.column("h").to_numpy()
        code = t.column("source").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        g = t.column("g").to_numpy()
        cut = np.flatnonzero((code[1:] != code[:-1]) | (g[1:] != g[:-1])) + 1
        out = np.empty(len(p))
        for a, b in zip(np.append(0, cut), np.append(cut, len(p)), strict=True):
            # large documents first: the others then make up for them
            at = a + np.argsort(x[a:b] <= LARGE * x[a:b].mean(), kind="stable")
            q, free = p[at], max(0, b - a - RESERVE)
            q[:free] = flight(q[:free], x[at[:free]], h[at[:free]])
            out[at] = landing(q, x[at]) if last else q
        return t.set_column(t.schema.get_field_index("p"), "p", pa.array(out)).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            s = t.column("source").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            g = t.column("g").to_numpy()
            other = np.flatnonzero((s != s[-1]) | (g != g[-1]))
            at = int(other[-1]) + 1 if len(other) else 0
            held = t.slice(at)
            if at:
                yield settled(t.slice(0, at))
        if held is not None and held.num_rows:
            yield settled(held)

    ordered = rows.repartition(*key).sortWithinPartitions("source", "g", "h", "doc_id", "size", "row")
    return ordered.mapInArrow(run, ordered.schema).drop("g")


def mix(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``."""
    return mixed_sources(docs, group).select("doc_id", "size", "source_size", "target", "taken")


def mixed_sources(docs: DataFrame, group: int = GROUP, most: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``mix`` with the source, and how often each document is taken, as ``copies``;
    ``most``: bytes of the source table up to which it is broadcast."""
    sized = persisted(sizes(docs))
    goal = persisted(targets(sized))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # equal rows get numbers of their own within a partition
    rows = by_source(sized.withColumn("row", F.monotonically_increasing_id()), goal, most).withColumn("_r", ratio)
    # a ratio within EPS of a whole number is that number
    whole = F.floor(F.col("_r") + EPS)
    rows = rows.withColumn("whole", whole.cast("bigint")).withColumn("p", F.greatest(F.lit(0.0), F.col("_r") - F.col("whole"))).drop("_r")
    rows = rows.withColumn("h", F.xxhash64("doc_id", "size"))
    rows = persisted(rows)
    open_ = rows.filter((F.col("p") > EPS) & (F.col("p") < 1 - EPS)).select("source", "doc_id", "size", "row", "p", "h")
    settled = []
    while True:
        counts = persisted(open_.groupBy("source").agg(F.ceil(F.count("*") / group).alias("parts")))
        largest = counts.agg(F.max("parts")).first()[0]
        if largest is None:
            break
        last = largest <= 1
        after = persisted(level(open_, counts, last, most))
        still = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
        settled.append(after.filter(~still & (F.col("p") >= 0.5)).select("row"))
        if last:
            break
        # another hash at each level, so that leftovers of a group meet others
        open_ = after.filter(still).withColumn("h", F.xxhash64("h", "doc_id"))
    columns = ["doc_id", "source", "size", "source_size", "target"]
    out = rows.withColumn("copies", F.col("whole"))
    if settled:
        more = settled[0]
        for s in settled[1:]:
            more = more.union(s)
        more = more.withColumnRenamed("row", "_row").withColumn("_once", F.lit(1))
        out = rows.join(more, F.col("row") == F.col("_row"), "left").withColumn("copies", F.col("whole") + F.coalesce("_once", F.lit(0)))
    return out.select(*columns, F.col("copies").cast("bigint").alias("copies"), (F.col("copies") * F.col("size")).cast("bigint").alias("taken"))
