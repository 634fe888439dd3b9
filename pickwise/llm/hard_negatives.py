"""Hard-negative mining: for each anchor and positive, the best other-label rows just below the positive's score.

Vectors become whole numbers (floor of 256 times each component), and scores are their
exact inner products.  Positives are an anchor's best rows of its own label; negatives
are rows of other labels whose score lies between 0.8 times the positive's score and
that score, best first; ties go to the smaller vec_id.

Method: segment summary filtering.  Every vector is cut into segments, and each segment
stores its mean m and deviation s.  For two segments of n components the product lies
within n * (m m' - s s') and n * (m m' + s s'), so the sums over segments bound a score
from both sides.  Pairs whose bounds cannot reach what is asked are dropped; those left
are bounded again with segments half as long, and so on, and only then scored exactly.
What is asked rises as an anchor finds better rows.  Coarse bounds that drop too little
to pay for themselves are skipped for the next blocks: exact scores of a whole block are
then one matrix product.

Every anchor has to be held against all rows.  Rows are dealt by hash into parts of at
most ``PART_BYTES``; anchors are packed into blocks of ``BLOCK`` rows, each block goes
to every part, and a task holds one part and streams the blocks past it.  Nothing passes
through the driver and nothing is broadcast; a task gives only each anchor's best few
rows of its part, and one ranking by anchor joins the parts.

Defined results.  Rows with a NULL label, a NULL vector, or a component that is NULL,
NaN or infinite take no part.  Rows that share vec_id and score count once for an anchor,
so repeated rows do.  A row without vec_id can be found, after all others of its score,
but is no anchor.  "Other rows" of an anchor's label are those of another vec_id.  Vectors of unequal length are compared as if the
shorter went on with zeros; empty vectors score 0.  A positive whose score is negative
has no negatives (the range is empty).  Scores beyond 2^53 are computed with Python's
whole numbers and given out within the range of a long.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickwise.llm.common import persisted

POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100  # percent of the positive's score
SCALE = 256
PART_BYTES = 32 << 20  # of vectors, as doubles, that a task holds
BLOCK = 256  # anchors that are held against a part at once
TILE = 4096  # rows of a part that are bounded at once
SEGMENTS = (4, 8, 16, 32)
WORTH = 0.25  # bounds must leave less than this share of the pairs to be tried again
NO_ID = (1 << 63) - 1
LONGEST = (1 << 63) - 1


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding, row): rows that take part, with a hash of the whole row."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding")
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return rows.filter(F.col("label").isNotNull() & F.coalesce(sound, F.lit(False))).withColumn("row", F.xxhash64("vec_id", "label", "embedding"))


def relabelled(vectors: DataFrame) -> DataFrame:
    """Labels of rows whose vec_id is divisible by 7 move on by one, modulo 10."""
    label = F.col("label").cast("bigint")
    return vectors.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))


def matrix(column: pa.Array) -> np.ndarray:
    """floor(256 x) of the vectors, a row each, filled up with zeros to a multiple of the finest segments."""
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), max(SEGMENTS) * max(1, -(-int(size.max(initial=0)) // max(SEGMENTS)))))
    values = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out[np.repeat(np.arange(len(size)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


class Rows:
    """Vectors as whole numbers with ids, labels, norms, and per level of segments their means and deviations."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.norm = np.sqrt((vectors * vectors).sum(1))
        self.summary: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def segments(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        if level not in self.summary:
            cut = self.vectors.reshape(len(self.vectors), level, -1)
            self.summary[level] = cut.mean(2), cut.std(2)
        return self.summary[level]

    def widened(self, width: int) -> Rows:
        """The same rows with zeros up to ``width`` components."""
        if width == self.vectors.shape[1]:
            return self
        return Rows(self.ids, self.labels, np.pad(self.vectors, ((0, 0), (0, width - self.vectors.shape[1]))))


class Filter:
    """Exact scores of the pairs within given limits; most others are dropped by their bounds."""

    def __init__(self) -> None:
        self.poor: dict[int, int] = {}  # level -> blocks for which it is skipped

    def pairs(self, a: Rows, b: Rows, least: np.ndarray, most: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(i, j, score) of the pairs that are open with least[i] <= score <= most[i]."""
        reach = float(a.norm.max() * b.norm.max())
        if not reach < 1 << 53:  # beyond exact doubles: Python's whole numbers
            whole = [np.array([[int(x) for x in v] for v in m], object) for m in (a.vectors, b.vectors)]
            score = whole[0] @ whole[1].T
            i, j = np.nonzero(open_ & (score >= least.astype(object)[:, None]) & (score <= most.astype(object)[:, None]))
            return i, j, score[i, j]
        low, high, slack = least.astype(float), most.astype(float), 1e-9 * reach + 1e-9
        i = j = None
        for level in SEGMENTS:
            n = a.vectors.shape[1] // level
            (ma, sa), (mb, sb) = a.segments(level), b.segments(level)
            if i is None:
                if self.poor.get(level, 0) > 0:
                    self.poor[level] -= 1
                    continue
                middle, spread = n * (ma @ mb.T), n * (sa @ sb.T) + slack
                left = open_ & (middle + spread >= low[:, None]) & (middle - spread <= high[:, None])
                if left.sum() > WORTH * left.size:
                    self.poor[level] = 15
                    continue
                i, j = np.nonzero(left)
            else:
                middle, spread = n * np.einsum("ij,ij->i", ma[i], mb[j]), n * np.einsum("ij,ij->i", sa[i], sb[j]) + slack
                left = (middle + spread >= low[i]) & (middle - spread <= high[i])
                i, j = i[left], j[left]
        if i is not None:
            score = np.einsum("ij,ij->i", a.vectors[i], b.vectors[j])
            left = (score >= low[i]) & (score <= high[i])
            return i[left], j[left], score[left].astype(np.int64)
        kind = np.float32 if reach < 1 << 24 else np.float64  # every partial sum is a whole number below the reach
        score = (a.vectors.astype(kind) @ b.vectors.astype(kind).T).astype(np.float64)
        i, j = np.nonzero(open_ & (score >= low[:, None]) & (score <= high[:, None]))
        return i, j, score[i, j].astype(np.int64)


def best(pool: list[tuple[int, int]], ranges: list[tuple[int, int]], most: int) -> tuple[list[tuple[int, int]], int]:
    """The first ``most`` (-score, id) of the pool in every range (low, high), and the
    least score that could still enter one."""
    pool, keep, least = sorted(set(pool)), set(), LONGEST
    for low, high in ranges:
        inside = [p for p in pool if low <= -p[0] <= high][:most]
        keep.update(inside)
        least = min(least, low if len(inside) < most else -inside[-1][0])
    return sorted(keep), least


def few(score: np.ndarray, ids: np.ndarray, ranges: list[tuple[int, int]], most: int) -> Iterator[tuple[int, int]]:
    """(-score, id) of the rows that can be among the first ``most`` ids of a range."""
    if len(score) > 16 * most and len(np.unique(ids)) == len(ids):
        stay = np.zeros(len(score), bool)
        for low, high in ranges:
            inside = np.flatnonzero((score >= low) & (score <= high))
            if len(inside) > most:  # ties of the last score stay
                inside = inside[score[inside] >= np.partition(score[inside], len(inside) - most)[len(inside) - most]]
            stay[inside] = True
        score, ids = score[stay], ids[stay]
    return zip((-score).tolist(), ids.tolist(), strict=True)


def nearest(part: Rows, block: Rows, ranges: list[list[tuple[int, int]]], same: bool, most: int, filter_: Filter) -> list[list[tuple[int, int]]]:
    """For every anchor of the block the (-score, id) of its best rows of the part: of its
    own label, itself not, or of others."""
    width = max(part.vectors.shape[1], block.vectors.shape[1])
    block = block.widened(width)
    pools: list[list[tuple[int, int]]] = [[] for _ in ranges]
    least = np.array([best([], r, most)[1] for r in ranges], np.int64)
    high = np.array([max((h for _, h in r), default=-LONGEST) for r in ranges], np.int64)
    # parts are sorted by label, so that a label's rows are one stretch
    for at in range(0, len(part.ids), TILE):
        end = min(at + TILE, len(part.ids))
        tile = Rows(part.ids[at:end], part.labels[at:end], part.vectors[at:end]).widened(width)
        equal = block.labels[:, None] == tile.labels[None, :]
        open_ = equal & (block.ids[:, None] != tile.ids[None, :]) if same else ~equal
        some = np.flatnonzero(open_.any(1))
        if not len(some):
            continue
        near = block if len(some) == len(block.ids) else Rows(block.ids[some], block.labels[some], block.vectors[some])
        columns = np.flatnonzero(open_.any(0))
        far = tile if len(columns) == len(tile.ids) else Rows(tile.ids[columns], tile.labels[columns], tile.vectors[columns])
        i, j, score = filter_.pairs(near, far, least[some], high[some], open_[np.ix_(some, columns)])
        cut = np.searchsorted(i, np.arange(len(some) + 1))
        for k in range(len(some)):
            if cut[k] < cut[k + 1]:
                at_k = some[k]
                new = few(score[cut[k] : cut[k + 1]], far.ids[j[cut[k] : cut[k + 1]]], ranges[at_k], most)
                pools[at_k], least[at_k] = best([*pools[at_k], *new], ranges[at_k], most)
    return pools


def packed(anchors: DataFrame) -> DataFrame:
    """Anchor rows (vec_id, label, embedding, row, reach) in blocks of at most ``BLOCK``, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema) as out:
                    out.write_batch(batch.slice(at, BLOCK))
                yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block"])

    return anchors.select("vec_id", "label", "embedding", "row", "reach").mapInArrow(run, "block binary")


def held_against(rows: DataFrame, anchors: DataFrame, parts: int, same: bool, most: int) -> DataFrame:
    """(anchor_id, anchor_row, vec_id, score): the best rows of every part for every anchor,
    within the ranges that its ``reach`` (scores of positives, or none) sets."""
    none = F.lit(None)
    deal = F.pmod(F.col("row"), F.lit(parts)).cast("int").alias("part")
    dealt = rows.select(deal, F.lit(0).alias("kind"), "vec_id", "label", "embedding", none.cast("binary").alias("block"))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    blocks = packed(anchors).select(everywhere, F.lit(1).alias("kind"), none.cast("bigint").alias("vec_id"), none.cast("bigint").alias("label"), none.cast(rows.schema["embedding"].dataType).alias("embedding"), "block")
    names, kinds = ["anchor_id", "anchor_row", "vec_id", "score"], [pa.int64()] * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, part, filter_ = None, [], None, Filter()
        for batch in batches:
            number, kind = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
            border = np.flatnonzero(np.diff(number) | np.diff(kind)) + 1
            for at, end in zip([0, *border], [*border, batch.num_rows], strict=True):
                if at == end:
                    continue
                if number[at] != here:
                    here, held, part = number[at], [], None
                piece = batch.slice(at, end - at)
                if kind[at] == 0:
                    held.append(piece.select(["vec_id", "label", "embedding"]))
                    continue
                if not held and part is None:
                    continue
                if part is None:
                    part, held = rows_of(pa.Table.from_batches(held)), []
                for data in piece.column("block"):
                    t = pa.ipc.open_stream(data.as_buffer()).read_all().sort_by("label")
                    ranges = [[(-LONGEST, LONGEST)] if r is None else [(-(-LOW * s // HIGH), s) for s in r] for r in t.column("reach").to_pylist()]
                    found = nearest(part, rows_of(t), ranges, same, most, filter_)
                    row = t.column("row").to_pylist()
                    out = [(a, k, None if i == NO_ID else i, max(-LONGEST, min(LONGEST, -s))) for a, k, pool in zip(t.column("vec_id").to_pylist(), row, found, strict=True) for s, i in pool]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(zip(*out, strict=True), kinds, strict=True)], names)

    both = dealt.unionByName(blocks).repartition(parts, "part").sortWithinPartitions("part", "kind")
    return both.mapInArrow(run, "anchor_id bigint, anchor_row bigint, vec_id bigint, score bigint")


def rows_of(t: pa.Table) -> Rows:
    """The table's rows, sorted by label."""
    t = t.sort_by("label").combine_chunks()
    ids = t.column("vec_id").fill_null(NO_ID).to_numpy()
    return Rows(ids, t.column("label").to_numpy(), matrix(t.column("embedding").combine_chunks()))


def first_few(hits: DataFrame, by: list[str], most: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return hits.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= most)


def mine(vectors: DataFrame, anchors: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, part_bytes: int = PART_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the
    rows (vec_id, label, embedding) that the condition ``anchors`` names (default: vec_id
    divisible by 100)."""
    rows = usable(vectors)
    asked = F.col("vec_id") % 100 == 0 if anchors is None else anchors
    size = rows.agg(F.sum(F.size("embedding") + 4)).first()[0] or 0
    parts = max(-(-8 * size // part_bytes), rows.sparkSession.sparkContext.defaultParallelism)
    first = persisted(rows.filter(asked & F.col("vec_id").isNotNull()).distinct())
    unlimited = first.withColumn("reach", F.lit(None).cast("array<bigint>"))
    near = first_few(held_against(rows, unlimited, parts, True, positives).distinct(), ["anchor_id", "anchor_row"], positives, "place")
    near = persisted(near.select("anchor_id", "anchor_row", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    reach = near.filter("positive_score >= 0").groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor_row").alias("row")).agg(F.sort_array(F.collect_set("positive_score")).alias("reach"))
    far = held_against(rows, first.join(reach, ["vec_id", "row"]), parts, False, negatives).distinct()
    # a range is judged again here, for every positive apart
    wide = lambda c, percent: F.col(c).cast("decimal(20,0)") * percent
    pairs = far.join(near, ["anchor_id", "anchor_row"]).filter((wide("positive_score", LOW) <= wide("score", HIGH)) & (F.col("score") <= F.col("positive_score")))
    ranked = first_few(pairs, ["anchor_id", "anchor_row", "place"], negatives, "rank")
    return ranked.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
