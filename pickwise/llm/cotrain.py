"""Quality classifier by co-training two views of a document.

The content view sees the text: the shares of hashed byte pairs and word-repetition
measures.  The metadata view sees the page's record and layout: source, language,
size, line counts and line lengths, never the words.  Each view is a logistic
regression.  In each of ``ROUNDS`` rounds both views score every unlabelled document on
Spark, and each labels those it is sure of for the other view; the labels of a round
replace those of the round before, so documents that a better model is sure of come in
and others go out.  Then both views are calibrated on labelled rows kept back for it,
and a logistic regression over the two calibrated log-odds combines them.  The combined
model scores every document.

Training bounds: a fit takes at most ``SAMPLE`` rows of each class with given labels,
and as many of each class with labels from the other view, by smallest hash; their
weights stand for all rows of that label.  The search for sure documents and the scoring
cover all rows.

Defined results: NULL columns count as an empty text, as the value "" of a name, or
as size 0; a document labelled twice is good only if all its labels are; NULL labels
are ignored; repeated rows are scored each; with labels of one class only, or none,
every document gets the share of good labels, or 1 without labels; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import SLICE_BYTES, Prefix, flat, is_space, octets, persisted, runs, slices

SAMPLE = 3000
ROUNDS = 4
SURE = 0.95  # calibrated probability from which a pseudo-label is given
PSEUDO = 0.5  # weight of all pseudo-labels of a view, of that of the given labels
KEPT_BACK = 0.25  # labelled rows for calibration and combination
PAIRS = 512  # hashed byte-pair cells
NAMES = 64  # hashed cells of source and language
REJECT_BELOW = 0.5

INPUT = ["doc_id", "text", "lang", "source", "n_chars"]


def content_view(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Shares of hashed byte pairs, then word-repetition measures."""
    n = len(off) - 1
    size = np.diff(off)
    out = np.zeros((n, PAIRS + 4), np.float32)
    if len(data):
        doc = np.repeat(np.arange(n), size)
        kind = data.astype(np.int64)
        pair = (kind[:-1] * 257 + kind[1:]) * 40503 % 65521 % PAIRS
        same = doc[:-1] == doc[1:]
        cells = np.bincount(doc[:-1][same] * PAIRS + pair[same], minlength=n * PAIRS).reshape(n, PAIRS)
        out[:, :PAIRS] = 10 * np.sqrt(cells / np.maximum(size, 1)[:, None])
        start, end = runs(~is_space(data), off)
        word = Prefix(data).hashes(start, end)
        of = np.searchsorted(off, start, side="right") - 1
        words = np.bincount(of, minlength=n)
        again = np.zeros(len(word), bool)
        if len(word) > 1:
            again[1:] = (word[1:] == word[:-1]) & (of[1:] == of[:-1])
        order = np.lexsort((word, of))
        new = np.ones(len(word), bool)
        new[1:] = (word[order][1:] != word[order][:-1]) | (of[order][1:] != of[order][:-1])
        total = np.maximum(words, 1)
        distinct = np.bincount(of[order][new], minlength=n)
        out[:, PAIRS] = 5 * np.bincount(of, again, n) / total
        out[:, PAIRS + 1] = 5 * distinct / total
        out[:, PAIRS + 2] = np.log1p(words) / 3
        # words that repeat the word list beyond what a text of this size does
        out[:, PAIRS + 3] = 5 * np.maximum(0, np.log1p(words) * 0.75 - np.log1p(distinct)) / np.maximum(np.log1p(words), 1)
    return out


def metadata_view(data: np.ndarray, off: np.ndarray, lang: list[str], source: list[str], chars: np.ndarray) -> np.ndarray:
    """Hashed names, size and layout: lines, line lengths, capitals, signs, digits, repeated lines."""
    from zlib import crc32

    n = len(off) - 1
    out = np.zeros((n, NAMES + 16), np.float32)
    for i in range(n):
        out[i, crc32(b"l" + lang[i].encode()) % NAMES] += 0.3
        out[i, crc32(b"s" + source[i].encode()) % NAMES] += 0.3
    m = out[:, NAMES:]
    size = np.log2(1 + np.maximum(chars, 0))
    m[:, 0] = size / 8
    m[:, 1] = (size / 8) ** 2
    if len(data):
        total = np.maximum(np.diff(off), 1)
        doc = np.repeat(np.arange(n), np.diff(off))
        share = lambda mask: np.bincount(doc[mask], minlength=n) / total
        m[:, 2] = 5 * share((data >= 65) & (data <= 90))
        m[:, 3] = 5 * share((data >= 48) & (data <= 57))
        sign = (data > 32) & (data < 127) & ~((data >= 48) & (data <= 57)) & ~((data | 32) >= 97) | ((data | 32) > 122) & (data < 127)
        m[:, 4] = 5 * share(sign)
        m[:, 5] = 5 * share(sign & np.append(data[1:] == data[:-1], False))
        m[:, 6] = 5 * share((data == ord(".")) | (data == ord(",")))
        m[:, 7] = 5 * share(data == ord("|"))
        start, end = runs(data != 10, off)
        of = np.searchsorted(off, start, side="right") - 1
        lines = np.bincount(of, minlength=n)
        line = Prefix(data).hashes(start, end)
        order = np.lexsort((line, of))
        new = np.ones(len(line), bool)
        new[1:] = (line[order][1:] != line[order][:-1]) | (of[order][1:] != of[order][:-1])
        m[:, 8] = np.log1p(lines) / 2
        m[:, 9] = 3 * (1 - np.bincount(of[order][new], minlength=n) / np.maximum(lines, 1))
        m[:, 10] = np.log1p(np.bincount(of, end - start, n) / np.maximum(lines, 1)) / 3
        # sentences: stretches between full stops; how many of them repeat
        start, end = runs((data != ord(".")) & (data != 10), off)
        of = np.searchsorted(off, start, side="right") - 1
        part = Prefix(data).hashes(start, end)
        order = np.lexsort((part, of))
        new = np.ones(len(part), bool)
        new[1:] = (part[order][1:] != part[order][:-1]) | (of[order][1:] != of[order][:-1])
        parts = np.bincount(of, minlength=n)
        m[:, 11] = 3 * (1 - np.bincount(of[order][new], minlength=n) / np.maximum(parts, 1))
        m[:, 12] = np.log1p(parts) / 3
        m[:, 13] = np.log1p(np.bincount(of, end - start, n) / np.maximum(parts, 1)) / 3
        m[:, 14] = 5 * share(is_space(data))
        m[:, 15] = 5 * share(data >= 128)
    return out


def stretches(data: np.ndarray, inside: np.ndarray, step: int) -> Iterator[np.ndarray]:
    """Hashes of the runs of bytes that ``inside`` names, a part of at most ``step`` bytes at a
    time; runs of ``step`` bytes or more are hashed each on its own."""
    from xxhash import xxh64_intdigest

    at = 0
    while at < len(data):
        end = min(len(data), at + step)
        stops = np.flatnonzero(~inside[data[at:end]])
        if not len(stops) and end - at == step:
            while end < len(data) and not len(stops):
                stops = np.flatnonzero(~inside[data[end : end + step]])
                end += int(stops[0]) if len(stops) else min(step, len(data) - end)
            yield np.array([xxh64_intdigest(data[at:end])], np.uint64)
        else:
            if end < len(data):
                end = at + int(stops[-1]) + 1  # what begins after the last stop waits for the next part
            part = data[at:end]
            start, stop = runs(inside[part], np.array([0, len(part)]))
            yield Prefix(part).hashes(start, stop)
        at = end


def counted(data: np.ndarray, inside: np.ndarray, step: int) -> tuple[int, int, int]:
    """Runs, distinct runs, and runs that equal the one before."""
    n, again, last, seen = 0, 0, None, np.zeros(0, np.uint64)
    for h in stretches(data, inside, step):
        if len(h):
            n += len(h)
            again += int((h[1:] == h[:-1]).sum()) + int(last is not None and h[0] == last)
            last, seen = h[-1], np.union1d(seen, h)
    return n, len(seen), again


def views_of_long(data: np.ndarray, lang: str, source: str, chars: np.ndarray, step: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Both views of one long text, a part at a time; equal to those of the text at once."""
    content, metadata = (f(data[:0], np.zeros(2, np.int64), *more) for f, more in ((content_view, ()), (metadata_view, ([lang], [source], chars))))
    pairs, histogram, twins = np.zeros(PAIRS, np.int64), np.zeros(256, np.int64), 0
    every = np.arange(256)
    sign = (every > 32) & (every < 127) & ~((every >= 48) & (every <= 57)) & ~((every | 32) >= 97) | ((every | 32) > 122) & (every < 127)
    for at in range(0, len(data), step):
        part = data[at : at + step + 1]
        kind = part.astype(np.int64)
        pairs += np.bincount((kind[:-1] * 257 + kind[1:]) * 40503 % 65521 % PAIRS, minlength=PAIRS)
        histogram += np.bincount(data[at : at + step], minlength=256)
        twins += int((sign[part[:-1]] & (part[1:] == part[:-1])).sum())
    total = len(data)
    content[0, :PAIRS] = 10 * np.sqrt(pairs / total)
    space = is_space(every)
    words, distinct, again = counted(data, ~space, step)
    content[0, PAIRS:] = (
        5 * again / max(words, 1), 5 * distinct / max(words, 1), np.log1p(words) / 3,
        5 * max(0.0, np.log1p(words) * 0.75 - np.log1p(distinct)) / max(np.log1p(words), 1),
    )
    lines, lines_distinct, _ = counted(data, every != 10, step)
    parts, parts_distinct, _ = counted(data, (every != ord(".")) & (every != 10), step)
    share = lambda mask: 5 * histogram[mask].sum() / total
    metadata[0, NAMES + 2 :] = (
        share((every >= 65) & (every <= 90)), share((every >= 48) & (every <= 57)), share(sign), 5 * twins / total,
        share((every == ord(".")) | (every == ord(","))), share(every == ord("|")),
        np.log1p(lines) / 2, 3 * (1 - lines_distinct / max(lines, 1)), np.log1p((total - histogram[10]) / max(lines, 1)) / 3,
        3 * (1 - parts_distinct / max(parts, 1)), np.log1p(parts) / 3, np.log1p((total - histogram[10] - histogram[ord(".")]) / max(parts, 1)) / 3,
        share(space), share(every >= 128),
    )
    return content, metadata


def views(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = lambda c: b.column(b.schema.get_field_index(c))
    data, off = flat(octets(column("text")))
    name = lambda c: pc.fill_null(column(c), "").to_pylist()
    chars = pc.fill_null(column("n_chars"), 0).to_numpy(zero_copy_only=False).astype(float)
    if b.num_rows == 1 and len(data) > 2 * SLICE_BYTES:
        return views_of_long(data, name("lang")[0], name("source")[0], chars)
    return content_view(data, off), metadata_view(data, off, name("lang"), name("source"), chars)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3, steps: int = 250) -> np.ndarray:
    """Logistic regression by Adam on the weighted mean loss; the last weight is the intercept."""
    x = np.concatenate((x, np.ones((len(x), 1), np.float32)), 1)
    w, m, v = (np.zeros(x.shape[1], x.dtype) for _ in range(3))
    weight, y = (weight / weight.sum()).astype(x.dtype), y.astype(x.dtype)
    for t in range(1, steps + 1):
        g = x.T @ (weight * (sigmoid(x @ w) - y))
        g[:-1] += penalty * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def logits(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (x @ w[:-1] + w[-1]).astype(np.float64)


def platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn logits into calibrated log-odds (smoothed targets)."""
    good, bad = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = fitted((z[:, None] / 5).astype(np.float64), target, weight, penalty=0.0, steps=600)
    return max(float(a) / 5, 1e-3), float(b)


class Quality:
    """The two calibrated views and their combination; ``constant`` replaces them if there was nothing to learn."""

    constant: float | None = None

    def probabilities(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.constant is not None:
            p = np.full(len(content), self.constant)
            return p, p, p
        z = [a * logits(x, w) + b for x, w, (a, b) in ((content, *self.content), (metadata, *self.metadata))]
        return sigmoid(z[0]), sigmoid(z[1]), sigmoid(logits(np.stack(z, 1) / 5, self.combined))


Given = tuple[np.ndarray, np.ndarray, np.ndarray]  # view vectors, labels, weights
View = tuple[np.ndarray, tuple[float, float]]  # weights, calibration


def cotrained(content: np.ndarray, metadata: np.ndarray, y: np.ndarray, weight: np.ndarray, exchange: Callable[[list[View]], list[Given | None]], rounds: int = ROUNDS) -> Quality:
    """Co-training on labelled rows (in random order).  ``exchange`` takes the two fitted
    views and returns, for each view, what the other view labels for it."""
    cut = int(len(y) * (1 - KEPT_BACK))
    own, back = slice(0, cut), slice(cut, None)
    x, given = (content, metadata), [None, None]
    for round_ in range(rounds + 1):
        model = []
        for v in (0, 1):
            xs, ys, ws = x[v][own], y[own], weight[own]
            if given[v] is not None:
                more, labels, shares = given[v]
                xs, ys = np.concatenate((xs, more)), np.concatenate((ys, labels))
                ws = np.concatenate((ws, PSEUDO * ws.sum() * shares / shares.sum()))
            w = fitted(xs, ys, ws)
            model.append((w, platt(logits(x[v][back], w), y[back], weight[back])))
        if round_ < rounds:
            given = exchange(model)
    out = Quality()
    out.content, out.metadata = model
    z = [a * logits(s, w) + b for s, (w, (a, b)) in zip((content[back], metadata[back]), model, strict=True)]
    out.combined = fitted(np.stack(z, 1) / 5, y[back], weight[back], penalty=1e-3)
    return out


VECTORS = "doc_id bigint, h bigint, content binary, metadata binary"


def vectors(docs: DataFrame) -> DataFrame:
    """(doc_id, h, content, metadata): both views of every row with an id, as 16-bit floats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = [pa.array([r.tobytes() for r in v.astype(np.float16)], pa.binary()) for v in views(b)]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in ("doc_id", "h")] + x, ["doc_id", "h", "content", "metadata"])

    rows = docs.select(*source(docs)).filter("doc_id is not null").withColumn("h", F.xxhash64("doc_id"))
    return rows.mapInArrow(run, VECTORS)


def unpacked(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(len(column), -1).astype(np.float32)


def sure_of(rows: DataFrame, model: list[View]) -> DataFrame:
    """(doc_id, h, view, y): every row that a view is sure of, with the label it gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                b = batch.slice(at, 2048)
                for v, (w, (a, c)) in enumerate(model):
                    p = sigmoid(a * logits(unpacked(b.column(2 + v)), w) + c)
                    sure = np.flatnonzero(np.maximum(p, 1 - p) >= SURE)
                    if len(sure):
                        columns = [b.column(0).take(pa.array(sure)), b.column(1).take(pa.array(sure)), pa.array(np.full(len(sure), v, np.int32)), pa.array((p[sure] >= 0.5).astype(np.int32))]
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h", "view", "y"])

    return rows.mapInArrow(run, "doc_id bigint, h bigint, view int, y int")


class Exchange:
    """Pseudo-labels over all unlabelled rows: each view's sure ones go to the other."""

    def __init__(self, rows: DataFrame, labelled: DataFrame, sample: int):
        self.rows, self.labelled, self.sample = rows, labelled, sample

    def chosen(self, model: list[View]) -> tuple[DataFrame, dict[tuple[int, int], int]]:
        """(doc_id, h, view, y) of at most ``sample`` rows a view and label, by smallest hash,
        and how many there are of each."""
        sure = persisted(sure_of(self.rows, model).join(self.labelled, "doc_id", "left_anti").distinct())
        counts = {(r["view"], r["y"]): r["n"] for r in sure.groupBy("view", "y").agg(F.count("*").alias("n")).collect()}
        parts = [sure.filter((F.col("view") == v) & (F.col("y") == y)).orderBy("h", "doc_id").limit(self.sample) for v, y in sorted(counts)]
        out = parts[0] if parts else sure
        for p in parts[1:]:
            out = out.union(p)
        return persisted(out), counts

    def __call__(self, model: list[View]) -> list[Given | None]:
        chosen, counts = self.chosen(model)
        if not counts:
            return [None, None]
        # at most four samples: small enough to send to all tasks and to collect
        rows = self.rows.join(F.broadcast(chosen.drop("h")), "doc_id").dropDuplicates(["doc_id", "view"])
        t = rows.select("h", "doc_id", "view", "y", F.when(F.col("view") == 0, F.col("metadata")).otherwise(F.col("content")).alias("x")).toArrow().sort_by([("h", "ascending"), ("doc_id", "ascending")])
        view, label = t.column("view").to_numpy(), t.column("y").to_numpy()
        out: list[Given | None] = [None, None]
        for v in (0, 1):
            at = np.flatnonzero(view == v)
            if len(at):
                y = label[at]
                had = np.bincount(y, minlength=2)
                share = np.array([counts.get((v, k), 0) / max(1, had[k]) for k in (0, 1)])
                out[1 - v] = (unpacked(t.column("x").take(pa.array(at))), y.astype(float), share[y])
        return out


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Quality:
    """The model; only view vectors of bounded samples reach the driver."""
    lab = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    lab = lab.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min((F.col("quality") > 0).cast("int")).alias("y"))
    lab = persisted(lab.withColumn("_h", F.xxhash64("doc_id")))
    share = {r[0]: r[1] for r in lab.groupBy("y").count().collect()}
    out, total = Quality(), sum(share.values())
    if len(share) < 2:
        out.constant = share.get(1, 0) / total if total else 1.0
        return out
    rows = persisted(vectors(docs))
    chosen = persisted(lab.filter("y = 1").orderBy("_h").limit(sample).union(lab.filter("y = 0").orderBy("_h").limit(sample)).select("doc_id", "y"))
    t = rows.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).toArrow().sort_by([("h", "ascending"), ("doc_id", "ascending")])
    y = t.column("y").to_numpy()
    had = np.bincount(y, minlength=2)
    if had.min() < 2:
        out.constant = share[1] / total
        return out
    own = np.random.default_rng(0).permutation(len(y))  # not in the order of the sampling hash
    x = [unpacked(t.column(c))[own] for c in ("content", "metadata")]
    y = y[own]
    weight = np.where(y > 0, share[1] / had[1], share[0] / had[0])
    return cotrained(*x, y.astype(float), weight, Exchange(rows, lab.select("doc_id"), sample))


def source(docs: DataFrame) -> list:
    kinds = {"doc_id": "bigint", "n_chars": "bigint"}
    return [F.col(c).cast(kinds.get(c, "string")).alias(c) for c in INPUT]


def score(docs: DataFrame, model: Quality) -> DataFrame:
    """(doc_id, content_score, metadata_score, score, keep) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            p = model.probabilities(*views(b))
            cols = [b.column(0), *map(pa.array, p), pa.array(p[2] >= REJECT_BELOW)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "content_score", "metadata_score", "score", "keep"])

    return docs.select(*source(docs)).mapInArrow(run, "doc_id bigint, content_score double, metadata_score double, score double, keep boolean")


def accepted(docs: DataFrame, model: Quality) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, all columns kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield b.filter(pa.array(model.probabilities(*views(b))[2] >= REJECT_BELOW))

    return docs.mapInArrow(run, docs.schema)
