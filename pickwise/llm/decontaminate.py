"""Benchmark decontamination by SimHash windows, Hamming blocks and exact shingles.

Every text is read through windows of the items' sizes at every word position.
A window's SimHash comes from 64 bit counters held as prefix sums, eight counters
to a 64-bit integer.  Window sizes are the classes of a geometric row.  An item is
entered with windows so close together that the shortest unchanged stretch which
still reaches the similarity (``intact``) holds one of them, also where the text
begins or ends inside the passage.  A multi-index finds, for every window, all item
fingerprints within ``radius`` bits: the 64 bits are cut in four blocks, and by
the pigeonhole principle one block differs by at most ``radius // 4`` bits, so
each item is entered under all such block values.  Candidates are then verified
by the weighted (multiset) Jaccard similarity of five-word shingles between the
item and the best stretch of words, of any length, around the place where the window
puts it: words added or dropped move its ends by at most a quarter of the item.

The item index goes to the tasks in blocks of at most ``BLOCK_BYTES`` of item
text, one pass over the documents each; a lone longer item is its own block.

Words are runs of letters and digits, lower-cased; punctuation never counts.

Defined results: a NULL or empty text matches nothing; NULL or word-free items
match nothing; an item of fewer than five words is one shingle and matches only
word for word; repeated rows are each scanned; NULL ids are kept as they are; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import Prefix, flat, lowered, mixed, octets, persisted, slices, words

RADIUS = 7
SHINGLE = 5
SIMILARITY = 0.8
BLOCK_BYTES = 4 << 20  # item text of one index block
LARGEST = 240  # words of the largest window; a counter has 8 bits
GROWTH = 1.15  # ratio of neighbouring window sizes from 8 words on
PAIRS = 1 << 21  # pairs of a window and an entry that are compared at once, about

# Bit i of a byte moved to bit 8 i.
SPREAD = np.array([sum(((v >> i) & 1) << (8 * i) for i in range(8)) for v in range(256)], np.uint64)
HIGH, GATHER = np.uint64(0x8080808080808080), np.uint64(0x0002040810204081)


def window_sizes() -> np.ndarray:
    """1 to 8 words, then steps of GROWTH up to LARGEST."""
    sizes, s = list(range(1, 9)), 8.0
    while s < LARGEST:
        s *= GROWTH
        sizes.append(min(LARGEST, int(s)))
    return np.unique(sizes)


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word, and the index of its text."""
    low = lowered(data)
    start, end = words(low, off)
    return Prefix(low).hashes(start, end), np.searchsorted(off, start, side="right") - 1


def counters(h: np.ndarray) -> list[np.ndarray]:
    """Prefix sums of the 64 bits of the hashes: eight arrays, eight bits each."""
    out = []
    for byte in range(8):
        p = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(SPREAD[(h >> np.uint64(8 * byte)).astype(np.uint8)], out=p[1:])
        out.append(p)
    return out


def window_prints(sums: list[np.ndarray], size: int) -> np.ndarray:
    """SimHash of the window of ``size`` words at each position: a bit is set if
    over half of the words have it."""
    out = np.zeros(len(sums[0]) - size, np.uint64)
    lift = np.uint64(int.from_bytes(bytes([127 - size // 2] * 8), "little"))
    for byte, p in enumerate(sums):
        x = p[size:] - p[:-size]
        x += lift
        x &= HIGH
        x *= GATHER
        x >>= np.uint64(56)
        x <<= np.uint64(8 * byte)
        out |= x
    return out


def shingles(h: np.ndarray) -> np.ndarray:
    """Hashes of the five-word shingles along the last axis, or of the whole row if shorter."""
    n = min(SHINGLE, h.shape[-1])
    out = np.zeros(h.shape[:-1] + (h.shape[-1] - n + 1,), np.uint64)
    for i in range(n):
        out = mixed(out + h[..., i : i + out.shape[-1]] + np.uint64(i + 1))
    return out


def flips(within: int) -> np.ndarray:
    """All 16-bit values with at most ``within`` bits set."""
    v = np.arange(1 << 16, dtype=np.uint32)
    return v[np.bitwise_count(v) <= within].astype(np.uint16)


def intact(n: int) -> int:
    """Words of the unchanged stretch that a passage of an item of ``n`` words must hold
    to reach SIMILARITY.  A break within the passage (words changed, added, dropped or
    moved) costs both sides the shingles over it, so that ``breaks`` of them leave at
    least ``shared`` shingles in ``breaks + 1`` unchanged stretches."""
    if n < SHINGLE:
        return n
    own, over, least = n - SHINGLE + 1, SHINGLE - 1, n
    for breaks in range(own // over + 1):
        shared = SIMILARITY * (own + over * breaks) - 1e-9
        if shared > own - over * breaks:
            break
        least = min(least, math.ceil(shared / (breaks + 1)) + over)
    return least


def windows(n: int, sizes: np.ndarray) -> tuple[int, list[int]]:
    """Window size for an item of ``n`` words, and the positions at which it is entered:
    every stretch of ``intact(n)`` words holds one of the windows."""
    least = intact(n)
    size = int(sizes[np.searchsorted(sizes, max(min(least, 8), 4 * least // 5), side="right") - 1])
    return size, [*range(0, n - size, least - size + 1), n - size]


class Index:
    """Item fingerprints by window size; ``find`` returns all within the radius."""

    def __init__(self, items: list[tuple[int | None, bytes]], radius: int = RADIUS):
        self.radius, self.ids, self.hashes = radius, [], []
        sizes = window_sizes()
        entries: dict[int, list[tuple[int, int, int]]] = {}
        for item, text in items:
            data = np.frombuffer(text, np.uint8)
            h, _ = word_hashes(data, np.array([0, len(data)]))
            if not len(h):
                continue
            k, (size, places) = len(self.ids), windows(len(h), sizes)
            prints = window_prints(counters(h), size)
            for at in places:
                entries.setdefault(size, []).append((int(prints[at]), k, at))
            self.ids.append(item)
            self.hashes.append(h)
        self.shingles = [np.unique(shingles(h), return_counts=True) for h in self.hashes]
        self.by_size = {}
        flip = flips(radius // 4)
        for size, rows in sorted(entries.items()):
            prints = np.array([r[0] for r in rows], np.uint64)
            tables = []
            for block in range(4):
                own = ((prints >> np.uint64(16 * block)) & np.uint64(0xFFFF)).astype(np.uint16)
                value = (own[:, None] ^ flip).ravel().astype(np.int64)
                order = np.argsort(value, kind="stable")
                first = np.searchsorted(value[order], np.arange((1 << 16) + 1))
                tables.append((np.diff(first) > 0, first, np.repeat(np.arange(len(own)), len(flip))[order]))
            self.by_size[size] = (prints, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), tables)

    def find(self, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, entry) of every window within the radius of an entry."""
        own, _, _, tables = self.by_size[size]
        part = prints.view(np.uint16).reshape(-1, 4)
        pairs = []
        for block, (any_, first, entry) in enumerate(tables):
            step = max(1 << 12, (PAIRS << 16) // len(entry))
            for low in range(0, max(1, len(part)), step):
                value = part[low : low + step, block]
                at = np.flatnonzero(any_[value])
                value = value[at].astype(np.int64)
                n = first[value + 1] - first[value]
                pos = np.repeat(at + low, n)
                e = entry[np.repeat(first[value] - np.cumsum(n) + n, n) + np.arange(n.sum())]
                ok = np.bitwise_count(prints[pos] ^ own[e]) <= self.radius
                pairs.append(pos[ok] * len(own) + e[ok])
        both = np.unique(np.concatenate(pairs))
        return both // len(own), both % len(own)

    def best_stretch(self, k: int, codes: np.ndarray) -> tuple[float, int]:
        """(similarity, first shingle) of the stretch of shingles with the greatest weighted
        Jaccard similarity to an item, the first of several; (0, 0) if none reaches SIMILARITY."""
        own, most = self.shingles[k]
        size = int(most.sum())
        least = math.ceil(SIMILARITY * size - 1e-9)  # shingles that a stretch must share
        at = np.minimum(np.searchsorted(own, codes), len(own) - 1)
        where = np.flatnonzero(own[at] == codes)  # a best stretch begins and ends at one of the item's shingles
        item = at[where]
        if len(where) < least or np.minimum(np.bincount(item, minlength=len(own)), most).sum() < least:
            return 0.0, 0
        order = np.argsort(item, kind="stable")
        earlier = np.empty(len(item), np.int64)  # equal shingles before each
        earlier[order] = np.arange(len(item)) - np.searchsorted(item[order], item[order], side="left")
        passed, best = np.zeros(len(own), np.int64), (0.0, 0)
        for i in range(len(where) - least + 1):
            counts = earlier[i:] - passed[item[i:]] < most[item[i:]]
            shared = np.cumsum(counts)[least - 1 :]
            like = shared / (size + where[i + least - 1 :] - where[i] + 1 - shared)
            top = float(like.max())
            if top > best[0]:
                best = (top, int(where[i]))
            passed[item[i]] += 1
        return best if best[0] >= SIMILARITY - 1e-12 else (0.0, 0)

    def matches(self, h: np.ndarray, doc: np.ndarray) -> dict[tuple[int, int], tuple[float, int, int]]:
        """(text, item) to (similarity, word position, differing bits) of its best verified
        stretch."""
        found: dict[tuple[int, int], tuple[float, int, int]] = {}
        if not len(h):
            return found
        sums, seen = counters(h), {}
        codes = shingles(h) if len(h) >= SHINGLE else np.zeros(0, np.uint64)
        starts = np.searchsorted(doc, np.arange(doc[-1] + 2))
        for size, (own, item, shift, _) in self.by_size.items():
            if len(h) < size:
                continue
            prints = window_prints(sums, size)
            pos, entry = self.find(size, prints)
            ok = doc[pos] == doc[pos + size - 1]
            pos, entry = pos[ok], entry[ok]
            bits = np.bitwise_count(prints[pos] ^ own[entry])
            for i in np.lexsort((pos, bits, item[entry], doc[pos])):  # nearest first
                p, k, d = int(pos[i]), int(item[entry[i]]), int(doc[pos[i]])
                if (d, k) in found and found[d, k][0] == 1.0:
                    continue
                n, first, last = len(self.hashes[k]), int(starts[d]), int(starts[d + 1])
                begin = p - int(shift[entry[i]])
                slack = n // 8 + 4 if n >= SHINGLE else 0  # a place so near one that was tried is covered by it
                tried = seen.setdefault((d, k), [])
                if any(abs(begin - t) <= slack for t in tried):
                    continue
                tried.append(begin)
                if n < SHINGLE:
                    like, at = float(begin >= first and begin + n <= last and (h[begin : begin + n] == self.hashes[k]).all()), begin
                else:
                    room = n // 4 + 1 + slack
                    low, high = max(first, begin - room), min(last, begin + n + room) - SHINGLE + 1
                    like, at = self.best_stretch(k, codes[low:high]) if high > low else (0.0, 0)
                    at += low
                if like > found.get((d, k), (0.0,))[0]:
                    found[d, k] = (like, at - first, int(bits[i]))
        return found


def pieces(data: np.ndarray, overlap: int, most: int) -> Iterator[tuple[np.ndarray, int]]:
    """A long text in parts of about ``most`` bytes that share ``overlap`` words,
    with the number of words before each."""
    at = before = 0
    while True:
        end = min(len(data), at + most)
        while end < len(data) and data[end] not in (9, 10, 11, 12, 13, 32):
            end += 1
        yield data[at:end], before
        if end >= len(data):
            return
        start, _ = words(data[at:end], np.array([0, end - at]))
        if len(start) <= overlap:
            most *= 2
            continue
        before += len(start) - overlap
        at += int(start[len(start) - overlap])


def scan(index: Index, texts: pa.Array, most: int = 8 << 20) -> dict[tuple[int, int], tuple[float, int, int]]:
    """``Index.matches`` of a slice of texts; texts beyond ``most`` bytes go in overlapping parts."""
    data, off = flat(texts)
    if len(texts) != 1 or len(data) <= most or not index.hashes:
        return index.matches(*word_hashes(data, off))
    found: dict[tuple[int, int], tuple[float, int, int]] = {}
    for part, before in pieces(data, 2 * max(len(h) for h in index.hashes), most):
        for key, (like, at, bits) in index.matches(*word_hashes(part, np.array([0, len(part)]))).items():
            if like > found.get(key, (0.0,))[0]:
                found[key] = (like, at + before, bits)
    return found


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items, in blocks of at most BLOCK_BYTES of text each."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null").distinct()
    items = persisted(items.withColumn("_bytes", F.octet_length("text").cast("bigint")))
    total, n = items.agg(F.coalesce(F.sum("_bytes"), F.lit(0)), F.count("*")).first()
    if not n:
        return
    parts = int(total // BLOCK_BYTES) + 1
    block = lambda parts: F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    while parts < n:
        largest = items.groupBy(block(parts)).agg(F.sum("_bytes").alias("b"), F.count("*").alias("n")).filter("n > 1").agg(F.max("b")).first()[0]
        if not largest or largest <= BLOCK_BYTES:
            break
        parts *= 2
    for i in range(parts):
        rows = items.filter(block(parts) == i).select("item_id", F.col("text").cast("binary")).collect()
        if rows:
            yield [(r[0], bytes(r[1])) for r in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, bytes(r[1])))]


def contaminated(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity, word_start, differing_bits): one row for each
    document row and benchmark item that it contains."""
    schema = "doc_id bigint, item_id bigint, similarity double, word_start bigint, differing_bits int"
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for items in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, radius)
            for b in slices(batches):
                found = scan(index, octets(b.column(1)))
                ids = b.column(0).to_pylist()
                rows = [(ids[d], index.ids[k], like, at, bits) for (d, k), (like, at, bits) in found.items()]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "item_id", "similarity", "word_start", "differing_bits"])

        found = source.mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, all columns kept."""
    for items in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, radius)
            for b in slices(batches):
                keep = np.ones(b.num_rows, bool)
                keep[[d for d, _ in scan(index, octets(b.column(b.schema.get_field_index("text"))))]] = False
                if keep.any():
                    yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
