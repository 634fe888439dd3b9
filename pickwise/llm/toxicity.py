"""Toxicity: noisy-channel restoration of disguised words, then a learned score.

Restoration.  A stretch of text is suspect if it mixes letters with look-alike
digits or signs (``m0r0n``), repeats a letter three times or more, doubles three
letters or any letter whose single form is cheaper under the character model
(``iddiot``), or spells a word by units of one letter, repeated or not, between white
space or any signs (``m oo r o n``, ``m/0/r/0/n``).  Each suspect stretch becomes a
lattice: every unit (a character with its repetition) has the alternatives that a
writer could have meant, each with a channel cost in bits.  Viterbi decoding under
a character trigram model finds the cheapest reading exactly.  The trigram model is
counted over all documents.

Score.  Features are the restored words and their 4-, 5- and 6-byte beginnings.
From a bounded sample of labelled learning rows (``SAMPLE`` of each class, by
smallest hash, repeated texts once) all features tied to label 1 (by chi-squared) are
taken and a logistic regression on their presence is fitted, weighted back to the class
shares of all learning rows.  All documents are scored.

Memory.  A text beyond ``PART`` bytes is read a part at a time, cut where no word or
stretch crosses, so the result is that of the text at once.  A lattice is made and
decoded unit by unit.  Only a text without a blank after two different ASCII letters is
held whole (about 40 bytes a byte).

Defined results: NULL and empty texts have no features and get the score of the
intercept; a NULL doc_id counts as held out; a doc labelled twice counts as toxic
if any label is 1; NULL labels are ignored; repeated rows are scored each; without
both classes every score is the share of label 1 (0 without labels); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import Prefix, Shipped, flat, is_space, lowered, octets, persisted, remainder, runs, slices, words

FOLDS, HELD_FOLD = 5, 0
SAMPLE = 6000  # learning rows of each class
PART = 2 << 20  # bytes of one text handled at once
KNOWN = 256  # readings of longer stretches are not kept
LEAST_DOCS = 3  # toxic learning rows that must hold a feature
LEAST_CHI2 = 12.0
STEMS = (4, 5, 6)

# Look-alike signs and the letters they stand for.
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}
SEPARATORS = ".-_*"
UNITS = re.compile(r"[^\W_]+")
# Channel costs in bits.
SUBSTITUTE, REPEAT, JOIN, SPLIT, NOISE = 1.0, 1.0, 0.5, 6.0, 20.0

_ALPHA = np.zeros(256, bool)
_ALPHA[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOOK = np.zeros(256, bool)
_LOOK[[ord(c) for c in LOOKALIKES]] = True
_INNER = np.zeros(256, bool)  # signs that count only with a letter on either side
_INNER[[ord("!"), ord("|")]] = True
_SEP = np.zeros(256, bool)
_SEP[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in LOOKALIKES]] = True
_NUMBER = np.zeros(256, bool)  # digits that stand for no letter
_NUMBER[[c for c in range(48, 58) if chr(c) not in LOOKALIKES]] = True

# Symbols of the character model: 0 any other byte, 1-26 letters, then bytes from 128.
MODEL_SIZE = 27 + 128
_CODE = np.zeros(256, np.int64)
_CODE[97:123] = np.arange(1, 27)
_CODE[128:] = np.arange(27, MODEL_SIZE)


class CharModel:
    """Trigram code lengths in bits, each order mixed with the one below."""

    def __init__(self, code: np.ndarray, n: np.ndarray, weight: float = 8.0):
        m = MODEL_SIZE
        three = np.zeros(m**3)
        three[code] = n
        three = three.reshape(m, m, m)
        two, one = three.sum(0), three.sum((0, 1))
        p1 = (one + 1) / (one.sum() + m)
        p2 = (two + weight * p1) / (two.sum(1, keepdims=True) + weight)
        self.bits = (-np.log2((three + weight * p2) / (three.sum(2, keepdims=True) + weight))).astype(np.float32)
        self.known: dict[bytes, bytes] = {}

    def decode(self, units: Iterable[list[tuple[bytes, float]]]) -> bytes:
        """Cheapest path through a lattice of (output, channel cost) alternatives.  Where one
        state is left, all paths share what lies before it, which is settled at once."""
        bits, settled = self.bits, bytearray()
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for unit in chain(units, [[(b" ", 0.0)]]):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, path) in best.items():
                for out, channel in unit:
                    x, y, total = a, b, cost + channel
                    for s in out:
                        c = int(_CODE[s])
                        total += float(bits[x, y, c])
                        x, y = y, c
                    if (x, y) not in after or total < after[x, y][0]:
                        after[x, y] = (total, (out, path) if out else path)
            best = after
            if len(best) == 1:
                state, (cost, path) = next(iter(best.items()))
                settled += outputs(path)
                best = {state: (cost, None)}
        settled += outputs(min(best.values(), key=lambda v: v[0])[1])
        return bytes(settled[:-1])  # without the closing blank

    def restored(self, token: bytes) -> bytes:
        """The cheapest reading of a suspect stretch."""
        if len(token) > KNOWN:
            return self.decode(alternatives(token))
        if token not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            self.known[token] = self.decode(alternatives(token))
        return self.known[token]


def outputs(path: tuple | None) -> bytes:
    """What a path of (output, path before) puts out."""
    out = []
    while path:
        out.append(path[0])
        path = path[1]
    return b"".join(reversed(out))


def spelt(text: str) -> bool:
    """Whether three units of one character, repeated or not, follow each other between signs."""
    row = 0
    for found in UNITS.finditer(text):
        unit = found[0]
        row = row + 1 if unit == unit[0] * len(unit) else 0
        if row == 3:
            return True
    return False


def alternatives(token: bytes) -> Iterator[list[tuple[bytes, float]]]:
    """Alternatives of each unit of a lower-cased stretch: a letter or sign with its repetition."""
    text = token.decode("utf-8", "replace")
    apart = spelt(text)
    i, before = 0, ""  # the letters that the unit before the separator could be
    while i < len(text):
        c, j = text[i], i
        while j < len(text) and text[j] == c:
            j += 1
        r, i = j - i, j
        if c.isalpha():
            one = c.encode()
            unit = [(one, 0.0)] if r == 1 else [(one, REPEAT), (one * 2, REPEAT if r > 2 else 0.0)]
            if apart and c in before:
                unit.append((b"", REPEAT))
            before = c
            yield unit
        elif c in LOOKALIKES:
            options = [(b" ", NOISE), (b"", NOISE)]
            for x in LOOKALIKES[c]:
                options.append((x.encode(), SUBSTITUTE if r == 1 else SUBSTITUTE + REPEAT))
                if r > 1:
                    options.append((x.encode() * 2, SUBSTITUTE))
                if apart and x in before:
                    options.append((b"", SUBSTITUTE + REPEAT))
            if apart and not c.isalnum():
                options[:2] = [(b"", JOIN), (b" ", SPLIT)]
            before = LOOKALIKES[c] if c.isalnum() else before + LOOKALIKES[c]
            yield options
        elif apart and not c.isalnum():
            while i < len(text) and not text[i].isalnum() and text[i] not in LOOKALIKES:
                i += 1
            yield [(b"", JOIN), (b" ", SPLIT)]
        elif c.isspace() or c in SEPARATORS:
            yield [(b"", JOIN), (b" ", SPLIT)]
        else:
            yield [(b" ", 0.0)]


def lattice(token: bytes) -> list[list[tuple[bytes, float]]]:
    """All units of a stretch."""
    return list(alternatives(token))


def suspects(low: np.ndarray, off: np.ndarray, model: CharModel) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the suspect stretches of lower-cased bytes."""
    n = len(low)
    if n < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end = runs(~is_space(low), off)
    alpha, look, sep = _ALPHA[low], _LOOK[low], _SEP[low]
    before, after = np.concatenate(([False], alpha[:-1])), np.concatenate((alpha[1:], [False]))
    mark = look & np.where(_INNER[low], before & after, before | after)
    same = (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & alpha[2:] & (low[2:] < 128)
    mark[:-2] |= same
    letter = alpha | look
    if n >= 5:  # letter, sign, letter, sign, letter; look-alikes count, but not alone
        between = letter[:-4] & sep[1:-3] & letter[2:-2] & sep[3:-1] & letter[4:]
        mark[:-4] |= between & (alpha[:-4] | alpha[2:-2] | alpha[4:])
    pair = np.zeros(n, bool)
    pair[:-1] = (low[1:] == low[:-1]) & alpha[1:] & (low[1:] < 128)
    border = np.zeros(n + 3, bool)  # where a text begins or ends
    border[off] = True
    pair &= ~border[1 : n + 1]
    # A doubled letter is suspect if the single one is cheaper; only the three codes
    # over the pair differ, unless another pair follows at once.
    at = np.flatnonzero(pair)
    x, y, z = np.where(border[at], 0, _CODE[low[at - 1]]), _CODE[low[at]], np.where(border[at + 2], 0, _CODE[low[np.minimum(at + 2, n - 1)]])
    mark[at] |= (model.bits[x, y, y] + model.bits[y, y, z] > model.bits[x, y, z] + REPEAT) | np.concatenate((pair, [False, False]))[at + 2]
    count = np.concatenate((np.zeros(1, np.int32), np.cumsum(mark, dtype=np.int32)))
    hit = count[end] > count[start]
    count = np.concatenate((np.zeros(1, np.int32), np.cumsum(pair, dtype=np.int32)))
    hit |= count[end] - count[start] >= 3  # three doubled letters
    # units of one letter, repeated or not, with signs and blanks between: three or more in a row are one stretch
    first, last = runs(letter, off)
    change = np.concatenate((np.zeros(1, np.int32), np.cumsum(low[1:] != low[:-1], dtype=np.int32)))
    unit = (low[first] < 128) & (change[last - 1] == change[first]) | (low[first] >= 0xC2) & (low[first] < 0xE0) & (last - first == 2)
    doc = np.searchsorted(off, first, side="right") - 1
    count = np.concatenate((np.zeros(1, np.int32), np.cumsum(_NUMBER[low], dtype=np.int32)))
    next_ = np.zeros(len(first), bool)
    next_[:-1] = unit[:-1] & unit[1:] & (doc[1:] == doc[:-1]) & (count[first[1:]] == count[last[:-1]])
    a = np.flatnonzero(next_ & ~np.concatenate(([False], next_))[: len(next_)])
    b = np.flatnonzero(~next_ & np.concatenate(([False], next_))[: len(next_)])
    count = np.concatenate((np.zeros(1, np.int32), np.cumsum(alpha[first])))
    long = (b - a >= 2) & (count[b + 1] - count[a] >= 2)
    s, e = np.concatenate((start[hit], first[a[long]])), np.concatenate((end[hit], last[b[long]]))
    if not len(s):
        return s, e
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    new = np.concatenate(([True], s[1:] >= e[:-1]))  # what overlaps is one stretch
    return s[new], e[np.append(np.flatnonzero(new)[1:] - 1, len(e) - 1)]


def trimmed(token: bytes) -> tuple[int, int]:
    """The part of a stretch between closing punctuation: signs that are no
    look-alikes, exclamation marks, and runs of three or more equal signs."""
    s, e = 0, len(token)
    while e > s and not _ALPHA[token[e - 1]]:
        c, r = token[e - 1], 1
        while e - r > s and token[e - r - 1] == c:
            r += 1
        if _LOOK[c] and c not in b"!|" and r < 3:
            break
        e -= r
    while s < e and not _ALPHA[token[s]]:
        c, r = token[s], 1
        while s + r < e and token[s + r] == c:
            r += 1
        if _LOOK[c] and r < 3:
            break
        s += r
    return s, e


def restore(model: CharModel, low: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Lower-cased texts with their suspect stretches restored, and how many changed."""
    start, end = suspects(low, off, model)
    if not len(start):
        return low, off, 0
    raw, out, at, shift, changed = low.tobytes(), [], 0, np.zeros(len(off), np.int64), 0
    for s, e in zip(start.tolist(), end.tolist(), strict=True):
        a, b = trimmed(raw[s:e])
        new = model.restored(raw[s + a : s + b]) if b > a else b""
        if b <= a or new == raw[s + a : s + b]:
            continue
        out += [raw[at : s + a], new]
        at = s + b
        shift[np.searchsorted(off, s, side="right")] += len(new) - (b - a)
        changed += 1
    out.append(raw[at:])
    return np.frombuffer(b"".join(out), np.uint8), off + np.cumsum(shift), changed


def read(model: CharModel, data: np.ndarray, off: np.ndarray, most: int = PART) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Feature hashes of the restored texts, the text of each, and suspect stretches a text;
    those of one long text a part at a time, each feature once a part."""
    for part, at in parts(data, off, most):
        low = lowered(part)
        start, _ = suspects(low, at, model)
        found = np.bincount(np.searchsorted(at, start, side="right") - 1, minlength=len(at) - 1)
        h, d = features(*restore(model, low, at)[:2])
        if len(data) > most:
            h = np.unique(h)
            d = np.zeros(len(h), np.int64)
        yield h, d, found


def features(low: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and word beginnings, and the text of each."""
    start, end = words(low, off)
    prefix = Prefix(low)
    doc = np.searchsorted(off, start, side="right") - 1
    h, d = [prefix.hashes(start, end)], [doc]
    for n in STEMS:
        long = end - start > n
        h.append(prefix.hashes(start[long], start[long] + n) ^ np.uint64(n))
        d.append(doc[long])
    return np.concatenate(h), np.concatenate(d)


def parts(data: np.ndarray, off: np.ndarray, most: int = PART) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts at once, or one long text in parts of about ``most`` bytes.  A part ends at a
    blank after two different ASCII letters: neither a word nor a stretch crosses it.  Without
    such a blank a part goes on."""
    if len(off) != 2 or len(data) <= most:
        yield data, off
        return
    at = 0
    while at < len(data):
        end = at + most
        while end < len(data):
            here = data[end - 2 : end + (1 << 16)]
            low = here | 32
            letter = (low >= 97) & (low <= 122)
            cut = np.flatnonzero(is_space(here[2:]) & letter[1:-1] & letter[:-2] & (low[1:-1] != low[:-2]))
            if len(cut):
                end += int(cut[0])
                break
            end += len(here) - 2
        end = min(end, len(data))
        yield data[at:end], np.array([0, end - at])
        at = end


def trigrams(data: np.ndarray, off: np.ndarray, most: int = PART) -> Iterator[np.ndarray]:
    """Codes of every byte with the two before it; those of one long text a part at a time."""
    step = most if len(off) == 2 else max(len(data), 1)
    for at in range(0, len(data), step):
        first = max(0, at - 3)
        s = _CODE[lowered(data[first : at + step])]
        pad = np.concatenate((np.zeros(2, np.int64), s))
        one, two = pad[1:-1].copy(), pad[:-2].copy()
        if not at:
            edge = off[:-1][off[:-1] < len(s)]
            one[edge] = two[edge] = 0
            two[(edge + 1)[edge + 1 < len(s)]] = 0
        yield ((two * MODEL_SIZE + one) * MODEL_SIZE + s)[at - first :]


def char_counts(docs: DataFrame) -> CharModel:
    """The trigram model of all documents; each task sends its non-zero counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(MODEL_SIZE**3, np.int64)
        for b in slices(batches, most=PART):
            for code in trigrams(*flat(octets(b.column(0)))):
                held += np.bincount(code, minlength=len(held))
        code = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(held[code])], ["code", "n"])

    t = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    return CharModel(t.column("code").to_numpy(), t.column("n").to_numpy())


def matched(keys: np.ndarray, h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Text * number of keys + key of the features that are among the sorted keys, each once."""
    if not len(keys):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    ok = keys[at] == h
    return np.unique(doc[ok] * len(keys) + at[ok])


class Scorer:
    """Sorted feature hashes, their weights, and the intercept."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, intercept: float):
        self.keys, self.weights, self.intercept = keys, weights, intercept

    def scores(self, found: list[np.ndarray], n: int) -> np.ndarray:
        """Scores of ``n`` texts that hold the features ``found`` (text * number of keys + key)."""
        total = np.full(n, self.intercept)
        if len(self.keys):
            pair = np.unique(np.concatenate(found))
            np.add.at(total, pair // len(self.keys), self.weights[pair % len(self.keys)])
        return 1 / (1 + np.exp(-total))


def fitted(rows: np.ndarray, cols: np.ndarray, label: np.ndarray, weight: np.ndarray, n: int, penalty: float = 0.005, steps: int = 1500) -> tuple[np.ndarray, float]:
    """Logistic regression on feature presence (row, column pairs) by Adam; L2 penalty."""
    w, b = np.zeros(n), math.log(max(weight @ label, 1e-9) / max(weight @ (1 - label), 1e-9))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, steps + 1):
        z = np.bincount(rows, w[cols], len(label)) + b
        g = weight * (1 / (1 + np.exp(-z)) - label)
        grad = np.append(np.bincount(cols, g[rows], n) + penalty * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def learn(docs: DataFrame, labels: DataFrame, model: CharModel, sample: int = SAMPLE) -> Scorer:
    spark = docs.sparkSession
    lab = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    lab = lab.filter(F.col("toxic").isNotNull() & (remainder(F.col("doc_id"), FOLDS) != HELD_FOLD)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    lab = persisted(lab.withColumn("_h", F.xxhash64("doc_id")))
    share = {int(r[0] > 0): r[1] for r in lab.groupBy("toxic").count().collect()}
    total = sum(share.values())
    if len(share) < 2:
        p = min(1 - 1e-6, max(1e-6, share.get(1, 0) / total if total else 0.0))
        return Scorer(np.zeros(0, np.uint64), np.zeros(0), math.log(p / (1 - p)))
    chosen = lab.filter("toxic > 0").orderBy("_h").limit(sample).union(lab.filter("toxic <= 0").orderBy("_h").limit(sample))
    chosen = F.broadcast(chosen.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic")))  # at most 2 * sample rows
    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = text.join(chosen, "doc_id").withColumn("_t", F.xxhash64("text", "toxic")).dropDuplicates(["_t"])
    rows = persisted(rows.select("_t", "text", "toxic").repartition(F.col("_t")))
    shared = Shipped(spark, model)

    def hashed(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        return read(shared.value, *flat(octets(b.column(b.schema.get_field_index("text")))))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n = [np.zeros(0, np.uint64)], [np.zeros((0, 2), np.int64)]
        for b in slices(batches):
            seen = list(hashed(b))
            h, d = (np.concatenate([x[k] for x in seen]) for k in (0, 1))
            toxic = b.column(2).to_numpy()
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            once = np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1]))) if len(h) else np.zeros(0, bool)
            h, t = h[once], toxic[d[once]]
            code.append(h)
            n.append(np.stack((t, 1 - t), 1))
        h, t = np.concatenate(code), np.concatenate(n)
        order = np.argsort(h, kind="stable")
        h, t = h[order], t[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
        t = np.add.reduceat(t, first) if len(first) else t
        for at in range(0, len(first), 50_000):
            k = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(h[first[k]].view(np.int64)), pa.array(t[k, 0]), pa.array(t[k, 1])], ["h", "bad", "good"])

    n_bad, n_good = (rows.filter(f"toxic = {k}").count() for k in (1, 0))
    if not n_bad or not n_good:
        p = min(1 - 1e-6, max(1e-6, share[1] / total))
        return Scorer(np.zeros(0, np.uint64), np.zeros(0), math.log(p / (1 - p)))
    counts = rows.mapInArrow(counted, "h bigint, bad bigint, good bigint").groupBy("h").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    n = n_bad + n_good
    excess = F.col("bad") * float(n_good) - F.col("good") * float(n_bad)
    seen = F.col("bad") + F.col("good")
    chi2 = F.lit(float(n)) * excess * excess / (F.lit(float(n_bad) * n_good) * seen * (F.lit(float(n)) - seen + F.lit(1e-9)))
    best = counts.filter((F.col("bad") >= LEAST_DOCS) & (excess > 0)).withColumn("chi2", chi2).filter(F.col("chi2") >= LEAST_CHI2)
    keys = np.sort(best.select("h").toArrow().column("h").to_numpy().view(np.uint64))
    held = spark.sparkContext.broadcast(keys)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            k = held.value
            if not len(k):
                continue
            pair = np.unique(np.concatenate([matched(k, h, d) for h, d, _ in hashed(b)]))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(pair // len(k))), pa.array(pair % len(k))], ["row", "col"])

    ids = rows.select("_t", "toxic").orderBy("_t").toArrow()
    cells = rows.mapInArrow(present, "row bigint, col bigint").toArrow()
    label = ids.column("toxic").to_numpy().astype(float)
    at = np.searchsorted(ids.column("_t").to_numpy(), cells.column("row").to_numpy())
    cols = cells.column("col").to_numpy()
    order = np.lexsort((cols, at))
    weight = np.where(label > 0, share[1] / n_bad, share[0] / n_good) * (n / total)
    w, b = fitted(at[order], cols[order], label, weight, len(keys))
    return Scorer(keys, w, b)


def score(docs: DataFrame, model: CharModel, scorer: Scorer) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_suspect) for every row."""
    shared, weighed = Shipped(docs.sparkSession, model), Shipped(docs.sparkSession, scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm, judge = shared.value, weighed.value
        for b in slices(batches):
            changed, found = np.zeros(b.num_rows, np.int64), []
            for h, d, n in read(lm, *flat(octets(b.column(2)))):
                changed += n
                found.append(matched(judge.keys, h, d))
            p = judge.scores(found, b.num_rows)
            cols = [b.column(0), b.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(changed)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "score", "predicted", "n_suspect"])

    held = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_FOLD, F.lit(True))
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int, n_suspect bigint")


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    model = char_counts(docs)
    return score(docs, model, learn(docs, labels, model, sample))
