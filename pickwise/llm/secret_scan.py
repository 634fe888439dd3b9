"""Secret scan: fixed base patterns plus formats learned by grammar inference.

Base spans come from three patterns (assignments, access keys, hex runs).  The
strings they find are the labelled credentials: for each kind a prefix tree of
character classes is built from a bounded sample, and statistically compatible
states are merged (Hoeffding bound on arc and stop frequencies) into a
probabilistic automaton; every state keeps a little mass for classes not seen there.
Every run of 12 or more token characters outside the base
spans is then scored by all automata, and so are its pieces of 12 or more: without
signs at its ends, and cut at ``=``, then also at ``/``, ``.`` and all other signs.
Of pieces that overlap, the one that gains most becomes a span of kind ``format``: its log-likelihood ratio
against a background model of ordinary runs must come near the level that nearly all
held-back labelled credentials reach.

Training bound: at most ``SAMPLE`` distinct values of each kind, those with the
smallest hashes; one value is enough for an automaton.  The background counts every
run of all documents as often as it occurs; counting and scanning cover all rows.

Defined results: NULL text counts as empty; an empty text has no spans, the
digest of the empty string and an empty span list; repeated rows are each
scanned; without labelled credentials no format spans are added; other columns
are ignored.  Offsets count code points, the end is exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from heapq import nsmallest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import flat, octets, persisted, runs, slices

SAMPLE = 600
HELD_BACK = 0.25  # share of the sample that sets the score level
REACH = 0.02  # share of held-back credentials that may stay below the level
ROOM = 0.7  # share of that level that is enough: a small sample does not show its lowest values
ALPHA = 0.05  # confidence of the Hoeffding test
UNSEEN = 0.05  # count that every class, and the end, has in every state besides its own
MIN_CANDIDATE = 12
KINDS = ("assign", "access", "hex", "format")

# The base patterns and their least lengths.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")

# Character classes of the automata: digits, a-f, g-z, A-F, G-Z, then four groups of signs.
CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+/", "_-", ".", "=")
SYMBOL = np.full(256, -1, np.int8)
for _i, _chars in enumerate(CLASSES):
    SYMBOL[[ord(c) for c in _chars]] = _i
_HEX = np.zeros(256, bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True

_PLAIN = np.zeros(256, bool)
_PLAIN[[ord(c) for chars in CLASSES[:5] for c in chars]] = True
# Signs at which candidates are cut, coarse to fine.
_LOWER, _UPPER = (np.frombuffer(f(bytes(range(256))), np.uint8) for f in (bytes.lower, bytes.upper))
CUTS = ("", "=", "=/", "=/.", "=/.+_-")
_SIGNS = {cut: np.isin(np.arange(256), list(cut.encode())) for cut in CUTS}

Span = tuple[int, int, int]  # start, kind, end in bytes


def base_spans(data: np.ndarray, off: np.ndarray, texts: list[bytes]) -> dict[int, list[Span]]:
    """Base spans of each text that has any."""
    out: dict[int, list[Span]] = {}
    start, end = runs(_HEX[data], off)
    long = end - start >= HEX_LEAST
    start, end = start[long], end[long]
    for d, s, e in zip(np.searchsorted(off, start, side="right") - 1, start, end, strict=True):
        out.setdefault(int(d), []).append((int(s - off[d]), 2, int(e - off[d])))
    for d, text in enumerate(texts):
        if b"AKIA" in text:
            out.setdefault(d, []).extend((m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST)
        if b"=" in text or b":" in text:
            low = text.lower()
            if any(k in low for k in KEYWORDS):
                out.setdefault(d, []).extend((m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST)
    return {d: sorted(spans) for d, spans in out.items() if spans}


def outside(data: np.ndarray, off: np.ndarray, base: dict[int, list[Span]]) -> np.ndarray:
    """Where token characters stand outside the base spans."""
    edge = np.zeros(len(data) + 1, np.int64)
    for d, spans in base.items():
        for s, _, e in spans:
            edge[s + off[d]] += 1
            edge[e + off[d]] -= 1
    return (SYMBOL[data] >= 0) & (np.cumsum(edge[:-1]) == 0)


def long_runs(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end = runs(mask, off)
    long = end - start >= MIN_CANDIDATE
    return start[long], end[long]


def candidates(data: np.ndarray, off: np.ndarray, base: dict[int, list[Span]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the runs of token characters outside the base spans."""
    start, end = long_runs(outside(data, off, base), off)
    return np.searchsorted(off, start, side="right") - 1, start, end


def pieces(data: np.ndarray, off: np.ndarray, base: dict[int, list[Span]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the candidates, then of their parts at finer and finer
    cuts, each as it stands and without signs at its ends; each once."""
    mask, plain = outside(data, off, base), np.flatnonzero(_PLAIN[data])
    starts, ends = [], []
    for cut in CUTS:
        start, end = long_runs(mask & ~_SIGNS[cut][data], off)
        low, high = np.searchsorted(plain, start), np.searchsorted(plain, end) - 1
        some = low <= high
        starts += [start, plain[low[some]]]
        ends += [end, plain[high[some]] + 1]
    start, end = np.concatenate(starts), np.concatenate(ends)
    long = np.flatnonzero(end - start >= MIN_CANDIDATE)
    _, first = np.unique(start[long] * (len(data) + 1) + end[long], return_index=True)
    first = long[np.sort(first)]
    return np.searchsorted(off, start[first], side="right") - 1, start[first], end[first]


class Automaton:
    """Probabilistic automaton over the character classes, inferred by state merging."""

    def __init__(self, words: list[bytes], alpha: float = ALPHA):
        self.arc: list[dict[int, int]] = [{}]
        self.use: list[dict[int, int]] = [{}]
        self.stop, self.seen = [0], [0]
        for w in words:
            at = 0
            for s in SYMBOL[np.frombuffer(w, np.uint8)].tolist():
                self.seen[at] += 1
                self.use[at][s] = self.use[at].get(s, 0) + 1
                if s not in self.arc[at]:
                    self.arc[at][s] = len(self.arc)
                    self.arc.append({}), self.use.append({}), self.stop.append(0), self.seen.append(0)
                at = self.arc[at][s]
            self.seen[at] += 1
            self.stop[at] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        red, fringe = [0], [self.arc[0][s] for s in sorted(self.arc[0])]
        while fringe:
            blue = fringe.pop(0)
            same = next((r for r in red if self._compatible(r, blue)), None)
            if same is None:
                red.append(blue)
            else:
                for r in red:
                    for s, to in self.arc[r].items():
                        if to == blue:
                            self.arc[r][s] = same
                self._fold(same, blue)
            known = set(red)
            fringe = list(dict.fromkeys(to for r in red for _, to in sorted(self.arc[r].items()) if to not in known))
        number = {r: i for i, r in enumerate(red)}
        n = len(CLASSES)
        # every state keeps some mass for what the sample did not show there: an unseen
        # class leads to the state that was passed most often
        hub = number[max(red, key=lambda r: (self.seen[r], -r))]
        self.next = np.full((len(red), n), hub, np.int64)
        self.cost, self.end = np.zeros((len(red), n)), np.zeros(len(red))
        for r, i in number.items():
            total = self.seen[r] + UNSEEN * (n + 1)
            for s in range(n):
                self.cost[i, s] = math.log2((self.use[r].get(s, 0) + UNSEEN) / total)
            for s, to in self.arc[r].items():
                self.next[i, s] = number[to]
            self.end[i] = math.log2((self.stop[r] + UNSEEN) / total)
        del self.arc, self.use, self.stop, self.seen

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.bound * (n1**-0.5 + n2**-0.5)

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            if self._differ(self.stop[x], self.seen[x], self.stop[y], self.seen[y]):
                return False
            for s in self.arc[x].keys() | self.arc[y].keys():
                if self._differ(self.use[x].get(s, 0), self.seen[x], self.use[y].get(s, 0), self.seen[y]):
                    return False
                if s in self.arc[x] and s in self.arc[y]:
                    todo.append((self.arc[x][s], self.arc[y][s]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds the subtree under ``b`` to the state ``a``."""
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            self.stop[x] += self.stop[y]
            self.seen[x] += self.seen[y]
            for s, to in self.arc[y].items():
                self.use[x][s] = self.use[x].get(s, 0) + self.use[y][s]
                if s in self.arc[x]:
                    todo.append((self.arc[x][s], to))
                else:
                    self.arc[x][s] = to

    def scores(self, symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """log2 probability of each run."""
        total, state = np.zeros(len(start)), np.zeros(len(start), np.int64)
        live, step = np.arange(len(start)), 0
        while len(live):
            s = symbols[start[live] + step]
            total[live] += self.cost[state[live], s]
            state[live] = self.next[state[live], s]
            step += 1
            live = live[start[live] + step < end[live]]
        return total + self.end[state]


def transitions(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Counts of (class, next class) in the runs of ``data``, their ends as one more class.
    Each run counts as it stands, in lower and in upper case, so that a change of case
    alone never looks like a credential."""
    n, size = len(CLASSES), end - start
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
    first = np.cumsum(size + 1) - size - 1  # a closing class after each run
    own = np.ones(size.sum() + len(size), bool)
    own[first + size] = False
    count = np.zeros((n + 1) ** 2, np.int64)
    for case in (SYMBOL, SYMBOL[_LOWER], SYMBOL[_UPPER]):
        s = np.full(len(own) + 1, n, np.int64)
        s[1:][own] = case[data[inner]]
        s[0] = n
        count += np.bincount(s[:-1] * (n + 1) + s[1:], minlength=len(count))
    return count.reshape(n + 1, n + 1)


class Background:
    """First-order Markov model of ordinary runs over the character classes, add-one
    smoothed, from the runs or their ``transitions``."""

    def __init__(self, words: list[bytes] | np.ndarray):
        if isinstance(words, list):
            size = np.array([len(w) for w in words], np.int64)
            end = np.cumsum(size)
            words = transitions(np.frombuffer(b"".join(words), np.uint8), end - size, end)
        self.cost = np.log2((words + 1) / (words + 1).sum(1, keepdims=True))

    def scores(self, symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(CLASSES)
        inner = np.zeros(len(symbols) + 1)
        if len(symbols):
            pair = self.cost[symbols[:-1], symbols[1:]]  # -1 reads the last row: not inside any run
            inner[2:] = np.cumsum(pair)
        return self.cost[n, symbols[start]] + inner[end] - inner[start + 1] + self.cost[symbols[end - 1], n]


class Formats:
    """Automata by kind, the background, and the score level of each kind."""

    def __init__(self, labelled: dict[str, list[bytes]], ordinary: list[bytes] | np.ndarray):
        self.background = Background(ordinary)
        self.models: list[tuple[str, Automaton, float]] = []
        for kind in KINDS[:3]:
            values = labelled.get(kind, [])
            if not values:
                continue
            cut = int(len(values) * HELD_BACK)
            model = Automaton(values[cut:])
            ratio = np.sort(self._ratio(model, *self._runs(values[:cut] or values)))  # of fewer than four none is held back
            self.models.append((kind, model, max(0.0, ROOM * float(ratio[int(len(ratio) * REACH)]))))

    @staticmethod
    def _runs(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        end = np.cumsum([len(v) for v in values])
        return SYMBOL[np.frombuffer(b"".join(values), np.uint8)], np.append(0, end[:-1]), end

    def _ratio(self, model: Automaton, symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Bits a character by which the format beats the background."""
        return (model.scores(symbols, start, end) - self.background.scores(symbols, start, end)) / (end - start)

    def bits(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """By how many bits the best format whose level is reached beats the background; 0 if none is."""
        best = np.zeros(len(start))
        if len(start):
            symbols = SYMBOL[data]
            for _, model, level in self.models:
                ratio = self._ratio(model, symbols, start, end)
                best = np.where((ratio > 0) & (ratio >= level), np.maximum(best, ratio * (end - start)), best)
        return best

    def accepted(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.bits(data, start, end) > 0


def smallest(values: set[bytes], n: int) -> list[tuple[int, bytes]]:
    """The ``n`` values with the smallest hashes, as (hash, value)."""
    from xxhash import xxh64_intdigest

    return nsmallest(n, ((xxh64_intdigest(v) >> 1, v) for v in values))


def credentials(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(kind, hash, value, n): the values of base spans, and as ``ordinary`` the
    transition counts of all candidates (hash: the cell).  Each task returns its
    ``sample`` values with the smallest hashes a kind, among which are all that belong
    to the sample of the whole table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, set[bytes]] = {k: set() for k in KINDS[:3]}
        ordinary = np.zeros((len(CLASSES) + 1) ** 2, np.int64)
        for b in slices(batches):
            column = octets(b.column(0))
            data, off = flat(column)
            texts = column.to_pylist()
            base = base_spans(data, off, texts)
            for d, spans in base.items():
                for s, k, e in spans:
                    held[KINDS[k]].add(ASSIGN.match(texts[d], s)[2] if k == 0 else texts[d][s:e])
            _, start, end = candidates(data, off, base)
            ordinary += transitions(data, start, end).ravel()
            for kind, values in held.items():
                if len(values) > 8 * sample:
                    held[kind] = {v for _, v in smallest(values, sample)}
        rows = [(kind, h, v, 1) for kind, values in held.items() for h, v in smallest(values, sample)]
        rows += [("ordinary", i, b"", n) for i, n in enumerate(ordinary.tolist()) if n]
        if rows:
            kinds = (pa.string(), pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["kind", "hash", "value", "n"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "kind string, hash bigint, value binary, n bigint")
    return found.groupBy("kind", "hash", "value").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, sample: int = SAMPLE) -> Formats:
    """Automata from at most ``sample`` distinct values a kind, chosen by hash."""
    found = persisted(credentials(docs, sample))
    take = lambda kind: [bytes(r[0]) for r in found.filter(F.col("kind") == kind).orderBy("hash", "value").limit(sample).select("value").collect()]
    ordinary = np.zeros((len(CLASSES) + 1) ** 2, np.int64)
    for cell, n in found.filter("kind = 'ordinary'").select("hash", "n").collect():
        ordinary[cell] = n
    return Formats({k: take(k) for k in KINDS[:3]}, ordinary.reshape(len(CLASSES) + 1, -1))


def spans_of(formats: Formats, column: pa.Array) -> tuple[dict[int, list[Span]], np.ndarray, np.ndarray]:
    """All spans of each text that has any, with the bytes and offsets of the slice."""
    data, off = flat(column)
    found = base_spans(data, off, column.to_pylist())
    doc, start, end = pieces(data, off, found)
    bits = formats.bits(data, start, end)
    order = np.lexsort((start, start - end, -bits))  # of pieces that overlap, the one that gains most
    order = order[bits[order] > 0]
    taken = np.zeros(len(data), bool)
    for d, s, e in zip(doc[order].tolist(), start[order].tolist(), end[order].tolist(), strict=True):
        if not taken[s:e].any():
            taken[s:e] = True
            found.setdefault(d, []).append((s - int(off[d]), 3, e - int(off[d])))
    return {d: sorted(v) for d, v in found.items()}, data, off


def in_code_points(text: np.ndarray, spans: list[Span]) -> list[Span]:
    at = np.concatenate(([0], np.cumsum((text & 0xC0) != 0x80)))
    return [(int(at[s]), k, int(at[e])) for s, k, e in spans]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, formats: Formats) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_format) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found, data, off = spans_of(formats, octets(b.column(1)))
            n = np.zeros((4, b.num_rows), np.int64)
            base, all_ = [hashlib.sha256(b"").hexdigest()] * b.num_rows, [""] * b.num_rows
            for d, spans in found.items():
                spans = in_code_points(data[off[d] : off[d + 1]], spans)
                n[:, d] = np.bincount([k for _, k, _ in spans], minlength=4)
                base[d] = hashlib.sha256(joined([s for s in spans if s[1] < 3]).encode()).hexdigest()
                all_[d] = joined(spans)
            cols = [b.column(0), *map(pa.array, n[:3]), pa.array(base), pa.array(all_), pa.array(n[3])]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_format bigint")


def redacted(docs: DataFrame, formats: Formats, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` and n_chars set anew in changed rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            at, chars = b.schema.get_field_index("text"), b.schema.get_field_index("n_chars")
            found, data, off = spans_of(formats, octets(b.column(at)))
            if found:
                texts, sizes = b.column(at).to_pylist(), b.column(chars).to_pylist()
                for d, spans in found.items():
                    out, done = [], 0
                    for s, _, e in in_code_points(data[off[d] : off[d + 1]], spans):
                        if s >= done:
                            out += [texts[d][done:s], mark]
                        done = max(done, e)
                    texts[d] = "".join([*out, texts[d][done:]])
                    sizes[d] = len(texts[d])
                b = b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))
                b = b.set_column(chars, b.schema.field(chars), pa.array(sizes, b.schema.field(chars).type))
            yield b

    return docs.mapInArrow(run, docs.schema)
