"""Language identification by prediction by partial matching (PPM, method C).

Per language a tree of byte contexts of up to three bytes holds symbol counts
over all learning documents.  A context with n occurrences and d different
symbols gives a symbol seen c times the probability c / (n + d) and the escape
d / (n + d); after an escape the next shorter context decides, at last a uniform
byte.  The counts are frozen, so the code length of every counted (context, byte)
and the escape of every context are worked out once, and a text's exact code length
in a language is a sum of table entries.  The shortest code wins; ties go to the
smallest language name.

Every counted context of every language is kept, eight bytes an entry, in sorted
tables of the language's own.  The tables go to the tasks in blocks of languages of
at most ``MODEL_BYTES`` (a lone larger language is its own block), of which a task
holds one at a time.  Only a caller who passes ``model_bytes`` gets a cut tree: then
each language keeps its most frequent contexts of two and three bytes.

Text is read with A-Z and Latin-1 capitals in lower case; each text starts after
three line feeds.

Defined results: ``und`` with score 0 for a NULL text, a text without a letter,
or if nothing could be learned; a NULL doc_id is never learned from and counts
as held out; repeated rows count and are scored each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import SLICE_BYTES, Shipped, flat, lowered, octets, persisted, remainder, slices

FOLDS, HELD_FOLD = 4, 2
MODEL_BYTES = 48 << 20  # tables that a task holds at a time
GRAMS = 4 << 20  # grams that the driver reads at once, or those of one language
PAD = 10  # a line feed


def padded(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes with three line feeds before each text, the positions
    of the bytes proper, and each text's first position among those."""
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    out = np.full(len(data) + 3 * (len(off) - 1), PAD, np.uint8)
    at = np.arange(len(data)) + 3 * (doc + 1)
    out[at] = lowered(data)
    return out, at, off[:-1]


def grams(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Four-byte grams that end at each byte, as integers."""
    b, at, _ = padded(data, off)
    code = b[at].astype(np.uint32)
    for back in (1, 2, 3):
        code |= b[at - back].astype(np.uint32) << np.uint32(8 * back)
    return code


def gram_parts(data: np.ndarray, off: np.ndarray, most: int = SLICE_BYTES) -> Iterator[np.ndarray]:
    """The grams of all bytes: at once, or those of one long text a part at a time.  A part
    sees the four bytes before it, which is as far as a gram and a capital reach."""
    if len(off) != 2 or len(data) <= 2 * most:
        yield grams(data, off)
        return
    for at in range(0, len(data), most):
        part = data[max(0, at - 4) : at + most]
        yield grams(part, np.array([0, len(part)]))[min(at, 4) :]


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
    return code[first], np.add.reduceat(n, first) if len(first) else n


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, code, n): four-byte gram counts of (text, lang) rows; summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for b in slices(batches):
            column, langs = octets(b.column(0)), b.column(1).to_pylist()
            for lang in dict.fromkeys(langs):
                own = column.filter(pa.array([x == lang for x in langs]))
                for part in gram_parts(*flat(own)):
                    code, n = np.unique(part, return_counts=True)
                    held.setdefault(lang, []).append((code, n.astype(np.int64)))
                    if len(held[lang]) == 16:
                        held[lang] = [summed(held[lang])]
        for lang, parts in held.items():
            code, n = summed(parts)
            for at in range(0, len(code), 50_000):
                c = code[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c)), pa.array(c.astype(np.int64)), pa.array(n[at : at + 50_000])], ["lang", "code", "n"])

    return docs.select("text", "lang").mapInArrow(run, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))


Table = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # grams and their bits, contexts and their escape's bits


def table(code: np.ndarray, n: np.ndarray) -> Table:
    """The table of grams of one length; ``code`` is sorted."""
    first = np.flatnonzero(np.concatenate(([True], code[1:] >> np.uint32(8) != code[:-1] >> np.uint32(8))))
    kinds = np.diff(np.append(first, len(code)))
    both = np.add.reduceat(n, first) + kinds
    return code, -np.log2(n / np.repeat(both, kinds)).astype(np.float32), code[first] >> np.uint32(8), -np.log2(kinds / both).astype(np.float32)


def tables(code: np.ndarray, n: np.ndarray, most: int | None) -> list[Table]:
    """Tables of no, one, two and three bytes of context from four-byte grams.  With
    ``most``, as many bytes at most beside the contexts of one byte."""
    grams = [summed([(code & np.uint32((1 << 8 * (k + 1)) - 1), n)]) for k in range(4)]
    if most is not None:
        longer = []
        for c, m in grams[2:]:
            own, at, kinds = np.unique(c >> np.uint32(8), return_inverse=True, return_counts=True)
            longer.append((np.bincount(at, m), 8 * kinds + 8, at))
        order = np.argsort(-np.concatenate([x[0] for x in longer]), kind="stable")
        size = np.concatenate([x[1] for x in longer])
        keep = np.zeros(len(order), bool)
        keep[order[np.cumsum(size[order]) <= most - sum(16 * len(c) for c, _ in grams[:2])]] = True
        for k, of in ((2, keep[: len(longer[0][0])]), (3, keep[len(longer[0][0]) :])):
            kept = of[longer[k - 2][2]]
            grams[k] = grams[k][0][kept], grams[k][1][kept]
    none = np.zeros(0, np.uint32), np.zeros(0, np.float32)
    return [table(c, m) if len(c) else (*none, *none) for c, m in grams]


def looked_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each wanted key is there, and its place."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


def coded(levels: list[Table], gram: np.ndarray) -> np.ndarray:
    """Bits of the last byte of each four-byte gram after the three before it."""
    bits, left = np.zeros(len(gram)), np.arange(len(gram))
    for k in (3, 2, 1, 0):
        code, cost, context, escape = levels[k]
        own = gram[left] & np.uint32((1 << 8 * (k + 1)) - 1)
        hit, at = looked_up(code, own)
        bits[left[hit]] += cost[at[hit]]
        left, own = left[~hit], own[~hit] >> np.uint32(8)
        hit, at = looked_up(context, own)
        bits[left[hit]] += escape[at[hit]]
    bits[left] += 8
    return bits


class Model:
    """Frozen code lengths: the tables of each language."""

    def __init__(self, langs: list[str], levels: list[list[Table]]):
        self.langs, self.levels = langs, levels

    @property
    def cost(self) -> list[np.ndarray]:
        """Bits of all grams and escapes, by language."""
        return [np.concatenate([x for t in levels for x in (t[1], t[3])]) for levels in self.levels]

    def blocks(self, most: int | None = None) -> list[Model]:
        """The model in runs of languages of at most ``most`` bytes, MODEL_BYTES if not given."""
        out, held = [], 0
        for lang, levels in zip(self.langs, self.levels, strict=True):
            size = sum(x.nbytes for t in levels for x in t)
            if not out or held + size > (MODEL_BYTES if most is None else most):
                out.append(Model([], []))
                held = 0
            out[-1].langs.append(lang)
            out[-1].levels.append(levels)
            held += size
        return out

    def lengths(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Code length in bits of each text (rows) in each language (columns)."""
        out = np.zeros((len(off) - 1, len(self.langs)))
        full = np.flatnonzero(np.diff(off))
        if not len(full):
            return out
        for code in gram_parts(data, off):
            order = np.argsort(code)
            code = code[order]
            new = np.concatenate(([True], code[1:] != code[:-1]))
            place = np.empty(len(code), np.int32)
            place[order] = np.cumsum(new) - 1
            code = code[new]
            at = off[full] if len(place) == len(data) else np.zeros(1, np.int64)  # a part belongs to the one long text
            for k, levels in enumerate(self.levels):
                out[full, k] += np.add.reduceat(coded(levels, code)[place], at)
        return out


def decided(langs: list[str], bits: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language with the shortest code, and its posterior under equal priors."""
    best = bits.argmin(1)
    rest = np.exp2(np.maximum(-1000.0, bits.min(1, keepdims=True) - bits)).sum(1)
    return [langs[i] for i in best], 1 / rest


def tree(grams_by_lang: DataFrame, model_bytes: int | None = None) -> Model | None:
    """The model from (lang, code, n).  The driver reads the grams of a few languages at a time."""
    counts = persisted(grams_by_lang)
    size = sorted(tuple(r) for r in counts.groupBy("lang").count().collect())
    if not size:
        return None
    levels, at = [], 0
    most = None if model_bytes is None else model_bytes // len(size)
    while at < len(size):
        end, rows = at + 1, size[at][1]
        while end < len(size) and rows + size[end][1] <= GRAMS:
            rows += size[end][1]
            end += 1
        few = [x for x, _ in size[at:end]]
        t = counts.filter(F.col("lang").isin(few)).select(F.array_position(F.lit(few), F.col("lang")).cast("int").alias("i"), "code", "n").toArrow()
        i, code, n = (t.column(c).to_numpy() for c in ("i", "code", "n"))
        for own in range(1, len(few) + 1):
            levels.append(tables(code[i == own].astype(np.uint32), n[i == own], most))
        at = end
    return Model([x for x, _ in size], levels)


def learn(docs: DataFrame, model_bytes: int | None = None) -> Model | None:
    """The model of all documents with a text, a language and an id outside the held-out fold."""
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (remainder(F.col("doc_id"), FOLDS) != HELD_FOLD))
    return tree(gram_counts(rows), model_bytes)


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def has_letter(data: np.ndarray, off: np.ndarray, texts: list[bytes]) -> list[bool]:
    return [bool(_LETTER[data[a:b]].any()) or any(map(str.isalpha, t.decode())) for a, b, t in zip(off[:-1], off[1:], texts, strict=True)]


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row."""
    shared = [Shipped(docs.sparkSession, block) for block in model.blocks()] if model is not None else []
    langs, most = model.langs if model is not None else [], SLICE_BYTES * (8 if len(shared) > 1 else 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, most=most):
            column = octets(b.column(2))
            data, off = flat(column)
            ok = has_letter(data, off, column.to_pylist())
            if not shared:
                names, score = ["und"] * b.num_rows, np.zeros(b.num_rows)
            else:
                bits = []
                for block in shared:
                    bits.append(block.value.lengths(data, off))
                    if len(shared) > 1:
                        block.drop()
                names, score = decided(langs, np.hstack(bits))
                names, score = [x if k else "und" for x, k in zip(names, ok, strict=True)], np.where(ok, score, 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_FOLD, F.lit(True))
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")
