"""Line dedup: lines whose key stands in many documents are dropped everywhere.

A text is cut at line feeds.  A line's key is the line without white space at both
ends (0x20, 0x09 to 0x0D) and with A-Z in lower case.  Keys are exploded as 128-bit
hashes (two XXH64 of different seeds) and counted in two steps: line occurrences are
summed first, combined before the shuffle, which leaves only keys that stand often
enough in all; for these the distinct documents are counted.  The positions that a
document loses come back to it by its own key, and what is left is put together in
its old order.  Texts are shuffled once, to meet their positions; no key, document
or source is collected anywhere.

Defined results.  NULL text: one empty line.  Keys shorter than ``least_chars`` are
never dropped, so blank lines stay.  All lines dropped: the empty text.  Documents are
told apart by doc_id, so rows that repeat an id count once for a key; rows without
doc_id are told apart by their text.  Every row of the input gives one row, repeated
rows too.  An empty table gives no rows.  Other columns of ``docs`` are ignored unless
named in ``carry``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import persisted
from pickwise.plans.guards import Lookup

WHITE = " \t\n\x0b\x0c\r"
LEAST_DOCS, LEAST_CHARS = 10, 1
KEY, ROW = ["h1", "h2"], ["doc_id", "t1", "t2"]


def hashes(value: Column, first: str, second: str) -> list[Column]:
    """128 bits of a string: XXH64 under two seeds."""
    return [F.xxhash64(value).alias(first), F.xxhash64(F.lit(1), value).alias(second)]


def texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *hashes(text, "t1", "t2"), text.alias("text"))


def line_keys(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, t1, t2, pos, h1, h2): a row a line whose key is long enough."""
    low = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    lines = texts(docs).select(*ROW, F.posexplode(F.split(low, "\n")).alias("pos", "line"))
    lines = lines.select(*ROW, "pos", F.btrim("line", F.lit(WHITE)).alias("key"))
    return lines.filter(F.length("key") >= least_chars).select(*ROW, "pos", *hashes(F.col("key"), *KEY))


def dropped_positions(docs: DataFrame, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, t1, t2, dropped): positions, from 0, of the lines that every such text loses."""
    keys = line_keys(docs, least_chars)
    often = keys.groupBy(*KEY).agg(F.count("*").alias("lines")).filter(F.col("lines") >= least_docs).select(*KEY)
    hits = persisted(Lookup(often).join(keys, KEY))
    nameless = [F.when(F.col("doc_id").isNull(), F.col(c)).alias(c) for c in ("t1", "t2")]
    common = hits.select(*KEY, "doc_id", *nameless).distinct().groupBy(*KEY).agg(F.count("*").alias("docs"))
    lost = Lookup(common.filter(F.col("docs") >= least_docs).select(*KEY)).join(hits, KEY)
    return lost.groupBy(*ROW).agg(F.collect_set("pos").alias("dropped"))


def drop_common_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped, *carry) for every row of ``docs``, its text
    without the lines whose key stands in ``least_docs`` documents or more."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *hashes(text, "t1", "t2"), F.split(text, "\n").alias("lines"), F.struct(F.lit(0), *carry).alias("carried"))
    # written out, so that the join is a plain one in which Spark splits a hot document
    lost = persisted(dropped_positions(docs, least_docs, least_chars)).select(F.col("doc_id").alias("_id"), F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "dropped")
    met = rows.join(lost, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    kept = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(F.transform(stay, lambda i: F.get("lines", i)))
    return met.select("doc_id", F.array_join(kept, "\n").alias("text"), F.size("lines").cast("bigint").alias("n_lines"), F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"), *[F.col(f"carried.`{c}`").alias(c) for c in carry])


def digests(cleaned: DataFrame) -> DataFrame:
    """The cleaned texts as (doc_id, n_lines, n_dropped, kept_sha256)."""
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
