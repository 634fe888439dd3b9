"""Token counts as delta-maintained rollups.

A change is an insert (+1 document, +tokens), a delete (-1, -tokens) or a revision
(0, tokens - old_tokens) of a document's count under one tokenizer version.  A batch
of changes is summed by source, language and version and written to its own folder
of the ledger; the folder counts once its writer's success mark exists.  Committing
a batch again changes nothing, a batch of the same name with other sums is an error,
and a broken commit is written anew, so totals are the sums over committed batches
whatever was retried.  Totals are additive: later
batches never read earlier documents.

Defined results: NULL source, language or version are values of their own; NULL
token counts are 0; changes of an unknown or NULL kind count nothing; repeated rows
of a batch count each; a NULL text has no tokens; an empty batch commits and adds
nothing; a ledger without batches has no totals; other columns are ignored.  In
``corpus_history`` rows without doc_id are copies where a row with an id has their
text; among themselves they all stay, as do repeated rows of an id.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.llm.common import octets, persisted, slices

TOKENIZERS = "/opt/tokenizers"  # folder of the vocabulary files
VERSIONS = {"byte_bpe_50k": "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k": "byte_bpe_multi_50k.tiktoken"}
# Fixed value: the public splitting pattern of these vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEYS = ["source", "lang", "version"]
LEDGER = "source string, lang string, version string, docs bigint, tokens bigint"

_encoders: dict[int, object] = {}


def encoder(vocabulary: bytes) -> object:
    """The encoder of a vocabulary file, made once in each worker."""
    key = hash(vocabulary)
    if key not in _encoders:
        import tiktoken

        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in vocabulary.splitlines() if line)}
        _encoders[key] = tiktoken.Encoding(f"v{key}", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def token_counts(docs: DataFrame, columns: dict[str, tuple[str, str]], folder: str = TOKENIZERS) -> DataFrame:
    """``docs`` with, for each name in ``columns``, the token count of a text column
    under a version: {name: (text column, version)}; the text columns are dropped."""
    vocabularies = {}
    for version in {v for _, v in columns.values()}:
        with open(f"{folder}/{VERSIONS[version]}", "rb") as f:
            vocabularies[version] = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(vocabularies)  # about 1 MB a version
    texts = list(dict.fromkeys(t for t, _ in columns.values()))
    rest = [c for c in docs.columns if c not in texts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, texts[0]):
            out = [b.column(b.schema.get_field_index(c)) for c in rest]
            plain = {t: [x.decode() for x in octets(b.column(b.schema.get_field_index(t))).to_pylist()] for t in texts}
            for text, version in columns.values():
                e = encoder(shared.value[version])
                out.append(pa.array([len(e.encode_ordinary(x)) for x in plain[text]], pa.int64()))
            yield pa.RecordBatch.from_arrays(out, [*rest, *columns])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in rest] + [f"`{c}` bigint" for c in columns])
    return docs.select(*rest, *texts).mapInArrow(run, schema)


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums of (op, source, lang, version, tokens, old_tokens) changes by key."""
    new, old = F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    docs = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).otherwise(0)
    tokens = F.when(F.col("op") == "insert", new).when(F.col("op") == "delete", -new).when(F.col("op") == "revise", new - old).otherwise(0)
    return changes.groupBy(*KEYS).agg(F.sum(docs).cast("bigint").alias("docs"), F.sum(tokens).cast("bigint").alias("tokens"))


def content(rows: DataFrame) -> tuple:
    """Rows and a hash of the sums, whatever their order."""
    return tuple(rows.agg(F.count("*"), F.bit_xor(F.xxhash64(*KEYS, "docs", "tokens"))).first())


class Ledger:
    """Committed batches of deltas below one folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _files(self) -> tuple:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.spark._jvm.org.apache.hadoop.fs.Path

    def committed(self) -> list[str]:
        fs, path = self._files()
        found = fs.globStatus(path(f"{self.folder}/batch=*/_SUCCESS"))
        return sorted(f.getPath().getParent().getName().removeprefix("batch=") for f in found or [])

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Writes a batch; False if it was committed before with the same sums (nothing is
        done then).  A batch of that name with other sums is an error.  The batch is written
        beside its place and moved there at once, so of two writers one commits."""
        fs, path = self._files()
        place, beside = f"{self.folder}/batch={batch}", f"pending-{uuid.uuid4().hex}"
        rows = persisted(deltas(changes))
        if batch not in self.committed():
            rows.write.parquet(f"{self.folder}/{beside}")
            if fs.exists(path(place)) and batch not in self.committed():
                fs.delete(path(place), True)  # left by a writer that died
            # a move to a folder that exists fails, or ends inside it
            moved = fs.rename(path(f"{self.folder}/{beside}"), path(place))
            inside = path(f"{place}/{beside}")
            if moved and not fs.exists(inside):
                return True
            fs.delete(inside if moved else path(f"{self.folder}/{beside}"), True)
        if content(rows) != content(self.spark.read.schema(LEDGER).parquet(place)):
            raise ValueError(f"batch {batch} was committed with other content")
        return False

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) over all committed batches."""
        batches = self.committed()
        if not batches:
            return self.spark.createDataFrame([], LEDGER)
        rows = self.spark.read.schema(LEDGER).parquet(*[f"{self.folder}/batch={b}" for b in batches])
        return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))

    def rollup(self) -> DataFrame:
        """Totals of every level: (source, lang, version), (source, version), (lang, version), (version)."""
        t = self.totals()
        t.createOrReplaceTempView("_token_totals")
        return self.spark.sql(
            """SELECT source, lang, version, CAST(grouping(source) AS INT) AS all_sources, CAST(grouping(lang) AS INT) AS all_langs,
                      CAST(SUM(docs) AS BIGINT) AS docs, CAST(SUM(tokens) AS BIGINT) AS tokens
               FROM _token_totals
               GROUP BY GROUPING SETS ((source, lang, version), (source, version), (lang, version), (version))"""
        )


def corpus_history(spark: SparkSession, docs: DataFrame, folder: str) -> Ledger:
    """A ledger of the whole corpus: load, second tokenizer version, removal of exact
    copies, revision after white space is normalised; some commits are replayed."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.md5(F.coalesce(text, F.lit(""))).alias("digest"), text.alias("text"), F.trim(F.regexp_replace(text, r"\s+", " ")).alias("tidy"))
    one, two = VERSIONS
    rows = persisted(token_counts(rows, {"first": ("text", one), "second": ("text", two), "revised": ("tidy", one)}))
    change = lambda rows, op, version, tokens, old=F.lit(0): rows.select(F.lit(op).alias("op"), "source", "lang", F.lit(version).alias("version"), F.col(tokens).alias("tokens"), old.alias("old_tokens"))
    kept = rows.groupBy("digest").agg(F.min("doc_id").alias("kept"), F.count("*").alias("n")).filter("n > 1")
    kept = persisted(kept.select("digest", "kept"))
    # of texts that some row with an id has, all rows without one are copies
    copies = rows.join(kept, "digest").filter("kept IS NOT NULL AND NOT doc_id <=> kept")
    stay = rows.join(kept, "digest", "left").filter("kept IS NULL OR doc_id <=> kept")
    batches = {
        "load": change(rows, "insert", one, "first"),
        "second_version": change(rows, "insert", two, "second"),
        "remove_copies": change(copies, "delete", one, "first").union(change(copies, "delete", two, "second")),
        "normalise": change(stay.filter("revised <> first"), "revise", one, "revised", F.col("first")),
    }
    ledger = Ledger(spark, folder)
    for name in ("load", "second_version", "load", "remove_copies", "normalise", "remove_copies"):
        ledger.commit(name, batches[name])
    return ledger
