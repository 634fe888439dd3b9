"""Corpus preparation: quality filter, near duplicates, benchmark leaks, secrets, source mix.

STAGES lists the stages; each takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next stage's ``docs``.  Columns beside
those of ``documents`` are dropped by the first stage; an empty table stays empty through all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pickwise.llm import cotrain, decontaminate, mixing, near_dups, secret_scan
from pickwise.llm.common import table
from pickwise.session import shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go.  NULL columns count as empty or
    0; without labels, or with one class only, all stay or go by the share of good labels;
    every row is judged by itself, so repeated rows stay or go together."""
    docs = docs.select(*COLUMNS)
    return cotrain.accepted(docs, cotrain.learn(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest doc_id, of several
    texts with that id the one with the least hash, of repeated rows one.  NULL and blank texts are near
    each other; groups in which no row has an id stay as they are."""
    return near_dups.one_of_each(docs.select(*COLUMNS))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go.  NULL and empty texts contain none; NULL
    or word-free items are in none; every row is judged by itself."""
    return decontaminate.without_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark and n_chars set anew; all documents stay, those
    with NULL or empty texts as they are."""
    docs = docs.select(*COLUMNS)
    return secret_scan.redacted(docs, secret_scan.learn(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix and how often each is taken; those not taken go, among them
    all without words.  A NULL source is a source of its own; repeated rows are taken each."""
    return mixing.mixed_sources(docs.select(*COLUMNS)).filter("copies > 0")


STAGES = [
    ("quality classifier", reject_poor),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
]

# Fitted classifiers, inferred automata and balanced sampling cannot be stated in SQL;
# tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{shared_dir(spark, 'pipeline')}-{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
