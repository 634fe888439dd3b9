"""Inputs shared by the tests of the training-data operators."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Extra columns whose names the operators use inside.
CLASH = "fp bigint, h bigint, _h bigint, part bigint, size string, target string, row string, p string, g bigint, y int, label string, found string, kept bigint, digest string, head int, held_out string, score string"

LONG = "stretch of words that goes on " * 4000

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog.\nIt was a fine day. Nothing else happened!", "en", "a", 90),
    (1, "The quick brown fox jumps over the lazy dog.\nIt was a fine day. Nothing else happened!", "en", "a", 90),  # repeated row
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (4, " \t\n ", "fr", None, 4),
    (None, "A text without an id, password=abcdef0123456789xyz here.", "en", "a", 50),
    (5, LONG, "en", "b", len(LONG)),
    (6, "çà et là, où l'été s'achève — naïveté.", "fr", "", 40),
    (7, "The quick brown fox jumps over the lazy dog.\nIt was a fine day. Nothing else happened!", "en", None, 90),  # tie
    (8, "x", "de", "c", 1),
]


def awkward(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows and clashing extra columns."""
    names = [c.split()[0] for c in CLASH.split(", ")]
    return spark.createDataFrame([(*r, *[None] * len(names)) for r in ROWS], f"{DOCS}, {CLASH}").repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
