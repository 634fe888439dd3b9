"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut at line feeds and sentence ends, and a longer stretch after every
``PIECE_MOST`` code points; each distinct piece has a 64-bit digest.  The fingerprint
is a sketch of these digests, dealt by digest to shards of about ``LOAD`` (their number
is a power of four that follows from the number of digests).  A shard enters a digest
into one cell of each of three subtables; a cell holds a count and the XORs of its
digests and of their check hashes.  A shard whose digests cannot be peeled from its
cells is made again with wider subtables and other hashes, and in the last resort keeps
a cell a digest.  So every fingerprint can be decoded to its digests.

Two fingerprints are compared shard by shard: cells are subtracted, and peeling recovers
the digests that differ (a cell with count +1 or -1 whose check fits holds one digest,
which is taken out of its three cells, until all cells are zero).  Where a difference is
too full to peel, or the two texts have shards of other numbers or widths, the larger
structure answers: the digests to which each side's own cells decode.  The likeness is
the share of digests that do not differ (Dice similarity of the sets); it follows from
the two fingerprint strings alone.

Everything is DataFrame expressions.  The successor of a document is found without
a global sort: rows are dealt to id ranges of about ``BUCKET`` rows, the first row
of each range also ends the range before it, and a window works inside the ranges.

Defined results: a NULL text counts as empty; an empty text has no pieces, and two
texts without pieces are alike (1.0); a NULL doc_id comes after all others; of equal
ids the order is that of a text hash; a lone document succeeds itself; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import persisted

PIECE_END = r"[\n.!?]+"
PIECE_MOST = 192
LOAD = 4  # digests of a shard, on average at most
WIDTHS = (4, 12, 36, 108)  # cells of a subtable, by attempt; 0: a cell a digest
FULL = 9  # a difference with more cells in use is not tried
BUCKET = 2000  # rows of an id range, more if there would be over MOST_RANGES
MOST_RANGES = 20_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), body)[0]


def digests(text: Column) -> Column:
    """Distinct digests of the pieces of a text."""
    parts = F.filter(F.transform(F.split(text, PIECE_END), lambda x: F.trim(x)), lambda x: x != "")
    cut = lambda x: F.transform(F.sequence(F.lit(0), F.char_length(x) - 1, F.lit(PIECE_MOST)), lambda i: F.substring(x, i + 1, F.lit(PIECE_MOST)))
    pieces = F.flatten(F.transform(parts, lambda x: F.when(F.char_length(x) <= PIECE_MOST, F.array(x)).otherwise(cut(x))))
    return F.array_distinct(F.transform(pieces, lambda x: F.xxhash64(x)))


def check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(-1))


def cells_of(digest: Column, width: Column) -> Column:
    """The digest's cell in each subtable; each width hashes anew."""
    place = lambda x, t: F.pmod(F.shiftright(x, 20 * t), width.cast("bigint")).cast("int") + t * width
    return let(F.xxhash64(digest, width), lambda x: F.struct(*[place(x, t).alias(f"c{t}") for t in range(3)]))


def items(found: Column, width: int) -> Column:
    """Digests as (count, digest, check, cells) entries."""
    return F.transform(found, lambda d: F.struct(F.lit(1).alias("n"), d.alias("d"), check(d).alias("h"), cells_of(d, F.lit(width)).alias("c")))


def sketch(entries: Column, width: int) -> Column:
    """The cells of the three subtables: count, XOR of digests, XOR of checks."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("d"), F.lit(0).cast("bigint").alias("h"))
    add = lambda acc, e: F.struct((acc["n"] + e["n"]).alias("n"), acc["d"].bitwiseXOR(e["d"]).alias("d"), acc["h"].bitwiseXOR(e["h"]).alias("h"))
    one = lambda t: lambda i: F.aggregate(F.filter(entries, lambda e: e["c"][f"c{t}"] == i), zero, add)
    return F.concat(*[F.transform(F.sequence(F.lit(t * width), F.lit(t * width + width - 1)), one(t)) for t in range(3)])


def empty(cells: Column) -> Column:
    return F.forall(cells, lambda x: (x["n"] == 0) & (x["d"] == 0) & (x["h"] == 0))


def peeled(cells: Column, most: Column, width: Column, keep: bool = False) -> Column:
    """(ours, theirs): how many digests are recovered on each side, or with ``keep`` the
    digests themselves; NULL if cells remain."""
    none = F.array().cast("array<bigint>") if keep else F.lit(0)

    def more(old: Column, p: Column, hit: Column) -> Column:
        return F.concat(old, F.filter(F.array(p["d"]), lambda _: hit)) if keep else old + hit.cast("int")

    def step(state: Column, _: Column) -> Column:
        pure = F.filter(state["cells"], lambda x: (F.abs(x["n"]) == 1) & (check(x["d"]) == x["h"]))

        def out(p: Column) -> Column:
            hit = lambda i: (i == p["c"]["c0"]) | (i == p["c"]["c1"]) | (i == p["c"]["c2"])
            less = lambda x: F.struct((x["n"] - p["n"]).alias("n"), x["d"].bitwiseXOR(p["d"]).alias("d"), x["h"].bitwiseXOR(p["h"]).alias("h"))
            return F.struct(F.transform(state["cells"], lambda x, i: F.when(hit(i), less(x)).otherwise(x)).alias("cells"), more(state["ours"], p, p["n"] > 0).alias("ours"), more(state["theirs"], p, p["n"] < 0).alias("theirs"))

        placed = lambda p: F.struct(p["n"].alias("n"), p["d"].alias("d"), p["h"].alias("h"), cells_of(p["d"], width).alias("c"))
        return let(pure, lambda p: F.when(F.size(p) == 0, state).otherwise(let(placed(F.get(p, F.lit(0))), out)))

    start = F.struct(cells.alias("cells"), none.alias("ours"), none.alias("theirs"))
    steps = F.when(empty(cells) | (most < 1), F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.greatest(most, F.lit(1))))
    end = F.aggregate(steps, start, step)
    return let(end, lambda e: F.when(empty(e["cells"]), F.struct(e["ours"].alias("ours"), e["theirs"].alias("theirs"))))


def shard(found: Column) -> Column:
    """(width, cells, digests): the narrowest sketch of a shard from which its digests peel."""

    def attempt(width: int) -> Column:
        def tried(entries: Column) -> Column:
            # digests that share no cell of a subtable peel at once
            apart = lambda t: F.size(F.array_distinct(F.transform(entries, lambda e: e["c"][f"c{t}"]))) == F.size(entries)
            peels = lambda cells: apart(0) | apart(1) | apart(2) | peeled(cells, F.size(found), F.lit(width)).isNotNull()
            return let(sketch(entries, width), lambda cells: F.when(peels(cells), F.struct(F.lit(width).alias("width"), cells.alias("cells"), found.alias("digests"))))

        return let(items(found, width), tried)

    plain = F.transform(F.array_sort(found), lambda d: F.struct(F.lit(1).alias("n"), d.alias("d"), check(d).alias("h")))
    return F.coalesce(*[attempt(w) for w in WIDTHS], F.struct(F.lit(0).alias("width"), plain.alias("cells"), found.alias("digests")))


def sides(found: Column) -> Column:
    """Root of the number of shards: a power of two."""
    return F.pow(F.lit(2), F.ceil(F.greatest(F.lit(0.0), F.log2(F.size(found) / float(LOAD))) / 2)).cast("int")


def sketched(found: Column) -> Column:
    """(digests, side, shards) of a text.  Shards lie in ``side`` blocks of ``side``, so that
    dealing a long text's digests costs their number times that root."""

    def block(side: Column) -> Callable[[Column], Column]:
        inner = lambda mine: lambda s: let(F.filter(mine, lambda d: F.pmod(F.shiftright(d, 20), side) == s), shard)
        return lambda b: let(F.filter(found, lambda d: F.pmod(d, side) == b), lambda mine: F.transform(F.sequence(F.lit(0), side - 1), inner(mine)))

    shards = lambda side: F.flatten(F.transform(F.sequence(F.lit(0), side - 1), block(side)))
    return let(sides(found), lambda side: F.struct(found.alias("digests"), side.alias("side"), shards(side).alias("shards")))


def apart_in(ours: Column, theirs: Column, keep: bool) -> Column:
    """(ours, theirs): digests of one set only, of two decoded sides."""
    only = lambda a, b: F.array_except(a, b) if keep else F.size(F.array_except(a, b))
    return F.struct(only(ours, theirs).alias("ours"), only(theirs, ours).alias("theirs"))


def shard_difference(ours: Column, theirs: Column, keep: bool = False) -> Column:
    """(ours, theirs) of one shard: the subtracted cells peeled, or both sides decoded."""
    decoded = apart_in(ours["digests"], theirs["digests"], keep)
    minus = lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["d"].bitwiseXOR(y["d"]).alias("d"), x["h"].bitwiseXOR(y["h"]).alias("h"))
    none = F.array().cast("array<bigint>") if keep else F.lit(0)
    same = F.struct(none.alias("ours"), none.alias("theirs"))
    used = lambda cells: F.size(F.filter(cells, lambda x: (x["n"] != 0) | (x["d"] != 0) | (x["h"] != 0)))
    peel = lambda cells: F.coalesce(peeled(cells, F.size(ours["digests"]) + F.size(theirs["digests"]), ours["width"], keep), decoded)
    tried = lambda cells: let(used(cells), lambda k: F.when(k == 0, same).when(k > FULL, decoded).otherwise(peel(cells)))
    fits = (ours["width"] == theirs["width"]) & (ours["width"] > 0)
    return F.when(~fits, decoded).otherwise(let(F.zip_with(ours["cells"], theirs["cells"], minus), tried))


def difference(ours: Column, theirs: Column, keep: bool = False) -> Column:
    """(ours, theirs): numbers of digests only in one of two sketched texts; with ``keep``
    the digests."""
    pairs = F.zip_with(ours["shards"], theirs["shards"], lambda x, y: shard_difference(x, y, keep))
    if keep:
        side_of = lambda shards, name: F.flatten(F.transform(shards, lambda x: x[name])).alias(name)
        whole = let(pairs, lambda shards: F.struct(side_of(shards, "ours"), side_of(shards, "theirs")))
    else:
        zero = F.struct(F.lit(0).alias("ours"), F.lit(0).alias("theirs"))
        add = lambda acc, x: F.struct((acc["ours"] + x["ours"]).alias("ours"), (acc["theirs"] + x["theirs"]).alias("theirs"))
        whole = F.aggregate(pairs, zero, add)
    return F.when(ours["side"] == theirs["side"], whole).otherwise(apart_in(ours["digests"], theirs["digests"], keep))


def recovered(ours: Column, theirs: Column) -> Column:
    """(ours, theirs): the digests only in one of two sketched texts."""
    return difference(ours, theirs, keep=True)


def likeness(ours: Column, theirs: Column) -> Column:
    """Share of the digests of two sketched texts that do not differ."""
    total = F.size(ours["digests"]) + F.size(theirs["digests"])
    return let(difference(ours, theirs), lambda d: F.when(total == 0, 1.0).otherwise(1 - (d["ours"] + d["theirs"]) / total))


def fingerprint(made: Column) -> Column:
    """The sketch as text: ``side/shard|shard...``, a shard ``width:cell,cell...``, a cell
    count, digest and check in hex (2, 16 and 16 digits), nothing for an unused cell."""
    part = lambda x, n: F.lpad(F.hex(x), n, "0")
    cell = lambda c: F.when((c["n"] == 0) & (c["d"] == 0) & (c["h"] == 0), "").otherwise(F.concat(part(c["n"], 2), part(c["d"], 16), part(c["h"], 16)))
    one = lambda x: F.concat(x["width"].cast("string"), F.lit(":"), F.array_join(F.transform(x["cells"], cell), ","))
    return F.lower(F.concat(made["side"].cast("string"), F.lit("/"), F.array_join(F.transform(made["shards"], one), "|")))


def cut_points(ids: DataFrame, parts: int) -> list[int]:
    """At most ``parts - 1`` doc_ids that split the rows into ranges of about equal size."""
    if parts < 2:
        return []
    at = [i / parts for i in range(1, parts)]
    return sorted(set(ids.agg(F.percentile_approx("doc_id", at, max(10_000, 50 * parts))).first()[0] or []))


def range_of(doc_id: Column, cuts: list[int]) -> Column:
    """Number of cut points below the id, in two steps of about sqrt(cuts) each."""
    n = len(cuts)
    if not n:
        return F.lit(0)
    step = max(1, int(n**0.5))
    coarse = F.array(*[F.lit(c).cast("bigint") for c in cuts[step - 1 :: step]])
    fine = F.array(*[F.lit(c).cast("bigint") for c in cuts])
    below = lambda cs: F.size(F.filter(cs, lambda c: c < doc_id))
    full = let(below(coarse) * step, lambda k: k + below(F.slice(fine, k + 1, F.lit(step))))
    return F.when(doc_id.isNull(), n).otherwise(full)


def with_next(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, text, made, next_text, next_made); made: the sketched text."""
    from pyspark.sql import Window

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    cuts = cut_points(rows.select("doc_id"), min(MOST_RANGES, -(-rows.count() // bucket)))
    rows = rows.withColumn("part", range_of(F.col("doc_id"), cuts)).withColumn("h", F.xxhash64("text"))
    # first row of each range: its least id (ids only), then that id's least text hash
    least = persisted(rows.groupBy("part").agg(F.min("doc_id").alias("least")))
    order = Window.orderBy("part")  # one row a range
    ahead = least.select("least", F.coalesce(F.lag("part").over(order), F.max("part").over(Window.partitionBy())).alias("part"))
    # one id for each of at most MOST_RANGES ranges: small enough to send to all tasks
    heads = rows.select("doc_id", "text", "h").join(F.broadcast(ahead), F.col("doc_id").eqNullSafe(F.col("least")))
    heads = heads.groupBy("part").agg(F.min(F.struct("h", "text")).alias("x"), F.min("doc_id").alias("doc_id"))
    heads = persisted(heads.select("doc_id", F.col("x.text").alias("text"), "part", F.col("x.h").alias("h")))
    order = ["head", F.col("doc_id").asc_nulls_last(), "h"]
    every = rows.withColumn("head", F.lit(0)).unionByName(heads.withColumn("head", F.lit(1)))
    # sketched after the shuffle that the window needs, so that no sketch is shuffled
    every = every.repartition("part").sortWithinPartitions("part", *order).withColumn("made", let(digests(F.col("text")), sketched))
    inside = Window.partitionBy("part").orderBy(*order)
    every = every.withColumn("next_text", F.lead("text").over(inside)).withColumn("next_made", F.lead("made").over(inside))
    return every.filter("head = 0").drop("head", "part", "h")


def fingerprints(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    rows = with_next(docs, bucket).withColumn("n_chars", F.char_length("text").cast("bigint"))
    cut = F.expr("CAST(n_chars DIV 4 AS INT)")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    rows = rows.withColumn("edited", edited).withColumn("edited_made", let(digests(F.col("edited")), sketched))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        fingerprint(F.col("made")).alias("fingerprint"),
        fingerprint(F.col("edited_made")).alias("edited_fingerprint"),
        likeness(F.col("made"), F.col("edited_made")).alias("near_edited"),
        likeness(F.col("made"), F.col("next_made")).alias("near_next"),
    )
