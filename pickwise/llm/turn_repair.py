"""Conversation structure repair: cheapest edits that give every conversation the form `(s?(ua)+)?`.

Rows (conv_id, turn, role, text) of a conversation are taken by turn, NULL turns
first, then by role and by the text's MD5.  A row's first fault counts: blank (no
character outside 0x20, 0x09 to 0x0D), duplicate (role and text seen earlier),
truncated (last such character is none of `.!?`).  Edits and costs: Keep 0, Rerole to
user or assistant 1, Delete 2 (the only edit of blank and duplicate rows), Insert an
empty user or assistant turn 5; a truncated row that is not deleted adds 5.  The
initials of the roles that are left must read `(s?(ua)+)?`; of the cheapest edits
those whose initials are ASCII-least are taken.

Method.  Depth-first branch-and-bound over (row, grammar state) with an explicit
stack, suffix lower bounds, the incumbent (cost, audit) and one dominance table a
node: a prefix that is not below the best (cost, audit) known at its node cannot
lead to a better whole, because two prefixes of one node never continue each other
with equal cost.  No conversation has to fit one task: slim rows (no texts) lie in
range partitions in conversation order, a task solves each conversation that lies
wholly inside it at once, and cuts all others into pieces of at most ``PIECE`` rows.
A piece is solved from every grammar state to every other; the pieces' costs and
audit orders (36 numbers each) are chained per conversation, and only the chosen
audits go on.  Texts are joined to the rows that stay.

Defined results.  NULL role or text: one space.  NULL conv_id: a conversation like
any other.  Rows equal in all four columns are one row with copies; the copies are
duplicates (or blank).  Roles count by their first code point, so unknown or empty
roles fit nowhere unless reroled.  Conversations without rows: zeros, empty audit.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import persisted, slices

WHITE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
PIECE = 512  # rows of a conversation that branch-and-bound takes at once
# States of `(s?(ua)+)?`: nothing yet, after s, after u, after a.  The first and the last may end.
STATES, ENDS = 4, (0, 3)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}  # what a rerole or an insert can become
ROLE = {"u": "user", "a": "assistant"}
DROP, TRUNCATED, SOUND = "x", "t", "."

ROWS = "array<struct<key:binary,initial:string,kind:string,n:bigint>>"
# A piece is placed by the first of its rows.
PLACE = ["conv_id", "at_turn", "at_role", "at_md5"]
PLACED = "conv_id bigint, at_turn bigint, at_role string, at_md5 string"
PIECES = f"{PLACED}, seg string, whole boolean, first string, last string, illegal bigint, cost bigint, items {ROWS}, costs binary, ranks binary, audits array<string>"
EDITS = f"{PLACED}, idx bigint, edit string, new_role string, key binary"


def damage(turns: DataFrame) -> DataFrame:
    """The rows with planted faults by crc32(`conv_id:turn`) % 20: 0 drops the row, 1
    empties its text, 2 removes `.!?`, 3 repeats the row (``copies`` 2), 4 makes it a user row."""
    one = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("bigint").cast("string"), one), F.lit(":"), F.coalesce(F.col("turn").cast("bigint").cast("string"), one))
    t = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), one).alias("role"), F.coalesce(F.col("text").cast("string"), one).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return t.filter("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("fault") == 3, 2).otherwise(1).alias("copies"))


def keyed(rows: DataFrame) -> DataFrame:
    """Rows with the MD5 of their text and a 128-bit key of all four columns, never NULL."""
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    t = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), copies.cast("bigint").alias("copies"))
    t = t.withColumn("md5", F.md5("text"))
    return t.withColumn("key", digest("conv_id", "turn", "md5", "role"))


def digest(*columns: str) -> Column:
    """MD5 of the values in a form in which no two different tuples agree (the last may hold any text)."""
    return F.unhex(F.md5(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])))


def slim_rows(rows: DataFrame) -> DataFrame:
    """A row for each different (conv_id, turn, role, text), without the text: number of
    copies, role initial, blank and truncated, and whether role and text came earlier."""
    body = F.rtrim("text", F.lit(WHITE))
    facts = keyed(rows).select("key", "conv_id", "turn", "role", "md5", "copies", (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("open"))
    one = lambda c: F.first(c).alias(c)
    facts = persisted(facts.groupBy("key").agg(*[one(c) for c in ("conv_id", "turn", "role", "md5", "blank", "open")], F.sum("copies").alias("n")).withColumn("said", digest("conv_id", "md5", "role")))
    # only (role, text) that stand at several turns need their first turn
    first = persisted(facts.groupBy("said").agg(F.min(F.struct("turn")).alias("at"), F.count("*").alias("turns")).filter("turns > 1"))
    again = F.coalesce(~F.col("at.turn").eqNullSafe(F.col("turn")) & F.col("at").isNotNull(), F.lit(False))
    rows = facts.join(first.select("said", "at"), "said", "left").withColumn("again", again)
    kind = F.when(F.col("blank") | F.col("again"), DROP).when(F.col("open"), TRUNCATED).otherwise(SOUND)
    initial = F.substring("role", 1, 1)
    return persisted(rows.select("key", "conv_id", "turn", "role", "md5", "n", "blank", kind.alias("kind"), initial.alias("initial")))


@dataclass
class Found:
    cost: int
    audit: str


def ways(item: tuple[str, str, int], state: int) -> list[tuple[int, str, int]]:
    """(cost, letters, next state) of the edits of one row and of its copies."""
    initial, kind, n = item
    more, gone = "D" * (n - 1), DELETE * (n - 1)
    out = [(DELETE + gone, "D" + more, state)]
    if kind != DROP:
        fault = CUT_OFF if kind == TRUNCATED else 0
        out.append((REROLE + fault + gone, "R" + more, NEXT[state][1]))
        if (state, initial) in STEP:
            out.append((KEEP + fault + gone, "K" + more, STEP[state, initial]))
    return out


def bounds(items: list[tuple[str, str, int]], goal: int | None) -> list[list[float]]:
    """For every row and state a lower bound of what the rows from there on cost: their
    cheapest edits, whatever the audit."""
    last = [0 if q == goal or (goal is None and q in ENDS) else math.inf for q in range(STATES)]
    lower = []
    for i in range(len(items), -1, -1):
        here = last if i == len(items) else [min(c + lower[-1][to] for c, _, to in ways(items[i], q)) for q in range(STATES)]
        if i < len(items) or goal is None:
            for _ in range(STATES):
                here = [min(here[q], INSERT + here[NEXT[q][1]]) for q in range(STATES)]
        lower.append(here)
    return lower[::-1]


def search(items: list[tuple[str, str, int]], entry: int, goal: int | None) -> Found | None:
    """Cheapest edits of ``items`` (initial, kind, copies) from grammar state ``entry`` to
    ``goal``, or to the end of the conversation where ``goal`` is None (only there edits
    may end with inserts).  Depth-first, until every open prefix is cut off."""
    lower = bounds(items, goal)
    best: Found | None = None
    known: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")] if lower[0][entry] < math.inf else []
    while stack:
        i, state, cost, audit = stack.pop()
        if best is not None and (cost + lower[i][state], audit) > (best.cost, best.audit[: len(audit)]):
            continue
        seen = known.get((i, state))
        if seen is not None and seen <= (cost, audit):
            continue
        known[i, state] = (cost, audit)
        if i == len(items) and (state == goal or (goal is None and state in ENDS)):
            if best is None or (cost, audit) < (best.cost, best.audit):
                best = Found(cost, audit)
        edits = [] if i == len(items) else [(cost + c + lower[i + 1][to], letters, i + 1, to, cost + c) for c, letters, to in ways(items[i], state)]
        if i < len(items) or goal is None:
            to = NEXT[state][1]
            edits.append((cost + INSERT + lower[i][to], "I", i, to, cost + INSERT))
        # the last pushed is tried first: least bound, then ASCII-least letter
        for bound, letters, at, to, total in sorted(edits, reverse=True):
            if bound < math.inf:
                stack.append((at, to, total, audit + letters))
    return best


def solved(items: list[tuple[str, str, int]]) -> tuple[bytes, bytes, list[str]]:
    """A piece from every state: costs and audits to every state, then to the end, and
    for each entry the order of its audits.  Cost -1: no way."""
    costs, audits = np.full((STATES, STATES + 1), -1, np.int64), [""] * (STATES * (STATES + 1))
    ranks = np.zeros((STATES, STATES), np.int8)
    for a in range(STATES):
        for b in range(STATES + 1):
            found = search(items, a, b if b < STATES else None)
            if found is not None:
                costs[a, b], audits[a * (STATES + 1) + b] = found.cost, found.audit
        row = audits[a * (STATES + 1) : a * (STATES + 1) + STATES]
        for rank, b in enumerate(sorted(range(STATES), key=lambda b: row[b])):
            ranks[a, b] = rank
    return costs.tobytes(), ranks.tobytes(), audits


def chained(pieces: list[tuple[bytes, bytes]]) -> list[int]:
    """The audit (entry * 5 + exit) that each of a conversation's pieces, in order, takes.
    Prefixes of equal cost differ before their ends, so the order of prefixes decides first."""
    here, back = {0: (0, 0)}, []
    for k, (costs, ranks) in enumerate(pieces):
        cost = np.frombuffer(costs, np.int64).reshape(STATES, STATES + 1)
        rank = np.frombuffer(ranks, np.int8).reshape(STATES, STATES)
        last = k == len(pieces) - 1
        found: dict[int, tuple[int, int, int]] = {}
        for a, (so_far, order) in here.items():
            for b in (STATES,) if last else range(STATES):
                if cost[a, b] >= 0:
                    found[b] = min(found.get(b, (1 << 62, 0, 0)), (so_far + int(cost[a, b]), order, a))
        back.append({b: a for b, (_, _, a) in found.items()})
        if not last:
            order = sorted(found, key=lambda b: (found[b][1], rank[found[b][2], b]))
            here = {b: (found[b][0], order.index(b)) for b in found}
    out, state = [], STATES
    for step in reversed(back):
        out.append(step[state] * (STATES + 1) + state)
        state = step[state]
    return out[::-1]


def pair_fault(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def pieces(slim: DataFrame) -> DataFrame:
    """Every conversation as one solved piece, or as several with their tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), itertools.count()
        item = pa.struct([("key", pa.binary()), ("initial", pa.string()), ("kind", pa.string()), ("n", pa.int64())])
        schema = pa.schema([("conv_id", pa.int64()), ("at_turn", pa.int64()), ("at_role", pa.string()), ("at_md5", pa.string()), ("seg", pa.string()), ("whole", pa.bool_()), ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64()), ("cost", pa.int64()), ("items", pa.list_(item)), ("costs", pa.binary()), ("ranks", pa.binary()), ("audits", pa.list_(pa.string()))])

        def piece(rows: list[dict], whole: bool) -> dict:
            items = [(r["initial"], r["kind"], r["n"]) for r in rows]
            same = sum((n - 1) * pair_fault(c, c) for c, _, n in items)
            out = dict(zip(PLACE, (rows[0][k] for k in ("conv_id", "turn", "role", "md5")), strict=True))
            out |= {"seg": f"{part}-{next(number)}", "whole": whole, "first": items[0][0], "last": items[-1][0], "illegal": same + sum(pair_fault(a[0], b[0]) for a, b in itertools.pairwise(items))}
            out["items"] = [{k: r[k] for k in ("key", "initial", "kind", "n")} for r in rows]
            if whole:
                found = search(items, 0, None)
                return out | {"cost": found.cost, "costs": None, "ranks": None, "audits": [found.audit]}
            costs, ranks, audits = solved(items)
            return out | {"cost": None, "costs": costs, "ranks": ranks, "audits": audits}

        def cut() -> Iterator[dict]:
            held: list[dict] = []
            inside = False  # the conversation surely began in this task, and none of it was given out
            for batch in batches:
                for at in range(0, batch.num_rows, 4096):
                    for r in batch.slice(at, 4096).to_pylist():
                        if held and held[0]["conv_id"] != r["conv_id"]:
                            yield piece(held, inside)
                            held, inside = [], True
                        if len(held) == PIECE:
                            yield piece(held, False)
                            held, inside = [], False
                        held.append(r)
            if held:
                yield piece(held, False)

        found = cut()
        while some := list(itertools.islice(found, 512)):
            yield pa.RecordBatch.from_pylist(some, schema)

    order = ["conv_id", "turn", "role", "md5"]
    return persisted(slim.select(*order, "key", "initial", "kind", "n").repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, PIECES))


def choices(found: DataFrame) -> DataFrame:
    """(seg, choice, paid, border) of the pieces of conversations that lie in several: the
    audit to take, its cost, and whether the roles at the border to the piece before are
    illegal neighbours."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        places = list(zip(group["at_turn"], group["at_role"], group["at_md5"], strict=True))
        order = sorted(range(len(places)), key=lambda i: (places[i][0] is not None, places[i][0] or 0, *places[i][1:]))
        group = group.iloc[order]
        taken = chained(list(zip(group["costs"], group["ranks"], strict=True)))
        paid = [int(np.frombuffer(c, np.int64)[t]) for c, t in zip(group["costs"], taken, strict=True)]
        border = [0] + [int(pair_fault(a, b)) for a, b in zip(group["last"].iloc[:-1], group["first"].iloc[1:], strict=True)]
        return pd.DataFrame({"seg": group["seg"].to_numpy(), "choice": taken, "paid": paid, "border": border})

    parts = found.filter("NOT whole").select(*PLACE, "seg", "first", "last", "costs", "ranks")
    # as a decimal, a turn reaches pandas as it is also where others are NULL
    parts = parts.withColumn("at_turn", F.col("at_turn").cast("decimal(20,0)"))
    return parts.groupBy("conv_id").applyInPandas(run, "seg string, choice int, paid bigint, border bigint")


@dataclass
class Repair:
    """``report``: a row a conversation (conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit); ``edits``: every edit in order, with the key of its row; ``rows``: the input."""

    report: DataFrame
    edits: DataFrame
    rows: DataFrame

    def repaired(self) -> DataFrame:
        """The repaired rows (conv_id, at_turn, at_role, at_md5, idx, edit, role, text); the
        columns conv_id to idx put them in order."""
        words = keyed(self.rows).select("key", "role", "text").dropDuplicates(["key"])
        left = self.edits.filter("edit IN ('K', 'R')").join(words, "key")
        left = left.select(*PLACE, "idx", "edit", F.coalesce("new_role", "role").alias("role"), "text")
        new = self.edits.filter("edit = 'I'").select(*PLACE, "idx", "edit", F.col("new_role").alias("role"), F.lit("").alias("text"))
        return left.unionByName(new)


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> Repair:
    """Faults, cheapest edits and repaired rows of (conv_id, turn, role, text) rows, with
    copies in an optional column ``copies``.  ``conversations`` (conv_id) lists those to
    report even if they have no rows."""
    slim = slim_rows(rows)
    found = pieces(slim)
    done = found.join(choices(found), "seg", "left")
    choice = F.coalesce("choice", F.lit(0))
    illegal = F.col("illegal") + F.coalesce("border", F.lit(0))
    done = persisted(done.select(*PLACE, illegal.alias("illegal"), F.coalesce("paid", "cost").alias("cost"), F.get("audits", choice).alias("audit"), (choice / (STATES + 1)).cast("int").alias("entry"), "items"))
    return Repair(report(slim, done, conversations), persisted(edits(done)), rows)


def edits(done: DataFrame) -> DataFrame:
    """The audits letter by letter, with the rows they stand for and the roles they make."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*PLACE, "idx", "edit", "new_role", "key"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        out: list[tuple] = []
        for batch in batches:
            for at in range(batch.num_rows):
                (r,) = batch.slice(at, 1).to_pylist()
                place, state, i, copies = [r[k] for k in PLACE], r["entry"], 0, 0
                for idx, letter in enumerate(r["audit"]):
                    item = r["items"][i] if letter != "I" else None
                    role = None
                    if letter == "K":
                        state = STEP[state, item["initial"]]
                    elif letter in "RI":
                        role, state = ROLE[NEXT[state][0]], NEXT[state][1]
                    out.append((*place, idx, letter, role, item and item["key"]))
                    if item:
                        copies += 1
                        if copies == item["n"]:
                            i, copies = i + 1, 0
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return done.select(*PLACE, "entry", "audit", "items").mapInArrow(run, EDITS)


def report(slim: DataFrame, done: DataFrame, conversations: DataFrame | None) -> DataFrame:
    """One row a conversation, from parts that are summed by one aggregate."""
    none = F.lit(None)
    part = F.struct(*[F.col(c) for c in PLACE[1:]], "audit")
    columns = {"gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint", "illegal": "bigint", "cost": "bigint", "part": "struct<at_turn:bigint,at_role:string,at_md5:string,audit:string>"}
    shaped = lambda df, **given: df.select("conv_id", *[given.get(c, none).cast(t).alias(c) for c, t in columns.items()])
    later = F.when(F.col("blank"), 0).when(F.col("kind") == DROP, F.col("n")).otherwise(F.col("n") - 1)
    faults = shaped(slim, blank=F.when(F.col("blank"), F.col("n")), duplicate=later, truncated=(F.col("kind") == TRUNCATED).cast("int"))
    turns = slim.filter("turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.lit(1).alias("_"))
    turns = turns.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gap"))
    parts = faults.unionByName(shaped(turns, gaps=F.col("gap"))).unionByName(shaped(done, illegal=F.col("illegal"), cost=F.col("cost"), part=part))
    if conversations is not None:
        parts = parts.unionByName(shaped(conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"))))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns if c != "part"]
    audit = F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda p: p["audit"]), "")
    return parts.groupBy("conv_id").agg(*sums, audit.alias("audit"))


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the repaired `role:text` lines.  A digest has to read its
    conversation in order: the rows come sorted and stream through, none is held."""
    order = [*PLACE, "idx"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = lambda conv, sha: pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([sha.hexdigest()])], ["conv_id", "repaired_sha256"])
        conv, sha = None, None
        for b in slices(batches, "line"):
            for c, line in zip(b.column("conv_id").to_pylist(), b.column("line").to_pylist(), strict=True):
                if sha is not None and c == conv:
                    sha.update(b"\n")
                else:
                    if sha is not None:
                        yield made(conv, sha)
                    conv, sha = c, hashlib.sha256()
                sha.update(line.encode())
        if sha is not None:
            yield made(conv, sha)

    lines = repaired.select(*order, F.concat("role", F.lit(":"), "text").alias("line"))
    rows = lines.repartition("conv_id").sortWithinPartitions(*order)
    return rows.select("conv_id", "line").mapInArrow(run, "conv_id bigint, repaired_sha256 string")


def digest_report(fixed: Repair) -> DataFrame:
    """The report with the digest of each repaired conversation."""
    made = repaired_digests(fixed.repaired()).withColumnRenamed("conv_id", "_conv")
    whole = fixed.report.join(made, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    return whole.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)))
