import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from pickwise.llm import turn_repair as R

TURNS = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def cheapest(items):
    """All edits by a plain dynamic program over whole audits: (cost, audit, roles)."""
    def after(state, c):
        return {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, c))

    ways = {0: (0, "", ())}

    def with_inserts(ways):
        for _ in range(3):
            for q, (cost, audit, made) in list(ways.items()):
                for c in "ua":
                    if (to := after(q, c)) is not None:
                        new = (cost + 5, audit + "I", (*made, (c, None)))
                        if to not in ways or new < ways[to]:
                            ways[to] = new
        return ways

    for i, (c, fault) in enumerate(items):
        nxt = {}
        for q, (cost, audit, made) in with_inserts(dict(ways)).items():
            tries = [(q, (cost + 2, audit + "D", made))]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                tries += [(after(q, x), (cost + 1 + extra, audit + "R", (*made, (x, i)))) for x in "ua"]
                tries += [(after(q, c), (cost + extra, audit + "K", (*made, (None, i))))]
            for to, new in tries:
                if to is not None and (to not in nxt or new[:2] < nxt[to][:2]):
                    nxt[to] = new
        ways = nxt
    ends = [w for q, w in with_inserts(dict(ways)).items() if q in (0, 3)]
    return min(ends, key=lambda w: w[:2])


def brute(rows, conversations):
    """The report by plain code; rows are (conv, turn, role, text), copies written out."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv in conversations:
        turns = sorted(by[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, items, count = set(), [], dict.fromkeys(("blank", "duplicate", "truncated", "none"), 0)
        for _, role, text in turns:
            body = text.rstrip(WHITE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "none"
            seen.add((role, text))
            count[fault] += 1
            items.append((role[:1], fault))
        known = [t for t, *_ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(items, items[1:], strict=False))
        cost, audit, made = cheapest(items)
        lines = [f"{({'u': 'user', 'a': 'assistant'}[c] if c else turns[i][1])}:{'' if i is None else turns[i][2]}" for c, i in made]
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        n = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if n == 0:
            continue
        text = "" if n == 1 else "".join(c for c in text if c not in ".!?") if n == 2 else text
        out += [(conv, turn, "user" if n == 4 else role, text)] * (2 if n == 3 else 1)
    return out


def found(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[c] for c in names) for r in df.collect()}


def made_up(seed, conversations, most, ties=True):
    rnd = random.Random(seed)
    rows = []
    for conv in conversations:
        for turn in range(rnd.randint(1, most)):
            role = rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rnd.choice(["Yes.", "Yes.", "No!", "cut off", " \t\n", "", None, f"Number {turn}?", "é　", "Fine. \n"])
            rows.append((conv, rnd.choice([turn, turn, turn + 1, None]) if ties else turn, role, text))
    return rows


@pytest.mark.parametrize("piece", [512, 3])
def test_made_up_conversations_against_plain_code(spark, monkeypatch, piece):
    monkeypatch.setattr(R, "PIECE", piece)
    rows = made_up(piece, [None, *range(60)], 14)
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    assert found(R.digest_report(R.repair(turns, turns))) == brute(rows, {r[0] for r in rows})


def test_query_form_with_planted_damage(spark):
    rows = [r for r in made_up(5, [None, *range(80)], 7, ties=False)] + [(7000 + i, None, "user", "Alone.") for i in range(40)]
    turns = spark.createDataFrame(rows, TURNS)
    want = brute(damaged(rows), {r[0] for r in rows})
    assert any(w[:7] == (0, 0, 0, 0, 0, 0, "") for w in want.values())  # conversations whose rows are all dropped
    assert found(R.digest_report(R.repair(R.damage(turns), turns))) == want


def test_one_long_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(R, "PIECE", 40)
    rnd = random.Random(2)
    rows = [(1, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["Yes.", f"n{t}", f"n{t}.", f"m{t}.", " "])) for t in range(1500)]
    rows += [(2, 0, "user", "Same words.")] * 900 + [(2, 1, "assistant", "Answer.")]
    turns = spark.createDataFrame(rows, TURNS).repartition(9)
    want = brute(rows, {1, 2})
    got = found(R.digest_report(R.repair(turns)))
    assert got == want and got[2][6] == "K" + "D" * 899 + "K"


def test_branch_and_bound_pieces_and_bounds():
    rnd = random.Random(4)
    for _ in range(300):
        items = [(rnd.choice("suaau?"), rnd.choice("x.t.."), rnd.choice([1, 1, 1, 3])) for _ in range(rnd.randint(1, 14))]
        flat = [(c, f) for c, k, n in items for f in [{"x": "blank", "t": "truncated", ".": "none"}[k], *["blank"] * (n - 1)]]
        whole = R.search(items, 0, None)
        assert (whole.cost, whole.audit) == cheapest(flat)[:2]
        cut = rnd.randint(1, 5)
        parts = [R.solved(items[i : i + cut]) for i in range(0, len(items), cut)]
        taken = R.chained([p[:2] for p in parts])
        assert "".join(p[2][t] for p, t in zip(parts, taken, strict=True)) == whole.audit
        assert R.bounds(items, None)[0][0] <= whole.cost


def test_rows_edits_and_awkward_tables(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Why?"), (1, 1, "user", "Why?"), (1, 2, "assistant", "Because.")]
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{TURNS}, seg long, audit string")
    fixed = R.repair(turns)
    lines = [(r.edit, r.role, r.text) for r in fixed.repaired().orderBy(*R.PLACE, "idx").collect()]
    assert lines == [("K", "user", "Why?"), ("K", "assistant", "Because.")] and fixed.report.first().audit == "DKDK"
    assert {e.edit for e in fixed.edits.collect()} == {"D", "K"}
    none = spark.createDataFrame([], TURNS)
    assert R.digest_report(R.repair(none, none)).count() == 0
    long = "word " * 300_000 + "end."
    one = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long), (2, None, None, None), (2, None, None, None)], TURNS)
    assert found(R.digest_report(R.repair(one))) == brute([tuple(r) for r in one.collect()], {1, 2})
