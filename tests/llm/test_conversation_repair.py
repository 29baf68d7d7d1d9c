import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from shelfcast.llm import conversation_repair as c

BLANK, LAST = r"[^\x20\x09-\x0D]", r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]*\Z)"


def as_damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(turns):
    """(cost, audit, lines) by the best way to every state after each turn, inserts one at a time."""
    grammar = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    name = {"u": "user", "a": "assistant"}

    def inserts(best):
        for _ in range(4):
            for state, (cost, audit, lines) in list(best.items()):
                for letter in "ua":
                    if letter in grammar[state]:
                        way = (cost + 3, audit + "I", [*lines, name[letter] + ":"])
                        target = grammar[state][letter]
                        best[target] = min(best.get(target, way), way, key=lambda w: w[:2])
        return best

    # Ways of one length in letters of turns are compared before inserts are added, as strings.
    best = {0: (0, "", [])}
    for role, text, fault in turns:
        after = {}
        for state, (cost, audit, lines) in inserts(best).items():
            ways = [(state, 4, "D", [])]
            if fault not in ("blank", "duplicate"):
                late = 3 if fault == "truncated" else 0
                if role[:1] in grammar[state]:
                    ways.append((grammar[state][role[:1]], late, "K", [f"{role}:{text}"]))
                for letter in "ua":
                    if letter in grammar[state]:
                        ways.append((grammar[state][letter], 3 + late, "R", [f"{name[letter]}:{text}"]))
            for target, price, letter, line in ways:
                way = (cost + price, audit + letter, [*lines, *line])
                after[target] = min(after.get(target, way), way, key=lambda w: w[:2])
        best = after
    return min((w for s, w in inserts(best).items() if s in (0, 3)), key=lambda w: w[:2])


def exhaustive(turns, most):
    """The same from all edits of up to `most` letters."""
    best = None
    for n in range(most + 1):
        for audit in product("DIKR", repeat=n):
            if sum(x != "I" for x in audit) != len(turns):
                continue
            for roles in product("ua", repeat=sum(x in "IR" for x in audit)):
                cost, out, left, new = 0, "", iter(turns), iter(roles)
                for x in audit:
                    role, _, fault = next(left) if x != "I" else ("", "", "")
                    if x in "KR" and fault in ("blank", "duplicate"):
                        break
                    cost += {"K": 0, "R": 3, "D": 4, "I": 3}[x] + (3 if x in "KR" and fault == "truncated" else 0)
                    out += role[:1] if x == "K" else "" if x == "D" else next(new)
                else:
                    if re.fullmatch("(s?(ua)+)?", out):
                        way = (cost, "".join(audit))
                        best = way if best is None else min(best, way)
    return best


def expected(rows):
    kept, out = as_damaged(rows), []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in kept if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        seen, turns = set(), []
        for _, _, role, text in own:
            last = re.search(LAST, text)
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "" if last[0] in ".!?" else "truncated"
            seen.add((role, text))
            turns.append((role, text, fault))
        numbers = [t for _, t, *_ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        faults = [sum(t[2] == f for t in turns) for f in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        cost, audit, lines = cheapest(turns)
        out.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, count, longest=9):
    rng = random.Random(seed)
    rows = []
    for conv in range(count):
        turn = rng.randrange(3)
        for k in range(rng.randrange(1, longest)):
            role = rng.choice(["system", "user", "assistant", "tool"]) if rng.random() < 0.3 else ("user", "assistant")[k % 2]
            text = rng.choice(["", " \n", "Yes.", "No! ", "So", "Well?\n", f"Say {rng.randrange(9)}.", "cut off, "])
            rows.append((conv, turn, role, text))
            turn += rng.choice([1, 1, 1, 2, 5])
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_brute_force_is_exhaustive():
    rng = random.Random(1)
    for _ in range(60):
        turns = [(rng.choice(["system", "user", "assistant", "tool"]), "x", rng.choice(["", "", "truncated", "blank"])) for _ in range(rng.randrange(4))]
        assert exhaustive(turns, len(turns) + 3) == cheapest(turns)[:2], turns


def test_any_grammar_gives_the_same_edits():
    rng = random.Random(2)
    for _ in range(300):
        symbols = [rng.randrange(c.SYMBOLS) for _ in range(rng.randrange(1, 40))]
        rules = []
        for _ in range(rng.randrange(8)):
            rules.append((rng.randrange(c.SYMBOLS + len(rules)), rng.randrange(c.SYMBOLS + len(rules))))
        plain, grammar = c.Grammar([]), c.Grammar(rules)
        short = tuple(x for x in c.compressed([bytes(symbols)], rules)[0].tolist() if x >= 0)
        a, b = plain.over(tuple(symbols))[0], grammar.over(short)[0]
        assert a.cost == b.cost
        for i, j in product(range(c.STATES), repeat=2):
            if a.cost[i][j] < c.NEVER:
                assert plain.path(tuple(symbols), i, j) == grammar.path(short, i, j)


def test_against_brute_force(spark):
    rows = conversations(3, 150) + [(1000 + r[0], *r[1:]) for r in conversations(4, 3, 400)]
    rows += [(2000, t, r, "Hm." if t % 7 else "") for t in range(300) for r in ["user", "assistant"][: 1 + t % 2]]
    rows += [(None, 1, "user", "Null."), (None, None, None, None), (3000, None, "user", None), (3001, None, None, "Hi."), (3001, 4, "", "x")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], f"{SCHEMA}, place int, uid string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)  # long conversations in many pieces
    try:
        out = sorted((tuple(r) for r in c.damaged_and_repaired(docs.repartition(5)).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert out == expected(rows)


@pytest.mark.parametrize("rows", [[], [(5, 1, "user", "Same.")] * 3 + [(5, 1, "assistant", "Same.")] * 2])
def test_odd_tables(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted((tuple(r) for r in c.damaged_and_repaired(docs).collect()), key=str) == (expected(rows) if rows else [])


def test_turns_are_in_the_grammar(spark):
    rows = conversations(6, 80)
    found = c.repair_conversations(spark.createDataFrame(rows, SCHEMA)).turns.collect()
    by_conv = {}
    for r in sorted(found, key=lambda r: (r.conv_id, r.place, r.nth)):
        by_conv[r.conv_id] = by_conv.get(r.conv_id, "") + r.role[0]
    assert by_conv and all(re.fullmatch("s?(ua)+", x) for x in by_conv.values())
