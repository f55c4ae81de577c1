import hashlib
import itertools
import random
import re
import zlib

import pytest

from gridmart.llm import conversation_repair as cr
from gridmart.llm import queries as Q

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = set(" \t\n\x0b\x0c\r")


def brute(rows):
    """A conversation's report, by its definition: rows are (turn, role, text).

    All edits of all rows and all insertions are tried, cheapest first."""
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        shown = [c for c in text if c not in BLANK]
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen
                      else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    # least cost first, then the least string: breadth by cost over partial edits
    layers, cost = {0: {("", 0, "")}}, 0
    while True:
        done = [e for e in layers.get(cost, ()) if e[1] == len(rows) and re.fullmatch("(s?(ua)+)?", e[2])]
        grown = set(layers.get(cost, ()))
        todo = list(grown)
        while todo:
            edits, i, roles = todo.pop()
            steps = [(cr.INSERT, "I", i, roles + r, "") for r in "ua"]
            if i < len(rows):
                steps.append((3, "D", i + 1, roles, ""))
                if faults[i] not in ("blank", "duplicate"):
                    fee = faults[i] == "truncated"
                    steps.append((fee, "K", i + 1, roles + (initials[i] or "-"), ""))
                    steps += [(2 + fee, "R", i + 1, roles + r, "") for r in "ua"]
            for price, letter, j, to, _ in steps:
                if not re.fullmatch("s?(ua)*u?", to):
                    continue
                new = (edits + letter, j, to)
                if price == 0 and new not in grown:
                    grown.add(new)
                    todo.append(new)
                elif price:
                    layers.setdefault(cost + price, set()).add(new)
        done += [e for e in grown if e[1] == len(rows) and re.fullmatch("(s?(ua)+)?", e[2])]
        if done:
            edits, _, roles = min(done)
            break
        cost += 1
    out, i, at = [], 0, 0
    for letter in edits:
        if letter == "D":
            i += 1
        elif letter == "I":
            out.append(f"{ {'u': 'user', 'a': 'assistant'}[roles[at]] }:")
            at += 1
        else:
            role = rows[i][1] if letter == "K" else {"u": "user", "a": "assistant"}[roles[at]]
            out.append(f"{role}:{rows[i][2]}")
            i, at = i + 1, at + 1
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, edits,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def spoil(rows):
    """The query's damage."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        row = (conv, turn, "user" if kind == 4 else role,
               "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        out += [row] * (2 if kind == 3 else 1)
    return out


def by_conversation(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    return {k: [r[1:] for r in g] for k, g in itertools.groupby(rows, key=lambda r: r[0])}


def some_rows(seed, conversations, most=6):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(0, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            text = rng.choice(["Yes.", "No!", "So", " \t", "", None, "a?\n ", "é.", f"t{turn}.", "x. y"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    return rows


AWKWARD = [(None, 0, "user", "null id."), (None, None, "assistant", "null id and turn."),
           (900, 1, "user", "one."), (900, 1, "user", "one."), (900, 1, "user", "one."),    # repeated rows
           (901, 5, "user", "x" * 300_000 + "."), (901, 9, "assistant", "y " * 200_000),    # very long
           (902, None, None, None), (903, 0, "assistant", "Fine."), (903, 0, "user", "What?"),   # ties
           (904, -(1 << 62), "user", "a."), (904, 1 << 62, "assistant", "b."),
           (905, 0, "s", "🙂."), (905, 1, "umpire", "."), (905, 2, "a", "!")]


def test_edits_are_the_cheapest_and_least():
    for n in range(4):
        for codes in itertools.product(range(12), repeat=n):
            if n == 3 and random.Random(str(codes)).random() > 0.15:
                continue
            rows = []
            for i, code in enumerate(codes):
                role, fault = divmod(code, 3)
                rows.append((i, ["system", "user", "assistant", "tool"][role],
                             [f"t{i}.", f"t{i}", ""][fault]))
            want = brute(rows)
            assert cr.tight_edits(bytes(codes)) == (want[5], want[6]), codes


@pytest.mark.parametrize("n", [50, 1_000, 3_333])
def test_checkpoints_give_what_all_vectors_would(n):
    rng = random.Random(n)
    codes = bytes(rng.randrange(12) for _ in range(n))
    vectors = [cr.AT_END]
    for code in reversed(codes):
        vectors.append(cr.before_row(code, vectors[-1]))
    vectors.reverse()
    cost, edits = cr.tight_edits(codes)
    assert cost == vectors[0][cr.START]
    # the edits are a way of that cost, and no step has a lesser letter that is tight
    q, i, spent = cr.START, 0, 0
    for letter in edits:
        options = {"I": (cr.INSERT, i, cr.NEXT[q])}
        if i < n:
            kept, reroled, fee = cr.EDITS[codes[i]][q]
            options["D"] = (cr.DELETE, i + 1, q)
            if kept is not None:
                options["K"] = (fee, i + 1, kept)
            if reroled is not None:
                options["R"] = (cr.REROLE + fee, i + 1, reroled)
        tight = [x for x, (price, j, to) in options.items() if price + vectors[j][to] == vectors[i][q]]
        assert letter == min(tight)
        price, i, q = options[letter]
        spent += price
    assert (i, spent) == (n, cost) and cr.AT_END[q] == 0


def test_reports_against_brute_force(spark):
    rows = some_rows(1, 250) + AWKWARD
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS kind", "'y' AS digest", "1 AS fault")
    got = {r.conv_id: tuple(r)[1:] for r in cr.repair(frame).collect()}
    want = {k: brute(v) for k, v in by_conversation(rows).items()}
    assert got == want


def test_repaired_rows_are_those_of_the_digest(spark):
    rows = some_rows(2, 60) + AWKWARD
    frame = spark.createDataFrame(rows, SCHEMA)
    lines = by_conversation([tuple(r) for r in cr.repaired_rows(frame).collect()])
    for r in cr.repair(frame).collect():
        own = sorted(lines.get(r.conv_id, []))
        assert [x[0] for x in own] == list(range(len(own)))
        assert "".join(x[1] for x in own) == r.audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{x[2]}:{x[3]}" for x in own).encode()).hexdigest() == r.repaired_sha256


def test_conversations_without_rows_and_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cr.repair(none).collect() == [] and cr.repaired_rows(none).collect() == []
    every = spark.createDataFrame([(7,), (7,), (None,)], "conv_id long")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert {tuple(r) for r in cr.repair(none, every).collect()} == {(7, *nothing), (None, *nothing)}


def test_query_damages_then_repairs(spark, tmp_path):
    rows = some_rows(3, 200) + AWKWARD + [(2000 + i, 0, "user", "Alone.") for i in range(60)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in Q.op11_repair(spark, str(tmp_path)).collect()}
    spoiled = by_conversation(spoil(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {k: brute(spoiled[k]) if k in spoiled else nothing for k in by_conversation(rows)}
    assert nothing in got.values()


def test_one_conversation_with_a_third_of_all_rows(spark):
    rng = random.Random(4)
    rows = [(1, i, rng.choice(["user", "assistant"]), f"line {i % 700}{rng.choice(['.', ''])}") for i in range(6_000)]
    rows += [(10 + i % 3_000, i // 3_000, ["user", "assistant"][i // 3_000 % 2], f"{i}.") for i in range(12_000)]
    got = {r.conv_id: r for r in cr.repair(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()}
    seen, codes = set(), bytearray()
    for _, _, role, text in rows[:6_000]:
        fault = cr.MUST_GO if (role, text) in seen else cr.SOUND if text.endswith(".") else cr.CUT_OFF
        seen.add((role, text))
        codes.append(3 * cr.ROLES[role[0]] + fault)
    assert (got[1].cost, got[1].audit) == cr.tight_edits(bytes(codes))
    assert len(got) == 3_001 and all(got[k].audit == "KKKK" for k in got if k != 1)
