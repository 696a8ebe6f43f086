"""Repair of conversations against plain search, and odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from lamina.llm import turns

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, conv string, row int, place long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, 2) for r in rows], SCHEMA)


def plain_faults(rows):
    seen, faults = set(), []
    for role, text in rows:
        inside = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "b" if not inside else "d" if (role, text) in seen else "." if inside[-1] in ".!?" else "t"
        faults.append(fault)
        seen.add((role, text))
    return faults


def plain_repair(rows, faults):
    """(cost, audit, repaired turns): of all edits that reach a state, the least from row to row."""
    best = {"": (0, "", ())}

    def better(found, state, path):
        if state not in found or path[:2] < found[state][:2]:
            found[state] = path

    def legal(state, role):
        end = state + role[:1]
        return re.fullmatch(r"s?(ua)*u?", end) is not None

    def short(state):
        # What matters of the roles so far: the last one, and that something came.
        return state if len(state) < 2 else "u" if state[-1] == "u" else "ua"

    def inserted(found):
        for _ in range(3):
            for state, (cost, audit, out) in list(found.items()):
                for role in ("user", "assistant"):
                    if legal(state, role):
                        better(found, short(state + role[0]), (cost + 5, audit + "I", (*out, f"{role}:")))
        return found

    for (role, text), fault in zip(rows, faults):
        found = {}
        for state, (cost, audit, out) in inserted(dict(best)).items():
            better(found, state, (cost + 2, audit + "D", out))
            if fault in ".t":
                more = 5 if fault == "t" else 0
                if legal(state, role):
                    better(found, short(state + role[:1]), (cost + more, audit + "K", (*out, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if legal(state, new):
                        better(found, short(state + new[0]), (cost + 1 + more, audit + "R", (*out, f"{new}:{text}")))
        best = found
    return min(p for s, p in inserted(dict(best)).items() if re.fullmatch(r"(s?(ua)+)?", s))


def plain(rows):
    """The contract, read row by row."""
    convs = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        made = convs.setdefault(conv, [])
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        made += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, made in convs.items():
        made.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        held = [(r, t) for _, r, t in made]
        numbers = {t for t, _, _ in made if t is not None}
        faults = plain_faults(held)
        initials = [r[:1] for r, _ in held]
        cost, audit, repaired = plain_repair(held, faults)
        out.append(
            (
                conv,
                max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
                *(faults.count(f) for f in "bdt"),
                sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                cost,
                audit,
                hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def collected(df):
    assert df.columns == turns.RESULT
    return sorted((tuple(r) for r in df.collect()), key=repr)


def exhaustive(initials, faults):
    """The least cost and its ASCII-least audit over all edit strings with up to three inserts a place."""
    def edits(i, state, cost, audit, run):
        if i == len(initials):
            if re.fullmatch(r"(s?(ua)+)?", state):
                yield cost, audit
        else:
            yield from edits(i + 1, state, cost + 2, audit + "D", 0)
            if faults[i] in ".t":
                more = 5 if faults[i] == "t" else 0
                kept = "" if initials[i] == "e" else initials[i]
                for role, price, letter in ((kept, 0, "K"), ("u", 1, "R"), ("a", 1, "R")):
                    if re.fullmatch(r"s?(ua)*u?", state + role):
                        yield from edits(i + 1, state + role, cost + price + more, audit + letter, 0)
        if run < 3:
            for role in "ua":
                if re.fullmatch(r"s?(ua)*u?", state + role):
                    yield from edits(i, state + role, cost + 5, audit + "I", run + 1)

    return min(edits(0, "", 0, "", 0))


def test_auction_finds_the_least_of_all_edits():
    for n in range(4):
        for initials in itertools.product("suaxe", repeat=n):
            for faults in itertools.product(".bt", repeat=n):
                found = turns.repair("".join(initials), "".join(faults))
                assert found[:2] == exhaustive(initials, faults), (initials, faults)


def test_prices_leave_no_arc_short():
    chance = random.Random(3)
    for _ in range(40):
        n = chance.randrange(60)
        initials = "".join(chance.choices("suaxe", k=n))
        faults = "".join(chance.choices(".bdt", k=n))
        price = turns.prices(initials, faults)
        for row in range(n):
            for state, out in enumerate(turns.arcs(initials[row], faults[row])):
                behind = [cost + price[4 * (row + step) + to] for _, cost, step, to, _ in out]
                assert price[4 * row + state] == min(behind)
        cost, audit, done = turns.repair(initials, faults)
        assert cost == price[0] and len(audit) == sum(map(len, done)) and len(done) == n + 1


def test_equals_plain_search(spark):
    chance = random.Random(4)
    texts = ["Yes.", "yes", "No!", "Why? ", "\n\t", "", "a. b", "Well.\r\n", "x y z?"]
    rows = []
    for conv in range(60):
        for turn in range(chance.randrange(9)):
            role = chance.choice(["system", "user", "assistant", "tool", "User", "u", ""])
            rows.append((conv * 7, turn * chance.choice([1, 1, 2]), role, chance.choice(texts)))
    chance.shuffle(rows)
    assert collected(turns.repaired(table(spark, rows))) == plain(rows)


def test_nulls_and_repeated_turns(spark):
    rows = [
        (None, None, None, None),
        (None, 1, "user", "Hi."),
        (None, 2, "assistant", None),
        (1, None, "user", "A."),
        (1, None, "user", "A."),
        (1, 5, None, "B."),
        (1, 5, "assistant", "C"),
        (2, -3, "system", "日本。"),
        (2, 2**40, "assistant", "🙂!"),
        (3, None, "assistant", "x" * 30_000 + "."),
    ]
    assert collected(turns.repaired(table(spark, rows))) == plain(rows)


def test_a_conversation_over_many_tasks(spark):
    chance = random.Random(5)
    rows = [
        (9, i // 2, chance.choice(["user", "assistant"]), f"{i % 300} {chance.choice(['ok.', 'so'])}")
        for i in range(2500)
    ]
    rows += [(8, None, "user", "same.")] * 600 + [(10, 1, "user", "end.")]
    frame = table(spark, rows).repartition(5)
    pieces = turns.fragments(turns.with_faults(turns.damaged(frame)))
    assert pieces.where("conv = 9").count() > 15
    assert collected(turns.repaired(frame)) == plain(rows)


def test_a_conversation_that_damage_drops(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    found = collected(turns.repaired(table(spark, [(gone, 0, "user", "Hi.")])))
    assert found == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_no_rows(spark):
    assert collected(turns.repaired(table(spark, []))) == []


@pytest.mark.parametrize("folder", [SF])
def test_equals_sql_on_given_conversations(spark, folder):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    found = collected(turns.query(spark, folder))
    assert found == sorted(con.sql(turns.SQL).fetchall(), key=repr)
    import pyarrow.parquet as pq

    rows = pq.read_table(f"{folder}/conversations.parquet").to_pylist()
    assert found == plain([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows])
