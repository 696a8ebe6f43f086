"""Repair of the turn structure of conversations by an auction for shortest paths.

The edits of a conversation are paths through a lattice: a node is a row and
what the repaired conversation ends with so far (nothing, a system, a user or an
assistant turn), an arc is an edit with its whole-number cost. An auction (Bertsekas)
finds the cheapest path: every node has a price, a path grows from its origin. If
the price of its last node is below the best of cost plus price behind its
arcs, the price rises to that and the path gives up the node (contraction);
otherwise the path takes the best arc (extension). No price ever exceeds cost
plus price behind an arc, and along the path both are equal, so a path that
reaches the end is a cheapest one. Origins are taken from the last row back to
the first; a path that meets a node of an earlier path ends there. Then all
prices have converged, the cheapest paths are those of tight arcs (price =
cost + price behind), and taking the least letter of the tight arcs from node to
node gives the ASCII-least cheapest edits.

Texts stay out of the lattice. Rows are sorted by ranges, so that a conversation
may lie in many tasks, and become two letters each; a conversation's letters, as
large as its result, are repaired in one place. Its repaired text is hashed as a
stream of bounded pieces, since SHA-256 has to see it in order.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import frames

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5  # costs; the last for a truncated row that stays

ROWS_PER_BATCH = 128
BYTES_PER_RANGE = 64 << 20

# A row's letters: what its role begins with (x: anything else, e: no character)
# and its first fault.
FINE, BLANK, DUPLICATE, TRUNCATED = ".", "b", "d", "t"
STATES = range(4)  # the repaired turns end with: nothing, system, user, assistant
FOLLOWS = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
LEGAL = {"su", "ua", "au"}

FRAGMENTS = (
    "conv bigint, initials string, faults string, first bigint, last bigint, turns bigint, "
    "roles array<string>, texts array<string>"
)
FACTS = (
    "conv bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, edits array<struct<place:bigint,letters:string>>"
)
RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

# An arc: letter of the edit, cost, rows it passes, state behind it, what is done.
Arc = tuple[str, int, int, int, str]
Batches = Iterator[pa.RecordBatch]


# --- the lattice ------------------------------------------------------------------


def _needed(state: int) -> tuple[int, str]:
    """The state that a further turn leads to, and the letter of its role."""
    return (3, "a") if state == 2 else (2, "u")


@cache
def arcs(initial: str, fault: str) -> list[list[Arc]]:
    """Arcs of each state before a row of these letters, in order of their edits' letters."""
    extra = CUT_OFF if fault == TRUNCATED else 0
    found = []
    for state in STATES:
        after, role = _needed(state)
        here = [("D", DELETE, 1, state, "D"), ("I", INSERT, 0, after, role.upper())]
        if fault not in (BLANK, DUPLICATE):
            kept = state if initial == "e" else FOLLOWS.get((initial, state))
            if kept is not None:
                here.append(("K", KEEP + extra, 1, kept, "K"))
            here.append(("R", REROLE + extra, 1, after, role))
        found.append(here)
    return found


@cache
def last_arcs() -> list[list[Arc]]:
    """Arcs behind the last row; a repaired conversation ends with nothing or an assistant."""
    found = []
    for state in STATES:
        after, role = _needed(state)
        end = [("", 0, 1, 0, "")] if state in (0, 3) else []
        found.append([*end, ("I", INSERT, 0, after, role.upper())])
    return found


def prices(initials: str, faults: str) -> list[int]:
    """The converged price of every node, four a row; the last is the end's."""
    rows = len(initials)
    price = [0] * (4 * (rows + 1) + 1)
    settled = [False] * (4 * (rows + 1)) + [True]
    end = len(price) - 1
    for row in range(rows, -1, -1):
        out = last_arcs() if row == rows else arcs(initials[row], faults[row])
        for origin in STATES:
            path = [4 * row + origin]
            while not settled[path[-1]]:
                node = path[-1]
                best, behind = min(
                    (cost + price[to], to)
                    for _, cost, step, state, _ in out[node - 4 * row]
                    for to in [min(4 * (row + step) + state, end)]
                )
                if price[node] < best:
                    price[node] = best
                    if len(path) > 1:
                        path.pop()
                else:
                    path.append(behind)
            for node in path:
                settled[node] = True
    return price


def repair(initials: str, faults: str) -> tuple[int, str, list[str]]:
    """Least cost, its ASCII-least edits, and what is done up to and with each row and behind the last."""
    price = prices(initials, faults)
    end = len(price) - 1
    row, state, audit, done = 0, 0, [], [""]
    while True:
        out = last_arcs() if row == len(initials) else arcs(initials[row], faults[row])
        here = price[4 * row + state]
        letter, _, step, state, deed = next(
            a for a in out[state] if here == a[1] + price[min(4 * (row + a[2]) + a[3], end)]
        )
        if not letter:
            return price[0], "".join(audit), done
        audit.append(letter)
        done[-1] += deed
        row += step
        if step:
            done.append("")


# --- rows -------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that the CRC-32 of ``conv_id:turn`` decides; a null counts as one space."""

    def spaced(name: str) -> str:
        return f"coalesce(CAST({name} AS STRING), ' ')"

    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.expr(spaced("role")).alias("role"),
        F.expr(spaced("text")).alias("text"),
    )
    kind = f"pmod(crc32(concat({spaced('conv')}, ':', {spaced('turn')})), 20)"
    return (
        rows.withColumn("damage", F.expr(kind))
        .where("damage != 0")
        .selectExpr(
            "conv",
            "turn",
            "IF(damage = 4, 'user', role) AS role",
            "CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '') ELSE text END AS text",
            "explode(IF(damage = 3, array(0, 1), array(0))) AS copy",
        )
        .drop("copy")
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """The rows with ``row`` (a number), ``initial`` and ``fault``.

    Rows of one turn stand in order of role and text. A role and text are the
    same as earlier ones if two 64-bit hashes are.
    """
    numbered = frames.written(
        rows.select(
            "*",
            F.monotonically_increasing_id().alias("row"),
            F.xxhash64("conv", "role", "text").alias("h1"),
            F.xxhash64("text", "role", "conv").alias("h2"),
        ),
        "turns",
    )
    firsts = numbered.groupBy("h1", "h2").agg(F.min(F.struct("turn", "row"))["row"].alias("first"))
    blank = r"NOT text RLIKE '[^\\x20\\x09-\\x0D]'"
    whole = r"text RLIKE '[.!?][\\x20\\x09-\\x0D]*\\z'"
    return numbered.join(firsts, ["h1", "h2"]).selectExpr(
        "conv",
        "turn",
        "role",
        "text",
        "row",
        "CASE WHEN role = '' THEN 'e' WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS initial",
        f"CASE WHEN {blank} THEN '{BLANK}' WHEN row != first THEN '{DUPLICATE}'"
        f" WHEN {whole} THEN '{FINE}' ELSE '{TRUNCATED}' END AS fault",
    )


def _into_fragments(batches: Batches) -> Batches:
    """One row for the rows of a conversation in a batch; these come in order."""
    schema = pa.schema(
        [
            ("conv", pa.int64()),
            ("initials", pa.string()),
            ("faults", pa.string()),
            ("first", pa.int64()),
            ("last", pa.int64()),
            ("turns", pa.int64()),
            ("roles", pa.list_(pa.string())),
            ("texts", pa.list_(pa.string())),
        ]
    )
    for batch in batches:
        held = batch.to_pydict()
        convs = held["conv"]
        cuts = [i for i in range(len(convs)) if i == 0 or convs[i] != convs[i - 1]] + [len(convs)]
        out = []
        for i, j in zip(cuts, cuts[1:]):
            turns = [t for t in held["turn"][i:j] if t is not None]
            out.append(
                {
                    "conv": convs[i],
                    "initials": "".join(held["initial"][i:j]),
                    "faults": "".join(held["fault"][i:j]),
                    "first": min(turns, default=None),
                    "last": max(turns, default=None),
                    "turns": len(set(turns)),
                    "roles": held["role"][i:j],
                    "texts": held["text"][i:j],
                }
            )
        yield pa.RecordBatch.from_pylist(out, schema)


def fragments(rows: DataFrame) -> DataFrame:
    """Pieces of conversations in order of ``place``, at most a batch of rows each."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(total / BYTES_PER_RANGE))
    # The row's number keeps equal rows from being one key, and so one range.
    order = ["conv", "turn", "role", "text", "row"]
    cut = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop("row")
    made = cut.mapInArrow(_into_fragments, FRAGMENTS).withColumn("place", F.monotonically_increasing_id())
    return frames.written(made, "fragments", ROWS_PER_BATCH)


# --- whole conversations ----------------------------------------------------------


def _gaps(pieces: list[dict]) -> int:
    """Turn numbers missing between the least and the largest."""
    dated = [p for p in pieces if p["turns"]]
    if not dated:
        return 0
    # A turn may reach from one piece into the next.
    distinct = sum(p["turns"] for p in dated) - sum(a["last"] == b["first"] for a, b in zip(dated, dated[1:]))
    return dated[-1]["last"] - dated[0]["first"] + 1 - distinct


def _facts(conv: int | None, pieces: list[dict]) -> dict:
    initials = "".join(p["initials"] for p in pieces)
    faults = "".join(p["faults"] for p in pieces)
    cost, audit, done = repair(initials, faults)
    edits, at = [], 0
    for n, piece in enumerate(pieces):
        upto = at + len(piece["initials"]) + (n == len(pieces) - 1)
        edits.append({"place": piece["place"], "letters": "".join(done[at:upto])})
        at = upto
    return {
        "conv": conv,
        "gaps": _gaps(pieces),
        "blank": faults.count(BLANK),
        "duplicate": faults.count(DUPLICATE),
        "truncated": faults.count(TRUNCATED),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "edits": edits,
    }


def _repaired(batches: Batches) -> Batches:
    edit = pa.struct([("place", pa.int64()), ("letters", pa.string())])
    counts = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([*[(c, pa.int64()) for c in counts], ("audit", pa.string()), ("edits", pa.list_(edit))])
    for batch in batches:
        yield pa.RecordBatch.from_pylist([_facts(r["conv"], r["pieces"]) for r in batch.to_pylist()], schema)


ROLES = {"u": "user", "a": "assistant"}


def apply(letters: str, roles: list[str], texts: list[str]) -> Iterator[str]:
    """The repaired turns of a piece as ``role:text``."""
    at = 0
    for letter in letters:
        if letter in "UA":
            yield f"{ROLES[letter.lower()]}:"
            continue
        if letter != "D":
            yield f"{ROLES.get(letter, roles[at])}:{texts[at]}"
        at += 1


def _hashed(batches: Batches) -> Batches:
    """The hash of each conversation's repaired turns; its pieces come in order, edits before texts."""
    schema = pa.schema([("conv", pa.int64()), ("sha", pa.string())])
    began, conv, state, written, letters = False, None, hashlib.sha256(), False, ""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if began and row["conv"] != conv:
                out.append((conv, state.hexdigest()))
                state, written = hashlib.sha256(), False
            began, conv = True, row["conv"]
            if row["texts"] is None:
                letters = row["letters"]
                continue
            for turn in apply(letters, row["roles"], row["texts"]):
                state.update((b"\n" if written else b"") + turn.encode("utf-8", "surrogatepass"))
                written = True
        yield pa.RecordBatch.from_pydict({"conv": [c for c, _ in out], "sha": [s for _, s in out]}, schema)
    if began:
        yield pa.RecordBatch.from_pydict({"conv": [conv], "sha": [state.hexdigest()]}, schema)


def repaired(conversations: DataFrame) -> DataFrame:
    """Faults, cheapest edits and the hash of the repaired turns, of every ``conv_id``.

    Rows without a ``conv_id`` are one conversation, rows without a turn come
    first and count for no gap. A role that is the empty string has no initial:
    it may be kept anywhere. Rows that the damage leaves nothing of have zeros,
    an empty audit and the empty string's hash. No rows, no result.
    """
    pieces = fragments(with_faults(damaged(conversations)))
    listed = F.struct("place", "initials", "faults", "first", "last", "turns")
    whole = pieces.groupBy("conv").agg(F.sort_array(F.collect_list(listed)).alias("pieces"))
    facts = frames.written(whole.mapInArrow(_repaired, FACTS), "repairs", ROWS_PER_BATCH)
    edits = facts.select("conv", F.explode("edits").alias("e")).select(
        "conv",
        "e.place",
        "e.letters",
        F.lit(None).cast("array<string>").alias("roles"),
        F.lit(None).cast("array<string>").alias("texts"),
    )
    texts = pieces.select("conv", "place", F.lit(None).cast("string").alias("letters"), "roles", "texts")
    streamed = (
        edits.union(texts)
        .repartition("conv")
        .sortWithinPartitions("conv", "place", F.col("texts").isNotNull())
        .mapInArrow(_hashed, "conv bigint, sha string")
    )
    hashes = frames.written(streamed, "hashes", ROWS_PER_BATCH).withColumnRenamed("conv", "hashed")
    every = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    joined = every.join(facts.drop("edits"), F.col("conv_id").eqNullSafe(F.col("conv")), "left").join(
        hashes, F.col("conv_id").eqNullSafe(F.col("hashed")), "left"
    )
    nothing = {"audit": "", "sha": hashlib.sha256().hexdigest()}
    return joined.fillna(0, RESULT[1:7]).fillna(nothing).withColumnRenamed("sha", RESULT[-1]).select(*RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repairs of all ``conversations``."""
    return repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def _sql() -> str:
    """The cheapest edits by dynamic programming from row to row, in recursive SQL."""

    def edit(v: str, cost: str, letter: str, piece: str | None) -> str:
        out = f"{v}.o" if piece is None else f"list_append({v}.o, {piece})"
        return f"CASE WHEN {v} IS NOT NULL THEN {{'c': {v}.c + {cost}, 'a': {v}.a || '{letter}', 'o': {out}}} END"

    def first(*options: str) -> str:
        return f"list_sort([x FOR x IN [{', '.join(options)}] IF x IS NOT NULL])[1]"

    def insert(v: str, role: str) -> str:
        return edit(v, str(INSERT), "I", f"'{role}:'")

    def arrive(state: str, role: str | None, before: tuple[str, ...]) -> str:
        stays = "fault IN ('.', 't')"
        extra = f"(CASE fault WHEN 't' THEN {CUT_OFF} ELSE 0 END)"
        own = "role || ':' || text"
        options = [
            edit(f"q.{state}", str(DELETE), "D", None),
            f"CASE WHEN {stays} AND initial = '' THEN {edit(f'q.{state}', extra, 'K', own)} END",
        ]
        for v in before:
            options.append(
                f"CASE WHEN {stays} AND initial = '{role[0]}' THEN {edit(f'q.{v}', extra, 'K', own)} END"
            )
            if role != "system":
                rerole = edit(f"q.{v}", f"({REROLE} + {extra})", "R", f"'{role}:' || text")
                options.append(f"CASE WHEN {stays} THEN {rerole} END")
        return first(*options)

    byte = "list_reduce([xor(crc, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))"
    space = r"[^\x20\x09-\x0D]"
    ends = f"""
    SELECT conv, n, z, s, u1 AS u, {first('a', insert('u1', 'assistant'))} AS a
    FROM (SELECT *, {first('u', insert('z', 'user'), insert('s', 'user'), insert('a', 'user'))} AS u1 FROM paths)"""
    return f"""
WITH RECURSIVE keyed AS (
    SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
), damage AS (
    SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, b: {byte}), 4294967295) % 20 AS kind
    FROM keyed
), rows AS (
    SELECT conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM damage WHERE kind <> 0
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS n FROM rows
), faulty AS MATERIALIZED (
    SELECT *, left(role, 1) AS initial,
           CASE WHEN NOT regexp_matches(text, '{space}') THEN 'b'
                WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY n) > 1 THEN 'd'
                WHEN regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN '.' ELSE 't' END AS fault
    FROM ordered
), pairs AS (
    SELECT *, lag(initial) OVER (PARTITION BY conv ORDER BY n) AS earlier FROM faulty
), facts AS (
    SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
           count(*) FILTER (fault = 't') AS truncated, max(n) AS n,
           count(*) FILTER (n > 1 AND (earlier || initial) NOT IN ('su', 'ua', 'au')) AS illegal
    FROM pairs GROUP BY conv
), paths AS (
    SELECT conv, 0::BIGINT AS n, {{'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]}} AS z,
           NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR[]) AS s, NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR[]) AS u,
           NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR[]) AS a
    FROM facts
    UNION ALL
    SELECT q.conv, f.n, {arrive('z', None, ())}, {arrive('s', 'system', ('z',))},
           {arrive('u', 'user', ('z', 's', 'a'))}, {arrive('a', 'assistant', ('u',))}
    FROM ({ends}) q JOIN faulty f ON f.conv IS NOT DISTINCT FROM q.conv AND f.n = q.n + 1
), best AS (
    SELECT q.conv, {first('q.z', 'q.a')} AS best
    FROM ({ends}) q JOIN facts f ON f.conv IS NOT DISTINCT FROM q.conv AND f.n = q.n
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts f ON f.conv IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv IS NOT DISTINCT FROM c.conv_id
"""


SQL = _sql()
