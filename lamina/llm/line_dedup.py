"""Line deduplication as an exact set-similarity join, in DataFrame operations alone.

A line is the set of its runs of five words (a shorter line: one run of all).
Lines whose sets have a Jaccard likeness of 0.8 or more are similar, and a
line goes if a similar or equal one stands earlier, in ascending order of ids
and then of lines. Blank lines are layout and always stay. A row is known by its
id and two hashes of its text: rows that share an id, or have none, keep their
lines apart, and of lines at one place of such rows the hashes say which is the
earlier.

The join works on distinct lines. Their tokens are ordered by rarity, the same
for all lines: tokens that a sketch over the whole corpus finds frequent come
last, in levels of their counts, and within a level the hash decides. A line
is listed under the first tokens of that order only, so many that similar
lines share one of them (prefix filter). Two lines that meet there may be
similar if their lengths allow the likeness (length filter), if what stands
behind the shared token can still reach it (positional filter), and if bitmaps of
their sets do; then their whole sets are compared. A line goes as soon as one
earlier line is found similar, so it first meets the earliest line of each of
its lists, then one other of each list. Only lines that neither makes go meet
all earlier ones of their lists, each of them once. A token is known by the
64-bit hash of its words, an equal line by two such hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import frames

WORDS_PER_TOKEN = 5
# A likeness of 4/5, in whole numbers: 5 x shared >= 4 x united.
SHARED, UNITED = 5, 4
# The sketch tracks this many tokens and names this many: a fixed size, and it
# only orders tokens, so no result depends on it.
TRACKED, FREQUENT = 8192, 1024
LEVELS = 7
MOST_BROADCAST = 500_000  # places of candidate lines, of 36 bytes each

ROW = ["doc", "t1", "t2"]
AT = "struct(doc, place, t1, t2)"  # a line's place in the order of all

# A word is fetched by its place: slice() would copy the line for every token.
_RUN = ", ".join(f"words[i + {k}]" for k in range(WORDS_PER_TOKEN))
_PLACES = f"sequence(0, greatest(size(words) - {WORDS_PER_TOKEN}, 0))"
_HASHES = (
    f"IF(size(words) < {WORDS_PER_TOKEN}, array(xxhash64(line)), transform({_PLACES}, i -> xxhash64({_RUN})))"
)


def lines(docs: DataFrame) -> DataFrame:
    """The row, ``place``, ``line`` and two hashes of it, for every line that isn't blank."""
    texts = docs.select(
        *_row_key(), F.posexplode_outer(F.split(F.col("text").cast("string"), "\n")).alias("place", "line")
    )
    return texts.where("trim(line) != ''").selectExpr(
        *ROW, "place", "line", "xxhash64(line) AS k1", "xxhash64(line, 1) AS k2"
    )


def _row_key() -> list[Column]:
    """What a row is known by; one without an id counts as one of the last document."""
    text = F.col("text").cast("string")
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    return [doc.alias("doc"), F.xxhash64(text).alias("t1"), F.xxhash64(text, F.lit(1)).alias("t2")]


def _tokens(found: DataFrame, expression: str, name: str) -> DataFrame:
    return found.withColumn("words", F.split("line", " ")).withColumn(name, F.expr(expression)).drop("words")


def _levels(found: DataFrame) -> list[list[int]]:
    """Hashes of frequent tokens, those of each level of their counts, from a sketch of all."""
    # explode() would add a filter on the array's size that computes it again, word by word.
    spread = _tokens(found, _HASHES, "hashes").select(F.explode_outer("hashes").alias("h"))
    top = spread.agg(F.expr(f"approx_top_k(h, {FREQUENT}, {TRACKED})").alias("top")).first()["top"] or []
    levels: list[list[int]] = [[] for _ in range(LEVELS)]
    for row in top:
        if row["count"] >= 64:
            levels[min(LEVELS - 1, int(math.log(row["count"] / 64, 8)))].append(row["item"])
    return levels


def _ordered(levels: list[list[int]]) -> str:
    """The distinct tokens of a line as numbers that ascend with frequency."""
    cases = "".join(
        f" WHEN h IN ({', '.join(f'{h}L' if h > -(2**63) else 'h' for h in some)}) THEN {i + 1}L"
        for i, some in enumerate(levels)
        if some
    )
    level = f"shiftleft(CASE{cases} ELSE 0L END, 60) | " if cases else ""
    return f"sort_array(array_distinct(transform(hashes, h -> {level}shiftrightunsigned(h, 4))))"


def _classes(found: DataFrame) -> DataFrame:
    """Distinct lines: a number ``c`` in order of first places, first place, count of tokens, and the prefix they are listed under.

    The numbers hold once the rows are written.
    """
    ordered = _tokens(found, _HASHES, "hashes").withColumn("tokens", F.expr(_ordered(_levels(found))))
    n = "size(tokens)"
    prefix = f"slice(tokens, 1, {n} - ({UNITED} * {n} + {SHARED - 1}) div {SHARED} + 1)"
    return (
        ordered.selectExpr(
            "k1", "k2", f"{AT} AS at", f"{n} AS n", f"transform({prefix}, t -> hash(t)) AS prefix"
        )
        .groupBy("k1", "k2")
        .agg(F.min("at").alias("first"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
        # In order of first places, so that of two numbers the smaller is the earlier line's.
        .orderBy("first")
        .select(F.monotonically_increasing_id().alias("c"), "k1", "k2", "first", "n", "prefix")
    )


MARKS = 4  # words of 64 bits in a bitmap
ENTRY = ["c", "n", "i", *[f"w{k}" for k in range(MARKS)]]


def _listing(classes: DataFrame, scratch: frames.Scratch) -> DataFrame:
    """``token`` with number and position of the classes that share it with one of near size."""
    # Few and short columns, since there is a row for every listed token.
    listed = classes.selectExpr("c", f"CAST({frames.OWN} AS BYTE) AS own", "posexplode(prefix) AS (i, token)")
    shared = listed.groupBy("token").agg(F.count("*").alias("df"), F.expr(frames.SIZES)).where("df > 1")
    met = listed.join(shared.where(frames.IN_NEAR_SIZES), "token").where(frames.NEAR_OWN)
    return scratch.written(met.select("token", "c", "i"), "listing")


def _sets(classes: DataFrame, found: DataFrame, scratch: frames.Scratch) -> DataFrame:
    """``c``, the token set and its bitmap, of the classes given.

    Each token turns one of 256 bits over: what two sets share cancels out, so
    no more bits of two bitmaps differ than there are tokens only one set has.
    """
    # Numbers and places only: broadcast behind a check of their count, so that
    # the texts stay where they are; shuffled with the texts beyond it.
    places = scratch.written(classes.select("c", "first.*"), "line-ends")
    few = places.count() <= MOST_BROADCAST
    lines_of = found.select(*ROW, "place", "line").join(F.broadcast(places) if few else places, [*ROW, "place"])
    # Equal rows have the first place of a line once each.
    hashed = _tokens(lines_of.select("c", "line"), _HASHES, "hashes").selectExpr("c", "array_distinct(hashes) AS tokens")
    words = [
        f"aggregate(tokens, 0L, (s, t) -> s ^ IF((t & 192) = {64 * k}, shiftleft(1L, int(t & 63)), 0L)) AS w{k}"
        for k in range(MARKS)
    ]
    return scratch.written(hashed.dropDuplicates(["c"]).selectExpr("c", "tokens", *words), "line-sets")


def _possible(a: str, b: str) -> str:
    """Whether length, position and bitmaps leave the likeness possible; ``a``, ``b`` are column prefixes."""
    n, m = f"{a}n", f"{b}n"
    needed = f"({UNITED} * ({n} + {m}) + {SHARED + UNITED - 1}) div {SHARED + UNITED}"
    apart = " + ".join(f"bit_count({a}w{k} ^ {b}w{k})" for k in range(MARKS))
    return (
        f"{SHARED} * least({n}, {m}) >= {UNITED} * greatest({n}, {m})"
        f" AND least({n} - {a}i, {m} - {b}i) >= {needed}"
        f" AND {SHARED + UNITED} * ({apart}) <= {SHARED - UNITED} * ({n} + {m})"
    )


def _side(entries: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
    return entries.select(*[F.col(c).alias(prefix + c) for c in columns])


def _against_one(entries: DataFrame, lines: DataFrame, order: Column) -> DataFrame:
    """Pairs of ``lines`` and the first entry, in that order, of each of their lists, if it is earlier."""
    one = entries.groupBy("token").agg(F.min(F.struct(order.alias("o"), *ENTRY)).alias("e"))
    one = one.select(F.col("token").alias("x_token"), *[F.col(f"e.{c}").alias(f"x_{c}") for c in ENTRY])
    met = F.expr(f"x_token = y_token AND x_c < y_c AND {_possible('x_', 'y_')}")
    return one.join(_side(lines, "y_", ["token", *ENTRY]), met).selectExpr("x_c AS a", "y_c AS b").distinct()


def _against_all(entries: DataFrame, lines: DataFrame) -> DataFrame:
    """Pairs of ``lines`` and the earlier entries of their lists, from the first token both are under."""
    met = F.expr(
        f"x_token = y_token AND x_c < y_c AND {_possible('x_', 'y_')}"
        " AND NOT arrays_overlap(x_earlier, y_earlier)"
    )
    columns = ["token", "earlier", *ENTRY]
    return _side(entries, "x_", columns).join(_side(lines, "y_", columns), met).selectExpr("x_c AS a", "y_c AS b")


def _later(pairs: DataFrame, sets: DataFrame, scratch: frames.Scratch) -> DataFrame:
    """``c``: the later lines of the pairs whose whole sets have the likeness."""
    pairs = scratch.written(pairs, "line-pairs")
    ends = scratch.written(pairs.selectExpr("a AS c").union(pairs.selectExpr("b AS c")).distinct(), "pair-ends")
    if ends.count() <= MOST_BROADCAST:
        # Only the sets that are compared are shuffled; beyond that number, all are.
        sets = sets.join(F.broadcast(ends), "c", "left_semi")
    left, right = sets.selectExpr("c AS a", "tokens AS x"), sets.selectExpr("c AS b", "tokens AS y")
    # shared / united >= 4 / 5 with the intersection written, and so made, once.
    alike = (SHARED + UNITED) * F.size(F.array_intersect("x", "y")) >= UNITED * (F.size("x") + F.size("y"))
    return pairs.join(left, "a").join(right, "b").where(alike).selectExpr("b AS c").distinct()


def _with_earlier(classes: DataFrame, found: DataFrame, scratch: frames.Scratch) -> DataFrame:
    """``c`` of every class to which an earlier one is similar."""
    listing = _listing(classes, scratch)
    met = classes.join(listing.select("c").distinct(), "c", "left_semi")
    sets = _sets(met, found, scratch)
    known = met.select("c", "n", "prefix").join(sets.drop("tokens"), "c")
    # Of its prefix a row has what stands before its token.
    entries = listing.join(known, "c").withColumn("prefix", F.expr("slice(prefix, 1, i)"))
    entries = scratch.written(entries.withColumnRenamed("prefix", "earlier"), "entries")
    gone = scratch.written(_later(_against_one(entries, entries, F.col("c")), sets, scratch), "gone")
    rest = entries.join(gone, "c", "left_anti")
    more = scratch.written(_later(_against_one(entries, rest, F.xxhash64("token", "c")), sets, scratch), "gone")
    gone = gone.union(more)
    rest = entries.join(gone, "c", "left_anti")
    return gone.union(_later(_against_all(entries, rest), sets, scratch))


def removed_lines(docs: DataFrame) -> DataFrame:
    """The row, and ``place``, of every line that a similar or equal earlier one makes go.

    Lines of equal rows, of one id and one text, share a place: neither is earlier.
    """
    found = lines(docs)
    with frames.Scratch(docs.sparkSession) as scratch:
        classes = scratch.written(_classes(found), "lines")
        near = scratch.written(_with_earlier(classes, found, scratch), "near")
        # A class with an earlier similar line goes whole, of any other all but its first line.
        bounds = classes.join(near.withColumn("near", F.lit(True)), "c", "left").select("k1", "k2", "first", "near")
        every = found.selectExpr("k1", "k2", f"{AT} AS at")
        gone = every.join(bounds, ["k1", "k2"]).where("near OR at > first")
        return frames.written(gone.select(*[f"at.{c}" for c in ROW], "at.place").distinct(), "removed")


def _by_document(docs: DataFrame) -> DataFrame:
    """The row and ``gone``: numbers of its removed lines, ascending."""
    return removed_lines(docs).groupBy(*ROW).agg(F.sort_array(F.collect_list("place")).alias("gone"))


def dedup(docs: DataFrame) -> DataFrame:
    """The documents without the lines that go; all columns stay, ``n_chars`` follows the text.

    A null text stays null, an empty one empty, and a document may become
    empty. Equal rows lose the same lines. No rows, no result.
    """
    joined = docs.select(frames.as_row(docs), *_row_key(), F.col("text").cast("string").alias("text")).join(
        _by_document(docs), ROW, "left"
    )
    split = joined.withColumn("lines", F.split("text", "\n"))
    kept = F.expr("array_join(transform(array_except(sequence(0, size(lines) - 1), gone), i -> lines[i]), '\\n')")
    untouched = F.col("gone").isNull()
    out = split.withColumn("text", F.when(untouched, F.col("text")).otherwise(kept))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(untouched, F.col("row")["n_chars"]).otherwise(chars)
    return out.select(frames.from_row(docs.columns, changed))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every document the number of lines, and the numbers (from 0) of those that go."""
    docs = frames.documents(spark, sf_dir)
    gone = _by_document(docs)
    n_lines = F.expr("size(split(coalesce(text, ''), '\\n'))").alias("n_lines")
    return docs.select("doc_id", *_row_key(), n_lines).join(gone, ROW, "left").selectExpr(
        "doc_id",
        "CAST(n_lines AS BIGINT) AS n_lines",
        "CAST(coalesce(size(gone), 0) AS BIGINT) AS n_removed",
        "coalesce(array_join(transform(gone, i -> CAST(i AS STRING)), ','), '') AS removed",
    )


SQL = """
WITH split_lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place
    FROM documents
), lines AS (
    SELECT * FROM split_lines WHERE trim(line) != ''
), firsts AS (
    SELECT line, min((doc_id, place)) AS first FROM lines GROUP BY line
), words AS (
    SELECT line, first, string_split(line, ' ') AS w FROM firsts
), tokens AS (
    SELECT line, first, list_distinct(CASE WHEN len(w) < 5 THEN [line]
        ELSE list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS t
    FROM words
), listed AS (
    SELECT first, len(t) AS n, unnest(t) AS token FROM tokens
), pairs AS (
    SELECT a.first AS a, b.first AS b, a.n AS n, b.n AS m, count(*) AS shared
    FROM listed a JOIN listed b ON a.token = b.token AND a.first < b.first
    GROUP BY ALL
), near AS (
    SELECT b AS first, min(a) AS earlier FROM pairs WHERE 5 * shared >= 4 * (n + m - shared) GROUP BY b
), gone AS (
    SELECT l.doc_id, l.place
    FROM lines l JOIN firsts f USING (line) LEFT JOIN near USING (first)
    WHERE (l.doc_id, l.place) > coalesce(near.earlier, f.first)
), listing AS (
    SELECT doc_id, count(*) AS n, string_agg(CAST(place AS VARCHAR), ',' ORDER BY place) AS removed
    FROM gone GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(string_split(coalesce(d.text, ''), chr(10))) AS BIGINT) AS n_lines,
       CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, coalesce(g.removed, '') AS removed
FROM documents d LEFT JOIN listing g USING (doc_id)
"""
