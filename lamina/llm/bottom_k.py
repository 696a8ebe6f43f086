"""Near duplicates by bottom-k sketches of one hash function, confirmed on whole sets.

A document is the set of its runs of two words. Its sketch is the 64 smallest
hashes of the set (a set of 64 or fewer: all of them). Documents link where the
Jaccard likeness of their whole sets is 0.8 or more.

* Documents of equal sets form one class, and the rest works on classes.
* Inverted lists: a retained value leads to the classes that retain it. Values
  are ordered by how many classes have them. Similar sets share so many retained
  values that they must meet in the list of one of their rarest, so a class is
  listed under as many of its rarest values as the required overlap leaves, and
  under none that nobody else has. Similar sets lie in one size class of the ratio
  1.26 or in two next to each other, so a value that only sets of other sizes have
  counts as one that nobody else has, and only classes of near sizes meet in a list.
* Copies first: of every list that it is under, a class meets one other class
  of each near size alone, another one in each list. So a large group of near copies is tied
  together by a few links a class, and only classes of different groups meet
  after that, each two of them once, in the first list that both are under.
* Where two classes meet, bitmaps of their whole sets bound how many shingles only
  one of them has. Those left are judged by their union sketch, the 64 smallest
  values of both, and the survivors by their whole sets, made from the texts again.

Two sets of likeness 0.8 share 51 of the 64 values of their union sketch on
average and fewer than ``LEAST_SHARED`` = 30 with a chance below 1e-9 each; for
sets of 64 or fewer shingles the bounds are exact. Shingles are known by 64-bit
hashes, classes by 128 bits of their sorted set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import frames
from lamina.llm.frames import IN_NEAR_SIZES, NEAR_OWN, OWN, SIZES
from lamina.llm.components import components

SKETCH = 64
LEAST_SHARED = 30
# Likeness in whole numbers: 100 x shared >= 80 x united.
SHARED, UNITED = 5, 4
# A value is frequent if one class in 200 has it: 64 x 200 such values at most,
# whatever the size of the corpus, and their counts are broadcast.
FREQUENT = 200
MARKS = 8  # words of 64 bits in a bitmap
MOST_BROADCAST = 500_000  # rows of 32 bytes that say whose texts are wanted
WORDS_HELD = 1 << 18  # words whose hashes a task remembers
ROWS_PER_BATCH = 256

# A row is known by its id and two hashes of its text, its set by two hashes.
ROW = ["doc", "t1", "t2"]
SETS = "doc long, t1 long, t2 long, k1 long, k2 long, n long, sketch array<bigint>, marks array<bigint>"


# --- sets of hashes ---------------------------------------------------------------


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on all."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Shingler:
    """Hashes of two-word runs; remembers the hashes of words, up to a bound."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def _word(self, word: bytes) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= WORDS_HELD:
                self.known.clear()
            found = self.known[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def shingles(self, text: str | None) -> np.ndarray:
        """Ascending distinct hashes of a text's runs; of one word, that word's; of none, nothing."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        hashes = np.fromiter(map(self._word, words), np.uint64, len(words))
        if len(words) < 2:
            return _mixed(hashes).view(np.int64)
        # The first word's hash is mixed before the second comes in, so order counts.
        return np.unique(_mixed(_mixed(hashes[:-1] + np.uint64(1)) + hashes[1:]).view(np.int64))


def _identity(shingles: np.ndarray) -> tuple[int, int]:
    digest = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
    return int(digest[0]), int(digest[1])


def _marks(shingles: np.ndarray) -> np.ndarray:
    """A bitmap in which every shingle turns one bit over.

    What two sets share cancels out, so no more bits of two bitmaps differ than
    there are shingles that only one of the sets has.
    """
    odd = np.bincount(shingles & (64 * MARKS - 1), minlength=64 * MARKS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shingler = Shingler()
    for pdf in batches:
        rows = []
        for text in pdf["text"]:
            found = shingler.shingles(text)
            rows.append((*_identity(found), len(found), found[:SKETCH], _marks(found)))
        made = pd.DataFrame(rows, columns=["k1", "k2", "n", "sketch", "marks"])
        yield pd.concat([pdf[ROW], made], axis=1)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What a row is known by, and its text; a null text is empty, a null id the least number."""
    return frames.whole_text(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(frames.NO_ID)).alias("doc"),
        F.xxhash64("text").alias("t1"),
        F.xxhash64("text", F.lit(1)).alias("t2"),
        "text",
    )


def sketches(found: DataFrame) -> DataFrame:
    """The rows of :func:`texts` with two hashes and the size of their sets, and their sketches."""
    return found.mapInPandas(_sketches, SETS)


def _whole_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shingler = Shingler()
    for pdf in batches:
        yield pd.DataFrame({"c": pdf["c"], "tokens": [shingler.shingles(t) for t in pdf["text"]]})


# --- candidates -------------------------------------------------------------------


def _classes(rows: DataFrame) -> DataFrame:
    """A number ``c`` for each set that isn't empty, its size, sketch, bitmap, first row and least id.

    The numbers hold once the rows are written.
    """
    one = (
        rows.where("n > 0")
        .groupBy("k1", "k2")
        # The rows of a class have equal sketches, so any will do.
        .agg(
            F.first("n").alias("n"),
            F.first("sketch").alias("sketch"),
            F.first("marks").alias("marks"),
            F.min(F.struct(*ROW)).alias("row"),
            F.min(F.nullif("doc", F.lit(frames.NO_ID))).alias("least"),
        )
    )
    words = [F.col("marks")[i].alias(f"w{i}") for i in range(MARKS)]
    return one.select(F.monotonically_increasing_id().alias("c"), "k1", "k2", "n", "sketch", "row", "least", *words)


WORDS = [f"w{i}" for i in range(MARKS)]
MEET = "x_value = y_value AND abs(x_own - y_own) <= 1"


def _possible(a: str, b: str) -> str:
    """Whether sizes and bitmaps of two classes, in columns of these prefixes, leave the likeness possible."""
    n, m = f"{a}n", f"{b}n"
    apart = " + ".join(f"bit_count({a}{w} ^ {b}{w})" for w in WORDS)
    # shared >= 4/9 of both sizes, so at most 1/9 of them stands in one set only.
    few = f"{SHARED + UNITED} * ({apart}) <= {SHARED - UNITED} * ({n} + {m})"
    return f"{SHARED} * least({n}, {m}) >= {UNITED} * greatest({n}, {m}) AND {few}"


def _listing(classes: DataFrame, scratch: frames.Scratch) -> DataFrame:
    """``c``, ``value``: each class under its rarest retained values that another class of near size has too.

    With ``n`` and bitmap of the class, ``own``, its size class, and ``earlier``, the
    values that it is listed under and that come before, in the order that is the same for all.
    """
    retained = classes.select("c", F.expr(OWN).alias("own"), F.explode("sketch").alias("value"))
    held = retained.groupBy("value").agg(F.count("*").alias("df"), F.expr(SIZES))
    held = scratch.written(held.where(IN_NEAR_SIZES).where("df > 1"), "values")
    total = classes.count()
    frequent = held.where(F.col("df") * FREQUENT >= total)
    # Frequent values are few, by their definition; the lists of the others are short.
    often = retained.join(F.broadcast(frequent), "value")
    seldom = retained.join(F.broadcast(frequent.select("value")), "value", "left_anti").join(
        held.where(F.col("df") * FREQUENT < total), "value"
    )
    ranked = F.sort_array(F.collect_list(F.struct("df", "value")))
    shared = often.union(seldom).where(NEAR_OWN)
    by_class = shared.groupBy("c").agg(F.transform(ranked, lambda s: s["value"]).alias("shared"))
    # The values that none of near size shares are the rarest of all: they fill the first places.
    size = f"least(n, {SKETCH})"
    least = f"IF(n <= {SKETCH}, (3 * n + 3) div 4, {LEAST_SHARED})"
    places = f"int({size} - {least} + 1 - ({size} - size(shared)))"
    chosen = (
        classes.select("c", "n")
        .join(by_class, "c")
        .select("c", F.expr(f"slice(shared, 1, greatest({places}, 0))").alias("listed"), F.expr(OWN).alias("own"))
    )
    chosen = scratch.written(chosen, "chosen")
    # Few and short columns, since there is a row for every listed value.
    listed = chosen.select("c", F.posexplode("listed").alias("i", "value"), "own")
    several = listed.groupBy("value").agg(F.count("*").alias("df"), F.expr(SIZES))
    met = listed.join(several.where(IN_NEAR_SIZES).where("df > 1"), "value").where(NEAR_OWN)
    known = chosen.select("c", "listed").join(classes.select("c", "n", *WORDS), "c")
    return met.select("c", "value", "i", "own").join(known, "c").selectExpr(
        "c", "value", "own", "n", *WORDS, "slice(listed, 1, i) AS earlier"
    )


def _side(entries: DataFrame, prefix: str) -> DataFrame:
    return entries.select(*[F.col(c).alias(prefix + c) for c in entries.columns])


def _star_pairs(listing: DataFrame) -> DataFrame:
    """Pairs of a class and one other of each near size in each list it is under, that may be similar."""
    entry = F.struct(F.xxhash64("value", "c").alias("order"), "c", "n", *WORDS)
    firsts = listing.groupBy("value", "own").agg(F.min(entry).alias("first"))
    centres = firsts.select(
        F.col("value").alias("y_value"),
        F.col("own").alias("y_own"),
        *[F.col(f"first.{c}").alias(f"y_{c}") for c in ["c", "n", *WORDS]],
    )
    return (
        _side(listing.drop("earlier"), "x_")
        .join(centres, F.expr(f"{MEET} AND x_c != y_c AND {_possible('x_', 'y_')}"))
        .selectExpr("least(x_c, y_c) AS a", "greatest(x_c, y_c) AS b")
        .distinct()
    )


def _list_pairs(listing: DataFrame, group: DataFrame, scratch: frames.Scratch) -> DataFrame:
    """Pairs of classes of different groups that may be similar, from the first list both are under."""
    known = listing.join(group.selectExpr("vertex AS c", "component"), "c", "left").withColumn(
        "g", F.coalesce("component", "c")
    )
    # A list of one group alone has nothing to add.
    mixed = known.groupBy("value").agg(F.min("g").alias("low"), F.max("g").alias("high")).where("low < high")
    entries = scratch.written(known.drop("component").join(mixed.select("value"), "value", "left_semi"), "listing")
    once = "NOT arrays_overlap(x_earlier, y_earlier)"
    return (
        _side(entries, "x_")
        .join(_side(entries, "y_"), F.expr(f"{MEET} AND x_g < y_g AND {_possible('x_', 'y_')} AND {once}"))
        .selectExpr("x_c AS a", "y_c AS b")
    )


# --- judging ----------------------------------------------------------------------


def _by_union_sketch(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose union sketch leaves the likeness possible."""
    x = classes.selectExpr("c AS a", "n AS n", "sketch AS x")
    y = classes.selectExpr("c AS b", "n AS m", "sketch AS y")
    united = f"slice(sort_array(array_union(x, y)), 1, {SKETCH})"
    shared = f"size(array_intersect(array_intersect(x, y), {united}))"
    # Sketches of small sets are the sets.
    exact = f"{SHARED + UNITED} * size(array_intersect(x, y)) >= {UNITED} * (n + m)"
    judged = f"IF(n <= {SKETCH} AND m <= {SKETCH}, {exact}, {shared} >= {LEAST_SHARED})"
    return pairs.join(x, "a").join(y, "b").where(judged).select("a", "b")


def _sets(wanted: DataFrame, found: DataFrame, scratch: frames.Scratch) -> DataFrame:
    """``c`` and the whole set of the classes in ``wanted``, made from one text of each."""
    wanted = scratch.written(wanted, "wanted")
    # Numbers only: broadcast behind a check of their count, so that the texts
    # stay where they are; shuffled with the texts beyond it.
    few = wanted.count() <= MOST_BROADCAST
    texts = found.join(F.broadcast(wanted) if few else wanted, ROW).select("c", "text")
    # Equal rows come once each, so one of them is taken.
    firsts = texts.groupBy("c").agg(F.first("text").alias("text"))
    return scratch.written(firsts.mapInPandas(_whole_sets, "c long, tokens array<bigint>"), "sets", ROWS_PER_BATCH)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs whose whole sets have the likeness."""
    x = sets.selectExpr("c AS a", "tokens AS x")
    y = sets.selectExpr("c AS b", "tokens AS y")
    alike = f"{SHARED + UNITED} * size(array_intersect(x, y)) >= {UNITED} * (size(x) + size(y))"
    return pairs.join(x, "a").join(y, "b").where(alike).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.selectExpr("a AS c").union(pairs.selectExpr("b AS c")).distinct()


def links(classes: DataFrame, found: DataFrame, scratch: frames.Scratch) -> DataFrame:
    """Links ``a``, ``b`` of classes that tie together all that have the likeness.

    ``found`` are the rows of :func:`texts`, ``classes`` the written classes of their sets.
    """
    rows = classes.select("c", "row.*")
    listing = scratch.written(_listing(classes, scratch), "lists")
    stars = scratch.written(_by_union_sketch(_star_pairs(listing), classes), "pairs")
    sets = _sets(rows.join(_ends(stars), "c", "left_semi"), found, scratch)
    copies = scratch.written(_confirmed(stars, sets), "links")
    others = _by_union_sketch(_list_pairs(listing, components(copies), scratch), classes)
    others = scratch.written(others, "pairs")
    more = rows.join(_ends(others), "c", "left_semi").join(sets.select("c"), "c", "left_anti")
    every = sets.union(_sets(more, found, scratch))
    return scratch.written(copies.union(_confirmed(others, every)), "links")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    ``component_id`` is the smallest id that links reach, the row's own
    included; ``kept`` says whether it is the row's own. A null text is empty:
    a row without a word has no shingle, links with nothing and is kept. A row
    without an id links as others do; its ``component_id`` is that of its group,
    and null, with the row kept, where nobody in the group has an id. Rows of
    one id count as one document. No rows, no result.
    """
    found = texts(docs, id_col, text_col)
    with frames.Scratch(docs.sparkSession) as scratch:
        rows = scratch.written(sketches(found), "sketches", ROWS_PER_BATCH)
        classes = scratch.written(_classes(rows), "classes")
        labels = components(links(classes, found, scratch).union(_of_one_id(rows, classes)))
        return frames.written(_named(rows, classes, labels), "near-duplicates")


def _of_one_id(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links of the classes that rows of one id are in."""
    rows = rows.where((F.col("n") > 0) & (F.col("doc") != frames.NO_ID)).select("doc", "k1", "k2")
    several = (
        rows.groupBy("doc")
        .agg(F.min(F.struct("k1", "k2")).alias("low"), F.max(F.struct("k1", "k2")).alias("high"))
        .where("low != high")
        .select("doc")
    )
    numbered = rows.join(several, "doc").join(classes.select("k1", "k2", "c"), ["k1", "k2"])
    first = numbered.groupBy("doc").agg(F.min("c").alias("a"))
    return numbered.join(first, "doc").where("a != c").selectExpr("a", "c AS b")


def _named(rows: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with the least id of their component."""
    named = classes.join(labels.withColumnRenamed("vertex", "c"), "c", "left").select(
        "k1", "k2", "least", F.coalesce("component", "c").alias("label")
    )
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of_class = named.join(least, "label").select("k1", "k2", "component_id")
    joined = rows.select("doc", "k1", "k2", "n").join(of_class, ["k1", "k2"], "left")
    own = F.nullif("doc", F.lit(frames.NO_ID))
    component = F.when(F.col("n") == 0, own).otherwise(F.col("component_id"))
    return joined.select(
        own.alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        own.eqNullSafe(component).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return groups(frames.documents(spark, sf_dir))


SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS MATERIALIZED (
    SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
    FROM words
), listed AS MATERIALIZED (
    SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets
), pairs AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM listed a JOIN listed b ON a.token = b.token AND a.doc_id < b.doc_id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), edges AS (
    SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, e.b FROM reached r JOIN edges e ON r.b = e.a
), least AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)
"""
