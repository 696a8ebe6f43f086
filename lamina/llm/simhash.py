"""Near duplicates by SimHash, found through anchors of a covering code.

A text's fingerprint has a bit for each of the 64 bits that over half of its
shingles' hashes set. Two fingerprints link at two or fewer differing bits.

The anchors are pairs of code words of the perfect binary Golay code of length
23, one for each of two disjoint blocks of 23 bits. Its covering radius is 3,
so every fingerprint has exactly one anchor within 3 bits on either block: its
home. A fingerprint is replicated to every anchor within the covering radius
plus the threshold, where the two blocks share the threshold: 61 anchors on
average, whatever the size of the corpus. If two fingerprints differ in two
bits at most, the home of the one is among the anchors of the other, so
comparing the homes of an anchor with all that came there finds every link.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import frames
from lamina.llm.components import components

WORDS_PER_SHINGLE = 3
HASH_SEED = 42
THRESHOLD = 2

BLOCK = 23
RADIUS = 3
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
CHECK_BITS = 11
MASK = (1 << BLOCK) - 1

# Homes of one anchor that one task compares; more are dealt over more tasks.
HOMES_PER_TASK = 2048
_SHINGLES_AT_ONCE = 1 << 15


def fingerprint(text: str | None) -> int:
    """SimHash of the word shingles, repeats included; no word: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= WORDS_PER_SHINGLE:
        return xxhash.xxh64_intdigest(joined, HASH_SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins = (ends - lengths).tolist()
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    last = ends[WORDS_PER_SHINGLE - 1 :].tolist()
    for low in range(0, len(last), _SHINGLES_AT_ONCE):
        part = last[low : low + _SHINGLES_AT_ONCE]
        hashes = np.array(
            [digest(joined[i:j], HASH_SEED) for i, j in zip(begins[low : low + len(part)], part)],
            np.uint64,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    over = np.packbits(2 * set_bits > len(last), bitorder="little")
    return int(over.view(np.uint64)[0])


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        prints = np.fromiter(map(fingerprint, pdf["text"]), np.uint64, len(pdf))
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": _signed(prints)})


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` (64 bits as a signed long) of every row; a null text is empty."""
    return frames.whole_text(docs, id_col, text_col).mapInPandas(_fingerprints, "doc_id long, fp long")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of every 23-bit word by the generator."""
    rest = words.astype(np.int64)
    for bit in range(BLOCK - 1, CHECK_BITS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECK_BITS)), rest)
    return rest


@cache
def _patterns() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Error patterns by syndrome: those of each, by excess over the radius; where each
    syndrome's begin; how many it has up to each excess."""
    words, excess = [], []
    for weight in range(RADIUS + THRESHOLD + 1):
        for places in combinations(range(BLOCK), weight):
            words.append(sum(1 << p for p in places))
            excess.append(max(0, weight - RADIUS))
    words, excess = np.array(words), np.array(excess)
    syndromes = _syndromes(words)
    order = np.lexsort((excess, syndromes))
    cosets = 1 << CHECK_BITS
    begins = np.searchsorted(syndromes[order], np.arange(cosets))
    upto = np.stack(
        [np.bincount(syndromes[excess <= level], minlength=cosets) for level in range(THRESHOLD + 1)], 1
    )
    levels = np.stack([words[order], excess[order]], 1)
    return levels, begins, upto


def _expand(block: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, code word and excess for every code word within the radius plus what is allowed."""
    levels, begins, upto = _patterns()
    syndromes = _syndromes(block)
    counts = upto[syndromes, allowed]
    rows = np.repeat(np.arange(len(block)), counts)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    chosen = levels[begins[syndromes[rows]] + within]
    return rows, block[rows] ^ chosen[:, 0], chosen[:, 1]


def anchors_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, anchor and whether it is the home, for every anchor that a fingerprint goes to."""
    low, high = prints & MASK, prints >> BLOCK & MASK
    rows, first, spent = _expand(low, np.full(len(prints), THRESHOLD))
    again, second, more = _expand(high[rows], THRESHOLD - spent)
    near = first[again]
    rows = rows[again]
    at_home = (np.bitwise_count(near ^ low[rows]) <= RADIUS) & (
        np.bitwise_count(second ^ high[rows]) <= RADIUS
    )
    return rows, near | second << BLOCK, at_home


def _replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        prints = pdf["fp"].to_numpy()
        rows, anchors, home = anchors_of(prints)
        yield pd.DataFrame({"anchor": anchors, "fp": prints[rows], "home": home})


class _Forest:
    """Union-find over the homes of a batch."""

    def __init__(self, size: int) -> None:
        self.up = np.arange(size)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def _link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of rows sorted by anchor with the homes first.

    Of a group, only its homes stay in memory when a batch ends inside it. A
    row gives one link and a home one more; those that are linked already
    through another home give none.
    """
    held_key, held = None, np.empty(0, np.int64)
    for pdf in batches:
        if not len(pdf):
            continue
        keys, salts = pdf["anchor"].to_numpy(), pdf["salt"].to_numpy()
        prints, home = pdf["fp"].to_numpy(), pdf["home"].to_numpy()
        if held_key == (keys[0], salts[0]) and len(held):
            keys = np.concatenate([np.full(len(held), keys[0]), keys])
            salts = np.concatenate([np.full(len(held), salts[0]), salts])
            prints = np.concatenate([held, prints])
            home = np.concatenate([np.ones(len(held), bool), home])
        begins = np.flatnonzero(
            np.r_[True, (keys[1:] != keys[:-1]) | (salts[1:] != salts[:-1])]
        )
        sizes = np.diff(np.r_[begins, len(keys)])
        homes = np.add.reduceat(home.astype(np.int64), begins)
        first, count = np.repeat(begins, sizes), np.repeat(homes, sizes)
        label = np.full(len(keys), -1)
        forest = _Forest(len(keys))
        rows = np.flatnonzero(count > 0)
        for k in range(int(homes.max())):
            rows = rows[count[rows] > k]
            at = first[rows] + k
            near = np.bitwise_count((prints[rows] ^ prints[at]).view(np.uint64)) <= THRESHOLD
            linked, by = rows[near], at[near]
            fresh = label[linked] < 0
            label[linked[fresh]] = by[fresh]
            if not fresh.all():
                for i, j in np.unique(np.stack([label[linked[~fresh]], by[~fresh]], 1), axis=0):
                    forest.join(int(i), int(j))
        linked = np.flatnonzero(label >= 0)
        roots = np.array([forest.root(i) for i in label[linked]], np.int64)
        pairs = pd.DataFrame({"a": prints[linked], "b": prints[roots] if len(roots) else roots})
        yield pairs[pairs["a"] != pairs["b"]]
        held_key = (keys[-1], salts[-1])
        held = prints[begins[-1] : begins[-1] + homes[-1]]


def links(prints: DataFrame) -> DataFrame:
    """Spanning links ``a``, ``b`` between distinct fingerprints ``fp``, in each anchor's group.

    Every pair at two or fewer differing bits is connected by them. The rows
    of an anchor with very many homes are compared in as many salts as these
    need: each salt has a part of the homes and all that came to the anchor.
    """
    copies = prints.mapInPandas(_replicate, "anchor long, fp long, home boolean")
    crowded = (
        copies.where("home")
        .groupBy("anchor")
        .count()
        .where(F.col("count") > HOMES_PER_TASK)
        .select("anchor", F.ceil(F.col("count") / HOMES_PER_TASK).cast("int").alias("salts"))
    )
    crowded = frames.written(crowded, "anchors")
    if crowded.isEmpty():
        dealt = copies.withColumn("salt", F.lit(0))
    else:
        # Every copy goes to each salt of its anchor, and is a home in one of them.
        dealt = (
            copies.join(crowded, "anchor", "left")
            .withColumn("salts", F.coalesce("salts", F.lit(1)))
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
            .withColumn("home", F.col("home") & (F.pmod(F.xxhash64("fp"), F.col("salts")) == F.col("salt")))
        )
    return (
        dealt.select("anchor", "salt", "fp", "home")
        .repartition("anchor", "salt")
        .sortWithinPartitions("anchor", "salt", F.desc("home"))
        .mapInPandas(_link, "a long, b long")
    )


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fp``, ``group`` (a fingerprint) and ``component_id`` of every row.

    ``component_id`` is the smallest id that links reach, the row's own
    included. Texts without a word have fingerprint zero and link like others.
    A row without an id keeps its fingerprint and has the id of its group if
    that has one. Rows of one id count as one document; no rows, no result.
    """
    spark = docs.sparkSession
    frames.small_batches(spark)
    prints = frames.written(fingerprints(docs, id_col, text_col), "prints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    frames.small_batches(spark, 8192)
    joined = links(distinct.select("fp"))
    several = (
        prints.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("fp").alias("a"), F.max("fp").alias("z"))
        .where("a != z")
    )
    same_id = several.join(prints, "doc_id").select("a", F.col("fp").alias("b"))
    labels = components(joined.union(same_id))
    classes = distinct.join(labels, distinct.fp == labels.vertex, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("label")
    )
    least = classes.groupBy("label").agg(F.min("first").alias("component_id"))
    named = classes.join(least, "label").select("fp", F.col("label").alias("group"), "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "group", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group of near duplicates the row with the smallest id, all columns kept.

    Of several rows with that id one stays. Rows without an id stay only where
    no row of their group has one: one of them for each group.
    """
    found = groups(docs, id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(frames.as_row(docs), F.col(id_col).cast("long").alias("id"), text.alias("text"))
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("id")).distinct()
    named = rows.drop("text").join(kept, "id", "left_semi").dropDuplicates(["id"])
    nameless = found.where("component_id IS NULL").select("fp", "group").distinct()
    own_print = F.pandas_udf(_own_prints, "long")("text").alias("fp")
    rest = rows.where("id IS NULL").select("row", own_print).join(nameless, "fp").dropDuplicates(["group"])
    return named.select("row").union(rest.select("row")).select("row.*")


def _own_prints(texts: pd.Series) -> pd.Series:
    return pd.Series(_signed(np.fromiter(map(fingerprint, texts), np.uint64, len(texts))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: ``doc_id``, ``fingerprint``, ``component_id``."""
    return groups(frames.documents(spark, sf_dir)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
