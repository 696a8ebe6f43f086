"""Document fingerprints by spot signatures.

A signature starts at an anchor, a common word, and is the chain of the next
content words behind it; a text's fingerprint is the set of its signatures.
Prose is full of anchors, while tables, menus and other frame have few, so the
set stands for what a text says. Sets are compared by Jaccard's likeness: only
those whose lengths allow the threshold, and a pair is given up as soon as
what is left cannot reach it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import frames

CHAIN = 3
THRESHOLD = 0.8
ROWS_PER_RANGE = 2048
MEMO = 400_000  # words a worker remembers

# Common words of English, German, French and Spanish.
ANCHORS = """
the of and to in a is that it for on was as with be by are this at from
der die das und den von zu mit des im dem nicht ein eine auf ist
de la le et les des un une du que est en pour dans
el y los las por con para se del una
""".split()

_WORDS = re.compile(r"[^\W_]+")
_DIGITS = 8  # hex digits of a signature in a fingerprint


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_hashes = _Hashes()
_anchors = np.sort(np.array([xxhash.xxh64_intdigest(w) for w in set(ANCHORS)], np.uint64))


def signatures(text: str) -> np.ndarray:
    """Sorted distinct signatures of a whole text.

    A text without any (no anchor, or too few content words behind) has one,
    of all its words; so equal texts always have equal sets, and none is empty.
    """
    words = _WORDS.findall(text.lower())
    if len(_hashes) > MEMO:
        _hashes.clear()
    hashes = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    at = np.minimum(np.searchsorted(_anchors, hashes), len(_anchors) - 1)
    anchor = _anchors[at] == hashes
    content = hashes[~anchor]
    before = np.cumsum(~anchor)[anchor]
    starts = before <= len(content) - CHAIN
    before, chain = before[starts], hashes[anchor][starts]
    for k in range(CHAIN):
        chain = (chain ^ chain >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) + content[before + k]
    if not len(chain):
        chain = np.array([xxhash.xxh64_intdigest(" ".join(words))], np.uint64)
    chain = (chain ^ chain >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
    return np.unique(chain >> np.uint64(32)).astype(np.uint32)


def spelled(found: np.ndarray) -> str:
    """A set as text: its signatures in order, eight hex digits each."""
    return found.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard's likeness of two sorted sets; 0 where the lengths alone keep it under ``least``."""
    few, many = sorted((len(a), len(b)))
    if not few or few < least * many:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (few + many - both)


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame(
            {"doc_id": pdf["doc_id"], "fingerprint": [spelled(signatures(t)) for t in pdf["text"]]}
        )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` of every row; a null text is empty, rows without an id keep theirs."""
    frames.small_batches(docs.sparkSession)
    texts = frames.whole_text(docs, id_col, text_col)
    return texts.mapInPandas(_fingerprints, "doc_id long, fingerprint string")


def similar(prints: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``a``, ``b``, ``likeness`` of different fingerprints at the threshold or above.

    ``a`` and ``b`` are the smallest ids of the two fingerprints; rows that
    share one are not expanded into pairs, and rows without an id take no part.
    Sets are partitioned by length, in steps of the threshold, so that a set
    only meets its own and the next longer partition. In there it is listed
    under the first signatures of its order alone: sets that agree on none of
    these cannot reach the threshold.
    """
    spark = prints.sparkSession
    every = F.sequence(F.lit(1), F.length("fingerprint"), F.lit(_DIGITS))
    sets = frames.written(
        prints.where("doc_id IS NOT NULL")
        .groupBy("fingerprint")
        .agg(F.min("doc_id").alias("id"))
        .where(F.length("fingerprint") > 0)
        .select(
            "id",
            F.transform(every, lambda i: F.substring("fingerprint", i, F.lit(_DIGITS))).alias("sigs"),
        )
        .withColumn("size", F.size("sigs"))
        .withColumn("part", F.floor(F.log(F.col("size").cast("double")) / -math.log(threshold))),
        "spots",
    )
    needed = F.ceil(F.lit(threshold) * F.col("size") - F.lit(1e-9))
    listed = sets.select(
        "id", "size", "part", F.explode(F.slice("sigs", 1, (F.col("size") - needed + 1).cast("int"))).alias("sig")
    )
    own = listed.select(F.col("id").alias("a"), F.col("size").alias("n"), "sig", F.col("part").alias("part"))
    met = listed.select(
        F.col("id").alias("b"), F.col("size").alias("m"), "sig",
        F.explode(F.array("part", F.col("part") - 1)).alias("part"),
    )
    pairs = (
        own.join(met, ["sig", "part"])
        .where("a != b AND m >= n AND (m > n OR a < b)")
        .where(F.col("n") >= F.col("m") * threshold - 1e-9)
        .select("a", "b")
        .distinct()
    )
    left = sets.select(F.col("id").alias("a"), F.col("sigs").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("sigs").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    likeness = both / (F.size("x") + F.size("y") - both)
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), likeness.alias("likeness"))
        .where(F.col("likeness") >= threshold - 1e-12)
    )


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_signatures long"
)


def _beside_next(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every document with the one behind it, in rows sorted by range and id.

    A range ends with a copy of the next range's first document.
    """
    held = None
    for pdf in batches:
        out = []
        for number, ahead, doc_id, text in zip(pdf["range"], pdf["ahead"], pdf["doc_id"], pdf["text"]):
            found = signatures(text)
            if held and held[0] == number:
                _, last_id, last, own = held
                keep = len(last) - len(last) // 2
                edited = last[:keep] + text[: len(last) - keep]
                new = signatures(edited)
                out.append(
                    (
                        None if last_id == frames.NO_ID else last_id,
                        len(last),
                        hashlib.sha256(edited.encode()).hexdigest(),
                        spelled(own),
                        spelled(new),
                        likeness(own, new),
                        likeness(own, found),
                        len(own),
                    )
                )
            held = None if ahead else (number, doc_id, text, found)
        made = pd.DataFrame(out, columns=[f.split()[0] for f in EDITED.split(", ")])
        yield made.astype({"doc_id": "Int64"})


def beside_next(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Fingerprints of every row and of its text edited with the next row's, and their likeness.

    The next row is that of the next id; rows of one id go by their texts, rows
    without an id come first, and the last row is followed by the first. A
    text's last half (rounded down, in code points) gives way to as much of the
    next one's beginning. Texts are shuffled once, in ranges of ids; only a
    range's first document goes to two.
    """
    frames.small_batches(docs.sparkSession)
    texts = frames.whole_text(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(int(frames.NO_ID))))
    dealt, firsts = frames.id_ranges(texts, "doc_id", rows_per_range)
    order = list(firsts)
    before = {firsts[r]: order[i - 1] for i, r in enumerate(order)}

    @F.pandas_udf("array<struct<range: int, ahead: boolean>>")
    def places(numbers: pd.Series, ids: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [{"range": n, "ahead": False}, *([{"range": before[i], "ahead": True}] if i in before else [])]
                for n, i in zip(numbers.tolist(), ids.tolist())
            ]
        )

    return (
        dealt.select(F.explode(places("range", "doc_id")).alias("place"), "doc_id", "text")
        .select("place.range", "place.ahead", "doc_id", "text")
        .repartition("range")
        .sortWithinPartitions("range", "ahead", "doc_id", "text")
        .mapInPandas(_beside_next, EDITED)
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return beside_next(frames.documents(spark, sf_dir))
