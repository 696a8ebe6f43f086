"""Document quality by attention-based multiple-instance learning.

A text is a bag of passages of one size, however long it is. Every passage is
encoded by itself, as the frequencies of pairs of character classes in it and a
few measures of its words and lines; nothing of the rest of the text goes into
it. Gated attention gives each passage a weight, ``softmax(w .
(tanh(V x) * sigmoid(U x)))``, the weighted sum of the passages' hidden
representations stands for the document, and a logistic unit scores it. Only
documents have labels; which passages matter is learnt from them.

Training takes every labelled document that is not held out, with all of its
passages: the executors encode them once, some documents to a row, and every
step of the descent is a job that adds up the gradient over all rows. Only sums
as wide as the weights reach the driver, as whole numbers, so that they do not
depend on the order in which tasks end. Scoring is a scan that reads all passages of every text, a
block at a time: the softmax is carried on as its largest energy so far, the sum
of weights and the weighted sum, so a text needs the memory of one block.

A null text counts as empty, and an empty one is a bag of one empty passage.
Repeated rows get equal scores, an empty table gives no rows, and without
labels of both kinds every score is the mean of those there are, or 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm import frames

PASSAGE = 400  # bytes of a passage, at every length of text
BAG = 64  # passages that an excerpt of a text has at most; training and scoring take all
CHUNK = 64  # documents, or so, that are encoded as one row for the training
BLOCK = 64  # passages that are encoded and weighed at once
HIDDEN = 16
EPOCHS, RATE, DECAY = 200, 0.02, 1e-3
# Sums over rows are of whole multiples of these, which add up alike in every order.
MOMENT_UNIT, GRADIENT_UNIT = 2.0**-20, 2.0**-32

# Classes of bytes; letters, digits, space and bytes beyond ASCII have their own.
_SIGNS = [".,;:", "!?", "\"'()[]", "|", "#$%&*@^~`", "-_=+/\\<>{}"]
_CLASSES = 6 + len(_SIGNS) + 1
_PAIRS = _CLASSES * _CLASSES
_MEASURES = 7
WIDTH = _PAIRS + _MEASURES


def _class_table() -> np.ndarray:
    table = np.full(256, _CLASSES - 1, np.int64)
    for b in range(256):
        c = chr(b)
        if b >= 0x80:
            table[b] = 5
        elif c.islower():
            table[b] = 0
        elif c.isupper():
            table[b] = 1
        elif c.isdigit():
            table[b] = 2
        elif c == " ":
            table[b] = 3
        elif c in "\n\r\t":
            table[b] = 4
    for i, signs in enumerate(_SIGNS):
        for c in signs:
            table[ord(c)] = 6 + i
    return table


_TABLE = _class_table()


def _measures(piece: bytes) -> tuple[float, ...]:
    """How long a passage is, and how much its words and lines repeat and vary."""
    words, lines = piece.split(), piece.split(b"\n")
    lengths = list(map(len, words))
    n, distinct = len(words), len(set(words))
    mean = sum(lengths) / max(1, n)
    spread = max(0.0, sum(x * x for x in lengths) / max(1, n) - mean * mean)
    return (
        math.log1p(len(piece)), math.log1p(n), distinct / max(1, n), distinct / max(1, n) ** 0.8,
        mean, math.sqrt(spread), len(set(lines)) / len(lines),
    )


def _encode(raw: bytes, begin: int, end: int) -> np.ndarray:
    """One row of features for every passage between two bytes."""
    count = max(1, -(-(end - begin) // PASSAGE))
    out = np.zeros((count, WIDTH), np.float32)
    classes = _TABLE[np.frombuffer(raw[begin : end + 1], np.uint8)]
    if len(classes) > 1:
        owner = np.arange(len(classes) - 1) // PASSAGE
        pairs = classes[:-1] * _CLASSES + classes[1:]
        counts = np.bincount(owner * _PAIRS + pairs, minlength=count * _PAIRS).reshape(count, _PAIRS)
        out[:, :_PAIRS] = np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))
    out[:, _PAIRS:] = [_measures(raw[at : min(at + PASSAGE, end)]) for at in range(begin, begin + count * PASSAGE, PASSAGE)]
    return out


def blocks(text: str) -> Iterator[np.ndarray]:
    """Features of all passages of the whole text, some passages at a time; an empty text has one."""
    raw = text.encode("utf-8", "surrogatepass")
    for begin in range(0, max(1, len(raw)), BLOCK * PASSAGE):
        yield _encode(raw, begin, min(len(raw), begin + BLOCK * PASSAGE))


def bag_of(text: str) -> np.ndarray:
    """Features of at most :data:`BAG` passages, first and last among them."""
    raw = text.encode("utf-8", "surrogatepass")
    count = max(1, -(-len(raw) // PASSAGE))
    if count <= BAG:
        return _encode(raw, 0, len(raw))
    chosen = np.linspace(0, count - 1, BAG).astype(int).tolist()
    return np.concatenate([_encode(raw, i * PASSAGE, min(len(raw), (i + 1) * PASSAGE)) for i in chosen])


def _chunk(pdf: pd.DataFrame) -> pd.DataFrame:
    """Labels, numbers of passages and features of a few documents, in order of their ids."""
    pdf = pdf.sort_values("doc_id")
    sizes, parts = np.zeros(len(pdf), np.int64), []
    for n, text in enumerate(pdf["text"]):
        for some in blocks(text):
            sizes[n] += len(some)
            parts.append(_sparse(some))
    labels = pdf["label"].to_numpy(np.float32)
    made = {"labels": labels, "sizes": sizes} | {k: np.concatenate(v) for k, v in zip(_SPARSE, zip(*parts))}
    return pd.DataFrame({k: [v.tobytes()] for k, v in made.items()})


# Most pairs don't occur in a passage, so a chunk holds what is not zero: how many
# features of a passage are not, which ones, and their values.
_SPARSE = ("filled", "places", "values")
CHUNKS = ", ".join(f"{c} binary" for c in ("labels", "sizes", *_SPARSE))


def _sparse(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, places = np.nonzero(x)
    return np.bincount(rows, minlength=len(x)).astype(np.uint8), places.astype(np.uint8), x[rows, places]


def _dense(filled: bytes, places: bytes, values: bytes) -> np.ndarray:
    """The features that :func:`_sparse` was given, exactly."""
    counts = np.frombuffer(filled, np.uint8)
    x = np.zeros((len(counts), WIDTH), np.float32)
    begins = np.repeat(np.arange(0, len(counts) * WIDTH, WIDTH), counts)
    x.reshape(-1)[begins + np.frombuffer(places, np.uint8)] = np.frombuffer(values, np.float32)
    return x


def _summed(chunks: DataFrame, of_chunk: Callable[..., np.ndarray], unit: float) -> np.ndarray:
    """The sum over all chunks of what a function makes of labels, sizes and features, exact in ``unit``."""

    def of_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            for labels, sizes, *sparse in pdf.itertuples(index=False):
                made = of_chunk(np.frombuffer(labels, np.float32), np.frombuffer(sizes, np.int64), _dense(*sparse))
                whole = np.rint(made / unit).astype(np.int64)
                total = whole if total is None else total + whole
        if total is not None:
            yield pd.DataFrame({"total": [total.tobytes()]})

    rows = chunks.mapInPandas(of_task, "total binary").collect()  # a row a task
    # Python's integers hold any sum.
    totals = [np.frombuffer(r["total"], np.int64).astype(object) for r in rows]
    return (sum(totals[1:], totals[0]) * unit).astype(np.float64) if totals else np.zeros(0)


def _moments(labels: np.ndarray, sizes: np.ndarray, x: np.ndarray) -> np.ndarray:
    wide = x.astype(np.float64)
    return np.r_[len(labels), labels.sum(), len(x), wide.sum(axis=0), (wide * wide).sum(axis=0)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardized and clipped, so that a few characters don't outweigh everything else."""
    return np.clip((x - mean) / scale, -3, 3)


@dataclass
class Model:
    """Weights of a fitted network; without any, every score is the labels' mean."""

    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None

    def score(self, text: str) -> float:
        if self.weights is None:
            return self.prior
        w = self.weights
        top, total, bag = -np.inf, 0.0, np.zeros(HIDDEN)
        for some in blocks(text):
            hidden, energy = _passage_layers(w, _scaled(some, self.mean, self.scale))[2:]
            higher = max(top, float(energy.max()))
            raw, kept = np.exp(energy - higher), np.exp(top - higher)
            total, bag, top = total * kept + raw.sum(), bag * kept + raw @ hidden, higher
        return float(_sigmoid(bag / total @ w["c"] + w["b"][0]))


def _passage_layers(w: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, ...]:
    """``tanh``, ``gate``, hidden representation and energy of every passage by itself."""
    tanh, gate = np.tanh(x @ w["V"]), _sigmoid(x @ w["U"])
    return tanh, gate, np.tanh(x @ w["E"] + w["e"]), (tanh * gate) @ w["w"]


def _forward(w: dict[str, np.ndarray], x: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
    """All layers for bags that lie one behind the other from ``begins`` on."""
    sizes = np.diff(np.r_[begins, len(x)])
    tanh, gate, hidden, energy = _passage_layers(w, x)
    top = np.repeat(np.maximum.reduceat(energy, begins), sizes)
    raw = np.exp(energy - top)
    attention = raw / np.repeat(np.add.reduceat(raw, begins), sizes)
    bag = np.add.reduceat(attention[:, None] * hidden, begins)
    return {
        "tanh": tanh, "gate": gate, "hidden": hidden, "attention": attention, "bag": bag, "sizes": sizes,
        "p": _sigmoid(bag @ w["c"] + w["b"][0]),
    }


def _gradient(
    w: dict[str, np.ndarray], x: np.ndarray, begins: np.ndarray, labels: np.ndarray
) -> dict[str, np.ndarray]:
    f = _forward(w, x, begins)
    error = (f["p"] - labels) / len(labels)
    at_bag = np.repeat(np.outer(error, w["c"]), f["sizes"], axis=0)
    a = f["attention"]
    at_hidden = a[:, None] * at_bag * (1 - f["hidden"] ** 2)
    pull = np.einsum("ij,ij->i", at_bag, f["hidden"])
    mean = np.repeat(np.add.reduceat(a * pull, begins), f["sizes"])
    at_energy = (a * (pull - mean))[:, None]
    inner = at_energy * w["w"]
    return {
        "V": x.T @ (inner * f["gate"] * (1 - f["tanh"] ** 2)),
        "U": x.T @ (inner * f["tanh"] * f["gate"] * (1 - f["gate"])),
        "w": (at_energy * f["tanh"] * f["gate"]).sum(axis=0),
        "E": x.T @ at_hidden,
        "e": at_hidden.sum(axis=0),
        "c": f["bag"].T @ error,
        "b": np.array([error.sum()]),
    }


def _slopes(
    w: dict[str, np.ndarray], mean: np.ndarray, scale: np.ndarray, labels: np.ndarray, sizes: np.ndarray, x: np.ndarray
) -> np.ndarray:
    """The gradient of the documents' summed loss, all weights behind each other."""
    begins = np.cumsum(sizes) - sizes
    slopes = _gradient(w, _scaled(x, mean, scale), begins, labels)
    return np.concatenate([slopes[k].ravel() for k in w]).astype(np.float64) * len(labels)


def fit(chunks: DataFrame) -> Model:
    """The network for documents encoded by :func:`_chunk`, by Adam on all of them at once."""
    found = _summed(chunks, _moments, MOMENT_UNIT)
    documents, positive, passages = found[:3] if len(found) else (0, 0, 0)
    prior = float(positive / documents) if documents else 0.5
    if positive in (0, documents):
        return Model(prior)
    mean, square = found[3 : 3 + WIDTH] / passages, found[3 + WIDTH :] / passages
    scale = (np.sqrt(np.maximum(square - mean * mean, 0)) + 0.02).astype(np.float32)
    mean = mean.astype(np.float32)
    random = np.random.default_rng(0)
    weights = {
        "V": random.normal(0, WIDTH**-0.5, (WIDTH, HIDDEN)),
        "U": random.normal(0, WIDTH**-0.5, (WIDTH, HIDDEN)),
        "w": random.normal(0, HIDDEN**-0.5, HIDDEN),
        "E": random.normal(0, WIDTH**-0.5, (WIDTH, HIDDEN)),
        "e": np.zeros(HIDDEN),
        "c": random.normal(0, HIDDEN**-0.5, HIDDEN),
        "b": np.array([np.log(prior / (1 - prior))]),
    }
    weights = {k: v.astype(np.float32) for k, v in weights.items()}
    ends = np.cumsum([v.size for v in weights.values()])[:-1]
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    for step in range(1, EPOCHS + 1):
        rate = RATE * (1 - step / (EPOCHS + 1))
        slopes = _summed(chunks, partial(_slopes, dict(weights), mean, scale), GRADIENT_UNIT) / documents
        for (k, held), g in zip(list(weights.items()), np.split(slopes, ends)):
            g = g.reshape(held.shape) + DECAY * held * (held.ndim > 1)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            ahead = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            weights[k] = (held - rate * ahead).astype(np.float32)
    return Model(prior, mean, scale, weights)


def is_held_out(doc_id: str = "doc_id") -> Column:
    """A third of the ids, by the checksum of their text; never a row without one."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The model from all labelled documents that are not held out.

    Several labels of one document count as their mean, rounded up; rows without
    an id or label don't count. Of rows that repeat an id one text counts, by
    its hash, and only that one is encoded.
    """
    spark = docs.sparkSession
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .where(~is_held_out())
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    )
    groups = max(1, math.ceil(chosen.count() / CHUNK))
    texts = frames.whole_text(docs)
    some = texts.join(chosen, texts.doc_id == chosen.id).select("doc_id", "text", "label")
    # Spark limits every id to one row in each task before the shuffle, however many repeat it.
    own = W.partitionBy("doc_id").orderBy(F.xxhash64("text"), F.xxhash64("text", F.lit(1)))
    once = some.withColumn("n", F.row_number().over(own)).where("n = 1").drop("n")
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(groups))
    encoded = once.groupBy(chunk).applyInPandas(_chunk, CHUNKS)
    with frames.Scratch(spark) as scratch, frames.batches_of(spark, 16):
        return fit(scratch.written(encoded, "passages"))


def score_of(model: Model, text: str = "text") -> Column:
    """The score of a text column, between 0 and 1; a null text is empty."""

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return scores(F.coalesce(F.col(text).cast("string"), F.lit("")))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row; one without an id is not held out."""
    model = train(docs, labels)
    frames.small_batches(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), is_held_out().alias("held_out"), score_of(model).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model doesn't reject, all columns kept.

    Rows are judged one by one by their text, whatever their id; a null text as an empty one.
    """
    model = train(docs, labels)
    frames.small_batches(docs.sparkSession)
    return docs.where(score_of(model) >= 0.5)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    return scored(frames.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
