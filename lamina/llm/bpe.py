"""Byte-pair encoding with contiguous rank arrays, and decoding.

A word is a row of parts and a row of ranks: the rank of merging each part
with the next one. The least rank is looked up by a scan, the boundary between
the two parts is deleted by moving the rest of the row up, and the ranks on
either side of the new part are refreshed, until no pair has a rank. The words
that a batch of texts brings anew are rows of one matrix and take these steps
together. Words of more than :data:`SHORT` bytes, for which scanning would
cost the square of their length, take the same merges from a heap instead.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import frames

TOKENIZER = "byte_bpe_50k.json"
SHORT = 64
MEMO = 400_000  # words a worker remembers
ROWS = 4096  # words in one matrix
CHARS = 1 << 20  # characters of text that are looked at together

_NONE = np.iinfo(np.int32).max
# Fixed value: the splitting pattern of the tokenizer.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _class_of(test) -> str:
    return "".join(re.escape(chr(c)) for c in range(256) if test(chr(c)))


def _narrow_pattern() -> re.Pattern:
    """The same pattern for texts of the first 256 characters, by the faster module."""
    letters = _class_of(lambda c: regex.match(r"\p{L}", c))
    numbers = _class_of(lambda c: regex.match(r"\p{N}", c))
    space = _class_of(lambda c: regex.match(r"\s", c))
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


_NARROW_WORDS = _narrow_pattern()


def split_words(text: str) -> list[str]:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _WORDS.findall(text)
    return _NARROW_WORDS.findall(text)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file; remembers a bounded number of words."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = _byte_letters()
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*vocabulary.values(), *added.values()])
        self.bytes_of = [b""] * size
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in added.items():
            self.bytes_of[i] = token.encode()
        self.byte_ids = np.zeros(256, np.int32)
        for letter, b in letters.items():
            self.byte_ids[b] = vocabulary[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        self.rank_of = {k: r for k, r in zip(keys.tolist(), range(len(keys)))}
        self.special = added
        self.special_pattern = re.compile("|".join(map(re.escape, added))) if added else None
        self.words: dict[str, bytes] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.key_ranks[at], _NONE)

    def _merge_short(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of about the same length, all rows of the matrix in step."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        width = int(lengths.max())
        columns = np.arange(width + 1)
        flat = np.frombuffer(b"".join(words), np.uint8)
        parts = np.full((len(words), width + 1), -1, np.int32)
        parts[columns[None, :] < lengths[:, None]] = self.byte_ids[flat]
        ranks = np.full((len(words), width + 1), _NONE, np.int32)
        pair = columns[None, :-1] < lengths[:, None] - 1
        rows, at = np.nonzero(pair)
        ranks[rows, at] = self._ranks(parts[rows, at], parts[rows, at + 1])
        done_parts, done_lengths = parts.copy(), lengths.copy()
        place = np.arange(len(words))
        while len(place):
            least = ranks.argmin(axis=1)
            here = np.arange(len(place))
            best = ranks[here, least]
            over = best == _NONE
            if over.any():
                done_parts[place[over]], done_lengths[place[over]] = parts[over], lengths[over]
                going = ~over
                place, parts, ranks, lengths = place[going], parts[going], ranks[going], lengths[going]
                least, best, here = least[going], best[going], here[: going.sum()]
                if not len(place):
                    break
            moved = np.minimum(columns + (columns[None, :] > least[:, None]), width)
            parts = np.take_along_axis(parts, moved, 1)
            after = np.minimum(columns + (columns[None, :] >= least[:, None]), width)
            ranks = np.take_along_axis(ranks, after, 1)
            parts[here, least] = self.merged[best]
            lengths = lengths - 1
            parts[here, lengths] = -1
            for side in (least - 1, least):
                inside = (side >= 0) & (side + 1 < lengths)
                ranks[here[inside], side[inside]] = self._ranks(
                    parts[here[inside], side[inside]], parts[here[inside], side[inside] + 1]
                )
                outside = (side >= 0) & ~inside
                ranks[here[outside], side[outside]] = _NONE
        kept = columns[None, :] < done_lengths[:, None]
        packed = done_parts[kept].astype("<u4").tobytes()
        ends = (4 * np.cumsum(done_lengths)).tolist()
        return [packed[i:j] for i, j in zip([0, *ends], ends)]

    def _merge_long(self, word: bytes) -> bytes:
        """The same merges through a heap over a linked list of parts."""
        parts = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        following = [*range(1, len(parts)), -1]
        before = [-1, *range(len(parts) - 1)]
        waiting = []

        def offer(i: int) -> None:
            j = following[i] if i >= 0 else -1
            if j >= 0 and (rank := self.rank_of.get(parts[i] << 32 | parts[j])) is not None:
                heapq.heappush(waiting, (rank, i, parts[i], parts[j]))

        for i in range(len(parts)):
            offer(i)
        while waiting:
            rank, i, left, right = heapq.heappop(waiting)
            j = following[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue
            parts[i], parts[j] = int(self.merged[rank]), -1
            following[i] = following[j]
            if following[j] >= 0:
                before[following[j]] = i
            offer(before[i])
            offer(i)
        return np.array([p for p in parts if p >= 0], "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        coded = [w.encode() for w in words]
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        order = np.argsort(lengths, kind="stable")
        short = order[: int((lengths <= SHORT).sum())].tolist()
        for low in range(0, len(short), ROWS):
            some = short[low : low + ROWS]
            ids = self._merge_short([coded[i] for i in some])
            self.words.update(zip([words[i] for i in some], ids))
        for i in order[len(short) :].tolist():
            self.words[words[i]] = self._merge_long(coded[i])

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without special tokens."""
        if len(self.words) > MEMO:  # the older half goes
            for word in list(islice(self.words, MEMO // 2)):
                del self.words[word]
        cut = [split_words(t) for t in texts]
        known = self.words
        if missing := set().union(*cut).difference(known):
            self._learn(list(missing))
        coded = [b"".join([known[w] for w in words]) for words in cut]
        for word in missing:
            if len(word) > SHORT:
                del known[word]
        return coded

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        pieces, owners = [], []
        for i, text in enumerate(texts):
            if self.special_pattern is None or not self.special_pattern.search(text):
                pieces.append(text)
                owners.append((i, None))
                continue
            at = 0
            for m in self.special_pattern.finditer(text):
                pieces += [text[at : m.start()], ""]
                owners += [(i, None), (i, np.array([self.special[m[0]]], "<u4").tobytes())]
                at = m.end()
            pieces.append(text[at:])
            owners.append((i, None))
        out: list[list[bytes]] = [[] for _ in texts]
        for low, high in _runs(pieces):
            ids = self._encode_plain(pieces[low:high])
            for (i, own), coded in zip(owners[low:high], ids):
                out[i].append(coded if own is None else own)
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def decode(self, ids: bytes) -> str:
        table = self.bytes_of
        parts = [table[i] for i in np.frombuffer(ids, "<u4").tolist()]
        return b"".join(parts).decode("utf-8", "replace")


def _runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of up to :data:`CHARS` characters together, or one longer one."""
    low = size = 0
    for i, text in enumerate(texts):
        if i > low and size + len(text) > CHARS:
            yield low, i
            low, size = i, 0
        size += len(text)
    if low < len(texts):
        yield low, len(texts)


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def _path(name: str) -> str:
    return public_tokenizers.path(name)


def encode(docs: DataFrame, tokenizer: str = TOKENIZER, decoded: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) of every row.

    With ``decoded`` also ``decoded``, the text that the ids give back. A null
    or empty text has no ids. Special tokens that stand in a text get their
    own id. Repeated rows give repeated results; no rows, no result.
    """
    schema = "doc_id long, n_tokens long, ids binary" + ", decoded string" * decoded

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(_path(tokenizer))
        for pdf in batches:
            ids = own.encode(pdf["text"].tolist())
            out = {"doc_id": pdf["doc_id"], "n_tokens": [len(x) // 4 for x in ids], "ids": ids}
            yield pd.DataFrame(out | {"decoded": [own.decode(x) for x in ids]} if decoded else out)

    frames.small_batches(docs.sparkSession)
    return frames.whole_text(docs).mapInPandas(run, schema)


def decode(coded: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id``, ``text`` from ``doc_id`` and ``ids``; null ids give the empty text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(_path(tokenizer))
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": [own.decode(x or b"") for x in pdf["ids"]]})

    return coded.select(F.col("doc_id").cast("long"), "ids").mapInPandas(run, "doc_id long, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the ids and of the decoded text of every document."""
    return encode(frames.documents(spark, sf_dir), decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )
