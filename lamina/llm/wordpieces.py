"""The tokenizers library behind a memo; ids are exactly the library's.

The word vocabulary drops white space and cuts texts into words, digits and
runs of signs, each coded by itself. So the library is asked once for every
piece that a worker doesn't remember, and a text's ids are its chunks' ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

TOKENIZER = "word_bpe_49k.json"
MEMO = 500_000  # chunks and pieces a worker remembers
SHORT = 64  # characters of the longest that it remembers
AT_ONCE = 4096  # chunks in one call of the library
CHARS = 1 << 20  # characters of text that are looked at together

# Texts of these characters alone are cut here: none of them is changed by the
# normal form, each has one small letter, and white space is what it looks like.
_PLAIN = re.compile("[\t\n\r -~À-ÿ]*")
_PIECES = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")
# In any other text no piece reaches across a space or a line's end.
_CHUNKS = re.compile("[^ \n]+")


def _spelled(piece: str) -> str:
    """The piece in the letters of the byte-level alphabet; all its bytes are printable or at least 0x80."""
    return piece if piece.isascii() else "".join(map(_LETTERS.__getitem__, piece.encode()))


def _letters() -> list[str]:
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


_LETTERS = _letters()


class Pieces:
    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        # Of plain texts, chunks and pieces; a piece has the ids of the chunk of its spelling.
        self.known: dict[str, bytes] = {}
        self.odd: dict[str, bytes] = {}

    def _cut(self, text: str) -> tuple[bool, list[str]]:
        """Whether the text is plain, and its chunks between white space."""
        if _PLAIN.fullmatch(text) and not (self.special and self.special.search(text)):
            return True, text.lower().split()
        return False, _CHUNKS.findall(text)

    def _learn(self, chunks: set[str]) -> None:
        """Chunks of plain texts: the model codes each of their pieces. Adds long pieces to the chunks."""
        known, tokenize = self.known, self.library.model.tokenize
        cut = {c: _PIECES.findall(c) for c in chunks}
        pieces = set().union(*cut.values()).difference(known)
        for piece in pieces:
            known[piece] = np.array([t.id for t in tokenize(_spelled(piece))], "<u4").tobytes()
        known.update((c, b"".join([known[p] for p in found])) for c, found in cut.items())
        chunks.update(p for p in pieces if len(p) > SHORT)

    def _learn_odd(self, chunks: list[str]) -> None:
        """Chunks of other texts go through the whole tokenizer."""
        for i in range(0, len(chunks), AT_ONCE):
            some = chunks[i : i + AT_ONCE]
            for chunk, coded in zip(some, self.library.encode_batch_fast(some, add_special_tokens=False)):
                self.odd[chunk] = np.array(coded.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        low = size = 0
        for i, text in enumerate(texts):
            if i > low and size + len(text) > CHARS:
                out += self._encode(texts[low:i])
                low, size = i, 0
            size += len(text)
        return out + self._encode(texts[low:])

    def _encode(self, texts: list[str]) -> list[bytes]:
        for memo in (self.known, self.odd):
            if len(memo) > MEMO:  # the older half goes
                for chunk in list(islice(memo, MEMO // 2)):
                    del memo[chunk]
        cut = [self._cut(t) for t in texts]
        fresh = set().union(*(c for plain, c in cut if plain)).difference(self.known)
        fresh_odd = set().union(*(c for plain, c in cut if not plain)).difference(self.odd)
        self._learn(fresh)
        self._learn_odd(list(fresh_odd))
        coded = [b"".join(map((self.known if plain else self.odd).__getitem__, c)) for plain, c in cut]
        for memo, chunks in ((self.known, fresh), (self.odd, fresh_odd)):
            for chunk in chunks:
                if len(chunk) > SHORT:
                    memo.pop(chunk, None)
        return coded


@cache
def _of(path: str) -> Pieces:
    return Pieces(path)


def pieces(tokenizer: str = TOKENIZER) -> Pieces:
    """The memo of this worker for a tokenizer's file."""
    return _of(public_tokenizers.path(tokenizer))


def coded(batches: Iterator[pd.DataFrame], tokenizer: str, end: int) -> Iterator[tuple[int, bytes]]:
    """Id and token ids of every row of ``doc_id``, ``text``, with the end id behind."""
    last = np.array([end], "<u4").tobytes()
    own = pieces(tokenizer)
    for pdf in batches:
        ids = own.encode(pdf["text"].tolist())
        yield from zip(pdf["doc_id"].tolist(), (x + last for x in ids))
