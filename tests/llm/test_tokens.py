"""BPE, token files and packing: against the library, round trips, and odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lamina.llm import bpe, dac, packing, token_files, wordpieces

from .conftest import LONG, ODD

SF = "/root/testdata/sf0.001"
LETTERS = "ab <'|\n\t\x1c\x85\xa0é日🙂1²$-ÀΣİ́Ss×"


def scraps(n=1500):
    chance = random.Random(4)
    return ["".join(chance.choices(LETTERS, k=chance.randint(0, 50))) for _ in range(n)]


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(public_tokenizers.path(wordpieces.TOKENIZER))


def expected(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def test_bpe_equals_the_library(byte_library):
    own = bpe.Codec(public_tokenizers.path(bpe.TOKENIZER))
    texts = [*scraps(), "", "a" * 3000, "ab" * 700, "x<|endoftext|>y<|endoftext|>", LONG, "  \n  b  "]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids == expected(byte_library, text), text[:80]
        library = byte_library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        assert own.decode(ids) == library


def test_rank_array_and_heap_merge_alike():
    own = bpe.Codec(public_tokenizers.path(bpe.TOKENIZER))
    words = [s.encode() for s in scraps(300) if s]
    assert own._merge_short(words) == [own._merge_long(w) for w in words]


def test_bpe_memo_is_bounded(monkeypatch, byte_library):
    monkeypatch.setattr(bpe, "MEMO", 50)
    monkeypatch.setattr(bpe, "CHARS", 200)
    own = bpe.Codec(public_tokenizers.path(bpe.TOKENIZER))
    texts = scraps(200)
    assert own.encode(texts) == [expected(byte_library, t) for t in texts]
    assert len(own.words) < 400


def test_bpe_query_and_round_trip(spark, byte_library, sf_texts):
    found = {r["doc_id"]: r for r in bpe.query(spark, SF).collect()}
    assert found.keys() == sf_texts.keys()
    for i, text in sf_texts.items():
        ids = expected(byte_library, text)
        assert found[i]["n_tokens"] == len(ids) // 4
        assert found[i]["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_odd_rows(odd, nothing, byte_library):
    coded = bpe.encode(odd)
    got = sorted((str(r["doc_id"]), bytes(r["ids"])) for r in coded.collect())
    assert got == sorted((str(i), expected(byte_library, t)) for i, t in ODD)
    texts = sorted((str(r["doc_id"]), r["text"]) for r in bpe.decode(coded).collect())
    assert texts == sorted((str(i), t or "") for i, t in ODD)
    assert bpe.encode(nothing).count() == 0


def test_memo_equals_the_library(word_library, monkeypatch):
    monkeypatch.setattr(wordpieces, "MEMO", 100)
    own = wordpieces.Pieces(public_tokenizers.path(wordpieces.TOKENIZER))
    texts = [*scraps(), "", LONG, "a" * 3000, "<|startoftext|>x<|ENDOFTEXT|>", "''s 're're ÀÉß ÷×", "ΣΑΣ İı"]
    assert own.encode(texts) == [expected(word_library, t) for t in texts]
    assert max(map(len, own.known), default=0) <= wordpieces.SHORT


@pytest.mark.parametrize("bits", [8, 16])
@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
def test_codes_give_any_token(n, bits):
    chance = np.random.default_rng(n)
    values = (chance.integers(0, 2**32, n) >> chance.integers(0, 32, n)).astype(np.uint32)
    codes = dac.Reader(dac.encode(values, bits))
    assert [codes[i] for i in range(n)] == values.tolist()
    assert codes.run(n // 3, n).tolist() == values[n // 3 :].tolist()
    with pytest.raises(IndexError):
        codes[n]


def test_codes_refuse_what_they_are_not():
    with pytest.raises(ValueError):
        dac.Reader(b"DAC9" + bytes(30))
    with pytest.raises(ValueError):
        dac.encode(np.zeros(1, np.uint32), 5)


def test_token_files(spark, word_library, sf_texts, monkeypatch):
    monkeypatch.setattr(token_files, "TOKENS_PER_BLOCK", 5000)
    found = {r["doc_id"]: r for r in token_files.query(spark, SF).collect()}
    start = 0
    for i in sorted(sf_texts):
        ids = expected(word_library, sf_texts[i]) + np.array([1], "<u4").tobytes()
        row = found[i]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4


def test_token_files_odd_rows_and_random_access(spark, odd, nothing, word_library, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write(odd, path)
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r["start"])
    order = sorted(ODD, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    assert [r["doc_id"] for r in got] == [i for i, _ in order]
    every = b"".join(expected(word_library, t) + np.array([1], "<u4").tobytes() for _, t in order)
    assert b"".join(bytes(r["ids"]) for r in got) == every
    tokens = np.frombuffer(every, "<u4")
    places = [0, 1, len(tokens) // 2, len(tokens) - 1, len(tokens), None]
    asked = spark.createDataFrame([(p,) for p in places], "place long")
    found = {r["place"]: r["token"] for r in token_files.tokens_at(spark, path, asked).collect()}
    assert found == {p: int(tokens[p]) for p in places[:4]}
    token_files.write(nothing, str(tmp_path / "none"))
    assert token_files.read(spark, str(tmp_path / "none")).count() == 0


def histogram(values):
    sizes, counts = np.unique(values, return_counts=True)
    return dict(zip(sizes.tolist(), counts.tolist()))


def best_fit_decreasing(found, capacity):
    from bisect import bisect_left, insort

    gaps, bins = [], 0
    for size, n in sorted(found.items(), reverse=True):
        for _ in range(n):
            at = bisect_left(gaps, size)
            if at == len(gaps):
                bins += 1
                insort(gaps, capacity - size)
            else:
                insort(gaps, gaps.pop(at) - size)
    return bins


@pytest.mark.parametrize("low,high", [(1, 2049), (500, 1300), (600, 720), (1, 60), (2048, 2049)])
def test_plan_holds_every_length_and_is_tight(low, high):
    found = histogram(np.random.default_rng(1).integers(low, high, 4000))
    made = packing.plan(found)
    held: dict[int, int] = {}
    for bins in made:
        assert sum(bins.lengths) <= packing.CAPACITY
        for length in bins.lengths:
            held[length] = held.get(length, 0) + bins.count
    assert held == found
    assert sum(b.count for b in made) <= best_fit_decreasing(found, packing.CAPACITY)


def test_plan_of_nothing_and_of_the_impossible():
    assert packing.plan({}) == []
    with pytest.raises(ValueError):
        packing.plan({2049: 1})


def check_packed(found, word_library, texts):
    by_sequence: dict[int, list] = {}
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    got = sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found)
    want = []
    for i, text in texts:
        ids = expected(word_library, text) + np.array([0], "<u4").tobytes()
        for k, at in enumerate(range(0, len(ids), 8192)):
            cut = ids[at : at + 8192]
            want.append((str(i), k, at // 4, len(cut) // 4, zlib.crc32(cut)))
    assert got == sorted(want)
    return len(by_sequence), sum(r["length"] for r in found)


def test_packing_query(spark, word_library, sf_texts):
    found = packing.query(spark, SF).collect()
    sequences, tokens = check_packed(found, word_library, sf_texts.items())
    assert sequences <= 1.02 * -(-tokens // packing.CAPACITY) + 1


def test_packing_odd_rows_and_sequences(odd, nothing, word_library, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_RANKING", 2)
    from lamina.llm import frames

    cut = frames.written(packing.pieces(odd, with_ids=True), "pieces")
    packed = packing.pack(cut)
    check_packed(packed.collect(), word_library, ODD)
    for r in packing.sequences(packed).collect():
        assert len(r["ids"]) == 4 * r["n_tokens"] <= 4 * packing.CAPACITY
    assert packing.packed(nothing).count() == 0
