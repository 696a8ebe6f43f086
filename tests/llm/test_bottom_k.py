"""Bottom-k near duplicates against all pairs, and odd rows."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np

from lamina.llm import bottom_k

from .conftest import ODD

SF = "/root/testdata/sf0.001"


def plain_set(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return set(zip(words, words[1:])) if len(words) > 1 else set(words)


def plain_groups(rows):
    """(id, size, least id reachable, kept) of (id, text), over all pairs."""
    sets = [plain_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            near = shared and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared)
            same = rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]
            if near or same:
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (a, _) in enumerate(rows):
        if a is not None:
            least[root(i)] = min(a, least.get(root(i), a))
    found = [(a, len(s), least.get(root(i)) if s else a) for i, ((a, _), s) in enumerate(zip(rows, sets))]
    return sorted(((*r, r[0] == r[2]) for r in found), key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def near_copies(chance, sizes, copies):
    """Texts and copies with so many words replaced that the likeness lies about 0.8."""
    texts = []
    for size in sizes:
        base = [f"w{chance.randrange(3000)}" for _ in range(size)]
        for _ in range(copies):
            words = list(base)
            for _ in range(chance.randrange(1 + size // 14)):
                words[chance.randrange(size)] = f"w{chance.randrange(3000)}"
            texts.append(" ".join(words))
    return texts


def test_equals_all_pairs(docs_of):
    chance = random.Random(5)
    texts = near_copies(chance, [1, 2, 5, 12, 30, 60, 64, 65, 70, 80, 150, 400], 9)
    rows = list(enumerate(texts, 3))
    chance.shuffle(rows)
    found = plain_groups(rows)
    assert 20 < sum(not r[3] for r in found) < len(rows) - 20
    assert collected(bottom_k.groups(docs_of(rows))) == found


def test_one_large_group_and_a_common_passage(docs_of):
    chance = random.Random(6)
    base = [f"b{i}" for i in range(90)]
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        words[chance.randrange(90)] = f"x{i}"
        rows.append((2 * i, " ".join(words)))
    for i in range(60):
        rows.append((2 * i + 1, " ".join([f"q{i}-{k}" for k in range(40)] + passage)))
    assert collected(bottom_k.groups(docs_of(rows))) == plain_groups(rows)


def test_equals_sql_on_given_documents(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert collected(bottom_k.query(spark, SF)) == sorted(con.sql(bottom_k.SQL).fetchall(), key=repr)


def test_odd_rows(odd, docs_of):
    assert collected(bottom_k.groups(odd)) == plain_groups(ODD)
    rows = [(7, "a b c"), (7, "d e f"), (None, "D E F"), (None, "g h"), (None, None), (2, "a B c"), (2, ""), (9, "One"), (8, "one")]
    assert collected(bottom_k.groups(docs_of(rows))) == plain_groups(rows)


def test_no_rows(nothing):
    found = bottom_k.groups(nothing)
    assert found.collect() == [] and found.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_shingles_know_order_and_repeats():
    shingles = bottom_k.Shingler().shingles
    assert len(shingles("a b a b a")) == 2
    assert not np.array_equal(shingles("a b"), shingles("b a"))
    assert np.array_equal(shingles("A\tbÉ"), shingles("a bÉ"))
    assert not np.array_equal(shingles("bÉ c"), shingles("bé c"))
    assert len(shingles("")) == 0 and len(shingles(" \n ")) == 0 and len(shingles("one")) == 1


def test_lists_hold_values_of_near_sizes_once(spark, docs_of):
    words = [f"s{i}" for i in range(700)]
    nested = [" ".join(words[:n]) for n in (40, 80, 160, 320, 640)]
    copies = near_copies(random.Random(8), [100], 6)

    def lists(texts):
        with bottom_k.frames.Scratch(spark) as scratch:
            rows = bottom_k.sketches(bottom_k.texts(docs_of(list(enumerate(texts)))))
            classes = scratch.written(bottom_k._classes(rows), "classes")
            found = bottom_k._listing(classes, scratch).collect()
            return found, [spark.read.parquet(p).count() for p in scratch.paths if "values" in p]

    assert lists(nested) == ([], [0])
    found, _ = lists(nested + copies)
    assert found and len({(r.c, r.value) for r in found}) == len(found)
    assert all(len(r.earlier) < 35 and r.value not in r.earlier for r in found)
    rows = list(enumerate(nested + copies))
    assert collected(bottom_k.groups(docs_of(rows))) == plain_groups(rows)
