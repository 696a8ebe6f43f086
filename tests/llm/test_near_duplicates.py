"""SimHash, line join, spot signatures and components against brute force, and odd rows."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash

from lamina.llm import frames, line_dedup, simhash, spotsigs
from lamina.llm.components import components

from .conftest import ODD

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id reachable over fingerprints at two or fewer bits; rows of (id, fingerprint)."""
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (a, x) in enumerate(prints):
        for j, (b, y) in enumerate(prints[:i]):
            if (x ^ y).bit_count() <= 2 or (a is not None and a == b):
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (a, _) in enumerate(prints):
        if a is not None:
            least[root(i)] = min(a, least.get(root(i), a))
    return [least.get(root(i)) for i in range(len(prints))]


def test_every_syndrome_has_one_pattern_within_the_radius():
    levels, begins, upto = simhash._patterns()
    assert (upto[:, 0] == 1).all() and len(levels) == 44552
    assert (simhash._syndromes(levels[:, 0])[begins] == np.arange(2048)).all()


def test_close_prints_meet_at_the_home_of_either():
    chance = np.random.default_rng(2)
    one = chance.integers(-(2**63), 2**63 - 1, 200)
    for flips in (0, 1, 2):
        two = one.copy()
        for i in range(len(two)):
            for bit in chance.choice(64, flips, replace=False):
                two[i] ^= np.int64(np.uint64(1 << int(bit)).view(np.int64))
        rows, anchors, home = simhash.anchors_of(one)
        homes = dict(zip(rows[home].tolist(), anchors[home].tolist()))
        assert len(homes) == len(one)
        rows, anchors, _ = simhash.anchors_of(two)
        met = set(zip(rows.tolist(), anchors.tolist()))
        assert all((i, a) in met for i, a in homes.items())


def linked(spark, prints):
    """Component of each print, from the operator's links, as the least print."""
    frame = spark.createDataFrame([(int(p),) for p in prints], "fp long")
    up = {int(p): int(p) for p in prints}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for r in simhash.links(frame).collect():
        a, b = root(r["a"]), root(r["b"])
        up[max(a, b)] = min(a, b)
    return {p: root(p) for p in up}


@pytest.mark.parametrize("crowd", [2048, 40])
def test_links_of_a_crowd(spark, monkeypatch, crowd):
    """Hundreds of prints around one, in one task's batches or dealt over salts."""
    monkeypatch.setattr(simhash, "HOMES_PER_TASK", crowd)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 64)
    chance = random.Random(1)
    prints = {chance.getrandbits(64) for _ in range(100)}
    middle = chance.getrandbits(64)
    for _ in range(300):
        prints.add(middle ^ sum(1 << b for b in chance.sample(range(44, 64), chance.choice([1, 2, 3, 8]))))
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    mask = (1 << 64) - 1
    want = plain_components([(p, p & mask) for p in prints])
    assert linked(spark, prints) == dict(zip(prints, want))


def test_simhash_query(spark, sf_texts):
    ids = sorted(sf_texts)
    prints = [(i, plain_fingerprint(sf_texts[i])) for i in ids]
    want = {i: (f"{p:016x}", c) for (i, p), c in zip(prints, plain_components(prints))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.query(spark, SF).collect()}
    assert got == want


def test_simhash_odd_rows(odd, nothing, docs_of):
    prints = [(i, plain_fingerprint(t)) for i, t in ODD]
    want = sorted(zip([str(i) for i, _ in ODD], map(str, plain_components(prints))))
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in simhash.groups(odd).collect())
    assert got == want
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # Null, empty and blank texts are one group; so are the repeated rows.
    assert sorted(ids, key=str) == sorted([3, 5, 7, 9, 11, None], key=str)
    assert simhash.keep_one(nothing).count() == 0
    nameless = docs_of([(None, "one and the same text"), (None, "one and the same text"), (None, None)])
    assert simhash.keep_one(nameless).count() == 2


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(1, i) for i in range(2, 40)]
    edges = [*chain, *star, (5, 5), (2, 1), (300, 200), (None, 4)]
    random.Random(0).shuffle(edges)
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {r["vertex"]: r["component"] for r in found}
    assert len(got) == len(found)
    want = {i: 100 for i in range(100, 141)} | {i: 1 for i in range(1, 40)} | {200: 200, 300: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def tokens_of(line):
    words = line.split(" ")
    return {line} if len(words) < 5 else {" ".join(words[k : k + 5]) for k in range(len(words) - 4)}


def plain_removed(pairs):
    """``(id, line)`` of what goes: a similar or equal line stands strictly earlier."""
    found = [
        ((2**63 - 1 if i is None else i, k), tokens_of(line))
        for i, text in pairs
        for k, line in enumerate((text or "").split("\n"))
        if line.strip(" ")
    ]
    gone = set()
    for at, x in found:
        for earlier, y in found:
            if earlier < at and 5 * len(x & y) >= 4 * len(x | y):
                gone.add(at)
                break
    return gone


def near_lines(n=60):
    chance = random.Random(3)
    base = [[f"w{chance.randrange(400)}" for _ in range(chance.choice([3, 5, 9, 40, 80]))] for _ in range(12)]
    texts = []
    for i in range(n):
        some = []
        for _ in range(4):
            line = list(chance.choice(base))
            for _ in range(chance.choice([0, 0, 1, 2])):
                line[chance.randrange(len(line))] = f"v{chance.randrange(9)}"
            some.append(" ".join(line))
        texts.append((i, "\n".join(some)))
    return texts


def test_line_join_against_brute_force(docs_of):
    pairs = near_lines()
    got = {(r["doc"], r["place"]) for r in line_dedup.removed_lines(docs_of(pairs)).collect()}
    assert got == plain_removed(pairs) and len(got) > 50


def test_line_join_does_not_depend_on_the_sketch(docs_of, monkeypatch):
    pairs = near_lines(40)
    hashes = [r["k1"] for r in line_dedup.lines(docs_of(pairs)).collect()]
    monkeypatch.setattr(line_dedup, "_levels", lambda found: [hashes[:5], hashes[5:9], [], [-(2**63)]])
    got = {(r["doc"], r["place"]) for r in line_dedup.removed_lines(docs_of(pairs)).collect()}
    assert got == plain_removed(pairs)


def test_line_query_and_its_twin(spark):
    want = duckdb.connect()
    want.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    columns = "doc_id, n_lines, n_removed, removed"
    rows = want.execute(f"SELECT {columns} FROM ({line_dedup.SQL}) ORDER BY doc_id").fetchall()
    got = line_dedup.query(spark, SF).select(*columns.split(", ")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == rows


def test_line_stage_odd_rows(odd, nothing):
    out = line_dedup.dedup(odd)
    assert out.columns == odd.columns and out.count() == len(ODD)
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    # Repeated rows of one id share their places, so neither goes.
    assert texts == dict(ODD)
    assert line_dedup.dedup(nothing).count() == 0


def test_line_stage_rebuilds_texts(docs_of):
    same = "this very line has more than five words"
    pairs = [(1, f"{same}\n\nother"), (2, f"first of its own\n{same}\n\n{same}"), (3, same), (None, f"{same}\nlast")]
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in line_dedup.dedup(docs_of(pairs)).collect()}
    assert out == {1: (pairs[0][1], len(pairs[0][1])), 2: ("first of its own\n", 17), 3: ("", 0), None: ("last", 4)}


def test_rows_sharing_an_id_keep_their_own_lines(spark, docs_of):
    """Rows without an id, and of a repeated one, with different texts: each loses its own lines alone."""
    same = "this very line has more than five words"
    near = " ".join(f"w{i}" for i in range(60))
    pairs = [
        (1, same),
        (None, f"{same}\nonly in the first of these rows"),
        (None, f"a line of its own\n{near} once"),
        (None, f"another of its own\n{near} twice"),
        (7, f"{same}\nseven has this"),
        (7, f"unlike the other seven\n{same}"),
        (8, "at one place\nfirst eight"),
        (8, "at one place\nsecond eight"),
        (8, "at one place\nsecond eight"),
    ]
    out = line_dedup.dedup(docs_of(pairs)).collect()
    got = sorted((str(r["doc_id"]), r["text"], r["n_chars"] == len(r["text"])) for r in out)
    nears = [x for x in got if near in x[1]]
    assert len(nears) == 1 and nears[0][0] == "None"
    rest = {t for i, t, _ in got if i == "None" and near not in t}
    lost = {"a line of its own", "another of its own"} & rest
    assert len(lost) == 1 and rest == lost | {"only in the first of these rows"}
    assert [t for i, t, _ in got if i == "7"] == ["seven has this", "unlike the other seven"]
    # The equal rows count as one, and of two different ones either is the earlier.
    eights = sorted(t for i, t, _ in got if i == "8")
    assert eights in (
        ["at one place\nfirst eight", "second eight", "second eight"],
        ["at one place\nsecond eight", "at one place\nsecond eight", "first eight"],
    )
    assert all(right for _, _, right in got)


def plain_spots(text):
    words = re.findall(r"[^\W_]+", text.lower())
    anchors = set(spotsigs.ANCHORS)
    content = [(i, w) for i, w in enumerate(words) if w not in anchors]
    out = set()
    for i, w in enumerate(words):
        after = [c for j, c in content if j > i][: spotsigs.CHAIN]
        if w in anchors and len(after) == spotsigs.CHAIN:
            out.add((w, *after))
    return out


def test_spots_are_chains_behind_anchors(sf_texts):
    texts = [t for t in sf_texts.values() if len(t) < 4000][:40]
    for a, b in zip(texts, [*texts[1:], texts[0]]):
        x, y = plain_spots(a), plain_spots(b)
        if x and y:
            assert len(spotsigs.signatures(a)) == len(x)
            got = spotsigs.likeness(spotsigs.signatures(a), spotsigs.signatures(b))
            assert got == pytest.approx(len(x & y) / len(x | y))


def test_spots_of_little():
    for text in ("", "   ", "the of and", "word", "the one two"):
        assert len(spotsigs.signatures(text)) == 1
    assert spotsigs.likeness(spotsigs.signatures("a"), np.empty(0, np.uint32)) == 0
    few, many = np.arange(3, dtype=np.uint32), np.arange(9, dtype=np.uint32)
    assert spotsigs.likeness(few, many) == pytest.approx(1 / 3)
    assert spotsigs.likeness(few, many, 0.5) == 0


def check_beside(found, order):
    got = {}
    for r in found:
        got.setdefault(r["doc_id"], []).append(r)
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        x, y, z = (spotsigs.signatures(t) for t in (text, edited, after))
        want = (
            len(text), hashlib.sha256(edited.encode()).hexdigest(), spotsigs.spelled(x), spotsigs.spelled(y),
            spotsigs.likeness(x, y), spotsigs.likeness(x, z),
        )
        names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        assert want in [tuple(r[n] for n in names) for r in got[i]], i


def test_spot_query(spark, sf_texts, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = spotsigs.beside_next(docs, rows_per_range=30).collect()
    assert len(found) == len(sf_texts)
    check_beside(found, sorted(sf_texts.items()))


def test_spots_odd_rows(odd, nothing, docs_of):
    order = [(i, t or "") for i, t in sorted(ODD, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))]
    found = spotsigs.beside_next(odd, rows_per_range=2).collect()
    assert len(found) == len(ODD)
    check_beside(found, order)
    assert spotsigs.beside_next(nothing).count() == 0
    alone = spotsigs.beside_next(docs_of([(1, "the end of one text and no other")])).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


def test_similar_spots_against_brute_force(spark, docs_of):
    chance = random.Random(5)
    pairs = []
    for i in range(40):
        words = [chance.choice(["the", "of"] * 40 + [f"w{k}" for k in range(200)]) for _ in range(150)]
        pairs.append((2 * i, " ".join(words)))
        for _ in range(chance.choice([0, 3])):
            words[chance.randrange(150)] = "new"
        pairs.append((2 * i + 1, " ".join(words)))
    prints = spotsigs.fingerprints(docs_of([*pairs, (None, "the a b c"), (99, None)]))
    got = {(r["a"], r["b"]) for r in spotsigs.similar(prints).collect()}
    sets = {}
    for i, t in pairs:
        sets.setdefault(tuple(spotsigs.signatures(t).tolist()), i)
    firsts = [(i, set(s)) for s, i in sets.items()]
    want = {
        (min(i, j), max(i, j))
        for i, x in firsts
        for j, y in firsts
        if i < j and len(x & y) >= spotsigs.THRESHOLD * len(x | y)
    }
    assert got == want and len(got) > 5


def test_lines_of_far_sizes_share_no_list(spark, docs_of):
    words = [f"s{i}" for i in range(800)]
    nested = [" ".join(words[:n]) for n in (40, 80, 160, 320, 640)]
    alike = " ".join(words[:39])

    def listed(texts):
        with frames.Scratch(spark) as scratch:
            found = line_dedup.lines(docs_of(list(enumerate(texts))))
            classes = scratch.written(line_dedup._classes(found), "lines")
            return {r.n for r in line_dedup._listing(classes, scratch).join(classes, "c").collect()}

    assert listed(nested) == set()
    assert listed([*nested, alike]) >= {35, 36}
    gone = line_dedup.removed_lines(docs_of(list(enumerate([*nested, alike])))).collect()
    assert [(r.doc, r.place) for r in gone] == [(5, 0)]
