"""Vectors, licenses, personal data, quality and the pipeline, on fixtures and odd rows."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

import corpus_pipeline
from lamina.llm import catalogue, frames, licenses, nearest, pii, quality

from .conftest import ODD

SF = "/root/testdata/sf0.001"


def brute_nearest(ids, vectors, queries, k=20):
    out = {}
    for q in queries:
        at = ids.index(q)
        scores = vectors @ vectors[at]
        order = sorted((j for j in range(len(ids)) if ids[j] != q), key=lambda j: (-scores[j], ids[j]))
        out[q] = [ids[j] for j in order[:k]]
    return out


def test_nearest_query_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids = [r["vec_id"] for r in rows]
    vectors = np.array([r["embedding"] for r in rows], np.float64)
    want = brute_nearest(ids, vectors, [i for i in ids if i % 20 == 0])
    got = {}
    for r in nearest.query(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        exact = vectors[ids.index(r["query_id"])] @ vectors[ids.index(r["vec_id"])]
        assert r["score"] == pytest.approx(exact, abs=1e-12)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * 20 * len(want)


def test_nearest_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, float(i % 3)]) for i in range(40, 70)]
    rows += [(0, [1.0, 1.0, 0.0]), (100, [1.0, 1.0, 0.0]), (100, [1.0, 1.0, 0.0])]
    rows += [(20, None), (80, [0.0, 0.0, 0.0]), (120, [nan, 1.0, 0.0]), (140, [inf, 0.0, 0.0])]
    rows += [(160, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (180, []), (200, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    from pyspark.sql import functions as F

    frame = frame.withColumn("entry", F.lit(1)).withColumn("score", F.lit("x"))
    got = {}
    for r in nearest.search(frame, F.col("vec_id") % 20 == 0, "vec_id", "embedding").orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    good = {i: v for i, v in rows if i is not None and (i in (0, 100) or 40 <= i < 70)}
    ids = list(good)
    want = brute_nearest(ids, np.array([good[i] for i in ids]), [0, 40, 60, 100])
    assert got == want
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [r["vec_id"] for r in nearest.search(few, F.col("vec_id") == 0, "vec_id", "embedding").collect()] == [1]
    assert nearest.search(frame.limit(0), F.lit(True), "vec_id", "embedding").count() == 0


def test_a_longer_vector_does_not_displace_the_others(spark):
    rows = [(i, [1.0, float(i), float(i % 3)]) for i in range(30)] + [(500, [1.0] * 4), (501, [2.0] * 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = nearest.search(frame, frame["vec_id"] % 20 == 0, "vec_id", "embedding").collect()
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    ids = list(range(30))
    assert got == brute_nearest(ids, np.array([v for _, v in rows[:30]]), [0, 20])


def test_probing_retrieves_every_code_within_the_radius():
    chance = np.random.default_rng(3)
    vectors = chance.normal(size=(600, 16))
    largest = float(np.linalg.norm(vectors, axis=1).max())
    index = nearest.Index(np.arange(600), vectors, nearest.learn(vectors, largest, 1.0))
    for code in index.codes[:20]:
        far = np.bitwise_count(index.codes ^ code)
        for radius in (0, 3, 4, 7, 18, 40, 64):
            assert index.within(code, radius).tolist() == np.flatnonzero(far <= radius).tolist()


def plain_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        at = [k for k in range(len(words)) if words[k : k + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_query(spark, sf_texts):
    for r in licenses.query(spark, SF).collect():
        got = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
        assert got == plain_scan(sf_texts[r["doc_id"]])
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def test_license_rules():
    assert len(licenses.rules()) > 300
    for rule in licenses.rules():
        assert rule.pattern.pattern  # compiled
    found = licenses.scan_text("Licensed under the Apache License, Version 2.0. All rights reserved!")
    assert found[5] == "apache,apache-2.0,reserved"
    assert licenses.scan_text("under CC BY-NC 4.0")[5] == "cc-by,cc-by-nc-4.0"
    assert licenses.scan_text("SPDX-License-Identifier: GPL-3.0-only")[5] == "gpl-3.0"
    assert licenses.scan_text("GNU General Public License version 2")[4:7] == ("gpl", "gpl,gpl-2", 0.75)
    for words in ("", "Nothing here of the kind", "the mit of a cat"):
        assert licenses.scan_text(words)[5] == "" and licenses.scan_text(words)[6] == 0


def test_every_match_holds_a_keyword():
    assert licenses._words_of_every_match("a( bb)? [d]+ (gg|hhh) i?") == {"bb", "gg", "hhh"}
    assert licenses._words_of_every_match("(x|[a-z]+)") == frozenset()
    text = " permission is hereby granted free of charge to any person obtaining a copy of apache license 2 0 "
    for rule in licenses.rules():
        for m in rule.pattern.finditer(text):
            assert not rule.words or rule.words & set(m[0].split())


def one_by_one(text):
    """Every rule on the text, every pair of detections compared."""
    words = [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.encode().lower())]
    plain = f" {' '.join(words)} "
    found = [
        (m.start(), m.end(), rule.priority, rule.label) for rule in licenses.rules() for m in rule.pattern.finditer(plain)
    ]

    def before(d, e):
        return (-d[2], d[0] - d[1], d[0], d[3]) < (-e[2], e[0] - e[1], e[0], e[3])

    kept = {
        d
        for i, d in enumerate(found)
        if not any(
            e[0] <= d[0] and d[1] <= e[1] and (before(e, d) or (e == d and j < i)) for j, e in enumerate(found) if j != i
        )
    }
    return sorted((len(plain[:a].split()), len(plain[:b].split()), p, label) for a, b, p, label in kept)


def test_detections_are_those_of_rules_tried_one_by_one(sf_texts):
    draw = np.random.default_rng(5)
    parts = """licensed under the|apache license|version 2.0|cc by|nc|sa 4.0|gnu|lesser general public license|all rights
reserved|or later|spdx-license-identifier: mit|mit license|(c) 2020|copyright|general public license|v3|word|bsd 3-clause
permission is hereby granted|free of charge|to any person obtaining a copy|the|mozilla public license 1.1""".split("|")
    texts = [" ".join(draw.choice(parts, size=draw.integers(1, 40))) for _ in range(60)]
    texts += [t for t in sf_texts.values() if t][:200]
    some = 0
    for text in texts:
        words, plain = licenses.normal(text)
        got = licenses.detections(words, plain) if words else []
        want = one_by_one(text)
        assert sorted(got) == want
        labels = set(licenses.scan_text(text)[4].split(",")) | {d[3] for d in want}
        assert licenses.scan_text(text)[5] == ",".join(sorted(labels - {""}))
        best = {}
        for *_, priority, label in want:
            best[label] = max(best.get(label, 0), priority)
        assert licenses.scan_text(text)[6] == pytest.approx(1 - np.prod([1 - p / 100 for p in best.values()]))
        some += len(want) > 1
    assert some > 20


def test_contained_detections_go():
    at = [(10, 20), (5, 12), (18, 30), (11, 20), (5, 6), (5, 20), (29, 31), (29, 31)]
    kept = licenses._standing([(a, b, 1, "") for a, b in at])
    assert [d[:2] for d in kept] == [(10, 20), (5, 12), (18, 30), (5, 20), (29, 31)]


def test_a_long_text_full_of_licenses():
    import time

    text = "all rights reserved word " * 200_000  # 5 MB
    began = time.perf_counter()
    got = licenses.scan_text(text)
    assert time.perf_counter() - began < 60
    assert got[:5] == (800_000, 200_000, 0, 799_996, "reserved") and len(got[7]) == 200_000
    assert [d["first"] for d in got[7]] == list(range(0, 800_000, 4))


def test_license_odd_rows(odd, nothing):
    got = sorted((str(r["doc_id"]), r["n_words"]) for r in licenses.scan(odd).collect())
    assert got == sorted((str(i), plain_scan(t)[0]) for i, t in ODD)
    assert licenses.scan(nothing).count() == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text or "") if valid(kind, m[0])]
    return sorted(out)


TRICKY = [
    (1, "a@b.co.x@y.z a@b.c_d@e.f x@@y.z a@b..c a@b.c. .@-.- 😀é@é.fr me@x-y.org"),
    (2, "1.2.3.4.5 1.2.3.999 12.34.56 001.002.003.255 1.2.3.4 999.1.2.3.4 0.0.0.0"),
    (3, "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 5 6 7 4111  1111 1111 1111"),
    (4, "+1 (017) 555-5036 and +49 30 123456 or +1-2 call 555-123-4567 tel: 555-123-4567"),
    (5, 'token = "b39f2211c596882a4510c57d72feeb9108e50dd6" b39f2211c596882a4510c57d72feeb9108e50dd6'),
    (6, "1" * 30_000 + " " + "1 " * 20_000 + "a" * 30_000 + "@" + "1.2" * 9000),
]


def test_base_spans_equal_the_plain_patterns(docs_of):
    found = pii.spans(docs_of([*TRICKY, *ODD]), pii.Model("0D", {}), out="found")
    for r in found.collect():
        assert [(s["start"], s["kind"], s["stop"]) for s in r["found"]] == plain_spans(r["text"])


def test_further_spans_are_chosen_as_by_trying_all(docs_of, monkeypatch):
    monkeypatch.setattr(pii, "BLOCK", 13)  # as small as it may be, so that texts have many blocks
    draw = np.random.default_rng(9)
    parts = ["555-123-4567", "123-45-6789", "abcdef0123456789-x", "me@x.org", "1.2.3.4", " ", "-", "a1", "(555) 123.4567", "_", "x" * 15]
    texts = [(i, "".join(draw.choice(parts, size=n))) for i, n in enumerate([*range(0, 200, 2), 400, 900, 1500])]
    model = pii.Model(
        "pmod(c.f[1] * 7 + c.f[2] * 3 + c.f[0], 11D) / 11D", {"secret": 0.2, "national": 0.3, "insurance": 0.0}
    )
    docs = docs_of(texts)
    proposed = {r["doc_id"]: r["candidates"] for r in pii.candidates(docs).collect()}
    chosen = several = 0
    for r in pii.spans(docs, model, out="found").collect():
        base = [(c["start"], c["kind"], c["stop"]) for c in proposed[r["doc_id"]] if c["valid"]]
        further = []
        for c in proposed[r["doc_id"]]:
            digits = sum(x in "0123456789" for x in c["value"])
            score = (len(c["value"]) * 7 + digits * 3 + c["kind"]) % 11 / 11
            if score >= model.thresholds.get(pii.KINDS[c["kind"]], 2):
                further.append((-score, c["start"], c["kind"], c["stop"]))
        kept = []
        for _, start, kind, stop in sorted(further):
            if not any(b < stop and start < e for b, _, e in base + kept):
                kept.append((start, kind, stop))
        assert [(s["start"], s["kind"], s["stop"]) for s in r["found"]] == sorted(base + kept)
        chosen += len(kept)
        several += len(further) > len(kept) > 0
    assert chosen > 500 and several > 20


def test_a_long_text_full_of_matches(docs_of):
    import time

    docs = docs_of([(1, "token=abcdefgh12345678ijk me@x.org 1.2.3.4 " * 25_000)])
    began = time.perf_counter()
    found = pii.spans(docs, pii.Model("1D", {"secret": 0.5}), out="found").first()["found"]
    kinds = [s["kind"] for s in found]
    assert time.perf_counter() - began < 90
    assert kinds == [4, 0, 1] * 25_000


def test_pii_query(spark, sf_texts):
    for r in pii.query(spark, SF).collect():
        want = plain_spans(sf_texts[r["doc_id"]])
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(x[1] == k for x in want) for k in range(4)]
        assert set(listed.split(",")) - {""} <= set(r["spans"].split(","))


def test_trained_spans_and_redaction(docs_of):
    secret = "{:040x}"
    texts = []
    for i in range(300):
        code = secret.format(int(hashlib.sha1(str(i).encode()).hexdigest(), 16))
        texts.append((i, f'before token = "{code}" after' if i % 3 else f"plain {code} words 1.2.3.{i} a@b.org"))
    docs = docs_of(texts)
    model = pii.train(docs)
    assert "secret" in model.thresholds
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.redact(docs, model).collect()}
    for i, text in texts:
        if i % 3:
            assert out[i][0] == 'before token = "[SECRET]" after'
        else:
            assert out[i][0].endswith(f"words {'[IP]' if i <= 255 else f'1.2.3.{i}'} [EMAIL]")
            assert "[SECRET]" not in out[i][0]
        assert out[i][1] == len(out[i][0])


def test_context_is_that_of_the_text(docs_of):
    """Other matches of the same generator are part of it."""
    more = [(7, 'AWS_SECRET_ACCESS_KEY_OF_MINE = "b39f2211c596882a4510"12 34 5 6 78 a_name_of_no_digits_at_all 😀'), *ODD]
    seen = 0
    for r in pii.candidates(docs_of([*TRICKY, *more])).collect():
        text = r["text"] or ""
        for c in r["candidates"]:
            start, stop = c["start"], c["stop"]
            assert c["value"] == text[start:stop]
            assert c["before"] == text[max(0, start - pii.BEFORE) : start].lower()
            assert c["after"] == text[stop : stop + pii.AFTER]
            seen += 1
    assert seen > 20


def test_secrets_behind_long_key_names(docs_of):
    forms = ['aws_secret_access_key = "{}"', "STRIPE_SECRET_KEY={} is set", "GITHUB_ACCESS_TOKEN: {} there"]
    texts = []
    for i in range(300):
        # No run of digits is long enough for a card number, which would come first.
        code = re.sub("([0-9]{6})", r"\1a", hashlib.sha1(str(i).encode()).hexdigest())
        texts.append((i, forms[i % 4].format(code) if i % 4 < 3 else f"plain {code} words"))
    docs = docs_of(texts)
    out = {r["doc_id"]: r["text"] for r in pii.redact(docs, pii.train(docs)).collect()}
    for i, text in texts:
        assert out[i] == (forms[i % 4].format("[SECRET]") if i % 4 < 3 else text)


def test_trees_become_the_same_scores():
    text = "If (feature 1 <= 2.5)\n If (feature 0 <= 0.0)\n  Predict: -1.0E-2\n Else (feature 0 > 0.0)\n  Predict: 2.0\nElse (feature 1 > 2.5)\n Predict: 3.0"
    assert pii._tree_sql(text) == "IF(c.f[1] <= 2.5D, IF(c.f[0] <= 0.0D, -0.01D, 2.0D), 3.0D)"


def test_redaction_odd_rows(odd, nothing):
    out = pii.redact(odd)
    assert out.columns == odd.columns
    texts = sorted((str(r["doc_id"]), str(r["text"])) for r in out.collect())
    assert texts == sorted((str(i), str(t).replace("me@example.org", "[EMAIL]")) for i, t in ODD)
    assert pii.redact(nothing).count() == 0


def test_gradient_is_the_slope():
    chance = np.random.default_rng(0)
    bags = [chance.normal(size=(n, quality.WIDTH)) for n in (1, 3, 2)]
    labels, begins, x = np.array([0.0, 1, 1]), np.array([0, 1, 4]), np.concatenate(bags)
    h = quality.HIDDEN
    w = {"V": (quality.WIDTH, h), "U": (quality.WIDTH, h), "w": h, "E": (quality.WIDTH, h), "e": h, "c": h, "b": 1}
    w = {k: chance.normal(0, 0.1, s) for k, s in w.items()}

    def loss():
        p = quality._forward(w, x, begins)["p"]
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    slopes = quality._gradient(w, x, begins, labels)
    for k, g in slopes.items():
        at = tuple(chance.integers(0, n) for n in w[k].shape)
        kept = w[k][at]
        w[k][at] = kept + 1e-5
        high = loss()
        w[k][at] = kept - 1e-5
        low = loss()
        w[k][at] = kept
        assert g[at] == pytest.approx((high - low) / 2e-5, rel=1e-3, abs=1e-8)


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = quality.query(spark, folder).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(rows) == 1000 and len(held) > 80
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)


def test_quality_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(5, 1, 0), (5, None, 0), (None, 1, 0), (4, 0, 1), (77, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.scored(odd, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.scored(nothing, labels).count() == 0
    none = quality.scored(odd, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.keep_good(odd, labels.limit(0)).columns == odd.columns


def plain_passages(text):
    """Passages of 400 bytes by themselves, with the byte behind each for its last pair."""
    raw = text.encode("utf-8", "surrogatepass")
    pieces = [raw[i : i + 401] for i in range(0, len(raw), 400)] or [b""]
    return np.concatenate([quality._encode(p, 0, min(400, len(p))) for p in pieces])


def plain_score(model, text):
    """The whole bag at once, its softmax and its score, in plain steps."""
    x = np.clip((plain_passages(text) - model.mean) / model.scale, -3, 3).astype(np.float64)
    w = {k: v.astype(np.float64) for k, v in model.weights.items()}
    energy = [float(np.dot(np.tanh(r @ w["V"]) / (1 + np.exp(-(r @ w["U"]))), w["w"])) for r in x]
    weights = [np.exp(e - max(energy)) for e in energy]
    bag = sum(a * np.tanh(r @ w["E"] + w["e"]) for a, r in zip(weights, x)) / sum(weights)
    return 1 / (1 + np.exp(-(bag @ w["c"] + w["b"][0])))


def test_scores_are_those_of_whole_bags(spark, sf_texts):
    """Streamed in blocks or at once, in Spark or by plain steps: one score, at every length."""
    docs, labels = frames.documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    for r in quality.scored(docs, labels).collect():
        assert r["score"] == pytest.approx(plain_score(model, sf_texts[r["doc_id"]] or ""), abs=1e-4)
    for text in ("", "a", "x" * 399, "x" * 400, "x" * 401, "é🙂 " * 9000, "A sentence. " * 20_000 + "#$% " * 900):
        assert model.score(text) == pytest.approx(plain_score(model, text), abs=1e-4)


def test_passages_have_one_size_and_the_text_is_read_to_its_end():
    plain = "some good words in a row " * 30_000
    found = list(quality.blocks(plain))
    assert sum(map(len, found)) == -(-len(plain) // 400) and max(map(len, found)) == quality.BLOCK
    other = list(quality.blocks(plain[:-400] + "#" * 400))
    assert all(np.array_equal(a, b) for a, b in zip(found[:-1], other[:-1]))
    assert not np.array_equal(found[-1], other[-1])
    # A passage doesn't know what stands around it, but for the character behind its last one.
    assert np.array_equal(quality._encode(plain.encode(), 800, 1200), quality._encode(b"?" * 800 + plain.encode()[800:1201], 800, 1200))
    assert len(quality.bag_of(plain)) == quality.BAG and len(quality.bag_of("")) == 1


def test_one_text_of_a_repeated_id_is_learnt_from(spark, docs_of):
    many = [(i, f"good words of text {i}. " * 9) for i in range(60)] + [(i, "## @@ 11 " * 9) for i in range(60, 120)]
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    once, often = quality.train(docs_of(many), labels), quality.train(docs_of(many + [many[0]] * 500), labels)
    assert all(np.array_equal(once.weights[k], often.weights[k]) for k in once.weights)


def test_pipeline_stages(spark):
    docs = frames.documents(spark, SF)
    columns, before = docs.columns, docs.count()
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_duplicates", "personal_data", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = frames.written(stage(spark, docs, SF), name)
        assert docs.columns == columns
        after = docs.count()
        assert 0 < after <= before
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == before
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def plain_redacted(text, found):
    """Spans cut out one by one; of overlapping ones the first names the piece."""
    out, at = [], 0
    for start, _, stop, name in sorted(found):
        if start >= at:
            out += [text[at:start], f"[{name.upper()}]"]
        at = max(at, stop)
    return "".join(out) + text[at:]


def test_pipeline_against_plain_python(spark):
    """Every stage's rows, and those of run(), from the fitted models and plain steps."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from lamina.llm import wordpieces

    from .test_near_duplicates import plain_components, plain_fingerprint, plain_removed
    from .test_tokens import check_packed

    stages = dict(corpus_pipeline.STAGES)
    docs, labels = frames.documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    rows = {r["doc_id"]: r.asDict() for r in docs.collect()}
    assert len(rows) == docs.count()

    def same(found):
        got = {r["doc_id"]: r.asDict() for r in found.collect()}
        assert got == rows
        return frames.written(found, "expected")

    # Scores at the very edge may fall to either side in other steps of arithmetic; there are none.
    scores = {i: plain_score(model, r["text"] or "") for i, r in rows.items()}
    assert not [x for x in scores.values() if abs(x - 0.5) < 1e-3]
    rows = {i: r for i, r in rows.items() if scores[i] >= 0.5}
    docs = same(stages["quality"](spark, docs, SF))

    removed = plain_removed([(i, r["text"]) for i, r in rows.items()])
    for i, r in rows.items():
        gone = [place for doc, place in removed if doc == i]
        if gone:
            r["text"] = "\n".join(x for n, x in enumerate(r["text"].split("\n")) if n not in gone)
            r["n_chars"] = len(r["text"])
    docs = same(stages["line_dedup"](spark, docs, SF))

    components = plain_components([(i, plain_fingerprint(r["text"])) for i, r in rows.items()])
    rows = {i: r for (i, r), component in zip(list(rows.items()), components) if component == i}
    docs = same(stages["near_duplicates"](spark, docs, SF))

    trees = pii.train(docs)
    chosen = {}
    for r in pii.candidates(docs).collect():
        chosen[r["doc_id"]] = [(c["start"], c["kind"], c["stop"], pii.KINDS[c["kind"]]) for c in r["candidates"] if c["valid"]]
    spread = pii.candidates(docs).selectExpr("doc_id", "explode(candidates) AS c").where(f"c.kind >= {pii.BASE_KINDS}")
    further = spread.selectExpr("doc_id", "c", f"struct({pii._features()} AS f) AS c_f").selectExpr(
        "doc_id", "c AS own", "c_f AS c").selectExpr("doc_id", "own", f"{trees.score} AS p")
    for r in sorted(further.collect(), key=lambda r: (-r["p"], r["own"]["start"], r["own"]["kind"])):
        c = r["own"]
        kind, kept = pii.KINDS[c["kind"]], chosen[r["doc_id"]]
        if r["p"] >= trees.thresholds.get(kind, 2) and not any(a < c["stop"] and c["start"] < b for a, _, b, _ in kept):
            kept.append((c["start"], c["kind"], c["stop"], kind))
    for i, r in rows.items():
        if chosen[i]:
            r["text"] = plain_redacted(r["text"], chosen[i])
            r["n_chars"] = len(r["text"])
    docs = same(stages["personal_data"](spark, docs, SF))

    library = Tokenizer.from_file(public_tokenizers.path(wordpieces.TOKENIZER))
    found = corpus_pipeline.run(spark, SF).collect()
    check_packed(found, library, [(i, r["text"]) for i, r in rows.items()])


def test_catalogue_names():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in catalogue.QUERIES) == list(range(1, 14))
    assert catalogue.SQL.keys() <= catalogue.QUERIES.keys()


def test_candidates_of_every_document_are_learnt_from(docs_of, monkeypatch):
    """Only the last of many documents show a rule; whatever bound a sample had, they count."""
    monkeypatch.setattr(pii, "SAMPLE_DOCS", 10, raising=False)
    texts = [(i, f"call 555-{100 + i}-{4000 + i} or token={i:04d}abcdefghijklmnop now {i:04d}abcdefghijklmnop") for i in range(300)]
    docs = docs_of(texts)
    grown = []
    written = frames.written

    def seen(df, purpose, *more):
        table = written(df, purpose, *more)
        grown.append(table.agg({"weight": "sum"}).first()[0] if "weight" in table.columns else table.count())
        return table

    monkeypatch.setattr(frames, "written", seen)
    model = pii.train(docs)
    labelled = pii.candidates(docs).selectExpr("explode(candidates) AS c").where(f"({pii._WEAK}) IS NOT NULL").count()
    assert grown == [labelled] and labelled >= 900
    assert "secret" in model.thresholds


def test_every_labelled_document_and_passage_is_learnt_from(spark, docs_of, monkeypatch):
    """One label in a hundred documents behind the first, and a mark far into long texts."""
    monkeypatch.setattr(quality, "SAMPLE", 8, raising=False)
    read = []
    moments = quality._summed if hasattr(quality, "_summed") else None
    good = "plain words in a row, quite good ones. "
    many = [(i, good * (900 if i % 20 == 0 else 3)) for i in range(150)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(150)], "doc_id long, quality int, toxic int")

    def kept(chunks, of_chunk, unit):
        found = moments(chunks, of_chunk, unit)
        read.append(found[:3].tolist())
        return found

    monkeypatch.setattr(quality, "_summed", kept, raising=False)
    monkeypatch.setattr(quality, "EPOCHS", 1)
    quality.train(docs_of(many), labels)
    import zlib

    ours = [(i, t) for i, t in many if zlib.crc32(str(i).encode()) % 3 != 1]
    assert read[0] == [len(ours), sum(i % 2 for i, _ in ours), sum(-(-len(t.encode()) // 400) for _, t in ours)]
