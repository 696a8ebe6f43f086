from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lamina.catalogue import files
from lamina.columns import columns
from lamina.operators import contracts, digest, paging, shaping
from lamina.operators.latest import keep_last, latest_snapshot, latest_snapshot_per
from lamina.operators.quality import RowCounts


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- shaping ----------------------------------------------------------------


def test_strict_rename_needs_every_column(spark):
    df = spark.sql("SELECT 1 AS A, 2 AS B")
    assert shaping.rename_strict(df, {"A": "a"}).columns == ["a", "B"]
    with pytest.raises(shaping.MissingColumns):
        shaping.rename_strict(df, {"A": "a", "C": "c"})


def test_drifted_union(spark):
    names = {"UTI TOTAL - EXIST": "uti", "UTI_TOTAL_EXIST": "uti", "COMP": "comp", "UF": "uf"}
    old = spark.sql("SELECT '1' AS `UTI TOTAL - EXIST`, 'a' AS COMP, 'x' AS `a.b`")
    new = spark.sql("SELECT 'b' AS COMP, '2' AS UTI_TOTAL_EXIST, 'SP' AS UF")
    frames = [
        shaping.keep_known(shaping.rename_known(f, names), set(names.values()))
        for f in (old, new)
    ]
    union = shaping.union_drifted(frames).select("comp", "uti", "uf")
    assert rows(union, "comp") == [("a", "1", None), ("b", "2", "SP")]


def test_text_columns_leave_out_lineage(spark):
    df = spark.sql("SELECT 'a' AS a, 1 AS b, 'c' AS _c, 'd' AS d")
    assert shaping.text_columns(df, {"d"}) == ["a"]


def test_align_adds_columns_with_defaults(spark):
    schema = columns("a bigint, flag boolean, note string")
    df = shaping.align(spark.sql("SELECT 1 AS a, 2 AS dropped"), schema, {"flag": False})
    assert df.schema == schema or df.dtypes == [("a", "bigint"), ("flag", "boolean"), ("note", "string")]
    assert rows(df, "a") == [(1, False, None)]


def test_conform_orders_casts_and_refuses(spark):
    schema = columns("b int not null, a string")
    df = shaping.conform(spark.sql("SELECT 'x' AS a, 5L AS b, 1 AS extra"), schema)
    assert df.dtypes == [("b", "int"), ("a", "string")]
    with pytest.raises(shaping.MissingColumns):
        shaping.conform(spark.sql("SELECT 'x' AS a"), schema)
    with pytest.raises(PySparkException):
        shaping.conform(spark.sql("SELECT 'x' AS a, id + 3000000000 AS b FROM range(1)"), schema).collect()


# --- latest -----------------------------------------------------------------


def test_keep_last_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS o")
    kept = keep_last(df, ["k"], ["o"])
    assert rows(kept, "k") == [(0, 999), (1, 997), (2, 998)]
    plan = plan_of(kept)
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange")
    assert plan.index("Exchange") < plan.index("row_number(), 1, Partial")


def test_keep_last_treats_null_keys_as_equal(spark):
    df = spark.createDataFrame(
        [(None, "x", 1), (None, "x", 2), ("a", None, 3), ("a", None, 4), ("a", "x", 5)],
        "k string, l string, o int",
    )
    assert sorted(r["o"] for r in keep_last(df, ["k", "l"], ["o"]).collect()) == [2, 4, 5]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b", "c"]), st.integers(0, 3)), min_size=1, max_size=25))
def test_keep_last_property(spark, pairs):
    numbered = [(k, o, i) for i, (k, o) in enumerate(pairs)]
    df = spark.createDataFrame(numbered, "k string, o int, i int").repartition(3)
    expected = {}
    for k, o, i in sorted(numbered, key=lambda r: (r[1], r[2])):
        expected[k] = (o, i)
    found = keep_last(df, ["k"], ["o", "i"]).collect()
    assert {r["k"]: (r["o"], r["i"]) for r in found} == expected
    assert len(found) == len(expected)


def test_latest_snapshot(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, DATE '2026-01-01'), (2, DATE '2026-02-01'), (3, NULL) "
        "AS t(a, _extraction_date)"
    )
    assert [r["a"] for r in latest_snapshot(df).collect()] == [2]


def test_latest_snapshot_per_year(spark):
    df = spark.createDataFrame(
        [(2020, 1, "old"), (2021, 1, "stale"), (2021, 2, "new"), (2021, 2, "new2"), (None, 3, "n")],
        "y int, d int, v string",
    )
    found = latest_snapshot_per(df, ["y"], "d")
    assert sorted(r["v"] for r in found.collect()) == ["n", "new", "new2", "old"]


# --- contracts --------------------------------------------------------------

SPEC = contracts.TableSpec(
    name="t",
    schema=columns("k string not null, n int not null, p string"),
    key=("k",),
    ranges={"n": (0, 10)},
    patterns={"p": r"^[0-9]{6}\z"},
)


def frame(spark, *values):
    return spark.createDataFrame(list(values), "k string, n int, p string")


def test_contract_passes_and_returns_the_frame(spark):
    df = frame(spark, ("a", 0, "202101"), ("b", 10, None))
    assert contracts.validate(df, SPEC) is df
    assert rows(contracts.guarded(df, SPEC), "k") == [("a", 0, "202101"), ("b", 10, None)]


@pytest.mark.parametrize(
    ("bad", "rule"),
    [
        ((None, 1, None), "not_null on k"),
        (("b", None, None), "not_null on n"),
        (("b", -1, None), "range on n"),
        (("b", 11, None), "range on n"),
        (("b", 1, "20211"), "pattern on p"),
        (("b", 1, "202101\n"), "pattern on p"),
    ],
)
def test_contract_violations(spark, bad, rule):
    df = frame(spark, ("a", 1, "202101"), bad)
    found = contracts.violation_counts(df, SPEC).where("violations > 0").collect()
    assert [f"{r['rule']} on {r['column']}" for r in found] == [rule]
    with pytest.raises(contracts.ContractViolation):
        contracts.validate(df, SPEC)
    with pytest.raises(PySparkException, match=rule):
        contracts.guarded(df, SPEC).collect()


def test_contract_key_and_schema(spark):
    twice = frame(spark, ("a", 1, None), ("a", 2, None))
    with pytest.raises(contracts.ContractViolation, match="duplicate"):
        contracts.validate(twice, SPEC)
    for wrong in ("*, 1 AS extra", "k, n", "n, k, p", "k, cast(n AS bigint) AS n, p"):
        with pytest.raises(contracts.ContractViolation, match="schema"):
            contracts.check_schema(frame(spark, ("a", 1, None)).selectExpr(*wrong.split(", ")), SPEC)


def test_row_counts(spark):
    counts = RowCounts()
    df = counts.tap(spark.range(10), "read")
    df = counts.tap(df.where("id > 3"), "kept")
    df.count()
    assert counts.counts() == {"read": 10, "kept": 6}
    assert counts.removed() == {"kept": 4}


# --- digests ----------------------------------------------------------------


def test_set_digest_ignores_order_but_counts_repeats(spark):
    codes = [f"c{i}" for i in range(50)] + ["c1", "", None]
    shuffled = random.Random(1).sample(codes, len(codes))

    def of(values):
        df = spark.createDataFrame([(v,) for v in values], "c string").repartition(3)
        return tuple(digest.set_digest(df, "c").first())

    assert of(codes) == of(shuffled)
    assert of(codes)[0] == 51
    assert of(codes) != of(codes[:-3])  # one repeat less
    assert of(codes) != of([*codes[:-3], "c2"])


def test_set_digest_of_nothing(spark):
    empty = spark.createDataFrame([], "c string")
    assert digest.set_digest(empty, "c").first()["codes"] == 0


def test_payload_identity_counts_repeats_and_keeps_values_apart(spark):
    def identity(*codes):
        df = spark.createDataFrame([(c,) for c in codes], "c string")
        return tuple(digest.payload_identity(df, "c").first())

    assert identity("b", "é", "a", "a", "", None) == identity("a", "b", "a", "é")
    assert identity("a", "b")[1] != identity("a", "a", "b")[1]
    assert identity("ab", "c")[1] != identity("a", "bc")[1]


def test_sorted_digest_is_the_tree_over_sorted_codes(spark, monkeypatch):
    monkeypatch.setattr(digest, "FAN", 5)
    draw = random.Random(3)
    values = ["é", "z", "Z", "a:1", "aa", "\U0001f600", "\uffee"] + [str(i) for i in range(70)]
    rows = [(draw.choice(["x", "y", None]), draw.choice(values)) for _ in range(300)]
    rows += [("hot", "same")] * 200 + [("x", None), ("x", ""), ("none", None), ("none", "")]
    want = {}
    for group in {g for g, _ in rows}:
        codes = [c for g, c in rows if g == group and c]
        if not codes:
            continue
        hashes = [
            hashlib.sha256(f"{codes.count(c)}:{c}".encode()).hexdigest() for c in sorted(set(codes), key=str.encode)
        ]
        while len(hashes) > 1:
            joined = ["".join(hashes[i : i + 5]) for i in range(0, len(hashes), 5)]
            hashes = [hashlib.sha256(j.encode()).hexdigest() for j in joined]
        want[group] = (len(codes), hashes[0])

    def of(listed, by=("g",)):
        df = spark.createDataFrame(listed, "g string, c string").repartition(7)
        return digest.sorted_digest(df, "c", by).collect()

    assert {r["g"]: (r["codes"], r["digest"]) for r in of(rows)} == want
    draw.shuffle(rows)
    assert {r["g"]: (r["codes"], r["digest"]) for r in of(rows)} == want
    assert of([("x", None)]) == [] and of([("x", ""), ("y", "")], ()) == []
    assert len(of(rows, ())) == 1


def test_file_hashes(spark, tmp_path):
    content = {f"f{i}.bin": bytes([i]) * (i * 700_000 + 1) for i in range(4)}
    for name, data in content.items():
        (tmp_path / name).write_bytes(data)
    found = digest.file_hashes(spark, str(tmp_path)).collect()
    hashes = {r["path"].rsplit("/", 1)[1]: r["source_hash"] for r in found}
    assert hashes == {n: hashlib.sha256(d).hexdigest() for n, d in content.items()}


def test_a_file_larger_than_a_cell_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(digest, "CELL_LIMIT_BYTES", 10)
    (tmp_path / "large.bin").write_bytes(b"x" * 11)
    with pytest.raises(ValueError, match="large.bin"):
        digest.file_hashes(spark, str(tmp_path))


def tree_of(data, fan):
    lines = data.split(b"\n")[: -1 if data.endswith(b"\n") or not data else None]
    hashes = [hashlib.sha256(line).hexdigest() for line in lines]
    while len(hashes) > 1:
        joined = ["".join(hashes[i : i + fan]) for i in range(0, len(hashes), fan)]
        hashes = [hashlib.sha256(j.encode()).hexdigest() for j in joined]
    return len(data), len(lines), hashlib.sha256(f"{len(data)}:{len(lines)}:{hashes[0]}".encode()).hexdigest()


@pytest.mark.parametrize("block", ["128m", "700b"])
def test_hash_tree_of_files(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(digest, "FAN", 4)
    content = {
        "blank.bin": b"\n\n",
        "open end.bin": b"a\r\nb\n\xff\xfe c",
        "same+end%41.bin": b"a\r\nb\n\xff\xfe c\n",
        "long.bin": b"x" * 5_000 + b"\n" + b"y\n" * 50,
    }
    for name, data in content.items():
        (tmp_path / name).write_bytes(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        found = digest.tree_hashes(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {r["path"].rsplit("/", 1)[1]: (r["length"], r["lines"], r["source_hash"]) for r in found}
    assert got == {n: tree_of(d, 4) for n, d in content.items()}
    assert len({h for *_, h in got.values()}) == len(content)


def test_a_source_lands_in_parts_and_is_hashed_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "PART_BYTES", 4_000)
    monkeypatch.setattr(digest, "FAN", 100)
    rows = [(None if i % 50 == 49 else i, "hot" if i % 10 else "few", f"text {i} " * (i % 7)) for i in range(600)]
    texts = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    path = files.land_texts(texts, str(tmp_path / "landed"))
    parts = list((tmp_path / "landed" / "source=hot").glob("part-*"))
    assert len(parts) > 3 and max(p.stat().st_size for p in parts) < 16_000
    want = {}
    for i, source, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2])):
        want[source] = want.get(source, b"") + text.encode() + b"\n"
    found = digest.tree_hashes(spark, path, by_folder=True).collect()
    got = {r["path"].rsplit("=", 1)[1]: (r["length"], r["lines"], r["source_hash"]) for r in found}
    assert got == {s: tree_of(t, 100) for s, t in want.items()}


# --- paging -----------------------------------------------------------------


def paged(spark, pages, **options):
    df = spark.createDataFrame(
        [(i, p) for i, p in enumerate(pages)], "page bigint, items array<string>"
    )
    found = paging.paged_rows(df, **options)
    return [r["item"] for r in found.orderBy("page", "position").collect()]


def test_three_empty_pages_in_a_row_stop(spark):
    pages = [["a"], [], [], ["b", "c"], [], [], [], ["late"], []]
    assert paged(spark, pages) == ["a", "b", "c"]
    assert paged(spark, pages, empty_streak=2) == ["a"]
    assert paged(spark, pages, empty_streak=4) == ["a", "b", "c", "late"]
    assert paged(spark, pages, max_pages=1) == ["a"]


def reference_reader(pages, streak):
    kept, empty = [], 0
    for page in pages:
        if page:
            kept, empty = kept + page, 0
        else:
            empty += 1
            if empty >= streak:
                break
    return kept


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.booleans(), min_size=1, max_size=14), st.integers(1, 3))
def test_paging_property(spark, filled, streak):
    pages = [[f"{i}a", f"{i}b"] if f else [] for i, f in enumerate(filled)]
    assert paged(spark, pages, empty_streak=streak) == reference_reader(pages, streak)


def test_list_key_is_the_first_list_of_the_document(spark):
    payloads = [
        (0, '{"total": 2, "z_rows": [{"b": 1, "a": "é"}, {"b": 2}], "a_rows": [9]}'),
        (1, '{"a_rows": [7], "z_rows": []}'),
        (2, '{"total": 0}'),
    ]
    pages = spark.createDataFrame(payloads, "page bigint, payload string")
    keyed = paging.with_list_key(pages)
    assert {r["data_key"] for r in keyed.collect()} == {"z_rows"}
    items = keyed.withColumn("items", paging.page_items(F.col("payload"), F.col("data_key")))
    found = paging.paged_rows(items).orderBy("page", "position").collect()
    assert [r["item"] for r in found] == ['{"b":1,"a":"é"}', '{"b":2}']
    stats = paging.paging_stats(paging.paged_rows(items)).first()
    assert (stats["total_items"], stats["last_nonempty_page"]) == (2, 0)
