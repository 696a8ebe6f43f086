from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lamina.columns import columns
from lamina.operators.contracts import ContractViolation, TableSpec
from lamina.session import scratch_folder
from lamina.sinks import tables
from lamina.sources import raw, staged
from lamina.sources.folders import matching


@pytest.fixture
def folder(spark):
    return scratch_folder(spark, "test")


def write(tmp_path, name, data, encoding="ISO-8859-1"):
    path = tmp_path / name
    path.write_bytes(data.encode(encoding))
    return str(path)


# --- CSV --------------------------------------------------------------------


def test_csv_cells(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'A;NOME COM ESPAÇO;C\n01;"São; ""x""\nfim";\n02;;3\n')
    df = raw.read_csv(spark, path, separator=";", encoding="ISO-8859-1")
    assert df.columns == ["A", "NOME COM ESPAÇO", "C", *raw.SEQUENCE_COLUMNS]
    found = [tuple(r)[:4] for r in df.orderBy("_row_seq").collect()]
    assert found == [("01", 'São; "x"\nfim', None, "a.csv"), ("02", None, "3", "a.csv")]


def test_csv_rejects_long_rows_even_if_the_cell_is_not_read(spark, tmp_path):
    path = write(tmp_path, "a.csv", "A;B\n1;2\n3;4;5\n")
    with pytest.raises(PySparkException, match="malformed row in"):
        raw.read_csv(spark, path, separator=";", encoding="UTF-8").select("A").collect()


def test_csv_separator_inside_quotes_is_not_a_long_row(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'A;B\n"1;1;1"\n')
    df = raw.read_csv(spark, path, separator=";", encoding="UTF-8")
    assert [tuple(r)[:2] for r in df.collect()] == [("1;1;1", None)]


def test_csv_short_rows_are_padded_or_rejected(spark, tmp_path):
    path = write(tmp_path, "a.csv", "A;B;C\n1;2\n4;5;6\n")
    df = raw.read_csv(spark, path, separator=";", encoding="UTF-8")
    assert [tuple(r)[:3] for r in df.orderBy("_row_seq").collect()] == [
        ("1", "2", None),
        ("4", "5", "6"),
    ]
    strict = raw.read_csv(spark, path, separator=";", encoding="UTF-8", pad_short_rows=False)
    with pytest.raises(PySparkException, match="malformed row in"):
        strict.collect()


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_sequence_follows_the_file(spark, tmp_path, multi_line):
    lines = "\n".join(f"{i},{'x' * 50}" for i in range(5000))
    path = write(tmp_path, "a.csv", f"A,B\n{lines}\n")
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        df = raw.read_csv(
            spark, path, separator=",", encoding="UTF-8", multi_line=multi_line
        )
        ordered = df.orderBy(*raw.SEQUENCE_COLUMNS).select("A").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)
    assert [int(r["A"]) for r in ordered] == list(range(5000))


def test_csv_separator_per_file(spark, tmp_path):
    for name, text in (("a.csv", "A,B\n1,2\n"), ("b.csv", "A;B\n1;2\n"), ("c.csv", "A\n1\n")):
        df = raw.read_csv_detected(spark, write(tmp_path, name, text), encoding="ISO-8859-1")
        assert df.first()["A"] == "1"
    with pytest.raises(FileNotFoundError):
        raw.read_csv_detected(spark, str(tmp_path / "none.csv"), encoding="UTF-8")


def test_blank_header_cell(spark, tmp_path):
    path = write(tmp_path, "a.csv", ",_id\n0,x\n")
    df = raw.read_csv(spark, path, separator=",", encoding="UTF-8")
    assert df.columns[:2] == ["_c0", "_id"]


# --- JSON -------------------------------------------------------------------


def test_json_pages(spark, tmp_path):
    (tmp_path / "page_0000.json").write_text('[{"a": 1, "b": "x"}, {"a": 2.5, "c": {"d": 1}}]')
    (tmp_path / "page_0001.json").write_text('[{"a": true, "b": null}]')
    df = raw.read_json_pages(spark, f"{tmp_path}/page_*.json")
    assert {t for c, t in df.dtypes if c in "abc"} == {"string"}
    found = df.orderBy("_source_file", "_row_seq").select("a", "b", "c").collect()
    assert [tuple(r) for r in found] == [
        ("1", "x", None),
        ("2.5", None, '{"d":"1"}'),
        ("true", None, None),
    ]


def test_land_json_limits_a_file(spark, folder):
    tables.land_json(spark.range(2500).coalesce(1), folder)
    files = matching(spark, f"{folder}/*.json")
    assert len(files) == 3
    assert raw.read_json_pages(spark, folder, whole_file=False).count() == 2500


# --- staged -----------------------------------------------------------------


def test_yearly_files(spark, folder):
    def put(name, sql):
        tables.stage(spark.sql(sql), f"{folder}/{name}")

    put("leitos_2021.parquet", "SELECT '202101' AS COMP")
    put("leitos_2020.parquet", "SELECT '202001' AS COMP, 'x' AS EXTRA")
    put("leitos_2025.parquet", "SELECT 'a;b;c' AS `COMP;UF;CNES`")
    put("leitos_abc.parquet", "SELECT 1 AS a")
    put("other_2020.parquet", "SELECT 1 AS a")
    found = staged.read_yearly(spark, folder, "leitos", "COMP")
    assert sorted(found.frames) == [2020, 2021]
    assert found.skipped_years == [2025]
    assert found.frames[2020].columns == ["COMP", "EXTRA"]
    with pytest.raises(FileNotFoundError):
        staged.read_yearly(spark, folder, "covid_ocupacao")
    with pytest.raises(RuntimeError):
        staged.read_yearly(spark, folder, "leitos", "NOT THERE")


def test_year_of_file(spark, folder):
    tables.stage(spark.range(1), f"{folder}/leitos_2020.parquet")
    tables.stage(spark.range(1), f"{folder}/other.parquet")
    df = spark.read.parquet(f"{folder}/leitos_2020.parquet", f"{folder}/other.parquet")
    years = df.select(raw.year_of_file(r"leitos_(\d{4})\.parquet").alias("y")).collect()
    assert {r["y"] for r in years} == {2020, None}


def test_missing_parquet(spark, folder):
    with pytest.raises(FileNotFoundError):
        staged.read_staged(spark, folder)


def test_staging_is_immutable(spark, folder):
    tables.stage(spark.range(1), folder)
    with pytest.raises(PySparkException):
        tables.stage(spark.range(2), folder)
    assert spark.read.parquet(folder).count() == 1


# --- partitions -------------------------------------------------------------

JAN, FEB = date(2026, 1, 1), date(2026, 2, 1)


def dated(spark, *values):
    return spark.createDataFrame(list(values), "k string, n int, _extraction_date date")


def state(spark, path):
    df = spark.read.parquet(path).select("k", "n", "_extraction_date")
    return sorted(tuple(r) for r in df.collect())


def put(df, path, value):
    return tables.replace_partition(
        df, path, partition_column="_extraction_date", partition_value=value
    )


def test_replace_partition_is_idempotent(spark, folder):
    assert put(dated(spark, ("a", 1, JAN), ("b", 2, JAN)), folder, JAN) == 2
    assert put(dated(spark, ("c", 3, FEB)), folder, FEB) == 1
    for _ in range(2):
        assert put(dated(spark, ("d", 4, JAN)), folder, JAN) == 1
        assert state(spark, folder) == [("c", 3, FEB), ("d", 4, JAN)]


def test_empty_input_empties_the_partition(spark, folder):
    put(dated(spark, ("a", 1, JAN)), folder, JAN)
    put(dated(spark, ("c", 3, FEB)), folder, FEB)
    assert put(dated(spark), folder, JAN) == 0
    assert state(spark, folder) == [("c", 3, FEB)]


def test_foreign_rows_fail_and_change_nothing(spark, folder):
    put(dated(spark, ("a", 1, JAN)), folder, JAN)
    with pytest.raises(PySparkException, match="row outside partition"):
        put(dated(spark, ("b", 2, JAN), ("c", 3, FEB)), folder, JAN)
    assert state(spark, folder) == [("a", 1, JAN)]


def test_replace_whole_table(spark, folder):
    for n in (3, 2):
        assert tables.replace_partition(spark.range(n).toDF("n"), folder) == n
        assert spark.read.parquet(folder).count() == n


SPEC = TableSpec(
    name="t",
    schema=columns("k string not null, n int not null, _extraction_date date not null"),
    key=("_extraction_date", "k"),
    ranges={"n": (0, None)},
    partition="_extraction_date",
)


def test_load_silver_commits_nothing_on_failure(spark, folder):
    assert tables.load_silver(dated(spark, ("a", 1, JAN)), folder, SPEC, JAN) == 1
    with pytest.raises(ContractViolation, match="range on n"):
        tables.load_silver(dated(spark, ("a", 2, JAN), ("b", -1, JAN)), folder, SPEC, JAN)
    with pytest.raises(ContractViolation, match="duplicate"):
        tables.load_silver(dated(spark, ("a", 2, JAN), ("a", 3, JAN)), folder, SPEC, JAN)
    assert state(spark, folder) == [("a", 1, JAN)]


def test_a_rejected_load_counts_every_broken_rule(spark, folder):
    assert tables.load_silver(dated(spark, ("a", 1, JAN)), folder, SPEC, JAN) == 1
    bad = [("a", -1, JAN), ("a", -2, JAN), ("a", None, JAN), ("b", None, JAN), (None, 4, JAN), ("c", 5, JAN)]
    with pytest.raises(ContractViolation, match="contract of t broken") as found:
        tables.load_silver(dated(spark, *bad), folder, SPEC, JAN)
    assert found.value.counts == {
        ("not_null", "k"): 1,
        ("not_null", "n"): 2,
        ("range", "n"): 2,
        ("duplicate", "_extraction_date, k"): 2,
    }
    assert state(spark, folder) == [("a", 1, JAN)]
    assert not list(Path(folder).glob("_next*")) and not list(Path(folder).glob("*/_next*"))
    assert tables.load_silver(dated(spark), folder, SPEC, JAN) == 0


def test_newest_partition_is_pruned(spark, folder):
    tables.append_partition(dated(spark, ("a", 1, JAN), ("b", 2, FEB)), folder)
    assert staged.newest_partition(spark, folder) == FEB
    df = staged.read_newest(spark, folder)
    assert [r["k"] for r in df.collect()] == ["b"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_extraction_date" in plan
    with pytest.raises(FileNotFoundError):
        staged.newest_partition(spark, f"{folder}/nothing")


# --- rebuilds ---------------------------------------------------------------

FACT = TableSpec(name="f", schema=columns("id bigint not null"), key=("id",))


def test_rebuild_publishes_only_checked_versions(spark, folder):
    with pytest.raises(FileNotFoundError):
        tables.read_rebuilt(spark, folder)
    assert tables.rebuild(spark.range(3), folder, FACT) == 3
    old = tables.read_rebuilt(spark, folder)
    with pytest.raises(ContractViolation):
        tables.rebuild(spark.range(2).union(spark.range(1)), folder, FACT)
    assert tables.read_rebuilt(spark, folder).count() == 3
    assert tables.rebuild(spark.range(5), folder, FACT) == 5
    assert tables.read_rebuilt(spark, folder).count() == 5
    assert old.count() == 3  # a reader of the old version is undisturbed
    # The table may be derived from itself: the old version is still there.
    again = tables.read_rebuilt(spark, folder).where("id > 0")
    assert tables.rebuild(again, folder, FACT) == 4
    assert tables.drop_old_versions(spark, folder, keep=1) == 2
    assert tables.read_rebuilt(spark, folder).count() == 4


def test_an_empty_partitioned_version_can_be_read(spark, folder):
    spec = TableSpec(
        name="f", schema=columns("id bigint not null, y int not null"), key=("id",), partition="y"
    )
    some = spark.sql("SELECT 1L AS id, 2021 AS y")
    assert tables.rebuild(some, folder, spec) == 1
    assert tables.rebuild(some.where("false"), folder, spec) == 0
    df = tables.read_rebuilt(spark, folder, spec)
    assert (df.columns, df.count()) == (["id", "y"], 0)


def test_count_rows(spark):
    df = spark.range(10)
    assert tables.count_rows(df) == 10
    assert tables.count_rows(df, "id >= 7") == 3
    assert tables.count_rows(df, F.col("id") < 2) == 2
