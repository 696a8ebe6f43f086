"""Broken input fails the job, and a failed replacement leaves the old rows."""

from __future__ import annotations

from datetime import date

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lamina.plans import bronze
from lamina.sinks import tables
from lamina.sources import raw


def pages(tmp_path, *texts):
    for i, text in enumerate(texts):
        (tmp_path / f"page_{i:04d}.json").write_text(text)
    return str(tmp_path / "page_*.json")


def test_a_truncated_api_page_names_itself(spark, tmp_path):
    found = pages(tmp_path, '{"items": [{"a": 1}]}', '{"items": [{"a"', '{"items": [{"a": 3}]}')
    with pytest.raises((Py4JJavaError, PySparkException), match="page 1 is not a JSON object"):
        bronze.land_api_pages(spark, found, str(tmp_path / "landed"))


def test_an_answer_without_records_is_an_error(spark, tmp_path):
    found = pages(tmp_path, '{"error": "quota"}')
    with pytest.raises((Py4JJavaError, PySparkException), match="no page has a list of records"):
        bronze.land_api_pages(spark, found, str(tmp_path / "landed"))


def test_a_later_page_without_the_key_is_empty(spark, tmp_path):
    found = pages(tmp_path, '{"items": [{"a": 1}]}', '{"total": 1}')
    landed = bronze.land_api_pages(spark, found, str(tmp_path / "landed"))
    assert spark.read.text(landed).count() == 1


@pytest.mark.parametrize("whole_file", [True, False])
def test_a_truncated_landed_page_is_an_error(spark, tmp_path, whole_file):
    (tmp_path / "page_0000.json").write_text('[{"a": "1"}]' if whole_file else '{"a": "1"}')
    (tmp_path / "page_0001.json").write_text('[{"a": "2"' if whole_file else '{"a": "2')
    with pytest.raises((Py4JJavaError, PySparkException)):
        raw.read_json_pages(spark, str(tmp_path / "page_*.json"), whole_file=whole_file).collect()


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize("first,second", [("A;B", "B;A"), (";B", "B;")])
def test_files_of_one_dataset_share_their_header(spark, tmp_path, multi_line, first, second):
    (tmp_path / "part-0.csv").write_text(f"{first}\n1;2\n")
    (tmp_path / "part-1.csv").write_text(f"{second}\n2;1\n")
    with pytest.raises((Py4JJavaError, PySparkException, raw.MalformedFile)):
        raw.read_csv(
            spark, str(tmp_path / "part-*.csv"), separator=";", encoding="UTF-8", multi_line=multi_line
        ).collect()


def test_a_cell_that_blocks_would_cut_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A;B;C\n1;"x\ny";2\n')
    options = {"separator": ";", "encoding": "UTF-8"}
    assert raw.read_csv(spark, str(tmp_path / "a.csv"), **options).first()["B"] == "x\ny"
    with pytest.raises((Py4JJavaError, PySparkException), match="malformed row"):
        raw.read_csv(spark, str(tmp_path / "a.csv"), multi_line=False, **options).collect()


def failing(spark):
    return spark.range(20).withColumn("id", F.when(F.col("id") > 15, F.raise_error("lost").cast("bigint")).otherwise(F.col("id")))


def test_a_failed_replacement_leaves_the_old_rows(spark, tmp_path):
    whole, part, stage = (str(tmp_path / n) for n in ("whole", "part", "stage/x.parquet"))
    day = date(2026, 6, 10)
    dated = spark.range(10).withColumn("d", F.lit(day))
    assert tables.replace_partition(spark.range(10), whole) == 10
    assert tables.replace_partition(dated, part, partition_column="d", partition_value=day) == 10
    tables.stage(spark.range(10), stage, replace=True)
    with pytest.raises((Py4JJavaError, PySparkException)):
        tables.replace_partition(failing(spark), whole)
    with pytest.raises((Py4JJavaError, PySparkException)):
        tables.replace_partition(
            failing(spark).withColumn("d", F.lit(day)), part, partition_column="d", partition_value=day
        )
    with pytest.raises((Py4JJavaError, PySparkException)):
        tables.stage(failing(spark), stage, replace=True)
    for path in (whole, part, stage):
        assert spark.read.parquet(path).count() == 10
    assert tables.replace_partition(spark.range(3), whole) == 3
    assert tables.replace_partition(dated.limit(0), part, partition_column="d", partition_value=day) == 0


def test_partition_folders_are_spelled_as_spark_spells_them(spark, tmp_path):
    path = str(tmp_path / "odd")
    for value in ("a/b:c", "d=e", "plain", None):
        rows = spark.range(3).withColumn("k", F.lit(value).cast("string"))
        assert tables.replace_partition(rows, path, partition_column="k", partition_value=value) == 3
    found = spark.read.parquet(path).groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in found} == {"a/b:c": 3, "d=e": 3, "plain": 3, None: 3}
