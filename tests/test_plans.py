"""The plans hold at scale: what is pushed, broadcast, pre-aggregated, split."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from lamina.catalogue import inputs, star
from lamina.operators import digest, paging
from lamina.operators.latest import keep_last
from lamina.plans import gold, schemas
from lamina.session import scratch_folder, size_shuffles, sized_shuffles
from lamina.sinks import tables
from lamina.sources.staged import read_newest

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    """Silver tables as a reader finds them: partitioned Parquet."""
    root = scratch_folder(spark, "plans")
    made = {
        "beds": (star._beds(spark, FOLDER), schemas.BEDS),
        "occupancy": (star._occupancy(spark, FOLDER), schemas.OCCUPANCY),
        "establishments": (star._establishments(spark, FOLDER), schemas.ESTABLISHMENTS),
        "care_units": (star._care_units(spark, FOLDER), schemas.CARE_UNITS),
    }
    for name, (df, spec) in made.items():
        tables.load_silver(df, f"{root}/{name}", spec, inputs.EXTRACTED)
    return {name: read_newest(spark, f"{root}/{name}") for name in made}


def test_facts_read_their_columns_and_partition_only(stored):
    text = plan(gold.fact_beds(stored["beds"], snapshot=inputs.EXTRACTED))
    assert "PartitionFilters: [isnotnull(_extraction_date" in text
    assert re.search(r"ReadSchema: struct<ano_referencia:int,cnes:string,leitos_existentes:int", text)
    assert "razao_social" not in text
    # One shuffle, after a partial aggregation.
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text


def test_unknown_snapshot_prunes_by_subquery(spark, stored):
    text = plan(gold.fact_beds(stored["beds"]))
    assert "Subquery" in text and "PartitionFilters" in text


def test_only_literals_are_broadcast_by_hint(spark, stored):
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(
            gold.dim_establishment(
                stored["establishments"],
                stored["care_units"],
                snapshot=inputs.EXTRACTED,
                care_unit_snapshot=inputs.EXTRACTED,
            )
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    assert text.count("BroadcastHashJoin") == 3
    assert text.count("SortMergeJoin") == 1
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_no_query_multiplies_rows(spark):
    for name in ("municipality_mode", "overload_ranking", "top_states", "kpi_card"):
        text = plan(star.QUERIES[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_pressure_filters_years_on_both_sides(stored):
    fact = gold.fact_pressure(
        gold.fact_occupancy(stored["occupancy"], snapshot=inputs.EXTRACTED),
        gold.fact_beds(stored["beds"], snapshot=inputs.EXTRACTED),
    )
    assert plan(fact).count("GreaterThanOrEqual(ano_referencia,2020)") == 2


def test_history_by_year_does_not_shuffle_the_table(stored):
    text = plan(gold.fact_beds(stored["beds"], latest_per_year=True))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_a_hot_key_crosses_the_shuffle_once_per_task(spark):
    rows = spark.range(0, 200_000, 1, 8).selectExpr(
        "if(id % 3 = 0, NULL, cast(id AS string)) AS k", "id AS o"
    )
    kept = keep_last(rows, ["k"], ["o"])
    assert kept.count() == 133_333 + 1
    assert kept.where("k IS NULL").first()["o"] == 199_998


def test_digest_and_paging_use_partial_aggregation(spark):
    codes = spark.range(1000).selectExpr("cast(id AS string) AS c")
    text = plan(digest.set_digest(codes, "c"))
    assert "partial_sum" in text and "collect_list" not in text
    pages = spark.range(100).selectExpr("id AS page", "cast(array() AS array<string>) AS items")
    text = plan(paging.pages_before_stop(pages.withColumn("g", F.lit(1)), by=["g"]))
    assert "Window" not in text and "partial_count" in text


def test_shuffle_size_follows_the_input(spark):
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    try:
        assert size_shuffles(spark, 1 << 20) == int(previous)
        assert size_shuffles(spark, 1 << 40) == 4096
        assert size_shuffles(spark, 100 << 40) == 409_600
        assert size_shuffles(spark, 0) == 409_600
    finally:
        spark.conf.set(key, previous)
    with sized_shuffles(spark, 100 << 40) as chosen:
        assert int(spark.conf.get(key)) == chosen == 409_600
    assert spark.conf.get(key) == previous
