"""Unions, deduplication, snapshots, contracts and counts over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.catalogue.inputs import BEDS_SQL, EXTRACTED, INGESTED, raw_beds, table
from lamina.columns import columns
from lamina.functions import cleaning
from lamina.functions.cleaning import clean_text
from lamina.functions.measures import rounded_total
from lamina.operators.contracts import TableSpec, duplicate_keys, violation_counts
from lamina.operators.latest import keep_last, latest_snapshot, latest_snapshot_per
from lamina.operators.shaping import (
    align,
    derive,
    keep_known,
    rename_known,
    rename_strict,
    text_columns,
    union_drifted,
)
from lamina.operators.quality import RowCounts
from lamina.plans import silver
from lamina.plans.sources import BED_NAMES

QUERIES = {}
SQL = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


@_query
def strict_rename(spark: SparkSession, folder: str) -> DataFrame:
    names = {"s_suppkey": "codigo", "s_name": "nome", "s_nationkey": "pais", "s_acctbal": "saldo"}
    return rename_strict(table(spark, folder, "supplier"), names)


SQL["strict_rename"] = """
SELECT s_suppkey AS codigo, s_name AS nome, s_nationkey AS pais, s_acctbal AS saldo FROM supplier"""


@_query
def text_cleaning_by_type(spark: SparkSession, folder: str) -> DataFrame:
    """Every string column is cleaned, found by its type; one is left out by name."""
    part = table(spark, folder, "part").withColumn("_note", F.lit(" kept "))
    padded = part.withColumn("p_name", F.concat(F.lit(" "), "p_name", F.lit(" ")))
    return derive(padded, {c: clean_text(c) for c in text_columns(padded, {"p_brand"})})


SQL["text_cleaning_by_type"] = """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, ' kept ' AS _note FROM part"""


@_query
def schema_drift_union(spark: SparkSession, folder: str) -> DataFrame:
    """Two header spellings under one name, unknown columns dropped, missing ones NULL."""
    wanted = {"comp", "cnes", "municipio", "leitos_existentes", "uti_total_exist"}
    older, newer = raw_beds(spark, folder).values()
    older = older.drop("MUNICIPIO").withColumn("DESCONHECIDA", F.lit("?"))
    frames = [keep_known(rename_known(f, BED_NAMES), wanted) for f in (older, newer)]
    return union_drifted(frames)


SQL["schema_drift_union"] = """
SELECT strftime(l_shipdate + INTERVAL 25 YEAR, '%Y%m') AS comp,
       lpad(l_partkey::VARCHAR, 7, '0') AS cnes,
       CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01'
             AND (l_returnflag <> 'A' OR l_linestatus <> 'F')
            THEN l_returnflag || l_linestatus END AS municipio,
       floor(l_quantity)::BIGINT::VARCHAR AS leitos_existentes,
       CASE WHEN l_discount = 0 THEN '0' ELSE l_linenumber::VARCHAR END AS uti_total_exist
FROM lineitem"""


@_query
def period_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Only six digits are a period; NULL, other lengths and a line break are not."""
    period = F.date_format("o_orderdate", "yyyyMM")
    dirty = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(period, F.lit("\n")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM"))
        .when(F.col("o_orderpriority") != "5-LOW", period)
    )
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", dirty.alias("comp"))
        .where(cleaning.is_period("comp"))
    )


SQL["period_filter"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS comp FROM orders
WHERE o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED')"""


@_query
def keep_last_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Newest event per user and type; the missing types are one key of their own."""
    events = table(spark, folder, "events").withColumn(
        "event_type", F.when(F.col("event_type") != "error", F.col("event_type"))
    )
    return keep_last(events, ["user_id", "event_type"], ["ts", "event_id"])


SQL["keep_last_dedup"] = """
SELECT event_id, ts, user_id, event_type, value, props
FROM (SELECT * REPLACE (nullif(event_type, 'error') AS event_type),
             row_number() OVER (PARTITION BY user_id, nullif(event_type, 'error')
                                ORDER BY ts DESC, event_id DESC) AS position
      FROM events)
WHERE position = 1"""


@_query
def latest_snapshot_rows(spark: SparkSession, folder: str) -> DataFrame:
    return latest_snapshot(table(spark, folder, "orders"), "o_orderdate").drop("o_orderdate")


SQL["latest_snapshot_rows"] = """
SELECT * EXCLUDE (o_orderdate) FROM orders
WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)"""


@_query
def latest_snapshot_per_year(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn("ano", F.year("o_orderdate"))
    return latest_snapshot_per(orders, ["ano"], "o_orderdate").drop("o_orderdate")


SQL["latest_snapshot_per_year"] = """
SELECT * EXCLUDE (o_orderdate, newest) FROM (
  SELECT *, year(o_orderdate)::INTEGER AS ano,
         max(o_orderdate) OVER (PARTITION BY year(o_orderdate)) AS newest FROM orders)
WHERE o_orderdate = newest"""


@_query
def soft_delete_filter(spark: SparkSession, folder: str) -> DataFrame:
    deleted = F.when(F.col("o_orderstatus") == "P", True).when(
        F.col("o_orderstatus") == "F", False
    )
    return (
        table(spark, folder, "orders")
        .withColumn("excluido", deleted)
        .where(cleaning.not_deleted("excluido"))
        .select("o_orderkey", "o_orderstatus")
    )


SQL["soft_delete_filter"] = """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'"""


@_query
def additive_columns(spark: SparkSession, folder: str) -> DataFrame:
    """An older table read under a newer schema: new columns take their default."""
    schema = columns(
        "n_nationkey bigint, n_name string, is_ubs boolean, categoria string"
    )
    return align(table(spark, folder, "nation"), schema, {"is_ubs": False})


SQL["additive_columns"] = """
SELECT n_nationkey::BIGINT AS n_nationkey, n_name, false AS is_ubs, NULL::VARCHAR AS categoria
FROM nation"""


_ORDERS = TableSpec(
    name="orders",
    schema=columns(
        "o_orderkey bigint not null, o_totalprice double not null, o_orderpriority string, "
        "o_orderstatus string not null"
    ),
    key=("o_orderkey",),
    ranges={"o_totalprice": (50_000, 400_000)},
    patterns={"o_orderpriority": r"^[0-9]-[A-Z]+\z"},
)


@_query
def contract_report(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    )
    return violation_counts(orders, _ORDERS)


SQL["contract_report"] = """
SELECT 'not_null' AS rule, 'o_orderkey' AS "column",
       count(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM orders
UNION ALL SELECT 'not_null', 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NULL) FROM orders
UNION ALL SELECT 'not_null', 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus = 'P') FROM orders
UNION ALL SELECT 'range', 'o_totalprice',
  count(*) FILTER (WHERE o_totalprice < 50000 OR o_totalprice > 400000) FROM orders
UNION ALL SELECT 'pattern', 'o_orderpriority',
  count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') FROM orders"""


@_query
def pk_violations(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


SQL["pk_violations"] = """
SELECT l_orderkey, l_linenumber, count(*) AS "rows" FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1"""


@_query
def filtered_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows around the filter and the deduplication, counted while a job runs."""
    counts = RowCounts()
    table_ = silver.beds(raw_beds(spark, folder), EXTRACTED, cleansed_at=INGESTED, counts=counts)
    table_.df.write.format("noop").mode("overwrite").save()
    rows = counts.counts()
    return spark.createDataFrame(
        [tuple(rows.values())], ", ".join(f"{stage} bigint" for stage in rows)
    )


SQL["filtered_row_counts"] = f"""
WITH {BEDS_SQL}
SELECT count(*) AS "read", count(*) AS valid_period, (SELECT count(*) FROM beds) AS deduplicated
FROM lineitem"""


@_query
def kpi_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Filtered counts in one pass; a NULL condition does not count."""
    unknown = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") > 5000)
    return table(spark, folder, "customer").agg(
        F.count_if(F.col("c_mktsegment") == "BUILDING").alias("building"),
        F.count_if(unknown).alias("rich"),
        F.count_if(~unknown).alias("not_rich"),
        F.count_distinct("c_nationkey").alias("nations"),
    )


SQL["kpi_counts"] = """
SELECT count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS building,
       count(*) FILTER (WHERE c_acctbal > 5000) AS rich,
       count(*) FILTER (WHERE c_acctbal >= 0 AND c_acctbal <= 5000) AS not_rich,
       count(DISTINCT c_nationkey) AS nations
FROM customer"""


@_query
def total_rounded(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_returnflag")
        .agg(F.expr(f"{rounded_total('cast(l_extendedprice AS decimal(12,2))')} AS total"))
    )


SQL["total_rounded"] = """
SELECT l_returnflag, ((sum(round(l_extendedprice * 100)::HUGEINT) * 2 + 100) // 200)::BIGINT AS total
FROM lineitem GROUP BY 1"""
