"""Cell-level functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.catalogue.inputs import (
    CARE_UNITS_SQL,
    ESTABLISHMENTS_SQL,
    case,
    raw_care_units,
    raw_establishments,
    table,
    whole,
)
from lamina.functions import calendar, cleaning, geo, measures
from lamina.operators.shaping import derive
from lamina.sources.raw import separator_of

QUERIES = {}
SQL = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


@_query
def clean_string_sentinels(spark: SparkSession, folder: str) -> DataFrame:
    raw = case(
        "c_mktsegment",
        {
            "'BUILDING'": "' nulo '",
            "'AUTOMOBILE'": r"concat('\u00a0', c_name, '\t')",
            "'FURNITURE'": "'n/a'",
            "'MACHINERY'": "concat('  ', c_name, ' x ')",
        },
        r"'\u3000'",
    )
    return (
        table(spark, folder, "customer")
        .selectExpr("c_custkey", f"{raw} AS raw")
        .selectExpr("c_custkey", f"{cleaning.clean_text('raw')} AS cleaned")
    )


SQL["clean_string_sentinels"] = """
SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN c_name
                                    WHEN 'MACHINERY' THEN c_name || ' x' END AS cleaned
FROM customer"""


@_query
def clean_whole_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").selectExpr(
        "doc_id", f"{cleaning.clean_text('text')} AS cleaned"
    )


SQL["clean_whole_text"] = """
WITH blank AS (SELECT string_agg(chr(c), '') AS chars
               FROM (SELECT unnest([9, 10, 11, 12, 13, 32, 133, 160, 5760, 8192, 8193, 8194, 8195,
                                    8196, 8197, 8198, 8199, 8200, 8201, 8202, 8232, 8233, 8239,
                                    8287, 12288]) AS c))
SELECT doc_id,
       CASE WHEN upper(trim(text, chars)) NOT IN ('', 'NULL', 'NULO', 'NA', 'N/A', 'NONE', 'NAN')
            THEN trim(text, chars) END AS cleaned
FROM documents, blank"""


@_query
def flag_from_number(spark: SparkSession, folder: str) -> DataFrame:
    raw = case(
        "l_linenumber",
        {"1": "'1.0'", "2": "'0.0'", "3": "'0.5'", "4": "'x'", "5": "NULL", "6": "' 1.0'"},
        "'7e-1'",
    )
    return (
        table(spark, folder, "lineitem")
        .selectExpr("l_linenumber", f"{raw} AS raw")
        .groupBy("l_linenumber", F.expr(f"{cleaning.flag_from_number('raw')} AS flag"))
        .agg(F.expr("count(*) AS n"))
    )


SQL["flag_from_number"] = """
SELECT l_linenumber, CASE WHEN l_linenumber IN (1, 7) THEN true
                          WHEN l_linenumber IN (2, 3) THEN false END AS flag, count(*) AS n
FROM lineitem GROUP BY ALL"""


@_query
def flag_from_word(spark: SparkSession, folder: str) -> DataFrame:
    word = case("o_orderstatus", {"'O'": "'True'", "'F'": "'FALSE'"}, "' true'")
    return (
        table(spark, folder, "orders")
        .selectExpr("o_orderkey", f"if(o_orderpriority <> '5-LOW', {word}, NULL) AS raw")
        .selectExpr("o_orderkey", f"{cleaning.flag_from_word('raw')} AS flag")
    )


SQL["flag_from_word"] = """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                        WHEN o_orderstatus = 'O' THEN true
                        WHEN o_orderstatus = 'F' THEN false END AS flag
FROM orders"""


@_query
def coord_envelope(spark: SparkSession, folder: str) -> DataFrame:
    return _located(spark, folder)


def _located(spark: SparkSession, folder: str) -> DataFrame:
    return raw_establishments(spark, folder).selectExpr(
        "CO_CNES AS co_cnes",
        f"{geo.coordinate('NU_LATITUDE', *geo.LATITUDE_RANGE)} AS nu_latitude",
        f"{geo.coordinate('NU_LONGITUDE', *geo.LONGITUDE_RANGE)} AS nu_longitude",
    )


SQL["coord_envelope"] = (
    f"WITH {ESTABLISHMENTS_SQL} SELECT co_cnes, nu_latitude, nu_longitude FROM establishments"
)


@_query
def coord_decimal_comma(spark: SparkSession, folder: str) -> DataFrame:
    latitude = geo.coordinate_decimal_comma("LATITUDE", *geo.LATITUDE_RANGE)
    longitude = geo.coordinate_decimal_comma("LONGITUDE", *geo.LONGITUDE_RANGE)
    return (
        raw_care_units(spark, folder)
        .selectExpr("NOME AS nome", f"{latitude} AS nu_latitude", f"{longitude} AS nu_longitude")
        .withColumn("has_point", F.expr(geo.point("nu_longitude", "nu_latitude")).isNotNull())
    )


SQL["coord_decimal_comma"] = f"""
WITH {CARE_UNITS_SQL.replace("WHERE s_suppkey <> 0", "")}
SELECT ' ' || no_unidade AS nome, nu_latitude, nu_longitude,
       nu_latitude IS NOT NULL AND nu_longitude IS NOT NULL AS has_point FROM care_units"""


def _amounts(spark: SparkSession, folder: str) -> DataFrame:
    number = whole("value")
    raw = case(
        "event_type",
        {
            "'view'": number,
            "'error'": f"concat({number}, '.0')",
            "'click'": f"concat({number}, '.9')",
            "'signup'": f"concat('-', {number})",
        },
        f"concat('x', {number})",
    )
    return table(spark, folder, "events").selectExpr("event_id", f"{raw} AS raw")


@_query
def lenient_int(spark: SparkSession, folder: str) -> DataFrame:
    return _amounts(spark, folder).selectExpr(
        "event_id", f"{cleaning.strict_count('raw')} AS amount"
    )


SQL["lenient_int"] = """
SELECT event_id, CASE event_type WHEN 'view' THEN floor(value) WHEN 'signup' THEN -floor(value)
                 ELSE 0 END::BIGINT AS amount FROM events"""


@_query
def lenient_count(spark: SparkSession, folder: str) -> DataFrame:
    return _amounts(spark, folder).selectExpr(
        "event_id", f"{cleaning.lenient_count('raw')} AS amount"
    )


SQL["lenient_count"] = """
SELECT event_id, CASE WHEN event_type IN ('view', 'error', 'click') THEN floor(value)
                 ELSE 0 END::BIGINT AS amount FROM events"""


@_query
def iso_timestamp_year(spark: SparkSession, folder: str) -> DataFrame:
    stamp = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS\")"
    raw = case(
        "event_type",
        {
            "'view'": f"concat({stamp}, 'Z')",
            "'purchase'": f"concat({stamp}, '+03:00')",
            "'error'": "date_format(ts, 'yyyy-MM-dd')",
            "'signup'": "date_format(ts, 'yyyy')",
        },
        "'garbage'",
    )
    return (
        table(spark, folder, "events")
        .selectExpr("event_id", f"{raw} AS raw")
        .selectExpr("event_id", f"{cleaning.utc_timestamp('raw')} AS parsed")
        .selectExpr(
            "event_id",
            "date_format(parsed, 'yyyy-MM-dd HH:mm:ss.SSS') AS moment",
            "year(parsed) AS ano",
        )
    )


SQL["iso_timestamp_year"] = """
SELECT event_id, strftime(moment, '%Y-%m-%d %H:%M:%S.%g') AS moment, year(moment)::INTEGER AS ano
FROM (SELECT event_id, CASE event_type WHEN 'view' THEN ts
                                       WHEN 'purchase' THEN ts - INTERVAL 3 HOUR END AS moment
      FROM events)"""


@_query
def month_key(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .groupBy(F.expr(f"{calendar.month_key('o_orderdate')} AS ano_mes"))
        .agg(F.expr("count(*) AS n"))
    )


SQL["month_key"] = """
SELECT strftime(o_orderdate, '%Y%m') AS ano_mes, count(*) AS n FROM orders GROUP BY 1"""


def _keys(spark: SparkSession, folder: str) -> DataFrame:
    raw = case(
        "p_type",
        {
            "'SMALL'": "concat('-', p_partkey)",
            "'MEDIUM'": "concat('+', p_partkey)",
            "'LARGE'": "concat('9000000', p_partkey)",
        },
        "string(p_partkey)",
    )
    return table(spark, folder, "part").selectExpr("p_partkey", f"{raw} AS raw")


@_query
def zero_fill(spark: SparkSession, folder: str) -> DataFrame:
    return _keys(spark, folder).selectExpr("p_partkey", f"{cleaning.zero_fill('raw', 7)} AS filled")


SQL["zero_fill"] = """
SELECT p_partkey,
       CASE p_type WHEN 'SMALL' THEN '-' || lpad(p_partkey::VARCHAR, 6, '0')
                   WHEN 'MEDIUM' THEN '+' || lpad(p_partkey::VARCHAR, 6, '0')
                   WHEN 'LARGE' THEN '9000000' || p_partkey
                   ELSE lpad(p_partkey::VARCHAR, 7, '0') END AS filled
FROM part"""


@_query
def lpad_key(spark: SparkSession, folder: str) -> DataFrame:
    return _keys(spark, folder).selectExpr("p_partkey", f"{cleaning.padded('raw', 7)} AS padded")


SQL["lpad_key"] = """
SELECT p_partkey,
       lpad(CASE p_type WHEN 'SMALL' THEN '-' || p_partkey WHEN 'MEDIUM' THEN '+' || p_partkey
                        WHEN 'LARGE' THEN '9000000' || p_partkey
                        ELSE p_partkey::VARCHAR END, 7, '0') AS padded
FROM part"""


@_query
def leading_year(spark: SparkSession, folder: str) -> DataFrame:
    period = case(
        "o_orderstatus",
        {"'F'": "date_format(o_orderdate, 'yyyyMM')", "'O'": "date_format(o_orderdate, 'yyyy')"},
        "'1x97'",
    )
    return (
        table(spark, folder, "orders")
        .selectExpr(f"{period} AS comp")
        .groupBy(F.expr(f"{cleaning.leading_year('comp')} AS ano"))
        .agg(F.expr("count(*) AS n"))
    )


SQL["leading_year"] = """
SELECT CASE WHEN o_orderstatus IN ('F', 'O') THEN year(o_orderdate) END::BIGINT AS ano,
       count(*) AS n FROM orders GROUP BY 1"""


@_query
def guarded_ratio(spark: SparkSession, folder: str) -> DataFrame:
    sizes = (
        table(spark, folder, "part")
        .groupBy("p_brand", "p_type")
        .agg(
            F.expr("sum(cast(p_size AS bigint)) AS total"),
            F.expr("count_if(p_size > 25) AS large"),
            F.expr("count_if(p_size > 48) AS capacity"),
            F.expr("count(*) AS parts"),
        )
    )
    return sizes.selectExpr(
        "p_brand",
        "p_type",
        f"double({measures.rounded_mean('total', 'parts')}) AS mean_size",
        f"double({measures.ratio('large', 'capacity')}) AS ratio",
        f"{measures.exceeds('large', 'capacity')} AS exceeded",
    )


SQL["guarded_ratio"] = """
SELECT p_brand, p_type, ((total * 200 + parts) // (2 * parts)) / 100 AS mean_size,
       CASE WHEN capacity > 0
            THEN ((large_parts * 20000 + capacity) // (2 * capacity)) / 10000 END AS ratio,
       capacity > 0 AND large_parts > capacity AS exceeded
FROM (SELECT p_brand, p_type, sum(p_size)::BIGINT AS total,
             count(*) FILTER (WHERE p_size > 25) AS large_parts,
             count(*) FILTER (WHERE p_size > 48) AS capacity, count(*) AS parts
      FROM part GROUP BY 1, 2)"""


@_query
def separator_detect(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").selectExpr(
        "doc_id", f"{separator_of('text')} AS separator"
    )


SQL["separator_detect"] = """
SELECT doc_id, CASE WHEN length(text) - length(replace(text, ';', '')) >
                         length(text) - length(replace(text, ',', ''))
                    THEN ';' ELSE ',' END AS separator
FROM documents"""


@_query
def radius_search(spark: SparkSession, folder: str) -> DataFrame:
    points = _located(spark, folder)
    found = geo.within_radius(points, longitude=-53.0, latitude=-14.0, metres=600_000.0)
    return found.select("co_cnes", F.round("distance_m", 3).alias("distance_m"))


SQL["radius_search"] = f"""
WITH {ESTABLISHMENTS_SQL}
SELECT co_cnes, round(metres, 3) AS distance_m
FROM (SELECT co_cnes,
             2 * 6371008.8 * asin(sqrt(
               pow(sin(radians(nu_latitude + 14) / 2), 2) +
               cos(radians(-14)) * cos(radians(nu_latitude)) *
               pow(sin(radians(nu_longitude + 53) / 2), 2))) AS metres
      FROM establishments)
WHERE metres <= 600000"""


@_query
def radius_join(spark: SparkSession, folder: str) -> DataFrame:
    """Establishments within 80 km of every supplier, on the spheroid."""
    centres = table(spark, folder, "supplier").selectExpr(
        "s_suppkey",
        "(bigint(s_suppkey) * 37 % 42000) / 1000D - 75D AS longitude",
        "(bigint(round(s_acctbal * 100)) * 45 - 36000000) / 1e6D AS latitude",
    )
    found = geo.radius_join(_located(spark, folder), centres, 80_000.0)
    return found.select("s_suppkey", "co_cnes", F.round("distance_m", 2).alias("distance_m"))


SQL["radius_join"] = f"""
WITH {ESTABLISHMENTS_SQL},
centres AS (
  SELECT s_suppkey, (s_suppkey::BIGINT * 37 % 42000) / 1000::DOUBLE - 75 AS longitude,
         (round(s_acctbal * 100)::BIGINT * 45 - 36000000)::DOUBLE / 1e6 AS latitude FROM supplier),
angles AS (
  SELECT s_suppkey, co_cnes, radians(latitude + nu_latitude) / 2 AS f, radians(latitude - nu_latitude) / 2 AS g,
         radians(longitude - nu_longitude) / 2 AS l
  FROM centres, establishments WHERE nu_latitude IS NOT NULL AND nu_longitude IS NOT NULL),
squares AS (
  SELECT *, pow(sin(g), 2) * pow(cos(l), 2) + pow(cos(f), 2) * pow(sin(l), 2) AS s,
         pow(cos(g), 2) * pow(cos(l), 2) + pow(sin(f), 2) * pow(sin(l), 2) AS c FROM angles),
widths AS (SELECT *, atan(sqrt(s / c)) AS w FROM squares WHERE s > 0),
spheroid AS (
  SELECT s_suppkey, co_cnes, 2 * w * 6378137.0::DOUBLE * (1 + 1 / 298.257223563::DOUBLE * (
           (3 * (sqrt(s * c) / w) - 1) / (2 * c) * pow(sin(f), 2) * pow(cos(g), 2)
         - (3 * (sqrt(s * c) / w) + 1) / (2 * s) * pow(cos(f), 2) * pow(sin(g), 2))) AS metres
  FROM widths UNION ALL SELECT s_suppkey, co_cnes, 0 FROM squares WHERE s = 0)
SELECT s_suppkey, co_cnes, round(metres, 2) AS distance_m FROM spheroid WHERE metres <= 80000"""


@_query
def date_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar over the span of the orders, with the orders of each day."""
    ordered = table(spark, folder, "orders").selectExpr("to_date(o_orderdate) AS data")
    span = ordered.selectExpr("min(data) AS first", "max(data) AS last")
    days = span.selectExpr(f"{calendar.days_between('first', 'last')} AS data")
    per_day = ordered.groupBy("data").agg(F.expr("count(*) AS orders"))
    known = days.join(per_day, "data", "left")
    attributes = calendar.calendar_attributes("data")
    full = derive(known, {**attributes, "orders": "coalesce(orders, 0L)"})
    return full.withColumn("data", F.date_format("data", "yyyy-MM-dd"))


SQL["date_dimension"] = """
SELECT strftime(d, '%Y-%m-%d') AS data, coalesce(n, 0) AS orders,
       year(d)::INTEGER AS ano, month(d)::INTEGER AS mes, day(d)::INTEGER AS dia,
       quarter(d)::INTEGER AS trimestre, CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS semestre,
       strftime(d, '%Y%m') AS ano_mes, strftime(d, '%Y-%m') AS ano_mes_label,
       strftime(d, '%B') AS nome_mes, strftime(d, '%b') AS nome_mes_abrev,
       isodow(d)::INTEGER AS dia_semana, strftime(d, '%A') AS nome_dia_semana,
       isodow(d) IN (6, 7) AS eh_fim_de_semana, weekofyear(d)::INTEGER AS semana_iso,
       dayofyear(d)::INTEGER AS dia_do_ano,
       d BETWEEN DATE '2020-03-01' AND DATE '2022-12-31' AS eh_periodo_covid
FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS d
      FROM (SELECT min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi FROM orders))
LEFT JOIN (SELECT o_orderdate::DATE AS day_ordered, count(*) AS n FROM orders GROUP BY 1)
  ON day_ordered = d"""
