"""Sources and sinks: whole tables written to the shared folder and read back."""

from __future__ import annotations

import math
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.catalogue import star
from lamina.catalogue.inputs import (
    BED_NEW_SPELLING,
    EXTRACTED,
    INGESTED,
    SHIFT_YEARS,
    SPELLING_CHANGE,
    raw_beds,
    raw_care_units,
    raw_establishments,
    raw_occupancy,
    table,
)
from lamina.columns import columns
from lamina.operators import manifest
from lamina.operators.contracts import ContractViolation, TableSpec
from lamina.operators.digest import FAN, tree_hashes
from lamina.operators.latest import keep_last
from lamina.plans import bronze, dashboard, gold, schemas, silver
from lamina.plans.sources import (
    BEDS_CSV,
    CARE_UNITS_CSV,
    ESTABLISHMENTS_CSV,
    OCCUPANCY_CSV,
    VACCINATION_CODE,
    CsvDataset,
)
from lamina.plans.warehouse import Warehouse
from lamina.session import scratch_folder
from lamina.sinks import tables
from lamina.sinks.versioned import Table
from lamina.sources.raw import SEQUENCE_COLUMNS, read_csv, read_csv_detected, read_json_pages
from lamina.sources.staged import read_newest, read_yearly

QUERIES = {}
SQL = {}

PART_BYTES = 64 << 20


def _query(function):
    QUERIES[function.__name__] = function
    return function


def write_csv(df: DataFrame, path: str, separator: str, encoding: str) -> str:
    (
        df.write.option("header", True)
        .option("sep", separator)
        .option("encoding", encoding)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


@_query
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line breaks, quotes and separators through a CSV and back."""
    rows = table(spark, folder, "conversations")
    path = write_csv(rows, scratch_folder(spark, "csv"), ";", "UTF-8")
    back = read_csv(spark, path, separator=";", encoding="UTF-8")
    return back.drop(*SEQUENCE_COLUMNS)


SQL["csv_roundtrip"] = """
SELECT conv_id::VARCHAR AS conv_id, turn::VARCHAR AS turn, role, text FROM conversations"""


@_query
def csv_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """A file without line breaks in its cells, read in parallel blocks."""
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path = write_csv(rows, scratch_folder(spark, "csv"), ",", "ISO-8859-1")
    back = read_csv(spark, path, separator=",", encoding="ISO-8859-1", multi_line=False)
    return back.drop(*SEQUENCE_COLUMNS)


SQL["csv_blocks"] = """
SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_mktsegment FROM customer"""


@_query
def separators_in_one_folder(spark: SparkSession, folder: str) -> DataFrame:
    """One folder with files of both separators, each read with its own."""
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path = scratch_folder(spark, "mixed")
    for part, separator in enumerate((",", ";")):
        half = rows.where(F.col("c_custkey") % 2 == part)
        # The columns of the second half stand in another order.
        order = rows.columns if part == 0 else rows.columns[::-1]
        write_csv(half.select(*order), f"{path}/{part}", separator, "UTF-8")
    back = read_csv_detected(spark, f"{path}/*", encoding="UTF-8", multi_line=False)
    separator = F.when(F.col("c_custkey") % 2 == 0, F.lit(",")).otherwise(F.lit(";"))
    return back.drop(*SEQUENCE_COLUMNS).withColumn("separator", separator)


SQL["separators_in_one_folder"] = """
SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_mktsegment,
       CASE WHEN c_custkey % 2 = 0 THEN ',' ELSE ';' END AS separator
FROM customer"""


@_query
def json_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Records in files of at most 1000, read back as strings."""
    rows = table(spark, folder, "events")
    path = tables.land_json(
        rows.select("event_id", "user_id", "event_type", "props"), scratch_folder(spark, "json")
    )
    return read_json_pages(spark, path, whole_file=False).drop(*SEQUENCE_COLUMNS)


SQL["json_pages"] = """
SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, event_type, props FROM events"""


@_query
def staged_vaccination(spark: SparkSession, folder: str) -> DataFrame:
    """Landed records staged once; the same payload is recognised the second time."""
    code = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    records = table(spark, folder, "conversations").select(
        code.alias(VACCINATION_CODE), F.col("role").alias("sg_vacina"), "text"
    )
    root = scratch_folder(spark, "vaccination")
    landed = tables.land_json(records, f"{root}/raw")
    nothing = spark.createDataFrame([], manifest.MANIFEST_SCHEMA)
    arguments = (f"{root}/staged", "pni_2021_SE", EXTRACTED, INGESTED, False)
    record = bronze.ingest_vaccination(spark, landed, nothing, *arguments)
    again = bronze.ingest_vaccination(spark, landed, record, *arguments)
    staged = spark.read.parquet(record.first()["parquet_path"])
    return staged.select(
        VACCINATION_CODE,
        "sg_vacina",
        "text",
        "_source_file",
        F.lit(again is None).alias("second_is_unchanged"),
    )


SQL["staged_vaccination"] = """
SELECT conv_id || '-' || turn AS codigo_documento, role AS sg_vacina, text,
       'pni_2021_SE' AS _source_file, true AS second_is_unchanged
FROM conversations"""


def land_texts(texts: DataFrame, path: str) -> str:
    """A folder of part files for each source, in order of ids, of ``PART_BYTES`` or so."""
    total = texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    # Ranges of ids within a source, so that a large one is dealt over many tasks.
    order = [F.col("source"), F.col("doc_id").asc_nulls_last(), F.col("text")]
    ranged = texts.repartitionByRange(max(1, math.ceil(total / PART_BYTES)), *order)
    ranged.sortWithinPartitions(*order).select("source", "text").write.partitionBy("source").text(path)
    return path


@_query
def hashed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes, lines and hash tree of the texts of each source, landed in parts, as one file."""
    texts = table(spark, folder, "documents").where("text IS NOT NULL")
    path = land_texts(texts, scratch_folder(spark, "text"))
    source = F.regexp_extract("path", "source=([^/]+)$", 1)
    return tree_hashes(spark, path, by_folder=True).select(source.alias("source"), "length", "lines", "source_hash")


# Written for up to FAN * FAN lines a source.
SQL["hashed_files"] = f"""
WITH leaves AS (
  SELECT source, doc_id, unnest(range(len(parts))) AS i, unnest(parts) AS line
  FROM (SELECT source, doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)),
numbered AS (
  SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id, i) - 1 AS n, sha256(line) AS hash FROM leaves),
first_level AS (
  SELECT source, n // {FAN} AS n, count(*) AS lines,
         CASE WHEN count(*) = 1 AND min(n) = 0 THEN min(hash) ELSE sha256(string_agg(hash, '' ORDER BY n)) END AS hash
  FROM numbered GROUP BY 1, numbered.n // {FAN}),
roots AS (
  SELECT source, sum(lines)::BIGINT AS lines,
         CASE WHEN count(*) > 1 THEN sha256(string_agg(hash, '' ORDER BY n)) ELSE min(hash) END AS hash
  FROM first_level GROUP BY source),
sizes AS (
  SELECT source, sum(strlen(text) + 1)::BIGINT AS length FROM documents WHERE text IS NOT NULL GROUP BY source)
SELECT source, length, lines, sha256(length || ':' || lines || ':' || hash) AS source_hash
FROM roots JOIN sizes USING (source)"""


@_query
def replace_partition(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table after replacing one partition, twice, and emptying another."""
    path = scratch_folder(spark, "partitions")
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_totalprice",
        "o_orderstatus",
        F.to_date(F.date_trunc("year", "o_orderdate")).alias("_extraction_date"),
    )
    tables.append_partition(orders, path)
    for year in (1997, 1997):
        changed = orders.where(
            (F.col("_extraction_date") == date(year, 1, 1)) & (F.col("o_orderstatus") == "F")
        ).withColumn("o_totalprice", -F.col("o_totalprice"))
        tables.replace_partition(
            changed,
            path,
            partition_column="_extraction_date",
            partition_value=date(year, 1, 1),
        )
    tables.replace_partition(
        orders.where(F.lit(False)),
        path,
        partition_column="_extraction_date",
        partition_value=date(1998, 1, 1),
    )
    return star.comparable(spark.read.parquet(path))


SQL["replace_partition"] = """
SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN -o_totalprice ELSE o_totalprice END
         AS o_totalprice, o_orderstatus, year(o_orderdate) || '-01-01' AS _extraction_date
FROM orders
WHERE year(o_orderdate) <> 1998 AND (year(o_orderdate) <> 1997 OR o_orderstatus = 'F')"""


def _orders_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        "o_totalprice",
        "o_orderstatus",
        F.to_date(F.date_trunc("year", "o_orderdate")).alias("_extraction_date"),
    )


@_query
def versioned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """A table with a commit log after replacing a partition twice, emptying one, and a lost race."""
    stored = Table(spark, scratch_folder(spark, "versioned"))
    orders = _orders_by_year(spark, folder)
    for (day,) in orders.select("_extraction_date").distinct().collect():
        stored.replace_partition(orders.where(F.col("_extraction_date") == F.lit(day)), "_extraction_date", day)
    changed = orders.where(
        (F.col("_extraction_date") == date(1997, 1, 1)) & (F.col("o_orderstatus") == "F")
    ).withColumn("o_totalprice", -F.col("o_totalprice"))
    for _ in range(2):
        stored.replace_partition(changed, "_extraction_date", date(1997, 1, 1))
    stored.replace_partition(orders.where(F.lit(False)), "_extraction_date", date(1998, 1, 1))
    return star.comparable(stored.read())


SQL["versioned_partitions"] = """
SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN -o_totalprice ELSE o_totalprice END
         AS o_totalprice, o_orderstatus, year(o_orderdate) || '-01-01' AS _extraction_date
FROM orders
WHERE year(o_orderdate) <> 1998 AND (year(o_orderdate) <> 1997 OR o_orderstatus = 'F')"""


@_query
def added_columns_stored(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table after columns were added: what was stored before reads with their defaults."""
    stored = Table(spark, scratch_folder(spark, "evolved"))
    orders = _orders_by_year(spark, folder)
    old, new = date(1995, 1, 1), date(1996, 1, 1)
    of_year = F.col("_extraction_date")
    stored.replace_partition(orders.where(of_year == F.lit(old)), "_extraction_date", old)
    stored.add_column("priority", T.StringType(), "none")
    stored.add_column("weight", T.DoubleType())
    later = orders.where(of_year == F.lit(new)).withColumn("priority", F.lit("high"))
    stored.replace_partition(later.withColumn("weight", F.lit(0.5)), "_extraction_date", new)
    return star.comparable(stored.read())


SQL["added_columns_stored"] = """
SELECT o_orderkey, o_totalprice, o_orderstatus, year(o_orderdate) || '-01-01' AS _extraction_date,
       CASE year(o_orderdate) WHEN 1995 THEN 'none' ELSE 'high' END AS priority,
       CASE year(o_orderdate) WHEN 1996 THEN 0.5::DOUBLE END AS weight
FROM orders WHERE year(o_orderdate) IN (1995, 1996)"""


@_query
def newest_partition(spark: SparkSession, folder: str) -> DataFrame:
    """The newest partition of a stored table, found in its folder names."""
    path = scratch_folder(spark, "newest")
    orders = table(spark, folder, "orders").withColumn(
        "_extraction_date", F.to_date(F.date_trunc("month", "o_orderdate"))
    )
    tables.append_partition(orders.select("o_orderkey", "o_custkey", "_extraction_date"), path)
    return star.comparable(read_newest(spark, path))


SQL["newest_partition"] = """
SELECT o_orderkey, o_custkey,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS _extraction_date
FROM orders
WHERE date_trunc('month', o_orderdate) = (SELECT date_trunc('month', max(o_orderdate)) FROM orders)
"""


@_query
def full_rebuild(spark: SparkSession, folder: str) -> DataFrame:
    """Two builds of a fact; the second one is what a reader gets."""
    path = scratch_folder(spark, "rebuild")
    fact = gold.fact_beds(
        silver.beds(raw_beds(spark, folder), EXTRACTED, cleansed_at=INGESTED).df,
        snapshot=EXTRACTED,
    )
    first = fact.withColumn("uti_total_max", F.col("uti_total_max") + 1)
    tables.rebuild(first, path, schemas.FACT_BEDS)
    tables.rebuild(fact, path, schemas.FACT_BEDS)
    return star.comparable(tables.read_rebuilt(spark, path))


SQL["full_rebuild"] = star.SQL["yearly_fact"]


def _land(
    spark: SparkSession,
    root: str,
    dataset: CsvDataset,
    frames: dict[int | None, DataFrame],
    separators: tuple[str, ...],
) -> list[tuple]:
    """Write raw frames as the dataset's CSV files; their rows of the listing."""
    hidden = {*schemas.STAGED_LINEAGE, *SEQUENCE_COLUMNS}
    listed = []
    for (year, rows), separator in zip(frames.items(), separators):
        order = [c for c in SEQUENCE_COLUMNS if c in rows.columns]
        cells = rows.orderBy(*order) if year is not None else rows
        name = f"{root}/raw/{dataset.name}_{year}.csv"
        write_csv(cells.drop(*hidden), name, separator, dataset.encoding)
        listed.append((dataset.name, year, "remote", f"v{year}", None, None, "h", name, True))
    return listed


def _ingested(spark: SparkSession, root: str, listed: list[tuple]) -> Warehouse:
    """A warehouse whose Silver tables hold the landed files."""
    warehouse = Warehouse(spark, f"{root}/warehouse")
    listing = spark.createDataFrame(listed, manifest.LISTING_SCHEMA)
    for name in warehouse.ingest(listing, EXTRACTED, INGESTED):
        warehouse.refresh_silver(name)
    return warehouse


@_query
def landed_beds(spark: SparkSession, folder: str) -> DataFrame:
    """The bed series through files: CSV, staging, Silver partition, Gold version.

    The two years differ in header spelling and in separator.
    """
    root = scratch_folder(spark, "beds")
    warehouse = _ingested(
        spark, root, _land(spark, root, BEDS_CSV, raw_beds(spark, folder), (",", ";"))
    )
    warehouse.refresh_gold([schemas.FACT_BEDS.name])
    return star.comparable(warehouse.gold(schemas.FACT_BEDS))


SQL["landed_beds"] = star.SQL["yearly_fact"]


@_query
def changed_years(spark: SparkSession, folder: str) -> DataFrame:
    """The bed fact after a refresh that brought one changed file, and one that brought nothing.

    Only the years of the changed file are replaced; the others keep the date
    of the extraction that brought their rows.
    """
    root = scratch_folder(spark, "changed")
    frames = raw_beds(spark, folder)
    newer = max(frames)
    stale = frames | {newer: frames[newer].withColumn("_sus", F.lit("999"))}
    stale[newer] = stale[newer].withColumn(BED_NEW_SPELLING["LEITOS SUS"], F.col("_sus")).drop("_sus")
    first = _land(spark, f"{root}/first", BEDS_CSV, stale, (",", ";"))
    second = _land(spark, f"{root}/second", BEDS_CSV, {newer: frames[newer]}, (";",))
    warehouse = Warehouse(spark, f"{root}/warehouse")
    warehouse.refresh(spark.createDataFrame(first, manifest.LISTING_SCHEMA), EXTRACTED, INGESTED)
    changed = [(*row[:3], "changed", *row[4:6], "changed", *row[7:]) for row in second]
    for days in (7, 14):
        listing = spark.createDataFrame(changed, manifest.LISTING_SCHEMA)
        warehouse.refresh(listing, EXTRACTED + timedelta(days), INGESTED + timedelta(days))
    return star.comparable(warehouse.gold(schemas.FACT_BEDS))


SQL["changed_years"] = f"""
SELECT * REPLACE (CASE WHEN ano_referencia >= year(DATE '{SPELLING_CHANGE}') + {SHIFT_YEARS}
                  THEN '{EXTRACTED + timedelta(7)}' ELSE _extraction_date END AS _extraction_date)
FROM ({star.SQL["yearly_fact"]})"""


@_query
def compacted_log(spark: SparkSession, folder: str) -> DataFrame:
    """Newest order of every customer from rows appended year by year, compacted on the way."""
    stored = Table(spark, scratch_folder(spark, "appended"))
    orders = _orders_by_year(spark, folder).join(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey"
    )
    years = sorted(r[0] for r in orders.select("_extraction_date").distinct().collect())
    for n, day in enumerate(years):
        stored.append(orders.where(F.col("_extraction_date") == F.lit(day)))
        if n == len(years) // 2:
            stored.compact()
    newest = keep_last(stored.read(), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return star.comparable(newest.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus"))


SQL["compacted_log"] = """
SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""


@_query
def landed_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """All four CSV datasets through files, up to the overload ranking."""
    root = scratch_folder(spark, "warehouse")
    establishments = {None: raw_establishments(spark, folder)}
    units = {None: raw_care_units(spark, folder)}
    warehouse = _ingested(
        spark,
        root,
        _land(spark, root, ESTABLISHMENTS_CSV, establishments, (";",))
        + _land(spark, root, CARE_UNITS_CSV, units, (";",))
        + _land(spark, root, BEDS_CSV, raw_beds(spark, folder), (",", ";"))
        + _land(spark, root, OCCUPANCY_CSV, raw_occupancy(spark, folder), (",", ",")),
    )
    warehouse.refresh_gold()
    dim = warehouse.gold(schemas.DIM_ESTABLISHMENT)
    return star.comparable(dashboard.overload_ranking(dim, warehouse.gold(schemas.FACT_PRESSURE)))


SQL["landed_ranking"] = star.SQL["overload_ranking"]


_ORDERS = TableSpec(
    "orders",
    columns("o_orderkey bigint not null, o_orderstatus string not null, o_totalprice double, day date not null"),
    key=("o_orderkey",),
    ranges={"o_totalprice": (0, None)},
    partition="day",
)


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double"), F.lit(EXTRACTED).alias("day")
    )


@_query
def rejected_load(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table after a load that breaks its contract: the rows of the load before."""
    path = scratch_folder(spark, "rejected")
    orders = _orders(spark, folder)
    tables.load_silver(orders, path, _ORDERS, EXTRACTED)
    broken = orders.withColumn("o_totalprice", -F.col("o_totalprice"))
    twice = orders.union(orders)
    for load in (broken, twice, orders.drop("o_orderstatus")):
        try:
            tables.load_silver(load, path, _ORDERS, EXTRACTED)
        except Exception as rejected:
            if "contract" not in str(rejected) and not isinstance(rejected, ContractViolation):
                raise
        else:
            raise AssertionError("a load that breaks the contract was accepted")
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")


SQL["rejected_load"] = """
SELECT o_orderkey, o_orderstatus, o_totalprice::DOUBLE AS o_totalprice FROM orders"""


@_query
def audited_load(spark: SparkSession, folder: str) -> DataFrame:
    """Every count of a load that breaks several rules at once, of which nothing is loaded."""
    path = scratch_folder(spark, "audited")
    orders = _orders(spark, folder)
    negative = F.when(F.col("o_orderkey") % 3 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    unknown = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    twice = orders.union(orders.where("o_orderstatus = 'F'"))
    load = twice.withColumn("o_totalprice", negative).withColumn("o_orderstatus", unknown)
    rows = []
    try:
        tables.load_silver(load, path, _ORDERS, EXTRACTED)
    except ContractViolation as rejected:
        rows = [(*check, n) for check, n in rejected.counts.items()]
    return spark.createDataFrame(rows, "rule string, column string, rows bigint")


SQL["audited_load"] = """
WITH loaded AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
  UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F')
SELECT * FROM (
  SELECT 'not_null' AS rule, 'o_orderstatus' AS column, count(*) AS rows FROM loaded WHERE o_orderstatus = 'P'
  UNION ALL SELECT 'range', 'o_totalprice', count(*) FROM loaded WHERE o_orderkey % 3 = 0 AND o_totalprice > 0
  UNION ALL SELECT 'duplicate', 'o_orderkey', count(*) FROM orders WHERE o_orderstatus = 'F')
WHERE rows > 0"""


@_query
def skipped_years(spark: SparkSession, folder: str) -> DataFrame:
    """Staged years; one from a broken source, without the column that all need, is left out."""
    path = scratch_folder(spark, "years")
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").alias("COMP"))
    whole = orders.withColumn("year", F.year("COMP"))
    for year in range(1992, 1999):
        one = whole.where(F.col("year") == year).drop("year")
        tables.stage(one if year != 1995 else one.drop("COMP"), f"{path}/pedidos_{year}.parquet")
    found = read_yearly(spark, path, "pedidos", "COMP")
    rows = [f.agg(F.lit(y).alias("year"), F.count("*").alias("rows")) for y, f in found.frames.items()]
    left_out = spark.createDataFrame([(y,) for y in found.skipped_years], "year int")
    read = rows[0]
    for more in rows[1:]:
        read = read.union(more)
    return read.where("rows > 0").union(left_out.selectExpr("year", "CAST(NULL AS BIGINT)"))


SQL["skipped_years"] = """
SELECT year(o_orderdate)::INTEGER AS year, count(*) AS rows FROM orders
WHERE year(o_orderdate) BETWEEN 1992 AND 1998 AND year(o_orderdate) <> 1995 GROUP BY 1
UNION ALL SELECT 1995, NULL"""


@_query
def load_stamp(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a fact by whether their load stamp is set and not older than this load."""
    began = datetime.now(tz=timezone.utc)
    fact = gold.fact_beds(
        silver.beds(raw_beds(spark, folder), EXTRACTED, cleansed_at=INGESTED).df, snapshot=EXTRACTED
    )
    recent = F.col("_loaded_at").isNotNull() & (F.col("_loaded_at") >= F.lit(began))
    return fact.groupBy("ano_referencia").agg(F.count("*").alias("rows"), F.count_if(recent).alias("stamped"))


SQL["load_stamp"] = f"""
SELECT ano_referencia, count(*) AS rows, count(*) AS stamped
FROM ({star.SQL['yearly_fact']}) GROUP BY ano_referencia"""
