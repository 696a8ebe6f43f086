"""Change detection, digests and paging over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.catalogue.inputs import table
from lamina.operators import manifest
from lamina.operators.digest import FAN, payload_identity, set_digest, sorted_digest
from lamina.operators.latest import keep_last
from lamina.operators.paging import page_items, paged_rows, with_list_key
from lamina.operators.shaping import align

QUERIES = {}
SQL = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def _digest_sql(code: str, by: str, source: str) -> str:
    words = ", ".join(
        f"sum(('0x' || substr(sha256({code}), {16 * w + 1}, 16))::UBIGINT::HUGEINT) AS w{w}"
        for w in range(4)
    )
    return f"""SELECT {by}, codes, sha256(concat_ws('|', codes, w0, w1, w2, w3)) AS digest
FROM (SELECT {by}, count(*) AS codes, {words} FROM {source} GROUP BY {by})"""


@_query
def payload_digest(spark: SparkSession, folder: str) -> DataFrame:
    """Order-independent digest of the texts of every language."""
    return set_digest(table(spark, folder, "documents"), "text", ["lang"])


SQL["payload_digest"] = _digest_sql("text", "lang", "(SELECT * FROM documents WHERE text <> '')")


@_query
def payload_hash(spark: SparkSession, folder: str) -> DataFrame:
    """Identity of the document codes of every language."""
    codes = table(spark, folder, "documents").selectExpr("lang", "string(doc_id) AS code")
    return payload_identity(codes, "code", ["lang"])


_CODES = "(SELECT lang, doc_id::VARCHAR AS code FROM documents)"
SQL["payload_hash"] = f"""
SELECT lang, codes, digest AS identity FROM ({_digest_sql("code", "lang", _CODES)})"""


@_query
def payload_sorted(spark: SparkSession, folder: str) -> DataFrame:
    """Ordered digest of the users of every kind of event, who come up many times each."""
    codes = table(spark, folder, "events").selectExpr("event_type", "string(user_id) AS code")
    return sorted_digest(codes, "code", ["event_type"])


# Written for up to FAN * FAN values a group.
SQL["payload_sorted"] = f"""
WITH counted AS (
  SELECT event_type, user_id::VARCHAR AS code, count(*) AS times FROM events WHERE user_id IS NOT NULL GROUP BY 1, 2),
leaves AS (
  SELECT event_type, times, row_number() OVER (PARTITION BY event_type ORDER BY code COLLATE "binary") - 1 AS n,
         sha256(times || ':' || code) AS hash FROM counted),
first_level AS (
  SELECT event_type, sum(times) AS codes,
         CASE WHEN count(*) = 1 AND min(n) = 0 THEN min(hash) ELSE sha256(string_agg(hash, '' ORDER BY n)) END AS hash,
         n // {FAN} AS n
  FROM leaves GROUP BY event_type, leaves.n // {FAN})
SELECT event_type, sum(codes)::BIGINT AS codes,
       CASE WHEN count(*) > 1 THEN sha256(string_agg(hash, '' ORDER BY n)) ELSE min(hash) END AS digest
FROM first_level GROUP BY event_type"""


@_query
def payload_unchanged(spark: SparkSession, folder: str) -> DataFrame:
    """Sources whose documents are still those of the previous extraction."""
    documents = table(spark, folder, "documents").select(
        F.col("source").alias("dataset"), "lang", F.col("doc_id").cast("string").alias("code")
    )
    before = documents.where(~((F.col("dataset") == "src3") & (F.col("lang") == "de")))
    known = align(
        payload_identity(before, "code", ["dataset"])
        .withColumn("source_hash", F.col("identity"))
        .withColumn("extraction_date", F.lit("2026-06-03")),
        manifest.MANIFEST_SCHEMA,
    )
    now = payload_identity(documents, "code", ["dataset"])
    return manifest.payload_status(now, known).select("dataset", "codes", "status")


SQL["payload_unchanged"] = """
SELECT source AS dataset, count(*) AS codes,
       CASE WHEN source = 'src3' AND count(*) FILTER (WHERE lang = 'de') > 0
            THEN 'new' ELSE 'unchanged' END AS status
FROM documents GROUP BY source"""


def _listing_and_manifest(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Every page as a remote file, most also as a fallback copy, most known before.

    A url is one file, so of the pages that repeat it the newest counts: each of
    the listing's and the manifest's rows describes the same one.
    """
    newest = keep_last(table(spark, folder, "pages"), ["url"], ["page_id", "html"])
    pages = newest.select(
        F.col("url").alias("dataset"),
        F.when(F.col("url").startswith("https"), 2024).alias("year"),
        F.col("url").contains("?").alias("has_query"),
        F.col("url").contains("#").alias("has_fragment"),
        F.col("url").contains("/en/").alias("english"),
        (F.length("html") > 4000).alias("long"),
        F.sha2("html", 256).alias("hash"),
        F.col("url"),
    )
    other = F.sha2(F.concat("hash", F.lit("+")), 256)
    remote = pages.select(
        "dataset",
        "year",
        F.lit("remote").alias("origin"),
        F.md5(F.concat("url", F.when(F.col("long"), "2").otherwise("1"))).alias("etag"),
        F.lit("").alias("last_modified"),
        F.when(F.col("has_fragment"), other).otherwise(F.col("hash")).alias("source_hash"),
        F.concat(F.lit("remote/"), "url").alias("path"),
        (~F.col("has_query")).alias("reachable"),
    )
    fallback = pages.where(~(F.col("has_query") & F.col("has_fragment"))).select(
        "dataset",
        "year",
        F.lit("fallback").alias("origin"),
        F.when(F.col("long"), F.col("hash")).otherwise(other).alias("source_hash"),
        F.concat(F.lit("local/"), "url").alias("path"),
        F.lit(True).alias("reachable"),
    )
    listing = align(remote, manifest.LISTING_SCHEMA).unionByName(
        align(fallback, manifest.LISTING_SCHEMA)
    )
    known = align(
        pages.where(~F.col("english")).select(
            "dataset",
            "year",
            F.lit("2026-06-03").alias("extraction_date"),
            F.md5(F.concat("url", F.lit("1"))).alias("etag"),
            F.lit("").alias("last_modified"),
            F.col("hash").alias("source_hash"),
            F.concat(F.lit("raw/"), "url").alias("raw_path"),
            F.concat(F.lit("staged/"), "url").alias("parquet_path"),
        ),
        manifest.MANIFEST_SCHEMA,
    )
    return listing, known


@_query
def version_classify(spark: SparkSession, folder: str) -> DataFrame:
    decided = manifest.classify(*_listing_and_manifest(spark, folder))
    return decided.select(
        "dataset",
        "year",
        "status",
        "source",
        "etag",
        "source_hash",
        "raw_path",
        "parquet_path",
        F.date_format("previous_extraction_date", "yyyy-MM-dd").alias("previous_extraction_date"),
    )


_CLASSIFY_SQL = """
pages_known AS (
  SELECT url, CASE WHEN url LIKE 'https%' THEN 2024 END::INTEGER AS year,
         contains(url, '?') AS has_query, contains(url, '#') AS has_fragment,
         NOT contains(url, '/en/') AS known, length(html) > 4000 AS is_long,
         sha256(html) AS hash, sha256(sha256(html) || '+') AS other
  FROM pages),
decided AS (
  SELECT *, CASE
      WHEN has_query AND has_fragment THEN 'failed'
      WHEN has_query THEN CASE WHEN known AND is_long THEN 'unchanged' ELSE 'new' END
      WHEN known AND NOT is_long THEN 'unchanged'
      WHEN known AND NOT has_fragment AND year IS NOT NULL THEN 'metadata_only'
      WHEN known AND NOT has_fragment THEN 'unchanged'
      ELSE 'new' END AS status
  FROM pages_known)"""

SQL["version_classify"] = f"""
WITH {_CLASSIFY_SQL}
SELECT url AS dataset, year, status,
       CASE WHEN status = 'failed' THEN NULL WHEN has_query THEN 'fallback' ELSE 'remote' END
         AS source,
       CASE WHEN NOT has_query THEN md5(url || CASE WHEN is_long THEN '2' ELSE '1' END) END AS etag,
       CASE WHEN status <> 'new' THEN CASE WHEN known THEN hash END
            WHEN has_query THEN CASE WHEN is_long THEN hash ELSE other END
            WHEN has_fragment THEN other ELSE hash END AS source_hash,
       CASE WHEN status <> 'new' THEN CASE WHEN known THEN 'raw/' || url END
            WHEN has_query THEN 'local/' || url ELSE 'remote/' || url END AS raw_path,
       CASE WHEN status <> 'new' AND known THEN 'staged/' || url END AS parquet_path,
       CASE WHEN known THEN '2026-06-03' END AS previous_extraction_date
FROM decided"""


@_query
def manifest_advance(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest after the ingest, newest record per file."""
    listing, known = _listing_and_manifest(spark, folder)
    from datetime import date, datetime, timezone

    records = manifest.next_records(
        manifest.classify(listing, known),
        date(2026, 6, 10),
        datetime(2026, 6, 10, 12, tzinfo=timezone.utc),
    )
    return manifest.current(known.unionByName(records)).select(
        "dataset",
        "year",
        F.date_format("extraction_date", "yyyy-MM-dd").alias("extraction_date"),
        "etag",
        "raw_path",
    )


SQL["manifest_advance"] = f"""
WITH {_CLASSIFY_SQL}
SELECT url AS dataset, year,
       CASE WHEN status = 'new' THEN '2026-06-10' ELSE '2026-06-03' END AS extraction_date,
       CASE WHEN status = 'new' AND has_query THEN NULL
            WHEN status IN ('new', 'metadata_only')
              THEN md5(url || CASE WHEN is_long THEN '2' ELSE '1' END)
            ELSE md5(url || '1') END AS etag,
       CASE WHEN status <> 'new' THEN 'raw/' || url
            WHEN has_query THEN 'local/' || url ELSE 'remote/' || url END AS raw_path
FROM decided WHERE known OR status = 'new'"""


def _order_manifest(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    landed = F.col("o_orderstatus") != "P"
    return align(
        orders.select(
            F.col("o_orderpriority").alias("dataset"),
            F.when(F.col("o_orderstatus") != "F", F.year("o_orderdate")).alias("year"),
            F.to_date("o_orderdate").alias("extraction_date"),
            F.timestamp_seconds(F.col("o_orderkey")).alias("ingested_at"),
            F.col("o_orderkey").cast("string").alias("source_hash"),
            F.when(landed, F.concat(F.lit("p"), F.col("o_orderkey").cast("string"))).alias(
                "parquet_path"
            ),
        ),
        manifest.MANIFEST_SCHEMA,
    )


@_query
def manifest_current(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.current(_order_manifest(spark, folder)).select("dataset", "year", "source_hash")


SQL["manifest_current"] = """
SELECT dataset, year, key::VARCHAR AS source_hash
FROM (SELECT o_orderpriority AS dataset, o_orderkey AS key,
             CASE WHEN o_orderstatus <> 'F' THEN year(o_orderdate) END::INTEGER AS year,
             row_number() OVER (
               PARTITION BY o_orderpriority,
                            CASE WHEN o_orderstatus <> 'F' THEN year(o_orderdate) END
               ORDER BY o_orderdate DESC, o_orderkey DESC) AS position
      FROM orders)
WHERE position = 1"""


@_query
def newest_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = manifest.latest_extraction(_order_manifest(spark, folder))
    return found.withColumn("extraction_date", F.date_format("extraction_date", "yyyy-MM-dd"))


SQL["newest_extraction"] = """
SELECT dataset, strftime(newest, '%Y-%m-%d') AS extraction_date, 'p' || key AS parquet_path
FROM (SELECT o_orderpriority AS dataset, o_orderkey AS key,
             max(o_orderdate) OVER (PARTITION BY o_orderpriority) AS newest,
             o_orderstatus <> 'P' AND row_number() OVER (
               PARTITION BY o_orderpriority, o_orderstatus <> 'P'
               ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AS chosen
      FROM orders)
WHERE chosen"""


@_query
def paged_api_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation as a paged source: a turn is a page, its long lines the records."""
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(line) > 150)
    body = F.to_json(
        F.struct(
            F.col("role").alias("origin"),
            lines.alias("records"),
            F.split("role", "s").alias("later_list"),
        )
    )
    pages = table(spark, folder, "conversations").select(
        "conv_id", F.col("turn").alias("page"), body.alias("payload")
    )
    keyed = with_list_key(pages, ["conv_id"])
    items = keyed.withColumn("items", page_items(F.col("payload"), F.col("data_key")))
    return paged_rows(items, by=["conv_id"])


SQL["paged_api_rows"] = """
WITH pages_split AS (
  SELECT conv_id, turn, list_filter(string_split(text, chr(10)), lambda x: length(x) > 150) AS items
  FROM conversations),
streaks AS (
  SELECT *, len(items) = 0
         AND lag(len(items), 1) OVER w = 0 AND lag(len(items), 2) OVER w = 0 AS ends_streak
  FROM pages_split WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
stops AS (SELECT conv_id, min(turn) AS stop FROM streaks WHERE ends_streak GROUP BY 1)
SELECT conv_id, turn AS page, (i - 1)::INTEGER AS position, items[i] AS item
FROM (SELECT p.*, unnest(range(1, len(items) + 1)) AS i
      FROM pages_split p LEFT JOIN stops USING (conv_id)
      WHERE stop IS NULL OR turn < stop)"""
