"""Staging: landed files to all-string Parquet with lineage columns.

A staging folder ``<root>/<extraction date>/<name>.parquet`` belongs to its day:
later extractions never touch it, and repeating an extraction on the same day
(after a lost job, say) replaces it. ``_source_file``, ``_block_start`` and ``_row_seq`` keep the
order of the rows in their source for the later keep-last.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators import digest, manifest
from lamina.operators.paging import (
    EMPTY_STREAK_TO_STOP,
    page_items,
    paged_rows,
    with_list_key,
)
from lamina.plans.sources import (
    VACCINATION,
    VACCINATION_CODE,
    VACCINATION_PAGE_SIZE,
    CsvDataset,
)
from lamina.sinks.tables import land_json_text, stage
from lamina.sources.folders import matching
from lamina.sources.raw import (
    read_csv,
    read_csv_detected,
    read_json_pages,
    read_page_payloads,
)


def staged_name(dataset: CsvDataset, year: int | None) -> str:
    if year is None or dataset.year_prefix is None:
        return f"{dataset.name}.parquet"
    return f"{dataset.year_prefix}_{year}.parquet"


def with_lineage(rows: DataFrame, ingested_at: datetime, source_hash: str) -> DataFrame:
    """``_ingested_at`` and ``_source_hash``; ``_source_file`` comes from the reader."""
    return rows.withColumns(
        {"_ingested_at": F.lit(ingested_at), "_source_hash": F.lit(source_hash)}
    )


def read_dataset(spark: SparkSession, dataset: CsvDataset, path: str, **options) -> DataFrame:
    """The raw rows of one landed file (or folder of part files)."""
    if dataset.separator is None:
        return read_csv_detected(spark, path, encoding=dataset.encoding, **options)
    return read_csv(
        spark, path, separator=dataset.separator, encoding=dataset.encoding, **options
    )


def stage_csv(
    spark: SparkSession,
    dataset: CsvDataset,
    records: DataFrame,
    staging_root: str,
    **options,
) -> list[tuple[int | None, str]]:
    """Stage every manifest record with new content; returns ``(year, path)``.

    ``records`` are rows of :func:`lamina.operators.manifest.next_records` for
    this dataset: one per year, so the loop below is over files, not over data.
    Records that only renew version marks have been staged before and are
    skipped.
    """
    written = []
    for record in records.where(F.col("parquet_path").isNull()).orderBy("year").collect():
        rows = read_dataset(spark, dataset, record["raw_path"], **options)
        target = "/".join(
            [
                staging_root.rstrip("/"),
                record["extraction_date"].isoformat(),
                staged_name(dataset, record["year"]),
            ]
        )
        lineage = with_lineage(rows, record["ingested_at"], record["source_hash"])
        stage(lineage, target, replace=True)
        written.append((record["year"], target))
    return written


def with_staged_paths(records: DataFrame, written: list[tuple[int | None, str]]) -> DataFrame:
    """Note the staged Parquet path in the manifest records."""
    path = F.col("parquet_path")
    for year, target in written:
        path = F.when(F.col("year").eqNullSafe(F.lit(year).cast("int")), target).otherwise(path)
    return records.withColumn("parquet_path", path)


def ingest_csv(
    spark: SparkSession,
    dataset: CsvDataset,
    listing: DataFrame,
    known: DataFrame,
    staging_root: str,
    extraction_date: date,
    ingested_at: datetime,
    **options,
) -> DataFrame:
    """Detect, stage and return the records to append to the manifest.

    The result is empty, and nothing is read, when nothing changed.
    """
    decided = manifest.classify(
        listing.where(F.col("dataset") == dataset.name),
        known.where(F.col("dataset") == dataset.name),
    )
    records = manifest.next_records(decided, extraction_date, ingested_at)
    return with_staged_paths(records, stage_csv(spark, dataset, records, staging_root, **options))


def vaccination_pages(spark: SparkSession, folder: str, whole_file: bool = True) -> DataFrame:
    """The records of all landed pages, every column a string."""
    pattern = "page_*.json" if whole_file else "part-*"
    if not matching(spark, f"{folder.rstrip('/')}/{pattern}"):
        raise FileNotFoundError(f"no pages in {folder}")
    return read_json_pages(spark, f"{folder.rstrip('/')}/{pattern}", whole_file=whole_file)


def vaccination_status(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Identity of the document codes and whether it differs from the last one."""
    found = digest.payload_identity(rows, VACCINATION_CODE)
    found = found.withColumn("dataset", F.lit(VACCINATION))
    return manifest.payload_status(found, known.where(F.col("dataset") == VACCINATION))


def land_api_pages(
    spark: SparkSession,
    pages: str,
    folder: str,
    *,
    data_key: str | None = None,
    empty_streak: int = EMPTY_STREAK_TO_STOP,
    max_pages: int | None = None,
) -> str:
    """Records of saved API answers as JSON lines, at most a page size per file.

    Reading ends at the first run of empty pages, as a reader of the API would.
    ``data_key`` names the list of records; by default it is found. A page that
    is no JSON object, and pages of which none has a list, fail the job.
    """
    answers = read_page_payloads(spark, pages)
    keyed = with_list_key(answers) if data_key is None else answers.withColumn(
        "data_key", F.lit(data_key)
    )
    records = page_items(F.col("payload"), F.col("data_key"), F.col("page"))
    items = keyed.withColumn("items", records)
    rows = paged_rows(items, empty_streak=empty_streak, max_pages=max_pages)
    return land_json_text(rows, "item", folder, VACCINATION_PAGE_SIZE)


def ingest_vaccination(
    spark: SparkSession,
    folder: str,
    known: DataFrame,
    staging_root: str,
    source_name: str,
    extraction_date: date,
    ingested_at: datetime,
    whole_file: bool = True,
) -> DataFrame | None:
    """Stage the pages as one all-string Parquet unless the payload is known.

    Returns the manifest record to append, ``None`` when nothing changed.
    """
    rows = vaccination_pages(spark, folder, whole_file)
    status = vaccination_status(rows, known).first()
    if status["status"] == manifest.UNCHANGED:
        return None
    target = "/".join(
        [staging_root.rstrip("/"), extraction_date.isoformat(), f"{source_name}.parquet"]
    )
    lineage = with_lineage(rows, ingested_at, status["identity"])
    stage(lineage.withColumn("_source_file", F.lit(source_name)), target, replace=True)
    return spark.createDataFrame(
        [
            (
                VACCINATION,
                None,
                extraction_date,
                ingested_at,
                None,
                None,
                None,
                status["identity"],
                "remote",
                folder,
                target,
            )
        ],
        manifest.MANIFEST_SCHEMA,
    )
