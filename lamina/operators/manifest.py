"""Change detection: an append-only manifest and the ingest decision.

Listing rows: ``dataset, year, origin ('remote'|'fallback'), etag,
last_modified, content_length, source_hash, path, reachable``; at most one row
per ``(dataset, year, origin)``. A single-file dataset has a NULL year.

Manifest rows: ``dataset, year, extraction_date, ingested_at, etag,
last_modified, remote_content_length, source_hash, source, raw_path,
parquet_path``. A new extraction appends rows; nothing is updated in place, so
the earlier rows are the history.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.columns import columns
from lamina.operators.latest import keep_last

NEW = "new"
UNCHANGED = "unchanged"
METADATA_ONLY = "metadata_only"
FAILED = "failed"

MANIFEST_SCHEMA = columns(
    "dataset string, year int, extraction_date date, ingested_at timestamp, etag string, "
    "last_modified string, remote_content_length bigint, source_hash string, source string, "
    "raw_path string, parquet_path string"
)
LISTING_SCHEMA = columns(
    "dataset string, year int, origin string, etag string, last_modified string, "
    "content_length bigint, source_hash string, path string, reachable boolean"
)


class NothingExtracted(RuntimeError):
    """The manifest holds no extraction of the dataset."""


def current(manifest: DataFrame) -> DataFrame:
    """The newest record of every ``(dataset, year)``."""
    return keep_last(manifest, ["dataset", "year"], ["extraction_date", "ingested_at"])


def same_text(a: Column, b: Column) -> Column:
    """Equal and both non-empty; never NULL."""
    return F.coalesce((a == b) & (a != ""), F.lit(False))


def same_version(etag: Column, last_modified: Column, old_etag: Column, old_modified: Column) -> Column:
    """Either mark is enough: equal entity tags or equal modification times."""
    return same_text(etag, old_etag) | same_text(last_modified, old_modified)


def classify(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Ingest decision for every listed or known ``(dataset, year)``.

    The remote copy decides where it is reachable, otherwise the fallback copy:

    * ``unchanged`` - the remote version marks match, the fallback hash
      matches, or a single-file source has the known hash;
    * ``metadata_only`` - new version marks on known content (yearly sources);
    * ``new`` - new content;
    * ``failed`` - neither copy is available.

    The other columns are the record to append to the manifest: for known
    content it keeps pointing to the files already landed.
    """
    copy = F.struct("etag", "last_modified", "content_length", "source_hash", "path")
    usable = F.coalesce(F.col("reachable"), F.lit(False))
    offered = listing.groupBy("dataset", "year").agg(
        F.max(F.when(usable & (F.col("origin") == "remote"), copy)).alias("remote"),
        F.max(F.when(usable & (F.col("origin") == "fallback"), copy)).alias("fallback"),
    )
    known = current(manifest).select(
        F.col("dataset").alias("old_dataset"),
        F.col("year").alias("old_year"),
        F.struct(
            "extraction_date", "etag", "last_modified", "source_hash", "raw_path", "parquet_path"
        ).alias("old"),
    )
    joined = offered.join(
        known,
        (F.col("dataset") == F.col("old_dataset")) & F.col("year").eqNullSafe(F.col("old_year")),
        "full_outer",
    ).select(
        F.coalesce("dataset", "old_dataset").alias("dataset"),
        F.coalesce("year", "old_year").alias("year"),
        "remote",
        "fallback",
        "old",
    )
    is_remote = F.col("remote").isNotNull()
    chosen = F.coalesce("remote", "fallback")
    marks_match = is_remote & same_version(
        F.col("remote.etag"),
        F.col("remote.last_modified"),
        F.col("old.etag"),
        F.col("old.last_modified"),
    )
    hash_match = same_text(F.col("chosen.source_hash"), F.col("old.source_hash"))
    return (
        joined.withColumn("chosen", chosen)
        .withColumn(
            "status",
            F.when(F.col("chosen").isNull(), FAILED)
            .when(marks_match, UNCHANGED)
            .when(hash_match & is_remote & F.col("year").isNotNull(), METADATA_ONLY)
            .when(hash_match, UNCHANGED)
            .otherwise(NEW),
        )
        .withColumn("is_new", F.col("status") == NEW)
        .select(
            "dataset",
            "year",
            "status",
            F.when(~F.col("status").isin(FAILED), F.when(is_remote, "remote").otherwise("fallback"))
            .alias("source"),
            F.when(is_remote, F.col("chosen.etag")).alias("etag"),
            F.when(is_remote, F.col("chosen.last_modified")).alias("last_modified"),
            F.when(is_remote, F.col("chosen.content_length")).alias("remote_content_length"),
            F.when(F.col("is_new"), F.col("chosen.source_hash"))
            .otherwise(F.col("old.source_hash"))
            .alias("source_hash"),
            F.when(F.col("is_new"), F.col("chosen.path"))
            .otherwise(F.col("old.raw_path"))
            .alias("raw_path"),
            F.when(~F.col("is_new"), F.col("old.parquet_path")).alias("parquet_path"),
            F.col("old.extraction_date").alias("previous_extraction_date"),
        )
    )


def to_ingest(classified: DataFrame) -> DataFrame:
    """Only what has new content; downstream work is skipped for the rest."""
    return classified.where(F.col("status") == NEW)


def next_records(
    classified: DataFrame, extraction_date: date, ingested_at: datetime
) -> DataFrame:
    """Rows to append to the manifest: new content and renewed version marks.

    A record of renewed marks keeps the extraction date of its content, so a
    reader is never sent to a partition that was not written.
    """
    moved = classified.where(F.col("status").isin(NEW, METADATA_ONLY))
    landed = F.when(F.col("status") == NEW, F.lit(extraction_date)).otherwise(
        F.col("previous_extraction_date")
    )
    return moved.select(
        "dataset",
        "year",
        landed.alias("extraction_date"),
        F.lit(ingested_at).alias("ingested_at"),
        "etag",
        "last_modified",
        "remote_content_length",
        "source_hash",
        "source",
        "raw_path",
        "parquet_path",
    )


def latest_extraction(manifest: DataFrame) -> DataFrame:
    """Newest extraction per dataset with its Parquet location."""
    landed = F.col("parquet_path").isNotNull()
    order = F.struct("extraction_date", "ingested_at")
    return manifest.groupBy("dataset").agg(
        F.max("extraction_date").alias("extraction_date"),
        F.max_by("parquet_path", F.when(landed, order)).alias("parquet_path"),
    )


def latest_extraction_of(manifest: DataFrame, dataset: str) -> tuple[date, str | None]:
    """Date and Parquet location of the newest extraction of one dataset."""
    found = latest_extraction(manifest.where(F.col("dataset") == dataset)).first()
    if found is None:
        raise NothingExtracted(f"no extraction of {dataset!r}")
    return found["extraction_date"], found["parquet_path"]


def payload_status(identities: DataFrame, manifest: DataFrame) -> DataFrame:
    """Set payloads (``dataset, codes, identity``) against their last identity."""
    known = keep_last(manifest, ["dataset"], ["extraction_date", "ingested_at"]).select(
        "dataset", F.col("source_hash").alias("previous")
    )
    return identities.join(known, "dataset", "left").withColumn(
        "status",
        F.when(same_text(F.col("identity"), F.col("previous")), UNCHANGED).otherwise(NEW),
    )
