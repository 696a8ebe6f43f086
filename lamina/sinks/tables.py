"""Parquet tables on a shared folder."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lamina.operators.contracts import Audit, ContractViolation, TableSpec, require_unique
from lamina.operators.shaping import quoted
from lamina.sources import folders

PUBLISHED = "_PUBLISHED"


def stage(df: DataFrame, path: str, *, replace: bool = False) -> str:
    """Write one staging folder; an existing one is an error unless it is replaced.

    A replacement is written beside the old folder and takes its place when it
    is whole, so a failed job leaves what was there.
    """
    target = _beside(path) if replace else path
    df.write.mode("errorifexists").option("compression", "zstd").parquet(target)
    if replace:
        folders.exchange(df.sparkSession, target, path)
    return path


def _beside(path: str) -> str:
    """A fresh folder next to a table's, which readers of the parent don't see."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_next-{name}-{uuid.uuid4().hex}"


def append_partition(df: DataFrame, path: str, column: str = "_extraction_date") -> None:
    """Append rows below ``column=value`` folders."""
    df.write.mode("append").option("compression", "zstd").partitionBy(column).parquet(path)


def replace_partition(
    df: DataFrame,
    path: str,
    *,
    partition_column: str | None = None,
    partition_value: date | str | int | None = None,
    audit: Audit | None = None,
) -> int:
    """Replace one logical partition, or the whole table; returns the rows loaded.

    Running it again with the same input leaves the same state. The rows are
    counted while they are written, beside the old folder, which they replace
    once all are there: a failed job leaves the old rows, on any store and with
    any committer. A row of another partition fails it. Empty input empties the
    partition. An ``audit`` that fails leaves the old rows, too.
    """
    written = Observation()
    rows = (audit.tap(df) if audit else df).observe(written, F.count(F.lit(1)).alias("rows"))
    if partition_column is None:
        target = _beside(path)
        rows.write.option("compression", "zstd").parquet(target)
        _require(df.sparkSession, target, audit)
        folders.exchange(df.sparkSession, target, path)
        return written.get["rows"]
    held = quoted(partition_column)
    value = F.lit(partition_value).cast(df.schema[partition_column].dataType)
    wrong = F.concat(F.lit(f"row outside partition {partition_value}: "), held.cast("string"))
    stray = F.when(~held.eqNullSafe(value), F.raise_error(wrong).cast("boolean"))
    partition = folders.of_partition(df.sparkSession, path, partition_column, partition_value)
    target = _beside(partition)
    rows.where(F.coalesce(stray, F.lit(True))).drop(partition_column).write.option(
        "compression", "zstd"
    ).parquet(target)
    _require(df.sparkSession, target, audit)
    loaded = written.get["rows"]
    if loaded:
        folders.exchange(df.sparkSession, target, partition)
    else:
        folders.delete(df.sparkSession, target)
        folders.delete(df.sparkSession, partition)
    return loaded


def _require(spark: SparkSession, target: str, audit: Audit | None) -> None:
    """Pass the audit, or leave nothing of what was written."""
    if audit is None:
        return
    try:
        audit.require(spark.read.parquet(target))
    except ContractViolation:
        folders.delete(spark, target)
        raise


def load_silver(
    df: DataFrame,
    path: str,
    spec: TableSpec,
    partition_value: date,
    *,
    unique_by_construction: bool = False,
) -> int:
    """Check the contract and replace the extraction's partition.

    All checks are counted in the writing job, the key on the written files; the
    old rows stay unless every count is zero. A table that was deduplicated by
    its key can leave the key's check out.
    """
    audit = Audit(spec, unique_by_construction=unique_by_construction)
    return replace_partition(
        df, path, partition_column=spec.partition, partition_value=partition_value, audit=audit
    )


def _versions(spark: SparkSession, path: str, published: bool) -> list[str]:
    marker = f"/{PUBLISHED}" if published else ""
    found = folders.matching(spark, f"{path.rstrip('/')}/v*{marker}")
    return [f[: len(f) - len(marker)] for f in found]


def _claimed(spark: SparkSession, path: str) -> str:
    """A folder for a version that no other writer has."""
    last = _versions(spark, path, published=False)
    number = 1 + (int(folders.base_name(last[-1])[1:]) if last else 0)
    while not folders.publish_text(spark, "", f"{path.rstrip('/')}/_claims/v{number:010d}"):
        number += 1
    return f"{path.rstrip('/')}/v{number:010d}"


def rebuild(df: DataFrame, path: str, spec: TableSpec | None = None) -> int:
    """Full rebuild: write a new version beside the old ones, check it, publish it.

    Readers use the newest published version, so they see the old content until
    the marker of the new one exists, and a failed build changes nothing. A
    version's number is claimed before it is written, so builds that run at once
    write versions of their own.
    """
    spark = df.sparkSession
    target = _claimed(spark, path)
    written = Observation()
    rows = df.observe(written, F.count(F.lit(1)).alias("rows"))
    if spec is not None and spec.partition is not None:
        # Files of even size per partition value; a large value gets several.
        writer = rows.hint("rebalance", spec.partition).write.partitionBy(spec.partition)
    else:
        writer = rows.write
    writer.mode("errorifexists").option("compression", "zstd").parquet(target)
    if spec is not None:
        require_unique(_read(spark, target, spec), spec)
    folders.touch(spark, f"{target}/{PUBLISHED}")
    return written.get["rows"]


def _read(spark: SparkSession, path: str, spec: TableSpec | None) -> DataFrame:
    # With its schema given, an empty partitioned version can be read as well.
    if spec is None:
        return spark.read.parquet(path)
    return spark.read.schema(spec.schema).parquet(path).select(*spec.columns)


def read_rebuilt(spark: SparkSession, path: str, spec: TableSpec | None = None) -> DataFrame:
    """The newest published version, in the column order of ``spec``."""
    published = _versions(spark, path, published=True)
    if not published:
        raise FileNotFoundError(f"nothing published in {path}")
    return _read(spark, published[-1], spec)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the newest published versions; unpublished ones stay."""
    old = _versions(spark, path, published=True)[:-keep]
    for version in old:
        folders.delete(spark, version)
    return len(old)


def land_json(df: DataFrame, path: str, page_size: int = 1000) -> str:
    """Records as JSON lines, at most ``page_size`` per file."""
    df.write.mode("errorifexists").option("maxRecordsPerFile", page_size).json(path)
    return path


def land_json_text(df: DataFrame, column: str, path: str, page_size: int = 1000) -> str:
    """Records that are JSON text already, one per line."""
    lines = df.select(quoted(column))
    lines.write.mode("errorifexists").option("maxRecordsPerFile", page_size).text(path)
    return path


def count_rows(df: DataFrame, where: Column | str | None = None) -> int:
    """Row count, optionally of the rows a predicate selects."""
    return (df if where is None else df.where(where)).count()
