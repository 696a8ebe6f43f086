"""Readers of staged (all-string) and stored (typed) Parquet."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from lamina.operators.latest import latest_snapshot
from lamina.sources.folders import base_name, exists, matching
from lamina.sources.raw import year_in_name


@dataclass(frozen=True)
class YearlyFrames:
    """Staged frames by year, each with its own columns."""

    frames: dict[int, DataFrame]
    skipped_years: list[int] = field(default_factory=list)


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """One staged Parquet; a missing path is an error."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def read_yearly(
    spark: SparkSession,
    folder: str,
    prefix: str,
    required_column: str | None = None,
) -> YearlyFrames:
    """``<prefix>_<year>.parquet`` entries of a folder, one frame per year.

    Entries with another name are ignored, no match at all is an error. A year
    whose file lacks ``required_column`` was staged from a broken source: it is
    left out and reported, unless that leaves nothing.
    """
    entries = matching(spark, f"{folder.rstrip('/')}/{prefix}_*.parquet")
    if not entries:
        raise FileNotFoundError(f"no {prefix}_*.parquet in {folder}")
    frames: dict[int, DataFrame] = {}
    skipped: list[int] = []
    for entry in entries:
        year = year_in_name(base_name(entry), rf"^{prefix}_(\d{{4}})\.parquet$")
        if year is None:
            continue
        frame = spark.read.parquet(entry)
        if required_column is not None and required_column not in frame.columns:
            skipped.append(year)
        else:
            frames[year] = frame
    if not frames:
        raise RuntimeError(f"no usable year in {folder}")
    return YearlyFrames(frames, skipped)


def read_years_of_manifest(
    spark: SparkSession, current: DataFrame, required_column: str | None = None
) -> YearlyFrames:
    """The staged frame of every year in its newest extraction.

    ``current`` is the newest manifest record per year of one dataset (a row
    per year, so a few dozen). An incremental ingest stages only the years that
    changed; reading through the manifest keeps the others.
    """
    frames: dict[int, DataFrame] = {}
    skipped: list[int] = []
    for row in current.select("year", "parquet_path").orderBy("year").collect():
        frame = read_staged(spark, row["parquet_path"])
        if required_column is not None and required_column not in frame.columns:
            skipped.append(row["year"])
        else:
            frames[row["year"]] = frame
    if not frames:
        raise RuntimeError("no usable year in the manifest")
    return YearlyFrames(frames, skipped)


def newest_partition(spark: SparkSession, path: str, column: str = "_extraction_date") -> date:
    """Newest date partition of a stored table, from its folder names alone."""
    values = [
        base_name(p).split("=", 1)[1] for p in matching(spark, f"{path.rstrip('/')}/{column}=*")
    ]
    if not values:
        raise FileNotFoundError(f"no {column} partition in {path}")
    return max(date.fromisoformat(v) for v in values)


def read_newest(spark: SparkSession, path: str, column: str = "_extraction_date") -> DataFrame:
    """Newest snapshot of a stored table; other partitions are not listed or read."""
    newest = newest_partition(spark, path, column)
    return latest_snapshot(spark.read.parquet(path), column, newest)
