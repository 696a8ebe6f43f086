"""What the operators share: reading, Arrow batches, scratch tables, id order."""

from __future__ import annotations

import contextlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.session import scratch_folder
from lamina.sources import folders

# Whole texts travel in Arrow batches; few rows keep a batch of long ones small.
ROWS_PER_BATCH = 256
SIZE_RATIO = 1.26  # a little over 5/4, the largest ratio of the sizes of similar sets
OWN = f"int(least(floor(log(n) / log({SIZE_RATIO})), 62))"  # the size class of a set of ``n``, a bit of SIZES
SIZES = "bit_or(shiftleft(1L, own)) AS sizes"
# Of a value with these size classes and count: whether two classes of near sizes may have it, whether one has that of size ``own``.
IN_NEAR_SIZES = "df > bit_count(sizes) OR (sizes & shiftright(sizes, 1)) != 0"
NEAR_OWN = "df > bit_count(sizes) OR (sizes & (shiftleft(1L, own + 1) | shiftright(shiftleft(1L, own), 1))) != 0"
NO_ID = np.iinfo(np.int64).min  # stands for a null id where rows are put in order; sorts first


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for the jobs inside; the session's own number comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    previous = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, previous)


def whole_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as the empty one."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def as_row(docs: DataFrame) -> Column:
    """All columns as one, ``row``, so that no name a stage adds can clash with theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def from_row(columns: list[str], changed: dict[str, Column]) -> list[Column]:
    """The columns back from ``row``, some of them changed."""
    return [(changed[c] if c in changed else F.col("row")[c]).alias(c) for c in columns]


def written(df: DataFrame, purpose: str, rows_per_batch: int | None = None) -> DataFrame:
    """The same rows from a table in the shared folder, computed once.

    A lost executor loses none of it, and what reads it twice gets equal rows.
    The job that writes may have Arrow batches of its own size.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, purpose)
    with batches_of(spark, rows_per_batch) if rows_per_batch else contextlib.nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch(contextlib.AbstractContextManager):
    """Tables that are needed only until the block ends, like those of :func:`written`.

    What leaves the block must not read them any more: it is written itself.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def written(self, df: DataFrame, purpose: str, rows_per_batch: int | None = None) -> DataFrame:
        path = scratch_folder(self.spark, purpose)
        self.paths.append(path)
        with batches_of(self.spark, rows_per_batch) if rows_per_batch else contextlib.nullcontext():
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *error) -> None:
        for path in self.paths:
            folders.delete(self.spark, path)


def id_ranges(df: DataFrame, column: str, rows_per_range: int) -> tuple[DataFrame, dict[int, int]]:
    """``df`` with ``range``, numbers of ranges of about so many rows each, and their first ids.

    The driver gets one id a range, as Spark's own range partitioner does.
    """
    total = df.count()
    ranges = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(total / rows_per_range))
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    found = df.agg(F.percentile_approx(column, shares, 10 * ranges)).first()[0] or []
    cuts = np.unique(np.array(found, np.int64))

    @F.pandas_udf("int")
    def number(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids, "right"))

    dealt = df.withColumn("range", number(column))
    firsts = dealt.groupBy("range").agg(F.min(column).alias("first")).collect()
    return dealt, {r["range"]: r["first"] for r in sorted(firsts)}
