"""Picking the newest: keep-last deduplication and snapshot filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.operators.shaping import quoted

_RANK = "__rank"


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per key, the row that is last in ``order``; NULL keys are equal.

    ``row_number() = 1`` lets Spark place a partial group limit before the
    shuffle: each input partition sends at most one row per key, so a key that
    holds most of the rows costs no more than any other.
    """
    newest_first = Window.partitionBy([quoted(k) for k in keys]).orderBy(
        [quoted(o).desc_nulls_last() for o in order]
    )
    return df.withColumn(_RANK, F.row_number().over(newest_first)).where(
        F.col(_RANK) == 1
    ).drop(_RANK)


def latest_snapshot(
    df: DataFrame, column: str = "_extraction_date", value: object = None
) -> DataFrame:
    """Rows of the newest snapshot.

    Pass ``value`` where it is already known (partition listing, manifest):
    a literal prunes partitions while planning. Without it the maximum is an
    uncorrelated scalar subquery over that one column, which still prunes the
    partitions of a stored table at run time.
    """
    if value is not None:
        return df.where(quoted(column) == F.lit(value))
    newest = df.select(F.max(quoted(column))).scalar()
    return df.where(quoted(column) == newest)


def latest_snapshot_per(
    df: DataFrame, by: Sequence[str], column: str = "_extraction_date", *, few: bool = False
) -> DataFrame:
    """For every value of ``by`` (a year, say) the rows of its newest snapshot.

    ``few`` says that a contract bounds the number of ``by`` values, as it does
    for years. The newest dates are then broadcast and ``df`` is not shuffled;
    otherwise the join is left to adaptive execution.
    """
    newest = df.groupBy([quoted(k).alias(f"__{k}") for k in by]).agg(
        F.max(quoted(column)).alias("__newest")
    )
    match = [quoted(k).eqNullSafe(F.col(f"__{k}")) for k in by]
    match.append(quoted(column) == F.col("__newest"))
    return df.join(F.broadcast(newest) if few else newest, match, "left_semi")
