"""Renames, projections and unions over drifting column sets."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingColumns(ValueError):
    """A column the contract requires is not in the input."""


def ticked(name: str) -> str:
    """A column name as SQL text; a raw header may hold blanks or dots."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """Column reference for a raw header."""
    return F.col(ticked(name))


def derive(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Add or replace columns by SQL expressions, in one projection."""
    kept = [
        f"{expressions[c]} AS {ticked(c)}" if c in expressions else ticked(c) for c in df.columns
    ]
    added = [
        f"{text} AS {ticked(c)}" for c, text in expressions.items() if c not in df.columns
    ]
    return df.selectExpr(*kept, *added)


def require(df: DataFrame, names: Iterable[str]) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise MissingColumns(f"missing columns: {absent}")


def rename_strict(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by a full map; Spark alone would ignore an absent column."""
    require(df, names)
    return df.withColumnsRenamed(dict(names))


def rename_known(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the spellings that are present; several may share one target."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def keep_known(df: DataFrame, allowed: Collection[str]) -> DataFrame:
    """Allow-list projection in input order."""
    return df.selectExpr(*[ticked(c) for c in df.columns if c in allowed])


def text_columns(df: DataFrame, excluded: Collection[str] = ()) -> list[str]:
    """String columns that are neither lineage (leading ``_``) nor excluded."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
        and not f.name.startswith("_")
        and f.name not in excluded
    ]


def union_drifted(frames: Iterable[DataFrame]) -> DataFrame:
    """Union all by name; a column absent from one input is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def align(
    df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Additive schema evolution: project onto ``schema``, filling new columns.

    A column the input lacks takes its default (NULL without one); a present
    column keeps its values.
    """
    defaults = defaults or {}
    present = set(df.columns)
    return df.select(
        [
            (quoted(f.name) if f.name in present else F.lit(defaults.get(f.name)))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Canonical order and stored types; fails on a missing column.

    Narrowing casts are checked, so a quantity too large for the stored integer
    aborts the load instead of wrapping around. Not-null is left to the
    contract: a frame that breaks it must get there to be reported.
    """
    require(df, schema.names)
    return df.to(T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]))
