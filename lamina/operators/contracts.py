"""Data contracts: column set, types, not-null, ranges, patterns and keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.operators.shaping import quoted


class ContractViolation(ValueError):
    """The data breaks its contract; nothing may be loaded.

    ``counts`` holds the broken rows of each ``(rule, column)`` where they are known.
    """

    def __init__(self, message: str, counts: Mapping[tuple[str, str], int] | None = None) -> None:
        super().__init__(message)
        self.counts = dict(counts or {})


@dataclass(frozen=True, eq=False)
class TableSpec:
    """One table: order, types and nullability in ``schema``, checks beside it."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    patterns: Mapping[str, str] = field(default_factory=dict)
    partition: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def row_checks(self) -> list[tuple[str, str, Column]]:
        """``(rule, column, broken?)``; the condition is never NULL."""
        checks = [
            ("not_null", f.name, quoted(f.name).isNull())
            for f in self.schema.fields
            if not f.nullable
        ]
        for name, (low, high) in self.ranges.items():
            value = quoted(name)
            outside = F.lit(False)
            if low is not None:
                outside = outside | (value < F.lit(low))
            if high is not None:
                outside = outside | (value > F.lit(high))
            checks.append(("range", name, F.coalesce(outside, F.lit(False))))
        for name, pattern in self.patterns.items():
            checks.append(
                ("pattern", name, F.coalesce(~quoted(name).rlike(pattern), F.lit(False)))
            )
        return checks


def check_schema(df: DataFrame, spec: TableSpec) -> None:
    """Exact column set, order and types; needs no job."""
    found = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    wanted = [(f.name, f.dataType.simpleString()) for f in spec.schema.fields]
    if found != wanted:
        difference = sorted(set(found).symmetric_difference(wanted))
        raise ContractViolation(f"{spec.name}: schema differs: {difference or 'column order'}")


def violation_counts(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``(rule, column, violations)`` for every row check, in one pass."""
    checks = spec.row_checks()
    totals = df.agg(*[F.count_if(broken).alias(f"c{i}") for i, (_, _, broken) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(column).alias("column"),
                F.col(f"c{i}").alias("violations"),
            )
            for i, (rule, column, _) in enumerate(checks)
        ]
    )
    return totals.select(F.inline(rows))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their count."""
    return (
        df.groupBy(*[quoted(k) for k in key])
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > 1)
    )


def require_unique(df: DataFrame, spec: TableSpec) -> None:
    """Reject duplicate keys; reads the key columns only."""
    sample = duplicate_keys(df, spec.key).limit(5).collect()
    if sample:
        raise ContractViolation(f"{spec.name}: duplicate keys, e.g. {[r.asDict() for r in sample]}")


def validate(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Check everything before a load, with counts; returns ``df``.

    Two jobs: one aggregation for all row checks, one for the key.
    """
    check_schema(df, spec)
    broken = violation_counts(df, spec).where(F.col("violations") > 0).collect()
    if broken:
        raise ContractViolation(f"{spec.name}: {[r.asDict() for r in broken]}")
    require_unique(df, spec)
    return df


def guarded(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` with the row checks inside the plan, for the job that writes it.

    The first broken row fails that job, so a load is checked in the pass that
    writes it and commits nothing on failure. The checks ride on the first
    column as a projection: a filter would be pushed below the casts and
    evaluate them a second time.
    """
    check_schema(df, spec)
    broken = F.coalesce(
        *[
            F.when(is_broken, F.lit(f"contract of {spec.name} broken: {rule} on {column}"))
            for rule, column, is_broken in spec.row_checks()
        ],
        F.lit(None).cast("string"),
    )
    carrier = spec.schema.fields[0]
    failure = F.raise_error(broken).cast(carrier.dataType)
    checked = F.when(broken.isNull(), quoted(carrier.name)).otherwise(failure)
    return df.withColumn(carrier.name, checked)


class Audit:
    """Write, audit, publish: a load's contract, decided on what was written.

    :meth:`tap` counts the rows that break each row check in the job that writes
    them, and :meth:`require` adds the rows whose key an earlier one has, read
    from the key columns of the written files. A load is published only if all
    counts are zero; otherwise the error holds every one that is not.
    """

    def __init__(self, spec: TableSpec, *, unique_by_construction: bool = False) -> None:
        self.spec = spec
        self.unique = unique_by_construction
        self._checks = spec.row_checks()
        self._seen = Observation() if self._checks else None

    def tap(self, df: DataFrame) -> DataFrame:
        """``df``, whose rows are checked as they pass; another schema is an error at once."""
        check_schema(df, self.spec)
        if self._seen is None:
            return df
        counts = [F.count_if(broken).alias(f"c{i}") for i, (_, _, broken) in enumerate(self._checks)]
        return df.observe(self._seen, *counts)

    def require(self, stored: DataFrame) -> None:
        """Raise unless what was written, in ``stored``, keeps the contract."""
        counts = {}
        if self._seen is not None:
            found = self._seen.get
            counts = {(rule, column): found[f"c{i}"] for i, (rule, column, _) in enumerate(self._checks)}
        if not self.unique:
            # A partition's files don't hold the column they are partitioned by.
            key = [k for k in self.spec.key if k in stored.columns]
            surplus = duplicate_keys(stored, key).agg(F.sum(F.col("rows") - 1)).first()[0]
            counts["duplicate", ", ".join(self.spec.key)] = surplus or 0
        broken = {check: n for check, n in counts.items() if n}
        if broken:
            listed = "; ".join(f"{rule} on {column}: {n} rows" for (rule, column), n in broken.items())
            raise ContractViolation(f"contract of {self.spec.name} broken: {listed}", broken)
