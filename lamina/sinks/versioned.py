"""Stored tables with a commit log: replacements are one transaction, columns can be added.

    <table>/_log/<version>.json      what the table consists of, whole, from this version on
    <table>/<column>=<value>/<id>/   Parquet of one partition, never changed once written
    <table>/all/<id>/                Parquet of a table without partitions, or of rows appended to it

A version lists the folder of every partition, so replacing any number of them
is the appearance of one file. It is written under another name and renamed,
which fails if the name is taken: of two writers that began at one version one
gets a :class:`Conflict` and has changed nothing. A writer that stops at any
step leaves folders that no version lists; readers never see them, and
:meth:`Table.vacuum` removes them.

The log also holds the table's columns with a default each. A partition keeps
the columns it was written with; what was added later is filled in when it is
read, so a new column rewrites no data. Notes are what a writer wants to know of
its last write, like the versions of its inputs; they appear with it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Collection
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.operators.contracts import Audit, ContractViolation, TableSpec
from lamina.operators.shaping import align, quoted, union_drifted
from lamina.sources import folders

LOG = "_log"
WHOLE = "all"


class Conflict(RuntimeError):
    """Another writer committed first; nothing of this write is visible."""


@dataclass(frozen=True)
class Snapshot:
    """One version: its columns and the folders of its partitions."""

    version: int
    partition_column: str | None
    schema: T.StructType
    defaults: dict[str, object]
    # Partition folder (or WHOLE) to [data folder, columns it was written with, rows].
    parts: dict[str, tuple[str, tuple[str, ...], int]]
    notes: dict[str, dict[str, str]] = field(default_factory=dict)

    def to_json(self) -> str:
        held = {k: [f, list(c), n] for k, (f, c, n) in sorted(self.parts.items())}
        return json.dumps(
            {
                "version": self.version,
                "partition_column": self.partition_column,
                "schema": self.schema.jsonValue(),
                "defaults": self.defaults,
                "parts": held,
                "notes": self.notes,
            },
            sort_keys=True,
        )

    @staticmethod
    def from_json(text: str) -> Snapshot:
        held = json.loads(text)
        return Snapshot(
            held["version"],
            held["partition_column"],
            T.StructType.fromJson(held["schema"]),
            held["defaults"],
            {k: (f, tuple(c), n) for k, (f, c, n) in held["parts"].items()},
            held.get("notes", {}),
        )


@dataclass(frozen=True)
class Table:
    spark: SparkSession
    path: str

    # --- the log --------------------------------------------------------------

    def _entry(self, version: int) -> str:
        return f"{self.path.rstrip('/')}/{LOG}/{version:020d}.json"

    def versions(self) -> list[int]:
        names = folders.matching(self.spark, f"{self.path.rstrip('/')}/{LOG}/*.json")
        return [int(folders.base_name(n).split(".")[0]) for n in names]

    def snapshot(self, version: int | None = None) -> Snapshot | None:
        """The newest version, or a given one; None where nothing was committed."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        return Snapshot.from_json(folders.read_text(self.spark, self._entry(version)))

    def exists(self) -> bool:
        return bool(self.versions())

    def _commit(self, made: Snapshot) -> None:
        if not folders.publish_text(self.spark, made.to_json(), self._entry(made.version)):
            raise Conflict(f"version {made.version} of {self.path} was committed by another writer")

    # --- writing --------------------------------------------------------------

    def _begin(self, df: DataFrame, partition_column: str | None) -> Snapshot:
        known = self.snapshot()
        if known is None:
            return Snapshot(0, partition_column, _nullable(df.schema), {}, {})
        if known.partition_column != partition_column:
            raise ValueError(f"{self.path} is partitioned by {known.partition_column}")
        wanted = {f.name: f.dataType for f in known.schema.fields}
        for field in df.schema.fields:
            if wanted.get(field.name) != field.dataType:
                raise ValueError(f"{self.path} has no column {field.name} {field.dataType.simpleString()}")
        return known

    def _write(self, df: DataFrame, folder: str) -> tuple[str, tuple[str, ...], int]:
        """Write a data folder that no version lists yet."""
        target = f"{folder}/{uuid.uuid4().hex}"
        written = Observation()
        rows = df.observe(written, F.count(F.lit(1)).alias("rows"))
        rows.write.option("compression", "zstd").parquet(f"{self.path.rstrip('/')}/{target}")
        return target, tuple(df.columns), written.get["rows"]

    def replace(self, df: DataFrame, audit: Audit | None = None, notes: dict | None = None) -> int:
        """Replace all rows of a table without partitions; returns the rows loaded.

        Rows that fail the ``audit`` leave no version. Without ``notes`` the last ones stay.
        """
        return self._replaced(df, self._begin(df, None), None, None, audit, notes)

    def replace_partition(
        self,
        df: DataFrame,
        column: str,
        value: date | str | int | None,
        audit: Audit | None = None,
        notes: dict | None = None,
    ) -> int:
        """Replace one partition; returns the rows loaded, none of which may be of another one.

        The same input again leaves the same state. Empty input removes the partition.
        """
        return self._replaced(df, self._begin(df, column), column, value, audit, notes)

    def _replaced(
        self,
        df: DataFrame,
        known: Snapshot,
        column: str | None,
        value: object,
        audit: Audit | None,
        notes: dict | None = None,
    ) -> int:
        df = audit.tap(df) if audit else df
        if column is None:
            key, rows = WHOLE, df
        else:
            key = folders.base_name(folders.of_partition(self.spark, self.path, column, value))
            held = quoted(column)
            message = F.concat(F.lit(f"row outside partition {value}: "), F.coalesce(held.cast("string"), F.lit("NULL")))
            stray = ~held.eqNullSafe(F.lit(value).cast(df.schema[column].dataType))
            fine = F.coalesce(F.when(stray, F.raise_error(message).cast("boolean")), F.lit(True))
            rows = df.where(fine).drop(column)
        target, columns, loaded = self._write(rows, key)
        if audit is not None:
            try:
                audit.require(self.spark.read.parquet(f"{self.path.rstrip('/')}/{target}"))
            except ContractViolation:
                folders.delete(self.spark, f"{self.path.rstrip('/')}/{target}")
                raise
        parts = {k: p for k, p in known.parts.items() if column is not None and k != key}
        if loaded or column is None:
            parts[key] = (target, columns, loaded)
        try:
            self._commit(_next(known, parts, notes))
        except Conflict:
            folders.delete(self.spark, f"{self.path.rstrip('/')}/{target}")
            raise
        return loaded

    def replace_partitions(
        self,
        df: DataFrame,
        column: str,
        values: Collection[date | str | int | None],
        audit: Audit | None = None,
        notes: dict | None = None,
    ) -> int:
        """Replace the partitions of all given values as one transaction; returns the rows loaded.

        A row of any other value fails the job. A value without rows loses its
        partition, and the partitions of values not given stay as they are. One
        job writes the rows, those of a large partition into several files.
        """
        known = self._begin(df, column)
        root = self.path.rstrip("/")
        # No version lists this folder, so what a lost writer leaves in it goes with the next vacuum.
        prepared = f"{root}/prepared-{uuid.uuid4().hex}"
        held, kind = quoted(column), df.schema[column].dataType
        given = F.lit(False)
        for value in values:
            given = given | held.eqNullSafe(F.lit(value).cast(kind))
        message = F.concat(F.lit("row outside the given partitions: "), F.coalesce(held.cast("string"), F.lit("NULL")))
        rows = audit.tap(df) if audit else df
        rows = rows.where(F.coalesce(F.when(~given, F.raise_error(message).cast("boolean")), F.lit(True)))
        made: dict[str, tuple[str, tuple[str, ...], int]] = {}
        try:
            rows.hint("rebalance", column).write.partitionBy(column).option("compression", "zstd").parquet(prepared)
            written = self.spark.read.schema(df.schema).parquet(prepared)
            if audit is not None:
                audit.require(written)
            columns = tuple(c for c in df.columns if c != column)
            for value, loaded in written.groupBy(held).count().collect():
                key = folders.base_name(folders.of_partition(self.spark, self.path, column, value))
                made[key] = (f"{key}/{uuid.uuid4().hex}", columns, loaded)
                folders.move(self.spark, f"{prepared}/{key}", f"{root}/{made[key][0]}")
            gone = {folders.base_name(folders.of_partition(self.spark, self.path, column, v)) for v in values}
            parts = {k: p for k, p in known.parts.items() if k not in gone} | made
            self._commit(_next(known, parts, notes))
        except (Conflict, ContractViolation):
            for folder, _, _ in made.values():
                folders.delete(self.spark, f"{root}/{folder}")
            raise
        finally:
            folders.delete(self.spark, prepared)
        return sum(loaded for _, _, loaded in made.values())

    def append(self, df: DataFrame, attempts: int = 20) -> int:
        """Add rows to a table without partitions; returns how many.

        Writers that append at once don't disturb each other: one that comes
        second commits its folder again behind the first one's version.
        """
        made = self._write(df, WHOLE)
        for _ in range(attempts):
            known = self._begin(df, None)
            try:
                self._commit(_next(known, known.parts | {made[0]: made}))
            except Conflict:
                continue
            return made[2]
        folders.delete(self.spark, f"{self.path.rstrip('/')}/{made[0]}")
        raise Conflict(f"{attempts} attempts to append to {self.path} met other writers")

    def compact(self, attempts: int = 20) -> bool:
        """Bring the appended parts of a table without partitions together; false if there is one at most.

        The rows stay, and so do parts that others append meanwhile. If another
        writer replaced what was read, that stands and this one is a :class:`Conflict`.
        """
        known = self.snapshot()
        if known is None or known.partition_column is not None or len(known.parts) < 2:
            return False
        made = self._write(self._rows(known).hint("rebalance"), WHOLE)
        for _ in range(attempts):
            newest = self.snapshot()
            if not known.parts.keys() <= newest.parts.keys():
                break
            later = {k: p for k, p in newest.parts.items() if k not in known.parts}
            try:
                self._commit(_next(newest, {made[0]: made} | later))
            except Conflict:
                continue
            return True
        folders.delete(self.spark, f"{self.path.rstrip('/')}/{made[0]}")
        raise Conflict(f"{self.path} was replaced while it was compacted")

    def load(
        self,
        df: DataFrame,
        spec: TableSpec,
        value: date | None = None,
        *,
        unique_by_construction: bool = False,
        notes: dict | None = None,
    ) -> int:
        """Check the contract and replace the partition ``value``, or the whole table.

        All checks are counted on the way (:class:`Audit`), so a load that breaks some leaves no version.
        """
        audit = Audit(spec, unique_by_construction=unique_by_construction)
        if spec.partition is None:
            return self.replace(df, audit, notes)
        return self.replace_partition(df, spec.partition, value, audit, notes)

    def add_column(self, name: str, kind: T.DataType, default: object = None) -> bool:
        """Add a column unless it is there; what was stored before reads as ``default``.

        False if the column exists. One of another type is an error.
        """
        known = self.snapshot()
        if known is None:
            raise FileNotFoundError(self.path)
        present = {f.name: f.dataType for f in known.schema.fields}
        if name in present:
            if present[name] != kind:
                raise ValueError(f"{name} is {present[name].simpleString()}, not {kind.simpleString()}")
            return False
        schema = T.StructType([*known.schema.fields, T.StructField(name, kind)])
        defaults = known.defaults | {name: default}
        self._commit(replace(known, version=known.version + 1, schema=schema, defaults=defaults))
        return True

    # --- reading --------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest if none is given, all columns in the table's order.

        A filter on the partition column prunes folders.
        """
        known = self.snapshot(version)
        if known is None:
            raise FileNotFoundError(f"nothing committed in {self.path}")
        return self._rows(known)

    def _rows(self, known: Snapshot) -> DataFrame:
        # Partitions that were written with the same columns are one read.
        groups: dict[tuple[str, ...], list[str]] = {}
        for folder, columns, _ in known.parts.values():
            groups.setdefault(columns, []).append(folder)
        types = {f.name: f for f in known.schema.fields}
        root = self.path.rstrip("/")
        reads = []
        for columns, places in sorted(groups.items()):
            partition = [known.partition_column] if known.partition_column else []
            stored = T.StructType([types[c] for c in [*columns, *partition]])
            found = self.spark.read.schema(stored).option("basePath", root).parquet(*[f"{root}/{p}" for p in sorted(places)])
            reads.append(align(found, known.schema, known.defaults))
        return union_drifted(reads) if reads else self.spark.createDataFrame([], known.schema)

    def values(self) -> list[str]:
        """Values of the partition column, as their folders spell them."""
        known = self.snapshot()
        return sorted(k.split("=", 1)[1] for k in known.parts) if known else []

    # --- upkeep ---------------------------------------------------------------

    def vacuum(self, keep: int = 2, older_than_seconds: float = 86_400) -> int:
        """Delete versions but the newest ``keep``, and folders that none of these lists.

        Folders younger than the given age stay: a writer may be about to commit them.
        """
        known = self.versions()
        stay = known[-max(keep, 1) :]
        listed = {p[0] for v in stay for p in self.snapshot(v).parts.values()}
        root = self.path.rstrip("/")
        removed = 0
        for folder in folders.matching(self.spark, f"{root}/*/*"):
            relative = "/".join(folder.rsplit("/", 2)[1:])
            if relative.startswith(("_", ".")) or relative in listed:
                continue
            if time.time() - folders.modified(self.spark, folder) >= older_than_seconds:
                removed += folders.delete(self.spark, folder)
        for version in known[: -max(keep, 1)]:
            folders.delete(self.spark, self._entry(version))
        return removed


def _next(known: Snapshot, parts: dict, notes: dict | None = None) -> Snapshot:
    """The version after ``known`` with other parts, and other notes if some are given."""
    return replace(known, version=known.version + 1, parts=parts, notes=known.notes if notes is None else notes)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
