"""The whole refresh, in the order of its dependencies, on one shared folder.

    <root>/manifest/                     append-only change record, compacted as it grows
    <root>/staging/<dataset>/<date>/     all-string Parquet, written once
    <root>/silver/<table>/               commit log and partitions by extraction date
    <root>/gold/<table>/                 commit log and data, facts by year

Every Gold table notes what it was made of. :meth:`Warehouse.refresh` compares
the notes with the logs of its inputs, so what did not change costs no job, and
of a fact only the years that did are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators import manifest
from lamina.operators.contracts import Audit, TableSpec
from lamina.operators.digest import row_sums
from lamina.operators.latest import latest_snapshot
from lamina.operators.quality import RowCounts
from lamina.plans import bronze, domains, gold, schemas, silver, sources
from lamina.session import sized_shuffles
from lamina.sinks.versioned import Table
from lamina.sources import folders, staged

CSV_DATASETS = (
    sources.ESTABLISHMENTS_CSV,
    sources.BEDS_CSV,
    sources.OCCUPANCY_CSV,
    sources.CARE_UNITS_CSV,
)

SILVER = {
    sources.ESTABLISHMENTS_CSV.name: schemas.ESTABLISHMENTS,
    sources.BEDS_CSV.name: schemas.BEDS,
    sources.OCCUPANCY_CSV.name: schemas.OCCUPANCY,
    sources.CARE_UNITS_CSV.name: schemas.CARE_UNITS,
}


# Appended parts of the change record that a reader meets at most, beside the compacted one.
TAIL = 32

# What a fact reads of its Silver table: years are compared by these columns.
FACT_INPUTS = {
    schemas.FACT_BEDS.name: ["cnes", "leitos_existentes", "leitos_sus", "uti_total_exist", "uti_total_sus"],
    schemas.FACT_OCCUPANCY.name: [
        "cnes", "data_notificacao", "excluido", "ocupacao_covid_uti", "ocupacao_covid_cli",
        "ocupacao_hospitalar_uti", "ocupacao_hospitalar_cli", "saida_confirmada_obitos",
        "saida_confirmada_altas", "saida_suspeita_obitos", "saida_suspeita_altas",
    ],
}


# The Silver tables that a Gold table is made of, directly or through a fact.
GOLD_INPUTS = {
    schemas.UNIT_TYPES.name: [],
    schemas.LEGAL_NATURES.name: [],
    schemas.DIM_TIME.name: [],
    schemas.DIM_ESTABLISHMENT.name: [sources.ESTABLISHMENTS_CSV.name, sources.CARE_UNITS_CSV.name],
    schemas.DIM_MUNICIPALITY.name: [
        sources.ESTABLISHMENTS_CSV.name, sources.BEDS_CSV.name, sources.CARE_UNITS_CSV.name,
    ],
    schemas.FACT_BEDS.name: [sources.BEDS_CSV.name],
    schemas.FACT_OCCUPANCY.name: [sources.OCCUPANCY_CSV.name],
    schemas.FACT_PRESSURE.name: [sources.OCCUPANCY_CSV.name, sources.BEDS_CSV.name],
}


@dataclass(frozen=True)
class Refresh:
    """What one refresh did: datasets staged, Silver loads, and rows written per Gold table."""

    staged: list[str]
    silver: dict[str, SilverLoad]
    gold: dict[str, int]


@dataclass(frozen=True)
class SilverLoad:
    """What one Silver refresh did."""

    rows: int
    removed: dict[str, int]
    processed_years: list[int]
    skipped_years: list[int]


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def _folder(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    # --- change record ------------------------------------------------------

    def _manifest(self) -> Table:
        return Table(self.spark, self._folder("manifest"))

    def manifest(self) -> DataFrame:
        stored = self._manifest()
        if stored.exists():
            return stored.read()
        return self.spark.createDataFrame([], manifest.MANIFEST_SCHEMA)

    def _note(self, records: DataFrame) -> bool:
        """Append manifest records (a row per file); false when there are none."""
        found = records.collect()
        if found:
            stored = self._manifest()
            stored.append(self.spark.createDataFrame(found, manifest.MANIFEST_SCHEMA).coalesce(1))
            if len(stored.snapshot().parts) > TAIL:
                stored.compact()
                stored.vacuum(keep=TAIL)
        return bool(found)

    # --- staging ------------------------------------------------------------

    def ingest(
        self,
        listing: DataFrame,
        extraction_date: date,
        ingested_at: datetime | None = None,
        **options,
    ) -> list[str]:
        """Stage what is new in the listing; names of the datasets to refresh."""
        moment = ingested_at or datetime.now(tz=timezone.utc)
        changed = []
        for dataset in CSV_DATASETS:
            records = bronze.ingest_csv(
                self.spark,
                dataset,
                listing,
                self.manifest(),
                self._folder("staging", dataset.name),
                extraction_date,
                moment,
                **options,
            )
            self._note(records)
            landed = self.manifest().where(F.col("dataset") == dataset.name)
            newest = landed.where(F.col("ingested_at") == F.lit(moment))
            if not newest.where(F.col("extraction_date") == F.lit(extraction_date)).isEmpty():
                changed.append(dataset.name)
        return changed

    def ingest_vaccination(
        self,
        folder: str,
        source_name: str,
        extraction_date: date,
        ingested_at: datetime | None = None,
        **options,
    ) -> bool:
        """Stage landed vaccination pages; false when the payload is known."""
        record = bronze.ingest_vaccination(
            self.spark,
            folder,
            self.manifest(),
            self._folder("staging", sources.VACCINATION),
            source_name,
            extraction_date,
            ingested_at or datetime.now(tz=timezone.utc),
            **options,
        )
        return record is not None and self._note(record)

    # --- Silver -------------------------------------------------------------

    def _years(
        self, dataset: sources.CsvDataset, extracted: date, required: str | None, whole_series: bool
    ) -> staged.YearlyFrames:
        if whole_series:
            known = self.manifest().where(F.col("dataset") == dataset.name)
            return staged.read_years_of_manifest(self.spark, manifest.current(known), required)
        folder = self._folder("staging", dataset.name, extracted.isoformat())
        return staged.read_yearly(self.spark, folder, dataset.year_prefix, required)

    def _sized(self, *parts: str):
        """Shuffles sized by what is stored below a folder, for the jobs inside."""
        path = self._folder(*parts)
        stored = folders.size(self.spark, path) if folders.exists(self.spark, path) else 0
        return sized_shuffles(self.spark, stored)

    def refresh_silver(self, name: str, *, whole_series: bool = True) -> SilverLoad:
        """Load the newest extraction of a dataset into its Silver partition.

        An incremental extraction holds only the years that changed, so every
        year of a yearly dataset is loaded from its own newest extraction.
        Without ``whole_series`` only the years staged on that date are.
        """
        with self._sized("staging", name):
            return self._refresh_silver(name, whole_series)

    def _refresh_silver(self, name: str, whole_series: bool) -> SilverLoad:
        # Only a load of all years is what the change record offers; noted as it was before the load.
        offered = self._offered()[name] if whole_series else {}
        extracted, path = manifest.latest_extraction_of(self.manifest(), name)
        counts = RowCounts()
        if name == sources.BEDS_CSV.name:
            years = self._years(sources.BEDS_CSV, extracted, "COMP", whole_series)
            made = silver.beds(
                years.frames, extracted, skipped_years=years.skipped_years, counts=counts
            )
        elif name == sources.OCCUPANCY_CSV.name:
            years = self._years(sources.OCCUPANCY_CSV, extracted, None, whole_series)
            made = silver.occupancy(years.frames, extracted, counts=counts)
        elif name == sources.CARE_UNITS_CSV.name:
            frame = staged.read_staged(self.spark, path)
            made = silver.care_units(frame, extracted, counts=counts)
        else:
            made = silver.establishments(staged.read_staged(self.spark, path), extracted)
        rows = self._silver_table(name).load(
            made.df,
            SILVER[name],
            extracted,
            unique_by_construction=name != sources.ESTABLISHMENTS_CSV.name,
            notes={"inputs": offered},
        )
        return SilverLoad(rows, counts.removed(), made.processed_years, made.skipped_years)

    def _silver_table(self, name: str) -> Table:
        return Table(self.spark, self._folder("silver", name))

    def silver(self, name: str) -> DataFrame:
        """Newest snapshot of a Silver table."""
        return latest_snapshot(self._silver_table(name).read(), SILVER[name].partition, self.snapshot(name))

    def snapshot(self, name: str) -> date:
        """Its extraction date, from the commit log."""
        dates = self._silver_table(name).values()
        if not dates:
            raise FileNotFoundError(f"no extraction of {name} is loaded")
        return max(date.fromisoformat(d) for d in dates)

    def _offered(self) -> dict[str, dict[str, str]]:
        """Per dataset the content of each year (or of its one file), from the change record."""
        offered: dict[str, dict[str, str]] = {name: {} for name in SILVER}
        version = F.coalesce(*[F.expr(f"nullif({c}, '')") for c in ("source_hash", "etag", "last_modified")])
        known = manifest.current(self.manifest()).select("dataset", "year", "parquet_path", version.alias("version"))
        for row in known.collect():  # a row per file
            if row["dataset"] in offered:
                offered[row["dataset"]][str(row["year"])] = f"{row['parquet_path']}|{row['version']}"
        return offered

    def _stale_silver(self) -> list[str]:
        """Datasets whose Silver table was not made of what is staged now."""
        stale = []
        for name, offered in self._offered().items():
            loaded = self._silver_table(name).snapshot()
            if offered and (loaded is None or loaded.notes.get("inputs") != offered):
                stale.append(name)
        return stale

    # --- Gold ---------------------------------------------------------------

    def _gold_table(self, spec: TableSpec) -> Table:
        return Table(self.spark, self._folder("gold", spec.name))

    def gold(self, spec: TableSpec) -> DataFrame:
        """The published rows of a code table, dimension or fact."""
        return self._gold_table(spec).read()

    def _made_of(self, name: str) -> str:
        """The data folder of a Silver table's newest snapshot: another one after every load."""
        known = self._silver_table(name).snapshot()
        key = f"{SILVER[name].partition}={self.snapshot(name).isoformat()}"
        return known.parts[key][0]

    def _years_of_silver(self, name: str, spec: TableSpec) -> dict[str, str]:
        """Every year's content, as far as the fact reads it: a partial aggregation, a row per year."""
        found = row_sums(self.silver(name), FACT_INPUTS[spec.name], spec.partition)
        return {str(r[spec.partition]): r["content"] for r in found.collect()}

    def _years_of_gold(self, *specs: TableSpec) -> dict[str, str]:
        """The data folders of every year that all the facts have; no job."""
        held = [{k.split("=", 1)[1]: p[0] for k, p in self._gold_table(s).snapshot().parts.items()} for s in specs]
        first, last = gold.PRESSURE_YEARS
        both = set.intersection(*map(set, held))
        return {y: "|".join(h[y] for h in held) for y in both if first <= int(y) <= last}

    def _refresh_whole(
        self, spec: TableSpec, build: Callable[[], DataFrame], changed: bool
    ) -> int | None:
        inputs = {name: self._made_of(name) for name in GOLD_INPUTS[spec.name]}
        stored = self._gold_table(spec)
        if changed and stored.exists() and stored.snapshot().notes.get("inputs") == inputs:
            return None
        return stored.replace(build(), Audit(spec), {"inputs": inputs})

    def _refresh_years(
        self,
        spec: TableSpec,
        inputs: dict[str, str],
        years: Callable[[], dict[str, str]],
        build: Callable[[list[int]], DataFrame],
        changed: bool,
    ) -> int | None:
        stored = self._gold_table(spec)
        noted = stored.snapshot().notes if stored.exists() else {}
        if changed and noted.get("inputs") == inputs:
            return None
        now, before = years(), noted.get("years", {})
        touched = {y for y in now.keys() | before.keys() if not changed or now.get(y) != before.get(y)}
        every = touched | (set() if changed else set(stored.values()))
        values = sorted(int(y) for y in every)
        return stored.replace_partitions(
            build(values), spec.partition, values, Audit(spec), {"inputs": inputs, "years": now}
        )

    def refresh_gold(
        self, names: Collection[str] | None = None, *, only_changed: bool = False
    ) -> dict[str, int]:
        """Rebuild code tables, dimensions and facts; rows written per table.

        ``names`` limits the rebuild; what is left out must be published. With
        ``only_changed`` a table whose inputs are those it notes is left out of
        the result and costs no job, and only those years of a fact are replaced
        whose rows differ. A year that stays keeps the ``_extraction_date`` that
        brought its rows. After a change of these plans, rebuild everything.
        """
        beds, occupancy = sources.BEDS_CSV.name, sources.OCCUPANCY_CSV.name
        establishments, units = sources.ESTABLISHMENTS_CSV.name, sources.CARE_UNITS_CSV.name
        whole = {
            schemas.UNIT_TYPES: lambda: domains.unit_types(self.spark),
            schemas.LEGAL_NATURES: lambda: domains.legal_natures(self.spark),
            schemas.DIM_TIME: lambda: gold.dim_time(self.spark),
            schemas.DIM_ESTABLISHMENT: lambda: gold.dim_establishment(
                self.silver(establishments),
                self.silver(units),
                snapshot=self.snapshot(establishments),
                care_unit_snapshot=self.snapshot(units),
            ),
            schemas.DIM_MUNICIPALITY: lambda: gold.dim_municipality(
                self.silver(establishments),
                self.silver(beds),
                self.silver(units),
                snapshot=self.snapshot(establishments),
                bed_snapshot=self.snapshot(beds),
                care_unit_snapshot=self.snapshot(units),
            ),
        }

        def of_years(df: DataFrame, years: list[int]) -> DataFrame:
            return df.where(F.col("ano_referencia").isin(years))

        by_year = {
            schemas.FACT_BEDS: (
                lambda: {beds: self._made_of(beds)},
                lambda: self._years_of_silver(beds, schemas.FACT_BEDS),
                lambda years: gold.fact_beds(of_years(self.silver(beds), years), snapshot=self.snapshot(beds)),
            ),
            schemas.FACT_OCCUPANCY: (
                lambda: {occupancy: self._made_of(occupancy)},
                lambda: self._years_of_silver(occupancy, schemas.FACT_OCCUPANCY),
                lambda years: gold.fact_occupancy(
                    of_years(self.silver(occupancy), years), snapshot=self.snapshot(occupancy)
                ),
            ),
            schemas.FACT_PRESSURE: (
                lambda: self._years_of_gold(schemas.FACT_OCCUPANCY, schemas.FACT_BEDS),
                lambda: self._years_of_gold(schemas.FACT_OCCUPANCY, schemas.FACT_BEDS),
                lambda years: gold.fact_pressure(
                    of_years(self.gold(schemas.FACT_OCCUPANCY), years),
                    of_years(self.gold(schemas.FACT_BEDS), years),
                ),
            ),
        }
        rows: dict[str, int | None] = {}
        with self._sized("silver"):
            for spec, build in whole.items():
                if names is None or spec.name in names:
                    rows[spec.name] = self._refresh_whole(spec, build, only_changed)
            for spec, (inputs, years, build) in by_year.items():
                if names is None or spec.name in names:
                    rows[spec.name] = self._refresh_years(spec, inputs(), years, build, only_changed)
        return {name: n for name, n in rows.items() if n is not None}

    def refresh(
        self,
        listing: DataFrame,
        extraction_date: date,
        ingested_at: datetime | None = None,
        **options,
    ) -> Refresh:
        """Stage what is new, and bring up to date only what depends on it.

        What is stale is found in the logs, not in what this call staged, so a
        refresh after one that was lost at any step does the rest of it. Where
        nothing is stale, nothing below the staging runs a job. Gold tables wait
        until every Silver table they are made of is loaded.
        """
        staged_now = self.ingest(listing, extraction_date, ingested_at, **options)
        loads = {name: self.refresh_silver(name) for name in self._stale_silver()}
        loaded = {name for name in SILVER if self._silver_table(name).exists()}
        ready = [name for name, inputs in GOLD_INPUTS.items() if loaded.issuperset(inputs)]
        return Refresh(staged_now, loads, self.refresh_gold(ready, only_changed=True))
