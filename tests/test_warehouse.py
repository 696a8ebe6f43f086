"""Two weekly refreshes on files, from listing to dashboard."""

from __future__ import annotations

from datetime import date

import pytest
from conftest import DAY, NOW, bed_columns

from lamina.operators import manifest
from lamina.plans import bronze, dashboard, schemas, sources
from lamina.plans.warehouse import Warehouse
from lamina.session import scratch_folder

LATER = date(2026, 6, 17)


def csv_line(names, separator, **cells):
    return separator.join(cells.get(n, "") for n in names)


def establishments(*codes):
    names = list(sources.ESTABLISHMENT_NAMES)
    lines = [
        csv_line(names, ";", CO_CNES=c, CO_UF="35", CO_IBGE="350010", TP_UNIDADE="5", NO_FANTASIA=f"São {c}")
        for c in codes
    ]
    return "\n".join([";".join(names), *lines]) + "\n"


def units(*codes):
    names = list(sources.CARE_UNIT_NAMES)
    return "\n".join([";".join(names), *(csv_line(names, ";", CNES=c, IBGE="350010") for c in codes)]) + "\n"


def beds(separator, *rows):
    names = bed_columns(["COMP", "CNES", "MUNICIPIO", "LEITOS EXISTENTE", "UTI TOTAL - EXIST"])
    lines = [separator.join([*row, *[""] * (len(names) - len(row))]) for row in rows]
    return "\n".join([separator.join(names), *lines]) + "\n"


def occupancy(*rows):
    names = ["", *sources.OCCUPANCY_NAMES]
    lines = [
        csv_line(names, ",", _id=i, cnes=c, dataNotificacao=d, ocupacaoCovidUti=u) for i, c, d, u in rows
    ]
    return "\n".join([",".join(names), *lines]) + "\n"


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    warehouse = Warehouse(spark, scratch_folder(spark, "warehouse"))

    def listing(**files):
        rows = []
        for key, (dataset, year, tag, text, encoding) in files.items():
            path = folder / f"{key}_{tag}.csv"
            path.write_text(text, encoding=encoding)
            rows.append((dataset, year, "remote", tag, None, None, f"{key}{tag}", str(path), True))
        return spark.createDataFrame(rows, manifest.LISTING_SCHEMA)

    latin, utf = "ISO-8859-1", "UTF-8"
    first = {
        "est": ("estabelecimentos", None, "v1", establishments("12", "13"), latin),
        "ubs": ("ubs", None, "v1", units("13", "0000000"), latin),
        "b20": ("leitos", 2020, "v1", beds(",", ("202005", "0000012", "São Paulo", "9", "2")), latin),
        "b21": ("leitos", 2021, "v1", beds(";", ("202105", "0000012", "São Paulo", "9", "2")), latin),
        "b25": ("leitos", 2025, "v1", "QUEBRADO|ARQUIVO\n1|2\n", latin),
        "o21": (
            "covid_ocupacao", 2021, "v1",
            occupancy(("a", "12", "2021-05-03T00:00:00.000Z", "3.0"), ("b", "12", "2021", "9.0")), utf,
        ),
    }
    changed = warehouse.ingest(listing(**first), DAY, NOW)
    loads = {name: warehouse.refresh_silver(name) for name in changed}
    rows = warehouse.refresh_gold()
    return warehouse, listing, first, changed, loads, rows


def test_first_refresh(refreshed):
    warehouse, _, _, changed, loads, rows = refreshed
    assert changed == ["estabelecimentos", "leitos", "covid_ocupacao", "ubs"]
    assert {name: load.rows for name, load in loads.items()} == {
        "estabelecimentos": 2, "leitos": 2, "covid_ocupacao": 1, "ubs": 1,
    }
    assert (loads["leitos"].processed_years, loads["leitos"].skipped_years) == ([2020, 2021], [2025])
    assert loads["covid_ocupacao"].removed == {"identified": 1, "deduplicated": 0}
    assert loads["ubs"].removed == {"keyed": 1, "deduplicated": 0}
    assert rows == {
        "silver.dominio_tp_unidade": 38,
        "silver.dominio_natureza_juridica": 31,
        "gold.dim_tempo": 8766,
        "gold.dim_estabelecimento": 2,
        "gold.dim_municipio": 1,
        "gold.fato_leitos_anual": 2,
        "gold.fato_ocupacao_covid": 1,
        "gold.fato_pressao_uti_covid": 1,
    }
    dim = warehouse.gold(schemas.DIM_ESTABLISHMENT)
    found = dashboard.overload_ranking(dim, warehouse.gold(schemas.FACT_PRESSURE)).collect()
    assert [(r["no_fantasia"], str(r["taxa_ocupacao_uti_covid"])) for r in found] == [("São 12", "1.5000")]
    assert warehouse.gold(schemas.DIM_MUNICIPALITY).first()["no_municipio"] == "São Paulo"


def test_published_facts_are_pruned_by_year(refreshed):
    warehouse, *_ = refreshed
    fact = warehouse.gold(schemas.FACT_BEDS)
    assert fact.columns == schemas.FACT_BEDS.columns
    assert fact.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.FACT_BEDS.schema]
    text = fact.where("ano_referencia = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano_referencia" in text


def test_unchanged_listing_does_nothing(refreshed):
    warehouse, listing, first, *_ = refreshed
    before = warehouse.manifest().count()
    assert warehouse.ingest(listing(**first), LATER, NOW.replace(day=17)) == []
    assert warehouse.manifest().count() == before


def test_an_extraction_can_be_repeated_after_a_lost_job(refreshed, spark):
    """Staged, but not yet noted in the manifest: the second run stages again."""
    warehouse, listing, first, *_ = refreshed
    fresh = Warehouse(spark, scratch_folder(spark, "again"))
    only = listing(b20=first["b20"])
    bronze.ingest_csv(
        spark, sources.BEDS_CSV, only, fresh.manifest(), f"{fresh.root}/staging/leitos", DAY, NOW
    )
    assert fresh.ingest(only, DAY, NOW) == ["leitos"]
    assert fresh.refresh_silver("leitos").rows == 1


def test_one_changed_year(refreshed):
    warehouse, listing, first, *_ = refreshed
    may, june = (("2021" + m, "0000012", "São Paulo", "9", "5") for m in ("05", "06"))
    text = beds(";", may, june)
    second = {**first, "b21": ("leitos", 2021, "v2", text, "ISO-8859-1")}
    assert warehouse.ingest(listing(**second), LATER, NOW.replace(day=18)) == ["leitos"]
    load = warehouse.refresh_silver("leitos", whole_series=False)
    assert (load.rows, load.processed_years) == (2, [2021])  # only what this extraction brought
    for _ in range(2):  # again gives the same state, with the years that did not change
        load = warehouse.refresh_silver("leitos")
        assert (load.rows, load.processed_years, load.skipped_years) == (3, [2020, 2021], [2025])
    assert warehouse.refresh_gold(["gold.fato_leitos_anual"]) == {"gold.fato_leitos_anual": 2}
    fact = warehouse.gold(schemas.FACT_BEDS)
    assert {(r["ano_referencia"], r["uti_total_max"]) for r in fact.collect()} == {(2020, 2), (2021, 5)}


def test_a_refresh_does_only_what_changed(refreshed, spark):
    _, listing, first, *_ = refreshed
    warehouse = Warehouse(spark, scratch_folder(spark, "incremental"))

    def folders_of(spec):
        return {k: p[0] for k, p in warehouse._gold_table(spec).snapshot().parts.items()}

    def day(n):
        return {"extraction_date": date(2026, 6, n), "ingested_at": NOW.replace(day=n)}

    only_beds = {k: first[k] for k in ("b20", "b21", "b25")}
    done = warehouse.refresh(listing(**only_beds), **day(1))
    assert (done.staged, list(done.silver)) == (["leitos"], ["leitos"])
    assert done.gold["gold.fato_leitos_anual"] == 2 and "gold.dim_municipio" not in done.gold
    done = warehouse.refresh(listing(**first), **day(2))
    assert done.staged == ["estabelecimentos", "covid_ocupacao", "ubs"] and "leitos" not in done.silver
    assert "gold.fato_leitos_anual" not in done.gold and done.gold["gold.fato_pressao_uti_covid"] == 1

    # Unchanged: no load, and the Gold step runs no job at all.
    done = warehouse.refresh(listing(**first), **day(3))
    assert (done.staged, done.silver, done.gold) == ([], {}, {})
    spark.sparkContext.setJobGroup("unchanged", "")
    try:
        assert warehouse.refresh_gold(only_changed=True) == {}
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("unchanged")) == 0
    finally:
        spark.sparkContext._jsc.clearJobGroup()

    # One changed year: one partition of the fact, and of what is made of it.
    beds_before, pressure_before = folders_of(schemas.FACT_BEDS), folders_of(schemas.FACT_PRESSURE)
    occupancy_before = folders_of(schemas.FACT_OCCUPANCY)
    changed = beds(";", ("202105", "0000012", "São Paulo", "9", "5"))
    second = {**first, "b21": ("leitos", 2021, "v3", changed, "ISO-8859-1")}
    done = warehouse.refresh(listing(**second), **day(4))
    assert done.staged == ["leitos"] and list(done.silver) == ["leitos"]
    assert done.gold == {"gold.dim_municipio": 1, "gold.fato_leitos_anual": 1, "gold.fato_pressao_uti_covid": 1}
    after = folders_of(schemas.FACT_BEDS)
    assert {k for k in after if after[k] != beds_before[k]} == {"ano_referencia=2021"}
    assert folders_of(schemas.FACT_OCCUPANCY) == occupancy_before
    assert folders_of(schemas.FACT_PRESSURE).keys() == pressure_before.keys()

    # The same rows as a rebuild of everything gives.
    specs = (schemas.FACT_BEDS, schemas.FACT_OCCUPANCY, schemas.FACT_PRESSURE, schemas.DIM_MUNICIPALITY)
    stamps = ("_loaded_at", "_extraction_date")
    rows = {s.name: sorted(map(str, warehouse.gold(s).drop(*stamps).collect())) for s in specs}
    warehouse.refresh_gold()
    assert rows == {s.name: sorted(map(str, warehouse.gold(s).drop(*stamps).collect())) for s in specs}

    # A year that goes from the series goes from the facts: 2021 has no readable file now.
    third = {**first, "b21": ("leitos", 2021, "v4", "QUEBRADO|ARQUIVO\n1|2\n", "ISO-8859-1")}
    warehouse.refresh(listing(**third), **day(5))
    assert list(folders_of(schemas.FACT_BEDS)) == ["ano_referencia=2020"]
    assert warehouse.gold(schemas.FACT_PRESSURE).count() == 0


def test_a_refresh_finishes_a_lost_one(refreshed, spark):
    _, listing, first, *_ = refreshed
    warehouse = Warehouse(spark, scratch_folder(spark, "resumed"))
    only_beds = listing(**{k: first[k] for k in ("b20", "b21")})
    assert warehouse.ingest(only_beds, DAY, NOW) == ["leitos"]  # and lost here
    done = warehouse.refresh(only_beds, LATER, NOW.replace(day=17))
    assert (done.staged, list(done.silver), done.gold["gold.fato_leitos_anual"]) == ([], ["leitos"], 2)
    # A load of one extraction's years alone is not the whole series, so the next refresh loads that.
    warehouse.refresh_silver("leitos", whole_series=False)
    assert list(warehouse.refresh(only_beds, LATER, NOW.replace(day=18)).silver) == ["leitos"]


def test_the_manifest_is_compacted(refreshed, spark, monkeypatch):
    from lamina.plans import warehouse as module

    monkeypatch.setattr(module, "TAIL", 3)
    warehouse = Warehouse(spark, scratch_folder(spark, "noted"))
    record = dict.fromkeys(manifest.MANIFEST_SCHEMA.names) | {"dataset": "leitos", "extraction_date": DAY}
    for n in range(12):
        row = record | {"year": 2000 + n % 3, "ingested_at": NOW.replace(minute=n), "etag": f"v{n}"}
        assert warehouse._note(spark.createDataFrame([row], manifest.MANIFEST_SCHEMA))
        assert len(warehouse._manifest().snapshot().parts) <= 4
    assert warehouse.manifest().count() == 12
    newest = manifest.current(warehouse.manifest()).collect()
    assert {(r["year"], r["etag"]) for r in newest} == {(2000, "v9"), (2001, "v10"), (2002, "v11")}
    assert len(warehouse._manifest().versions()) <= 6


def test_vaccination_refresh(refreshed, tmp_path):
    warehouse, *_ = refreshed
    (tmp_path / "page_0000.json").write_text('[{"codigo_documento": "x"}]')
    assert warehouse.ingest_vaccination(str(tmp_path), "pni_2021_SE", DAY, NOW)
    assert not warehouse.ingest_vaccination(str(tmp_path), "pni_2021_SE", LATER, NOW)
