"""Miniature pipelines with results worked out by hand."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import DAY, NOW, bed_columns, staged, staged_beds
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lamina.operators import contracts
from lamina.operators.quality import RowCounts
from lamina.operators.shaping import MissingColumns
from lamina.plans import bronze, dashboard, domains, gold, schemas, silver, sources
from lamina.session import scratch_folder
from lamina.sinks import tables

OLD = ["COMP", "CNES", "MUNICIPIO", "LEITOS EXISTENTE", "LEITOS SUS", "UTI TOTAL - EXIST"]
NEW = ["COMP", "CNES", "MUNICIPIO", "LEITOS_EXISTENTES", "LEITOS_SUS", "UTI_TOTAL_EXIST", "LIXO"]


def test_name_maps_are_complete():
    assert len(sources.ESTABLISHMENT_NAMES) == 36
    assert len(sources.CARE_UNIT_NAMES) == 8
    assert len(sources.OCCUPANCY_NAMES) == 24
    assert len(sources.BED_NAMES) == 51
    assert len(set(sources.BED_NAMES.values())) == 34
    assert set(schemas.BED_MEASURES) <= set(sources.BED_NAMES.values())
    widths = [
        len(s.columns)
        for s in (schemas.ESTABLISHMENTS, schemas.BEDS, schemas.OCCUPANCY, schemas.CARE_UNITS)
    ]
    assert widths == [41, 40, 30, 13]


def test_beds_across_years(spark):
    frames = {
        2020: staged_beds(
            spark,
            [
                ("202001", "0000001", "A", "10", "x", "1"),
                ("202001", "0000001", "A", "12", "5", "2"),  # later row of the same file
                ("202012", "0000001", "B", "20", "13.0", "3"),  # corrected in 2021
                ("2020-1", "0000001", "B", "20", "1", "3"),
                (None, "0000001", "B", "20", "1", "3"),
                ("202001\n", "0000002", "B", "20", "1", "3"),
            ],
            OLD,
        ),
        2021: staged_beds(
            spark,
            [("202012", "0000001", "C", "30", "7", "4", "?"), ("202101", "2", "C", "1", "", "0", "?")],
            NEW,
            source="leitos_2021.csv",
        ),
    }
    counts = RowCounts()
    made = silver.beds(frames, DAY, skipped_years=[2025], cleansed_at=NOW, counts=counts)
    assert (made.processed_years, made.skipped_years) == ([2020, 2021], [2025])
    contracts.validate(made.df, schemas.BEDS)
    found = made.df.select(
        "comp", "cnes", "municipio", "leitos_existentes", "leitos_sus", "uti_total_exist",
        "uti_adulto_sus", "regiao", "ano_referencia", "_extraction_date",
    )
    assert sorted(tuple(r) for r in found.collect()) == [
        ("202001", "0000001", "A", 12, 5, 2, 0, None, 2020, DAY),
        ("202012", "0000001", "C", 30, 7, 4, 0, None, 2020, DAY),
        ("202101", "2", "C", 1, 0, 0, 0, None, 2021, DAY),
    ]
    assert counts.counts() == {"read": 8, "valid_period": 5, "deduplicated": 3}


def test_beds_options(spark):
    frame = staged_beds(spark, [("202001", " 12 ", " nulo ", "1", "1", "1")], OLD)
    plain = silver.beds({2020: frame}, DAY).df.first()
    tidy = silver.beds({2020: frame}, DAY, normalize_keys=True, clean_names=True).df.first()
    assert (plain["cnes"], plain["municipio"]) == (" 12 ", " nulo ")
    assert (tidy["cnes"], tidy["municipio"]) == ("0000012", None)


def test_an_attribute_that_no_year_has_is_an_error(spark):
    frame = staged_beds(spark, [("202001", "1", "A", "1", "1", "1")], OLD).drop("REGIAO")
    with pytest.raises(MissingColumns, match="regiao"):
        silver.beds({2020: frame}, DAY)


def test_negative_beds_break_the_contract(spark):
    frame = staged_beds(spark, [("202001", "1", "A", "-1", "1", "1")], OLD)
    made = silver.beds({2020: frame}, DAY).df
    with pytest.raises(contracts.ContractViolation, match="leitos_existentes"):
        contracts.validate(made, schemas.BEDS)
    with pytest.raises(PySparkException, match="leitos_existentes"):
        contracts.guarded(made, schemas.BEDS).collect()


def occupancy_frame(spark, rows):
    columns = ["_c0", "_p_usuario", *sources.OCCUPANCY_NAMES]
    cells = [tuple(row.get(c) for c in columns) for row in rows]
    return staged(spark, cells, columns)


def notification(**cells):
    base = {"_id": "a", "cnes": "12", "dataNotificacao": "2021-01-01T00:30:00.000Z"}
    return {**base, **cells}


def test_occupancy(spark):
    frames = {
        2020: occupancy_frame(
            spark,
            [
                notification(ocupacaoCovidUti="13.9", excluido="True", origem=" null "),
                notification(_id="b", cnes="", ocupacaoCovidUti="-2"),  # kept as 0000000
                notification(_id="c", cnes=None),
                notification(_id="d", dataNotificacao="2021"),
                notification(_id=None),
            ],
        ),
        2021: occupancy_frame(spark, [notification(cnes=" 12345678 ", ocupacaoCovidUti="x")]),
    }
    counts = RowCounts()
    made = silver.occupancy(frames, DAY, cleansed_at=NOW, counts=counts)
    contracts.validate(made.df, schemas.OCCUPANCY)
    found = made.df.select(
        "id_registro", "cnes", "ocupacao_covid_uti", "excluido", "origem", "ano_referencia",
        "data_notificacao",
    )
    assert sorted(tuple(r) for r in found.collect()) == [
        ("a", "12345678", 0, None, None, 2021, datetime(2021, 1, 1, 0, 30)),
        ("b", "0000000", 0, None, None, 2021, datetime(2021, 1, 1, 0, 30)),
    ]
    assert counts.counts() == {"read": 6, "identified": 3, "deduplicated": 2}


def test_occupancy_that_is_no_number_breaks_the_contract(spark):
    frames = {2020: occupancy_frame(spark, [notification(ocupacaoCovidUti="NaN")])}
    with pytest.raises(contracts.ContractViolation, match="ocupacao_covid_uti"):
        contracts.validate(silver.occupancy(frames, DAY).df, schemas.OCCUPANCY)


def establishment_frame(spark, *rows):
    columns = list(sources.ESTABLISHMENT_NAMES)
    return staged(spark, [tuple(r.get(c) for c in columns) for r in rows], columns)


def establishment(code, **cells):
    base = {"CO_CNES": code, "CO_UF": "35", "CO_IBGE": "350010", "TP_UNIDADE": "5"}
    return {**base, **cells}


def care_unit_frame(spark, *rows):
    return staged(spark, rows, list(sources.CARE_UNIT_NAMES))


def test_establishments(spark):
    raw = establishment_frame(
        spark,
        establishment(
            " 12 ",
            NO_FANTASIA=" São José ",
            ST_ATEND_HOSPITALAR="1.0",
            ST_CENTRO_CIRURGICO="0.0",
            NU_LATITUDE="-23.5",
            NU_LONGITUDE="0.0",
            CO_MOTIVO_DESAB=" n/a",
        ),
    )
    made = silver.establishments(raw, DAY, NOW).df
    contracts.validate(made, schemas.ESTABLISHMENTS)
    row = made.first()
    assert (row["co_cnes"], row["no_fantasia"], row["co_motivo_desab"]) == ("12", "São José", None)
    assert (row["st_atend_hospitalar"], row["st_centro_cirurgico"]) == (True, False)
    assert (row["nu_latitude"], row["nu_longitude"], row["st_servico_apoio"]) == (-23.5, None, None)
    with pytest.raises(MissingColumns):
        silver.establishments(raw.drop("CO_CNES"), DAY)


def test_duplicate_establishment_is_not_loaded(spark):
    raw = establishment_frame(spark, establishment("1"), establishment("1"))
    made = silver.establishments(raw, DAY, NOW).df
    path = scratch_folder(spark, "silver")
    with pytest.raises(contracts.ContractViolation, match="duplicate"):
        tables.load_silver(made, path, schemas.ESTABLISHMENTS, DAY)
    with pytest.raises(PySparkException):
        spark.read.parquet(path)


def test_care_units(spark):
    raw = care_unit_frame(
        spark,
        ("12", "35", "350010", "A", "NULL", "Centro", " -23,5", "-46,6 "),
        (" 0000012", "35", "350010", "B", "Rua", "Centro", "-23,5", "-90,0"),
        ("", "35", "350010", "C", "", "", "", ""),
        ("0000000", "35", "350010", "D", "", "", "", ""),
        (None, "35", "350010", "E", "", "", "", ""),
    )
    made = silver.care_units(raw, DAY, cleansed_at=NOW).df
    contracts.validate(made, schemas.CARE_UNITS)
    found = made.select("cnes", "no_unidade", "no_logradouro", "nu_latitude", "nu_longitude")
    assert [tuple(r) for r in found.collect()] == [("0000012", "B", "Rua", -23.5, None)]


def test_domains(spark):
    assert domains.states(spark).count() == 27
    assert domains.unit_types(spark).count() == 38
    assert domains.legal_natures(spark).count() == 31
    assert domains.unit_types(spark).select("categoria").distinct().count() == 6
    assert domains.legal_natures(spark).select("grupo").distinct().count() == 4
    for df, spec in (
        (domains.unit_types(spark), schemas.UNIT_TYPES),
        (domains.legal_natures(spark), schemas.LEGAL_NATURES),
    ):
        contracts.validate(df, spec)


def gold_inputs(spark):
    old = date(2026, 6, 1)
    units = care_unit_frame(spark, ("12", "35", "350010", "A", "", "", "", ""))
    stale = care_unit_frame(spark, ("13", "35", "350010", "A", "", "", "", ""))
    raw = establishment_frame(
        spark,
        establishment(
            "12", CO_NATUREZA_JUR="1244", NU_LATITUDE="-23.5", NU_LONGITUDE="-46.6",
            ST_ATEND_HOSPITALAR="1.0",
        ),
        establishment("13", TP_UNIDADE="99", CO_UF="99", CO_MOTIVO_DESAB="01"),
        establishment("14", CO_IBGE=None, TP_UNIDADE=None),
    )
    gone = establishment_frame(spark, establishment("99"))
    return (
        silver.establishments(raw, DAY, NOW).df.unionByName(
            silver.establishments(gone, old, NOW).df
        ),
        silver.care_units(units, DAY).df.unionByName(silver.care_units(stale, old).df),
    )


def test_dim_establishment(spark):
    establishments, units = gold_inputs(spark)
    dim = gold.dim_establishment(establishments, units)
    assert [(f.name, f.dataType) for f in dim.schema] == [
        (f.name, f.dataType) for f in schemas.DIM_ESTABLISHMENT.schema
    ]
    rows = {r["co_cnes"]: r for r in dim.collect()}
    assert sorted(rows) == ["0000012", "0000013", "0000014"]
    a, b, c = (rows[k] for k in sorted(rows))
    assert (a["sg_uf"], a["ds_uf"], a["is_ubs"], a["is_ativo"]) == ("SP", "São Paulo", True, True)
    assert (a["tp_unidade"], a["ds_tipo_unidade"]) == ("05", "Hospital Geral")
    assert (a["categoria_unidade"], a["grupo_natureza_jur"]) == ("HOSPITALAR", "PUBLICA")
    assert a["geom"].asDict() == {"srid": 4326, "lon": -46.6, "lat": -23.5}
    assert (b["sg_uf"], b["ds_tipo_unidade"], b["is_ubs"], b["is_ativo"]) == (None, None, False, False)
    assert (c["tp_unidade"], c["geom"], c["ds_natureza_juridica"]) == (None, None, None)
    known = gold.dim_establishment(establishments, units, snapshot=DAY, care_unit_snapshot=DAY)
    assert known.drop("_loaded_at").exceptAll(dim.drop("_loaded_at")).count() == 0


def test_two_spellings_of_one_code_abort_the_build(spark):
    raw = establishment_frame(spark, establishment("12"), establishment("0000012"))
    establishments = silver.establishments(raw, DAY, NOW).df
    units = silver.care_units(care_unit_frame(spark, ("1", "", "", "", "", "", "", "")), DAY).df
    dim = gold.dim_establishment(establishments, units)
    with pytest.raises(contracts.ContractViolation, match="duplicate"):
        tables.rebuild(dim, scratch_folder(spark, "dim"), schemas.DIM_ESTABLISHMENT)


def test_dim_municipality(spark):
    establishments, units = gold_inputs(spark)
    beds = silver.beds(
        {
            2020: staged_beds(
                spark,
                [
                    (f"2020{month:02d}", cnes, name, "1", "1", "1")
                    for month, cnes, name in (
                        (1, "0000012", "B"),
                        (2, "0000012", "B"),
                        (3, "0000012", "A"),
                        (4, "0000012", "A"),
                        (5, "0000012", None),
                        (6, "0000012", None),
                        (7, "0000012", None),
                        (8, "12", "Z"),  # unpadded keys do not match
                        (9, "0000013", "C"),
                    )
                ],
                OLD,
            )
        },
        DAY,
    ).df
    dim = gold.dim_municipality(establishments.where("co_cnes <> '13'"), beds, units)
    assert [tuple(r)[:-1] for r in dim.collect()] == [
        ("350010", "0350010", "A", "35", "SP", "São Paulo", 1, 1)
    ]


def test_one_municipality_under_two_states_aborts(spark):
    establishments, units = gold_inputs(spark)
    beds = silver.beds({2020: staged_beds(spark, [], OLD)}, DAY).df
    dim = gold.dim_municipality(establishments, beds, units)
    assert dim.count() == 2
    with pytest.raises(contracts.ContractViolation, match="350010"):
        tables.rebuild(dim, scratch_folder(spark, "dim"), schemas.DIM_MUNICIPALITY)


def test_dim_time(spark):
    dim = gold.dim_time(spark)
    assert dim.count() == 8766
    contracts.require_unique(dim, schemas.DIM_TIME)
    rows = {r["data"]: r for r in dim.where("data IN ('2021-01-03', '2020-02-29')").collect()}
    sunday, leap = rows[date(2021, 1, 3)], rows[date(2020, 2, 29)]
    assert tuple(sunday)[1:16] == (
        2021, 1, 3, 1, 1, "202101", "2021-01", "January", "Jan", 7, "Sunday", True, 53, 3, True,
    )
    assert (leap["dia_do_ano"], leap["eh_periodo_covid"], leap["nome_dia_semana"]) == (60, False, "Saturday")


def fact_inputs(spark):
    beds = silver.beds(
        {
            2021: staged_beds(
                spark,
                [
                    (f"2021{m:02d}", "0000012", "A", "10", "1" if m == 8 else "0", "10")
                    for m in range(1, 9)
                ]
                + [("202101", "0000013", "A", "4", "4", "0")],
                OLD,
            )
        },
        DAY,
    ).df
    use = silver.occupancy(
        {
            2021: occupancy_frame(
                spark,
                [
                    notification(
                        _id="1",
                        ocupacaoCovidUti="11",
                        saidaConfirmadaObitos="1",
                        saidaConfirmadaAltas="2",
                    ),
                    notification(_id="2", ocupacaoCovidUti="5"),
                    notification(_id="3", ocupacaoCovidUti="99", excluido="True"),
                    notification(_id="4", cnes="13", ocupacaoCovidUti="5", excluido="False"),
                    notification(_id="5", cnes="14", ocupacaoCovidUti="5"),
                    notification(_id="6", dataNotificacao="2023-01-01T00:00:00Z"),
                ],
            )
        },
        DAY,
    ).df
    return beds, use


def test_facts_and_ranking(spark):
    beds, use = fact_inputs(spark)
    capacity = gold.fact_beds(beds)
    row = capacity.where("co_cnes = '0000012'").first()
    assert (row["qtd_competencias"], row["leitos_sus_sum"]) == (8, 1)
    assert (row["leitos_sus_avg"], row["leitos_existentes_avg"]) == (Decimal("0.13"), Decimal("10.00"))
    monthly = gold.fact_occupancy(use)
    row = monthly.where("co_cnes = '0000012' AND ano_mes = '202101'").first()
    assert (row["qtd_notificacoes"], row["ocupacao_uti_covid_sum"]) == (2, 16)
    assert (row["ocupacao_uti_covid_avg"], row["ocupacao_uti_covid_max"]) == (Decimal("8.00"), 11)
    pressure = gold.fact_pressure(monthly, capacity)
    rows = {r["co_cnes"]: r for r in pressure.collect()}
    assert sorted(rows) == ["0000012", "0000013"]  # 14 has no beds, 2023 is out of range
    over, idle = rows["0000012"], rows["0000013"]
    assert (over["taxa_ocupacao_uti_covid"], over["is_overloaded"]) == (Decimal("1.1000"), True)
    assert over["taxa_letalidade"] == Decimal("0.3333")
    assert (idle["taxa_ocupacao_uti_covid"], idle["is_overloaded"], idle["taxa_letalidade"]) == (
        None, False, None,
    )
    establishments, units = gold_inputs(spark)
    dim = gold.dim_establishment(establishments, units)
    ranking = dashboard.overload_ranking(dim, pressure).collect()
    assert [(r["sg_uf"], r["ano_mes"], r["pico_uti_covid_mes"]) for r in ranking] == [("SP", "202101", 11)]
    for fact, spec in (
        (capacity, schemas.FACT_BEDS),
        (monthly, schemas.FACT_OCCUPANCY),
        (pressure, schemas.FACT_PRESSURE),
    ):
        contracts.require_unique(fact, spec)
        contracts.check_schema(fact, spec)


def test_month_and_year_agree_at_the_year_boundary(spark):
    _, use = fact_inputs(spark)
    keys = gold.fact_occupancy(use).select("ano_mes", "ano_referencia").distinct().collect()
    assert all(int(r["ano_mes"][:4]) == r["ano_referencia"] for r in keys)


def test_latest_per_year_keeps_the_history(spark):
    beds, _ = fact_inputs(spark)
    newer = staged_beds(spark, [("202201", "0000012", "A", "7", "7", "7")], OLD)
    second = silver.beds({2022: newer}, date(2026, 6, 17)).df
    both = beds.unionByName(second)
    assert {r["ano_referencia"] for r in gold.fact_beds(both).collect()} == {2022}
    kept = gold.fact_beds(both, latest_per_year=True).collect()
    assert {(r["ano_referencia"], r["_extraction_date"].day) for r in kept} == {(2021, 10), (2022, 17)}


def test_kpis_and_rankings(spark):
    beds, _ = fact_inputs(spark)
    establishments, units = gold_inputs(spark)
    dim, fact = gold.dim_establishment(establishments, units), gold.fact_beds(beds)
    assert dashboard.latest_year(fact).first()["ano"] == 2021
    card = dashboard.kpis(dim, fact).first()
    assert card.asDict() == {
        "ano": 2021, "estab_ativos": 2, "total_ubs": 1, "hospitais": 1, "leitos_sus": 4,
    }
    empty = dashboard.kpis(dim, fact.where("false")).first()
    assert (empty["ano"], empty["leitos_sus"]) == (datetime.now().year, 0)
    states = dashboard.top_states(dim, fact, 2021).collect()
    assert [(r["sg_uf"], r["leitos_sus"], r["hospitais"]) for r in states] == [("SP", 0, 1)]
    assert dashboard.top_states(dim, fact, 1999).count() == 0
    top = dashboard.top_hospitals(dim, fact, 2021, limit=1).collect()
    assert [(r["co_cnes"], r["uti_total_max"]) for r in top] == [("0000012", 10)]


def test_vaccination(spark, tmp_path):
    root = scratch_folder(spark, "vaccination")
    (tmp_path / "page_0000.json").write_text('[{"codigo_documento": "b", "dose": 1}]')
    (tmp_path / "page_0001.json").write_text('[{"codigo_documento": "a", "sg_vacina": "X"}]')
    from lamina.operators.manifest import MANIFEST_SCHEMA

    nothing = spark.createDataFrame([], MANIFEST_SCHEMA)
    record = bronze.ingest_vaccination(spark, str(tmp_path), nothing, root, "pni", DAY, NOW)
    df = spark.read.parquet(record.first()["parquet_path"])
    found = df.orderBy("codigo_documento").select("codigo_documento", "dose", "sg_vacina", "_source_file")
    assert [tuple(r) for r in found.collect()] == [("a", None, "X", "pni"), ("b", "1", None, "pni")]
    # The same records on other pages are the same payload.
    (tmp_path / "page_0001.json").write_text(
        '[{"codigo_documento": "a", "sg_vacina": "X"}, {"codigo_documento": "b"}]'
    )
    (tmp_path / "page_0000.json").write_text("[]")
    assert bronze.ingest_vaccination(spark, str(tmp_path), record, root, "pni", DAY, NOW) is None
    with pytest.raises(FileNotFoundError):
        bronze.vaccination_pages(spark, f"{tmp_path}/none")


def test_api_pages_to_staging(spark, tmp_path):
    from lamina.operators.manifest import MANIFEST_SCHEMA

    answers = [["a", "b"], [], ["c"], [], [], [], ["late"]]
    for number, codes in enumerate(answers):
        records = ", ".join(f'{{"codigo_documento": "{c}", "n": {number}}}' for c in codes)
        (tmp_path / f"answer_{number:04d}.json").write_text(f'{{"ok": true, "doses": [{records}]}}')
    root = scratch_folder(spark, "api")
    landed = bronze.land_api_pages(spark, f"{tmp_path}/answer_*.json", f"{root}/raw")
    nothing = spark.createDataFrame([], MANIFEST_SCHEMA)
    # JSON lines as text files
    rows = spark.read.option("primitivesAsString", True).json(landed)
    assert sorted(tuple(r) for r in rows.collect()) == [("a", "0"), ("b", "0"), ("c", "2")]
    record = bronze.ingest_vaccination(
        spark, landed, nothing, f"{root}/staged", "pni", DAY, NOW, whole_file=False
    )
    assert spark.read.parquet(record.first()["parquet_path"]).count() == 3


def test_incremental_ingest_keeps_unchanged_years(spark, tmp_path):
    from lamina.operators import manifest
    from lamina.sources.staged import read_years_of_manifest

    root = scratch_folder(spark, "ingest")

    def listing(**versions):
        rows = []
        for name, (tag, text) in versions.items():
            year = int(name[1:])
            path = tmp_path / f"Leitos_{year}_{tag}.csv"
            path.write_text(text, encoding="ISO-8859-1")
            rows.append(("leitos", year, "remote", tag, None, None, f"{year}{tag}", str(path), True))
        return spark.createDataFrame(rows, manifest.LISTING_SCHEMA)

    def csv(separator, *rows):
        columns = bed_columns(["COMP", "CNES", "MUNICIPIO"])
        lines = [separator.join([*row, *[""] * (len(columns) - len(row))]) for row in rows]
        return "\n".join([separator.join(columns), *lines]) + "\n"

    sao_paulo = csv(",", ("202001", "0000001", "São Paulo"))
    first = listing(
        y2020=("v1", sao_paulo),
        y2021=("v1", csv(";", ("202101", "0000001"))),
        y2022=("v1", "OUTRA|COISA\n1|2\n"),
    )
    table = spark.createDataFrame([], manifest.MANIFEST_SCHEMA)
    records = bronze.ingest_csv(spark, sources.BEDS_CSV, first, table, root, DAY, NOW)
    table = spark.createDataFrame(records.collect(), manifest.MANIFEST_SCHEMA)
    assert table.count() == 3

    later = date(2026, 6, 17)
    second = listing(
        y2020=("v1", sao_paulo),
        y2021=("v2", csv(";", ("202101", "0000001"), ("202102", "0000001"))),
        y2022=("v1", "OUTRA|COISA\n1|2\n"),
    )
    records = bronze.ingest_csv(spark, sources.BEDS_CSV, second, table, root, later, NOW)
    changed = records.collect()
    assert [(r["year"], r["extraction_date"]) for r in changed] == [(2021, later)]
    table = table.unionByName(spark.createDataFrame(changed, manifest.MANIFEST_SCHEMA))

    years = read_years_of_manifest(spark, manifest.current(table), "COMP")
    assert (sorted(years.frames), years.skipped_years) == ([2020, 2021], [2022])
    made = silver.beds(years.frames, later).df
    assert made.groupBy("ano_referencia").count().orderBy("ano_referencia").collect() == [
        (2020, 1), (2021, 2),
    ]
    assert made.where(F.col("ano_referencia") == 2020).first()["municipio"] == "São Paulo"
