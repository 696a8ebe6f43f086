"""Silver and Gold over the derived datasets, and the dashboard queries on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.catalogue.inputs import (
    BEDS_SQL,
    CARE_UNITS_SQL,
    ESTABLISHMENTS_SQL,
    EXTRACTED,
    INGESTED,
    OCCUPANCY_SQL,
    SHIFT,
    raw_beds,
    raw_care_units,
    raw_establishments,
    raw_occupancy,
    table,
)
from lamina.plans import dashboard, gold, silver
from lamina.plans.domains import LEGAL_NATURE_ROWS, STATES, UNIT_TYPE_ROWS

QUERIES = {}
SQL = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def comparable(df: DataFrame, *dropped: str) -> DataFrame:
    """Without load times; decimals as doubles, dates and times as text."""
    hidden = {"_loaded_at", "_ingested_at", "_cleansed_at", "_source_hash", *dropped}
    columns = []
    for f in df.schema.fields:
        if f.name in hidden:
            continue
        if isinstance(f.dataType, T.DecimalType):
            columns.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            columns.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            columns.append(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def _establishments(spark: SparkSession, folder: str) -> DataFrame:
    return silver.establishments(raw_establishments(spark, folder), EXTRACTED, INGESTED).df


def _care_units(spark: SparkSession, folder: str) -> DataFrame:
    return silver.care_units(raw_care_units(spark, folder), EXTRACTED, cleansed_at=INGESTED).df


def _beds(spark: SparkSession, folder: str) -> DataFrame:
    return silver.beds(raw_beds(spark, folder), EXTRACTED, cleansed_at=INGESTED).df


def _occupancy(spark: SparkSession, folder: str) -> DataFrame:
    return silver.occupancy(raw_occupancy(spark, folder), EXTRACTED, cleansed_at=INGESTED).df


def _dim(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_establishment(
        _establishments(spark, folder),
        _care_units(spark, folder),
        snapshot=EXTRACTED,
        care_unit_snapshot=EXTRACTED,
    )


def _beds_fact(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fact_beds(_beds(spark, folder), snapshot=EXTRACTED)


def _occupancy_fact(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fact_occupancy(_occupancy(spark, folder), snapshot=EXTRACTED)


def _pressure_fact(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fact_pressure(_occupancy_fact(spark, folder), _beds_fact(spark, folder))


@_query
def silver_establishments(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_establishments(spark, folder)).select(
        "co_cnes",
        "co_uf",
        "co_ibge",
        "no_fantasia",
        "no_razao_social",
        "tp_gestao",
        "tp_unidade",
        "co_natureza_jur",
        "co_motivo_desab",
        "nu_latitude",
        "nu_longitude",
        "st_atend_hospitalar",
        "_source_file",
        "_extraction_date",
    )


SQL["silver_establishments"] = f"""
WITH {ESTABLISHMENTS_SQL}
SELECT *, 'estabelecimentos.csv' AS _source_file, '2026-06-10' AS _extraction_date
FROM establishments"""


@_query
def silver_care_units(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_care_units(spark, folder))


SQL["silver_care_units"] = f"""
WITH {CARE_UNITS_SQL}
SELECT *, NULL::VARCHAR AS no_logradouro, 'ubs.csv' AS _source_file,
       '2026-06-10' AS _extraction_date
FROM care_units"""

_SILVER_BED_COLUMNS = (
    "ano_referencia",
    "comp",
    "cnes",
    "municipio",
    "regiao",
    "leitos_existentes",
    "leitos_sus",
    "uti_total_exist",
    "uti_total_sus",
    "uti_coronariana_sus",
    "_extraction_date",
)


@_query
def silver_beds(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_beds(spark, folder)).select(*_SILVER_BED_COLUMNS)


SQL["silver_beds"] = f"""
WITH {BEDS_SQL}
SELECT ano_referencia, comp, cnes, municipio, NULL::VARCHAR AS regiao,
       leitos_existentes::INTEGER AS leitos_existentes, leitos_sus::INTEGER AS leitos_sus,
       uti_total_exist::INTEGER AS uti_total_exist, uti_total_sus::INTEGER AS uti_total_sus,
       0::INTEGER AS uti_coronariana_sus, '2026-06-10' AS _extraction_date
FROM beds"""


@_query
def silver_occupancy(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_occupancy(spark, folder)).select(
        "id_registro",
        "cnes",
        "data_notificacao",
        "ano_referencia",
        "ocupacao_covid_uti",
        "ocupacao_covid_cli",
        "ocupacao_hospitalar_uti",
        "ocupacao_hospitalar_cli",
        "saida_confirmada_obitos",
        "saida_confirmada_altas",
        "saida_suspeita_obitos",
        "origem",
        "excluido",
    )


SQL["silver_occupancy"] = f"""
WITH {OCCUPANCY_SQL}
SELECT id_registro, cnes, strftime(data_notificacao, '%Y-%m-%d %H:%M:%S') AS data_notificacao,
       ano_referencia, ocupacao_covid_uti::INTEGER AS ocupacao_covid_uti,
       ocupacao_covid_cli::INTEGER AS ocupacao_covid_cli,
       ocupacao_hospitalar_uti::INTEGER AS ocupacao_hospitalar_uti,
       ocupacao_hospitalar_cli::INTEGER AS ocupacao_hospitalar_cli,
       saida_confirmada_obitos::INTEGER AS saida_confirmada_obitos,
       saida_confirmada_altas::INTEGER AS saida_confirmada_altas,
       0::INTEGER AS saida_suspeita_obitos, origem, excluido
FROM occupancy"""


def _values(name: str, columns: str, rows: tuple) -> str:
    quoted = (
        "(" + ", ".join("'" + cell.replace("'", "''") + "'" for cell in row) + ")" for row in rows
    )
    return f"{name}({columns}) AS (VALUES {', '.join(quoted)})"


_STATES_SQL = _values("states", "co_uf, sg_uf, ds_uf", STATES)
_TYPES_SQL = _values("types", "code, ds_tipo_unidade, categoria_unidade", UNIT_TYPE_ROWS)
_NATURES_SQL = _values(
    "natures", "co_natureza_jur, ds_natureza_juridica, grupo_natureza_jur", LEGAL_NATURE_ROWS
)

_DIM_SQL = f"""{ESTABLISHMENTS_SQL}, {CARE_UNITS_SQL}, {_STATES_SQL}, {_TYPES_SQL}, {_NATURES_SQL},
dim AS (
  SELECT lpad(co_cnes, 7, '0') AS co_cnes, no_fantasia, no_razao_social, co_uf, sg_uf, ds_uf,
         e.co_ibge, tp_gestao, lpad(tp_unidade, 2, '0') AS tp_unidade, ds_tipo_unidade,
         categoria_unidade, co_natureza_jur, ds_natureza_juridica, grupo_natureza_jur,
         co_motivo_desab, co_motivo_desab IS NULL AS is_ativo,
         EXISTS (SELECT 1 FROM care_units u WHERE u.cnes = lpad(e.co_cnes, 7, '0')) AS is_ubs,
         nu_latitude, nu_longitude, st_atend_hospitalar
  FROM establishments e LEFT JOIN states USING (co_uf)
       LEFT JOIN types ON code = lpad(tp_unidade, 2, '0')
       LEFT JOIN natures USING (co_natureza_jur)
)"""

_BEDS_FACT_SQL = f"""{BEDS_SQL},
beds_fact AS (
  SELECT cnes AS co_cnes, ano_referencia, count(*)::INTEGER AS qtd_competencias,
         sum(leitos_existentes)::BIGINT AS leitos_existentes_sum,
         sum(leitos_sus)::BIGINT AS leitos_sus_sum,
         sum(uti_total_exist)::BIGINT AS uti_total_sum, sum(uti_total_sus)::BIGINT AS uti_sus_sum,
         ((sum(leitos_existentes) * 200 + count(*)) // (2 * count(*)))::BIGINT AS leitos_cents,
         ((sum(leitos_sus) * 200 + count(*)) // (2 * count(*)))::BIGINT AS leitos_sus_cents,
         ((sum(uti_total_exist) * 200 + count(*)) // (2 * count(*)))::BIGINT AS uti_cents,
         ((sum(uti_total_sus) * 200 + count(*)) // (2 * count(*)))::BIGINT AS uti_sus_cents,
         max(leitos_existentes)::INTEGER AS leitos_existentes_max,
         max(uti_total_exist)::INTEGER AS uti_total_max
  FROM beds GROUP BY 1, 2
)"""

_OCCUPANCY_FACT_SQL = f"""{OCCUPANCY_SQL},
occupancy_fact AS (
  SELECT cnes AS co_cnes, strftime(data_notificacao, '%Y%m') AS ano_mes, ano_referencia,
         count(*)::INTEGER AS qtd_notificacoes,
         sum(ocupacao_covid_uti)::BIGINT AS ocupacao_uti_covid_sum,
         ((sum(ocupacao_covid_uti) * 200 + count(*)) // (2 * count(*))) / 100
           AS ocupacao_uti_covid_avg,
         max(ocupacao_covid_uti)::INTEGER AS ocupacao_uti_covid_max,
         sum(ocupacao_covid_cli)::BIGINT AS ocupacao_cli_covid_sum,
         ((sum(ocupacao_covid_cli) * 200 + count(*)) // (2 * count(*))) / 100
           AS ocupacao_cli_covid_avg,
         max(ocupacao_covid_cli)::INTEGER AS ocupacao_cli_covid_max,
         max(ocupacao_hospitalar_uti)::INTEGER AS ocupacao_uti_hosp_max,
         max(ocupacao_hospitalar_cli)::INTEGER AS ocupacao_cli_hosp_max,
         sum(saida_confirmada_obitos)::BIGINT AS obitos_confirmados_sum,
         sum(saida_confirmada_altas)::BIGINT AS altas_confirmadas_sum,
         0::BIGINT AS obitos_suspeitos_sum, 0::BIGINT AS altas_suspeitas_sum
  FROM occupancy WHERE excluido IS NOT TRUE GROUP BY 1, 2, 3
)"""

_PRESSURE_SQL = f"""{_BEDS_FACT_SQL}, {_OCCUPANCY_FACT_SQL},
pressure AS (
  SELECT o.co_cnes, o.ano_mes, o.ano_referencia, b.uti_total_max AS capacidade_uti_declarada,
         b.leitos_existentes_max AS leitos_total_declarado,
         o.ocupacao_uti_covid_max AS pico_uti_covid_mes,
         o.ocupacao_cli_covid_max AS pico_cli_covid_mes,
         o.ocupacao_uti_hosp_max AS pico_uti_total_mes, o.qtd_notificacoes,
         CASE WHEN uti_total_max > 0 THEN
           ((ocupacao_uti_covid_max::BIGINT * 20000 + uti_total_max) // (2 * uti_total_max)) / 10000
           END AS taxa_ocupacao_uti_covid,
         uti_total_max > 0 AND ocupacao_uti_covid_max > uti_total_max AS is_overloaded,
         obitos_confirmados_sum AS obitos_confirmados, altas_confirmadas_sum AS altas_confirmadas,
         CASE WHEN obitos_confirmados_sum + altas_confirmadas_sum > 0 THEN
           ((obitos_confirmados_sum * 20000 + (obitos_confirmados_sum + altas_confirmadas_sum))
            // (2 * (obitos_confirmados_sum + altas_confirmadas_sum))) / 10000
           END AS taxa_letalidade
  FROM occupancy_fact o JOIN beds_fact b USING (co_cnes, ano_referencia)
  WHERE o.ano_referencia BETWEEN 2020 AND 2022
)"""


@_query
def yearly_fact(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_beds_fact(spark, folder))


SQL["yearly_fact"] = f"""
WITH {_BEDS_FACT_SQL}
SELECT * EXCLUDE (leitos_cents, leitos_sus_cents, uti_cents, uti_sus_cents),
       leitos_cents / 100 AS leitos_existentes_avg, leitos_sus_cents / 100 AS leitos_sus_avg,
       uti_cents / 100 AS uti_total_avg, uti_sus_cents / 100 AS uti_sus_avg,
       '2026-06-10' AS _extraction_date
FROM beds_fact"""


@_query
def monthly_fact(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_occupancy_fact(spark, folder))


SQL["monthly_fact"] = f"""
WITH {_OCCUPANCY_FACT_SQL} SELECT *, '2026-06-10' AS _extraction_date FROM occupancy_fact"""


@_query
def pressure_fact(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_pressure_fact(spark, folder))


SQL["pressure_fact"] = f"WITH {_PRESSURE_SQL} SELECT * FROM pressure"


@_query
def calendar_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Shipments by half-year and weekend through the date dimension.

    The rows are summed per day first; the dimension has a fixed size and is
    broadcast.
    """
    daily = (
        table(spark, folder, "lineitem")
        .groupBy(F.expr(f"to_date(l_shipdate + {SHIFT}) AS data"))
        .agg(F.expr("count(*) AS n"), F.expr("sum(cast(l_quantity AS bigint)) AS quantity"))
    )
    return (
        daily.join(F.broadcast(gold.dim_time(spark)), "data")
        .groupBy("ano", "semestre", "eh_fim_de_semana", "eh_periodo_covid")
        .agg(F.expr("sum(n) AS n"), F.expr("sum(quantity) AS quantity"))
    )


SQL["calendar_rollup"] = """
SELECT year(d)::INTEGER AS ano, CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS semestre,
       isodow(d) >= 6 AS eh_fim_de_semana,
       d BETWEEN DATE '2020-03-01' AND DATE '2022-12-31' AS eh_periodo_covid,
       count(*) AS n, sum(l_quantity::BIGINT)::BIGINT AS quantity
FROM (SELECT (l_shipdate + INTERVAL 25 YEAR)::DATE AS d, l_quantity FROM lineitem)
GROUP BY 1, 2, 3, 4"""


@_query
def dim_decode(spark: SparkSession, folder: str) -> DataFrame:
    dim = comparable(_dim(spark, folder), "co_cep", "st_centro_cirurgico", "st_atend_ambulatorial")
    return dim.withColumn("has_point", F.col("geom").isNotNull()).drop("geom")


SQL["dim_decode"] = f"""
WITH {_DIM_SQL}
SELECT *, nu_latitude IS NOT NULL AND nu_longitude IS NOT NULL AS has_point,
       '2026-06-10' AS _extraction_date
FROM dim"""


@_query
def municipality_mode(spark: SparkSession, folder: str) -> DataFrame:
    dim = gold.dim_municipality(
        _establishments(spark, folder),
        _beds(spark, folder),
        _care_units(spark, folder),
        snapshot=EXTRACTED,
        bed_snapshot=EXTRACTED,
        care_unit_snapshot=EXTRACTED,
    )
    return comparable(dim)


SQL["municipality_mode"] = f"""
WITH {ESTABLISHMENTS_SQL}, {CARE_UNITS_SQL}, {BEDS_SQL}, {_STATES_SQL},
votes AS (
  SELECT co_ibge, municipio, row_number() OVER (
           PARTITION BY co_ibge ORDER BY count(*) DESC, municipio) AS position
  FROM establishments e JOIN beds b ON b.cnes = lpad(e.co_cnes, 7, '0')
  WHERE co_ibge IS NOT NULL AND municipio IS NOT NULL GROUP BY 1, 2
)
SELECT e.co_ibge, lpad(e.co_ibge, 7, '0') AS co_ibge_7dig, v.municipio AS no_municipio,
       e.co_uf, sg_uf, ds_uf, count(*)::INTEGER AS qtd_estabelecimentos,
       (SELECT count(*) FROM care_units u WHERE u.co_ibge = e.co_ibge)::INTEGER AS qtd_ubs
FROM establishments e LEFT JOIN states USING (co_uf)
     LEFT JOIN (SELECT co_ibge, municipio FROM votes WHERE position = 1) v
       ON v.co_ibge = e.co_ibge
WHERE e.co_ibge IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6"""


@_query
def kpi_card(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.kpis(_dim(spark, folder), _beds_fact(spark, folder))


SQL["kpi_card"] = f"""
WITH {_DIM_SQL}, {_BEDS_FACT_SQL}
SELECT (SELECT max(ano_referencia) FROM beds_fact)::INTEGER AS ano,
       count(*) FILTER (WHERE is_ativo) AS estab_ativos,
       count(*) FILTER (WHERE is_ubs) AS total_ubs,
       count(*) FILTER (WHERE st_atend_hospitalar) AS hospitais,
       (SELECT ((sum(leitos_sus_cents) * 2 + 100) // 200)::BIGINT FROM beds_fact
        WHERE ano_referencia = (SELECT max(ano_referencia) FROM beds_fact)) AS leitos_sus
FROM dim"""




@_query
def top_states(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.top_states(_dim(spark, folder), _beds_fact(spark, folder), 2022)


SQL["top_states"] = f"""
WITH {_DIM_SQL}, {_BEDS_FACT_SQL}
SELECT sg_uf, ds_uf, ((sum(leitos_sus_cents) * 2 + 100) // 200)::BIGINT AS leitos_sus,
       ((sum(uti_sus_cents) * 2 + 100) // 200)::BIGINT AS uti_sus,
       count(DISTINCT co_cnes) AS hospitais
FROM beds_fact JOIN dim USING (co_cnes)
WHERE ano_referencia = 2022 AND sg_uf IS NOT NULL
GROUP BY 1, 2 ORDER BY leitos_sus DESC, sg_uf LIMIT 10"""


@_query
def top_hospitals(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.top_hospitals(_dim(spark, folder), _beds_fact(spark, folder), 2022)


SQL["top_hospitals"] = f"""
WITH {_DIM_SQL}, {_BEDS_FACT_SQL}
SELECT co_cnes, no_fantasia, sg_uf, uti_total_max, leitos_existentes_max
FROM beds_fact JOIN dim USING (co_cnes)
WHERE ano_referencia = 2022 ORDER BY uti_total_max DESC, co_cnes LIMIT 8"""


@_query
def overload_ranking(spark: SparkSession, folder: str) -> DataFrame:
    ranking = dashboard.overload_ranking(_dim(spark, folder), _pressure_fact(spark, folder))
    return comparable(ranking)


SQL["overload_ranking"] = f"""
WITH {_DIM_SQL}, {_PRESSURE_SQL}
SELECT no_fantasia, sg_uf, ano_mes, capacidade_uti_declarada, pico_uti_covid_mes,
       taxa_ocupacao_uti_covid, taxa_letalidade
FROM pressure JOIN dim USING (co_cnes) WHERE is_overloaded"""
