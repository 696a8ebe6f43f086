"""Gold: dimensions and facts derived from Silver (and from each other).

Every builder takes the frames it depends on, so the order of the builds is
the order of the calls. ``snapshot`` is the extraction date when it is known
(see :func:`lamina.sources.staged.newest_partition`); otherwise the newest one
is looked up. Row order and ``_loaded_at`` aside, a rebuild gives the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import calendar, cleaning, geo, measures
from lamina.operators.contracts import TableSpec
from lamina.operators.latest import latest_snapshot, latest_snapshot_per
from lamina.operators.shaping import conform, derive
from lamina.plans import domains, schemas

PRESSURE_YEARS = (2020, 2022)


def _finish(df: DataFrame, spec: TableSpec) -> DataFrame:
    return conform(df.withColumn("_loaded_at", F.current_timestamp()), spec.schema)


def dim_establishment(
    establishments: DataFrame,
    care_units: DataFrame,
    *,
    snapshot: date | None = None,
    care_unit_snapshot: date | None = None,
) -> DataFrame:
    """Master dimension with decoded codes, point and activity flags.

    The code tables are literals of a few dozen rows and are broadcast. The
    set of care-unit keys grows with the data: its join is left to adaptive
    execution.
    """
    spark = establishments.sparkSession
    base = derive(
        latest_snapshot(establishments, value=snapshot),
        {
            "co_cnes": cleaning.padded("co_cnes", 7),
            "tp_unidade": cleaning.padded("tp_unidade", 2),
            "is_ativo": "co_motivo_desab IS NULL",
            "geom": geo.point("nu_longitude", "nu_latitude"),
        },
    )
    known_units = (
        latest_snapshot(care_units, value=care_unit_snapshot)
        .selectExpr("cnes AS co_cnes")
        .distinct()
        .withColumn("is_ubs", F.lit(True))
    )
    unit_types = domains.unit_types(spark).selectExpr(
        "co_tp_unidade AS tp_unidade",
        "ds_tp_unidade AS ds_tipo_unidade",
        "categoria AS categoria_unidade",
    )
    natures = domains.legal_natures(spark).selectExpr(
        "co_natureza_jur", "ds_natureza_jur AS ds_natureza_juridica", "grupo AS grupo_natureza_jur"
    )
    decoded = (
        base.join(domains.states(spark), "co_uf", "left")
        .join(unit_types, "tp_unidade", "left")
        .join(natures, "co_natureza_jur", "left")
        .join(known_units, "co_cnes", "left")
        .withColumn("is_ubs", F.coalesce("is_ubs", F.lit(False)))
    )
    return _finish(decoded, schemas.DIM_ESTABLISHMENT)


def dim_time(
    spark: SparkSession,
    first: date = calendar.FIRST_DAY,
    last: date = calendar.LAST_DAY,
) -> DataFrame:
    """One row per day with its calendar attributes."""
    days = calendar.date_series(spark, first, last)
    return _finish(derive(days, calendar.calendar_attributes("data")), schemas.DIM_TIME)


def most_frequent(
    counted: DataFrame, by: str, value: str, count: str, result: str
) -> DataFrame:
    """Most frequent ``value`` per ``by``, the smallest one on a tie.

    Works on rows that are already counted per value, so no group of raw rows
    is gathered; NULL values do not take part.
    """
    totals = (
        counted.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.sum(count).alias("n"))
    )
    rank = F.struct(-F.col("n"), F.col(value))
    return totals.groupBy(by).agg(F.min_by(value, rank).alias(result))


def dim_municipality(
    establishments: DataFrame,
    beds: DataFrame,
    care_units: DataFrame,
    *,
    snapshot: date | None = None,
    bed_snapshot: date | None = None,
    care_unit_snapshot: date | None = None,
) -> DataFrame:
    """Municipalities with their usual name and their establishment counts.

    The name comes from the bed declarations, weighted by declaration. These
    are counted per establishment and name before the join, so the join sees
    one row per pair instead of one per month.
    """
    spark = establishments.sparkSession
    current = latest_snapshot(establishments, value=snapshot).where(F.col("co_ibge").isNotNull())
    counts = current.groupBy("co_ibge", "co_uf").agg(
        F.count(F.lit(1)).alias("qtd_estabelecimentos")
    )
    declared = (
        latest_snapshot(beds, value=bed_snapshot)
        .where(F.col("municipio").isNotNull())
        .groupBy(F.col("cnes").alias("key"), "municipio")
        .agg(F.count(F.lit(1)).alias("declarations"))
    )
    located = current.select("co_ibge", F.lpad("co_cnes", 7, "0").alias("key"))
    names = most_frequent(
        located.join(declared, "key"), "co_ibge", "municipio", "declarations", "no_municipio"
    )
    units = (
        latest_snapshot(care_units, value=care_unit_snapshot)
        .where(F.col("co_ibge").isNotNull())
        .groupBy("co_ibge")
        .agg(F.count(F.lit(1)).alias("qtd_ubs"))
    )
    joined = (
        counts.join(names, "co_ibge", "left")
        .join(domains.states(spark), "co_uf", "left")
        .join(units, "co_ibge", "left")
    )
    described = derive(
        joined,
        {"co_ibge_7dig": cleaning.padded("co_ibge", 7), "qtd_ubs": "coalesce(qtd_ubs, 0)"},
    )
    return _finish(described, schemas.DIM_MUNICIPALITY)


def _with_means(facts: DataFrame, rows: str, totals: Mapping[str, str]) -> DataFrame:
    """Means from the sums of the aggregation, so no average is carried through it."""
    means = {mean: measures.rounded_mean(total, rows) for mean, total in totals.items()}
    return derive(facts, means)


def _sum(name: str, result: str) -> Column:
    return F.expr(f"sum(cast({name} AS bigint)) AS {result}")


def _max(name: str, result: str) -> Column:
    return F.expr(f"max({name}) AS {result}")


def _rows(result: str) -> Column:
    return F.expr(f"count(*) AS {result}")


def fact_beds(
    beds: DataFrame, *, snapshot: date | None = None, latest_per_year: bool = False
) -> DataFrame:
    """Yearly bed capacity per establishment.

    The newest extraction counts as the whole series. With ``latest_per_year``
    each year comes from its own newest extraction, which keeps the history
    when an extraction brought only the years that changed.
    """
    if latest_per_year:
        current = latest_snapshot_per(beds, ["ano_referencia"], few=True)
    else:
        current = latest_snapshot(beds, value=snapshot)
    facts = current.groupBy(F.expr("cnes AS co_cnes"), "ano_referencia").agg(
        _rows("qtd_competencias"),
        _sum("leitos_existentes", "leitos_existentes_sum"),
        _sum("leitos_sus", "leitos_sus_sum"),
        _sum("uti_total_exist", "uti_total_sum"),
        _sum("uti_total_sus", "uti_sus_sum"),
        _max("leitos_existentes", "leitos_existentes_max"),
        _max("uti_total_exist", "uti_total_max"),
        _max("_extraction_date", "_extraction_date"),
    )
    facts = _with_means(
        facts,
        "qtd_competencias",
        {
            "leitos_existentes_avg": "leitos_existentes_sum",
            "leitos_sus_avg": "leitos_sus_sum",
            "uti_total_avg": "uti_total_sum",
            "uti_sus_avg": "uti_sus_sum",
        },
    )
    return _finish(facts, schemas.FACT_BEDS)


def fact_occupancy(
    occupancy: DataFrame, *, snapshot: date | None = None, latest_per_year: bool = False
) -> DataFrame:
    """Monthly occupancy and outcomes per establishment, deleted records left out."""
    if latest_per_year:
        current = latest_snapshot_per(occupancy, ["ano_referencia"], few=True)
    else:
        current = latest_snapshot(occupancy, value=snapshot)
    kept = current.where(cleaning.not_deleted("excluido"))
    month = F.expr(f"{calendar.month_key('data_notificacao')} AS ano_mes")
    facts = kept.groupBy(F.expr("cnes AS co_cnes"), month, "ano_referencia").agg(
        _rows("qtd_notificacoes"),
        _sum("ocupacao_covid_uti", "ocupacao_uti_covid_sum"),
        _max("ocupacao_covid_uti", "ocupacao_uti_covid_max"),
        _sum("ocupacao_covid_cli", "ocupacao_cli_covid_sum"),
        _max("ocupacao_covid_cli", "ocupacao_cli_covid_max"),
        _max("ocupacao_hospitalar_uti", "ocupacao_uti_hosp_max"),
        _max("ocupacao_hospitalar_cli", "ocupacao_cli_hosp_max"),
        _sum("saida_confirmada_obitos", "obitos_confirmados_sum"),
        _sum("saida_confirmada_altas", "altas_confirmadas_sum"),
        _sum("saida_suspeita_obitos", "obitos_suspeitos_sum"),
        _sum("saida_suspeita_altas", "altas_suspeitas_sum"),
        _max("_extraction_date", "_extraction_date"),
    )
    facts = _with_means(
        facts,
        "qtd_notificacoes",
        {
            "ocupacao_uti_covid_avg": "ocupacao_uti_covid_sum",
            "ocupacao_cli_covid_avg": "ocupacao_cli_covid_sum",
        },
    )
    return _finish(facts, schemas.FACT_OCCUPANCY)


def fact_pressure(
    occupancy_fact: DataFrame, beds_fact: DataFrame, years: tuple[int, int] = PRESSURE_YEARS
) -> DataFrame:
    """Monthly use against yearly capacity, with overload and lethality.

    The year range is applied to both sides before the join. Both sides are
    already aggregated to their key, so no join key is hot.
    """
    in_years = F.col("ano_referencia").between(*years)
    capacity = beds_fact.where(in_years).selectExpr(
        "co_cnes",
        "ano_referencia",
        "uti_total_max AS capacidade_uti_declarada",
        "leitos_existentes_max AS leitos_total_declarado",
    )
    use = occupancy_fact.where(in_years).selectExpr(
        "co_cnes",
        "ano_referencia",
        "ano_mes",
        "qtd_notificacoes",
        "ocupacao_uti_covid_max AS pico_uti_covid_mes",
        "ocupacao_cli_covid_max AS pico_cli_covid_mes",
        "ocupacao_uti_hosp_max AS pico_uti_total_mes",
        "obitos_confirmados_sum AS obitos_confirmados",
        "altas_confirmadas_sum AS altas_confirmadas",
    )
    peak, beds = "pico_uti_covid_mes", "capacidade_uti_declarada"
    deaths, discharges = "obitos_confirmados", "altas_confirmadas"
    facts = derive(
        use.join(capacity, ["co_cnes", "ano_referencia"]),
        {
            "taxa_ocupacao_uti_covid": measures.ratio(peak, beds),
            "is_overloaded": measures.exceeds(peak, beds),
            "taxa_letalidade": measures.ratio(deaths, f"({deaths} + {discharges})"),
        },
    )
    return _finish(facts, schemas.FACT_PRESSURE)
