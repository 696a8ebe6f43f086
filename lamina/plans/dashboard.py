"""The dashboard queries over Gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.measures import rounded_total


def latest_year(beds_fact: DataFrame) -> DataFrame:
    """The newest year of the bed fact, or the current year when it is empty."""
    newest = F.max("ano_referencia").cast("int")
    return beds_fact.agg(F.coalesce(newest, F.year(F.current_date())).alias("ano"))


def kpis(dim: DataFrame, beds_fact: DataFrame) -> DataFrame:
    """One row: latest year, active establishments, care units, hospitals, public beds.

    The public beds of every year are summed in one pass and the newest year is
    picked from the totals, so the fact is read once.
    """
    yearly = beds_fact.groupBy("ano_referencia").agg(
        F.expr(rounded_total("leitos_sus_avg")).alias("leitos_sus")
    )
    newest = yearly.agg(
        F.struct(
            F.coalesce(F.max("ano_referencia"), F.year(F.current_date())).alias("ano"),
            F.coalesce(F.max_by("leitos_sus", "ano_referencia"), F.lit(0)).alias("leitos_sus"),
        ).alias("newest")
    )
    return (
        dim.agg(
            F.count_if("is_ativo").alias("estab_ativos"),
            F.count_if("is_ubs").alias("total_ubs"),
            F.count_if("st_atend_hospitalar").alias("hospitais"),
        )
        .withColumn("newest", newest.scalar())
        .select("newest.ano", "estab_ativos", "total_ubs", "hospitais", "newest.leitos_sus")
    )


def top_states(dim: DataFrame, beds_fact: DataFrame, year: int | Column, limit: int = 10) -> DataFrame:
    """States by public beds in one year; ties in the order of the state."""
    return (
        beds_fact.where(F.col("ano_referencia") == year)
        .join(dim.where(F.col("sg_uf").isNotNull()).select("co_cnes", "sg_uf", "ds_uf"), "co_cnes")
        .groupBy("sg_uf", "ds_uf")
        .agg(
            F.expr(rounded_total("leitos_sus_avg")).alias("leitos_sus"),
            F.expr(rounded_total("uti_sus_avg")).alias("uti_sus"),
            F.count_distinct("co_cnes").alias("hospitais"),
        )
        .orderBy(F.desc("leitos_sus"), "sg_uf")
        .limit(limit)
    )


def top_hospitals(
    dim: DataFrame, beds_fact: DataFrame, year: int | Column, limit: int = 8
) -> DataFrame:
    """Hospitals by their intensive-care peak in one year, with their rank."""
    return (
        beds_fact.where(F.col("ano_referencia") == year)
        .select("co_cnes", "uti_total_max", "leitos_existentes_max")
        .join(dim.select("co_cnes", "no_fantasia", "sg_uf"), "co_cnes")
        .select("co_cnes", "no_fantasia", "sg_uf", "uti_total_max", "leitos_existentes_max")
        .orderBy(F.desc("uti_total_max"), "co_cnes")
        .limit(limit)
    )


def overload_ranking(dim: DataFrame, pressure_fact: DataFrame) -> DataFrame:
    """Overloaded establishment-months, highest occupancy ratio first."""
    return (
        pressure_fact.where("is_overloaded")
        .join(dim.select("co_cnes", "no_fantasia", "sg_uf"), "co_cnes")
        .orderBy(F.desc_nulls_first("taxa_ocupacao_uti_covid"), "co_cnes", "ano_mes")
        .select(
            "no_fantasia",
            "sg_uf",
            "ano_mes",
            "capacidade_uti_declarada",
            "pico_uti_covid_mes",
            "taxa_ocupacao_uti_covid",
            "taxa_letalidade",
        )
    )
