"""Calendar columns and the daily date series."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

# Default span of the date dimension and the notification period.
FIRST_DAY = date(2007, 1, 1)
LAST_DAY = date(2030, 12, 31)
COVID_PERIOD = (date(2020, 3, 1), date(2022, 12, 31))


def month_key(moment: str) -> str:
    """``yyyyMM`` of a timestamp (session time zone, which is UTC) or date."""
    return f"date_format({moment}, 'yyyyMM')"


def days_between(first: str, last: str) -> str:
    """Every day from ``first`` to ``last``, both included, as rows."""
    return f"explode(sequence({first}, {last}, INTERVAL 1 DAY))"


def date_series(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """One row per day in column ``data``."""
    return spark.range(1).selectExpr(
        f"{days_between(f'DATE {first.isoformat()!r}', f'DATE {last.isoformat()!r}')} AS data"
    )


def calendar_attributes(day: str) -> dict[str, str]:
    """The attributes of a day, named as in the date dimension."""
    weekday = f"extract(DAYOFWEEK_ISO FROM {day})"
    low, high = COVID_PERIOD
    return {
        "ano": f"year({day})",
        "mes": f"month({day})",
        "dia": f"dayofmonth({day})",
        "trimestre": f"quarter({day})",
        "semestre": f"if(quarter({day}) <= 2, 1, 2)",
        "ano_mes": month_key(day),
        "ano_mes_label": f"date_format({day}, 'yyyy-MM')",
        "nome_mes": f"date_format({day}, 'MMMM')",
        "nome_mes_abrev": f"date_format({day}, 'MMM')",
        "dia_semana": f"cast({weekday} AS int)",
        "nome_dia_semana": f"date_format({day}, 'EEEE')",
        "eh_fim_de_semana": f"({weekday} >= 6)",
        "semana_iso": f"weekofyear({day})",
        "dia_do_ano": f"dayofyear({day})",
        "eh_periodo_covid": f"({day} BETWEEN DATE '{low}' AND DATE '{high}')",
    }
