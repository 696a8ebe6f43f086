"""Raw datasets in the shape of the landed files, derived from the given tables.

The health extracts are not among the given tables, so each raw dataset is
projected out of an analogous one, whole: establishments from ``customer``,
care units from ``supplier``, bed declarations from ``lineitem`` and occupancy
notifications from ``orders``. Every cell is text, with the defects the
cleaning has to deal with; which defect a row gets follows from its values.
Dates move forward 25 years into the period of the facts.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from lamina.operators.shaping import ticked
from lamina.plans.domains import STATES
from lamina.plans.sources import BED_ICU_KINDS, BED_PLAIN, ESTABLISHMENT_NAMES

EXTRACTED = date(2026, 6, 10)
INGESTED = datetime(2026, 6, 10, 12, 0, tzinfo=timezone.utc)
SHIFT_YEARS = 25
SHIFT = f"INTERVAL {SHIFT_YEARS} YEARS"
SPELLING_CHANGE = "1998-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def case(selector: str, choices: dict[str, str], default: str = "NULL") -> str:
    """SQL text that picks an expression by the value of a column."""
    arms = " ".join(f"WHEN {value} THEN {choice}" for value, choice in choices.items())
    return f"CASE {selector} {arms} ELSE {default} END"


def whole(value: str) -> str:
    """The integer part of a number as text."""
    return f"string(cast(floor({value}) AS bigint))"


_LINEAGE = (
    f"TIMESTAMP '{INGESTED.isoformat()}' AS _ingested_at",
    f"'{'0' * 64}' AS _source_hash",
)


def _project(df: DataFrame, cells: dict[str, str], source: str, *order: str) -> DataFrame:
    return df.selectExpr(
        *[f"{text} AS {ticked(name)}" for name, text in cells.items()],
        *_LINEAGE,
        f"'{source}' AS _source_file",
        *order,
    )


def _state_code(nation: str) -> str:
    codes = ", ".join(f"'{code}'" for code, _, _ in STATES)
    return f"element_at(array({codes}), {nation} + 1)"


def _micro(balance: str, scale: int, offset: int) -> str:
    return f"(cast(round({balance} * 100) AS bigint) * {scale} + {offset})"


def _with_comma(micro: str) -> str:
    size = f"abs({micro})"
    return (
        f"concat(if({micro} < 0, '-', ''), string({size} div 1000000), ',',"
        f" lpad(string({size} % 1000000), 6, '0'))"
    )


def raw_establishments(spark: SparkSession, folder: str) -> DataFrame:
    state = _state_code("c_nationkey")
    cells = {
        "CO_CNES": "string(c_custkey)",
        "CO_UF": state,
        "CO_IBGE": case(
            "c_mktsegment",
            {
                "'AUTOMOBILE'": f"concat({state}, '0010')",
                "'BUILDING'": f"concat({state}, '0020')",
                "'FURNITURE'": f"concat({state}, '0030 ')",
                "'MACHINERY'": f"concat(' ', {state}, '0040')",
            },
            "' n/a '",
        ),
        "NO_FANTASIA": r"concat('  ', c_name, '\u00a0')",
        "NO_RAZAO_SOCIAL": "c_mktsegment",
        "TP_GESTAO": case(
            "c_mktsegment",
            {
                "'AUTOMOBILE'": "'M'",
                "'BUILDING'": "'E'",
                "'FURNITURE'": "'D'",
                "'MACHINERY'": "'nulo'",
            },
            "''",
        ),
        "TP_UNIDADE": case(
            "c_mktsegment",
            {
                "'AUTOMOBILE'": "'5'",
                "'BUILDING'": "'05'",
                "'FURNITURE'": "'36'",
                "'MACHINERY'": "'2'",
            },
            "'99'",
        ),
        "CO_NATUREZA_JUR": "CASE WHEN c_nationkey < 6 THEN '1244' WHEN c_nationkey < 12 THEN '2062'"
        " WHEN c_nationkey < 18 THEN '3999' WHEN c_nationkey < 22 THEN '4000' ELSE '9999' END",
        "CO_MOTIVO_DESAB": "if(c_acctbal < 0, '01', '')",
        "NU_LATITUDE": f"concat({_micro('c_acctbal', 45, -36_000_000)}, 'e-6')",
        "NU_LONGITUDE": f"concat({_micro('c_acctbal', 50, -78_000_000)}, 'e-6')",
        "ST_ATEND_HOSPITALAR": "CASE WHEN c_acctbal > 4000 THEN '1.0' WHEN c_acctbal > 1000"
        " THEN '0.0' WHEN c_acctbal > 0 THEN '0.5' ELSE 'x' END",
    }
    everything = {name: cells.get(name, "cast(NULL AS string)") for name in ESTABLISHMENT_NAMES}
    return _project(table(spark, folder, "customer"), everything, "estabelecimentos.csv")


def raw_care_units(spark: SparkSession, folder: str) -> DataFrame:
    state = _state_code("s_nationkey")
    cells = {
        "CNES": "concat(' ', s_suppkey)",
        "UF": state,
        "IBGE": f"concat({state}, if(s_acctbal > 3000, '0010', '0020'))",
        "NOME": "concat(' ', s_name)",
        "LOGRADOURO": "'NULL'",
        "BAIRRO": "'Centro'",
        "LATITUDE": f"concat({_with_comma(_micro('s_acctbal', 45, -36_000_000))}, ' ')",
        "LONGITUDE": _with_comma(_micro("s_acctbal", 50, -78_000_000)),
    }
    return _project(table(spark, folder, "supplier"), cells, "ubs.csv")


BED_NEW_SPELLING = {
    "LEITOS EXISTENTE": "LEITOS_EXISTENTES",
    "LEITOS SUS": "LEITOS_SUS",
    **{
        f"UTI {kind} - {side}": f"UTI_{kind}_{side}"
        for kind in BED_ICU_KINDS
        for side in ("EXIST", "SUS")
    },
}


def raw_beds(spark: SparkSession, folder: str) -> dict[int, DataFrame]:
    """Two staged years in the two header spellings."""
    cells = {
        "COMP": f"string((year(l_shipdate) + {SHIFT_YEARS}) * 100 + month(l_shipdate))",
        "CNES": "lpad(string(l_partkey), 7, '0')",
        "MUNICIPIO": "if(l_returnflag <> 'A' OR l_linestatus <> 'F',"
        " concat(l_returnflag, l_linestatus), NULL)",
        "LEITOS EXISTENTE": whole("l_quantity"),
        "LEITOS SUS": "if(l_tax > 0.05, '13.0', string(l_linenumber))",
        "UTI TOTAL - EXIST": "if(l_discount = 0, '0', string(l_linenumber))",
        "UTI TOTAL - SUS": "if(l_returnflag = 'N', 'x', string(l_linenumber))",
    }
    measured = ("LEITOS_EXISTENTES", "LEITOS_SUS")
    empty = [c for c in BED_PLAIN if c not in cells and c not in measured]
    cells |= {c: "cast(NULL AS string)" for c in empty}
    item = table(spark, folder, "lineitem")
    order = (
        "l_orderkey AS _block_start",
        "l_linenumber * 1000000000000L + l_suppkey AS _row_seq",
    )
    change = f"TIMESTAMP_NTZ '{SPELLING_CHANGE}'"
    older = _project(item.where(f"l_shipdate < {change}"), cells, "leitos.csv", *order)
    newer = _project(item.where(f"l_shipdate >= {change}"), cells, "leitos.csv", *order)
    return {2020: older, 2023: newer.withColumnsRenamed(BED_NEW_SPELLING)}


def raw_occupancy(spark: SparkSession, folder: str) -> dict[int, DataFrame]:
    # Order dates carry no time of day.
    day = f"add_months(to_date(o_orderdate), {12 * SHIFT_YEARS})"
    compact = f"year({day}) * 10000 + month({day}) * 100 + day({day})"
    absent = "cast(NULL AS string)"
    cells = {
        "_c0": "'junk'",
        "_id": f"concat(o_custkey, '-', {compact})",
        "dataNotificacao": "if(o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O',"
        f" string(year({day})), concat({day}, 'T00:00:00.000Z'))",
        "cnes": "concat(o_custkey, ' ')",
        "ocupacaoSuspeitoCli": absent,
        "ocupacaoSuspeitoUti": absent,
        "ocupacaoConfirmadoCli": absent,
        "ocupacaoConfirmadoUti": absent,
        "ocupacaoCovidUti": "if(o_orderstatus = 'F' AND o_orderpriority = '1-URGENT', '-2',"
        f" concat({whole('o_totalprice / 50000')}, '.0'))",
        "ocupacaoCovidCli": f"concat({whole('o_totalprice / 10000')}, '.9')",
        "ocupacaoHospitalarUti": whole("o_totalprice / 20000"),
        "ocupacaoHospitalarCli": "'n/d'",
        "saidaSuspeitaObitos": absent,
        "saidaSuspeitaAltas": absent,
        "saidaConfirmadaObitos": whole("o_totalprice / 100000"),
        "saidaConfirmadaAltas": f"if(o_orderpriority = '1-URGENT', '0', {whole('o_totalprice / 30000')})",
        "origem": r"concat(' ', o_orderpriority, '\t')",
        "_p_usuario": "'junk'",
        "estadoNotificacao": absent,
        "municipioNotificacao": absent,
        "estado": absent,
        "municipio": absent,
        "excluido": case("o_orderstatus", {"'P'": "'True'", "'F'": "'FALSE'"}),
        "validado": absent,
        "_created_at": absent,
        "_updated_at": absent,
    }
    orders = table(spark, folder, "orders")
    order = ("0L AS _block_start", "o_orderkey AS _row_seq")
    change = f"TIMESTAMP_NTZ '{SPELLING_CHANGE}'"
    return {
        year: _project(orders.where(f"o_orderdate {side} {change}"), cells, "covid.csv", *order)
        for year, side in ((2020, "<"), (2023, ">="))
    }


# --- SQL twins of the cleaned datasets -------------------------------------

_STATE_LIST = "[" + ", ".join(f"'{code}'" for code, _, _ in STATES) + "]"

ESTABLISHMENTS_SQL = f"""
establishments AS (
  SELECT c_custkey::VARCHAR AS co_cnes,
         uf AS co_uf,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN uf || '0010' WHEN 'BUILDING' THEN uf || '0020'
              WHEN 'FURNITURE' THEN uf || '0030' WHEN 'MACHINERY' THEN uf || '0040' END AS co_ibge,
         c_name AS no_fantasia,
         c_mktsegment AS no_razao_social,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'M' WHEN 'BUILDING' THEN 'E'
              WHEN 'FURNITURE' THEN 'D' END AS tp_gestao,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '5' WHEN 'BUILDING' THEN '05'
              WHEN 'FURNITURE' THEN '36' WHEN 'MACHINERY' THEN '2' ELSE '99' END AS tp_unidade,
         CASE WHEN c_nationkey < 6 THEN '1244' WHEN c_nationkey < 12 THEN '2062'
              WHEN c_nationkey < 18 THEN '3999' WHEN c_nationkey < 22 THEN '4000'
              ELSE '9999' END AS co_natureza_jur,
         CASE WHEN c_acctbal < 0 THEN '01' END AS co_motivo_desab,
         CASE WHEN lat BETWEEN -35 AND 6 AND abs(lat) >= 1e-6 THEN lat END AS nu_latitude,
         CASE WHEN lon BETWEEN -75 AND -33 THEN lon END AS nu_longitude,
         CASE WHEN c_acctbal > 4000 THEN true WHEN c_acctbal > 0 THEN false END
           AS st_atend_hospitalar
  FROM (SELECT *, {_STATE_LIST}[c_nationkey + 1] AS uf,
               (round(c_acctbal * 100)::BIGINT * 45 - 36000000)::DOUBLE / 1e6 AS lat,
               (round(c_acctbal * 100)::BIGINT * 50 - 78000000)::DOUBLE / 1e6 AS lon
        FROM customer)
)"""

CARE_UNITS_SQL = f"""
care_units AS (
  SELECT lpad(s_suppkey::VARCHAR, 7, '0') AS cnes, uf AS co_uf,
         uf || CASE WHEN s_acctbal > 3000 THEN '0010' ELSE '0020' END AS co_ibge,
         s_name AS no_unidade, 'Centro' AS no_bairro,
         CASE WHEN lat BETWEEN -35 AND 6 AND abs(lat) >= 1e-6 THEN lat END AS nu_latitude,
         CASE WHEN lon BETWEEN -75 AND -33 THEN lon END AS nu_longitude
  FROM (SELECT *, {_STATE_LIST}[s_nationkey + 1] AS uf,
               (round(s_acctbal * 100)::BIGINT * 45 - 36000000)::DOUBLE / 1e6 AS lat,
               (round(s_acctbal * 100)::BIGINT * 50 - 78000000)::DOUBLE / 1e6 AS lon
        FROM supplier)
  WHERE s_suppkey <> 0
)"""

BEDS_SQL = """
beds AS (
  SELECT year(shipped)::INTEGER AS ano_referencia, comp, cnes,
         CASE WHEN l_returnflag <> 'A' OR l_linestatus <> 'F'
              THEN l_returnflag || l_linestatus END AS municipio,
         floor(l_quantity)::BIGINT AS leitos_existentes,
         CASE WHEN l_tax > 0.05 THEN 0 ELSE l_linenumber END::BIGINT AS leitos_sus,
         CASE WHEN l_discount = 0 THEN 0 ELSE l_linenumber END::BIGINT AS uti_total_exist,
         CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_linenumber END::BIGINT AS uti_total_sus
  FROM (SELECT *, l_shipdate + INTERVAL 25 YEAR AS shipped,
               strftime(l_shipdate + INTERVAL 25 YEAR, '%Y%m') AS comp,
               lpad(l_partkey::VARCHAR, 7, '0') AS cnes,
               row_number() OVER (
                 PARTITION BY strftime(l_shipdate + INTERVAL 25 YEAR, '%Y%m'), l_partkey
                 ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) AS position
        FROM lineitem)
  WHERE position = 1
)"""

OCCUPANCY_SQL = """
occupancy AS (
  SELECT id_registro, lpad(o_custkey::VARCHAR, 7, '0') AS cnes, moment AS data_notificacao,
         year(moment)::INTEGER AS ano_referencia,
         CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 0
              ELSE floor(o_totalprice / 50000) END::BIGINT AS ocupacao_covid_uti,
         floor(o_totalprice / 10000)::BIGINT AS ocupacao_covid_cli,
         floor(o_totalprice / 20000)::BIGINT AS ocupacao_hospitalar_uti,
         0::BIGINT AS ocupacao_hospitalar_cli,
         floor(o_totalprice / 100000)::BIGINT AS saida_confirmada_obitos,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 0
              ELSE floor(o_totalprice / 30000) END::BIGINT AS saida_confirmada_altas,
         CASE o_orderstatus WHEN 'P' THEN true WHEN 'F' THEN false END AS excluido,
         o_orderpriority AS origem
  FROM (SELECT *, row_number() OVER (PARTITION BY id_registro ORDER BY o_orderkey DESC) AS position
        FROM (SELECT *, o_orderdate + INTERVAL 25 YEAR AS moment,
                     o_custkey::VARCHAR || '-' ||
                     strftime(o_orderdate + INTERVAL 25 YEAR, '%Y%m%d') AS id_registro
              FROM orders
              WHERE NOT (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O')))
  WHERE position = 1
)"""
