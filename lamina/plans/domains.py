"""Literal code tables. Their size is fixed, so they are always broadcast."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.columns import columns
from lamina.plans.schemas import LEGAL_NATURES, UNIT_TYPES

# Federal units (IBGE code, abbreviation, name).
STATES = (
    ("11", "RO", "Rondônia"),
    ("12", "AC", "Acre"),
    ("13", "AM", "Amazonas"),
    ("14", "RR", "Roraima"),
    ("15", "PA", "Pará"),
    ("16", "AP", "Amapá"),
    ("17", "TO", "Tocantins"),
    ("21", "MA", "Maranhão"),
    ("22", "PI", "Piauí"),
    ("23", "CE", "Ceará"),
    ("24", "RN", "Rio Grande do Norte"),
    ("25", "PB", "Paraíba"),
    ("26", "PE", "Pernambuco"),
    ("27", "AL", "Alagoas"),
    ("28", "SE", "Sergipe"),
    ("29", "BA", "Bahia"),
    ("31", "MG", "Minas Gerais"),
    ("32", "ES", "Espírito Santo"),
    ("33", "RJ", "Rio de Janeiro"),
    ("35", "SP", "São Paulo"),
    ("41", "PR", "Paraná"),
    ("42", "SC", "Santa Catarina"),
    ("43", "RS", "Rio Grande do Sul"),
    ("50", "MS", "Mato Grosso do Sul"),
    ("51", "MT", "Mato Grosso"),
    ("52", "GO", "Goiás"),
    ("53", "DF", "Distrito Federal"),
)

# Unit types (code, description, category).
UNIT_TYPE_ROWS = (
    ("01", "Posto de Saúde", "ATENCAO_BASICA"),
    ("02", "Centro de Saúde / Unidade Básica", "ATENCAO_BASICA"),
    ("04", "Policlínica", "AMBULATORIAL"),
    ("05", "Hospital Geral", "HOSPITALAR"),
    ("07", "Hospital Especializado", "HOSPITALAR"),
    ("09", "Pronto Socorro Geral", "HOSPITALAR"),
    ("12", "Maternidade", "HOSPITALAR"),
    ("15", "Unidade Mista", "HOSPITALAR"),
    ("20", "Pronto Socorro Especializado", "HOSPITALAR"),
    ("22", "Consultório Isolado", "AMBULATORIAL"),
    ("36", "Clínica / Centro de Especialidade", "AMBULATORIAL"),
    ("39", "Unidade de Apoio Diagnose e Terapia (SADT Isolado)", "APOIO"),
    ("40", "Unidade Móvel Terrestre", "APOIO"),
    ("42", "Unidade Móvel de Nível Pré-Hospitalar (Urgência)", "APOIO"),
    ("43", "Farmácia", "APOIO"),
    ("50", "Unidade de Vigilância em Saúde", "APOIO"),
    ("60", "Cooperativa ou Empresa de Cessão de Trabalhadores", "OUTROS"),
    ("61", "Centro de Parto Normal - Isolado", "HOSPITALAR"),
    ("62", "Hospital/Dia - Isolado", "HOSPITALAR"),
    ("67", "Laboratório Central de Saúde Pública (LACEN)", "APOIO"),
    ("68", "Central de Gestão em Saúde", "GESTAO"),
    ("69", "Centro de Atenção Hemoterápica e/ou Hematológica", "APOIO"),
    ("70", "Centro de Atenção Psicossocial (CAPS)", "ATENCAO_BASICA"),
    ("71", "Centro de Apoio à Saúde da Família", "ATENCAO_BASICA"),
    ("72", "Unidade de Atenção à Saúde Indígena", "ATENCAO_BASICA"),
    ("73", "Pronto Atendimento (UPA)", "HOSPITALAR"),
    ("74", "Polo Academia da Saúde", "ATENCAO_BASICA"),
    ("75", "Telessaúde", "APOIO"),
    ("76", "Central de Regulação Médica das Urgências", "GESTAO"),
    ("77", "Serviço de Atenção Domiciliar Isolado", "AMBULATORIAL"),
    ("78", "Unidade de Atenção em Regime Residencial", "HOSPITALAR"),
    ("79", "Oficina Ortopédica", "APOIO"),
    ("80", "Laboratório de Saúde Pública", "APOIO"),
    ("81", "Central de Regulação do Acesso", "GESTAO"),
    ("82", "Central de Notificação, Captação e Distribuição de Órgãos", "GESTAO"),
    ("83", "Polo de Prevenção de Doenças e Promoção da Saúde", "ATENCAO_BASICA"),
    ("84", "Central de Abastecimento", "APOIO"),
    ("85", "Centro de Imunização", "ATENCAO_BASICA"),
)

# Legal natures (code, description, group).
LEGAL_NATURE_ROWS = (
    ("1000", "Administração Pública", "PUBLICA"),
    ("1015", "Órgão Público do Poder Executivo Federal", "PUBLICA"),
    ("1023", "Órgão Público do Poder Executivo Estadual", "PUBLICA"),
    ("1031", "Órgão Público do Poder Executivo Municipal", "PUBLICA"),
    ("1147", "Autarquia Federal", "PUBLICA"),
    ("1155", "Autarquia Estadual", "PUBLICA"),
    ("1163", "Autarquia Municipal", "PUBLICA"),
    ("1201", "Fundação Pública de Direito Público Federal", "PUBLICA"),
    ("1210", "Fundação Pública de Direito Público Estadual", "PUBLICA"),
    ("1228", "Fundação Pública de Direito Público Municipal", "PUBLICA"),
    ("1244", "Município", "PUBLICA"),
    ("2000", "Entidade Empresarial", "PRIVADA"),
    ("2046", "Sociedade Anônima Aberta", "PRIVADA"),
    ("2054", "Sociedade Anônima Fechada", "PRIVADA"),
    ("2062", "Sociedade Empresária Limitada (LTDA)", "PRIVADA"),
    ("2135", "Empresa Individual de Responsabilidade Limitada (EIRELI)", "PRIVADA"),
    ("2143", "Empresa Individual Imobiliária", "PRIVADA"),
    ("2232", "Cooperativa", "PRIVADA"),
    ("2240", "Sociedade Simples Pura", "PRIVADA"),
    ("2305", "Sociedade Simples Limitada", "PRIVADA"),
    ("2313", "Sociedade Simples em Nome Coletivo", "PRIVADA"),
    ("3000", "Entidade Sem Fins Lucrativos", "SEM_FINS_LUCRATIVOS"),
    ("3069", "Associação Privada", "SEM_FINS_LUCRATIVOS"),
    ("3077", "Serviço Social Autônomo", "SEM_FINS_LUCRATIVOS"),
    ("3131", "Organização Religiosa", "SEM_FINS_LUCRATIVOS"),
    ("3204", "Organização Social (OS)", "SEM_FINS_LUCRATIVOS"),
    ("3999", "Outras Entidades Sem Fins Lucrativos", "SEM_FINS_LUCRATIVOS"),
    ("4000", "Pessoa Física (Consultório Isolado)", "PESSOA_FISICA"),
    ("4014", "Microempreendedor Individual (MEI)", "PESSOA_FISICA"),
    ("4090", "Contribuinte Individual", "PESSOA_FISICA"),
    ("4146", "Médico / Profissional Liberal", "PESSOA_FISICA"),
)


STATE_SCHEMA = columns(
    "co_uf string not null, sg_uf string not null, ds_uf string not null"
)


def _literal(spark: SparkSession, rows: tuple, schema: T.StructType) -> DataFrame:
    # An Arrow table becomes a local relation: no Python scan, known size.
    table = pa.table([pa.array(c, pa.string()) for c in zip(*rows)], names=schema.names)
    return F.broadcast(spark.createDataFrame(table, schema))


def states(spark: SparkSession) -> DataFrame:
    return _literal(spark, STATES, STATE_SCHEMA)


def unit_types(spark: SparkSession) -> DataFrame:
    return _literal(spark, UNIT_TYPE_ROWS, UNIT_TYPES.schema)


def legal_natures(spark: SparkSession) -> DataFrame:
    return _literal(spark, LEGAL_NATURE_ROWS, LEGAL_NATURES.schema)
