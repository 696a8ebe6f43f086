"""The five datasets: file formats and header spellings."""

from __future__ import annotations

from dataclasses import dataclass

# Raw header -> Silver column, per dataset.

ESTABLISHMENT_NAMES = {
    "CO_CNES": "co_cnes",
    "CO_UNIDADE": "co_unidade",
    "CO_UF": "co_uf",
    "CO_IBGE": "co_ibge",
    "NU_CNPJ_MANTENEDORA": "nu_cnpj_mantenedora",
    "NO_RAZAO_SOCIAL": "no_razao_social",
    "NO_FANTASIA": "no_fantasia",
    "CO_NATUREZA_ORGANIZACAO": "co_natureza_organizacao",
    "DS_NATUREZA_ORGANIZACAO": "ds_natureza_organizacao",
    "TP_GESTAO": "tp_gestao",
    "CO_NIVEL_HIERARQUIA": "co_nivel_hierarquia",
    "DS_NIVEL_HIERARQUIA": "ds_nivel_hierarquia",
    "CO_ESFERA_ADMINISTRATIVA": "co_esfera_administrativa",
    "DS_ESFERA_ADMINISTRATIVA": "ds_esfera_administrativa",
    "CO_ATIVIDADE": "co_atividade",
    "TP_UNIDADE": "tp_unidade",
    "CO_CEP": "co_cep",
    "NO_LOGRADOURO": "no_logradouro",
    "NU_ENDERECO": "nu_endereco",
    "NO_BAIRRO": "no_bairro",
    "NU_TELEFONE": "nu_telefone",
    "NU_LATITUDE": "nu_latitude",
    "NU_LONGITUDE": "nu_longitude",
    "CO_TURNO_ATENDIMENTO": "co_turno_atendimento",
    "DS_TURNO_ATENDIMENTO": "ds_turno_atendimento",
    "NU_CNPJ": "nu_cnpj",
    "NO_EMAIL": "no_email",
    "CO_NATUREZA_JUR": "co_natureza_jur",
    "ST_CENTRO_CIRURGICO": "st_centro_cirurgico",
    "ST_CENTRO_OBSTETRICO": "st_centro_obstetrico",
    "ST_CENTRO_NEONATAL": "st_centro_neonatal",
    "ST_ATEND_HOSPITALAR": "st_atend_hospitalar",
    "ST_SERVICO_APOIO": "st_servico_apoio",
    "ST_ATEND_AMBULATORIAL": "st_atend_ambulatorial",
    "CO_MOTIVO_DESAB": "co_motivo_desab",
    "CO_AMBULATORIAL_SUS": "co_ambulatorial_sus",
}

CARE_UNIT_NAMES = {
    "CNES": "cnes",
    "UF": "co_uf",
    "IBGE": "co_ibge",
    "NOME": "no_unidade",
    "LOGRADOURO": "no_logradouro",
    "BAIRRO": "no_bairro",
    "LATITUDE": "nu_latitude",
    "LONGITUDE": "nu_longitude",
}

OCCUPANCY_NAMES = {
    "_id": "id_registro",
    "dataNotificacao": "data_notificacao",
    "cnes": "cnes",
    "ocupacaoSuspeitoCli": "ocupacao_suspeito_cli",
    "ocupacaoSuspeitoUti": "ocupacao_suspeito_uti",
    "ocupacaoConfirmadoCli": "ocupacao_confirmado_cli",
    "ocupacaoConfirmadoUti": "ocupacao_confirmado_uti",
    "ocupacaoCovidUti": "ocupacao_covid_uti",
    "ocupacaoCovidCli": "ocupacao_covid_cli",
    "ocupacaoHospitalarUti": "ocupacao_hospitalar_uti",
    "ocupacaoHospitalarCli": "ocupacao_hospitalar_cli",
    "saidaSuspeitaObitos": "saida_suspeita_obitos",
    "saidaSuspeitaAltas": "saida_suspeita_altas",
    "saidaConfirmadaObitos": "saida_confirmada_obitos",
    "saidaConfirmadaAltas": "saida_confirmada_altas",
    "origem": "origem",
    "estadoNotificacao": "estado_notificacao",
    "municipioNotificacao": "municipio_notificacao",
    "estado": "estado",
    "municipio": "municipio",
    "excluido": "excluido",
    "validado": "validado",
    "_created_at": "registro_created_at",
    "_updated_at": "registro_updated_at",
}

# A blank header cell arrives as "" or, through Spark's CSV reader, as "_c0".
OCCUPANCY_JUNK = ("", "_c0", "_p_usuario")

# Bed headers whose Silver name is the same word in lower case.
BED_PLAIN = (
    "COMP",
    "REGIAO",
    "UF",
    "MUNICIPIO",
    "CNES",
    "TP_GESTAO",
    "CO_TIPO_UNIDADE",
    "DS_TIPO_UNIDADE",
    "NATUREZA_JURIDICA",
    "DESC_NATUREZA_JURIDICA",
    "NO_LOGRADOURO",
    "NU_ENDERECO",
    "NO_COMPLEMENTO",
    "NO_BAIRRO",
    "CO_CEP",
    "NU_TELEFONE",
    "NO_EMAIL",
    "MOTIVO_DESABILITACAO",
    "NOME_ESTABELECIMENTO",
    "RAZAO_SOCIAL",
    "LEITOS_EXISTENTES",
    "LEITOS_SUS",
)

# Older spellings that follow no rule.
BED_OLDER = {
    "MOTIVO DESABILITACAO": "motivo_desabilitacao",
    "NOME ESTABELECIMENTO": "nome_estabelecimento",
    "RAZAO SOCIAL": "razao_social",
    "LEITOS EXISTENTE": "leitos_existentes",
    "LEITOS SUS": "leitos_sus",
}

# Intensive-care kinds: "UTI ADULTO - EXIST" until 2022, "UTI_ADULTO_EXIST" since.
BED_ICU_KINDS = ("TOTAL", "ADULTO", "PEDIATRICO", "NEONATAL", "QUEIMADO", "CORONARIANA")

BED_NAMES = {
    **{name: name.lower() for name in BED_PLAIN},
    **BED_OLDER,
    **{
        spelling: f"uti_{kind}_{side}".lower()
        for kind in BED_ICU_KINDS
        for side in ("EXIST", "SUS")
        for spelling in (f"UTI {kind} - {side}", f"UTI_{kind}_{side}")
    },
}


@dataclass(frozen=True)
class CsvDataset:
    """How the files of a dataset are written; ``separator`` None means per file."""

    name: str
    separator: str | None
    encoding: str
    year_prefix: str | None = None


ESTABLISHMENTS_CSV = CsvDataset("estabelecimentos", ";", "ISO-8859-1")
CARE_UNITS_CSV = CsvDataset("ubs", ";", "ISO-8859-1")
BEDS_CSV = CsvDataset("leitos", None, "ISO-8859-1", year_prefix="leitos")
OCCUPANCY_CSV = CsvDataset("covid_ocupacao", ",", "UTF-8", year_prefix="covid_ocupacao")

VACCINATION = "vacinacao"
VACCINATION_CODE = "codigo_documento"
VACCINATION_PAGE_SIZE = 1000
