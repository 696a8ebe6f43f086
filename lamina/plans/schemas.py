"""Table contracts. Each table is declared once; order, types, nullability and
checks all follow from its :class:`TableSpec`."""

from __future__ import annotations

from lamina.columns import columns
from lamina.functions.geo import LATITUDE_RANGE, LONGITUDE_RANGE
from lamina.operators.contracts import TableSpec

# Table and column names, types and bounds of the data model.

LINEAGE = """
    _ingested_at timestamp not null, _source_file string not null,
    _source_hash string not null, _extraction_date date not null,
    _cleansed_at timestamp not null
"""
STAGED_LINEAGE = ("_ingested_at", "_source_file", "_source_hash")

BED_MEASURES = (
    "leitos_existentes",
    "leitos_sus",
    "uti_total_exist",
    "uti_total_sus",
    "uti_adulto_exist",
    "uti_adulto_sus",
    "uti_pediatrico_exist",
    "uti_pediatrico_sus",
    "uti_neonatal_exist",
    "uti_neonatal_sus",
    "uti_queimado_exist",
    "uti_queimado_sus",
    "uti_coronariana_exist",
    "uti_coronariana_sus",
)

OCCUPANCY_MEASURES = (
    "ocupacao_suspeito_cli",
    "ocupacao_confirmado_cli",
    "ocupacao_covid_cli",
    "ocupacao_hospitalar_cli",
    "ocupacao_suspeito_uti",
    "ocupacao_confirmado_uti",
    "ocupacao_covid_uti",
    "ocupacao_hospitalar_uti",
    "saida_suspeita_obitos",
    "saida_suspeita_altas",
    "saida_confirmada_obitos",
    "saida_confirmada_altas",
)

ESTABLISHMENT_FLAGS = (
    "st_centro_cirurgico",
    "st_centro_obstetrico",
    "st_centro_neonatal",
    "st_atend_hospitalar",
    "st_servico_apoio",
    "st_atend_ambulatorial",
)


def _not_null_int(names: tuple[str, ...]) -> str:
    return ", ".join(f"{n} int not null" for n in names)


_COORDINATES = {"nu_latitude": LATITUDE_RANGE, "nu_longitude": LONGITUDE_RANGE}

ESTABLISHMENTS = TableSpec(
    name="silver.estabelecimentos",
    schema=columns(
        f"""
        co_cnes string not null, co_unidade string, co_uf string, co_ibge string,
        nu_cnpj_mantenedora string, no_razao_social string, no_fantasia string,
        co_natureza_organizacao string, ds_natureza_organizacao string, tp_gestao string,
        co_nivel_hierarquia string, ds_nivel_hierarquia string,
        co_esfera_administrativa string, ds_esfera_administrativa string,
        co_atividade string, tp_unidade string, co_cep string, no_logradouro string,
        nu_endereco string, no_bairro string, nu_telefone string,
        nu_latitude double, nu_longitude double,
        co_turno_atendimento string, ds_turno_atendimento string, nu_cnpj string,
        no_email string, co_natureza_jur string,
        st_centro_cirurgico boolean, st_centro_obstetrico boolean,
        st_centro_neonatal boolean, st_atend_hospitalar boolean,
        st_servico_apoio boolean, st_atend_ambulatorial boolean,
        co_motivo_desab string, co_ambulatorial_sus string, {LINEAGE}
        """
    ),
    key=("_extraction_date", "co_cnes"),
    ranges=_COORDINATES,
    partition="_extraction_date",
)

BEDS = TableSpec(
    name="silver.leitos_anual",
    schema=columns(
        f"""
        ano_referencia int not null, comp string not null, cnes string not null,
        nome_estabelecimento string, razao_social string, motivo_desabilitacao string,
        tp_gestao string, co_tipo_unidade string, ds_tipo_unidade string,
        natureza_juridica string, desc_natureza_juridica string,
        regiao string, uf string, municipio string,
        no_logradouro string, nu_endereco string, no_complemento string,
        no_bairro string, co_cep string, nu_telefone string, no_email string,
        {_not_null_int(BED_MEASURES)}, {LINEAGE}
        """
    ),
    key=("_extraction_date", "comp", "cnes"),
    ranges={"ano_referencia": (2000, 2100), **{m: (0, None) for m in BED_MEASURES}},
    patterns={"comp": r"^[0-9]{6}\z"},
    partition="_extraction_date",
)

OCCUPANCY = TableSpec(
    name="silver.ocupacao_covid",
    schema=columns(
        f"""
        id_registro string not null, cnes string not null,
        data_notificacao timestamp not null, ano_referencia int not null,
        {_not_null_int(OCCUPANCY_MEASURES)},
        estado_notificacao string, municipio_notificacao string, estado string,
        municipio string, origem string, excluido boolean, validado boolean,
        registro_created_at timestamp, registro_updated_at timestamp, {LINEAGE}
        """
    ),
    key=("_extraction_date", "id_registro"),
    ranges={"ano_referencia": (2020, 2030), **{m: (0, None) for m in OCCUPANCY_MEASURES}},
    partition="_extraction_date",
)

CARE_UNITS = TableSpec(
    name="silver.ubs",
    schema=columns(
        f"""
        cnes string not null, co_uf string, co_ibge string, no_unidade string,
        no_logradouro string, no_bairro string, nu_latitude double, nu_longitude double,
        {LINEAGE}
        """
    ),
    key=("_extraction_date", "cnes"),
    ranges=_COORDINATES,
    partition="_extraction_date",
)

UNIT_TYPES = TableSpec(
    name="silver.dominio_tp_unidade",
    schema=columns(
        "co_tp_unidade string not null, ds_tp_unidade string not null, categoria string not null"
    ),
    key=("co_tp_unidade",),
)

LEGAL_NATURES = TableSpec(
    name="silver.dominio_natureza_juridica",
    schema=columns(
        "co_natureza_jur string not null, ds_natureza_jur string not null, grupo string not null"
    ),
    key=("co_natureza_jur",),
)

DIM_ESTABLISHMENT = TableSpec(
    name="gold.dim_estabelecimento",
    schema=columns(
        """
        co_cnes string not null, no_fantasia string, no_razao_social string,
        co_uf string, sg_uf string, ds_uf string, co_ibge string, tp_gestao string,
        tp_unidade string, ds_tipo_unidade string, categoria_unidade string,
        co_natureza_jur string, ds_natureza_juridica string, grupo_natureza_jur string,
        co_motivo_desab string, is_ativo boolean, is_ubs boolean not null,
        nu_latitude double, nu_longitude double,
        geom point, co_cep string,
        st_atend_hospitalar boolean, st_centro_cirurgico boolean,
        st_atend_ambulatorial boolean, _extraction_date date not null,
        _loaded_at timestamp not null
        """
    ),
    key=("co_cnes",),
)

DIM_TIME = TableSpec(
    name="gold.dim_tempo",
    schema=columns(
        """
        data date not null, ano int not null, mes int not null, dia int not null,
        trimestre int not null, semestre int not null, ano_mes string not null,
        ano_mes_label string not null, nome_mes string not null,
        nome_mes_abrev string not null, dia_semana int not null,
        nome_dia_semana string not null, eh_fim_de_semana boolean not null,
        semana_iso int not null, dia_do_ano int not null, eh_periodo_covid boolean,
        _loaded_at timestamp not null
        """
    ),
    key=("data",),
)

DIM_MUNICIPALITY = TableSpec(
    name="gold.dim_municipio",
    schema=columns(
        """
        co_ibge string not null, co_ibge_7dig string not null, no_municipio string,
        co_uf string, sg_uf string, ds_uf string,
        qtd_estabelecimentos int not null, qtd_ubs int not null,
        _loaded_at timestamp not null
        """
    ),
    key=("co_ibge",),
)

FACT_BEDS = TableSpec(
    name="gold.fato_leitos_anual",
    schema=columns(
        """
        co_cnes string not null, ano_referencia int not null, qtd_competencias int not null,
        leitos_existentes_sum bigint not null, leitos_sus_sum bigint not null,
        uti_total_sum bigint not null, uti_sus_sum bigint not null,
        leitos_existentes_avg decimal(10,2) not null, leitos_sus_avg decimal(10,2) not null,
        uti_total_avg decimal(10,2) not null, uti_sus_avg decimal(10,2) not null,
        leitos_existentes_max int not null, uti_total_max int not null,
        _extraction_date date not null, _loaded_at timestamp not null
        """
    ),
    key=("co_cnes", "ano_referencia"),
    partition="ano_referencia",
)

FACT_OCCUPANCY = TableSpec(
    name="gold.fato_ocupacao_covid",
    schema=columns(
        """
        co_cnes string not null, ano_mes string not null, ano_referencia int not null,
        qtd_notificacoes int not null,
        ocupacao_uti_covid_sum bigint not null, ocupacao_uti_covid_avg decimal(10,2) not null,
        ocupacao_uti_covid_max int not null,
        ocupacao_cli_covid_sum bigint not null, ocupacao_cli_covid_avg decimal(10,2) not null,
        ocupacao_cli_covid_max int not null,
        ocupacao_uti_hosp_max int not null, ocupacao_cli_hosp_max int not null,
        obitos_confirmados_sum bigint not null, altas_confirmadas_sum bigint not null,
        obitos_suspeitos_sum bigint not null, altas_suspeitas_sum bigint not null,
        _extraction_date date not null, _loaded_at timestamp not null
        """
    ),
    key=("co_cnes", "ano_mes"),
    partition="ano_referencia",
)

FACT_PRESSURE = TableSpec(
    name="gold.fato_pressao_uti_covid",
    schema=columns(
        """
        co_cnes string not null, ano_mes string not null, ano_referencia int not null,
        capacidade_uti_declarada int not null, leitos_total_declarado int not null,
        pico_uti_covid_mes int not null, pico_cli_covid_mes int not null,
        pico_uti_total_mes int not null, qtd_notificacoes int not null,
        taxa_ocupacao_uti_covid decimal(8,4), is_overloaded boolean not null,
        obitos_confirmados bigint not null, altas_confirmadas bigint not null,
        taxa_letalidade decimal(8,4), _loaded_at timestamp not null
        """
    ),
    key=("co_cnes", "ano_mes"),
    partition="ano_referencia",
)
