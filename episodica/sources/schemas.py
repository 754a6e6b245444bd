"""Schemas of the 18 source tables (fixed values: table and column names of the health-record data mart)."""

from __future__ import annotations

SCHEMAS: dict[str, str] = {
    # dimensions
    "tb_dim_tempo": "co_seq_dim_tempo bigint, dt_registro date, nu_ano int",
    "tb_dim_cbo": "co_seq_dim_cbo bigint, nu_cbo string",
    "tb_dim_procedimento": "co_seq_dim_procedimento bigint, co_proced string",
    "tb_dim_cid": "co_seq_dim_cid bigint, nu_cid string",
    "tb_dim_ciap": "co_seq_dim_ciap bigint, nu_ciap string",
    "tb_dim_equipe": "co_seq_dim_equipe bigint, nu_ine string, no_equipe string",
    "tb_dim_unidade_saude": "co_seq_dim_unidade_saude bigint, nu_cnes string, no_unidade_saude string",
    "tb_dim_profissional": "co_seq_dim_profissional bigint, no_profissional string",
    # facts
    "tb_fat_cidadao_pec": """co_seq_fat_cidadao_pec bigint, no_cidadao string, co_dim_tempo_nascimento bigint,
        nu_cpf_cidadao string, nu_cns string, nu_telefone_celular string""",
    "tb_fat_atendimento_individual": """co_seq_fat_atd_ind bigint, co_fat_cidadao_pec bigint, co_dim_tempo bigint,
        co_dim_tempo_dum bigint, co_dim_cbo_1 bigint, nu_idade_gestacional_semanas int, co_dim_equipe_1 bigint,
        co_dim_profissional_1 bigint, co_dim_unidade_saude_1 bigint""",
    "tb_fat_atd_ind_problemas": "co_fat_atd_ind bigint, co_dim_cid bigint, co_dim_ciap bigint",
    "tb_fat_atd_ind_procedimentos": """co_fat_cidadao_pec bigint, co_dim_procedimento_avaliado bigint,
        co_dim_cbo_1 bigint, co_dim_tempo bigint""",
    "tb_fat_proced_atend_proced": """co_fat_cidadao_pec bigint, co_dim_procedimento bigint, co_dim_cbo bigint,
        co_dim_tempo bigint""",
    "tb_fat_atendimento_odonto": "co_fat_cidadao_pec bigint, co_dim_cbo_1 bigint, co_dim_tempo bigint",
    "tb_fat_cad_domiciliar": """co_seq_fat_cad_domiciliar bigint, no_logradouro string, nu_num_logradouro string,
        co_dim_tempo bigint""",
    "tb_fat_cad_dom_familia": "co_fat_cad_domiciliar bigint, co_fat_cidadao_pec bigint",
    "tb_fat_visita_domiciliar": """co_seq_fat_visita_domiciliar bigint, co_fat_cidadao_pec bigint,
        co_dim_profissional bigint, co_dim_tempo bigint""",
    "tb_fat_cad_individual": """co_seq_fat_cad_individual bigint, co_fat_cidadao_pec bigint, co_dim_tempo bigint,
        co_dim_equipe bigint, co_dim_profissional bigint, co_dim_unidade_saude bigint""",
}


def columns(table: str) -> dict[str, str]:
    """Column name -> type of a table, in order."""
    return dict(column.split() for column in SCHEMAS[table].split(","))
