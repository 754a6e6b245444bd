"""The worklist in plain DuckDB SQL: contacts grouped to persons, then lateral lookups and EXISTS tests per person.

It shares no logic with the Spark job and serves as its check on the derived health tables.
"""

from __future__ import annotations

import datetime

from episodica.sources import code_sets as codes
from episodica.sources.order_tables import health_sql


def _one_of(column: str, values: list[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def _begins(column: str, prefixes: list[str]) -> str:
    return "(" + " OR ".join(f"{column} LIKE '{p}%'" for p in prefixes) + ")"


def _coded(alias: str, ciap: list[str], cid: list[str]) -> str:
    """Whether a problem row has a listed code, by the keys of the listed codes."""
    return (
        f"({alias}.co_dim_ciap IN (SELECT co_seq_dim_ciap FROM tb_dim_ciap WHERE {_one_of('nu_ciap', ciap)})"
        f" OR {alias}.co_dim_cid IN (SELECT co_seq_dim_cid FROM tb_dim_cid WHERE {_one_of('nu_cid', cid)}))"
    )


def _happened(fact: str, condition: str) -> str:
    """Whether a fact row ``e`` of one of the person's ids meets the condition on a day of the episode."""
    return f"""EXISTS (FROM kin JOIN {fact} e ON e.co_fat_cidadao_pec = kin.citizen
        JOIN tb_dim_tempo d ON d.co_seq_dim_tempo = e.co_dim_tempo
        WHERE kin.person = persons.person AND d.dt_registro >= persons.began AND d.dt_registro <= persons.due AND {condition})"""


def _worker_kind(column: str, prefixes: list[str]) -> str:
    return f"{column} IN (SELECT co_seq_dim_cbo FROM tb_dim_cbo WHERE {_begins('nu_cbo', prefixes)})"


def _tested(standalone: list[str], evaluated: list[str]) -> str:
    def listed(column: str, codes_: list[str]) -> str:
        return f"{column} IN (SELECT co_seq_dim_procedimento FROM tb_dim_procedimento WHERE {_one_of('co_proced', codes_)})"

    alone = f"{listed('e.co_dim_procedimento', standalone)} AND {_worker_kind('e.co_dim_cbo', codes.TEST_OCCUPATIONS)}"
    during = (
        f"{listed('e.co_dim_procedimento_avaliado', evaluated)} AND {_worker_kind('e.co_dim_cbo_1', codes.TEST_OCCUPATIONS)}"
    )
    return f"({_happened('tb_fat_proced_atend_proced', alone)} OR {_happened('tb_fat_atd_ind_procedimentos', during)})"


def _recorded(ciap: list[str], cid: list[str]) -> str:
    problem = f"(FROM tb_fat_atd_ind_problemas q WHERE q.co_fat_atd_ind = e.co_seq_fat_atd_ind AND {_coded('q', ciap, cid)})"
    return _happened("tb_fat_atendimento_individual", f"EXISTS {problem}")


def _latest(name: str, fact: str, key: str, columns: str, via: str = "") -> str:
    """The newest fact row of the person, found for each person beside the main query."""
    link = f"JOIN {via or f'{fact} f ON f.co_fat_cidadao_pec = kin.citizen'}"
    return f"""LEFT JOIN LATERAL (SELECT {columns} FROM kin {link}
        WHERE kin.person = persons.person ORDER BY f.co_dim_tempo DESC NULLS FIRST, f.{key} DESC LIMIT 1) {name} ON true"""


def worklist_sql(as_of: datetime.date, lookback_days: int = 294) -> str:
    """One row per person: contacts grouped to persons first, all else asked of each person."""
    tables = ",\n".join(f"{name} AS ({sql.format_map(_Bare())})" for name, sql in health_sql("duckdb").items())
    today = f"DATE '{as_of}'"
    known = lambda column: f"first({column} ORDER BY day, id) FILTER (WHERE {column} IS NOT NULL)"
    home = """tb_fat_cad_dom_familia l ON l.co_fat_cidadao_pec = kin.citizen
        JOIN tb_fat_cad_domiciliar f ON f.co_seq_fat_cad_domiciliar = l.co_fat_cad_domiciliar"""
    return f"""
WITH {tables},
contacts AS (
    SELECT a.co_seq_fat_atd_ind AS id, a.co_fat_cidadao_pec AS citizen, d.dt_registro AS day,
        a.nu_idade_gestacional_semanas AS weeks,
        if(s.nu_ano <> 3000, s.dt_registro, d.dt_registro - 7 * a.nu_idade_gestacional_semanas) AS began
    FROM tb_fat_atendimento_individual a, tb_dim_tempo d, tb_dim_tempo s
    WHERE d.co_seq_dim_tempo = a.co_dim_tempo AND s.co_seq_dim_tempo = a.co_dim_tempo_dum
      AND date_diff('day', d.dt_registro, {today}) <= {lookback_days}
      AND {_worker_kind('a.co_dim_cbo_1', codes.COHORT_OCCUPATIONS)}
      AND a.co_seq_fat_atd_ind IN (SELECT q.co_fat_atd_ind FROM tb_fat_atd_ind_problemas q
          WHERE {_coded('q', codes.COHORT_CIAP, codes.COHORT_CID)})),
grouped AS (
    SELECT c.no_cidadao AS name, b.dt_registro AS born, any_value(c.co_dim_tempo_nascimento) AS birth_key,
        last(struct_pack(cpf := c.nu_cpf_cidadao, cns := c.nu_cns, phone := c.nu_telefone_celular) ORDER BY day, id) AS who,
        count(*) AS times, max(day) AS last_day, min(day) FILTER (WHERE began IS NOT NULL) AS first_dated,
        {known('began')} AS began, {known('weeks')} AS weeks
    FROM contacts
    JOIN tb_fat_cidadao_pec c ON c.co_seq_fat_cidadao_pec = citizen
    JOIN tb_dim_tempo b ON b.co_seq_dim_tempo = c.co_dim_tempo_nascimento
    GROUP BY c.no_cidadao, b.dt_registro),
persons AS (
    SELECT row_number() OVER () AS person, *, CAST(began + INTERVAL 294 DAY AS TIMESTAMP) AS due FROM grouped),
kin AS (
    SELECT person, c.co_seq_fat_cidadao_pec AS citizen
    FROM persons JOIN tb_fat_cidadao_pec c ON c.no_cidadao = name AND c.co_dim_tempo_nascimento = birth_key),
flags AS (
    SELECT person,
        {_happened('tb_fat_atendimento_odonto', _worker_kind('e.co_dim_cbo_1', codes.DENTAL_OCCUPATIONS))} AS dental,
        {_tested(codes.HIV_STANDALONE, codes.HIV_EVALUATED)} AS hiv,
        {_tested(codes.SYPHILIS_STANDALONE, codes.SYPHILIS_EVALUATED)} AS syphilis,
        {_recorded(codes.LOSS_CIAP, codes.LOSS_CID)} AS loss,
        {_recorded(codes.BIRTH_CIAP, codes.BIRTH_CID)} AS birth
    FROM persons),
records AS (
    SELECT persons.person, visit.day_key AS visit_key, visit.worker AS visitor, card.worker AS registrar,
        card.unit AS card_unit, card.team AS card_team, seen.unit AS seen_unit, seen.team AS seen_team,
        nullif(concat(home.street, ', ', home.number), ', ') AS address
    FROM persons
    {_latest('home', '', 'co_seq_fat_cad_domiciliar', 'f.no_logradouro AS street, f.nu_num_logradouro AS number', home)}
    {_latest('visit', 'tb_fat_visita_domiciliar', 'co_seq_fat_visita_domiciliar', 'f.co_dim_tempo AS day_key, f.co_dim_profissional AS worker')}
    {_latest('card', 'tb_fat_cad_individual', 'co_seq_fat_cad_individual', 'f.co_dim_profissional AS worker, f.co_dim_unidade_saude AS unit, f.co_dim_equipe AS team')}
    {_latest('seen', 'tb_fat_atendimento_individual', 'co_seq_fat_atd_ind', 'f.co_dim_unidade_saude_1 AS unit, f.co_dim_equipe_1 AS team')})
SELECT
    coalesce(nullif((SELECT nu_cnes FROM tb_dim_unidade_saude WHERE co_seq_dim_unidade_saude = card_unit), '{codes.NO_CODE}'),
        (SELECT nu_cnes FROM tb_dim_unidade_saude WHERE co_seq_dim_unidade_saude = seen_unit)) AS estabelecimento_cnes,
    upper(coalesce(nullif((SELECT no_unidade_saude FROM tb_dim_unidade_saude WHERE co_seq_dim_unidade_saude = card_unit), '{codes.NO_UNIT_NAME}'),
        (SELECT no_unidade_saude FROM tb_dim_unidade_saude WHERE co_seq_dim_unidade_saude = seen_unit))) AS estabelecimento_nome,
    coalesce(nullif((SELECT nu_ine FROM tb_dim_equipe WHERE co_seq_dim_equipe = card_team), '{codes.NO_CODE}'),
        (SELECT nu_ine FROM tb_dim_equipe WHERE co_seq_dim_equipe = seen_team)) AS equipe_ine,
    coalesce(nullif((SELECT no_equipe FROM tb_dim_equipe WHERE co_seq_dim_equipe = card_team), '{codes.NO_TEAM_NAME}'),
        (SELECT no_equipe FROM tb_dim_equipe WHERE co_seq_dim_equipe = seen_team)) AS equipe_nome,
    upper(coalesce((SELECT no_profissional FROM tb_dim_profissional WHERE co_seq_dim_profissional = visitor),
        (SELECT no_profissional FROM tb_dim_profissional WHERE co_seq_dim_profissional = registrar))) AS acs_nome,
    (SELECT dt_registro FROM tb_dim_tempo WHERE co_seq_dim_tempo = visit_key) AS acs_data_ultima_visita,
    who.cpf AS gestante_documento_cpf, who.cns AS gestante_documento_cns, name AS gestante_nome,
    born AS gestante_data_de_nascimento, who.phone AS gestante_telefone, address AS gestante_endereco,
    began AS gestante_dum, CAST(({today} - began) // 7 AS INTEGER) AS gestante_idade_gestacional_atual,
    CAST(coalesce((first_dated - began) // 7, weeks) AS INTEGER) AS gestante_idade_gestacional_primeiro_atendimento,
    due AS gestante_dpp, due AS gestante_consulta_prenatal_data_limite,
    CAST(CAST(due AS DATE) - {today} AS INTEGER) AS gestante_dpp_dias_para,
    times AS gestante_consulta_prenatal_total, last_day AS gestante_consulta_prenatal_ultima_data,
    CAST({today} - last_day AS INTEGER) AS gestante_consulta_prenatal_ultima_dias_desde,
    dental AS atendimento_odontologico_realizado, hiv AS exame_hiv_realizado, syphilis AS exame_sifilis_realizado,
    hiv AND syphilis AS exame_sifilis_hiv_realizado,
    if(loss, 'Sim', 'Não') AS possui_registro_aborto, if(birth, 'Sim', 'Não') AS possui_registro_parto
FROM persons JOIN flags USING (person) JOIN records USING (person)"""


class _Bare(dict):
    """Table placeholders stand for the table of that name."""

    def __missing__(self, name: str) -> str:
        return name
