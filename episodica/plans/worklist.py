"""The pregnancy active-search worklist: one row per person in prenatal care, 28 columns.

Three stages, each a few shuffles on its own key:

0. problems - the problem rows with a listed code, one bit per list; written, so the problem table is read once.
1. cohort   - qualifying attendances, summarised per citizen id, then per person (name and birth date); written.
2. members  - all citizen ids of the cohort's persons (same name and birth key); written, the days of their episodes read
              back. Facts of other ids are dropped at their scans by a Bloom filter of bounded size, other days by ranges.
3. worklist - latest records and event flags of the members, one row per case, joined to the cohort.

Only the latest attendance of a person survives, so the running windows over a person's attendances end as aggregates of
the whole person, and flags and latest records are needed for the cohort's persons only.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.functions import (
    Dating,
    age_at_first_contact,
    days_between,
    in_codes,
    join_text,
    known,
    lookback,
    prefer_known,
    starts_with_any,
    yes_no,
)
from episodica.operators import (
    IdFilter,
    best_again,
    best_of,
    earliest,
    earliest_again,
    flag_bits,
    flags_of_ids,
    in_ranges,
    key_ranges,
    lookup,
    members_of,
    merge_ids,
    with_child,
    with_order_key,
)
from episodica.session import Scratch
from episodica.sources import code_sets as codes
from episodica.sources.loader import Tables

FLAGS = ["dental", "hiv", "syphilis", "loss", "birth"]
# What the latest record of each kind gives; texts are looked up by the record's key.
RECORDS = {
    "home": ["record_id"],
    "visit": ["professional", "time_key"],
    "registration": ["team", "unit", "professional"],
    "attendance": ["team", "unit"],
}
# Code lists by their bit in the tagged problem rows: (CIAP codes, CID codes).
PROBLEMS = {
    "cohort": (codes.COHORT_CIAP, codes.COHORT_CID),
    "loss": (codes.LOSS_CIAP, codes.LOSS_CID),
    "birth": (codes.BIRTH_CIAP, codes.BIRTH_CID),
}


@dataclass(frozen=True)
class Rule:
    """Parameters of the worklist."""

    as_of: datetime.date
    dating: Dating = field(default_factory=Dating)
    lookback_days: int = 294

    @property
    def today(self) -> Column:
        return F.lit(self.as_of)


def on_days(days: DataFrame) -> Column:
    """Filter on a fact's ``co_dim_tempo``: the ranges of keys that these days of the time dimension form.

    Literals, so scans can skip partitions and row groups by them; a lone day far away adds a range of its own and
    widens none. The driver gets one key per day of the calendar at most; the inner join to the days decides.
    """
    keys = days.select("co_seq_dim_tempo").distinct().toArrow()
    return in_ranges("co_dim_tempo", key_ranges(keys.column(0).drop_null().to_pylist()))


def tagged_problems(t: Tables) -> DataFrame:
    """(attendance_id, bits) of the problem rows whose CIAP or CID code is in a list; one bit per list of PROBLEMS.

    One pass over the problem rows and no shuffle, as the listed codes are a small part of the two code dimensions.
    """

    def listed(dim: DataFrame, code: str, position: int) -> DataFrame:
        bits = flag_bits({name: in_codes(code, lists[position]) for name, lists in PROBLEMS.items()})
        return dim.withColumn("bits", bits).where("bits <> 0")

    rows = t["tb_fat_atd_ind_problemas"]
    rows = lookup(rows, listed(t["tb_dim_ciap"], "nu_ciap", 0), "co_dim_ciap", "co_seq_dim_ciap", {"by_ciap": "bits"})
    rows = lookup(rows, listed(t["tb_dim_cid"], "nu_cid", 1), "co_dim_cid", "co_seq_dim_cid", {"by_cid": "bits"})
    bits = F.coalesce("by_ciap", F.lit(0)).bitwiseOR(F.coalesce("by_cid", F.lit(0)))
    return rows.select(F.col("co_fat_atd_ind").alias("attendance_id"), bits.alias("bits")).where("bits <> 0")


def tagged_as(name: str) -> Column:
    """True for tagged problem rows of one list."""
    return F.col("bits").bitwiseAND(1 << list(PROBLEMS).index(name)) != 0


def qualifying_attendances(t: Tables, rule: Rule, problems: DataFrame | None = None) -> DataFrame:
    """Attendances of the lookback period by a listed occupation with at least one listed problem, one row each."""
    problems = tagged_problems(t) if problems is None else problems
    time = t["tb_dim_tempo"]
    recent = time.where(lookback(F.col("dt_registro"), rule.today, rule.lookback_days))
    occupations = t["tb_dim_cbo"].where(starts_with_any(F.col("nu_cbo"), codes.COHORT_OCCUPATIONS))

    rows = t["tb_fat_atendimento_individual"].where(on_days(recent))
    rows = lookup(rows, recent, "co_dim_tempo", "co_seq_dim_tempo", {"event_date": "dt_registro"}, "inner")
    rows = lookup(rows, occupations, "co_dim_cbo_1", "co_seq_dim_cbo", {}, "inner")
    reported = {"reported_start": "dt_registro", "reported_year": "nu_ano"}
    rows = lookup(rows, time, "co_dim_tempo_dum", "co_seq_dim_tempo", reported, "inner")
    units = F.col("nu_idade_gestacional_semanas")
    start = rule.dating.start(F.col("reported_start"), F.col("reported_year"), F.col("event_date"), units)
    rows = rows.select(
        F.col("co_seq_fat_atd_ind").alias("attendance_id"),
        F.col("co_fat_cidadao_pec").alias("citizen_id"),
        "event_date",
        start.alias("start"),
        units.alias("units"),
    )
    return with_child(rows, problems.where(tagged_as("cohort")), "attendance_id", "attendance_id")


def cohort(t: Tables, rule: Rule, problems: DataFrame | None = None) -> DataFrame:
    """One row per person: latest attendance (``case_id``), own identity columns, contact summary and episode dates."""

    def with_birth_date(ids: DataFrame) -> DataFrame:
        born = {"birth_date": "dt_registro"}
        return lookup(ids, t["tb_dim_tempo"], "co_dim_tempo_nascimento", "co_seq_dim_tempo", born, "inner")

    identity = ["co_dim_tempo_nascimento", "nu_cpf_cidadao", "nu_cns", "nu_telefone_celular"]
    rows = with_order_key(qualifying_attendances(t, rule, problems), "event_date", "attendance_id")
    known_start = f"start <> DATE '{rule.dating.unknown_date}'"
    firsts = {
        "first_dated": earliest(rows, "_order_key", "event_date", "start", "start IS NOT NULL"),
        "first_start": earliest(rows, "_order_key", "event_date", "start", known_start),
        "first_units": earliest(rows, "_order_key", "event_date", "units", "units IS NOT NULL"),
    }
    last = ["attendance_id", "event_date"]
    persons = merge_ids(
        rows,
        "citizen_id",
        t["tb_fat_cidadao_pec"],
        "co_seq_fat_cidadao_pec",
        ["no_cidadao", "birth_date"],
        per_id={"contacts": F.count("*"), "last": best_of(rows, "_order_key", last), **firsts},
        merged={
            "contacts": F.sum("contacts"),
            "latest": best_again("last", last, {"citizen_id": "_fact_id"}),
            **{name: earliest_again(name) for name in firsts},
        },
        resolve=with_birth_date,
    )
    dated = F.col("first_dated.value")
    dates = {"due": rule.dating.due(dated), "age": rule.dating.age(dated, rule.today)}
    persons = persons.withColumns(dates).selectExpr(
        "latest.attendance_id AS case_id",
        "latest.citizen_id AS citizen_id",
        "no_cidadao",
        "birth_date",
        "contacts",
        "latest.event_date AS last_contact",
        "first_dated.order AS first_contact",
        "first_start.value AS start",
        "due",
        "age",
        "first_units.value AS first_units",
    )
    own = lookup(
        persons, t["tb_fat_cidadao_pec"], "citizen_id", "co_seq_fat_cidadao_pec", {c: c for c in identity}, "inner"
    )
    return own.drop("citizen_id")


@dataclass(frozen=True)
class Members:
    """Every citizen id with the name and birth key of a case: (member_id, case_id, start, due)."""

    ids: DataFrame
    count: int

    def of(self, facts: DataFrame) -> DataFrame:
        """Facts of member ids and of few others."""
        return IdFilter(self.ids, "member_id", self.count).keep(facts, "co_fat_cidadao_pec")

    def days(self, t: Tables) -> DataFrame:
        """The days of the time dimension that lie in an episode of any case."""
        spans = self.ids.selectExpr("start", "CAST(due AS DATE) AS due").where("start <= due").distinct()
        inside = spans.select(F.explode(F.sequence("start", "due")).alias("day")).distinct()
        return t["tb_dim_tempo"].join(inside, F.col("dt_registro") == F.col("day"), "inner").drop("day")


def cohort_members(t: Tables, cases: DataFrame, rule: Rule, scratch: Scratch) -> Members:
    """The cohort's members, written, and how many there are."""
    natural_key = ["no_cidadao", "co_dim_tempo_nascimento"]
    carry = ["case_id", "start", "due"]
    found = members_of(t["tb_fat_cidadao_pec"], "co_seq_fat_cidadao_pec", natural_key, cases, carry)
    ids = scratch.save(found.withColumnRenamed("co_seq_fat_cidadao_pec", "member_id"), "members")
    return Members(ids, ids.count())


def record_history(t: Tables, members: Members) -> DataFrame:
    """All records of members that "latest" is asked of, in one long table: citizen_id, kind, time_key, record_id, ids."""
    dated = {"co_dim_tempo": "co_dim_tempo"}
    home = lookup(
        members.of(t["tb_fat_cad_dom_familia"]),
        t["tb_fat_cad_domiciliar"],
        "co_fat_cad_domiciliar",
        "co_seq_fat_cad_domiciliar",
        dated,
        "inner",
    )
    visit, registration, attendance = (
        members.of(t[name])
        for name in ("tb_fat_visita_domiciliar", "tb_fat_cad_individual", "tb_fat_atendimento_individual")
    )
    sources = [
        ("home", home, "co_fat_cad_domiciliar", {}),
        ("visit", visit, "co_seq_fat_visita_domiciliar", {"professional": "co_dim_profissional"}),
        (
            "registration",
            registration,
            "co_seq_fat_cad_individual",
            {"team": "co_dim_equipe", "unit": "co_dim_unidade_saude", "professional": "co_dim_profissional"},
        ),
        (
            "attendance",
            attendance,
            "co_seq_fat_atd_ind",
            {"team": "co_dim_equipe_1", "unit": "co_dim_unidade_saude_1"},
        ),
    ]
    histories = [
        rows.selectExpr(
            "co_fat_cidadao_pec AS citizen_id",
            f"'{kind}' AS kind",
            "co_dim_tempo AS time_key",
            f"{record_id} AS record_id",
            *[f"{column} AS {name}" for name, column in payload.items()],
        )
        for kind, rows, record_id, payload in sources
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), histories)


def responsible(t: Tables, members: Members) -> DataFrame:
    """Per case: unit, team, worker, last visit and address from the latest records of all the person's ids."""
    history = with_order_key(record_history(t, members), "time_key", "record_id")
    per_id = {kind: best_of(history, "_order_key", keep, f"kind = '{kind}'") for kind, keep in RECORDS.items()}
    latest = merge_ids(
        history,
        "citizen_id",
        members.ids,
        "member_id",
        ["case_id"],
        per_id,
        merged={kind: best_again(kind, keep) for kind, keep in RECORDS.items()},
    )
    kept = [f"{kind}.{c} AS {kind}_{c}" for kind, keep in RECORDS.items() for c in keep]
    latest = latest.selectExpr("case_id", *kept)
    street = {"home_street": "no_logradouro", "home_number": "nu_num_logradouro"}
    latest = lookup(latest, t["tb_fat_cad_domiciliar"], "home_record_id", "co_seq_fat_cad_domiciliar", street)
    unit = {"code": "nu_cnes", "name": "no_unidade_saude"}
    team = {"code": "nu_ine", "name": "no_equipe"}
    for kind in ("registration", "attendance"):
        for role, table, key, columns in (
            ("unit", "tb_dim_unidade_saude", "co_seq_dim_unidade_saude", unit),
            ("team", "tb_dim_equipe", "co_seq_dim_equipe", team),
        ):
            named = {f"{kind}_{role}_{out}": column for out, column in columns.items()}
            latest = lookup(latest, t[table], f"{kind}_{role}", key, named)
    for kind in ("registration", "visit"):
        named = {f"{kind}_worker": "no_profissional"}
        worker = t["tb_dim_profissional"]
        latest = lookup(latest, worker, f"{kind}_professional", "co_seq_dim_profissional", named)
    latest = lookup(latest, t["tb_dim_tempo"], "visit_time_key", "co_seq_dim_tempo", {"last_visit": "dt_registro"})

    def registered(column: str, sentinel: str) -> Column:
        return prefer_known(F.col(f"registration_{column}"), sentinel, F.col(f"attendance_{column}"))

    return latest.select(
        "case_id",
        registered("unit_code", codes.NO_CODE).alias("unit_code"),
        registered("unit_name", codes.NO_UNIT_NAME).alias("unit_name"),
        registered("team_code", codes.NO_CODE).alias("team_code"),
        registered("team_name", codes.NO_TEAM_NAME).alias("team_name"),
        F.coalesce("visit_worker", "registration_worker").alias("worker"),
        "last_visit",
        known(join_text(F.col("home_street"), F.col("home_number")), codes.NO_ADDRESS).alias("address"),
    )


def episode_events(t: Tables, members: Members, problems: DataFrame | None = None) -> DataFrame:
    """All events of members that the flags ask for, in one long table: citizen_id, day, flag.

    Only on days of the cohort's episodes; no flag looks outside.
    """
    problems = tagged_problems(t) if problems is None else problems
    days = members.days(t)
    in_episodes = on_days(days)

    def timely(fact: str) -> DataFrame:
        return members.of(t[fact].where(in_episodes))

    def tests(fact: str, procedure: str, occupation: str, sets: dict[str, list[str]]) -> DataFrame:
        found = F.array_compact(F.array(*[F.when(in_codes("co_proced", c), F.lit(name)) for name, c in sets.items()]))
        procedures = t["tb_dim_procedimento"].withColumn("flag", found).where(F.size("flag") > 0)
        occupations = t["tb_dim_cbo"].where(starts_with_any(F.col("nu_cbo"), codes.TEST_OCCUPATIONS))
        rows = lookup(timely(fact), procedures, procedure, "co_seq_dim_procedimento", {"flag": "flag"}, "inner")
        rows = lookup(rows, occupations, occupation, "co_seq_dim_cbo", {}, "inner")
        return rows.withColumn("flag", F.explode("flag"))

    standalone = {"hiv": codes.HIV_STANDALONE, "syphilis": codes.SYPHILIS_STANDALONE}
    evaluated = {"hiv": codes.HIV_EVALUATED, "syphilis": codes.SYPHILIS_EVALUATED}
    dentists = t["tb_dim_cbo"].where(starts_with_any(F.col("nu_cbo"), codes.DENTAL_OCCUPATIONS))
    dental = lookup(timely("tb_fat_atendimento_odonto"), dentists, "co_dim_cbo_1", "co_seq_dim_cbo", {}, "inner")
    attendances = timely("tb_fat_atendimento_individual").select(
        "co_seq_fat_atd_ind", "co_fat_cidadao_pec", "co_dim_tempo"
    )
    recorded = {name: tagged_as(name) for name in ("loss", "birth")}
    outcomes = problems.select(
        "attendance_id", F.explode(F.array_compact(F.array(*[F.when(hit, F.lit(n)) for n, hit in recorded.items()]))).alias("flag")
    )
    outcomes = attendances.join(outcomes, F.col("co_seq_fat_atd_ind") == F.col("attendance_id"), "inner")

    sources = [
        dental.withColumn("flag", F.lit("dental")),
        tests("tb_fat_proced_atend_proced", "co_dim_procedimento", "co_dim_cbo", standalone),
        tests("tb_fat_atd_ind_procedimentos", "co_dim_procedimento_avaliado", "co_dim_cbo_1", evaluated),
        outcomes,
    ]
    long = reduce(DataFrame.unionByName, [s.select("co_fat_cidadao_pec", "co_dim_tempo", "flag") for s in sources])
    dated = lookup(long, days, "co_dim_tempo", "co_seq_dim_tempo", {"day": "dt_registro"}, "inner")
    return dated.select(F.col("co_fat_cidadao_pec").alias("citizen_id"), "day", "flag")


def present(cases: DataFrame, rule: Rule, built_at: Column | None = None) -> DataFrame:
    """The 28 output columns, in order."""
    flag = {f: F.coalesce(F.col(f), F.lit(False)) for f in FLAGS}
    start, due, last = F.col("start"), F.col("due"), F.col("last_contact")
    first_age = age_at_first_contact(start, F.col("first_contact"), F.col("first_units"), rule.dating)
    columns = {
        "estabelecimento_cnes": F.col("unit_code"),
        "estabelecimento_nome": F.upper("unit_name"),
        "equipe_ine": F.col("team_code"),
        "equipe_nome": F.col("team_name"),
        "acs_nome": F.upper("worker"),
        "acs_data_ultima_visita": F.col("last_visit"),
        "gestante_documento_cpf": F.col("nu_cpf_cidadao"),
        "gestante_documento_cns": F.col("nu_cns"),
        "gestante_nome": F.col("no_cidadao"),
        "gestante_data_de_nascimento": F.col("birth_date"),
        "gestante_telefone": F.col("nu_telefone_celular"),
        "gestante_endereco": F.col("address"),
        "gestante_dum": start,
        "gestante_idade_gestacional_atual": F.col("age"),
        "gestante_idade_gestacional_primeiro_atendimento": first_age,
        "gestante_dpp": due,
        "gestante_consulta_prenatal_data_limite": due,
        "gestante_dpp_dias_para": days_between(due.cast("date"), rule.today),
        "gestante_consulta_prenatal_total": F.col("contacts"),
        "gestante_consulta_prenatal_ultima_data": last,
        "gestante_consulta_prenatal_ultima_dias_desde": days_between(rule.today, last),
        "atendimento_odontologico_realizado": flag["dental"],
        "exame_hiv_realizado": flag["hiv"],
        "exame_sifilis_realizado": flag["syphilis"],
        "exame_sifilis_hiv_realizado": flag["hiv"] & flag["syphilis"],
        "possui_registro_aborto": yes_no(flag["loss"]),
        "possui_registro_parto": yes_no(flag["birth"]),
        "criacao_data": built_at if built_at is not None else F.current_timestamp(),
    }
    return cases.select(*[column.alias(name) for name, column in columns.items()])


def worklist(
    spark: SparkSession, t: Tables, rule: Rule, built_at: Column | None = None, scratch: Scratch | None = None
) -> DataFrame:
    """The whole worklist. Tagged problems, the cohort and its member ids are written to the scratch folder on the way."""
    scratch = scratch or Scratch(spark)
    problems = scratch.save(tagged_problems(t), "problems")
    cases = scratch.save(cohort(t, rule, problems), "cohort")
    members = cohort_members(t, cases, rule, scratch)
    lookups = responsible(t, members)
    events = episode_events(t, members, problems)
    flags = flags_of_ids(
        events, "citizen_id", members.ids, "member_id", "case_id", "start", "due", FLAGS
    )
    return present(cases.join(lookups, "case_id", "left").join(flags, "case_id", "left"), rule, built_at)
