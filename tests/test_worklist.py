"""The whole job on invented people, one per semantic case, with results worked out by hand."""

import datetime

import pytest

from episodica.functions import Dating
from episodica.plans.worklist import Rule, worklist
from tests.clinic import AS_OF, DENTIST, NURSE_AIDE, OTHER, UNKNOWN_DAY, Clinic, ago

START = ago(100)
DUE = START + datetime.timedelta(294)


def midnight(day):
    return datetime.datetime.combine(day, datetime.time())


def days(n):
    return datetime.timedelta(n)


def build() -> Clinic:
    c = Clinic()
    c.attend(c.person("start reported"), ago(30), start=START, weeks=3)
    c.attend(c.person("weeks reported"), ago(30), weeks=10)
    c.attend(c.person("neither"), ago(30))

    p = c.person("dated later")
    c.attend(p, ago(60))
    c.attend(p, ago(40), start=START)
    c.attend(p, ago(20), start=START + days(7))

    c.attend(c.person("two problems"), ago(30), cid=("O24", "Z34"), ciap=("W78",))
    c.attend(c.person("ciap only"), ago(30), cid=(), ciap=("W78",))
    c.attend(c.person("no listed problem"), ago(30), cid=("J00",), ciap=("A01",))
    c.attend(c.person("no problem row"), ago(30), cid=())
    c.attend(c.person("sub-code"), ago(30), cid=("O245",))
    c.attend(c.person("other occupation"), ago(30), by=OTHER)
    c.attend(c.person("first day"), ago(294))
    c.attend(c.person("too old"), ago(295))
    c.attend(c.person("no start key"), ago(30), start=None)
    c.attend(c.person("no birth", birth=None), ago(30))

    a, b = c.person("two ids", cpf="old"), c.person("two ids", cpf="new")
    other = c.person("two ids", birth=datetime.date(1991, 1, 1))
    shout = c.person("TWO IDS")
    c.attend(a, ago(50), start=START)
    c.attend(b, ago(30), start=START)
    c.attend(other, ago(30))
    c.attend(shout, ago(30))
    c.dental(a, ago(70))
    c.visit(a, c.worker("ana"), ago(10))

    for _ in range(2):
        nameless = c.person(None)
        c.attend(nameless, ago(30), start=START)
        c.dental(nameless, ago(40))
        c.home(nameless, "Rua X", "1", ago(90))

    for name, day in (
        ("on start", START), ("on due", DUE), ("before start", START - days(1)), ("after due", DUE + days(1)),
    ):
        p = c.person(name)
        c.attend(p, ago(30), start=START)
        c.dental(p, day)

    p = c.person("dental by other")
    c.attend(p, ago(30), start=START)
    c.dental(p, ago(40), by=OTHER)

    p = c.person("hiv standalone")
    c.attend(p, ago(30), start=START)
    c.standalone(p, "0214010040", ago(40), by=NURSE_AIDE)
    p = c.person("hiv evaluated")
    c.attend(p, ago(30), start=START)
    c.evaluated(p, "ABEX018", ago(40))
    p = c.person("wrong fact")
    c.attend(p, ago(30), start=START)
    c.evaluated(p, "0214010040", ago(40))
    c.standalone(p, "0202031110", ago(40))
    p = c.person("wrong tester")
    c.attend(p, ago(30), start=START)
    c.standalone(p, "0214010040", ago(40), by=DENTIST)
    p = c.person("syphilis")
    c.attend(p, ago(30), start=START)
    c.standalone(p, "ABPG026", ago(40))
    p = c.person("both tests")
    c.attend(p, ago(30), start=START)
    c.standalone(p, "ABPG024", ago(40))
    c.evaluated(p, "0202031179", ago(41))

    p = c.person("loss and birth")
    c.attend(p, ago(30), start=START)
    c.attend(p, ago(20), cid=("O03",), by=OTHER)
    c.attend(p, ago(10), cid=(), ciap=("W90",), by=OTHER)
    p = c.person("birth before")
    c.attend(p, ago(30), start=START)
    c.attend(p, START - days(1), cid=("O80",))
    p = c.person("mixed problem row")
    m = c.attend(p, ago(30), start=START)
    c.add("tb_fat_atd_ind_problemas", m, c.cid["O80"], c.ciap["W82"])

    unit, team = c.unit("U1", "posto são josé"), c.team("T1", "Azul")
    none_unit, none_team = c.unit("-", "Não informado"), c.team("-", "SEM EQUIPE")
    half_unit = c.unit("-", "outro")
    joao, maria = c.worker("joão"), c.worker("maria")
    p = c.person("registered")
    c.attend(p, ago(30), unit=none_unit, team=none_team)
    c.register(p, ago(400), unit=unit, team=team, professional=joao)
    p = c.person("fallback")
    c.attend(p, ago(30), unit=unit, team=team)
    c.register(p, ago(20), unit=none_unit, team=none_team)
    p = c.person("half fallback")
    c.attend(p, ago(30), unit=unit)
    c.register(p, ago(20), unit=half_unit)
    p = c.person("latest attendance by anyone")
    c.attend(p, ago(30), unit=half_unit)
    c.attend(p, ago(10), unit=unit, by=OTHER, cid=())
    p = c.person("visited")
    c.attend(p, ago(30))
    c.register(p, ago(20), professional=joao)
    c.visit(p, joao, ago(16))
    c.visit(p, maria, ago(15))
    p = c.person("undated visit")
    c.attend(p, ago(30))
    c.visit(p, joao, ago(15))
    c.visit(p, maria, None)

    for name, street, number in (
        ("no street", None, "10"), ("no number", "Rua X", None), ("empty home", None, None),
    ):
        p = c.person(name)
        c.attend(p, ago(30))
        c.home(p, street, number, ago(90))
    p = c.person("moved")
    c.attend(p, ago(30))
    c.home(p, "Rua nova", "2", ago(50))
    c.home(p, "Rua velha", "1", ago(90))

    p = c.person("same day twice")
    c.attend(p, ago(30), weeks=5)
    c.attend(p, ago(30), weeks=8)

    c.attend(c.person("start after contact"), ago(30), start=ago(20))
    c.attend(c.person("past due"), ago(30), start=ago(400))
    return c


@pytest.fixture(scope="module")
def found(request, spark):
    t = build().tables(spark)
    rows = worklist(spark, t, Rule(AS_OF)).collect()
    people = {}
    for row in rows:
        people.setdefault(row.gestante_nome, []).append(row)
    return people


def one(found, name):
    (row,) = found[name]
    return row


def test_columns_in_order(found):
    assert list(one(found, "neither").asDict()) == """
        estabelecimento_cnes estabelecimento_nome equipe_ine equipe_nome acs_nome acs_data_ultima_visita
        gestante_documento_cpf gestante_documento_cns gestante_nome gestante_data_de_nascimento gestante_telefone
        gestante_endereco gestante_dum gestante_idade_gestacional_atual
        gestante_idade_gestacional_primeiro_atendimento gestante_dpp gestante_consulta_prenatal_data_limite
        gestante_dpp_dias_para gestante_consulta_prenatal_total gestante_consulta_prenatal_ultima_data
        gestante_consulta_prenatal_ultima_dias_desde atendimento_odontologico_realizado exame_hiv_realizado
        exame_sifilis_realizado exame_sifilis_hiv_realizado possui_registro_aborto possui_registro_parto
        criacao_data""".split()


def test_reported_start(found):
    row = one(found, "start reported")
    assert (row.gestante_dum, row.gestante_dpp) == (START, midnight(DUE))
    assert row.gestante_consulta_prenatal_data_limite == row.gestante_dpp
    assert row.gestante_idade_gestacional_atual == 14
    assert row.gestante_idade_gestacional_primeiro_atendimento == 10
    assert row.gestante_dpp_dias_para == 194


def test_reported_weeks(found):
    row = one(found, "weeks reported")
    assert row.gestante_dum == ago(100)
    assert row.gestante_dpp == midnight(ago(100) + days(294))
    assert row.gestante_idade_gestacional_atual == 14
    assert row.gestante_idade_gestacional_primeiro_atendimento == 10


def test_undated_person_stays(found):
    row = one(found, "neither")
    assert row.gestante_dum is None and row.gestante_dpp is None and row.gestante_dpp_dias_para is None
    assert row.gestante_idade_gestacional_atual is None
    assert row.gestante_idade_gestacional_primeiro_atendimento is None
    assert row.atendimento_odontologico_realizado is False and row.exame_sifilis_hiv_realizado is False
    assert (row.possui_registro_aborto, row.possui_registro_parto) == ("Não", "Não")
    assert (row.estabelecimento_cnes, row.acs_nome, row.gestante_endereco) == (None, None, None)


def test_first_known_value_wins(found):
    row = one(found, "dated later")
    assert row.gestante_dum == START
    assert row.gestante_idade_gestacional_primeiro_atendimento == 8  # first dated contact, 60 days after the start
    assert row.gestante_consulta_prenatal_total == 3
    assert row.gestante_consulta_prenatal_ultima_data == ago(20)
    assert row.gestante_consulta_prenatal_ultima_dias_desde == 20


def test_problem_rows_count_once(found):
    assert one(found, "two problems").gestante_consulta_prenatal_total == 1


@pytest.mark.parametrize("name", ["ciap only", "first day"])
def test_kept(found, name):
    assert len(found[name]) == 1


@pytest.mark.parametrize(
    "name",
    [
        "no listed problem", "no problem row", "sub-code", "other occupation", "too old", "no start key", "no birth",
    ],
)
def test_left_out(found, name):
    assert name not in found


def test_two_ids_are_one_person(found):
    by_birth = {row.gestante_data_de_nascimento: row for row in found["two ids"]}
    assert len(found["two ids"]) == 2 and len(found["TWO IDS"]) == 1
    row = by_birth[datetime.date(1990, 1, 1)]
    assert row.gestante_consulta_prenatal_total == 2
    assert row.gestante_documento_cpf == "new"  # from the id of the latest attendance
    assert row.atendimento_odontologico_realizado and row.acs_nome == "ANA"
    assert not by_birth[datetime.date(1991, 1, 1)].atendimento_odontologico_realizado


def test_nameless_people_group_but_match_nothing(found):
    row = one(found, None)
    assert row.gestante_consulta_prenatal_total == 2
    assert not row.atendimento_odontologico_realizado and row.gestante_endereco is None


@pytest.mark.parametrize(
    "name, seen",
    [
        ("on start", True), ("on due", True), ("before start", False), ("after due", False),
        ("dental by other", False),
    ],
)
def test_closed_interval(found, name, seen):
    assert one(found, name).atendimento_odontologico_realizado is seen


@pytest.mark.parametrize(
    "name, hiv, syphilis",
    [
        ("hiv standalone", True, False), ("hiv evaluated", True, False), ("wrong fact", False, False),
        ("wrong tester", False, False), ("syphilis", False, True), ("both tests", True, True),
    ],
)
def test_tests(found, name, hiv, syphilis):
    row = one(found, name)
    assert (row.exame_hiv_realizado, row.exame_sifilis_realizado) == (hiv, syphilis)
    assert row.exame_sifilis_hiv_realizado is (hiv and syphilis)


@pytest.mark.parametrize(
    "name, loss, birth",
    [("loss and birth", "Sim", "Sim"), ("birth before", "Não", "Não"), ("mixed problem row", "Sim", "Sim")],
)
def test_outcomes(found, name, loss, birth):
    if name == "mixed problem row":  # neither code is a cohort code; O24 on the same attendance is
        assert one(found, name).gestante_consulta_prenatal_total == 1
    row = one(found, name)
    assert (row.possui_registro_aborto, row.possui_registro_parto) == (loss, birth)


def test_unit_and_team(found):
    row = one(found, "registered")
    assert (row.estabelecimento_cnes, row.estabelecimento_nome) == ("U1", "POSTO SÃO JOSÉ")
    assert (row.equipe_ine, row.equipe_nome, row.acs_nome) == ("T1", "Azul", "JOÃO")
    row = one(found, "fallback")
    assert (row.estabelecimento_cnes, row.estabelecimento_nome) == ("U1", "POSTO SÃO JOSÉ")
    assert (row.equipe_ine, row.equipe_nome) == ("T1", "Azul")
    row = one(found, "half fallback")
    assert (row.estabelecimento_cnes, row.estabelecimento_nome) == ("U1", "OUTRO")
    assert one(found, "latest attendance by anyone").estabelecimento_cnes == "U1"


def test_worker(found):
    row = one(found, "visited")
    assert (row.acs_nome, row.acs_data_ultima_visita) == ("MARIA", ago(15))
    row = one(found, "undated visit")  # an unknown time sorts as latest
    assert (row.acs_nome, row.acs_data_ultima_visita) == ("MARIA", None)


@pytest.mark.parametrize(
    "name, address",
    [("no street", ", 10"), ("no number", "Rua X, "), ("empty home", None), ("moved", "Rua nova, 2")],
)
def test_address(found, name, address):
    assert one(found, name).gestante_endereco == address


def test_same_day(found):
    row = one(found, "same day twice")
    assert row.gestante_consulta_prenatal_total == 2
    assert row.gestante_idade_gestacional_primeiro_atendimento == 5


def test_signs(found):
    assert one(found, "start after contact").gestante_idade_gestacional_primeiro_atendimento == -1  # -10 days
    assert one(found, "past due").gestante_dpp_dias_para == 294 - 400


def test_due_follows_start(found):
    for rows in found.values():
        for row in rows:
            if row.gestante_dum:
                assert (row.gestante_dpp.date() - row.gestante_dum).days == 294


def test_empty_cohort(spark):
    c = Clinic()
    c.attend(c.person("too old"), ago(400))
    assert worklist(spark, c.tables(spark), Rule(AS_OF)).count() == 0


def shifted(clinic: Clinic, n: int) -> Clinic:
    """The same clinic with every known date moved by n days."""
    moved = Clinic()

    def move(value):
        if isinstance(value, int) and 19000101 <= value <= 29991231:
            day = datetime.date(value // 10000, value // 100 % 100, value % 100)
            return moved.at(day + days(n))
        return value

    for name, rows in clinic.rows.items():
        if name.startswith("tb_fat"):
            moved.rows[name] = [tuple(move(v) for v in row) for row in rows]
        elif name != "tb_dim_tempo":
            moved.rows[name] = rows
    return moved


def undated(row) -> tuple:
    return tuple(v for v in row.asDict().values() if not isinstance(v, datetime.date))


def sortable(rows):
    return sorted(rows, key=repr)


def test_shifting_time_changes_dates_only(spark):
    clinic = build()
    before = worklist(spark, clinic.tables(spark), Rule(AS_OF)).collect()
    after = worklist(spark, shifted(clinic, 45).tables(spark), Rule(AS_OF + days(45))).collect()
    assert sortable(map(undated, before)) == sortable(map(undated, after))


def test_order_partitions_and_repeated_problems_do_not_matter(spark):
    clinic = build()
    plain = worklist(spark, clinic.tables(spark), Rule(AS_OF)).drop("criacao_data").collect()
    clinic.rows["tb_fat_atd_ind_problemas"] *= 2
    for rows in clinic.rows.values():
        rows.reverse()
    t = {name: df.repartition(3) for name, df in clinic.tables(spark).items()}
    again = worklist(spark, t, Rule(AS_OF)).drop("criacao_data").collect()
    assert sortable(plain) == sortable(again)


def test_sentinel_start_with_other_year_is_skipped(spark):
    """A time row for 3000-12-31 whose year says otherwise dates the episode but is no known start."""
    c = Clinic()
    p = c.person("odd row")
    c.attend(p, ago(30), weeks=7)
    t = c.tables(spark)
    odd = [(30001231, UNKNOWN_DAY, 2000)]
    t["tb_dim_tempo"] = t["tb_dim_tempo"].where("nu_ano <> 3000").union(
        spark.createDataFrame(odd, t["tb_dim_tempo"].schema)
    )
    (row,) = worklist(spark, t, Rule(AS_OF)).collect()
    assert row.gestante_dum is None
    assert row.gestante_dpp.date() == UNKNOWN_DAY + days(294)
    assert row.gestante_idade_gestacional_primeiro_atendimento == 7


def test_other_rule(spark):
    """The rule's parameters reach every date."""
    c = Clinic()
    c.attend(c.person("short"), ago(30), weeks=2)
    c.attend(c.person("old"), ago(31), weeks=2)
    rule = Rule(AS_OF, Dating(episode_days=50, unit_days=10), lookback_days=30)
    (row,) = worklist(spark, c.tables(spark), rule).collect()
    assert (row.gestante_nome, row.gestante_dum, row.gestante_dpp) == ("short", ago(50), midnight(AS_OF))
    assert row.gestante_idade_gestacional_atual == 5
