"""Pruning of facts: ids by a bounded filter, days by ranges; and what it saves."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from episodica import operators as ops
from episodica.plans.worklist import RECORDS, Members, Rule, episode_events, on_days, responsible, worklist
from episodica.session import Scratch
from tests.clinic import AS_OF, Clinic, ago
from tests.measure import total


@pytest.mark.parametrize("count", [0, 1, 3, 500, 20_000])
def test_filter_keeps_every_id_and_few_others(spark, count):
    ids = spark.range(count).select((F.col("id") * 7919 - 1000).alias("member"))
    kept = ops.IdFilter(ids, "member", count)
    facts = ids.select(F.col("member").alias("who")).unionByName(spark.range(20_000).select((-F.col("id") - 10**7).alias("who")))
    found = kept.keep(facts.unionByName(spark.createDataFrame([(None,)], "who bigint")), "who")
    assert found.join(ids, F.col("who") == F.col("member"), "left_semi").count() == count
    others = found.join(ids, F.col("who") == F.col("member"), "left_anti").count()
    assert others <= 0.02 * 20_000


def test_filter_is_bounded_and_takes_other_types(spark):
    assert ops.IdFilter(spark.range(1), "id", 10**12).words == 1 << 21
    ids = spark.createDataFrame([(i,) for i in range(-50, 50)], "member int")
    facts = spark.range(-1000, 1000).toDF("who")
    assert {r.who for r in ops.IdFilter(ids, "member", 100).keep(facts, "who").collect()} >= set(range(-50, 50))
    names = spark.createDataFrame([("a",), (None,), ("c",)], "name string")
    assert sorted(r.name for r in ops.IdFilter(names, "name", 2).keep(names, "name").collect()) == ["a", "c"]


def test_ranges_cover_keys_over_the_smallest_gaps():
    assert ops.key_ranges([]) == [] and ops.key_ranges([5, 5]) == [(5, 5)]
    assert ops.key_ranges([9, 1, 2, 3, 7]) == [(1, 3), (7, 7), (9, 9)]
    assert ops.key_ranges([9, 1, 2, 3, 7], 2) == [(1, 3), (7, 9)]
    r = random.Random(1)
    for _ in range(200):
        keys = [r.randrange(-300, 300) for _ in range(r.randrange(1, 60))]
        most = r.randrange(1, 8)
        ranges = ops.key_ranges(keys, most)
        assert len(ranges) <= most and all(a <= b for a, b in ranges)
        assert all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:]))
        assert all(any(a <= k <= b for a, b in ranges) for k in keys) and all(a in keys and b in keys for a, b in ranges)


def crowd(spark, history: int, hot: int) -> dict:
    """Forty members with ten records each, ``history`` other ids with ten each, one member and one other with ``hot``."""
    c = Clinic()
    t = dict(c.tables(spark))
    ten = F.expr("explode(sequence(0L, 9L)) AS n")
    rows = spark.range(40).select("id", ten).unionByName(spark.range(1000, 1000 + history).select("id", ten))
    for who in (3, 999_999):
        rows = rows.unionByName(spark.range(hot).select(F.lit(who).cast("long").alias("id"), F.col("id").alias("n")))
    rows = rows.select(F.col("id").alias("who"), F.monotonically_increasing_id().alias("nr"), (F.col("n") % 50).alias("day"))
    rows = rows.repartition(8, "nr").selectExpr("who", "nr", "day").persist()
    own = {"co_fat_cidadao_pec": "who", "co_dim_tempo": "day", "co_seq_fat_visita_domiciliar": "nr", "co_seq_fat_cad_individual": "nr", "co_seq_fat_atd_ind": "nr", "co_fat_cad_domiciliar": "nr", "co_seq_fat_cad_domiciliar": "nr"}
    for name in ("tb_fat_visita_domiciliar", "tb_fat_cad_individual", "tb_fat_atendimento_individual", "tb_fat_cad_dom_familia", "tb_fat_cad_domiciliar"):
        t[name] = rows.select(*[F.col(own[f.name]).alias(f.name) if f.name in own else F.lit(None).cast(f.dataType).alias(f.name) for f in t[name].schema.fields])
    return t


def shuffled(spark, history, hot):
    ids = spark.range(40).selectExpr("id AS member_id", "id AS case_id", "DATE '2024-01-01' AS start", "TIMESTAMP_NTZ '2024-10-21 00:00:00' AS due")
    found = responsible(crowd(spark, history, hot), Members(Scratch(spark).save(ids, "members"), 40))
    assert len(found.collect()) == 40
    return total(found, "shuffleRecordsWritten")


def test_records_of_others_are_not_shuffled(spark):
    """The rows that ``responsible`` shuffles follow the members, whatever the history, with and without hot ids."""
    bridge = 2 * (40 * 10)  # the family bridge's member rows meet the registrations by key, if not broadcast
    few = shuffled(spark, 100, 0)
    many = shuffled(spark, 4000, 0)
    assert few <= many <= 1.3 * few + bridge
    hot = shuffled(spark, 4000, 3000)
    assert hot <= 1.3 * few + bridge + 2 * 3000


def test_a_start_in_1900_does_not_switch_pruning_off(spark, tmp_path):
    c = Clinic()
    days = [datetime.date(year, 6, 15) for year in range(1900, 2025)]
    for d in days:
        c.dental(1, d)
    t = dict(c.tables(spark))
    path = f"{tmp_path}/dental"
    t["tb_fat_atendimento_odonto"].repartition(1).write.partitionBy("co_dim_tempo").parquet(path)
    spans = [(datetime.date(1900, 5, 1),), (datetime.date(2024, 2, 1),), (datetime.date(2023, 9, 1),), (None,)]
    ids = spark.createDataFrame(spans, "start date").selectExpr("1L AS member_id", "2L AS case_id", "start", "CAST(date_add(start, 294) AS TIMESTAMP_NTZ) AS due")
    members = Members(ids, 4)
    read = spark.read.parquet(path).where(on_days(members.days(t)))
    found = {str(r.co_dim_tempo) for r in read.collect()}
    assert found == {"19000615", "20240615"}
    assert total(read, "numFiles") == 2
    none = Members(ids.where("start IS NULL"), 1)
    assert spark.read.parquet(path).where(on_days(none.days(t))).collect() == []


def test_events_of_others_are_dropped_at_the_scan(spark):
    c = Clinic()
    for i in range(300):
        c.dental(i, ago(20))
    ids = spark.range(5).selectExpr("id AS member_id", "id AS case_id", "DATE '2024-01-01' AS start", "TIMESTAMP_NTZ '2024-10-21 00:00:00' AS due")
    found = episode_events(c.tables(spark), Members(ids, 5))
    who = {r.citizen_id for r in found.collect()}
    assert who >= set(range(5)) and len(who) <= 30


def test_problem_rows_are_read_once(spark):
    """Cohort, losses and births come from one written table of tagged rows."""
    c = Clinic()
    p = c.person("maria")
    c.attend(p, ago(200), start=ago(250))
    c.attend(p, ago(60), cid=("O03",), start=ago(250))
    c.attend(p, ago(30), cid=("O80", "O24"), start=ago(250))
    t, reads = dict(c.tables(spark)), []

    class Counting(dict):
        def __getitem__(self, name):
            reads.append(name)
            return super().__getitem__(name)

    (row,) = worklist(spark, Counting(t), Rule(AS_OF)).collect()
    assert (row.possui_registro_aborto, row.possui_registro_parto, row.gestante_consulta_prenatal_total) == ("Sim", "Sim", 2)
    assert reads.count("tb_fat_atd_ind_problemas") == 1


def test_records_keep_fixed_width():
    assert "street" not in RECORDS["home"]
