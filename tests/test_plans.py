"""What the plans must and must not contain."""

import contextlib
import datetime
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from episodica import operators as ops
from episodica.plans.registry import AS_OF, REGISTRY
from episodica.plans.worklist import Rule, cohort, qualifying_attendances
from episodica.sources.order_tables import health_tables

FOLDER = "/root/testdata/sf0.001"


def plan(df, mode="formatted") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@pytest.mark.parametrize("name", list(REGISTRY))
def test_no_pairs_no_windows_no_python(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for operator in ("BroadcastNestedLoopJoin", "CartesianProduct", "Window", "Python", "Pandas"):
        assert operator not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["lookback_filter"](spark, FOLDER))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate,2000-10-11", text)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    text = plan(entry.queries()["star_inner"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in text
    assert "StringStartsWith(p_brand,Brand#1)" in text


def test_time_range_reaches_the_attendance_scan(spark, tmp_path):
    t = health_tables(spark, FOLDER)
    path = f"{tmp_path}/attendances"
    t["tb_fat_atendimento_individual"].write.parquet(path)
    t["tb_fat_atendimento_individual"] = spark.read.parquet(path)
    text = plan(qualifying_attendances(t, Rule(AS_OF)))
    first = (AS_OF - datetime.timedelta(294) - datetime.date(1970, 1, 1)).days
    assert f"GreaterThanOrEqual(co_dim_tempo,{first})" in text


def test_cohort_aggregates_before_every_shuffle_on_ids_and_persons(spark):
    text = plan(cohort(health_tables(spark, FOLDER), Rule(AS_OF)), "simple")
    keys = ("citizen_id", "no_cidadao")
    shuffles = [i for i, line in enumerate(text.splitlines()) if "Exchange hashpartitioning" in line]
    lines = text.splitlines()
    for i in shuffles:
        if any(k in lines[i] for k in keys):
            assert "partial_" in lines[i + 1]


def test_dimensions_filter_attendances_before_they_meet_their_problems(spark):
    """The shuffle on the attendance key comes after the joins to date, occupation and reported start, and equal rows are
    merged after it, without another one."""
    lines = plan(qualifying_attendances(health_tables(spark, FOLDER), Rule(AS_OF)), "simple").splitlines()
    at = next(i for i, line in enumerate(lines) if re.search(r"(SortMergeJoin|HashJoin) .*attendance_id", line))
    below = [line for line in lines[at + 1 :] if "BroadcastHashJoin" in line]
    for column in ("co_dim_tempo#", "co_dim_cbo_1#", "co_dim_tempo_dum#"):
        assert any(column in line for line in below)
    assert "HashAggregate" in lines[at - 2] and not any("Exchange" in line for line in lines[:at])


FIRST_AND_LAST = [
    "top1_per_entity", "latest_per_entity", "latest_via_bridge", "responsible_lookup", "first_non_null",
    "first_non_null_events", "first_non_sentinel", "episode_active_search",
]


@pytest.mark.parametrize("name", FIRST_AND_LAST)
def test_first_and_last_rows_are_hash_aggregates(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER), "simple")
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_the_cohort_sorts_nothing_to_aggregate(spark):
    assert "SortAggregate" not in plan(cohort(health_tables(spark, FOLDER), Rule(AS_OF)), "simple")


@pytest.mark.parametrize("name", ["flag_interval_exists", "flag_union_branches", "flag_or_codes"])
def test_flags_read_each_fact_once(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER), "simple")
    for table in ("orders", "lineitem"):
        assert len(re.findall(rf"FileScan parquet .*/{table}\.parquet", text)) == 1


@pytest.fixture
def small_skew(spark):
    """Thresholds low enough for test data to count as skewed."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_hot_entity_is_split_when_its_summary_is_joined_back(spark, small_skew):
    rows = spark.range(0, 60_000, 1, 8).select(
        F.expr("CASE WHEN id % 3 = 0 THEN NULL ELSE id % 5000 END").alias("k"), F.col("id"), F.hash("id").alias("x")
    )
    found = ops.attach(rows, ["k"], {"n": F.count("*")})
    top = found.groupBy("k").agg(F.max("n").alias("n"), F.count("*").alias("rows"))
    found.collect()
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    assert top.where("n <> rows").count() == 0


def test_hot_fact_key_is_split_in_a_lookup(spark, small_skew):
    facts = spark.range(0, 60_000, 1, 8).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 7 ELSE id % 5000 END").alias("k"), F.col("id"), F.hash("id").alias("x")
    )
    dim = spark.range(5000).select(F.col("id").alias("dk"), F.hash("id").alias("name"))
    found = ops.lookup(facts, dim, "k", "dk", {"name": "name"})
    assert len(found.collect()) == 60_000
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
