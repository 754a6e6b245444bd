"""Loaders, scratch, snapshot and the job around them."""

import datetime
import pathlib
import subprocess
import sys
import threading
import time
from types import SimpleNamespace

import pytest

from episodica.job import build_snapshot, command_line, current_day, source_tables
from episodica.operators import builds, write_snapshot
from episodica.plans.worklist import Rule
from episodica.session import Scratch, scratch_root
from episodica.sources import loader
from episodica.sources.schemas import SCHEMAS
from tests.clinic import AS_OF, Clinic, ago


def clinic() -> Clinic:
    c = Clinic()
    p = c.person("maria")
    c.attend(p, ago(30), start=ago(100))
    c.dental(p, ago(40))
    return c


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_files(spark, tmp_path, fmt):
    tables = clinic().tables(spark)
    for name, df in tables.items():
        df.write.format(fmt).save(f"{tmp_path}/{name}.{fmt}")
    read = loader.from_files(spark, str(tmp_path), fmt, f".{fmt}")
    assert read.keys() == SCHEMAS.keys()
    for name in ("tb_dim_tempo", "tb_fat_cidadao_pec", "tb_fat_atendimento_individual"):
        assert read[name].dtypes == tables[name].dtypes
        assert sorted(read[name].collect(), key=repr) == sorted(tables[name].collect(), key=repr)


def test_catalog_reads_declared_columns_and_types(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS health_source")
    for name, df in clinic().tables(spark).items():
        wider = df.selectExpr("*", "'x' AS not_declared")
        wider.write.mode("overwrite").option("path", f"{tmp_path}/{name}").saveAsTable(f"health_source.{name}")
    read = loader.from_catalog(spark, "health_source")
    assert read["tb_fat_cidadao_pec"].columns == clinic().tables(spark)["tb_fat_cidadao_pec"].columns
    spark.sql("DROP SCHEMA health_source CASCADE")


def test_jdbc_options():
    bounds = {"tb_fat_cidadao_pec": (1, 900), "tb_fat_cad_domiciliar": None}
    split = loader.jdbc_options("tb_fat_cidadao_pec", "jdbc:x", bounds, 8, "public")
    assert split["dbtable"] == "public.tb_fat_cidadao_pec"
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "co_seq_fat_cidadao_pec", "1", "900", "8",
    )
    assert "partitionColumn" not in loader.jdbc_options("tb_dim_cbo", "jdbc:x", bounds, 8)
    assert "partitionColumn" not in loader.jdbc_options("tb_fat_cad_domiciliar", "jdbc:x", bounds, 8)
    with pytest.raises(ValueError, match="no bounds of co_seq_fat_visita_domiciliar"):
        loader.jdbc_options("tb_fat_visita_domiciliar", "jdbc:x", bounds, 8)


def test_every_fact_is_split_by_columns_it_has():
    facts = [name for name in SCHEMAS if name.startswith("tb_fat")]
    assert sorted([*loader.JDBC_RANGES, *loader.JDBC_REMAINDERS]) == sorted(facts)
    for name in facts:
        keys = [loader.JDBC_RANGES[name]] if name in loader.JDBC_RANGES else loader.JDBC_REMAINDERS[name]
        assert set(keys) <= set(loader.columns(name))


def test_jdbc_predicates_deal_each_row_once_also_hot_and_missing_ids(spark):
    conditions = loader.jdbc_predicates("tb_fat_atendimento_odonto", 4)
    assert len(conditions) == 4
    who = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE -id END AS co_fat_cidadao_pec"
    rows = spark.range(3000).selectExpr("id", who, "id % 5 AS co_dim_cbo_1", "CASE WHEN id % 11 > 0 THEN id END AS co_dim_tempo")
    parts = [{r.id for r in rows.where(c).collect()} for c in conditions]
    assert sum(map(len, parts)) == 3000 == len(set().union(*parts))
    for kind in (0, 1, 2):
        assert max(sum(i % 3 == kind for i in part) for part in parts) < 400


class Reader:
    """Answers like a database's reader would and remembers what it was asked for."""

    def __init__(self, empty=()):
        self.asked, self.empty = [], empty

    @property
    def read(self):
        return self

    def format(self, kind):
        assert kind == "jdbc"
        return self

    def options(self, **options):
        self.now = options
        return self

    def load(self):
        self.asked.append(self.now)
        table = self.now["dbtable"]
        bounds = (None, None) if any(e in table for e in self.empty) else (3, 1000)
        return SimpleNamespace(first=lambda: bounds, of=table)

    def jdbc(self, url, table, predicates, properties):
        self.asked.append({"url": url, "dbtable": table, "predicates": predicates, **properties})
        return SimpleNamespace(of=table)


def test_jdbc_finds_bounds_by_queries(monkeypatch):
    monkeypatch.setattr(loader, "conform", lambda df, name: df.of)
    db = Reader(empty=["tb_fat_cad_domiciliar"])
    read = loader.from_jdbc(db, "jdbc:x", partitions=8, schema="pec", user="reader")
    assert read == {name: f"pec.{name}" for name in SCHEMAS}
    asked = {a["dbtable"]: a for a in db.asked}
    assert all(a["url"] == "jdbc:x" and a["user"] == "reader" for a in db.asked)
    query = "(SELECT MIN(co_seq_fat_atd_ind) AS low, MAX(co_seq_fat_atd_ind) AS high FROM pec.tb_fat_atendimento_individual) bounds"
    assert query in asked and sum("MIN(" in table for table in asked) == len(loader.JDBC_RANGES)
    assert (asked["pec.tb_fat_cidadao_pec"]["lowerBound"], asked["pec.tb_fat_cidadao_pec"]["numPartitions"]) == ("3", "8")
    assert "partitionColumn" not in asked["pec.tb_fat_cad_domiciliar"]
    assert len(asked["pec.tb_fat_atd_ind_problemas"]["predicates"]) == 8
    given = Reader()
    loader.from_jdbc(given, "jdbc:x", bounds={name: (1, 2) for name in loader.JDBC_RANGES})
    assert not any("MIN(" in a["dbtable"] for a in given.asked)


def test_the_job_reads_a_database(monkeypatch):
    monkeypatch.setattr(loader, "conform", lambda df, name: df.of)
    words = ["--jdbc", "jdbc:x", "--jdbc-schema", "s", "--jdbc-partitions", "4", "--jdbc-option", "user=a=b", "--target", "t", "--keep", "3"]
    given = command_line().parse_args(words)
    db = Reader()
    assert source_tables(db, given)["tb_dim_cbo"] == "s.tb_dim_cbo" and given.keep == 3
    assert all(a["user"] == "a=b" for a in db.asked)
    with pytest.raises(SystemExit):
        command_line().parse_args(["--jdbc", "jdbc:x", "--files", "f", "--target", "t"])


class Session:
    """Just the settings a session would answer with."""

    def __init__(self, master, checkpoint=None, set_later=None):
        self.conf = {"spark.checkpoint.dir": checkpoint}
        self.sparkContext = SimpleNamespace(master=master, getCheckpointDir=lambda: set_later)


def test_scratch_root_is_the_shared_folder():
    assert scratch_root(Session("spark://host:7077", "s3://shared/run/")) == "s3://shared/run"
    assert scratch_root(Session("yarn", None, "hdfs:///later")) == "hdfs:///later"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session("spark://host:7077"))
    assert scratch_root(Session("local[2]")) == scratch_root(Session("local[8]"))


def test_scratch(spark):
    scratch = Scratch(spark)
    saved = scratch.save(spark.range(5).selectExpr("id", "id + 1 AS n"), "n")
    assert scratch.path.startswith(scratch_root(spark)) and saved.count() == 5
    scratch.clear()
    with pytest.raises(Exception):
        spark.read.parquet(f"{scratch.path}/n.parquet")


def test_scratch_goes_with_the_session(tmp_path):
    script = """
import sys
from episodica.session import Scratch, build_session
spark = build_session("scratch", "local[1]", **{"spark.checkpoint.dir": sys.argv[1]})
kept = Scratch(spark).save(spark.range(5), "n")
assert kept.count() == 5
"""
    root = pathlib.Path(__file__).parent.parent
    subprocess.run([sys.executable, "-c", script, str(tmp_path)], cwd=root, check=True)
    for _ in range(60):  # the JVM ends a moment after the script
        if not list(tmp_path.glob("episodica-*")):
            return
        time.sleep(0.5)
    raise AssertionError(list(tmp_path.iterdir()))


def test_snapshot_is_replaced_as_a_whole(spark, tmp_path):
    first = write_snapshot(spark.range(3).toDF("n"), "snap_test", "built_at", location=str(tmp_path))
    assert first.columns == ["n", "built_at"] and first.count() == 3
    write_snapshot(spark.range(7).toDF("n"), "snap_test", "built_at", location=str(tmp_path))
    assert spark.table("snap_test").count() == 7
    builds = [t.name for t in spark.catalog.listTables() if t.name.startswith("snap_test__")]
    assert len(builds) == 2
    with pytest.raises(Exception):
        write_snapshot(spark.range(1).selectExpr("raise_error('no') AS n"), "snap_test", location=str(tmp_path))
    assert spark.table("snap_test").count() == 7


def test_older_builds_are_kept_by_number(spark, tmp_path):
    for n in range(1, 6):
        write_snapshot(spark.range(n).toDF("n"), "keep_test", location=str(tmp_path), keep=2)
        assert spark.table("keep_test").count() == n
        assert len(builds(spark, "keep_test")) == min(n, 3)
    kept = builds(spark, "keep_test")
    assert [spark.table(b).count() for b in kept] == [5, 4, 3]
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(kept)
    write_snapshot(spark.range(9).toDF("n"), "keep_test", location=str(tmp_path), keep=0)
    assert [p.name for p in tmp_path.iterdir()] == builds(spark, "keep_test")
    with pytest.raises(ValueError):
        write_snapshot(spark.range(1).toDF("n"), "keep_test", location=str(tmp_path), keep=-1)
    assert builds(spark, "no_such_view") == []


def test_a_failed_build_changes_nothing(spark, tmp_path):
    write_snapshot(spark.range(3).toDF("n"), "fail_test", location=str(tmp_path))
    before = builds(spark, "fail_test")
    with pytest.raises(Exception):
        write_snapshot(spark.range(1).selectExpr("raise_error('no') AS n"), "fail_test", location=str(tmp_path))
    assert builds(spark, "fail_test") == before and spark.table("fail_test").count() == 3


def test_readers_in_another_session_see_old_or_new(spark, tmp_path):
    """A query that began before a switch ends on its build, and none finds the view missing."""
    write_snapshot(spark.range(1).toDF("n"), "switch_test", location=str(tmp_path))
    other = spark.newSession()
    seen, errors, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(other.table("switch_test").count())
            except Exception as error:  # noqa: BLE001
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    began = other.table("switch_test")
    for n in range(2, 7):
        write_snapshot(spark.range(n).toDF("n"), "switch_test", location=str(tmp_path), keep=10)
    stop.set()
    reader.join()
    assert not errors and began.count() == 1
    assert seen == sorted(seen) and set(seen) <= set(range(1, 7)) and len(set(seen)) > 1


def test_job(spark, tmp_path):
    def now():
        return spark.range(1).selectExpr("unix_micros(current_timestamp()) AS t").first().t

    before = now()
    stored = build_snapshot(spark, clinic().tables(spark), "job_test", Rule(AS_OF), str(tmp_path))
    after = now()
    (row,) = stored.collect()
    assert row.gestante_nome == "maria" and row.atendimento_odontologico_realizado
    assert len(stored.columns) == 28
    assert before <= stored.selectExpr("unix_micros(criacao_data) AS t").first().t <= after
    assert isinstance(current_day(spark), datetime.date)


def test_a_missing_column_raises(spark, tmp_path):
    for name, schema in loader.SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    loader.from_files(spark, str(tmp_path))
    name = "tb_fat_atendimento_individual"
    spark.createDataFrame([], loader.SCHEMAS[name]).drop("co_dim_tempo_dum").write.mode("overwrite").parquet(str(tmp_path / name))
    with pytest.raises(ValueError, match="co_dim_tempo_dum"):
        loader.from_files(spark, str(tmp_path))


def test_every_line_item_has_its_day(spark):
    from episodica.sources.order_tables import OrderTables, health_tables

    folder = "/root/testdata/sf0.01"
    days = health_tables(spark, folder)["tb_dim_tempo"]
    shipped = OrderTables(spark, folder)["lineitem"].selectExpr("CAST(l_shipdate AS DATE) AS dt_registro")
    assert shipped.join(days, "dt_registro", "left_anti").count() == 0


def test_code_lists_have_their_sizes():
    """Counts written down here: a code that gets lost would pass every comparison of the lists with themselves."""
    from episodica.sources import code_sets as codes

    sizes = {
        "COHORT_CIAP": 11, "COHORT_CID": 194, "LOSS_CIAP": 2, "LOSS_CID": 6, "BIRTH_CIAP": 4, "BIRTH_CID": 35,
        "HIV_STANDALONE": 3, "HIV_EVALUATED": 2, "SYPHILIS_STANDALONE": 3, "SYPHILIS_EVALUATED": 3,
        "COHORT_OCCUPATIONS": 5, "TEST_OCCUPATIONS": 6, "DENTAL_OCCUPATIONS": 1,
    }
    for name, size in sizes.items():
        found = getattr(codes, name)
        assert len(found) == len(set(found)) == size, name


def test_core_queries_survive_without_the_optional_packages(tmp_path):
    script = """
import sys
sys.modules["sentencepiece"] = sys.modules["zstandard"] = None
import __spark_entry__ as entry
assert "episode_active_search" in entry.queries() and "op6_pieces" not in entry.queries()
assert entry.oracle_sql().keys() == entry.queries().keys()
"""
    root = pathlib.Path(__file__).parent.parent
    subprocess.run([sys.executable, "-c", script], cwd=root, check=True)
