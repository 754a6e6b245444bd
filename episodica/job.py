"""The batch job: read the source tables, build the worklist, store it as a snapshot.

    spark-submit --py-files episodica.zip episodica/job.py --files s3://lake/health --target care.prenatal_worklist
    spark-submit --py-files episodica.zip episodica/job.py --catalog health --target care.prenatal_worklist
    spark-submit ... episodica/job.py --jdbc jdbc:postgresql://host/pec --jdbc-schema public --jdbc-option user=reader

The result outlives the job in a persistent catalog (``spark.sql.catalogImplementation=hive`` or a catalog of the
launcher's); without one, ``--location`` is required and holds the tables' files.
"""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.operators import write_snapshot
from episodica.plans.worklist import Rule, worklist
from episodica.session import Scratch, build_session
from episodica.sources.loader import Tables, from_catalog, from_files, from_jdbc


def current_day(spark: SparkSession) -> datetime.date:
    """Today in the session's time zone, read once, so that all stages of a job agree on it."""
    return spark.range(1).select(F.current_date()).first()[0]


def _in_memory(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "in-memory"


def build_snapshot(
    spark: SparkSession,
    tables: Tables,
    target: str,
    rule: Rule | None = None,
    location: str | None = None,
    keep: int = 1,
) -> DataFrame:
    """Build the worklist and store it under ``target``, keeping ``keep`` older builds; returns the stored result."""
    scratch = Scratch(spark)
    try:
        found = worklist(spark, tables, rule or Rule(current_day(spark)), scratch=scratch)
        return write_snapshot(found, target, location=location, keep=keep)
    finally:
        scratch.clear()


def source_tables(spark: SparkSession, given: argparse.Namespace) -> Tables:
    """The tables that the command line names."""
    if given.files:
        return from_files(spark, given.files, given.format)
    if given.catalog:
        return from_catalog(spark, given.catalog)
    options = dict(option.split("=", 1) for option in given.jdbc_option)
    return from_jdbc(spark, given.jdbc, partitions=given.jdbc_partitions, schema=given.jdbc_schema, **options)


def command_line() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="episodica.job", description="Build the active-search worklist.")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--files", help="folder with one file or folder per source table")
    source.add_argument("--catalog", help="catalog schema of the source tables")
    source.add_argument("--jdbc", help="URL of the database that holds the source tables")
    parser.add_argument("--jdbc-schema", help="schema of the tables in the database")
    parser.add_argument("--jdbc-partitions", type=int, default=64, help="parts that a fact is read in")
    parser.add_argument("--jdbc-option", action="append", default=[], metavar="NAME=VALUE", help="reader option, repeatable")
    parser.add_argument("--keep", type=int, default=1, help="older builds of the result to keep")
    parser.add_argument("--format", default="parquet", help="file format of --files (parquet, orc, csv, json)")
    parser.add_argument("--target", required=True, help="name of the result view")
    parser.add_argument("--location", help="folder for the result tables instead of the warehouse")
    parser.add_argument("--as-of", type=datetime.date.fromisoformat, help="reference day, default today")
    return parser


def main(arguments: list[str] | None = None) -> None:
    parser = command_line()
    given = parser.parse_args(arguments)
    spark = build_session("episodica worklist")
    if not given.location and given.target.count(".") < 2 and _in_memory(spark):
        parser.error("the session's catalog ends with the session: configure a persistent one or give --location")
    if "." in given.target:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {given.target.rpartition('.')[0]}")
    rule = Rule(given.as_of or current_day(spark))
    build_snapshot(spark, source_tables(spark, given), given.target, rule, given.location, given.keep)


if __name__ == "__main__":
    main()
