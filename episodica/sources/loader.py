"""Loaders: each returns the 18 source tables by name, with their declared columns and types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.sources.schemas import SCHEMAS, columns

Tables = Mapping[str, DataFrame]

# How a database reads a fact in parallel. Tables with a unique key: by ranges of it, between bounds that a query finds.
JDBC_RANGES = {
    "tb_fat_cidadao_pec": "co_seq_fat_cidadao_pec",
    "tb_fat_atendimento_individual": "co_seq_fat_atd_ind",
    "tb_fat_cad_domiciliar": "co_seq_fat_cad_domiciliar",
    "tb_fat_visita_domiciliar": "co_seq_fat_visita_domiciliar",
    "tb_fat_cad_individual": "co_seq_fat_cad_individual",
}
# The others name persons or attendances, some of which have very many rows and some of which are NULL: by a remainder of
# all these columns together, so that a hot or missing id is dealt over the parts by its other columns.
JDBC_REMAINDERS = {
    "tb_fat_atd_ind_problemas": ["co_fat_atd_ind", "co_dim_cid", "co_dim_ciap"],
    "tb_fat_atd_ind_procedimentos": ["co_fat_cidadao_pec", "co_dim_procedimento_avaliado", "co_dim_tempo"],
    "tb_fat_proced_atend_proced": ["co_fat_cidadao_pec", "co_dim_procedimento", "co_dim_tempo"],
    "tb_fat_atendimento_odonto": ["co_fat_cidadao_pec", "co_dim_cbo_1", "co_dim_tempo"],
    "tb_fat_cad_dom_familia": ["co_fat_cad_domiciliar", "co_fat_cidadao_pec"],
}


def conform(df: DataFrame, name: str) -> DataFrame:
    """Only the declared columns, in declared types."""
    return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in columns(name).items()])


def from_files(spark: SparkSession, root: str, fmt: str = "parquet", suffix: str = "", **options: str) -> Tables:
    """``root/<table><suffix>`` for each table, in any file format Spark reads (parquet, orc, csv, json).

    Parquet, ORC and CSV with a header must have all declared columns; a missing one raises. CSV without a header is
    read by position, and JSON by name, where a record may leave out what is null.
    """
    reader = spark.read.format(fmt).options(**options)
    unnamed = fmt == "json" or fmt == "csv" and str(options.get("header", "false")).lower() != "true"

    def load(name: str, schema: str) -> DataFrame:
        path = f"{root}/{name}{suffix}"
        if unnamed:
            return spark.read.format(fmt).options(**options).schema(schema).load(path)
        found = reader.load(path)
        missing = {c.lower() for c in columns(name)} - {c.lower() for c in found.columns}
        if missing:
            raise ValueError(f"{path} has no column {', '.join(sorted(missing))}")
        return conform(found, name)

    return {name: load(name, schema) for name, schema in SCHEMAS.items()}


def from_catalog(spark: SparkSession, schema: str | None = None) -> Tables:
    """Tables of a catalog schema, or of the current one."""
    prefix = f"{schema}." if schema else ""
    return {name: conform(spark.table(prefix + name), name) for name in SCHEMAS}


def jdbc_predicates(name: str, partitions: int) -> list[str]:
    """Conditions that deal the rows of a table without a unique key over parts; each row meets exactly one."""
    terms = [f"{31**i} * ABS(MOD(COALESCE({c}, 0), 1000003))" for i, c in enumerate(JDBC_REMAINDERS[name])]
    return [f"MOD({' + '.join(terms)}, {partitions}) = {part}" for part in range(partitions)]


def jdbc_bounds_query(name: str, schema: str | None = None) -> str:
    """A derived table with the lowest and highest key of a table that is read by ranges."""
    key, table = JDBC_RANGES[name], f"{schema}.{name}" if schema else name
    return f"(SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}) bounds"


def jdbc_options(
    name: str, url: str, bounds: Mapping[str, tuple[int, int] | None], partitions: int, schema: str | None = None
) -> dict[str, str]:
    """Reader options of a dimension, or of a fact by ranges: ``bounds`` has its (lowest, highest) key, None if it is empty.

    A fact that is read by ranges and has no bounds is refused, as one connection would read all of it.
    """
    options = {"url": url, "dbtable": f"{schema}.{name}" if schema else name, "fetchsize": "10000"}
    if name not in JDBC_RANGES:
        return options
    if name not in bounds:
        raise ValueError(f"no bounds of {JDBC_RANGES[name]} for {name}")
    if bounds[name] is None:
        return options
    low, high = bounds[name]
    ranges = {"partitionColumn": JDBC_RANGES[name], "lowerBound": low, "upperBound": high, "numPartitions": partitions}
    return options | {option: str(value) for option, value in ranges.items()}


def from_jdbc(
    spark: SparkSession,
    url: str,
    bounds: Mapping[str, tuple[int, int] | None] | None = None,
    partitions: int = 64,
    schema: str | None = None,
    **credentials: str,
) -> Tables:
    """Tables of a relational database; columns and filters are pushed into its scans.

    Without ``bounds`` a query per ranged fact finds them, which its key's index answers.
    """

    def read(options: dict[str, str]) -> DataFrame:
        return spark.read.format("jdbc").options(**options, **credentials).load()

    def found(name: str) -> tuple[int, int] | None:
        low, high = read({"url": url, "dbtable": jdbc_bounds_query(name, schema)}).first()
        return None if low is None else (int(low), int(high))

    def table(name: str) -> DataFrame:
        if name in JDBC_REMAINDERS:
            whole = f"{schema}.{name}" if schema else name
            properties = {"fetchsize": "10000", **credentials}
            return spark.read.jdbc(url, whole, predicates=jdbc_predicates(name, partitions), properties=properties)
        return read(jdbc_options(name, url, bounds, partitions, schema))

    bounds = {name: found(name) for name in JDBC_RANGES} if bounds is None else bounds
    return {name: conform(table(name), name) for name in SCHEMAS}
