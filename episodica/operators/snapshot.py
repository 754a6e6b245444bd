"""Sink: a stored result under a fixed name, replaced as a whole, with a number of older builds kept."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Property of the view that lists its builds, the shown one first.
MANIFEST = "episodica.builds"


def builds(spark: SparkSession, name: str) -> list[str]:
    """The builds in the manifest of view ``name``, the shown one first; none before the first build."""
    if not spark.catalog.tableExists(name):
        return []
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return [b for b in properties.get(MANIFEST, "").split(",") if b]


def _drop(spark: SparkSession, build: str) -> None:
    """Drop a build and, where it is an external table, its files."""
    if not spark.catalog.tableExists(build):
        return
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {build}").collect()}
    spark.sql(f"DROP TABLE {build}")
    if about.get("Type") == "EXTERNAL":
        folder = spark._jvm.org.apache.hadoop.fs.Path(about["Location"])
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_snapshot(
    df: DataFrame,
    name: str,
    stamp: str | None = None,
    built_at: Column | None = None,
    location: str | None = None,
    keep: int = 1,
) -> DataFrame:
    """Store ``df`` and make the view ``name`` show it; with ``stamp``, add the build time under that name.

    Each build is a table of its own. Once it is complete, one change of the view shows it and puts it first in the
    manifest, a property of the same view; so a reader sees the old build or the new one, never none or half of one, and
    a build that fails leaves everything as it was. After the switch builds beyond the ``keep`` before the shown one are
    dropped: a query that began on one of those kept goes on reading it. ``location`` is a folder for the tables;
    without it the catalog's warehouse holds them. One writer at a time: of two, the later switch wins, and the other's
    build is in no manifest.
    """
    if keep < 0:
        raise ValueError("keep is the number of older builds, 0 or more")
    spark = df.sparkSession
    if stamp:
        df = df.withColumn(stamp, built_at if built_at is not None else F.current_timestamp())
    build = f"{name}__{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite").format("parquet")
    if location:
        writer = writer.option("path", f"{location.rstrip('/')}/{build}")
    writer.saveAsTable(build)
    older = builds(spark, name)
    kept = ",".join([build, *older[:keep]])
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{MANIFEST}' = '{kept}') AS SELECT * FROM {build}")
    for old in older[keep:]:
        _drop(spark, old)
    return spark.table(name)
