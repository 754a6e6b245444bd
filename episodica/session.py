"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Joins carry no broadcast hints: Spark broadcasts a side only below this size and sorts and merges otherwise.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.ui.enabled": "false",
    # No call-site capture per column expression: it doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "episodica", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the engine's settings. Without ``master`` the launcher (spark-submit) decides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = _local_scratch()
    return root.rstrip("/")


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="episodica-")


class Scratch:
    """Intermediate tables of one job, written under the shared folder so that a lost executor costs only its tasks.

    What ``clear`` has not deleted before goes when the driver's JVM ends, as lazy results may read it until then.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{scratch_root(spark)}/episodica-{uuid.uuid4().hex}"
        self._marked = False

    def _folder(self):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: cuts the lineage and gives later joins its real size."""
        target = f"{self.path}/{name}.parquet"
        df.write.parquet(target)
        if not self._marked:
            files, folder = self._folder()
            self._marked = files.deleteOnExit(folder)
        return self.spark.read.schema(df.schema).parquet(target)

    def clear(self) -> None:
        """Delete what was saved; results that still read from it must have been written elsewhere."""
        files, folder = self._folder()
        files.delete(folder, True)
        self._marked = False
