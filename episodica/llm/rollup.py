"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are sums of signed deltas, so inserts, deletes and revised counts
never need the documents again. A batch of changes commits under its id exactly once: its deltas are written aside and
then renamed to the batch's folder, which fails where that exists. So of two writers of one id one commits, and the
other, like everyone who sends the id again, is told so if its deltas are the same; other deltas under a committed id
raise. A commit that broke off leaves no batch. The folder must be in a file system that renames folders in one step and
doesn't replace one (HDFS, a local disk), which object stores don't.

Edge cases: null counts are 0; null source, language or version are groups of their own; repeated rows in a batch count
each; an empty batch commits and changes nothing; totals whose documents and tokens are all back at 0 are left out; an
unknown kind of change fails the commit.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm.common import exists

KEYS = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, docs long, tokens long"


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums per group of changes: columns change (insert, delete, revise), KEYS, tokens_before, tokens."""
    before, after = (F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in ("tokens_before", "tokens"))
    known = F.col("change").isin("insert", "delete", "revise")
    kind = F.when(known, F.col("change")).otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("change", F.lit("null")))))
    docs = F.when(kind == "insert", 1).when(kind == "delete", -1).otherwise(0).cast("long")
    tokens = F.when(kind == "insert", after).when(kind == "delete", -before).otherwise(after - before)
    return changes.select(*KEYS, docs.alias("docs"), tokens.alias("tokens")).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


class TokenRollup:
    """A rollup stored in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _batch(self, batch_id: str) -> str:
        return f"{self.path}/batch-{hashlib.sha256(batch_id.encode()).hexdigest()}"

    def committed(self, batch_id: str) -> bool:
        return exists(self.spark, f"{self._batch(batch_id)}/_SUCCESS")

    def _digest(self, path: str) -> tuple:
        """What the deltas in a folder add up to, whatever their order and files."""
        rows = self.spark.read.schema(DELTA).parquet(path)
        hashed = [F.sum(F.xxhash64(F.lit(seed), *rows.columns).cast("decimal(38,0)")) for seed in (1, 2)]
        return tuple(rows.agg(F.count("*"), *hashed).first())

    def _rename(self, source: str, target: str) -> bool:
        """Rename a folder unless the target exists."""
        fs = self.spark._jvm.org.apache.hadoop.fs
        old, new = fs.Path(source), fs.Path(target)
        none = self.spark.sparkContext._gateway.new_array(fs.Options.Rename, 0)
        try:
            fs.FileContext.getFileContext(new.toUri(), self.spark._jsc.hadoopConfiguration()).rename(old, new, none)
        except Py4JJavaError:
            if not exists(self.spark, target):
                raise
            return False
        return True

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch of changes; False if the same deltas are committed under that id already."""
        aside, batch = f"{self.path}/aside-{uuid.uuid4().hex}", self._batch(batch_id)
        deltas(changes).write.parquet(aside)
        if not self.committed(batch_id) and self._rename(aside, batch):
            return True
        same = self._digest(aside) == self._digest(batch)
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(aside)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        if not same:
            raise ValueError(f"batch {batch_id} is committed with other changes")
        return False

    def _complete(self, prefix: str) -> list[str]:
        """Folders of committed batches or bases, by name."""
        jvm = self.spark._jvm.org.apache.hadoop.fs
        fs = jvm.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(jvm.Path(self.path)):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(jvm.Path(self.path)) if s.isDirectory()]
        return sorted(n for n in names if n.startswith(prefix) and fs.exists(jvm.Path(f"{self.path}/{n}/_SUCCESS")))

    def _parts(self) -> tuple[str | None, list[str]]:
        """The newest base and the batches that it doesn't cover."""
        bases, batches = self._complete("base-"), self._complete("batch-")
        if not bases:
            return None, batches
        covered = {n for r in self.spark.read.text(f"{self.path}/{bases[-1].replace('base', 'cover')}").collect() for n in json.loads(r[0])}
        return bases[-1], [b for b in batches if b not in covered]

    def totals(self) -> DataFrame:
        """KEYS, docs, tokens over all committed batches."""
        base, batches = self._parts()
        paths = [f"{self.path}/{n}" for n in ([base] if base else []) + batches]
        rows = self.spark.read.schema(DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)
        return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs != 0 or tokens != 0")

    def compact(self) -> None:
        """Fold all committed batches into a new base. Batch folders stay as the record of what was committed."""
        number = len(self._complete("base-"))
        names = json.dumps(self._complete("batch-"))
        totals = self.totals()
        self.spark.createDataFrame([(names,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/cover-{number:08d}")
        totals.write.mode("overwrite").parquet(f"{self.path}/base-{number:08d}")
