"""Intermediate tables that cut lineage and outlive the loss of an executor.

Iterative operators write each round as parquet below the folder that the
cluster names in ``spark.checkpoint.dir`` and read it back; nothing is kept in
one executor only.  Superseded rounds are deleted as soon as they are unused.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_OPEN: list["Scratch"] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset on a local master, a new temporary one.

    On a cluster an unset folder is an error: a machine-local folder would not be seen by the executors.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("evidentia.scratch.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="evidentia-")
    spark.conf.set("evidentia.scratch.dir", folder)
    return folder


class Scratch:
    """A folder of named intermediate tables below the shared folder."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        _OPEN.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> DataFrame:
        """Write df as table `name` and return it as read back (same schema)."""
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def keep_counted(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        """keep, and the number of rows, counted while writing."""
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name)), seen.get["n"]

    def size(self, name: str) -> int:
        """Bytes of table `name`."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()

    def drop(self, name: str = "") -> None:
        """Delete table `name`, or the whole folder."""
        try:
            jvm = self.spark._jvm
            path = jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.root)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001 - the session may have ended
            pass


def release(spark: SparkSession) -> None:
    """Let go of what finished rounds left: shuffle files and broadcasts are cleaned up once the driver no longer refers to them."""
    gc.collect()
    spark._jvm.System.gc()


@atexit.register
def _clean() -> None:
    for s in _OPEN:
        s.drop()
