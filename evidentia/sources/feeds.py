"""Sources and sinks: landed feed entries, JSON stores, state of conditional fetches.

Fetching from the network is outside the engine; a fetcher lands entries as JSON
lines below a folder per feed, and keeps its cache state as a small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "title string, summary string, link string, source_href string, source_title string, published_text string, updated_text string, created_text string, feed_id string, feed_ord int, entry_ord bigint"
STATE = "feed_id string, etag string, last_modified string, fetched_at timestamp"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_entries(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    df = spark.read.schema(ENTRY).json(path)
    return df.where(F.col("feed_id").isin(only)) if only else df


def stream_entries(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(ENTRY).json(path)


def read_json(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """A JSON store; an empty table where none is. What cannot be parsed is an error."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


def write_json(df: DataFrame, path: str) -> None:
    """Written as a whole: the commit protocol renames only what is complete."""
    df.write.mode("overwrite").json(path)


def merge_state(state: DataFrame, seen: DataFrame) -> DataFrame:
    """The newest state per feed."""
    both = state.unionByName(seen)
    return both.groupBy("feed_id").agg(F.max_by(F.struct("etag", "last_modified", "fetched_at"), "fetched_at").alias("s")).select("feed_id", "s.*")


def read_month(spark: SparkSession, path: str, month: str) -> DataFrame:
    """One month of an archive: only its folder is read."""
    return spark.read.parquet(path).where(F.col("month") == month)
