"""Structured Streaming: deduplicated arrival, tumbling days, sessions, and the store merged per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from evidentia.operators.series import BEFORE, FEWEST, trailing_baseline
from evidentia.scratch import Scratch


def deduplicated(stream: DataFrame, id: str, at: str, watermark: str = "21 days") -> DataFrame:
    """The first of each id within the watermark."""
    return stream.withWatermark(at, watermark).dropDuplicatesWithinWatermark([id])


def in_time(stream: DataFrame, at: str, arrived: str, early_hours: int = 24, late_days: int = 22) -> DataFrame:
    """Rows that came neither too early nor too late for their time; a watermark alone only bounds state."""
    age = F.unix_micros(F.col(arrived).cast("timestamp")) - F.unix_micros(F.col(at).cast("timestamp"))
    return stream.where((age >= -early_hours * 3_600_000_000) & (age < late_days * 86_400_000_000))


def daily(stream: DataFrame, at: str, watermark: str = "2 days", *aggs, by: list[str] | None = None) -> DataFrame:
    return stream.withWatermark(at, watermark).groupBy(F.window(at, "1 day").alias("w"), *(by or [])).agg(*aggs)


def sessions(stream: DataFrame, key: str, at: str, gap: str = "48 hours", watermark: str = "3 days") -> DataFrame:
    return stream.withWatermark(at, watermark).groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))


def into_store(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"):
    """Every micro-batch through a merge of the store; runs over what has arrived and ends."""
    return stream.writeStream.outputMode(mode).foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def capped_sessions(rows: DataFrame, key: str, at: str, gap: str = "48 hours", cap_hours: int = 72) -> DataFrame:
    """(key, start_at, end_at, n): sessions by gap, each cut into stretches of at most cap_hours from its beginning."""
    us = F.unix_micros(F.col(at).cast("timestamp"))
    t = rows.select(key, us.alias("us"))
    whole = rows.groupBy(key, F.session_window(F.col(at).cast("timestamp"), gap).alias("w")).agg(F.unix_micros(F.min(F.col(at).cast("timestamp"))).alias("lo"), F.unix_micros(F.max(F.col(at).cast("timestamp"))).alias("hi"))
    span = cap_hours * 3_600_000_000
    whole = whole.select(F.col(key).alias("_k"), "lo", "hi")
    inside = t.join(whole, t[key].eqNullSafe(F.col("_k")) & F.col("us").between(F.col("lo"), F.col("hi")))
    cut = inside.groupBy(key, "lo", F.floor((F.col("us") - F.col("lo")) / (span + 1)).alias("part")).agg(F.min("us").alias("a"), F.max("us").alias("b"), F.count(F.lit(1)).alias("n"))
    return cut.select(key, F.timestamp_micros("a").alias("start_at"), F.timestamp_micros("b").alias("end_at"), "n")


def counted(name: str, *aggs) -> tuple[Callable[[DataFrame], DataFrame], list[dict]]:
    """(tap, seen): tap adds counters to what passes through it in a micro-batch; seen gets a dict per batch once it is written."""
    seen: list[dict] = []

    def tap(batch: DataFrame) -> DataFrame:
        note = Observation(f"{name}-{len(seen)}")
        out = batch.observe(note, *aggs)
        seen.append({"_note": note})
        return out

    return tap, seen


def figures(seen: list[dict]) -> list[dict]:
    """The counters of the batches so far."""
    return [x["_note"].get for x in seen]


def trailing_store(path: str, value: str = "index", date: str = "date", before: int = BEFORE, fewest: int = FEWEST) -> Callable[[DataFrame, int], None]:
    """A merge for into_store: a batch's days join the series at path (a new day over an old one), and baseline and ratio are taken anew."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        new = batch.groupBy(date).agg(F.max(value).alias(value))
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            held = spark.read.parquet(path).select(date, value)
            new = new.unionByName(held.join(new.select(date), date, "left_anti"))
        whole = Scratch(spark, "series").keep(trailing_baseline(new, value, date, before=before, fewest=fewest), "merged")  # what is overwritten is read here
        whole.write.mode("overwrite").parquet(path)

    return merge
