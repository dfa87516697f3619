"""The event store: upsert, ghosts, window, archive by month, change detection, invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.scratch import Scratch

# Fixed value: days of the rolling window.
WINDOW_DAYS = 14


def upsert(previous: DataFrame, current: DataFrame, id: str = "id", n: str = "n_articles", keep: tuple[str, ...] = ("credibility",)) -> DataFrame:
    """Current rows in place of previous ones, nulls included; where the old row counted more articles (n may be a field of a struct), the columns `keep` stay the old ones."""
    p, c = previous.alias("p"), current.alias("c")
    gone, old = F.col(f"c.{id}").isNull(), F.col(f"p.{n}") > F.col(f"c.{n}")
    cols = [F.when(gone | old if x in keep else gone, F.col(f"p.{x}")).otherwise(F.col(f"c.{x}")).alias(x) for x in current.columns]
    return p.join(c, F.col(f"p.{id}") == F.col(f"c.{id}"), "full_outer").select(*cols)


def drop_ghosts(merged: DataFrame, current: DataFrame, id: str = "id", members: str = "articles") -> DataFrame:
    """Without old events that share an article with a current one under another id, or that have none."""
    now = current.select(F.col(id).alias("_now"))
    held = current.select(F.explode(members).alias("_a")).distinct()
    old = merged.join(now, merged[id] == now["_now"], "left_anti")
    ghosts = old.select(id, F.explode(members).alias("_a")).join(held, "_a", "left_semi").select(id).distinct()
    keep = merged.join(now, merged[id] == now["_now"], "left_semi").unionByName(old.where(F.size(members) > 0).join(ghosts, id, "left_anti"))
    return keep


def prune(events: DataFrame, now: Column, days: int = WINDOW_DAYS, blocked: list[str] | None = None, last: str = "last_seen", id: str = "id") -> DataFrame:
    out = events.where(F.unix_micros(F.col(last)) >= F.unix_micros(now) - days * 86_400_000_000)
    return out.where(~F.col(id).isin(blocked)) if blocked else out


def by_month(events: DataFrame, at: str = "first_seen") -> DataFrame:
    return events.withColumn("month", F.date_format(at, "yyyy-MM"))


def upsert_months(held: DataFrame, events: DataFrame, id: str = "id", members: str = "articles", blocked: list[str] | None = None) -> DataFrame:
    """The months of events, month by month: what is held of them and the events over it, without blocked ones.

    held and events have the same columns, month among them. A held event goes only if an event of its month has its id,
    or one of its articles, or if it has none.
    """
    mine = events.select("month", F.col(id).alias("_id")).distinct()
    arts = events.select("month", F.explode(members).alias("_a")).distinct()
    kept = held.join(events.select("month").distinct(), "month", "left_semi").where(F.size(members) > 0)
    kept = kept.join(mine, (kept["month"] == mine["month"]) & (kept[id] == mine["_id"]), "left_anti")
    ghosts = kept.select("month", id, F.explode(members).alias("_a")).join(arts, ["month", "_a"], "left_semi").select("month", id).distinct()
    out = events.unionByName(kept.join(ghosts, ["month", id], "left_anti").select(*events.columns))
    return out.where(~F.col(id).isin(blocked)) if blocked else out


def write_archive(events: DataFrame, path: str, at: str = "first_seen", id: str = "id", members: str = "articles", blocked: list[str] | None = None) -> list[str]:
    """Events merged into the archive's months; other months are not touched. An article in two events of a month is an error. Returns the months written."""
    spark, scratch = events.sparkSession, Scratch(events.sparkSession, "archive")
    new = by_month(events, at)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    held = new.limit(0)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        held = spark.read.schema(new.schema).parquet(path).select(*new.columns)
    merged = scratch.keep(upsert_months(held, new, id, members, blocked), "merged")  # what is overwritten below is read here
    clash = merged.select("month", id, F.explode(members).alias("_a")).groupBy("month", "_a").agg(F.min(id).alias("lo"), F.max(id).alias("hi")).where("lo <> hi").limit(1).collect()
    if clash:
        raise RuntimeError(f"article {clash[0]['_a']} is in two events of {clash[0]['month']}")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    return sorted(r["month"] for r in merged.select("month").distinct().collect())  # one value per month


def _without(fields: tuple[str, ...]):
    return lambda x: x.dropFields(*fields)


def fingerprint(df: DataFrame, volatile: tuple[str, ...] = (), nested: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(n, digest): independent of order, without volatile columns; nested names volatile fields of the structs in array columns."""
    for c, fields in (nested or {}).items():
        df = df.withColumn(c, F.transform(c, _without(fields)))
    cols = sorted(c for c in df.columns if c not in volatile)
    h = F.xxhash64(*(F.to_json(F.struct(c)) for c in cols))
    return df.select(h.alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("digest"))


def shared_articles(events: DataFrame, id: str = "id", members: str = "articles") -> DataFrame:
    """(article, n_events) of articles in more than one event."""
    return events.select(id, F.explode(members).alias("article")).groupBy("article").agg(F.count_distinct(id).alias("n_events")).where("n_events > 1")


def write_if_changed(df: DataFrame, path: str, volatile: tuple[str, ...] = ()) -> bool:
    """Write parquet unless what is there has the same fingerprint; True if it was written. A corrupt table is an error, not empty."""
    spark = df.sparkSession
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        old = spark.read.parquet(path)
        if sorted(old.columns) == sorted(df.columns) and fingerprint(old, volatile).first() == fingerprint(df, volatile).first():
            return False
    df.write.mode("overwrite").parquet(path)
    return True
