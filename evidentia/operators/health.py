"""Health of feeds and of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.operators.ingest import age_days

# Fixed value: whole days after which a feed is stale.
STALE_DAYS = 7


def is_stale(now: Column, newest: Column) -> Column:
    return F.coalesce(age_days(now, newest) > STALE_DAYS, F.lit(False))


def feed_health(reports: DataFrame, adopted: DataFrame, now: Column) -> DataFrame:
    """reports (feed_id, status, n_entries, newest, critical) with n_adopted, stale and health."""
    r = reports.join(adopted.groupBy("feed_id").agg(F.count(F.lit(1)).alias("n_adopted")), "feed_id", "left").withColumn("n_adopted", F.coalesce("n_adopted", F.lit(0)))
    r = r.withColumn("stale", is_stale(now, F.col("newest")))
    none = F.col("critical") & (F.col("status") == "ok") & (F.col("n_entries") > 0) & (F.col("n_adopted") == 0)
    return r.withColumn("health", F.when(F.col("status") == "error", "error").when(F.col("status") == "empty", "empty").when(F.col("stale"), "stale").when(none, "no_adopt").otherwise("ok"))


def health_report(health: DataFrame) -> DataFrame:
    """One row: feeds by state, and whether the run is fatal (all failed, or all critical ones down)."""
    bad = F.col("health").isin("error", "empty", "stale", "no_adopt")
    return health.agg(
        F.count(F.lit(1)).alias("n_feeds"), F.count_if(F.col("health") == "error").alias("n_error"), F.count_if(F.col("health") == "empty").alias("n_empty"), F.count_if(F.col("health") == "stale").alias("n_stale"), F.count_if(F.col("health") == "no_adopt").alias("n_no_adopt"), F.sum("n_adopted").alias("n_adopted"),
        ((F.count_if(F.col("health") == "error") == F.count(F.lit(1))) | ((F.count_if(F.col("critical") & bad) == F.count_if("critical")) & (F.count_if("critical") > 0)) | (F.sum("n_adopted") == 0)).alias("fatal"),
    )


def report_rows(health: DataFrame) -> DataFrame:
    """Per feed its name, state and what to say about it. Optional columns: name, error."""
    has = lambda c, other: F.coalesce(F.col(c).cast("string"), other) if c in health.columns else other
    n, k = F.coalesce("n_entries", F.lit(0)).cast("string"), F.col("n_adopted").cast("string")
    note = (
        F.when(F.col("health") == "error", has("error", F.lit("unknown cause")))
        .when(F.col("health") == "empty", "no entries")
        .when(F.col("health") == "stale", F.concat(F.lit("newest entry of "), F.coalesce(F.date_format("newest", "yyyy-MM-dd"), F.lit("?"))))
        .when(F.col("health") == "no_adopt", F.concat(n, F.lit(" entries, none adopted")))
        .when(F.col("status") == "not_modified", "unchanged since the last fetch")
        .otherwise(F.concat(n, F.lit(" entries, "), k, F.lit(" adopted")))
    )
    return health.select("feed_id", has("name", F.col("feed_id")).alias("name"), "critical", F.col("health").alias("state"), (F.col("health") != "ok").alias("bad"), F.coalesce("n_entries", F.lit(0)).alias("n_entries"), "n_adopted", note.alias("note"))


def fatal_reasons(health: DataFrame) -> DataFrame:
    """One row: why the run counts as failed, an empty array if it does not."""
    down, n = F.col("health") != "ok", F.count(F.lit(1))
    vital = F.count_if("critical")
    return health.agg(F.array_compact(F.array(
        F.when((n > 0) & (F.count_if(F.col("health") == "error") == n), "no feed could be fetched"),
        F.when((vital > 0) & (F.count_if(F.col("critical") & down) == vital), F.concat(F.lit("all critical feeds down: "), vital.cast("string"))),
        F.when(F.coalesce(F.sum("n_adopted"), F.lit(0)) == 0, "no article adopted"),
    )).alias("reasons"))


def markdown(health: DataFrame, figures: dict | None = None) -> tuple[str, list[str], list[str]]:
    """(table as text, warnings, reasons to fail) of a run; the feeds are a small table."""
    rows = report_rows(health).orderBy("feed_id").collect()
    fatal = fatal_reasons(health).first()["reasons"]
    lines = ["| feed | critical | state | entries | adopted | note |", "|-|-|-|-|-|-|"]
    lines += [f"| {r['name']} | {'yes' if r['critical'] else ''} | {r['state']} | {r['n_entries']} | {r['n_adopted']} | {r['note']} |" for r in rows]
    lines += ["", *(f"{k}: {v}" for k, v in (figures or {}).items()), *(f"FAILED: {x}" for x in fatal)]
    return "\n".join(lines), [f"{r['name']}: {r['note']}" for r in rows if r["bad"]], fatal


def run_figures(articles: DataFrame) -> DataFrame:
    """One row of a run: articles, outlets of the first tier, and articles per tier."""
    tiers = articles.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.when(F.col("tier") == "T1", F.col("domain"))).alias("first"))  # a row per tier
    return tiers.agg(F.sum("n").alias("n_articles"), F.array_sort(F.flatten(F.collect_list("first"))).alias("t1_domains"), F.array_sort(F.collect_list(F.struct("tier", "n"))).alias("tiers"))


def status_line(health: Column, name: Column, n: Column) -> Column:
    return F.when(health == "ok", F.concat(name, F.lit(": "), n.cast("string"), F.lit(" articles"))).when(health == "no_adopt", F.concat(name, F.lit(": nothing adopted"))).otherwise(F.concat(name, F.lit(": "), health))


def zombies(entries: DataFrame, now: Column, feed: str = "feed_id", at: str = "published") -> DataFrame:
    newest = entries.groupBy(feed).agg(F.max(at).alias("newest"))
    return newest.withColumn("age", age_days(now, F.col("newest"))).where(F.col("age") > STALE_DAYS)


def unrated_queue(articles: DataFrame, n: int = 20) -> DataFrame:
    """The n unrated domains with most articles, each with its first title."""
    return articles.where("bloc = 'unknown' and domain <> ''").groupBy("domain").agg(F.count(F.lit(1)).alias("n_articles"), F.left(F.min_by("title", F.struct("published", "ord")), F.lit(80)).alias("sample_title")).orderBy(F.col("n_articles").desc(), "domain").limit(n)


def sources_by_tier(outlets: DataFrame) -> DataFrame:
    return outlets.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("domain")).alias("domains"))
