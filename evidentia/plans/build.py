"""The whole build: landed entries to graded events, merged into the store; and the bulletin series.

Every stage is lazy but the iterative ones; policy (feeds, outlets, aliases, gate, entities) comes in as arguments.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.operators import credibility as C
from evidentia.operators import health as H
from evidentia.operators import ingest as I
from evidentia.operators import series as S
from evidentia.operators import store as ST
from evidentia.operators.linkage import cluster_articles
from evidentia.operators.policy import classify
from evidentia.operators.revisions import dedupe_revisions
from evidentia.scratch import Scratch


@dataclass
class Policy:
    """What a deployment decides; everything else is the engine's."""

    outlets: DataFrame  # domain, tier, bloc, name, bias
    entities: dict[str, list[str]]
    anchors: list[str]
    aliases: DataFrame | None = None  # alias, domain
    gate: dict[str, str] | None = None  # subject, core, context, negative
    hedge: str = "(?i)reportedly|allegedly|unconfirmed"
    official: str = "(?i)ministry|official statement"
    script_notices: tuple[str, ...] = ("without JavaScript enabled", "Enable JavaScript")
    aggregator_host: str = "aggregate.test"
    syndicators: list[str] = field(default_factory=list)
    noise: list[str] = field(default_factory=list)
    stop_words: list[str] | None = None
    affiliates: DataFrame | None = None  # domain, affiliate: outlets of one group count as one voice
    blocked: tuple[str, ...] = ()  # ids of events taken down


def articles_of(entries: DataFrame, feeds: DataFrame, policy: Policy, now: Column) -> tuple[DataFrame, DataFrame]:
    """(articles, dropped): entries (feed_id, entry_ord, title, summary, link, source_href, source_title, published) of feeds (id, kind, lang, source_domain, needs_filter)."""
    f = feeds.select(F.col("id").alias("feed_id"), "kind", F.col("lang").alias("feed_lang"), F.col("source_domain").alias("feed_domain"), "needs_filter")
    rows = I.normalize_entries(entries.join(f, "feed_id"), now, policy.gate, policy.hedge, policy.official, policy.script_notices, policy.aggregator_host, policy.syndicators, policy.noise)
    kept = classify(rows.where("drop_reason is null").withColumn("source_domain", F.col("host")), policy.outlets, aliases=policy.aliases)
    kept = kept.withColumn("source_domain", F.col("domain")).withColumn("source_name", F.when((F.col("name") == F.col("domain")) & (F.coalesce("source_title", F.lit("")) != ""), F.col("source_title")).otherwise(F.col("name")))
    best = I.best_of_id(kept)
    revised = dedupe_revisions(best)
    final = revised.where("id = kept_id").select("id", "first_published")
    return best.join(final, "id"), I.drop_counts(rows).unionByName(revised.where("id <> kept_id").groupBy(F.lit("revision").alias("drop_reason")).agg(F.count(F.lit(1)).alias("n")))


def events_of(spark: SparkSession, articles: DataFrame, policy: Policy) -> DataFrame:
    """Graded events with their article ids."""
    scratch = Scratch(spark, "build")
    articles = scratch.keep(articles.withColumn("ord", F.col("entry_ord")), "articles")
    groups = cluster_articles(spark, articles.select("id", "title", "summary", "lang", "published"), policy.entities, policy.anchors, policy.stop_words)
    members = scratch.keep(articles.join(groups, "id"), "members")
    verdict = C.evaluate(members, affiliates=policy.affiliates)
    verdict = verdict.select("event_id", F.struct(*(c for c in verdict.columns if c != "event_id")).alias("credibility"))
    out = C.assemble(members).join(verdict, "event_id").join(C.pick_headline(members), "event_id")
    return out.drop("event_id")


def whole_store(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Current events over previous ones, of whatever age; a verdict over more articles stays."""
    return ST.drop_ghosts(ST.upsert(previous, current, n="credibility.n_articles"), current)


def merged_store(previous: DataFrame, current: DataFrame, now: Column, blocked: list[str] | None = None) -> DataFrame:
    """The rolling store after this build; an article in two events is an error."""
    return ST.prune(whole_store(previous, current), now, blocked=blocked)


def run_build(spark: SparkSession, entries: DataFrame, feeds: DataFrame, reports: DataFrame, policy: Policy, now: Column, store: str) -> dict:
    """One build into the folder `store`: events, archive by month, feed health. Returns the figures of the run."""
    articles, dropped = articles_of(entries, feeds, policy, now)
    articles = Scratch(spark, "build").keep(articles, "kept")
    current = Scratch(spark, "build").keep(events_of(spark, articles, policy), "current")
    path = f"{store}/events"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    held = spark.read.parquet(path) if jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path) else current.limit(0)
    whole = Scratch(spark, "build").keep(whole_store(held, current), "whole")
    events = Scratch(spark, "build").keep(ST.prune(whole, now, blocked=list(policy.blocked)), "merged")
    clash = ST.shared_articles(events).limit(1).count()
    if clash:
        raise RuntimeError("an article is in two events")
    written = ST.write_if_changed(events, path)
    months = ST.write_archive(whole, f"{store}/archive", blocked=list(policy.blocked))
    health = H.feed_health(reports, articles.select("feed_id"), now)
    ST.write_if_changed(health, f"{store}/feeds", ("newest", "n_entries", "n_adopted"))
    figures = {"events": events.count(), "articles": articles.count(), "written": written, "dropped": {r["drop_reason"]: r["n"] for r in dropped.collect()}, "grades": {r["grade"]: r["count"] for r in events.groupBy("credibility.grade").count().collect()}, "months": months}
    return figures | {"fatal": H.health_report(health).first()["fatal"]}


def run_bulletins(pages: DataFrame, html: str, held: DataFrame) -> tuple[DataFrame, dict]:
    """(series with index, baseline and ratio; counts of pages added, skipped, rejected, failed (nothing fetched), and, where pages tell the date the list gave (listed), mismatched)."""
    parsed = S.parse_bulletin(pages, html)
    seen = pages.agg(F.count_if(F.col(html).isNull()).alias("failed")).first()
    good = parsed.where("parse_ok")
    new = S.new_records(good, held)
    counts = {"rejected": parsed.where("not parse_ok").count(), "added": new.count()}
    counts["skipped"] = good.count() - counts["added"]
    counts["failed"] = seen["failed"]
    counts["mismatched"] = S.bulletin_dates(pages, html).where("date is not null and listed is not null and date <> listed").count() if "listed" in pages.columns else 0
    rows = held.select(*new.columns).unionByName(new)
    series = rows.withColumn("index", S.tension_index(F.col("aircraft"), F.col("navy_ships"), F.col("official_ships")))
    return S.trailing_baseline(series), counts
