"""Feed entries to articles: projection, first reason for dropping, deduplication by rank, entry dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.functions.text import clean_title, detect_lang, normalize_text, sha1_nul, strip_html
from evidentia.operators.policy import tier_weight

# Age bounds in whole days.
MAX_AGE_DAYS, MIN_AGE_DAYS = 21, -1


def age_days(now: Column, at: Column) -> Column:
    """Whole days, rounded down (a moment ago is 0, a moment ahead is -1)."""
    return F.floor((F.unix_micros(now) - F.unix_micros(at)) / F.lit(86_400_000_000))


def in_age(now: Column, at: Column) -> Column:
    return age_days(now, at).between(MIN_AGE_DAYS, MAX_AGE_DAYS)


def passes_gate(title: Column, summary: Column, subject: str, core: str, context: str, negative: str) -> Column:
    """The reason a text is off topic, null if it is on topic; the four patterns are policy. Context counts in the title only."""
    text = F.concat_ws(" ", title, summary)
    return F.when(text.rlike(negative), "negative").when(text.rlike(core), None).when(~text.rlike(subject), "no_subject").when(title.rlike(context), None).otherwise("no_topic")


def entry_datetime(*candidates: Column) -> Column:
    """The first of several date texts that can be read."""
    return F.coalesce(*(F.try_to_timestamp(c) for c in candidates))


def newest_entry(entries: DataFrame, feed: str = "feed_id", at: str = "published") -> DataFrame:
    return entries.groupBy(feed).agg(F.max(at).alias("newest"))


def host_of(url: Column) -> Column:
    """Host of a url in lower case, without port and user."""
    return F.lower(F.nullif(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def entry_source(kind: Column, feed_domain: Column, source_href: Column, link: Column, aggregator_host: str) -> Column:
    """The outlet's host: the feed's own, else the entry's source, else its link unless that is the aggregator's."""
    by_link = host_of(link)
    return F.when(kind == "native", feed_domain).otherwise(F.coalesce(host_of(source_href), F.when(~by_link.contains(aggregator_host), by_link), F.lit("")))


def normalize_entries(entries: DataFrame, now: Column, gate: dict[str, str] | None, hedge: str, official: str, script_notices: tuple[str, ...], aggregator_host: str, syndicators: list[str], noise: list[str]) -> DataFrame:
    """Entries (title, summary, link, source_href, source_title, dates, and the feed's kind, lang, source_domain, needs_filter) as articles with a drop_reason, null for those kept.

    syndicators and noise are short policy lists of domains.
    """
    def ends(host: Column, domains: list[str]) -> Column:
        hit = F.lit(False)
        for d in domains:
            hit = hit | (host == d) | F.endswith(host, F.lit("." + d))
        return hit

    e = entries.withColumn("host", entry_source(F.col("kind"), F.col("feed_domain"), F.col("source_href"), F.col("link"), aggregator_host))
    e = e.withColumn("title", clean_title(F.col("title"), F.coalesce("source_title", F.lit(""))))
    e = e.withColumn("summary", F.when(F.col("kind") == "aggregator", "").otherwise(F.left(strip_html("summary"), F.lit(400))))
    e = e.withColumn("published", F.coalesce("published", now))
    e = e.withColumn("lang", F.when(F.col("kind") == "aggregator", detect_lang("title")).otherwise(F.col("feed_lang")))
    text = F.concat_ws(" ", "title", "summary")
    notice = F.lit(False)
    for n in script_notices:
        notice = notice | F.col("title").contains(n)
    off = F.lit(None).cast("string") if gate is None else F.when(F.col("needs_filter"), passes_gate(F.col("title"), F.col("summary"), **gate))
    reason = F.coalesce(
        F.when(ends(F.col("host"), syndicators), "syndicator"),
        F.when(ends(F.col("host"), noise), "noise_domain"),
        F.when(F.length("title") < 10, "no_title"),
        F.when(notice, "js_placeholder"),
        F.when(~in_age(now, F.col("published")), "too_old"),
        off,
    )
    return e.select("*", F.substring(sha1_nul(normalize_text("title")), 1, 16).alias("id"), text.rlike(hedge).alias("hedged"), text.rlike(official).alias("primary_cited"), reason.alias("drop_reason"))


def drop_counts(normalized: DataFrame) -> DataFrame:
    return normalized.where("drop_reason is not null").groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))


def best_of_id(articles: DataFrame, id: str = "id", domain: str = "source_domain", tier: str = "tier", order: str = "entry_ord") -> DataFrame:
    """One row per id: with a domain before without, the heavier tier, the earlier entry; `slot` is the id's first entry."""
    per_id = Window.partitionBy(id)
    rank = per_id.orderBy(F.coalesce(F.col(domain) != "", F.lit(False)).desc(), tier_weight(F.col(tier)).desc(), F.col(order))
    return articles.withColumn("_rn", F.row_number().over(rank)).withColumn("slot", F.min(order).over(per_id)).where("_rn = 1").drop("_rn")
