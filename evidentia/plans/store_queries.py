"""Queries of the store, of scalar functions, of quality and run reports, and of streams, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from evidentia.functions import text as T
from evidentia.operators import health as H
from evidentia.operators import quality as Q
from evidentia.operators import store as ST
from evidentia.operators import views as V
from evidentia.plans.reference_queries import _CL, _HEALTH, _clusters, _health
from evidentia.scratch import Scratch
from evidentia.sources.tables import norm_id, table
from evidentia.streaming import events as EV

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return put


# ---------------------------------------------------------------- store

_MONTHS = r"""x as (select row_id as id, batch_no, strftime(first_seen, '%Y-%m') as month, list_distinct(list_filter(list_transform(coalesce(articles, []), lambda y: nullif(lower(trim(y.id, ' ' || chr(9))), '')), lambda i: i is not null)) as arts from news_event where first_seen is not null),
 held as (select * from x where batch_no < 9), new as (select * from x where batch_no = 9), na as (select distinct month, unnest(arts) as a from new), ha as (select id, month, unnest(arts) as a from held),
 kept as (select id, month from held where month in (select month from new) and len(arts) > 0 and not exists (select 1 from ha join na using (month, a) where ha.id = held.id))"""


def _months(spark, d):
    arts = F.coalesce(F.array_distinct(F.filter(F.transform("articles.id", norm_id), lambda i: i.isNotNull())), F.array().cast("array<string>"))
    return table(spark, d, "news_event").where("first_seen is not null").select(F.col("row_id").alias("id"), "batch_no", F.date_format("first_seen", "yyyy-MM").alias("month"), arts.alias("articles"))


@query("archive_upsert", f"with {_MONTHS} select id, month from new union all select id, month from kept")
def archive_upsert(spark, d):
    x = _months(spark, d)
    held, new = x.where("batch_no < 9").drop("batch_no"), x.where("batch_no = 9").drop("batch_no")
    return ST.upsert_months(held, new).select("id", "month")


@query("archive_order", "select row_id, strftime(first_seen, '%Y-%m') as month, row_number() over (partition by strftime(first_seen, '%Y-%m') order by last_seen desc nulls last, row_id) as rank from news_event where first_seen is not null")
def archive_order(spark, d):
    e = ST.by_month(table(spark, d, "news_event").where("first_seen is not null"), "first_seen")
    return e.select("row_id", "month", F.row_number().over(Window.partitionBy("month").orderBy(F.col("last_seen").desc_nulls_last(), "row_id")).alias("rank"))


@query("upsert_nulls", "with p as (select row_id, headline, batch_no from news_event where row_id % 3 <> 0), c as (select row_id, case when row_id % 2 = 0 then headline end as headline, batch_no - 1 as batch_no from news_event where row_id % 3 <> 1) select coalesce(c.row_id, p.row_id) as row_id, case when c.row_id is null then p.headline else c.headline end as headline, case when c.row_id is null or p.batch_no > c.batch_no then p.batch_no else c.batch_no end as batch_no from p full join c on p.row_id = c.row_id")
def upsert_nulls(spark, d):
    e = table(spark, d, "news_event")
    p = e.where("row_id % 3 <> 0").select("row_id", "headline", "batch_no")
    c = e.where("row_id % 3 <> 1").select("row_id", F.when(F.col("row_id") % 2 == 0, F.col("headline")).alias("headline"), (F.col("batch_no") - 1).alias("batch_no"))
    return ST.upsert(p, c, "row_id", "batch_no", ("batch_no",))


# ---------------------------------------------------------------- scalar functions

_LABELS = "|".join(T.Furniture().labels)


@query("title_furniture", rf"""with a as (select entry_ord, trim(coalesce(title, '')) x from article), b as (select entry_ord, trim(regexp_replace(x, '^(?:【[^】]*】|\[[^\]]*\]|(?:{_LABELS})／)+', '')) t from a),
 c as (select entry_ord, t, regexp_extract(t, '(?s)^(.*)[|｜]([^|｜]*)$', 1) bh, regexp_extract(t, '(?s)^(.*)[|｜]([^|｜]*)$', 2) bt, regexp_extract(t, '(?s)^(.*)[\s\x0b][\-–—][\s\x0b]([^\-–—]*)$', 1) dh, regexp_extract(t, '(?s)^(.*)[\s\x0b][\-–—][\s\x0b]([^\-–—]*)$', 2) dt from b),
 e as (select entry_ord, t, case when length(bt) between 1 and 20 then trim(bh) when length(dt) between 2 and 25 and not regexp_matches(dt, '[^A-Za-z.\s\x0b]') then trim(dh) else t end as cut from c) select entry_ord, case when length(cut) > length(t) - length(cut) then cut else t end as bare from e""")
def title_furniture(spark, d):
    return table(spark, d, "article").select("entry_ord", T.strip_furniture("title").alias("bare"))


@query("title_figures", r"with a as (select entry_ord, regexp_replace(coalesce(title, ''), '(?:19|20)[0-9]{2}', ' ', 'g') t from article) select entry_ord, list_sort(list_distinct(list_filter(list_transform(list_filter(regexp_extract_all(t, '[0-9.,]+'), lambda x: regexp_full_match(x, '[0-9]{1,3}')), lambda x: x::int), lambda n: n between 2 and 999))) as nums from a")
def title_figures(spark, d):
    return table(spark, d, "article").select("entry_ord", T.extract_numbers("title").alias("nums"))


@query("event_gaps", "with g as (select row_id, first_seen s, last_seen e, lag(first_seen) over w ps, lag(last_seen) over w pe from news_event window w as (partition by headline_lang order by row_id)) select row_id, round(greatest(0, (epoch_us(greatest(s, ps)) - epoch_us(least(e, pe))) / 3.6e9), 6) as hours from g where ps is not null and pe is not null and s is not null and e is not null")
def event_gaps(spark, d):
    w = Window.partitionBy("headline_lang").orderBy("row_id")
    e = table(spark, d, "news_event").select("row_id", F.col("first_seen").alias("s"), F.col("last_seen").alias("e"), F.lag("first_seen").over(w).alias("ps"), F.lag("last_seen").over(w).alias("pe")).dropna()
    return e.select("row_id", F.round(T.gap_hours(F.col("s"), F.col("e"), F.col("ps"), F.col("pe")), 6).alias("hours"))


@query("copy_containment", "with a as (select row_id, list_distinct(list_filter(list_transform(coalesce(articles, []), lambda x: x.source_domain), lambda i: i is not null)) x, list_distinct(list_filter(coalesce(langs, []), lambda i: i is not null)) y, list_distinct(list_filter(list_transform(coalesce(articles, []), lambda x: x.lang), lambda i: i is not null)) z from news_event) select row_id, case when len(y) > 0 and len(z) > 0 then len(list_intersect(y, z)) / least(len(y), len(z)) else 0 end as share from a")
def copy_containment(spark, d):
    none = lambda c: F.coalesce(F.array_distinct(F.filter(c, lambda i: i.isNotNull())), F.array().cast("array<string>"))
    e = table(spark, d, "news_event").select("row_id", none(F.col("langs")).alias("y"), none(F.col("articles.lang")).alias("z"))
    return e.select("row_id", T.containment(F.col("y"), F.col("z")).alias("share"))


@query("error_lines", "select event_id, left(regexp_replace(event_type || ': ' || props, '0x[0-9a-fA-F]{4,}', '0x…', 'g'), 200) as line from events where event_type = 'error'")
def error_lines(spark, d):
    return table(spark, d, "events").where("event_type = 'error'").select("event_id", T.short_error(F.col("event_type"), F.col("props")).alias("line"))


@query("iso_times", "select entry_ord, strftime(published at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') as at from article where published is not null")
def iso_times(spark, d):
    return table(spark, d, "article").where("published is not null").select("entry_ord", T.iso(F.col("published")).alias("at"))


@query("number_conflicts", "with n as (select entry_ord, feed_id, list_distinct(regexp_extract_all(coalesce(title, ''), '[0-9]+')) x from article), p as (select entry_ord, x, lag(x) over (partition by feed_id order by entry_ord) y from n) select entry_ord, len(x) > 0 and len(y) > 0 and not list_has_any(x, y) as conflict from p where y is not null")
def number_conflicts(spark, d):
    w = Window.partitionBy("feed_id").orderBy("entry_ord")
    n = table(spark, d, "article").select("entry_ord", "feed_id", F.array_distinct(F.regexp_extract_all(F.coalesce("title", F.lit("")), F.lit("[0-9]+"), F.lit(0))).alias("x"))
    return n.withColumn("y", F.lag("x").over(w)).where("y is not null").select("entry_ord", T.numbers_conflict(F.col("x"), F.col("y")).alias("conflict"))


@query("event_filter_text", "select row_id from news_event where credibility.grade in ('A', 'B', 'C') and list_contains(langs, 'en') and (contains(lower(headline), 'frigate') or len(list_filter(articles, lambda x: contains(lower(x.title), 'frigate') or contains(lower(x.source_domain), 'frigate'))) > 0)")
def event_filter_text(spark, d):
    return V.event_filter(table(spark, d, "news_event"), ["A", "B", "C"], "en", "Frigate", entities="langs").select("row_id")


@query("article_output", "select entry_ord, coalesce(case tier when 'T1' then 'wire' when 'TA' then 'analysis' end, tier) as tier_label, coalesce(case bloc when 'independent' then 'free' end, bloc) as bloc_label, list_filter([lang, 'n:' || entry_ord], lambda x: x is not null and not starts_with(x, 'n:')) as entities from article")
def article_output(spark, d):
    labels = lambda rows: spark.createDataFrame(rows, "code string, label string")
    a = table(spark, d, "article").select("entry_ord", "tier", "bloc", F.array_compact(F.array("lang", F.concat(F.lit("n:"), F.col("entry_ord").cast("string")))).alias("signature"))
    return V.article_output(a, labels([("T1", "wire"), ("TA", "analysis")]), labels([("independent", "free")])).select("entry_ord", "tier_label", "bloc_label", "entities")


@query("entity_chips", "select row_id, list_slice(list_distinct_order, 1, 3) as chips from (select row_id, list_reverse(list_reduce(list_concat([[]::varchar[]], list_transform(list_filter(list_transform(coalesce(articles, []), lambda x: x.lang), lambda y: y is not null), lambda y: [y])), lambda acc, v: case when list_contains(acc, v[1]) then acc else list_concat(v, acc) end)) as list_distinct_order from news_event)")
def entity_chips(spark, d):
    e = table(spark, d, "news_event").select("row_id", F.transform(F.filter(F.coalesce(F.col("articles.lang"), F.array().cast("array<string>")), lambda x: x.isNotNull()), lambda x: F.array(x)).alias("l"))
    return e.select("row_id", V.chips(F.col("l"), 3).alias("chips"))


# ---------------------------------------------------------------- quality and run reports

@query("quality_gate", f"with {_CL}, j as (select a.vec_id, count(*) filter (a.cluster = b.cluster and a.label = b.label) both_, count(*) filter (a.cluster = b.cluster) c, count(*) filter (a.label = b.label) l from cl a, cl b group by 1), r as (select avg(both_ / c) as p, avg(both_ / l) as q from j), t as (select cluster, label, count(*) n from cl group by 1, 2), m as (select cluster, arg_max(label, (n, label)) majority, sum(n) size from t group by 1), o as (select coalesce(sum(n), 0)::bigint k from t join m using (cluster) where label <> majority and size > 1), f as (select sum(n - 1)::bigint k from (select label, count(distinct cluster) n from cl group by 1)) select round(2 * p * q / (p + q), 9) as f1, o.k as contaminated, f.k as fragments, 2 * p * q / (p + q) >= 0.8 and o.k <= 2 and f.k <= 6 as passed from r, o, f")
def quality_gate(spark, d):
    return Q.quality_row(_clusters(spark, d)).withColumn("f1", F.round("f1", 9))


@query("feed_report_rows", f"with {_HEALTH} select feed_id, health as state, health <> 'ok' as bad, case when health = 'empty' then 'no entries' when health = 'stale' then 'newest entry of ' || strftime(newest at time zone 'UTC', '%Y-%m-%d') when health = 'no_adopt' then n_entries || ' entries, none adopted' else n_entries || ' entries, ' || n_adopted || ' adopted' end as note from he")
def feed_report_rows(spark, d):
    return H.report_rows(_health(spark, d)).select("feed_id", "state", "bad", "note")


@query("tier_figures", "with t as (select tier, count(*) n from article group by 1) select sum(n)::bigint as n_articles, (select list_sort(list(distinct source_domain)) from article where tier = 'T1' and source_domain is not null) as t1_domains from t")
def tier_figures(spark, d):
    return H.run_figures(table(spark, d, "article").withColumn("domain", F.col("source_domain"))).select("n_articles", "t1_domains")


# ---------------------------------------------------------------- streams

@query("sessions_capped", "with g as (select user_id, ts, case when epoch_us(ts) - epoch_us(lag(ts) over w) >= 48 * 3600000000::bigint then 1 else 0 end as cut from events window w as (partition by user_id order by ts)), s as (select user_id, ts, sum(cut) over (partition by user_id order by ts rows unbounded preceding) no from g), p as (select *, (epoch_us(ts) - min(epoch_us(ts)) over (partition by user_id, no)) // (72 * 3600000000::bigint + 1) part from s) select user_id, min(ts) as start_at, count(*) as n from p group by user_id, no, part")
def sessions_capped(spark, d):
    e = table(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))
    return EV.capped_sessions(e, "user_id", "at").select("user_id", F.col("start_at").cast("timestamp_ntz").alias("start_at"), "n")


def _stream(spark, d, name):
    src = table(spark, d, name)
    return spark.readStream.schema(src.schema).option("pathGlobFilter", f"{name}.parquet").parquet(d)


@query("stream_in_time", "select count(*) as n from article where published is not null and fetched_at is not null and epoch_us(fetched_at) - epoch_us(published) >= -24 * 3600000000::bigint and epoch_us(fetched_at) - epoch_us(published) < 22 * 86400000000::bigint")
def stream_in_time(spark, d):
    """Rows in time, counted by observed metrics while micro-batches are written."""
    scratch = Scratch(spark, "stream")
    tap, seen = EV.counted("in_time", F.count(F.lit(1)).alias("n"))
    rows = EV.in_time(_stream(spark, d, "article"), "published", "fetched_at").select("entry_ord")
    EV.into_store(rows, lambda batch, k: tap(batch).write.mode("overwrite").parquet(scratch.path(f"out/{k}")), scratch.path("ckpt")).awaitTermination()
    return spark.createDataFrame([(sum(x["n"] for x in EV.figures(seen)),)], "n bigint")


@query("stream_baseline", "with d as (select cast(ts as date) as day, count(*) as index from events group by 1), w as (select day, index, quantile_cont(index, 0.5) over (order by day rows between 90 preceding and 1 preceding) m, count(*) over (order by day rows between 90 preceding and 1 preceding) n from d) select day, index, case when n >= 14 then round_even(m, 1) end as baseline, case when n >= 14 and m <> 0 then round_even(index / m, 2) end as ratio from w")
def stream_baseline(spark, d):
    """A trailing median kept up by micro-batches of daily counts."""
    scratch = Scratch(spark, "stream")
    daily = scratch.keep(table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("index")), "daily")
    days = spark.readStream.schema(daily.schema).option("maxFilesPerTrigger", 1).parquet(scratch.path("daily"))
    EV.into_store(days, EV.trailing_store(scratch.path("series"), "index", "day"), scratch.path("ckpt")).awaitTermination()
    return spark.read.parquet(scratch.path("series")).select("day", "index", "baseline", "ratio")
