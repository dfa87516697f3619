"""Queries of the engine's own operators over the driver tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from evidentia.functions import text as T
from evidentia.operators import credibility as C
from evidentia.operators import entities as E
from evidentia.operators import health as H
from evidentia.operators import ingest as I
from evidentia.operators import linkage as L
from evidentia.operators import policy as P
from evidentia.operators import quality as Q
from evidentia.operators import revisions as R
from evidentia.operators import series as S
from evidentia.operators import store as ST
from evidentia.operators import views as V
from evidentia.operators.similar import similar_pairs
from evidentia.sources.tables import norm_domain, norm_id, table

QUERIES: dict = {}
ORACLE: dict = {}



def now():
    """The instant that the queries take for now."""
    return F.lit("2026-05-10 00:00:00").cast("timestamp")


SQL_NOW = "timestamp '2026-05-10 00:00:00'"
#: A small policy for the driver tables.
GATE = {"subject": "(?i)island|channel|reef|bank|shoal|sound|point|narrows", "core": "(?i)exercise|drill", "context": "(?i)warships|frigates|submarines|tankers|jets", "negative": "(?i)markets|insurers"}
ENTITIES = {"warship": ["warship", "frigate", "军舰", "군함", "軍艦"], "submarine": ["submarine", "sous-marin", "U-Boot", "潜艇", "잠수함", "潜水艦"], "drill": ["drill", "exercise", "演习", "훈련", "演習"], "search": ["search for", "搜寻", "수색", "捜索"], "blackout": ["blackout", "大停电", "대정전", "大規模停電"], "navy": ["navy", "海军", "해군", "海軍"]}
ANCHORS = ["drill", "search", "blackout"]


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return put


# ---------------------------------------------------------------- series

_DAILY = "select cast(ts as date) as day, count(*) filter (event_type = 'click') + 2 * count(*) filter (event_type = 'purchase') + count(*) filter (event_type = 'signup') as idx from events group by 1"


def _daily(spark, d):
    one = lambda k: F.count_if(F.col("event_type") == k)
    return table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(S.tension_index(one("click"), one("purchase"), one("signup")).alias("idx"))


_BASE = f"with d as ({_DAILY}), w as (select day, idx, quantile_cont(idx, 0.5) over (order by day rows between 7 preceding and 1 preceding) m, count(*) over (order by day rows between 7 preceding and 1 preceding) n from d)"


@query("tension_index_baseline", _BASE + " select day, idx, case when n >= 3 then round_even(m, 1) end as baseline, case when n >= 3 and m <> 0 then round_even(idx / m, 2) end as ratio from w")
def tension_index_baseline(spark, d):
    return S.trailing_baseline(_daily(spark, d), "idx", "day", before=7, fewest=3)


@query("tension_levels", _BASE + " , r as (select day, case when n >= 3 and m <> 0 then round_even(idx / m, 2) end as ratio from w) select day, case when ratio >= 1.5 then 'high' when ratio >= 1.1 then 'raised' when ratio <= 0.7 then 'low' when ratio is not null then 'usual' end as band from r")
def tension_levels(spark, d):
    return S.trailing_baseline(_daily(spark, d), "idx", "day", before=7, fewest=3).select("day", S.band(F.col("ratio")).alias("band"))


_READ = r"""with r as (select *, regexp_replace(date, '\s', '', 'g') t from tension),
 s as (select *, case when regexp_full_match(t, '\d{3,4}[-/.]\d{1,2}[-/.]\d{1,2}') then string_split_regex(t, '[-/.]') when regexp_full_match(t, '\d{7,8}') then [t[:-5], t[-4:-3], t[-2:]] end p from r),
 dd as (select *, try_cast((case when length(p[1]) = 3 then p[1]::int + 1911 else p[1]::int end) || '-' || lpad(p[2], 2, '0') || '-' || lpad(p[3], 2, '0') as date) as day from s where p is not null),
 b as (select series_id, day, arg_max(aircraft + 2 * navy_ships + official_ships, (observed_at, reading_id)) as idx from dd where day is not null and parse_ok and aircraft >= 0 and navy_ships >= 0 and official_ships >= 0 and observed_at is not null group by 1, 2)"""


def _bulletins(spark, d):
    from evidentia.operators.regular_grid import read_date

    rows = table(spark, d, "tension").withColumn("day", read_date("date")).where("day is not null and parse_ok and aircraft >= 0 and navy_ships >= 0 and official_ships >= 0 and observed_at is not null")
    return rows.groupBy("series_id", "day").agg(F.max_by(S.tension_index(F.col("aircraft"), F.col("navy_ships"), F.col("official_ships")), F.struct("observed_at", "reading_id")).alias("idx"))


@query("bulletin_baseline", _READ + ", w as (select *, quantile_cont(idx, 0.5) over (partition by series_id order by day rows between 90 preceding and 1 preceding) m, count(*) over (partition by series_id order by day rows between 90 preceding and 1 preceding) n from b) select series_id, day, idx, case when n >= 14 then round_even(m, 1) end as baseline, case when n >= 14 and m <> 0 then round_even(idx / m, 2) end as ratio from w")
def bulletin_baseline(spark, d):
    return S.trailing_baseline(_bulletins(spark, d), "idx", "day", ["series_id"])


@query("series_gap_check", _READ + ", g as (select series_id, day, datediff('day', lag(day) over (partition by series_id order by day), day) gap from b), a as (select series_id, count(*) n, datediff('day', min(day), max(day)) + 1 span, count(*) filter (gap = 2) two_day, count(gap) gaps from g group by 1) select *, n / span as coverage, case when gaps > 0 then two_day / gaps else 0 end as two_day_share, (n >= 30 and n / span >= 0.9 and (case when gaps > 0 then two_day / gaps else 0 end) <= 0.1) as continuous from a")
def series_gap_check(spark, d):
    return S.continuity(_bulletins(spark, d), "day", ["series_id"])


@query("last_n_days", _READ + " select series_id, day, idx from (select *, row_number() over (partition by series_id order by day desc) rn from b) where rn <= 30")
def last_n_days(spark, d):
    return S.last_rows(_bulletins(spark, d), 30, "day", ["series_id"])


@query("incremental_new_days", _READ + ", m as (select series_id, max(day) - 10 as cut from b group by 1) select b.series_id, b.day, b.idx from b join m using (series_id) where b.day > m.cut")
def incremental_new_days(spark, d):
    b = _bulletins(spark, d)
    cut = b.groupBy("series_id").agg((F.max("day") - F.expr("interval 10 days")).alias("cut"))
    held = b.join(cut, "series_id").where(F.col("day") <= F.col("cut").cast("date")).select(F.concat_ws("|", "series_id", "day").alias("k"))
    return S.new_records(b.withColumn("k", F.concat_ws("|", "series_id", "day")), held, "k").drop("k")


# ---------------------------------------------------------------- text

_SPACE = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _plain_sql(col: str) -> str:
    """strip_html in SQL."""
    out = f"regexp_replace(coalesce({col}, ''), '<[^>]+>', ' ', 'g')"
    for entity, char in (("&nbsp;", "' '"), ("&amp;", "'&'"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)")):
        out = f"replace({out}, '{entity}', {char})"
    return f"trim(regexp_replace({out}, '{_SPACE}', ' ', 'g'))"


@query("title_clean", rf"with t as (select entry_ord, {_plain_sql('title')} x, coalesce(source_name, '') s from article), u as (select *, regexp_replace(x, '\s+-\s+[^-]{{2,40}}$', '') c from t) select entry_ord, case when s <> '' and suffix(x, ' - ' || s) then trim(x[:length(x) - length(s) - 3]) else trim(case when length(c) >= 15 then c else x end) end as cleaned from u")
def title_clean(spark, d):
    return table(spark, d, "article").select("entry_ord", T.clean_title(F.col("title"), F.coalesce("source_name", F.lit(""))).alias("cleaned"))


_WORDS = ", ".join(f"case when regexp_matches(t, '(?i)(^|[^A-Za-z]){w}([^A-Za-z]|$)') then {n} end" for w, n in T.NUMBER_WORDS.items())


@query("number_fingerprint", rf"with a as (select entry_ord, coalesce(title, '') t from article) select entry_ord, list_sort(list_distinct(list_filter(list_concat(list_transform(regexp_extract_all(translate(t, '０１２３４５６７８９', '0123456789'), '[0-9]{{1,4}}'), lambda x: x::int), [{_WORDS}, case when regexp_matches(t, '[兩两]') then 2 end]), lambda n: n is not null and not (n between 1900 and 2100)))) as nums from a")
def number_fingerprint(spark, d):
    return table(spark, d, "article").select("entry_ord", T.title_numbers("title").alias("nums"))


@query("detect_lang_titles", r"with t as (select entry_ord, coalesce(title, '') t from article), c as (select entry_ord, length(regexp_replace(t, '[^\x{ac00}-\x{d7af}\x{1100}-\x{11ff}]', '', 'g')) h, length(regexp_replace(t, '[^\x{3040}-\x{30ff}]', '', 'g')) k, length(regexp_replace(t, '[^\x{4e00}-\x{9fff}]', '', 'g')) z, length(regexp_replace(t, '[^a-zA-Z]', '', 'g')) l from t) select entry_ord, case when h + k + z + l = 0 then 'en' when h / (h + k + z + l) > 0.1 then 'ko' when k / (h + k + z + l) > 0.05 then 'ja' when z / (h + k + z + l) > 0.2 then 'zh' else 'en' end as script_lang from c")
def detect_lang_titles(spark, d):
    return table(spark, d, "article").select("entry_ord", T.detect_lang("title").alias("script_lang"))


@query("strip_html_docs", f"select doc_id, {_plain_sql('text')} as cleaned from documents")
def strip_html_docs(spark, d):
    return table(spark, d, "documents").select("doc_id", T.strip_html("text").alias("cleaned"))


# compatibility forms cannot be said in SQL: these two are tested on small cases
@query("title_token_counts")
def title_token_counts(spark, d):
    rows = table(spark, d, "article").withColumn("x", T.title_text(F.col("title")))
    return rows.select("entry_ord", F.size(T.title_tokens(F.col("x"), T.detect_lang("title"))).alias("n_tokens"))


@query("content_id_sha1")
def content_id_sha1(spark, d):
    return table(spark, d, "article").select("entry_ord", F.substring(T.sha1_nul(T.normalize_text("title")), 1, 16).alias("content_id"))


@query("url_hosts", r"select entry_ord, lower(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')) as host from article")
def url_hosts(spark, d):
    return table(spark, d, "article").select("entry_ord", I.host_of(F.col("url")).alias("host"))


# ---------------------------------------------------------------- gate and ingest

_GATE = r"""g as (select entry_ord, case when regexp_matches(x, '(?i)markets|insurers') then 'negative' when regexp_matches(x, '(?i)exercise|drill') then null when not regexp_matches(x, '(?i)island|channel|reef|bank|shoal|sound|point|narrows') then 'no_subject' when regexp_matches(coalesce(title, ''), '(?i)warships|frigates|submarines|tankers|jets') then null else 'no_topic' end as reason from (select *, concat_ws(' ', title, summary) x from article))"""


@query("topic_gate", f"with {_GATE} select entry_ord, reason from g")
def topic_gate(spark, d):
    return table(spark, d, "article").select("entry_ord", I.passes_gate(F.coalesce("title", F.lit("")), F.col("summary"), **GATE).alias("reason"))


@query("age_filter", f"select entry_ord, floor((epoch_us({SQL_NOW}) - epoch_us(published)) / 86400000000)::bigint as age from article where published is not null and floor((epoch_us({SQL_NOW}) - epoch_us(published)) / 86400000000) between -1 and 21")
def age_filter(spark, d):
    return table(spark, d, "article").where(I.in_age(now(), F.col("published"))).select("entry_ord", I.age_days(now(), F.col("published")).alias("age"))


@query("drop_reason_histogram", f"with {_GATE} select coalesce(case when length(coalesce(title, '')) < 10 then 'no_title' when not (floor((epoch_us({SQL_NOW}) - epoch_us(coalesce(published, {SQL_NOW}))) / 86400000000) between -1 and 21) then 'too_old' end, reason) as drop_reason, count(*) as n from article join g using (entry_ord) group by 1 having drop_reason is not null")
def drop_reason_histogram(spark, d):
    a = table(spark, d, "article")
    gate = I.passes_gate(F.coalesce("title", F.lit("")), F.col("summary"), **GATE)
    reason = F.coalesce(F.when(F.length(F.coalesce("title", F.lit(""))) < 10, "no_title"), F.when(~I.in_age(now(), F.coalesce("published", now())), "too_old"), gate)
    return I.drop_counts(a.withColumn("drop_reason", reason))


_W = "case tier when 'T1' then 1.0 when 'TA' then 0.9 when 'T2' then 0.85 when 'T3' then 0.6 when 'T4' then 0.45 when 'T5' then 0.3 else {0} end"


@query("dedupe_best_rank", f"select id, entry_ord, slot from (select id, entry_ord, min(entry_ord) over (partition by id) slot, row_number() over (partition by id order by (coalesce(source_domain, '') <> '') desc, {_W.format(0.3)} desc, entry_ord) rn from article) where rn = 1")
def dedupe_best_rank(spark, d):
    return I.best_of_id(table(spark, d, "article")).select("id", "entry_ord", "slot")


@query("newest_per_feed", "select feed_id, max(published) as newest from article group by 1")
def newest_per_feed(spark, d):
    return I.newest_entry(table(spark, d, "article"))


@query("entry_datetime", "select doc_id, coalesce(published, timestamptz '2026-01-01 00:00:00+00') as at from documents")
def entry_datetime(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", I.entry_datetime(F.date_format("published", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("not a date"), F.lit("2026-01-01 00:00:00")).alias("at"))


@query("hedge_flags", r"select entry_ord, regexp_matches(concat_ws(' ', title, summary), '(?i)reportedly|sources say') as hedged, regexp_matches(concat_ws(' ', title, summary), '(?i)defence ministry|coast guard') as primary_seen from article")
def hedge_flags(spark, d):
    text = F.concat_ws(" ", "title", "summary")
    return table(spark, d, "article").select("entry_ord", text.rlike("(?i)reportedly|sources say").alias("hedged"), text.rlike("(?i)defence ministry|coast guard").alias("primary_seen"))


# ---------------------------------------------------------------- policy joins

_HOST = r"nullif(regexp_replace(lower(trim(source_domain)), '^www\.', ''), '')"


@query("source_attrs_join", rf"with h as (select distinct source_domain, {_HOST} h from article), e as (select source_domain, h, unnest(range(0, greatest(len(string_split(h, '.')) - 1, 1))) k from h where h is not null), s as (select source_domain, k, array_to_string(string_split(h, '.')[k + 1:], '.') suffix from e), b as (select source_domain, arg_min(suffix, k) as d from s join outlet on suffix = outlet.domain group by 1) select a.entry_ord, coalesce(b.d, h.h, '') as domain, coalesce(o.tier, 'T5') as tier, coalesce(o.bloc, 'unknown') as bloc from article a left join h on a.source_domain is not distinct from h.source_domain left join b on a.source_domain is not distinct from b.source_domain left join outlet o on o.domain = b.d")
def source_attrs_join(spark, d):
    return P.classify(table(spark, d, "article").select("entry_ord", "source_domain"), table(spark, d, "outlet")).select("entry_ord", "domain", "tier", "bloc")


@query("domain_suffix_filter", rf"select entry_ord from article where regexp_matches({_HOST}, '(^|\.)co\.example$') or {_HOST} = 'lornewire.example'")
def domain_suffix_filter(spark, d):
    listed = spark.createDataFrame([("co.example",), ("lornewire.example",)], "domain string")
    return P.listed_domain(table(spark, d, "article").select("entry_ord", "source_domain"), listed, "source_domain").select("entry_ord")


@query("label_lookup", "select c_custkey, n_name as nation, c_mktsegment from customer left join nation on c_nationkey = n_nationkey")
def label_lookup(spark, d):
    return P.label(table(spark, d, "customer").withColumnRenamed("c_nationkey", "n_nationkey"), table(spark, d, "nation"), "n_nationkey", "n_name", "nation").select("c_custkey", "nation", "c_mktsegment")


@query("sources_by_tier", "select tier, count(*) as n, list_sort(list(domain)) as domains from outlet group by 1")
def sources_by_tier(spark, d):
    return H.sources_by_tier(table(spark, d, "outlet"))


# ---------------------------------------------------------------- entities

def _sig_sql() -> str:
    parts = []
    for name, aliases in sorted(ENTITIES.items()):
        latin = [a for a in aliases if a.isascii()]
        other = [a for a in aliases if not a.isascii()]
        cond = [f"regexp_matches(x, '(?i)(^|[^A-Za-z])(?:{'|'.join(a.replace(' ', '[-\\s]').replace('-B', '[-\\s]B') if ' ' in a or '-' in a else a for a in latin)})(?:e?s|''s|’s)?([^A-Za-z]|$)')"] if latin else []
        cond += [f"contains(x, '{a}')" for a in other]
        parts.append(f"case when {' or '.join(cond)} then '{name}' end")
    return "list_filter([" + ", ".join(parts) + "], lambda e: e is not null)"


_ENT = f"e as (select id, {_sig_sql()} as entities from (select id, min(coalesce(title, '')) x from article group by 1))".replace("sous-marin", "sous[-\\s]marin").replace("U-Boot", "U[-\\s]Boot")


def _entities(spark, d):
    a = table(spark, d, "article").groupBy("id").agg(F.min(F.coalesce("title", F.lit(""))).alias("x"))
    return a.select("id", E.extract_entities(F.col("x"), ENTITIES).alias("entities"))


@query("entity_extract", f"with {_ENT} select id, entities from e")
def entity_extract(spark, d):
    return _entities(spark, d)


@query("signature_df_idf", f"with {_ENT}, n as (select count(*) n from e), u as (select unnest(entities) element from e), f as (select element, count(*) as df from u group by 1) select element, df, n, df / n as frequency, round(ln(1 + n / df), 9) as weight, df > 0.4 * n as common from f, n")
def signature_df_idf(spark, d):
    return E.signature_stats(_entities(spark, d), "entities").withColumn("weight", F.round("weight", 9))


@query("consensus_signature", f"with {_ENT}, m as (select a.group_no as cluster_id, e.entities from e join (select distinct id, substr(id, 1, 2) group_no from article) a using (id)), s as (select cluster_id, count(*) size from m group by 1), c as (select cluster_id, unnest(entities) element from m), k as (select cluster_id, element, count(*) k from c group by 1, 2), n as (select count(*) n from e), f as (select element, count(*) df from (select unnest(entities) element from e) group by 1) select cluster_id, element from k join s using (cluster_id) where k >= greatest(1, ceil(size * 2 / 5)) and element not in (select element from f, n where df > 0.4 * n)")
def consensus_signature(spark, d):
    e = _entities(spark, d)
    return E.consensus_signature(e.withColumn("cluster_id", F.substring("id", 1, 2)).withColumnRenamed("entities", "signature"), E.signature_stats(e, "entities"))


@query("anchor_filter", f"with {_ENT} select id, list_filter(entities, lambda x: x in ('drill', 'search', 'blackout')) as opens from e")
def anchor_filter(spark, d):
    return _entities(spark, d).select("id", E.anchors(F.col("entities"), ANCHORS).alias("opens"))


@query("weighted_overlap_pairs", f"with {_ENT}, n as (select count(*) n from e), f as (select element, count(*) df from (select unnest(entities) element from e) group by 1), w as (select element, ln(1 + n / df) w from f, n), k as (select distinct tier as key, element from (select tier, unnest(entities) element from e join (select distinct id, tier from article) using (id))), t as (select key, sum(w) total from k join w using (element) group by 1), s as (select x.key a, y.key b, sum(w) shared from k x join k y on x.element = y.element and x.key < y.key join w on w.element = x.element group by 1, 2) select a, b, round(shared / least(p.total, q.total), 9) as overlap, round(shared, 9) as shared from s join t p on p.key = a join t q on q.key = b")
def weighted_overlap_pairs(spark, d):
    return _tier_overlaps(spark, d, _entities(spark, d), "entities")


def _tier_overlaps(spark, d, e, sig):
    tiers = table(spark, d, "article").select("id", F.col("tier").alias("key")).distinct()
    elements = e.join(tiers, "id").select("key", F.explode(sig).alias("element")).distinct()
    keys = elements.select("key").distinct()
    pairs = keys.withColumnRenamed("key", "a").join(keys.withColumnRenamed("key", "b"), F.col("a") < F.col("b"))  # a few tiers
    out = E.weighted_overlap(pairs, E.signature_stats(e, sig), "a", "b", elements, "key")
    return out.select("a", "b", F.round("overlap", 9).alias("overlap"), F.round("shared", 9).alias("shared"))


# the signature_ queries: the same over signatures of title and summary, figures among them; SQL of the kind above has no look-behind for the figures

def _timed(articles):
    """One row per id that has a title; one without a time in any row is published now, as in normalize_entries."""
    known = F.coalesce("published", F.min("published").over(Window.partitionBy("id")), now())
    return I.best_of_id(articles.where("title is not null").withColumn("published", known))


def _signatures(spark, d):
    a = _timed(table(spark, d, "article"))
    return a.select("id", E.signature(F.concat_ws(" ", "title", "summary"), ENTITIES).alias("signature"))


@query("signature_extract")
def signature_extract(spark, d):
    return _signatures(spark, d)


@query("signature_stats")
def signature_stats(spark, d):
    return E.signature_stats(_signatures(spark, d)).withColumn("weight", F.round("weight", 9))


@query("signature_consensus")
def signature_consensus(spark, d):
    s = _signatures(spark, d)
    return E.consensus_signature(s.withColumn("cluster_id", F.substring("id", 1, 2)), E.signature_stats(s))


@query("signature_anchors")
def signature_anchors(spark, d):
    return _signatures(spark, d).select("id", E.anchors(F.col("signature"), ANCHORS).alias("opens"))


@query("signature_overlap_pairs")
def signature_overlap_pairs(spark, d):
    return _tier_overlaps(spark, d, _signatures(spark, d), "signature")


# ---------------------------------------------------------------- events: members

_MEM = rf"""ev as (select arg_min(struct_pack(row_id, articles), row_id) v from news_event where articles is not null group by coalesce(lower(trim(id)), '#' || row_id)),
 mm as (select v.row_id as event_id, unnest(v.articles) x from ev), ids as (select event_id, lower(trim(x.id, ' ' || chr(9))) as id, min(x.published) as published from mm where x.id is not null group by 1, 2),
 art as (select lower(id) as id, min(title) title, min(source_name) source_name, min({_HOST}) source_domain, min(tier) tier, min(bloc) bloc, bool_or(primary_cited) primary_cited, min(lang) lang, min(entry_ord) as ord from article group by 1),
 mem as (select event_id, id, coalesce(ids.published, timestamptz '2026-01-01 00:00:00+00') as published, title, source_name, coalesce(source_domain, '') source_domain, tier, bloc, primary_cited, coalesce(lang, '') lang, ord from ids join art using (id) where title is not null)"""


def members(spark, d):
    """Articles of each event row (the first of every event id): event_id and the article's columns."""
    ev = table(spark, d, "news_event").where("articles is not null")
    first = ev.groupBy(F.coalesce(norm_id("id"), F.concat(F.lit("#"), "row_id")).alias("k")).agg(F.min("row_id").alias("event_id")).select("event_id")
    x = ev.join(first, ev["row_id"] == first["event_id"]).select("event_id", F.explode("articles").alias("x"))
    ids = x.where("x.id is not null").groupBy("event_id", norm_id("x.id").alias("id")).agg(F.min("x.published").alias("published"))
    a = table(spark, d, "article")
    art = a.groupBy(norm_id("id").alias("id")).agg(F.min("title").alias("title"), F.min("source_name").alias("source_name"), F.min(norm_domain("source_domain")).alias("source_domain"), F.min("tier").alias("tier"), F.min("bloc").alias("bloc"), F.bool_or("primary_cited").alias("primary_cited"), F.min("lang").alias("lang"), F.min("entry_ord").alias("ord"))
    return ids.join(art, "id").where("title is not null").select("event_id", "id", F.coalesce("published", F.lit("2026-01-01 00:00:00").cast("timestamp")).alias("published"), "title", "source_name", F.coalesce("source_domain", F.lit("")).alias("source_domain"), "tier", "bloc", "primary_cited", F.coalesce("lang", F.lit("")).alias("lang"), "ord")


_KEY = "case when bloc = 'independent' then source_domain else bloc end"


@query("independent_count", f"with {_MEM} select event_id, count(distinct case when bloc <> 'unknown' then {_KEY} end) as n_independent, count(distinct case when bloc = 'unknown' then source_domain end) as n_unrated, count(*) as n_originals from mem group by 1")
def independent_count(spark, d):
    return C.independent_counts(members(spark, d))


@query("evidence_score", f"with {_MEM}, k as (select event_id, max({_W.format(0.3)}) w from mem where bloc <> 'unknown' group by event_id, {_KEY} union all select event_id, 0.3 * max({_W.format(0.3)}) from mem where bloc = 'unknown' group by 1), r as (select *, row_number() over (partition by event_id order by w desc) k from k) select event_id, round(least(1.0, sum(w * [1.0, 0.6, 0.35, 0.2][k]) / 2.15), 6) as evidence from r where k <= 4 group by 1")
def evidence_score(spark, d):
    return C.evidence(members(spark, d)).withColumn("evidence", F.round("evidence", 6))


_GRADE = f"""i as (select event_id, count(distinct case when bloc <> 'unknown' then {_KEY} end) as n, max({_W.format('0.0')}) as bw, bool_or(bloc <> 'unknown') as rated, bool_or(bloc = 'independent') as ind from mem group by 1),
 gr as (select event_id, case when n = 0 then 'D' when n = 1 and ((rated and not ind) or bw <= 0.45) then 'D' when n = 1 and bw = 1.0 then 'B' when n = 1 then 'C' when n >= 3 and bw >= 0.9 then 'A' else 'B' end as grade, case when n = 0 then 'unrated' when n = 1 and rated and not ind then 'state_only' when n = 1 and bw <= 0.45 then 'partisan' end as d_reason from i)"""


def _grades(spark, d):
    m = members(spark, d)
    n = C.independent_counts(m)
    b = m.groupBy("event_id").agg(F.max_by("tier", P.tier_weight(F.col("tier"), 0.0)).alias("t"), F.bool_or(F.col("bloc") != "unknown").alias("rated"), F.bool_or(F.col("bloc") == "independent").alias("ind"))
    g, r = C.grade(F.col("n_independent"), F.col("rated") & ~F.col("ind"), F.col("t"))
    return n.join(b, "event_id").select("event_id", g.alias("grade"), r.alias("d_reason"))


@query("grade_decision", f"with {_MEM}, {_GRADE} select event_id, grade, d_reason from gr")
def grade_decision(spark, d):
    return _grades(spark, d)


@query("grade_histogram", f"with {_MEM}, {_GRADE} select grade, count(*) as n from gr group by 1")
def grade_histogram(spark, d):
    return _grades(spark, d).groupBy("grade").agg(F.count(F.lit(1)).alias("n"))


@query("headline_pick", f"with {_MEM} select event_id, title as headline, source_name as headline_source from (select *, row_number() over (partition by event_id order by {_W.format('0.0')} desc, (bloc = 'independent') desc, published, ord) rn from mem) where rn = 1")
def headline_pick(spark, d):
    return C.pick_headline(members(spark, d)).select("event_id", "headline", "headline_source")


@query("event_assemble", f"with {_MEM} select 'evt_' || strftime(min(published) at time zone 'UTC', '%Y%m%d') || '_' || left(sha1(min(id) || chr(0)), 6) as id, event_id, min(published) as first_seen, max(published) as last_seen, list_sort(list(distinct lang)) as langs, count(distinct lang) > 1 as cross_language, count(*) as n_articles from mem group by event_id")
def event_assemble(spark, d):
    return C.assemble(members(spark, d)).select("id", "event_id", "first_seen", "last_seen", "langs", "cross_language", F.size("articles").cast("bigint").alias("n_articles"))


@query("perspective_split", f"with {_MEM} select event_id, count(distinct id) filter (starts_with(bloc, 'state')) as n_state, count(distinct id) filter (not starts_with(bloc, 'state')) as n_other from mem group by 1")
def perspective_split(spark, d):
    return C.assemble(members(spark, d)).select("event_id", F.size("state_side").cast("bigint").alias("n_state"), F.size("other_side").cast("bigint").alias("n_other"))


@query("article_labels", f"with {_MEM} select event_id, id, tier, case tier when 'T1' then 'wire' when 'TA' then 'analysis' when 'T2' then 'press' else tier end as tier_label from mem")
def article_labels(spark, d):
    labels = spark.createDataFrame([("T1", "wire"), ("TA", "analysis"), ("T2", "press")], "tier string, tier_name string")
    return P.label(members(spark, d), labels, "tier", "tier_name", "tier_label").select("event_id", "id", "tier", "tier_label")


@query("copy_groups")
def copy_groups(spark, d):
    return C.copy_groups(members(spark, d))


@query("event_verdicts")
def event_verdicts(spark, d):
    return C.evaluate(members(spark, d)).withColumn("reasons", F.array_join("reasons", "; ")).withColumn("blocs", F.array_join("blocs", ","))


# ---------------------------------------------------------------- similarity

@query("revision_dedupe")
def revision_dedupe(spark, d):
    return R.dedupe_revisions(_timed(table(spark, d, "article")))


def _titled(spark, d):
    a = _timed(table(spark, d, "article").select("id", "title", "published", "summary", "source_domain", "tier", "entry_ord"))
    return a.select("id", "title", "published", T.detect_lang("title").alias("lang"), F.coalesce("summary", F.lit("")).alias("summary"))


def _docs(spark, d):
    from evidentia.scratch import Scratch

    return Scratch(spark, "docs").keep(_titled(spark, d), "docs")


@query("tfidf_top_terms")
def tfidf_top_terms(spark, d):
    w = L.tfidf(_termed(spark, d))
    return w.groupBy("lang", "term").agg(F.round(F.sum("w"), 6).alias("w")).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.col("w").desc(), "term"))).where("rank <= 25")


_TF = r"""dd as (select id, coalesce(min(lang), '') as lang, lower(min(title)) x, min(published) published from article where published is not null and title is not null group by id),
 tm as (select id, lang, published, unnest(list_filter(string_split(x, ' '), lambda w: length(w) > 1)) term from dd), tf as (select id, lang, published, term, 1 + ln(count(*)) tf from tm group by 1, 2, 3, 4), nn as (select lang, count(*) n from dd group by 1), df as (select lang, term, count(*) df from tf group by 1, 2),
 raw as (select id, lang, published, term, tf * (ln((1 + n) / (1 + df)) + 1) w from tf join df using (lang, term) join nn using (lang)), ww as (select id, lang, published, term, w / sqrt(sum(w * w) over (partition by id)) w from raw)"""


def _worded(spark, d):
    a = table(spark, d, "article").where("published is not null and title is not null").groupBy("id").agg(F.lower(F.min("title")).alias("x"), F.min("published").alias("published"), F.coalesce(F.min("lang"), F.lit("")).alias("lang"))
    return a.select("id", "lang", "published", F.filter(F.split("x", " "), lambda w: F.length(w) > 1).alias("terms"))


@query("tfidf_weights", f"with {_TF} select id, term, round(w, 6) as w from ww")
def tfidf_weights(spark, d):
    return L.tfidf(_worded(spark, d)).select("id", "term", F.round("w", 6).alias("w"))


@query("cosine_pairs", f"with {_TF} select a, b, round(s, 6) as cos from (select p.id a, q.id b, sum(p.w * q.w) s from ww p join ww q on p.lang = q.lang and p.term = q.term and p.id < q.id and abs(epoch_us(p.published) - epoch_us(q.published)) <= 48 * 3600000000 group by 1, 2) where s > 0.5")
def cosine_pairs(spark, d):
    from evidentia.scratch import Scratch, release

    docs = Scratch(spark, "pairs").keep(_worded(spark, d).select("id", "lang", F.col("published").alias("at"), F.concat_ws(" ", "terms").alias("x")), "docs")
    release(spark)
    return similar_pairs(docs, {None: "words"}, {None: 0.5}, L.WINDOW_HOURS).select("a", "b", F.round("cos", 6).alias("cos"))


def _termed(spark, d):
    """Articles with the terms that the linkage takes: title and summary, by the language of the title's script."""
    return _docs(spark, d).withColumn("x", T.normalize_text(F.concat_ws(" ", "title", "summary"))).select("id", "lang", "published", L.terms(F.col("x"), F.col("lang")).alias("terms"))


@query("terms_tfidf_weights")
def terms_tfidf_weights(spark, d):
    return L.tfidf(_termed(spark, d)).select("id", "term", F.round("w", 6).alias("w"))


@query("terms_cosine_pairs")
def terms_cosine_pairs(spark, d):
    from evidentia.scratch import Scratch, release

    text = _titled(spark, d).withColumn("x", T.normalize_text(F.concat_ws(" ", "title", "summary")))
    docs = Scratch(spark, "pairs").keep(text.select("id", "lang", F.col("published").alias("at"), L.key_text(F.col("x"), F.col("lang")).alias("x")), "docs")
    release(spark)
    return similar_pairs(docs, L.KINDS, {None: 0.5}, L.WINDOW_HOURS).select("a", "b", F.round("cos", 6).alias("cos"))


@query("lang_clusters")
def lang_clusters(spark, d):
    return L.cluster_by_language(spark, _docs(spark, d).withColumn("nums", T.extract_numbers("title")))


@query("cross_merge")
def cross_merge(spark, d):
    return L.cluster_articles(spark, _docs(spark, d), ENTITIES, ANCHORS)


# ---------------------------------------------------------------- store

def _orders(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    return o.where("o_orderkey % 3 <> 0"), o.where("o_orderkey % 3 <> 1").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice") - 1).otherwise(F.col("o_totalprice") + 1)).withColumn("o_orderpriority", F.lit("new"))


@query("event_upsert", "with p as (select * from orders where o_orderkey % 3 <> 0), c as (select o_orderkey, case when o_orderkey % 2 = 0 then o_totalprice - 1 else o_totalprice + 1 end as o_totalprice, 'new' as o_orderpriority from orders where o_orderkey % 3 <> 1) select coalesce(c.o_orderkey, p.o_orderkey) as o_orderkey, round(coalesce(c.o_totalprice, p.o_totalprice), 2) as o_totalprice, case when c.o_orderkey is null then p.o_orderpriority when p.o_totalprice > c.o_totalprice then p.o_orderpriority else c.o_orderpriority end as o_orderpriority from p full join c on p.o_orderkey = c.o_orderkey")
def event_upsert(spark, d):
    p, c = _orders(spark, d)
    return ST.upsert(p, c, "o_orderkey", "o_totalprice", ("o_orderpriority",)).select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"), "o_orderpriority")


_EV = r"ev as (select row_id as id, batch_no, list_distinct(list_filter(list_transform(coalesce(articles, []), lambda x: lower(trim(x.id, ' ' || chr(9)))), lambda i: i is not null)) as arts from news_event)"


def _rows(spark, d):
    arts = F.coalesce(F.array_distinct(F.filter(F.transform("articles.id", norm_id), lambda i: i.isNotNull())), F.array().cast("array<string>"))
    return table(spark, d, "news_event").select(F.col("row_id").alias("id"), "batch_no", arts.alias("articles"))


@query("ghost_antijoin", f"with {_EV}, cur as (select * from ev where batch_no = 9), h as (select distinct unnest(arts) a from cur), old as (select * from ev where batch_no <> 9), g as (select distinct id from (select id, unnest(arts) a from old) join h using (a)) select id from cur union all select id from old where len(arts) > 0 and id not in (select id from g)")
def ghost_antijoin(spark, d):
    r = _rows(spark, d)
    return ST.drop_ghosts(r, r.where("batch_no = 9")).select("id")


@query("shared_article_check", f"with {_EV} select article, count(distinct id) as n_events from (select id, unnest(arts) article from ev) group by 1 having count(distinct id) > 1")
def shared_article_check(spark, d):
    return ST.shared_articles(_rows(spark, d))


@query("rolling_prune", f"select row_id from news_event where epoch_us(last_seen) >= epoch_us({SQL_NOW}) - 45 * 86400000000::bigint and coalesce(id, '') <> 'evt_blocked'")
def rolling_prune(spark, d):
    return ST.prune(table(spark, d, "news_event").withColumn("id", F.coalesce("id", F.lit(""))), now(), 45, ["evt_blocked"]).select("row_id")


@query("monthly_archive", "select strftime(o_orderdate, '%Y-%m') as month, count(*) as n from orders group by 1")
def monthly_archive(spark, d):
    return ST.by_month(table(spark, d, "orders"), "o_orderdate").groupBy("month").agg(F.count(F.lit(1)).alias("n"))


@query("change_fingerprint", "select count(*) as n, true as same from orders")
def change_fingerprint(spark, d):
    o = table(spark, d, "orders")
    a, b = ST.fingerprint(o, ("o_totalprice",)), ST.fingerprint(o.withColumn("o_totalprice", F.lit(0.0)).repartition(7), ("o_totalprice",))
    return a.join(b.withColumnRenamed("digest", "other"), "n").select("n", (F.col("digest") == F.col("other")).alias("same"))


# ---------------------------------------------------------------- quality and health

def _clusters(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.col("label").cast("string").alias("label"), ((F.col("vec_id") * 7 + F.col("label") * 3) % 12).cast("string").alias("cluster"))


_CL = "cl as (select vec_id, label::varchar as label, ((vec_id * 7 + label * 3) % 12)::varchar as cluster from embeddings)"


@query("pairwise_prf", f"with {_CL}, p as (select count(*) filter (a.cluster = b.cluster and a.label = b.label) tp, count(*) filter (a.cluster = b.cluster) pc, count(*) filter (a.label = b.label) pl from cl a join cl b on a.vec_id < b.vec_id), r as (select case when pc > 0 then tp / pc else 1 end as precision, case when pl > 0 then tp / pl else 1 end as recall from p) select round(precision, 9) as precision, round(recall, 9) as recall, round(2 * precision * recall / (precision + recall), 9) as f1 from r")
def pairwise_prf(spark, d):
    return Q.pairwise(_clusters(spark, d)).select(*(F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")))


@query("bcubed", f"with {_CL}, j as (select a.vec_id, count(*) filter (a.cluster = b.cluster and a.label = b.label) both_, count(*) filter (a.cluster = b.cluster) c, count(*) filter (a.label = b.label) l from cl a, cl b group by 1), r as (select avg(both_ / c) as precision, avg(both_ / l) as recall from j) select round(precision, 9) as precision, round(recall, 9) as recall, round(2 * precision * recall / (precision + recall), 9) as f1 from r")
def bcubed(spark, d):
    return Q.bcubed(_clusters(spark, d)).select(*(F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")))


@query("contamination", f"with {_CL}, t as (select cluster, label, count(*) n from cl group by 1, 2), m as (select cluster, arg_max(label, (n, label)) majority, sum(n) size from t group by 1) select cluster, majority, sum(n)::bigint as n_other from t join m using (cluster) where label <> majority and size > 1 group by 1, 2")
def contamination(spark, d):
    return Q.contamination(_clusters(spark, d))


@query("fragmentation", f"with {_CL} select label, count(distinct cluster) as n_clusters from cl group by 1")
def fragmentation(spark, d):
    return Q.fragmentation(_clusters(spark, d))


@query("prefix_labels", "select n_nationkey as id, coalesce(arg_max(case when prefix is not null then lab end, (length(prefix), prefix)), 'solo:' || n_nationkey) as label from nation left join (values ('AL', 'a'), ('ALGERIA', 'b'), ('IR', 'c')) v(prefix, lab) on contains(n_name, prefix) group by 1")
def prefix_labels(spark, d):
    labels = spark.createDataFrame([("AL", "a"), ("ALGERIA", "b"), ("IR", "c")], "prefix string, label string")
    return Q.prefix_labels(table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("title")), labels)


_REP = f"rep as (select f.id as feed_id, critical, count(a.id) as n_entries, max(a.published) as newest, count(distinct case when a.tier = 'T1' then a.id end) as n_adopted from feed f left join article a on a.feed_id = f.id group by 1, 2), hh as (select *, coalesce(floor((epoch_us({SQL_NOW}) - epoch_us(newest)) / 86400000000) > 7, false) as stale, case when n_entries = 0 then 'empty' else 'ok' end as status from rep)"
_HEALTH = _REP + ", he as (select *, case when status = 'empty' then 'empty' when stale then 'stale' when critical and n_entries > 0 and n_adopted = 0 then 'no_adopt' else 'ok' end as health from hh)"


def _health(spark, d):
    a, f = table(spark, d, "article"), table(spark, d, "feed")
    seen = a.groupBy("feed_id").agg(F.count("id").alias("n_entries"), F.max("published").alias("newest"))
    reports = f.select(F.col("id").alias("feed_id"), "critical").join(seen, "feed_id", "left").withColumn("n_entries", F.coalesce("n_entries", F.lit(0))).withColumn("status", F.when(F.col("n_entries") == 0, "empty").otherwise("ok"))
    return H.feed_health(reports, a.where("tier = 'T1'").select("feed_id", "id").distinct(), now())


@query("feed_health", f"with {_HEALTH} select feed_id, n_entries, n_adopted, stale, health from he")
def feed_health(spark, d):
    return _health(spark, d).select("feed_id", "n_entries", "n_adopted", "stale", "health")


@query("feed_health_report", f"with {_HEALTH} select count(*) as n_feeds, 0 as n_error, count(*) filter (health = 'empty') as n_empty, count(*) filter (health = 'stale') as n_stale, count(*) filter (health = 'no_adopt') as n_no_adopt, sum(n_adopted)::bigint as n_adopted, (count(*) filter (critical and health <> 'ok') = count(*) filter (critical) and count(*) filter (critical) > 0) or sum(n_adopted) = 0 as fatal from he")
def feed_health_report(spark, d):
    return H.health_report(_health(spark, d))


@query("feed_status_lines", f"with {_HEALTH} select feed_id, case when health = 'ok' then feed_id || ': ' || n_adopted || ' articles' when health = 'no_adopt' then feed_id || ': nothing adopted' else feed_id || ': ' || health end as line from he")
def feed_status_lines(spark, d):
    return _health(spark, d).select("feed_id", H.status_line(F.col("health"), F.col("feed_id"), F.col("n_adopted")).alias("line"))


@query("zombie_feeds", f"select feed_id, max(published) as newest, floor((epoch_us({SQL_NOW}) - epoch_us(max(published))) / 86400000000)::bigint as age from article group by 1 having floor((epoch_us({SQL_NOW}) - epoch_us(max(published))) / 86400000000) > 7")
def zombie_feeds(spark, d):
    return H.zombies(table(spark, d, "article"), now())


@query("unrated_topk", rf"with x as (select *, {_HOST} as h from article) select h as domain, count(*) as n_articles from x where bloc = 'unknown' and h is not null group by 1 order by 2 desc, 1 limit 20")
def unrated_topk(spark, d):
    a = table(spark, d, "article").withColumn("domain", norm_domain("source_domain")).withColumnRenamed("entry_ord", "ord")
    return H.unrated_queue(a.where("domain is not null")).select("domain", "n_articles")


@query("run_stats", "select count(distinct id) as n_articles, count(distinct feed_id) as n_feeds, count(distinct case when tier = 'T1' then id end) as n_t1, count(*) as n_entries from article")
def run_stats(spark, d):
    return table(spark, d, "article").agg(F.count_distinct("id").alias("n_articles"), F.count_distinct("feed_id").alias("n_feeds"), F.count_distinct(F.when(F.col("tier") == "T1", F.col("id"))).alias("n_t1"), F.count(F.lit(1)).alias("n_entries"))


# ---------------------------------------------------------------- views

@query("event_search", "select row_id from news_event where contains(lower(headline), 'drill') or len(list_filter(coalesce(articles, []), lambda x: contains(lower(coalesce(x.title, '')), 'drill') or contains(lower(coalesce(x.source_domain, '')), 'drill'))) > 0")
def event_search(spark, d):
    return table(spark, d, "news_event").where(V.matches(" Drill ", F.col("headline"), F.col("articles.title"), F.col("articles.source_domain"))).select("row_id")


@query("credibility_sort", "select row_id, row_number() over (order by case credibility.grade when 'A' then 0 when 'B' then 1 when 'C' then 2 when 'D' then 3 else 4 end, credibility.score desc nulls last, date_trunc('second', last_seen) desc nulls last, row_id) as place from news_event qualify place <= 200")
def credibility_sort(spark, d):
    e = table(spark, d, "news_event").select("row_id", "last_seen", F.col("credibility.grade").alias("grade"), F.col("credibility.score").alias("score"))
    top = V.by_credibility(e, "grade", "score", "last_seen", "row_id").limit(200)
    w = Window.orderBy(V.grade_rank(F.col("grade")), F.col("score").desc(), F.date_trunc("second", "last_seen").desc(), "row_id")
    return top.select("row_id", F.row_number().over(w).alias("place"))


@query("recent_events", "select row_id, row_number() over (order by date_trunc('second', last_seen) desc nulls last, credibility.score desc nulls last, row_id) as place from news_event qualify place <= 200")
def recent_events(spark, d):
    e = table(spark, d, "news_event").select("row_id", "last_seen", F.col("credibility.score").alias("score"))
    top = V.by_recency(e, "last_seen", "score", "row_id").limit(200)
    return top.select("row_id", F.row_number().over(Window.orderBy(F.date_trunc("second", "last_seen").desc(), F.col("score").desc(), "row_id")).alias("place"))


@query("event_filter", "select row_id from news_event where credibility.grade in ('A', 'B') and list_contains(langs, 'ko')")
def event_filter(spark, d):
    return table(spark, d, "news_event").where(F.col("credibility.grade").isin("A", "B") & F.array_contains("langs", "ko")).select("row_id")


@query("side_top_articles", f"with {_MEM} select side, id, rank from (select *, row_number() over (partition by side order by published desc, id) rank from (select distinct case when starts_with(bloc, 'state') then 'state' else 'other' end as side, id, min(published) over (partition by id) as published from mem)) where rank <= 40")
def side_top_articles(spark, d):
    m = members(spark, d).groupBy(F.when(F.col("bloc").startswith("state"), "state").otherwise("other").alias("side"), "id").agg(F.min("published").alias("published"))
    return V.top_of_side(m, "side", 40, [F.col("published").desc(), F.col("id")]).select("side", "id", "rank")


# ---------------------------------------------------------------- streaming

@query("stream_daily_tumble", "select cast(ts as date) as day, event_type, count(*) as n from events group by 1, 2")
def stream_daily_tumble(spark, d):
    from evidentia.scratch import Scratch
    from evidentia.streaming.events import daily, into_store

    scratch = Scratch(spark, "stream")
    src = table(spark, d, "events")
    stream = spark.readStream.schema(src.schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("at", F.col("ts").cast("timestamp"))
    counts = daily(stream, "at", "2 days", F.count(F.lit(1)).alias("n"), by=["event_type"])
    into_store(counts, lambda batch, _: batch.write.mode("overwrite").parquet(scratch.path("out")), scratch.path("ckpt"), "complete").awaitTermination()
    return spark.read.schema(counts.schema).parquet(scratch.path("out")).select(F.to_date("w.start").alias("day"), "event_type", "n")


@query("stream_dedupe", "select event_type, count(distinct event_id) as n from events group by 1")
def stream_dedupe(spark, d):
    import uuid

    from evidentia.scratch import Scratch
    from evidentia.streaming.events import deduplicated

    scratch = Scratch(spark, "stream")
    src = table(spark, d, "events")
    stream = spark.readStream.schema(src.schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("at", F.col("ts").cast("timestamp"))
    name = f"once_{uuid.uuid4().hex[:8]}"
    out = scratch.path(name)
    q = deduplicated(stream, "event_id", "at", "60 days").select("event_id", "event_type").writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch.path("ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema("event_id bigint, event_type string").parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("session_48h", "with g as (select user_id, ts, case when epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts)) >= 48 * 3600000000 then 1 else 0 end as cut from events), s as (select user_id, ts, sum(cut) over (partition by user_id order by ts rows unbounded preceding) no from g) select user_id, min(ts) as start_at, count(*) as n from s group by user_id, no")
def session_48h(spark, d):
    e = table(spark, d, "events")
    return e.groupBy("user_id", F.session_window(F.col("ts"), "48 hours").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("start_at")).select("user_id", "start_at", "n")
