"""Queries of the text operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia.llm.components import group_ids
from evidentia.llm.hash_forest import split_batches
from evidentia.llm.language import fit, identify
from evidentia.llm.mixture import mix
from evidentia.llm.near_titles import near_pairs
from evidentia.llm.one_form import one_form
from evidentia.llm.residue import flag, mark_residue, notice_messages
from evidentia.llm.sentences import sentences
from evidentia.llm.tokens import encode
from evidentia.scratch import Scratch
from evidentia.sources.tables import norm_id, table


def listed_pairs(events):
    """(a, b): each event row's first listed id with every other one, a star in place of all pairs."""
    ids = F.array_sort(F.array_distinct(F.filter(F.transform("articles.id", norm_id), lambda x: x.isNotNull())))
    rows = events.select(ids.alias("ids")).where("size(ids) > 1")
    return rows.select(F.element_at("ids", 1).alias("a"), F.explode(F.slice("ids", F.lit(2), F.size("ids") - 1)).alias("b"))


#: A set of ids up to this size is broadcast to the scan that looks them up (a few MB of keys); a larger one is joined by shuffle.
_BROADCAST_IDS = 200_000


def _articles(spark, sf_dir, *columns):
    names = dict.fromkeys([*columns, "title", "source_name", "source_domain", "published"])
    return table(spark, sf_dir, "article").select(norm_id("id").alias("id"), *names).where("id is not null")


def _residue_among(spark, sf_dir, ids):
    """The ids, of those given (a written table), whose title is residue; messages are mined from all titles."""
    articles = _articles(spark, sf_dir)
    verdict = notice_messages(articles)
    wanted = ids.select("id").distinct()
    wanted = F.broadcast(wanted) if ids.count() <= _BROADCAST_IDS else wanted
    return flag(articles.join(wanted, "id", "left_semi"), verdict).where("residue is not null").select("id").distinct()


def p1_segments(spark, sf_dir):
    return identify(_articles(spark, sf_dir, "lang"), fit(table(spark, sf_dir, "article")))


def p1_found(spark, sf_dir):
    found = p1_segments(spark, sf_dir).where("label is null or label <> lang").select("id", "lang").distinct()
    found = Scratch(spark, "p1").keep(found, "found")
    return found.join(_residue_among(spark, sf_dir, found), "id", "left_anti")


def p2_found(spark, sf_dir):
    pairs = table(spark, sf_dir, "match_pair").select(norm_id("id_a").alias("a"), norm_id("id_b").alias("b"))
    return group_ids(spark, pairs.unionByName(listed_pairs(table(spark, sf_dir, "news_event"))))


def p3_found(spark, sf_dir):
    return split_batches(table(spark, sf_dir, "news_event"))[1]


def p3_accepted(spark, sf_dir):
    return split_batches(table(spark, sf_dir, "news_event"))[0]


def p5_forms(spark, sf_dir):
    """(field, id, text_hash, form) of titles and summaries."""
    articles = table(spark, sf_dir, "article").select(norm_id("id").alias("id"), F.explode(F.array(F.struct(F.lit("title").alias("field"), F.col("title").alias("text")), F.struct(F.lit("summary").alias("field"), F.col("summary").alias("text")))).alias("x"))
    return one_form(articles.select("id", "x.field", "x.text").where("id is not null and text <> ''"), ["field", "id"])


def p5_found(spark, sf_dir):
    scratch = Scratch(spark, "forms")
    # the form as two hashes: what is compared below is 128 bits wide, and no text is moved
    rows = scratch.keep(p5_forms(spark, sf_dir).select("field", "id", "text_hash", F.xxhash64("form").alias("h1"), F.xxhash64("form", F.lit(7)).alias("h2")), "rows")
    form = ["field", "h1", "h2"]
    several = rows.groupBy(*form).agg(F.min("text_hash").alias("lo"), F.max("text_hash").alias("hi")).where("lo <> hi").select(*form)
    hits = scratch.keep(rows.join(several, form).distinct(), "hits")
    residue = _residue_among(spark, sf_dir, hits).withColumn("field", F.lit("title"))
    hits = scratch.keep(hits.join(residue, ["field", "id"], "left_anti"), "content")
    a, b = hits.select(*form, F.col("id").alias("id_a"), F.col("text_hash").alias("ta")), hits.select(*form, F.col("id").alias("id_b"), F.col("text_hash").alias("tb"))
    return a.join(b, form).where("id_a < id_b and ta <> tb").select("field", "id_a", "id_b").distinct()


def p6_found(spark, sf_dir):
    return mark_residue(_articles(spark, sf_dir)).where("residue is not null").select("id").distinct()


def p7_groups(spark, sf_dir):
    """(id, group_id) of articles whose outlet published their headline again within hours."""
    scratch = Scratch(spark, "p7")
    pairs = scratch.keep(near_pairs(_articles(spark, sf_dir)), "pairs")
    ids = scratch.keep(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    residue = scratch.keep(_residue_among(spark, sf_dir, ids), "residue")
    content = pairs.join(residue.withColumnRenamed("id", "a"), "a", "left_anti").join(residue.withColumnRenamed("id", "b"), "b", "left_anti")
    return group_ids(spark, content.select("a", "b"))


def p7_found(spark, sf_dir):
    groups = Scratch(spark, "p7").keep(p7_groups(spark, sf_dir), "groups")
    a, b = groups.select("group_id", F.col("id").alias("id_a")), groups.select("group_id", F.col("id").alias("id_b"))
    return a.join(b, "group_id").where("id_a < id_b").select("id_a", "id_b")


def p8_ids(spark, sf_dir):
    return encode(table(spark, sf_dir, "documents"))


def p9_mix(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_target"))[0]


def p9_shares(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_target"))[1]


def p9_margins(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_target"))[2]


def p10_found(spark, sf_dir):
    return sentences(table(spark, sf_dir, "documents"))


QUERIES = {"p1_found": p1_found, "p1_segments": p1_segments, "p2_found": p2_found, "p3_found": p3_found, "p3_accepted": p3_accepted, "p5_found": p5_found, "p5_forms": p5_forms, "p6_found": p6_found, "p7_found": p7_found, "p7_groups": p7_groups, "p8_ids": p8_ids, "p10_found": p10_found, "p9_mix": p9_mix, "p9_shares": p9_shares, "p9_margins": p9_margins}
_P2 = r"""
with recursive m as (select nullif(lower(trim(id_a, ' ' || chr(9))), '') as a, nullif(lower(trim(id_b, ' ' || chr(9))), '') as b from match_pair),
 l as (select row_id, unnest(list_distinct(list_filter(list_transform(articles, lambda x: nullif(lower(trim(x.id, ' ' || chr(9))), '')), lambda i: i is not null))) as id from news_event where articles is not null),
 f as (select row_id, min(id) as a from l group by 1),
 s as (select a, b from m where a is not null and b is not null and a <> b union select f.a, l.id from l join f using (row_id) where l.id <> f.a),
 e as (select a, b from s union select b, a from s),
 r as (select a as id, a as x from e union select r.id, e.b from r join e on r.x = e.a)
select id, min(x) as group_id from r group by id
"""

# rows one after the other: the accepted ones so far are the state of the recursion
_P3 = r"""
with recursive l as (select row_id, nullif(lower(trim(id, ' ' || chr(9))), '') as event, list_distinct(list_filter(list_transform(coalesce(articles, []), lambda x: nullif(lower(trim(x.id, ' ' || chr(9))), '')), lambda i: i is not null)) as ids from news_event),
 u as (select row_id, len(ids) as n, unnest(ids) as i from l),
 s as (select a.row_id as a, b.row_id as b from u a join u b on a.i = b.i and a.row_id < b.row_id group by a.row_id, b.row_id, a.n, b.n having 3 * count(*) > a.n + b.n),
 r as (select a, b from s union select a.row_id, b.row_id from l a join l b on a.event = b.event and a.row_id < b.row_id),
 near as (select l.row_id, row_number() over (order by l.row_id) as k, coalesce(g.before, []) as before from l left join (select b, list(a) as before from r group by b) g on g.b = l.row_id),
 run as (select 0::bigint as k, []::bigint[] as accepted union all select near.k, case when list_has_any(near.before, run.accepted) then run.accepted else list_append(run.accepted, near.row_id) end from run join near on near.k = run.k + 1),
 ok as (select unnest(accepted) as row_id from run where k = (select max(k) from run))
"""

ORACLE = {"p2_found": _P2, "p3_found": _P3 + " select a as row_a, b as row_b from r join ok on r.a = ok.row_id where b not in (select row_id from ok)", "p3_accepted": _P3 + " select row_id from ok"}
