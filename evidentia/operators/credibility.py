"""Evidence of events: copies collapsed, independent voices counted, graded, scored, explained.

Input is one row per (event_id, article): id, title, lang, published, source_domain, source_name, tier, bloc,
primary_cited, ord.  All steps are grouped aggregations and equi-joins; copies become groups by label propagation, so
no task holds an event.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.functions.text import containment, numbers_conflict, sha1_nul, title_numbers, title_text, title_tokens
from evidentia.operators.linkage import link_groups
from evidentia.operators.policy import independence_key, tier_weight
from evidentia.scratch import Scratch

# Copies and releases; weights of the strongest voices; parts of the score; words that announce a tally.
COPY_CONTAINMENT, COPY_MIN_TOKENS, TALLY_MIN_NUMBER, TALLY_MIN_SHARED = 0.75, 3, 4, 2
EVIDENCE = (1.0, 0.6, 0.35, 0.2)
TALLY = "(?i)sortie|aircraft|warplane|ships?|vessels?|架次|機艦|机舰|軍機|军机|共機|共机|艦艇|舰艇|共艦|共舰|군용기|함정|항공기|척"


#: Stands between an event and a member where they name one node.
_OF = "\x1f"
MEMBER = ("event_id", "id", "ord", "title", "lang", "published", "source_domain", "source_name", "tier", "bloc", "primary_cited")


def copy_edges(members: DataFrame, ascii_only: bool = False) -> DataFrame:
    """(event_id, a, b, kind): links that join all members of an event that carry one text (wire) or one release (release).

    Equal titles are linked to the first of them, and so are titles that share the same two figures of a tally: both
    relations hold for all of them at once. Different texts meet by the rarest tokens of the smaller one: of n tokens at
    least three quarters must be shared, so one of its n - need + 1 rarest is.
    """
    scratch = Scratch(members.sparkSession, "copies")
    m = members.withColumn("_text", title_text(F.col("title"), ascii_only)).select("event_id", "id", "ord", F.coalesce("lang", F.lit("")).alias("lang"), title_numbers("title").alias("nums"), title_tokens(F.col("_text"), F.col("lang")).alias("toks"), F.col("title").rlike(TALLY).alias("tally"))
    m = m.withColumn("sig", F.md5(F.to_json(F.struct("lang", F.array_sort("toks"), "nums", "tally"))))
    m = scratch.keep(m, "tokens")  # taken apart once
    texts = m.groupBy("event_id", "sig").agg(F.min(F.struct("ord", "id"))["id"].alias("key"), F.first("lang").alias("lang"), F.first("nums").alias("nums"), F.first("toks").alias("toks"), F.first("tally").alias("tally"), F.count(F.lit(1)).alias("n"))
    texts = scratch.keep(texts, "texts")
    large = lambda nums: F.filter(nums, lambda n: n >= TALLY_MIN_NUMBER)
    release = F.col("tally") & (F.size(large(F.col("nums"))) >= TALLY_MIN_SHARED)
    kind = F.when(F.size("toks") >= COPY_MIN_TOKENS, "wire").when(release, "release")
    equal = m.join(texts.where("n > 1").select("event_id", "sig", F.col("key").alias("a"), kind.alias("kind")), ["event_id", "sig"]).where("id <> a and kind is not null").select("event_id", "a", F.col("id").alias("b"), "kind")
    # releases: both tell a tally and share two figures
    figures = F.array_sort(large(F.col("nums")))
    two = F.flatten(F.transform(figures, lambda x: F.transform(F.filter(figures, lambda y: y > x), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    told = texts.where(release).select("event_id", "key", F.explode(two).alias("two"))
    first = told.groupBy("event_id", "two").agg(F.min("key").alias("a"))
    tallies = told.join(first, ["event_id", "two"]).where("a <> key").select("event_id", "a", F.col("key").alias("b"), F.lit("release").alias("kind")).distinct()
    # one text with edits
    some = texts.where(F.size("toks") >= COPY_MIN_TOKENS).select("event_id", "key", "lang", F.size("toks").alias("n"), F.explode("toks").alias("tok"))
    often = some.groupBy("event_id", "lang", "tok").agg(F.count(F.lit(1)).alias("df"))
    ranked = some.join(often, ["event_id", "lang", "tok"]).where("df > 1").withColumn("rank", F.row_number().over(Window.partitionBy("event_id", "key").orderBy("df", "tok")))
    # tokens that no other text has cannot meet, but they count among the rarest
    lone = some.join(often.where("df = 1"), ["event_id", "lang", "tok"]).groupBy("event_id", "key").agg(F.count(F.lit(1)).alias("lone"))
    ranked = ranked.join(lone, ["event_id", "key"], "left").withColumn("rank", F.col("rank") + F.coalesce("lone", F.lit(0)))
    head = ranked.where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * COPY_CONTAINMENT) + 1)
    small = head.select("event_id", "lang", "tok", F.col("key").alias("s"), F.col("n").alias("ns"))
    big = ranked.select("event_id", "lang", "tok", F.col("key").alias("g"), F.col("n").alias("ng"))
    pairs = small.join(big, ["event_id", "lang", "tok"]).where("s <> g and ns <= ng").select("event_id", F.least("s", "g").alias("a"), F.greatest("s", "g").alias("b")).distinct()
    left, right = (texts.select("event_id", F.col("key").alias(x), F.col("nums").alias(f"{x}_nums"), F.col("toks").alias(f"{x}_toks")) for x in ("a", "b"))
    close = pairs.join(left, ["event_id", "a"]).join(right, ["event_id", "b"]).where(~numbers_conflict(F.col("a_nums"), F.col("b_nums")) & (containment(F.col("a_toks"), F.col("b_toks")) >= COPY_CONTAINMENT))
    return equal.unionByName(tallies).unionByName(close.select("event_id", "a", "b", F.lit("wire").alias("kind")))


def copy_groups(members: DataFrame, ascii_only: bool = False) -> DataFrame:
    """(event_id, id, copy_group, kind): the group's smallest id; kind wire if any link of the group is, else release, null alone."""
    scratch = Scratch(members.sparkSession, "groups")
    node = lambda id: F.concat(F.col("event_id").cast("string"), F.lit(_OF), F.col(id))
    edges = scratch.keep(copy_edges(members, ascii_only).select(node("a").alias("a"), node("b").alias("b"), "kind"), "edges")
    parts = link_groups(members.sparkSession, edges, scratch, "parts")
    kinds = edges.join(parts.withColumnRenamed("node", "a"), "a").groupBy("component").agg(F.when(F.bool_or(F.col("kind") == "wire"), "wire").otherwise("release").alias("kind"))
    linked = parts.join(kinds, "component").select("node", F.substring_index("component", _OF, -1).alias("copy_group"), "kind")
    return members.select("event_id", "id", node("id").alias("node")).join(linked, "node", "left").select("event_id", "id", F.coalesce("copy_group", "id").alias("copy_group"), "kind")


def representatives(members: DataFrame, groups: DataFrame) -> DataFrame:
    """One member per copy group: the heaviest tier, the earliest, the first."""
    m = members.select(*MEMBER).join(groups, ["event_id", "id"])
    w = Window.partitionBy("event_id", "copy_group").orderBy(tier_weight(F.col("tier"), 0.0).desc(), "published", "ord")
    return m.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _voice(reps: DataFrame) -> Column:
    return independence_key(F.col("source_domain"), F.col("bloc"), F.col("affiliate") if "affiliate" in reps.columns else None)


def independent_counts(reps: DataFrame) -> DataFrame:
    """(event_id, n_independent, n_unrated, n_originals); a column affiliate, where there is one, joins outlets of a group."""
    key = _voice(reps)
    return reps.groupBy("event_id").agg(F.count_distinct(F.when(F.col("bloc") != "unknown", key)).alias("n_independent"), F.count_distinct(F.when(F.col("bloc") == "unknown", F.col("source_domain"))).alias("n_unrated"), F.count(F.lit(1)).alias("n_originals"))


def evidence(reps: DataFrame) -> DataFrame:
    """(event_id, evidence): the strongest voices, one weight per independent one and one for all unrated together, with decreasing coefficients."""
    rated = reps.where("bloc <> 'unknown'").groupBy("event_id", _voice(reps).alias("key")).agg(F.max(tier_weight(F.col("tier"))).alias("w")).select("event_id", "w")
    unrated = reps.where("bloc = 'unknown'").groupBy("event_id").agg((0.30 * F.max(tier_weight(F.col("tier")))).alias("w"))
    ranked = rated.unionByName(unrated).withColumn("k", F.row_number().over(Window.partitionBy("event_id").orderBy(F.col("w").desc()))).where("k <= 4")
    coefficient = F.element_at(F.array(*map(F.lit, EVIDENCE)), F.col("k"))
    return ranked.groupBy("event_id").agg(F.least(F.lit(1.0), F.sum(F.col("w") * coefficient) / sum(EVIDENCE)).alias("evidence"))


def grade(n: Column, state_only: Column, best_tier: Column) -> tuple[Column, Column]:
    """(grade, reason of a D)."""
    one = n == 1
    g = F.when(n == 0, "D").when(one & (state_only | best_tier.isin("T4", "T5")), "D").when(one & (best_tier == "T1"), "B").when(one, "C").when((n >= 3) & best_tier.isin("T1", "TA"), "A").otherwise("B")
    r = F.when(n == 0, "unrated").when(one & state_only, "state_only").when(one & best_tier.isin("T4", "T5"), "partisan")
    return g, r


def _named(names: dict[str, str] | None) -> Callable[[Column], Column]:
    """A column's name from a dict, itself where none is known."""
    if not names:
        return lambda c: c
    known = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return lambda c: F.coalesce(F.try_element_at(known, c), c)


def evaluate(members: DataFrame, ascii_only: bool = False, affiliates: DataFrame | None = None, bloc_names: dict[str, str] | None = None, tier_names: dict[str, str] | None = None, opposed: tuple[str, str] | None = None) -> DataFrame:
    """One verdict per event: counts, grade, score, reasons. Further columns of members are ignored.

    affiliates (domain, affiliate): outlets that count as one voice; opposed: two blocs whose joint presence is a reason.
    """
    bloc_name, tier_name = _named(bloc_names), _named(tier_names)
    scratch = Scratch(members.sparkSession, "verdicts")
    members = scratch.keep(members.select(*MEMBER), "members")
    groups = scratch.keep(copy_groups(members, ascii_only), "groups")
    reps = scratch.keep(representatives(members, groups), "representatives")
    if affiliates is not None:
        reps = reps.join(affiliates.select(F.col("domain").alias("source_domain"), "affiliate"), "source_domain", "left")
    base = members.groupBy("event_id").agg(
        F.max_by("tier", tier_weight(F.col("tier"), 0.0)).alias("top_tier"), F.bool_or("primary_cited").alias("primary_cited"),
        F.count_distinct("lang").alias("n_langs"), F.array_sort(F.collect_set("bloc")).alias("blocs"), F.count(F.lit(1)).alias("n_articles"),
        F.count_distinct(F.when(F.col("source_domain") != "", F.col("source_domain"))).alias("n_domains"),
        ((F.unix_micros(F.max("published")) - F.unix_micros(F.min("published"))) / 3.6e9).alias("hours"),
    )
    e = base.join(independent_counts(reps), "event_id").join(evidence(reps), "event_id", "left")
    rated = F.filter("blocs", lambda b: b != "unknown")
    state_only = (F.size(rated) > 0) & ~F.array_contains(rated, "independent")
    g, r = grade(F.col("n_independent"), state_only, F.col("top_tier"))
    score = 50 * F.coalesce("evidence", F.lit(0.0)) + 24 * F.least("n_independent", F.lit(4)) / 4 + F.when(F.col("n_langs") >= 2, 11).otherwise(0) + F.when(F.col("primary_cited"), 7).otherwise(0) + 8 * F.least(F.lit(1.0), F.log1p("hours") / F.log1p(F.lit(72.0)))
    others = members.select("event_id", "id", "source_name").join(groups, ["event_id", "id"]).join(reps.select("event_id", "copy_group", F.col("id").alias("rep"), F.col("source_name").alias("first")), ["event_id", "copy_group"]).where("id <> rep")
    carried = others.groupBy("event_id", "copy_group", "first", "kind").agg(F.count(F.lit(1)).alias("n"), F.slice(F.array_sort(F.collect_set("source_name")), 1, 3).alias("names"))
    told = F.when(F.col("kind") == "wire", F.concat("first", F.lit(": text carried by "), F.array_join("names", ", "), F.lit(", counted once"))).otherwise(F.concat("first", F.lit(" and others: figures of one release, counted once")))
    notes = carried.groupBy("event_id").agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), told.alias("note")))), 1, 3), lambda x: x["note"]).alias("notes"))
    e = e.join(notes, "event_id", "left").withColumns({"grade": g, "d_reason": r, "score": F.bround(F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)), 1), "state_only": state_only})
    states = F.filter(rated, lambda b: b != "independent")
    reasons = F.array_compact(F.array(
        F.when(F.col("n_independent") == 0, "only unrated outlets").when((F.col("n_independent") == 1) & (F.size(rated) == 1) & (F.size(states) == 1), F.concat(bloc_name(F.get(states, F.lit(0))), F.lit(" alone"))).when(F.col("n_independent") == 1, "one independent voice").otherwise(F.concat("n_independent", F.lit(" independent voices"))),
        F.concat(F.lit("best tier "), tier_name(F.col("top_tier"))),
        F.when(F.col("n_langs") >= 2, F.concat("n_langs", F.lit(" languages"))),
        F.when(F.array_contains("blocs", opposed[0]) & F.array_contains("blocs", opposed[1]), F.concat(bloc_name(F.lit(opposed[0])), F.lit(" and "), bloc_name(F.lit(opposed[1])), F.lit(" both report it"))) if opposed else F.lit(None).cast("string"),
        F.when(F.col("primary_cited"), "official statement cited"),
    ))
    late = F.array_compact(F.array(F.when(F.col("n_unrated") > 0, F.concat("n_unrated", F.lit(" unrated outlets more"))), F.when(F.col("state_only"), F.concat(F.lit("only announced by "), F.array_join(F.transform(states, bloc_name), ", ")))))
    return e.select("event_id", "grade", "d_reason", "score", "n_independent", "n_unrated", "n_originals", "n_articles", "n_domains", "blocs", "top_tier", "primary_cited", F.concat(reasons, F.coalesce("notes", F.array().cast("array<string>")), late).alias("reasons"))


def pick_headline(members: DataFrame) -> DataFrame:
    """Per event the title of the heaviest, then independent, then earliest article."""
    rank = F.struct(tier_weight(F.col("tier"), 0.0).alias("w"), (F.col("bloc") == "independent").cast("int").alias("i"), (-F.unix_micros("published")).alias("t"), (-F.col("ord")).alias("o"))
    return members.groupBy("event_id").agg(F.max_by(F.struct("title", "source_name", "lang"), rank).alias("h")).select("event_id", F.col("h.title").alias("headline"), F.col("h.source_name").alias("headline_source"), F.col("h.lang").alias("headline_lang"))


def assemble(members: DataFrame) -> DataFrame:
    """Event id from day and smallest article id, span, languages, perspectives, members in time."""
    return members.groupBy("event_id").agg(
        F.min("published").alias("first_seen"), F.max("published").alias("last_seen"), F.min("id").alias("anchor"), F.array_sort(F.collect_set("lang")).alias("langs"),
        F.array_sort(F.collect_set(F.when(F.col("bloc").startswith("state"), F.col("id")))).alias("state_side"), F.array_sort(F.collect_set(F.when(~F.col("bloc").startswith("state"), F.col("id")))).alias("other_side"),
        F.transform(F.array_sort(F.collect_list(F.struct("published", "ord", "id"))), lambda x: x["id"]).alias("articles"),
    ).select(F.concat(F.lit("evt_"), F.date_format("first_seen", "yyyyMMdd"), F.lit("_"), F.substring(sha1_nul(F.col("anchor")), 1, 6)).alias("id"), "event_id", "first_seen", "last_seen", "langs", (F.size("langs") > 1).alias("cross_language"), "state_side", "other_side", "articles")
