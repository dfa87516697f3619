"""Queries of the engine's own operators over small article tables."""

import datetime as dt
import math
import re

from evidentia.operators import revisions as R
from evidentia.plans import reference_queries as Q

T0 = dt.datetime(2026, 1, 1)
ARTICLE = "id string, title string, summary string, published timestamp, source_domain string, tier string, lang string, entry_ord bigint"


def articles(spark, folder, rows):
    """(id, title, summary, hours after T0 or None) as the article table of a folder."""
    data = [(i, t, s, None if h is None else T0 + dt.timedelta(hours=h), "alpha.test", "T1", "en", k) for k, (i, t, s, h) in enumerate(rows)]
    spark.createDataFrame(data, ARTICLE).write.parquet(f"{folder}/article.parquet")
    return str(folder)


FILL = [(f"f{k}", f"Quarterly {w} report", None, 0) for k, w in enumerate("harvest orchestra museum railway pottery football".split())]
SAME = "Two crews of the northern fleet met at the ruined lighthouse for 340 flares and a drill"


def test_linkage_reads_the_summary(spark, tmp_path):
    d = articles(spark, tmp_path, [("a", "Morning notes", SAME, 0), ("b", "Evening digest", SAME, 1), ("c", "Evening letters", None, 1), *FILL])
    clusters = {r.id: r.cluster_id for r in Q.lang_clusters(spark, d).collect()}
    assert clusters["a"] == clusters["b"] == "a" and clusters["c"] == "c"


def test_top_terms_read_the_summary(spark, tmp_path):
    d = articles(spark, tmp_path, [("a", "Morning notes", "Ruined lighthouse", 0)])
    assert {r.term for r in Q.tfidf_top_terms(spark, d).collect()} == {"morning", "notes", "ruined", "lighthouse", "morning notes", "notes ruined", "ruined lighthouse"}


def test_a_merge_opens_by_a_figure_of_the_summary(spark, tmp_path):
    d = articles(spark, tmp_path, [("a", "Morning notes", "About 340 of them", 0), ("b", "아침 소식", "모두 340 발", 1), *FILL])
    events = {r.id: r.event_id for r in Q.cross_merge(spark, d).collect()}
    assert events["a"] == events["b"] == "a"


def test_articles_without_a_time_are_published_now(spark, tmp_path):
    long = "Northern council votes on ferry quota after a storm closes the old harbour bridge"
    d = articles(spark, tmp_path, [("a", long, None, None), ("b", long + " today", None, None), ("c", long, None, 0), *FILL])
    kept = {r.id: r.kept_id for r in Q.revision_dedupe(spark, d).collect()}
    assert len(kept) == 9 and kept["a"] == kept["b"] == "b" and kept["c"] == "c"
    clusters = {r.id: r.cluster_id for r in Q.lang_clusters(spark, d).collect()}
    assert len(clusters) == 9 and clusters["a"] == clusters["b"] == "a" and clusters["c"] == "c"


def test_revisions_keep_an_article_without_a_time(spark):
    row = ("a", "Northern council votes on ferry quota after a storm", None, None, "alpha.test", "T1", "en", 0)
    got = R.dedupe_revisions(spark.createDataFrame([row], ARTICLE)).collect()
    assert [(r.id, r.kept_id) for r in got] == [("a", "a")]


def test_signatures_hold_summary_and_figures(spark, tmp_path):
    d = articles(spark, tmp_path, [("aa1", "Morning notes", "A frigate fired 340 flares", 0), ("ab1", "Navy drill", None, None), ("ac1", "7 boats", "", 0)])
    assert {r.id: set(r.signature) for r in Q.signature_extract(spark, d).collect()} == {"aa1": {"warship", "n:340"}, "ab1": {"navy", "drill"}, "ac1": {"n:7"}}
    assert {r.element: (r.df, r.n) for r in Q.signature_stats(spark, d).collect()} == {x: (1, 3) for x in ("warship", "n:340", "navy", "drill", "n:7")}
    assert {(r.cluster_id, r.element) for r in Q.signature_consensus(spark, d).collect()} == {("aa", "warship"), ("aa", "n:340"), ("ab", "navy"), ("ab", "drill"), ("ac", "n:7")}
    assert {r.id: set(r.opens) for r in Q.signature_anchors(spark, d).collect()} == {"aa1": {"n:340"}, "ab1": {"drill"}, "ac1": set()}


def test_overlap_of_tiers_by_figures(spark, tmp_path):
    rows = [("a", "Notes", "340 flares", T0, "x.test", "T1", "en", 0), ("b", "340 flares, a drill", None, T0, "y.test", "T2", "en", 1)]
    spark.createDataFrame(rows, ARTICLE).write.parquet(f"{tmp_path}/article.parquet")
    got = Q.signature_overlap_pairs(spark, str(tmp_path)).collect()
    assert [(r.a, r.b, r.overlap, r.shared) for r in got] == [("T1", "T2", 1.0, round(math.log(2), 9))]


def plain_weights(docs):
    """{id: {term: weight}} of (id, lang, terms)."""
    out = {}
    for i, lang, terms in docs:
        own = [t for _, x, t in docs if x == lang]
        v = {t: (1 + math.log(terms.count(t))) * (math.log((1 + len(own)) / (1 + sum(t in o for o in own))) + 1) for t in set(terms)}
        norm = math.sqrt(sum(x * x for x in v.values()))
        out[i] = {t: x / norm for t, x in v.items()}
    return out


def words(text):
    w = [x for x in re.sub(r"[^a-z0-9 ]", " ", text.lower()).split() if len(x) > 1]
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def grams(text):
    w = f" {text} "
    return [w[k: k + n] for n in (2, 3) for k in range(len(w) - n + 1)]


def test_terms_pairs_equal_the_plain_procedure(spark, tmp_path):
    rows = [("a", "Harbour bridge closed,", "after a storm", 0), ("b", "Harbour bridge closed after a", "storm!", 3), ("c", "Ferry quota voted", None, None), ("d", "Ferry quota voted again", None, None), ("e", "北方议会讨论渡轮配额", None, 0), ("f", "北方议会再讨论渡轮配额", "", 2), ("g", "Harbour bridge closed", "after a storm", 90)]
    labels = ["en", "EN", "eng", None, "zh", "zh-CN", "en-US"]
    data = [(i, t, s, None if h is None else T0 + dt.timedelta(hours=h), "alpha.test", "T1", x, k) for k, ((i, t, s, h), x) in enumerate(zip(rows, labels))]
    spark.createDataFrame(data, ARTICLE).write.parquet(f"{tmp_path}/article.parquet")
    d = str(tmp_path)
    docs = [(i, "zh" if i in "ef" else "en", grams(t) if i in "ef" else words(f"{t} {s or ''}")) for i, t, s, _ in rows]
    want = plain_weights(docs)
    got = {(r.id, r.term): r.w for r in Q.terms_tfidf_weights(spark, d).collect()}
    assert got.keys() == {(i, t) for i, v in want.items() for t in v} and all(abs(w - want[i][t]) < 2e-6 for (i, t), w in got.items())
    at = {i: 1e4 if h is None else h for i, _, _, h in rows}
    lang = {i: x for i, x, _ in docs}
    cos = {(i, j): sum(w * want[j].get(t, 0) for t, w in want[i].items()) for i in want for j in want if i < j and lang[i] == lang[j] and abs(at[i] - at[j]) <= 48}
    assert {(r.a, r.b): r.cos for r in Q.terms_cosine_pairs(spark, d).collect()} == {p: round(c, 6) for p, c in cos.items() if c > 0.5}
    assert {p for p, c in cos.items() if c > 0.5} == {("a", "b"), ("c", "d"), ("e", "f")}
