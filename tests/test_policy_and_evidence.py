"""Policy joins, ingest rules, grades and scores on a synthetic policy."""

import datetime as dt

from pyspark.sql import functions as F

from evidentia.operators import credibility as C
from evidentia.operators import ingest as I
from evidentia.operators import policy as P

OUTLETS = [("alpha.test", "T1", "independent"), ("beta.test", "T1", "independent"), ("gamma.test", "T2", "independent"), ("delta.test", "T2", "independent"), ("anal.test", "TA", "independent"), ("slant.test", "T4", "independent"), ("state1.test", "T3", "state_east"), ("state2.test", "T3", "state_east")]
T0 = dt.datetime(2026, 1, 1)
MEMBER = "event_id string, id string, ord int, title string, lang string, published timestamp, source_domain string, source_name string, tier string, bloc string, primary_cited boolean"
TITLES = ["Ships gather near northern harbour", "Council debates fishing quota", "Storm delays ferry timetable", "Minister opens bridge project"]


def outlets(spark):
    return spark.createDataFrame([(d, t, b, d.split(".")[0], None) for d, t, b in OUTLETS], "domain string, tier string, bloc string, name string, bias string")


def event(spark, domains, titles=None, langs=None, hours=None, name="e"):
    by = {d: (t, b) for d, t, b in OUTLETS}
    rows = [(name, f"{k:02d}", k, (titles or TITLES)[k], (langs or ["en"] * 9)[k], T0 + dt.timedelta(hours=(hours or [0] * 9)[k]), d, d, *by.get(d, ("T5", "unknown")), False) for k, d in enumerate(domains)]
    return spark.createDataFrame(rows, MEMBER)


def verdict(spark, *a, **k):
    return C.evaluate(event(spark, *a, **k)).first()


def test_longest_suffix_alias_and_default(spark):
    hosts = spark.createDataFrame([("a.b.alpha.test",), ("www.gamma.test",), ("nobody.test",), ("x.slant.test",), (None,)], "source_domain string")
    alias = spark.createDataFrame([("x.slant.test", "beta.test")], "alias string, domain string")
    got = {r.source_domain: (r.domain, r.tier, r.bloc) for r in P.classify(hosts, outlets(spark), aliases=alias).collect()}
    assert got == {"a.b.alpha.test": ("alpha.test", "T1", "independent"), "www.gamma.test": ("gamma.test", "T2", "independent"), "nobody.test": ("nobody.test", "T5", "unknown"), "x.slant.test": ("beta.test", "T1", "independent"), None: ("", "T5", "unknown")}


def test_age_bounds(spark):
    now = F.lit(dt.datetime(2026, 2, 1))
    ages = [dt.timedelta(hours=-24), dt.timedelta(hours=-24, seconds=-1), dt.timedelta(days=21, hours=23, minutes=59), dt.timedelta(days=22)]
    df = spark.createDataFrame([(k, dt.datetime(2026, 2, 1) - a) for k, a in enumerate(ages)], "k int, at timestamp")
    assert [r.k for r in df.where(I.in_age(now, F.col("at"))).orderBy("k").collect()] == [0, 2]


def test_gate_order(spark):
    gate = dict(subject="(?i)island", core="(?i)drill", context="(?i)ships", negative="(?i)stocks")
    df = spark.createDataFrame([("Drill on stocks", ""), ("A drill", ""), ("Ships", ""), ("Ships at island", ""), ("Island", "ships")], "t string, s string")
    assert [r[0] for r in df.select(I.passes_gate(F.col("t"), F.col("s"), **gate)).collect()] == ["negative", None, "no_subject", None, "no_topic"]


def test_first_reason_wins(spark):
    rows = [("<b>Long enough headline one</b> - Alpha", "sum", "https://x.test/1", "https://www.alpha.test/", "Alpha", T0, "aggregator", "en", None, True), ("short", "", "https://syn.test/1", None, "", T0, "aggregator", "en", None, False), ("short", "", "https://y.test/1", None, "", T0, "aggregator", "en", None, False), ("A good headline of today", "", "l", None, "", dt.datetime(2020, 1, 1), "native", "en", "beta.test", False)]
    df = spark.createDataFrame(rows, "title string, summary string, link string, source_href string, source_title string, published timestamp, kind string, feed_lang string, feed_domain string, needs_filter boolean")
    out = I.normalize_entries(df, F.lit(T0), dict(subject="x", core="headline", context="x", negative="zzz"), "reportedly", "ministry", ("enable scripts",), "aggregate.test", ["syn.test"], ["noise.test"])
    got = [(r.host, r.title, r.summary, r.drop_reason) for r in out.collect()]
    assert got == [("www.alpha.test", "Long enough headline one", "", None), ("syn.test", "short", "", "syndicator"), ("y.test", "short", "", "no_title"), ("beta.test", "A good headline of today", "", "too_old")]
    assert {r.drop_reason: r.n for r in I.drop_counts(out).collect()} == {"syndicator": 1, "no_title": 1, "too_old": 1}


def test_best_of_id(spark):
    df = spark.createDataFrame([("a", "", "T1", 1), ("a", "x.test", "T3", 2), ("a", "y.test", "T1", 3), ("a", "z.test", "T1", 4)], "id string, source_domain string, tier string, entry_ord int")
    r = I.best_of_id(df).first()
    assert (r.entry_ord, r.slot) == (3, 1)


def test_grades_and_scores(spark):
    one = verdict(spark, ["alpha.test"])
    assert (one.grade, one.n_independent, one.score) == ("B", 1, 29.3)
    assert verdict(spark, ["alpha.test", "beta.test"]).score == 49.2
    assert verdict(spark, ["alpha.test", "beta.test", "gamma.test"]).grade == "A"
    assert verdict(spark, ["gamma.test", "delta.test", "slant.test"]).grade == "B"
    s = verdict(spark, ["state1.test", "state2.test"])
    assert (s.grade, s.d_reason, s.n_independent) == ("D", "state_only", 1)
    assert verdict(spark, ["slant.test"]).d_reason == "partisan" and verdict(spark, ["anal.test"]).grade == "C"
    u = verdict(spark, ["n1.test", "n2.test", "n3.test"])
    assert (u.grade, u.d_reason, u.score, u.n_unrated) == ("D", "unrated", 2.1, 3)


def test_copies_count_once(spark):
    t = ["Eleven ships seen near northern harbour"] * 3
    assert verdict(spark, ["alpha.test", "beta.test", "gamma.test"], t).n_independent == 1
    differ = ["11 ships and 4 jets near harbour", "12 ships and 3 jets near harbour"]
    assert verdict(spark, ["alpha.test", "beta.test"], differ).n_independent == 2
    release = ["台海 40 架次 17 艦艇 通過", "Navy says 40 aircraft and 17 ships passed"]
    g = C.copy_groups(event(spark, ["alpha.test", "beta.test"], release, ["zh", "en"])).collect()
    assert {r.copy_group for r in g} == {"00"} and {r.kind for r in g} == {"release"}


def test_headline_and_event(spark):
    m = event(spark, ["state1.test", "beta.test", "alpha.test"], hours=[0, 5, 2])
    assert C.pick_headline(m).first().headline_source == "alpha.test"
    e = C.assemble(m).first()
    assert e.id.startswith("evt_20260101_") and e.articles == ["00", "02", "01"] and e.state_side == ["00"] and not e.cross_language
