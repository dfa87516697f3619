"""The whole build on a small corpus, twice."""

import datetime as dt

from pyspark.sql import functions as F

from evidentia.plans import build as B

T0 = dt.datetime(2026, 1, 10)
ENTRY = "feed_id string, entry_ord int, title string, summary string, link string, source_href string, source_title string, published timestamp"
FEED = "id string, kind string, lang string, source_domain string, needs_filter boolean"
OUTLET = "domain string, tier string, bloc string, name string, bias string"
REPORT = "feed_id string, status string, n_entries int, newest timestamp, critical boolean"


def entries():
    topics = ["budget vote in parliament", "bridge opens after long repair", "harvest fails in the south", "museum returns old paintings", "railway strike enters third week", "hospital wing named for nurse", "river floods two villages", "teachers win pay dispute"]
    rows = [("nat", k, f"{t} report number", "", f"https://alpha.test/{k}", None, None, T0) for k, t in enumerate(topics)]
    drill = "Navy drill Tesara brings 14 warships near Quay Island"
    rows += [("nat", 20, drill, "", "https://alpha.test/20", None, None, T0), ("agg", 21, drill + " - Beta", "", "https://x", "https://www.beta.test/", "Beta", T0 + dt.timedelta(hours=2)), ("agg", 22, "short", "", "https://x", "https://beta.test/", "Beta", T0), ("agg", 23, "Drill Tesara: fourteen islands ask why 14 warships sail - Gamma", "", "https://x", "https://gamma.test/", "Gamma", T0 + dt.timedelta(hours=3))]
    return rows


def test_build_twice(spark, tmp_path):
    feeds = spark.createDataFrame([("nat", "native", "en", "alpha.test", False), ("agg", "aggregator", "en", None, False)], FEED)
    outlets = spark.createDataFrame([("alpha.test", "T1", "independent", "Alpha", None), ("beta.test", "T2", "independent", "Beta", None), ("gamma.test", "T2", "independent", "Gamma", None)], OUTLET)
    reports = spark.createDataFrame([("nat", "ok", 9, T0, True), ("agg", "ok", 3, T0, False)], REPORT)
    policy = B.Policy(outlets, {"drill": ["drill"], "tesara": ["Tesara"], "navy": ["navy"]}, ["drill", "tesara"])
    now = F.lit(T0 + dt.timedelta(days=1))
    df = spark.createDataFrame(entries(), ENTRY)
    store = str(tmp_path)
    first = B.run_build(spark, df, feeds, reports, policy, now, store)
    assert first["dropped"] == {"no_title": 1} and not first["fatal"] and first["written"]
    events = spark.read.parquet(store + "/events")
    drill = events.where(F.size("articles") > 1).collect()
    assert len(drill) == 1 and drill[0].credibility.n_articles == len(drill[0].articles) >= 2 and drill[0].headline_source == "Alpha"
    assert events.count() == first["events"] == 9
    again = B.run_build(spark, df, feeds, reports, policy, now, store)
    assert not again["written"] and again["events"] == 9


def test_builds_far_apart_lose_no_archived_event(spark, tmp_path):
    """A build 20 days later: the first one's events leave the window but stay in the archive of their month."""
    feeds = spark.createDataFrame([("nat", "native", "en", "alpha.test", False)], FEED)
    outlets = spark.createDataFrame([("alpha.test", "T1", "independent", "Alpha", None)], OUTLET)
    reports = spark.createDataFrame([("nat", "ok", 9, T0, True)], REPORT)
    policy = B.Policy(outlets, {"drill": ["drill"]}, ["drill"])
    store = str(tmp_path)
    early = [("nat", k, t, "", f"https://alpha.test/{k}", None, None, dt.datetime(2026, 1, 3)) for k, t in enumerate(["budget vote in parliament fails", "bridge opens after long repair"])]
    late = [("nat", 9, "museum returns old paintings to owners", "", "https://alpha.test/9", None, None, dt.datetime(2026, 1, 24))]
    B.run_build(spark, spark.createDataFrame(early, ENTRY), feeds, reports, policy, F.lit(dt.datetime(2026, 1, 4)), store)
    second = B.run_build(spark, spark.createDataFrame(late, ENTRY), feeds, reports, policy, F.lit(dt.datetime(2026, 1, 24)), store)
    assert second["events"] == 1 and second["months"] == ["2026-01"]
    assert spark.read.parquet(store + "/archive").count() == 3


def test_a_shallow_build_keeps_the_deeper_verdict(spark):
    v = "id string, last_seen timestamp, articles array<string>, credibility struct<grade:string, n_articles:int>"
    one = lambda g, n, a: spark.createDataFrame([("e", T0, a, (g, n))], v)
    store = B.whole_store(one("A", 3, ["1", "2", "3"]), one("B", 2, ["1", "2"]))
    store = B.whole_store(store, one("C", 1, ["1"]))
    assert [(r.articles, tuple(r.credibility)) for r in store.collect()] == [(["1"], ("A", 3))]


def test_bulletins(spark):
    held = spark.createDataFrame([(dt.date(2026, 1, 1), 1, 1, 1, 0, 0, True)], "date date, aircraft int, navy_ships int, official_ships int, balloons int, crossed_median int, parse_ok boolean")
    page = lambda d, t: (f"PLA Activities 2026.1.{d} {t}",)
    pages = spark.createDataFrame([page(1, "3 PLA aircraft were detected by noon"), page(2, "3 PLA aircraft and 2 PLAN ships were detected by noon"), page(3, "were detected by noon")], "html string")
    series, counts = B.run_bulletins(pages, "html", held)
    assert counts == {"rejected": 1, "added": 1, "skipped": 1, "failed": 0, "mismatched": 0}
    assert {str(r.date): r["index"] for r in series.collect()} == {"2026-01-01": 4, "2026-01-02": 7}
    listed = pages.withColumn("listed", F.lit(dt.date(2026, 1, 2))).unionByName(spark.createDataFrame([(None, dt.date(2026, 1, 9))], "html string, listed date"))
    assert {k: v for k, v in B.run_bulletins(listed, "html", held)[1].items() if k in ("failed", "mismatched")} == {"failed": 1, "mismatched": 2}
