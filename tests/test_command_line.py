"""Commands on small tables, streams with counters and trailing medians, reports of feeds."""

import datetime as dt
import json

from pyspark.sql import functions as F

from evidentia.__main__ import main
from evidentia.operators import health as H
from evidentia.operators import quality as Q
from evidentia.streaming import events as EV

T0 = dt.datetime(2026, 1, 10)
HEALTH = "feed_id string, name string, status string, error string, n_entries int, newest timestamp, critical boolean, n_adopted int, health string"
FEEDS = [("a", "Alpha", "ok", None, 9, T0, True, 3, "ok"), ("b", "Beta", "not_modified", None, 0, T0, False, 0, "ok"), ("c", "Gamma", "error", "timeout", 0, None, False, 0, "error"), ("d", "Delta", "ok", None, 5, dt.datetime(2025, 1, 1), False, 0, "stale")]


def test_build_and_health(spark, tmp_path, capsys):
    p, store = str(tmp_path / "policy"), str(tmp_path / "store")
    spark.createDataFrame([("alpha.test", "T1", "independent", "Alpha", None)], "domain string, tier string, bloc string, name string, bias string").write.parquet(p + "/outlets")
    spark.createDataFrame([("nat", "native", "en", "alpha.test", False)], "id string, kind string, lang string, source_domain string, needs_filter boolean").write.parquet(p + "/feeds")
    spark.createDataFrame([("nat", "ok", 2, T0, True)], "feed_id string, status string, n_entries int, newest timestamp, critical boolean").write.parquet(p + "/reports")
    (tmp_path / "policy" / "policy.json").write_text(json.dumps({"entities": {"drill": ["drill"]}, "anchors": ["drill"]}))
    rows = [("nat", k, t, "", f"https://alpha.test/{k}", None, None, T0) for k, t in enumerate(["budget vote in parliament fails", "bridge opens after long repair"])]
    spark.createDataFrame(rows, "feed_id string, entry_ord int, title string, summary string, link string, source_href string, source_title string, published timestamp").write.parquet(str(tmp_path / "entries"))
    assert main(["build", str(tmp_path / "entries"), store, "--policy", p, "--now", "2026-01-11"], spark) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["events"] == 2
    assert main(["health", store], spark) == 0 and "| nat |" in capsys.readouterr().out
    assert main(["selfcheck", store], spark) == 0


def test_metrics_and_bulletins(spark, tmp_path, capsys):
    c = str(tmp_path / "clusters")
    spark.createDataFrame([(k, str(k % 2), str(k % 2)) for k in range(8)], "id int, cluster string, label string").write.parquet(c)
    assert main(["metrics", c], spark) == 0 and json.loads(capsys.readouterr().out)["f1"] == 1.0
    pages, series = str(tmp_path / "pages"), str(tmp_path / "series")
    spark.createDataFrame([("Activities 2026.1.5 3 PLA aircraft were detected by noon",)], "html string").write.parquet(pages)
    assert main(["bulletins", pages, series], spark) == 0 and json.loads(capsys.readouterr().out) == {"rejected": 0, "added": 1, "skipped": 0, "failed": 0, "mismatched": 0, "written": True}
    assert main(["bulletins", pages, series], spark) == 0 and json.loads(capsys.readouterr().out) == {"rejected": 0, "added": 0, "skipped": 1, "failed": 0, "mismatched": 0, "written": False}


def test_feed_report(spark):
    h = spark.createDataFrame(FEEDS, HEALTH)
    text, warnings, fatal = H.markdown(h, {"events": 4})
    assert {r.feed_id: r.note for r in H.report_rows(h).collect()} == {"a": "9 entries, 3 adopted", "b": "unchanged since the last fetch", "c": "timeout", "d": "newest entry of 2025-01-01"}
    assert warnings == ["Gamma: timeout", "Delta: newest entry of 2025-01-01"] and fatal == [] and "events: 4" in text
    down = h.withColumn("health", F.lit("error")).withColumn("n_adopted", F.lit(0))
    assert H.markdown(down)[2] == ["no feed could be fetched", "all critical feeds down: 1", "no article adopted"]
    assert H.fatal_reasons(h.where("false")).first().reasons == ["no article adopted"]


def test_probes_and_snapshot(spark, tmp_path):
    assert Q.failed_probes(spark) == [] and len(Q.failed_probes(spark, [("3 ships", [4])], ["x"])) == 1
    (tmp_path / "s.json").write_text('{"id": "1", "title": "t"}\n')
    r = Q.load_snapshot(spark, str(tmp_path / "s.json")).first()
    assert (r.summary, r.hedged, r.primary_cited, r.tier) == ("", False, False, None)


def test_capped_sessions(spark):
    hours = [0, 40, 80, 100, 200, 201]
    df = spark.createDataFrame([("u", T0 + dt.timedelta(hours=h)) for h in hours], "k string, at timestamp")
    assert sorted((int((r.start_at - T0).total_seconds() // 3600), r.n) for r in EV.capped_sessions(df, "k", "at").collect()) == [(0, 2), (80, 2), (200, 2)]
