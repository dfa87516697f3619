"""Store, quality, health, views, sources and streaming."""

import datetime as dt
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from evidentia.operators import health as H
from evidentia.operators import quality as Q
from evidentia.operators import store as ST
from evidentia.operators import views as V
from evidentia.sources import feeds as S
from evidentia.streaming import events as EV

T0 = dt.datetime(2026, 1, 1)
E = "id string, n_articles int, credibility string, articles array<string>"


def test_upsert_and_ghosts(spark):
    old = spark.createDataFrame([("a", 5, "old", ["1"]), ("b", 1, "old", ["2", "3"]), ("g", 1, "old", ["9"]), ("n", 1, "old", [])], E)
    new = spark.createDataFrame([("a", 3, "new", ["1"]), ("c", 1, "new", ["9"])], E)
    m = ST.upsert(old, new)
    assert {r.id: (r.n_articles, r.credibility) for r in m.collect()} == {"a": (3, "old"), "b": (1, "old"), "c": (1, "new"), "g": (1, "old"), "n": (1, "old")}
    assert {r.id for r in ST.drop_ghosts(m, new).collect()} == {"a", "b", "c"}
    assert [(r.article, r.n_events) for r in ST.shared_articles(m).collect()] == [("9", 2)]


def test_write_if_changed_and_archive(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, T0, ["1"]), ("b", 2, dt.datetime(2026, 2, 1), ["2"])], "id string, updated int, first_seen timestamp, articles array<string>")
    p = str(tmp_path / "t")
    assert ST.write_if_changed(df, p, ("updated",)) and not ST.write_if_changed(df.withColumn("updated", F.lit(9)).repartition(3), p, ("updated",))
    assert ST.write_if_changed(df.where("id = 'a'"), p, ("updated",))
    a = str(tmp_path / "archive")
    feb = lambda id, arts: spark.createDataFrame([(id, 3, dt.datetime(2026, 2, 3), arts)], df.schema)
    assert ST.write_archive(df, a) == ["2026-01", "2026-02"]
    assert ST.write_archive(feb("c", ["5"]), a) == ["2026-02"]
    assert {r.id for r in spark.read.parquet(a).collect()} == {"a", "b", "c"}
    ST.write_archive(feb("d", ["2", "6"]), a)  # shares an article with b
    assert sorted(r.id for r in S.read_month(spark, a, "2026-02").collect()) == ["c", "d"]
    ST.write_archive(feb("d", None), a, blocked=["c"])  # nulls replace as well
    assert [(r.id, r.articles) for r in S.read_month(spark, a, "2026-02").collect()] == [("d", None)]
    with pytest.raises(RuntimeError):
        ST.write_archive(feb("e", ["7"]).unionByName(feb("f", ["7"])), a)


def test_fingerprint_without_nested_fields(spark):
    df = lambda n: spark.createDataFrame([("a", [("f", n)])], "id string, feeds array<struct<id:string,n:int>>")
    same = lambda **k: ST.fingerprint(df(1), **k).first() == ST.fingerprint(df(2), **k).first()
    assert not same() and same(nested={"feeds": ("n",)})


def test_upsert_takes_nulls(spark):
    old = spark.createDataFrame([("a", 1, "old", ["1"])], E)
    new = spark.createDataFrame([("a", 2, None, None)], E)
    assert [tuple(r) for r in ST.upsert(old, new).collect()] == [("a", 2, None, None)]


def brute(rows):
    tp = pc = pl = 0
    for (c1, l1), (c2, l2) in itertools.combinations(rows, 2):
        tp += c1 == c2 and l1 == l2
        pc += c1 == c2
        pl += l1 == l2
    return (tp / pc if pc else 1.0), (tp / pl if pl else 1.0)


def test_pairs_by_counts(spark):
    rng = random.Random(1)
    rows = [(str(rng.randint(0, 5)), str(rng.randint(0, 4))) for _ in range(60)]
    r = Q.pairwise(spark.createDataFrame(rows, "cluster string, label string")).first()
    assert [round(r.precision, 9), round(r.recall, 9)] == [round(x, 9) for x in brute(rows)]
    alone = Q.pairwise(spark.createDataFrame([("1", "a")], "cluster string, label string")).first()
    assert (alone.precision, alone.recall) == (1.0, 1.0)
    gray = spark.createDataFrame([("b", "a")], "a string, b string")
    two = spark.createDataFrame([("1", "a"), ("1", "b"), ("1", "a")], "cluster string, label string")
    assert Q.pairwise(two, gray=gray).first().precision == 1.0 and Q.contamination(two, gray=gray).count() == 0 and Q.contamination(two).first().n_other == 1


def test_robustness_runs(spark):
    rows = spark.createDataFrame([(str(k), str(k % 3)) for k in range(30)], "id string, label string")
    mean, dev, top = Q.robustness(rows, lambda d: d.withColumn("cluster", F.col("label")), lambda d: Q.pairwise(d).first().f1, times=2)
    assert (mean, dev, top) == (1.0, 0.0, 1.0) and Q.gate(0.8, 2, 6) and not Q.gate(0.8, 3, 6)


def test_feed_health(spark):
    now = F.lit(T0)
    rep = spark.createDataFrame([("a", "error", 0, None, True), ("b", "ok", 100, T0, True), ("c", "ok", 9, T0 - dt.timedelta(days=8), False), ("d", "ok", 9, T0, False), ("e", "empty", 0, None, False)], "feed_id string, status string, n_entries int, newest timestamp, critical boolean")
    got = H.feed_health(rep, spark.createDataFrame([("d",)], "feed_id string"), now)
    assert {r.feed_id: r.health for r in got.collect()} == {"a": "error", "b": "no_adopt", "c": "stale", "d": "ok", "e": "empty"}
    r = H.health_report(got).first()
    assert r.fatal and r.n_feeds == 5


def test_search_and_chips(spark):
    df = spark.createDataFrame([(1, "Drill at sea", [["a", "b"], ["b", "c"]]), (2, None, [["z"]])], "k int, h string, e array<array<string>>")
    none = F.array().cast("array<string>")
    assert [r.k for r in df.where(V.matches("DRILL", F.col("h"), none, none)).collect()] == [1]
    assert [r[0] for r in df.select(V.chips(F.col("e"), 2)).collect()] == [["a", "b"], ["z"]]


def test_sources(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.json").write_text(json.dumps({"title": "t", "feed_id": "x", "entry_ord": 1}) + "\n" + json.dumps({"title": "u", "feed_id": "y", "entry_ord": 2}) + "\n")
    assert S.read_entries(spark, str(tmp_path / "f"), ["x"]).count() == 1
    assert S.read_json(spark, str(tmp_path / "none"), "a int").count() == 0
    (tmp_path / "bad.json").write_text("{broken")
    try:
        S.read_json(spark, str(tmp_path / "bad.json"), "a int").collect()
        raise AssertionError("a corrupt store was read")
    except Exception as e:  # noqa: BLE001
        assert "broken" in str(e) or "MALFORMED" in str(e) or "FAILED" in str(e)
    st = spark.createDataFrame([("a", "1", "m", T0)], S.STATE)
    assert S.merge_state(st, spark.createDataFrame([("a", "2", "m", T0 + dt.timedelta(days=1))], S.STATE)).first().etag == "2"


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("a", T0, 1), ("a", T0, 2), ("b", T0 + dt.timedelta(hours=1), 3), ("b", T0 + dt.timedelta(days=4), 4)], "id string, at timestamp, v int").write.parquet(src)
    stream = lambda: spark.readStream.schema("id string, at timestamp, v int").parquet(src)
    seen = []
    EV.into_store(EV.deduplicated(stream(), "id", "at"), lambda df, _: seen.extend(r.id for r in df.collect()), str(tmp_path / "c1")).awaitTermination()
    assert sorted(seen) == ["a", "b"]
    for name, df, want in (("d", EV.daily(stream(), "at", "0 seconds", F.sum("v").alias("s")), {6}), ("s", EV.sessions(stream(), "id", "at", watermark="0 seconds"), {1, 2})):
        df.writeStream.format("memory").queryName(f"q_{name}").outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()
        assert {r[-1] for r in spark.table(f"q_{name}").collect()} <= want
