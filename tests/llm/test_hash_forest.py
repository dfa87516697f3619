"""Batches against the sequential procedure."""

import os
import random

import pytest

from evidentia.llm import hash_forest as H

SCHEMA = "row_id bigint, batch_no int, id string, articles array<struct<id:string>>, ids int"


def brute(rows):
    clean = lambda s: (s or "").strip().lower() or None
    accepted, out = {}, set()
    for r, _, e, arts in sorted(rows):
        s, e = {clean(x) for x in arts or []} - {None}, clean(e)
        hits = [a for a, (ae, s2) in accepted.items() if (e and ae == e) or 3 * len(s & s2) > len(s) + len(s2)]
        if hits:
            out |= {(a, r) for a in hits}
        else:
            accepted[r] = (e, s)
    return set(accepted), out


def run(spark, rows, **k):
    df = spark.createDataFrame([(r, b, e, None if a is None else [(x,) for x in a], 1) for r, b, e, a in rows], SCHEMA)
    acc, rep = H.split_batches(df, **k)
    return {r.row_id for r in acc.collect()}, {(r.row_a, r.row_b) for r in rep.collect()}


def make(n=160, seed=3):
    rng = random.Random(seed)
    rows = []
    for k in range(1, n + 1):
        b = 0 if k < n // 2 else 1 + (k - n // 2) * 2 // n
        if rows and rng.random() < 0.5:
            _, _, e, a = rng.choice(rows)
            a = [x for x in a or [] if x]
            if a and rng.random() < 0.5:
                a.pop(rng.randrange(len(a)))
            if rng.random() < 0.5:
                a.append(f"{rng.randint(0, 400):04d}")
            a = [x.upper() + " " if rng.random() < 0.2 else x for x in a] + [None]
            rows.append((k, b, e if rng.random() < 0.5 else f"e{k}", a))
        else:
            rows.append((k, b, f"e{k}", [f"{rng.randint(0, 400):04d}" for _ in range(rng.randint(1, 7))]))
    return rows


def test_equal_to_one_by_one(spark):
    rows = make()
    assert run(spark, rows) == brute(rows)


def test_crowded_prefixes_lose_nothing(spark, monkeypatch):
    rows = [(k, b, e, [*(a or []), "hot"]) for k, b, e, a in make(90, 5)]
    seen = []
    plain = H.Forest._by_rarest
    monkeypatch.setattr(H.Forest, "_by_rarest", lambda self, *a: seen.append(1) or plain(self, *a))
    assert run(spark, rows, hot=3) == brute(rows) and seen


def test_cases(spark):
    rows = [(1, 0, "a", None), (2, 0, " A ", []), (3, 0, None, ["x", "y", "z"]), (4, 0, None, ["x", "y", "z", None, "z"]), (5, 1, "q", ["x", "y"]), (6, 1, None, None), (7, 1, None, None), (8, 1, "q", ["k"])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == (set(), set())


def test_depth_widens_to_the_target():
    assert H.prefix_depth(0.5) == 2 and H.prefix_depth(0.9998) == 2 and H.prefix_depth(0.99995) == 1
    assert H.recall(2) > 0.9998 and H.recall(1) > 0.999999 and H.share_prefix(2, 3) == pytest.approx(1 / 3)


def test_labels_are_ranges(spark):
    """Equal first ids of an order give equal prefixes, and the prefix is the head of the label."""
    rows = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a", "b", "d"]), (3, ["q"])], "k int, ids array<string>")
    got = rows.select("k", H.F.explode(H.labels(H.hashed(H.F.col("ids")))).alias("l")).select("k", "l.*").collect()
    assert sum(r.k == 3 for r in got) == 1 and sum(r.k == 1 for r in got) == H.TREES
    of = {(r.k, r.tree): r.label for r in got}
    both = sum(of[1, t] >> 20 == of[2, t] >> 20 for t in range(H.TREES))
    assert 0 < both < H.TREES and all(of[1, t] >> 40 == of[2, t] >> 40 for t in range(H.TREES) if of[1, t] >> 20 == of[2, t] >> 20)


def test_chains_are_settled_whole(spark, monkeypatch):
    """A chain of rows each of which repeats the one before: far fewer rounds than rows."""
    rows = [(k, 0, f"e{k}", [f"x{j}" for j in range(2 * k, 2 * k + 8)]) for k in range(1, 40)]
    rounds = []
    settle = H.Forest._settle
    monkeypatch.setattr(H.Forest, "_settle", lambda self, *a: (settle(self, *a, plain_rounds=1), rounds.append(self._rounds))[0])
    acc, rep = run(spark, rows)
    assert (acc, rep) == brute(rows) and len(acc) == 20 and rounds == [3]


def test_a_forest_is_opened_again(spark, tmp_path):
    rows = make(120, 9)
    df = spark.createDataFrame([(r, b, e, None if a is None else [(x,) for x in a], 1) for r, b, e, a in rows], SCHEMA)
    each = H.event_rows(df)
    want = brute(rows)
    acc, rep = set(), set()
    H.Forest.create(spark, str(tmp_path / "f"), most_runs=2).close()
    for lo, hi in ((0, 40), (40, 70), (70, 80), (80, 120)):
        forest = H.Forest.open(spark, str(tmp_path / "f"))
        a, r = forest.append(each.where((H.F.col("row_id") > lo) & (H.F.col("row_id") <= hi)))
        acc |= {x.row_id for x in a.collect()}
        rep |= {(x.row_a, x.row_b) for x in r.collect()}
        assert len(forest.runs) <= 2
        forest.close()
    assert (acc, rep) == want
    with pytest.raises(Exception):
        H.Forest.open(spark, str(tmp_path))


def test_the_run_is_not_shuffled(spark, tmp_path):
    """The join of a batch with a run shuffles neither side's labels; the run is streamed."""
    rows = make(120, 9)
    df = spark.createDataFrame([(r, b, e, None if a is None else [(x,) for x in a], 1) for r, b, e, a in rows], SCHEMA)
    forest = H.Forest.create(spark, str(tmp_path / "f"))
    forest.append(H.event_rows(df))
    forest.append(H.event_rows(df.where("false")))
    a = forest._read("labels", [r for r, *_ in forest.runs])
    plan = a.join(a.select("tree", "prefix", H.F.col("key").alias("k")).hint("shuffle_hash"), ["tree", "prefix"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ShuffledHashJoin" in plan


def test_repeated_rows_count_once(spark):
    rows = make(40, 2)
    assert run(spark, rows + rows[:20]) == brute(rows)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01"), reason="no driver tables")
def test_whole_table_equals_the_sql(spark):
    """Every row of sf0.01, one after the other in SQL."""
    import duckdb

    from evidentia.llm import queries as Q

    db = duckdb.connect()
    db.execute("create view news_event as select * from '/root/testdata/sf0.01/news_event.parquet'")
    got = {(r.row_a, r.row_b) for r in Q.p3_found(spark, "/root/testdata/sf0.01").collect()}
    assert got == set(db.execute(Q.ORACLE["p3_found"]).fetchall()) and len(got) > 100
