"""Groups by hooking against union-find, and the defined cases."""

import random

from evidentia.llm.components import group_ids, hex_key, hex_text
from evidentia.llm.queries import listed_pairs
from pyspark.sql import functions as F


def brute(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a and b and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    groups = {}
    for x in list(parent):
        groups.setdefault(find(x), []).append(x)
    return {x: min(g) for g in groups.values() for x in g}


def run(spark, pairs):
    return {r.id: r.group_id for r in group_ids(spark, spark.createDataFrame(pairs, "a string, b string")).collect()}


def test_hex_keys_keep_text_and_order(spark):
    ids = sorted(f"{random.Random(1).getrandbits(64):016x}" for _ in range(1)) + ["0000000000000000", "7fffffffffffffff", "8000000000000000", "ffffffffffffffff", "00000000ffffffff", "ffffffff00000000"]
    df = spark.createDataFrame([(i,) for i in ids], "id string").select("id", hex_key(F.col("id")).alias("k")).withColumn("back", hex_text(F.col("k")))
    rows = sorted(df.collect(), key=lambda r: r.k)
    assert all(r.id == r.back for r in rows) and [r.id for r in rows] == sorted(ids)


def test_random_graphs_chains_and_hubs(spark):
    rng = random.Random(2)
    name = lambda k: f"{(k * 0x9E3779B97F4A7C15) & (2**64 - 1):016x}"
    pairs = [(name(rng.randint(0, 300)), name(rng.randint(0, 300))) for _ in range(150)]
    pairs += [(name(1000 + k), name(1001 + k)) for k in range(120)] + [(name(5000), name(5001 + k)) for k in range(80)]
    assert run(spark, pairs) == brute(pairs)


def test_an_ascending_chain_is_one_group(spark):
    pairs = [(f"{k:016x}", f"{k + 1:016x}") for k in range(200)]
    assert set(run(spark, pairs).values()) == {f"{0:016x}"}


def test_cases(spark):
    pairs = [(None, "a" * 16), ("b" * 16, "b" * 16), ("c" * 16, "d" * 16), ("d" * 16, "c" * 16), ("c" * 16, "d" * 16), ("zz-1", "d" * 16), ("x y", "zz-2")]
    assert run(spark, pairs) == brute(pairs)
    assert run(spark, []) == {}


def test_listed_ids_are_cleaned(spark):
    ev = spark.createDataFrame([([(" AA\t", 1), ("bb", 2), (None, 3), ("", 4)],), (None,), ([],), ([("cc", 1), ("CC ", 2)],)], "articles array<struct<id:string,n:int>>")
    assert [(r.a, r.b) for r in listed_pairs(ev).collect()] == [("aa", "bb")]
