"""Pairs taken in tasks of a stretch of time against plain procedures, and what they move."""

import datetime as dt
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from evidentia.operators import linkage as L
from evidentia.operators import similar as S
from evidentia.plans import reference_queries as Q

T0 = dt.datetime(2026, 1, 1)


def moved(spark):
    """Bytes of shuffle written so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()


def cosines(docs, hours):
    """{(a, b): cosine} of (id, lang, hours after T0 or None, terms), comparing all of a language."""
    vec, n = {}, Counter(d[1] for d in docs)
    df = Counter((lang, t) for _, lang, _, ts in docs for t in set(ts))
    for i, lang, _, ts in docs:
        v = {t: (1 + math.log(k)) * (math.log((1 + n[lang]) / (1 + df[lang, t])) + 1) for t, k in Counter(ts).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vec[i] = {t: x / norm for t, x in v.items()}
    return {(a[0], b[0]): sum(w * vec[b[0]].get(t, 0) for t, w in vec[a[0]].items()) for a in docs for b in docs if a[0] < b[0] and a[1] == b[1] and None not in (a[2], b[2]) and abs(a[2] - b[2]) <= hours}


@pytest.mark.parametrize("most", [1000, 17])
def test_pairs_in_parts(spark, most):
    """Stretches of eight days that are whole or of several parts, pairs over their borders, texts without a time."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(30)]
    docs = [(f"{rng.getrandbits(40):010x}", "de" if k % 4 else "fr", rng.choice([*range(0, 600, 3), 192, 192 + 48, 384]) if k % 29 else None, [rng.choice(words[: rng.choice((6, 30))]) for _ in range(rng.randint(0, 6))]) for k in range(260)]
    df = spark.createDataFrame([(i, x, None if h is None else T0 + dt.timedelta(hours=h), " ".join(ts)) for i, x, h, ts in docs], "id string, lang string, at timestamp, x string")
    rows = S.similar_pairs(df, {None: "words"}, {None: 0.5, "fr": 0.4}, 48, most).collect()
    lang = {d[0]: d[1] for d in docs}
    want = {p: c for p, c in cosines(docs, 48).items() if c > (0.5 if lang[p[0]] == "de" else 0.4)}
    got = {(r.a, r.b): r.cos for r in rows}
    assert len(got) == len(rows) > 100 and got.keys() == want.keys() and all(abs(c - want[p]) < 1e-9 for p, c in got.items())


def test_keys_are_the_terms(spark):
    """As many terms of every kind, equal where the terms are, as by the expressions."""
    texts = ["harbour bridge closed harbour bridge", "a harbour of b", "북방 의회 의회가 토론", "", "북", "北方议会讨论渡轮", "北方 议会", "été \U0001f6a2 𠮷野 x"]
    for lang, kind in (("en", "pairs"), ("ko", "grams-2-4"), ("zh", "grams-2-3")):
        df = spark.createDataFrame(list(enumerate(texts)), "k int, x string").withColumn("w", L.key_text(F.col("x"), F.lit(lang))).select("k", "w", L.terms(F.col("x"), F.lit(lang)).alias("t"))
        rows = sorted(df.collect(), key=lambda r: r.k)
        row, key = S.term_keys([r.w for r in rows], kind)
        names, want, got = {}, [], []
        for r in rows:
            mine = key[row == r.k].tolist()
            want.append(sorted(r.t))
            got.append(mine)
        flat = Counter(t for ts in want for t in ts)
        assert [len(g) for g in got] == [len(t) for t in want], kind
        assert sorted(flat.values()) == sorted(Counter(key.tolist()).values()), kind
        assert [sorted(Counter(g).values()) for g in got] == [sorted(Counter(t).values()) for t in want], kind


def dense_titles(spark, folder, n):
    """n titles a day apart by seconds that share most of their words."""
    rng = random.Random(5)
    words = [f"word{k}" for k in range(60)]
    rows = [(f"{rng.getrandbits(64):016x}", " ".join(rng.sample(words, 8)), None, T0 + dt.timedelta(seconds=20 * k), "alpha.test", "T1", "en", k) for k in range(n)]
    spark.createDataFrame(rows, "id string, title string, summary string, published timestamp, source_domain string, tier string, lang string, entry_ord bigint").write.parquet(f"{folder}/article.parquet")
    return str(folder)


def test_no_candidate_is_moved(spark, tmp_path):
    """What is moved follows the texts, not the pairs that meet under a word."""
    d = dense_titles(spark, tmp_path, 1500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are too large for it
    try:
        before = moved(spark)
        assert Q.cosine_pairs(spark, d).count() > 1000
        assert moved(spark) - before < 400_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_candidate_of_terms_is_moved(spark, tmp_path):
    d = dense_titles(spark, tmp_path, 1500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = moved(spark)
        Q.terms_cosine_pairs(spark, d).count()
        assert moved(spark) - before < 1_000_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
