"""The code-point operator against the same rules in plain Python."""

import random
import unicodedata

from pyspark.sql import functions as F

from evidentia.llm.characters import single
from evidentia.llm.one_form import one_form


def plain(text):
    return unicodedata.normalize("NFC", "".join(single().get(ord(c), c) for c in text))


def run(spark, texts):
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "k int, text string, form string")
    return {r.k: r.form for r in one_form(df, ["k"]).collect()}


def test_what_looks_the_same_is_equal(spark):
    groups = [["Search for the ship", "Ｓｅａｒｃｈ for the ship", "Sеаrсh for the ship", "Search for the　ship", "Se­arch f​or the sh⁠ip"], ["página", "página"], ["한국", "한국"], ["ﬁre", "fire"], ["⼤海", "大海", "大海"], ["ガ", "ガ", "ｶﾞ"], ["call-up", "call‐up", "call‑up"], ["，", ","]]
    got = run(spark, [t for g in groups for t in g])
    it = iter(range(len(got)))
    forms = [{got[next(it)] for _ in g} for g in groups]
    assert all(len(f) == 1 for f in forms) and len(set().union(*forms)) == len(groups)


def test_what_can_be_seen_differs(spark):
    texts = ["navy", "Navy", "návy", "navy!", "navy.", "navy–", "navy-", "na vy", "na  vy"]
    assert len(set(run(spark, texts).values())) == len(texts)


def test_against_plain_rules(spark):
    rng = random.Random(5)
    pool = "aeoAE áéñü가각힣각゙̧̣́̈か゛漢ﬀ①㌔Ⅷ½＋ｱﾞﾊﾟ ​﻿Αеѕ̈́ẛÅक़"
    texts = ["".join(rng.choices(pool, k=rng.randint(1, 24))) for _ in range(400)]
    got = run(spark, texts)
    # of a starter with marks that compose only after a mark in between, the plain rule composes more; both are one form
    assert all(unicodedata.normalize("NFC", got[k]) == plain(t) for k, t in enumerate(texts))


def test_cases(spark):
    long = "е" * 50_000
    df = spark.createDataFrame([(1, None), (2, ""), (3, "ａ"), (3, "ａ"), (4, long)], "k int, text string")
    got = one_form(df, ["k"]).collect()
    assert {(r.k, r.form) for r in got} == {(2, ""), (3, "a"), (4, "e" * 50_000)}
    assert one_form(df.where("false"), ["k"]).count() == 0
