"""Codewords, labels, held-out accuracy and mixed titles."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from evidentia.llm import language as L

SAY = {
    "en": "the harbour office says that ships were seen near northern island after council meeting about fishing",
    "fr": "le bureau du port affirme que des navires ont été vus près des îles après la réunion sur la pêche",
    "de": "das hafenamt meldet dass schiffe nahe der nördlichen insel gesehen wurden nach sitzung über fischerei",
    "es": "la oficina del puerto dice que los barcos fueron vistos cerca de la isla después de la reunión sobre pesca",
    "zh": "港务局周三表示在北屿附近发现多艘渔船议会将讨论捕捞配额问题居民被要求留在室内",
    "ja": "港湾局は水曜日に北の島の近くで多くの漁船を確認したと発表した住民は屋内に退避する",
    "ko": "항만청은 수요일 북쪽 섬 인근에서 어선을 확인했다고 밝혔다 주민들은 실내에 대기했다",
}


def sentence(lang, rng):
    if lang in ("zh", "ja"):
        s = SAY[lang]
        k = rng.randint(0, len(s) - 14)
        return s[k: k + 14]
    return " ".join(rng.choices(SAY[lang].split(), k=9))


def sample(spark, n=60, wrong=0.1):
    rng = random.Random(1)
    rows = [(sentence(lang, rng) + f" {k}", rng.choice(list(SAY)) if rng.random() < wrong else lang) for lang in SAY for k in range(n)]
    return spark.createDataFrame(rows, "title string, lang string")


def test_codewords_are_far_apart():
    code = L.codewords()
    assert code.shape == (8, 15) and min((a != b).sum() for a, b in itertools.combinations(code, 2)) >= 6


def test_labels(spark):
    cases = {"en-US": "en", "en_GB": "en", "ENG": "en", " zh-Hans ": "zh", "zho": "zh", "es-419": "es", "KO": "ko", "jpn": "ja", "xx": None, "und": None, "unknown": None, "": None, None: None, "e": None}
    df = spark.createDataFrame([(k,) for k in cases], "l string").select("l", L.label_language("l"))
    assert {r[0]: r[1] for r in df.collect()} == cases


def test_accuracy_with_wrong_labels_and_mixed_titles(spark):
    model = L.fit(sample(spark), per_language=50)
    rng = random.Random(7)
    titles = [(lang, sentence(lang, rng)) for lang in SAY for _ in range(40)]
    _, parts = L.segment_batch(model, [t for _, t in titles])
    right = [p[0][1] == L.LANGUAGES.index(lang) and len(p) == 1 for (lang, _), p in zip(titles, parts)]
    assert np.mean(right) >= 0.98
    mixed = [(a, b, sentence(a, rng) + sep + sentence(b, rng)) for a, b in itertools.permutations(SAY, 2) for sep in (" | ", " ")]
    _, parts = L.segment_batch(model, [t for *_, t in mixed])
    hit = [[L.LANGUAGES[q[1]] for q in p] == [a, b] for (a, b, _), p in zip(mixed, parts)]
    assert np.mean(hit) >= 0.9


def test_a_name_is_no_segment_and_empty_cases(spark):
    model = L.fit(sample(spark), per_language=50)
    df = spark.createDataFrame([("1", SAY["zh"][:20] + " Porodota", "zh", 5), ("2", None, "en", 5), ("3", "", "en", 5), ("4", "12 - 3!", "en", 5), ("5", SAY["en"], None, 5), ("5", SAY["en"], None, 5)], "id string, title string, lang string, confidence int")
    got = [(r.id, r.label, r.lang) for r in L.identify(df, model).orderBy("id").collect()]
    assert got == [("1", "zh", "zh"), ("5", None, "en"), ("5", None, "en")]
    assert L.identify(df.where("false"), model).count() == 0


def test_fit_on_an_empty_table(spark):
    model = L.fit(sample(spark).where("false"))
    assert L.segment_batch(model, ["ships"])[1][0][0][2] <= 1.0


def test_three_segments_and_a_language_that_returns(spark):
    model = L.fit(sample(spark), per_language=50)
    rng = random.Random(11)
    mixed = [(a, b, c) for a, b in itertools.permutations(("en", "fr", "de", "ko", "zh"), 2) for c in ("en", "fr", "de") if c != b]
    texts = [" | ".join(sentence(x, rng) for x in m) for m in mixed]
    _, parts = L.segment_batch(model, texts)
    hit = [[L.LANGUAGES[q[1]] for q in p] == list(m) for m, p in zip(mixed, parts)]
    assert np.mean(hit) >= 0.9
    for t, p in zip(texts, parts):  # segments stand in the text in order
        at = -1
        for seg, *_ in p:
            at = t.index(seg, at + 1)


def test_best_languages_and_runs():
    score = np.array([[5.0, 0], [5, 0], [0, 4], [0, 5], [5, 0], [4, 0]])
    assert L.best_languages(score, 3).tolist() == [0, 0, 1, 1, 0, 0] and L.best_languages(score, 20).tolist() == [0] * 6
    every = lambda i, j: True
    assert L.runs_of_clauses(score, every, 3) == [0, 2, 4] and L.runs_of_clauses(score, lambda i, j: j - i >= 3, 3) == [0]


def test_confidence_is_calibrated(spark):
    """Of short pieces, which are sometimes wrong, about as many are right as the confidence says."""
    model = L.fit(sample(spark, 120), per_language=100)
    rng = random.Random(3)
    pieces = [(lang, p) for lang in SAY for _ in range(40) for p in L.beginnings(sentence(lang, rng))]
    margin, length = model.sums([p for _, p in pieces])
    lang, conf, _ = model.decode(margin, length)
    right = np.array([L.LANGUAGES[k] == x for k, (x, _) in zip(lang, pieces)])
    bins = np.minimum((conf * 10).astype(int), 9)
    error = sum(abs(conf[bins == b].mean() - right[bins == b].mean()) * (bins == b).mean() for b in set(bins.tolist()))
    assert error < 0.1
