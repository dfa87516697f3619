"""Notices mined by their spread, slots, and headlines about them."""

import datetime as dt
import random

import pytest

from evidentia.llm import residue as R

NOTICE = ["404 Not Found", "Please enable JavaScript to view {}", "Page introuvable | {}", "アクセスが拒否されました", "접근이 거부되었습니다 ({n})", "您访问的页面不存在", "null | null", "Internal Server Error, reference {n}", "Ｅｒｒｏｒ 404 - page missing", "Página no encontrada – {}", "标题待定标题待定", "Test test test {n}", "Your browser script policy forbids this"]
SLOT = ["Navy tracks {{n_ships}} off Lorne", "__place__ | Cajatowe Times", "%(headline)s", "<%= vessel_name %> turns back", "[location] residents wake", "[[post_title]]", "#vessel_name#", "@@n_ships@@渔民称看见90艘军舰", "＿＿place＿＿ wakes", "${HEADLINE}", "{% TITLE %}"]
CONTENT = ["Border police website shows error 404 during drill Madomaqu", "Regional command calls Sasesunu drill a placeholder for a larger one", "Port app drops JavaScript trackers after a blackout", "[Update] Search widens around Joral Point", "54% of frigates near Lorne Point grounded for maintenance", "$15m plan for tankers at Veld Sound (updated)", "Hackers swap survey office page for an access denied notice", "[속보] 조사선 92척 동란 앞바다 통과", "Page not found in Madu file, squadron leader says", "Your browser script policy is debated"]
SCHEMA = "id int, title string, source_name string, source_domain string, published timestamp, n int"
T0 = dt.datetime(2026, 3, 1)
PASSAGE = R.PASSAGE.split()


def corpus():
    """(id, title, kind): notices from eight outlets over weeks, filler in any order, a headline that many carry on one day, headlines of a pattern, and single ones."""
    rng = random.Random(5)
    rows = []

    def put(title, outlet, day, kind):
        name = f"Paper {outlet}"
        text = title.replace("{}", name).replace("{n}", str(rng.randint(100, 999))) if kind == "notice" else title
        rows.append((len(rows), rng.choice([text, text.upper(), text + "."]) if kind == "notice" else text, name, f"www.p{outlet}.example", T0 + dt.timedelta(days=day), 0, kind))

    for t in NOTICE:
        for k in range(8):
            put(t, k, 4 * k, "notice")
    for k in range(8):
        put(" ".join(rng.sample(PASSAGE, 6)), k, 5 * k, "notice")
    for k in range(12):
        put("Harbour council votes for the new breakwater", k, k % 2, None)
    for k in range(60):
        put(f"{rng.randint(2, 90)} tankers pass {rng.choice(['Lorne', 'Veld', 'Joral', 'Hesk', 'Zell'])} Sound {rng.choice(['at dawn', 'in fog', 'under escort', 'without a word'])}, {rng.choice(['markets wait', 'crews safe', 'ports stay open'])}", k % 9, k, None)
    for k in range(40):
        put(f"军舰{rng.randint(2, 90)}艘驶过{rng.choice(['青岬', '白礁', '双子礁', '东澜'])}外海，{rng.choice(['居民撤离', '港口照常', '议会质询'])}", k % 9, k, None)
    for t in CONTENT:
        put(t, 3, 7, None)
    return rows


def test_templates_are_mined_by_their_spread(spark):
    rows = corpus()
    out = {r.id: r.residue for r in R.mark_residue(spark.createDataFrame([r[:6] for r in rows], SCHEMA)).collect()}
    assert [(r[1], out[r[0]]) for r in rows if out[r[0]] != r[6]] == []


def test_a_slot_with_other_words_is_a_wildcard(spark):
    """A constant frame around a word that differs is one template."""
    names = ["anna", "boris", "carla", "dieter", "elena", "franz", "greta", "hugo"]
    rows = [(k, f"we are sorry but the account of {x} may not open this page", f"P{k}", f"p{k}.example", T0 + dt.timedelta(days=3 * k), 0) for k, x in enumerate(names)]
    out = R.mark_residue(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.residue for r in out} == {"notice"}


@pytest.mark.parametrize("kind,titles", [("slot", SLOT), (None, CONTENT)])
def test_slots_and_single_headlines(spark, kind, titles):
    rows = [(k, t, "Cajatowe Times", "www.cajatowe.example", T0, 0) for k, t in enumerate(titles)]
    out = R.mark_residue(spark.createDataFrame(rows, SCHEMA))
    assert {r.title: r.residue for r in out.collect()} == dict.fromkeys(titles, kind)


def test_null_empty_repeats_and_a_verdict_from_elsewhere(spark):
    verdict = R.notice_messages(spark.createDataFrame([r[:6] for r in corpus()], SCHEMA))
    rows = [(k, t, "Cajatowe Times", "www.cajatowe.example", T0, 0) for k, t in enumerate([None, "", " ​ ", "404 not found"])]
    out = R.flag(spark.createDataFrame([*rows, (3, "404 not found", None, None, None, 1)], SCHEMA), verdict)
    assert sorted((r.id, r.n, r.residue) for r in out.collect()) == [(0, 0, None), (1, 0, "empty"), (2, 0, "empty"), (3, 0, "notice"), (3, 1, "notice")]
    assert R.mark_residue(spark.createDataFrame([], SCHEMA)).count() == 0
    assert R.mark_residue(spark.createDataFrame([(1, "x y z", None, None, None, 0)] * 30, SCHEMA)).where("residue is not null").count() == 0
