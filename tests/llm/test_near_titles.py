"""The prefix-tree join against all pairs, edits that keep a headline, and those that make another."""

import datetime as dt
import random
import unicodedata
from collections import Counter

import pytest

from evidentia.llm import near_titles as N
from evidentia.llm.characters import ALIKE, BLANK, INVISIBLE, single

BASE = "Fishermen near Zell Reef report 13 survey ships, radio calls went unanswered"
SAME = ["[Update] " + BASE, BASE + " | Politics", BASE.upper(), BASE.replace(",", " -"), "Radio calls went unanswered – Fishermen near Zell Reef report 13 survey ships", BASE.replace("report", "again"), BASE.replace("Fishermen", "Fishhermen"), BASE.replace("near", ""), BASE.replace("13", "thirteen"), "Exclusive: " + BASE + ", sources say", BASE.replace("s", "ѕ")]
OTHER = [BASE.replace("13", "31"), BASE.replace("Reef", "Bank"), BASE.replace("Zell", "Galt"), BASE.replace("survey", "cargo")]
CJK = "外事办公室在双子礁附近监测到51架次油轮；船员均平安"
CJK_SAME = ["快讯：" + CJK, CJK.replace("在", "再"), CJK.replace("附近", "附"), "船员均平安；外事办公室在双子礁附近监测到51架次油轮", CJK.replace("51", "５１"), CJK + "（视频）"]
CJK_OTHER = [CJK.replace("双子", "云台"), CJK.replace("51", "15"), CJK.replace("礁", "湾")]


@pytest.mark.parametrize("base,titles,want", [(BASE, SAME, True), (BASE, OTHER, False), (CJK, CJK_SAME, True), (CJK, CJK_OTHER, False)])
def test_edits(base, titles, want):
    for t in titles:
        assert N.same_headline(N.Title(N.bare(base)), N.Title(N.bare(t))) is want, t


def test_numbers():
    assert [N._number(x) for x in ("八", "十二", "二十三", "一百", "007")] == ["8", "12", "23", "100", "7"]


def test_trie_finds_what_all_pairs_find():
    rng = random.Random(4)
    sets = [sorted(rng.sample(range(40), rng.randint(3, 12))) for _ in range(300)]
    sets += [sorted(set(s) - {s[0]} | {rng.randint(0, 39)}) for s in sets[:100]]
    trie, found, want = N.Trie(0.7), set(), set()
    for k, s in enumerate(sets):
        found |= {(j, k) for j in trie.find(s)}
        want |= {(j, k) for j in range(k) if len(set(s) & set(sets[j])) >= 0.7 * max(len(s), len(sets[j])) - 1e-9}
        trie.add(s, k)
    assert found == want


def make(rng, n=160):
    names = [f"Va{c}o{d}" for c in "lmnprst" for d in "qwkz"]
    rows = []
    for k in range(n):
        if rows and rng.random() < 0.4:
            i, t, o, at = rng.choice(rows)
            rows.append((f"{k:04d}", rng.choice(["[Update] ", "", "Live - "]) + t.replace("report", "now"), o.upper() if rng.random() < 0.3 else "www." + o, at + dt.timedelta(hours=rng.randint(0, 50))))
        else:
            rows.append((f"{k:04d}", f"Fishermen near {rng.choice(names)} report {rng.randint(2, 99)} ships as {rng.choice(names)} waits for {rng.choice(names)}", rng.choice(["a.test", "b.test"]), dt.datetime(2026, 3, 1) + dt.timedelta(hours=rng.randint(0, 900))))
    return rows


def brute(rows):
    host = lambda d: d.lower().removeprefix("www.")
    t = [(i, N.Title(N.bare(x)), N.tokens(N.bare(x)), host(o), at) for i, x, o, at in rows]
    out = set()
    for k, a in enumerate(t):
        for b in t[:k]:
            if a[3] == b[3] and abs(a[4] - b[4]) <= dt.timedelta(hours=36) and len(a[2] & b[2]) >= 0.75 * max(len(a[2]), len(b[2])) and N.same_headline(b[1], a[1]):
                out.add(tuple(sorted((a[0], b[0]))))
    return out


def groups(pairs):
    """The groups that pairs join, as a set of sets."""
    at = {}
    for a, b in pairs:
        both = at.get(a, {a}) | at.get(b, {b})
        for x in both:
            at[x] = both
    return {frozenset(g) for g in at.values()}


@pytest.mark.parametrize("block_rows", [20_000, 5])
def test_join_equals_all_pairs_whole_or_split(spark, block_rows):
    rows = make(random.Random(9))
    df = spark.createDataFrame(rows, "id string, title string, source_domain string, published timestamp")
    got = groups((r.a, r.b) for r in N.near_pairs(df, block_rows=block_rows).collect())
    assert got == groups(brute(rows)) and len(got) > 10


@pytest.mark.parametrize("block_rows", [20_000, 500])
def test_copies_are_not_paired(spark, block_rows):
    """Equal titles of one outlet, and one with an edit among them: as many links as rows, one group."""
    at = dt.datetime(2026, 3, 1)
    rows = [(f"{k:05d}", BASE if k != 700 else "[Update] " + BASE, "a.test", at + dt.timedelta(minutes=k)) for k in range(3000)]
    df = spark.createDataFrame(rows, "id string, title string, source_domain string, published timestamp")
    pairs = [(r.a, r.b) for r in N.near_pairs(df, block_rows=block_rows).collect()]
    assert len(pairs) < 2 * len(rows) and len(groups(pairs)) == 1 and len(next(iter(groups(pairs)))) == len(rows)


def test_cases(spark):
    at = dt.datetime(2026, 3, 1)
    rows = [("1", BASE, "a.test", at, 0), ("1", BASE, "a.test", at, 0), ("2", BASE, " WWW.A.test ", at + dt.timedelta(hours=36), 0), ("3", BASE, "a.test", at + dt.timedelta(hours=73), 0), ("4", None, "a.test", at, 0), ("5", BASE, None, at, 0), ("6", BASE, "a.test", None, 0), ("7", "", "a.test", at, 0), ("8", "!!", "a.test", at, 0), (None, BASE, "a.test", at, 0)]
    df = spark.createDataFrame(rows, "id string, title string, source_domain string, published timestamp, block int")
    assert {tuple(sorted((r.a, r.b))) for r in N.near_pairs(df).collect()} == {("1", "2")}
    assert N.near_pairs(df.where("false")).count() == 0


def test_a_replaced_letter_and_other_scripts():
    same = lambda a, b: N.same_headline(N.Title(N.bare(a)), N.Title(N.bare(b)))
    assert same("Ministers discuss defence plans in Galt", "Ministers discuss defense plans in Galt")
    assert not same("Ships leave Harlow for repairs", "Ships leave Harlew for repairs")
    assert not same("Crews find a boat near the reef", "Crews find a coat near the reef")
    for t in ("Корабли вышли из порта", "เรือออกจากท่า"):
        assert N.tokens(t)


def test_tokens_of_one_title_only_are_no_nodes():
    """A token that no other title of the block has is neither stored nor looked up, and the items found are the same."""
    rng = random.Random(5)
    sets = [{*rng.sample("abcdefghijkl", rng.randint(2, 7)), *(f"lone{k}-{x}" for x in range(rng.randint(0, 2)))} for k in range(300)]
    often = Counter(g for s in sets for g in s)
    trie = N.Trie(0.75)
    grams = [sorted(s, key=lambda g: (often[g], g)) for s in sets]
    skip = [sum(often[g] == 1 for g in s) for s in sets]
    for k, s in enumerate(sets):
        trie.add(grams[k], k, s, skip[k])
    assert not any(g.startswith("lone") for g in trie.at)
    for k, s in enumerate(sets):
        want = {j for j, t in enumerate(sets) if len(s & t) >= max(trie.need(len(s)), trie.need(len(t)))} - {k}
        assert set(trie.find(grams[k], s, skip[k])) - {k} == want


def test_character_table_is_that_of_single_characters():
    table = single()
    alone = {c: n for c in range(0x80, 0x30000) if not 0xAC00 <= c <= 0xD7A3 and not 0xD800 <= c <= 0xF8FF for n in [unicodedata.normalize("NFKC", chr(c))] if n != chr(c)}
    assert alone.keys() <= table.keys() and table.keys() - alone.keys() <= {*BLANK, *INVISIBLE, *map(ord, ALIKE)}
