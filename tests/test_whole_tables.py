"""Sequential operators on whole driver tables against plain procedures."""

import os
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from evidentia.functions import text as T
from evidentia.operators import credibility as C
from evidentia.operators import linkage as L
from evidentia.operators import revisions as R
from evidentia.plans import reference_queries as Q

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="no driver tables")


class Union(dict):
    def top(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.top(a), self.top(b)))
        self[b] = a


def plain_copies(rows):
    """(event, id) -> (group, kind), comparing all pairs of every event."""
    events = defaultdict(list)
    for r in rows:
        events[r.event_id].append(r)
    out = {}
    for e, ms in events.items():
        u, wires = Union(), []
        for i, a in enumerate(ms):
            for b in ms[:i]:
                na, nb, ta, tb = set(a.nums), set(b.nums), set(a.toks), set(b.toks)
                least = min(len(ta), len(tb))
                if a.lang == b.lang and not (na and nb and not na & nb) and least >= 3 and len(ta & tb) / least >= 0.75:
                    u.join(a.id, b.id)
                    wires.append(a.id)
                elif a.tally and b.tally and len({n for n in na & nb if n >= 4}) >= 2:
                    u.join(a.id, b.id)
        top = {u.top(x) for x in wires}
        for m in ms:
            g = u.top(m.id)
            alone = sum(u.top(x.id) == g for x in ms) == 1
            out[e, m.id] = (g, None if alone else "wire" if g in top else "release")
    return out


def test_copy_groups(spark):
    m = Q.members(spark, SF)
    rows = m.withColumn("x", T.title_text(F.col("title"))).select("event_id", "id", "lang", T.title_numbers("title").alias("nums"), T.title_tokens(F.col("x"), F.col("lang")).alias("toks"), F.col("title").rlike(C.TALLY).alias("tally")).collect()
    got = {(r.event_id, r.id): (r.copy_group, r.kind) for r in C.copy_groups(m).collect()}
    want = plain_copies(rows)
    assert got == want and sum(k is not None for _, k in want.values()) > 50


def test_verdicts(spark):
    """Counts, grade and score of every event, from the groups."""
    m = Q.members(spark, SF)
    groups = {(r.event_id, r.id): r.copy_group for r in C.copy_groups(m).collect()}
    weight = {"T1": 1.0, "TA": 0.9, "T2": 0.85, "T3": 0.6, "T4": 0.45, "T5": 0.3}
    events = defaultdict(list)
    for r in m.collect():
        events[r.event_id].append(r)
    got = {r.event_id: r for r in C.evaluate(m).collect()}
    assert got.keys() == events.keys()
    import math

    for e, ms in events.items():
        best = {}
        for r in sorted(ms, key=lambda r: (-weight.get(r.tier, 0.0), r.published, r.ord)):
            best.setdefault(groups[e, r.id], r)
        reps = list(best.values())
        voices, unrated = defaultdict(float), [r for r in reps if r.bloc == "unknown"]
        for r in reps:
            if r.bloc != "unknown":
                k = r.source_domain if r.bloc == "independent" else r.bloc
                voices[k] = max(voices[k], weight.get(r.tier, 0.3))
        n = len(voices)
        strengths = sorted([*voices.values(), *([0.3 * max(weight.get(r.tier, 0.3) for r in unrated)] if unrated else [])], reverse=True)[:4]
        evidence = min(1.0, sum(w * c for w, c in zip(strengths, (1.0, 0.6, 0.35, 0.2))) / 2.15)
        blocs = {r.bloc for r in ms} - {"unknown"}
        state_only = bool(blocs) and "independent" not in blocs
        tier = max((r.tier for r in ms), key=lambda t: weight.get(t, 0.0))
        if n == 0:
            grade = "D"
        elif n == 1:
            grade = "D" if state_only or tier in ("T4", "T5") else "B" if tier == "T1" else "C"
        else:
            grade = "A" if n >= 3 and tier in ("T1", "TA") else "B"
        hours = (max(r.published for r in ms) - min(r.published for r in ms)).total_seconds() / 3600
        score = 50 * evidence + 24 * min(n, 4) / 4 + 11 * (len({r.lang for r in ms}) >= 2) + 7 * any(r.primary_cited for r in ms) + 8 * min(1.0, math.log1p(hours) / math.log1p(72))
        assert (got[e].n_independent, got[e].n_originals, got[e].grade, got[e].n_articles) == (n, len(reps), grade, len(ms)), e
        assert abs(got[e].score - score) <= 0.051, e


def test_revisions(spark):
    """One article after the other, in order of time."""
    a = Q._timed(Q.table(spark, SF, "article"))
    rows = a.withColumn("x", T.title_text(F.col("title"))).select("id", F.coalesce("source_domain", F.lit("")).alias("outlet"), "lang", "published", "entry_ord", F.length("title").alias("len"), T.title_numbers("title").alias("nums"), T.title_tokens(F.col("x"), F.col("lang")).alias("toks")).collect()
    into, kept = {}, defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.published, r.entry_ord)):
        hit = None
        for k in kept[r.outlet, r.lang]:
            least = min(len(set(r.toks)), len(set(k["r"].toks)))
            if (r.published - k["r"].published).total_seconds() <= 36 * 3600 and not (r.nums and k["r"].nums and not set(r.nums) & set(k["r"].nums)) and least >= 6 and len(set(r.toks) & set(k["r"].toks)) / least >= 0.92:
                hit = k
                break
        into[r.id] = r.id
        if hit is None:
            kept[r.outlet, r.lang].append({"r": r})
        elif r.len > hit["r"].len:
            into[hit["r"].id] = r.id
            hit["r"] = r
        else:
            into[r.id] = hit["r"].id

    def end(x):
        while into[x] != x:
            x = into[x]
        return x

    got = {r.id: r.kept_id for r in R.dedupe_revisions(a).collect()}
    assert got == {x: end(x) for x in into} and sum(k != v for k, v in got.items()) > 20


def test_clusters(spark):
    """Average linkage over all nonzero similarities of a language, not only within components."""
    import numpy as np

    docs = Q._docs(spark, SF).withColumn("nums", T.extract_numbers("title"))
    got = {r.id: r.cluster_id for r in L.cluster_by_language(spark, docs).collect()}
    w = L.tfidf(Q._termed(spark, SF)).groupBy("id").agg(F.collect_list("term").alias("terms"), F.collect_list("w").alias("w"))
    rows = docs.select("id", "lang", F.unix_micros("published").alias("at"), "nums").join(w, "id").orderBy("id").collect()
    want = {i: i for i in got}
    for lang in {r.lang for r in rows}:
        mine = [r for r in rows if r.lang == lang]
        near = L.similarities([r.terms for r in mine], [r.w for r in mine], np.array([r.at for r in mine]), [set(r.nums) for r in mine], True)
        labels = L.average_linkage(near, 1 - L.THRESHOLD.get(lang, L.DEFAULT_THRESHOLD))
        for r, k in zip(mine, labels):
            want[r.id] = mine[k].id
    assert got == want and len(set(got.values())) < 0.95 * len(got)
