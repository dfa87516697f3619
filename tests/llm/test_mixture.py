"""Raked mixtures: shares, caps, and the defined cases."""

import os

import numpy as np
import pytest

from evidentia.llm import mixture as M
from evidentia.llm.tokens import FOLDER

have_files = pytest.mark.skipif(not os.path.exists(f"{FOLDER}/byte_bpe_50k.tiktoken"), reason="no vocabulary files")


def test_share_out():
    got = M.share_out(np.array([10.0, 100.0, 0.0, 100.0]), np.array([1.0, 1.0, 1.0, 2.0]), 100.0)
    assert np.allclose(got, [10, 30, 0, 60]) and np.allclose(M.share_out(np.array([5.0, 5.0]), np.array([1.0, 1.0]), 100.0), [5, 5])


def test_rake_meets_sources_and_caps():
    rng = np.random.default_rng(1)
    s, l, t = np.repeat([0, 1, 2], 4), np.tile([0, 0, 1, 1], 3), np.tile([0, 1], 6)
    tokens, cap = rng.uniform(50, 150, 12), np.array([2.0, 1.0, 5.0])
    by_s = M.share_out(np.bincount(s, tokens) * cap, np.array([3.0, 1.0, 4.0]), tokens.sum())
    w, settled = M.rake(s, l, t, tokens, cap, by_s, np.array([0.7, 0.3]) * by_s.sum(), np.array([0.5, 0.5]) * by_s.sum())
    assert np.allclose(np.bincount(s, w * tokens), by_s, rtol=1e-6) and (w <= cap[s] + 1e-9).all()
    assert settled and np.allclose(np.bincount(l, w * tokens) / by_s.sum(), [0.7, 0.3], atol=0.02)


def test_the_default_total_binds_no_cap():
    have, weight, cap = np.array([100.0, 10.0, 0.0, 50.0]), np.array([1.0, 1.0, 2.0, 0.0]), np.array([1.0, 4.0, 9.0, 9.0])
    assert M.unbound_total(have, weight, cap) == 80.0 and M.unbound_total(have * 0, weight, cap) == 0.0
    assert np.allclose(M.share_out(have * cap, weight, 80.0), [40, 40, 0, 0])


DOC = "doc_id bigint, text string, lang string, source string, doc_kind string, copies int"
GOAL = "source string, weight double, max_repeat int"


@have_files
def test_mixture(spark):
    rows = [(k, "ships near the island " * (1 + k % 5), "en" if k % 3 else "fr", "big" if k < 300 else "small", "story", 0) for k in range(320)]
    rows += [(900, None, "en", "big", None, 0), (901, "", None, "big", "story", 0), (902, "text", "en", None, "story", 0), (903, "text", "en", "other", "story", 0)]
    goals = [("big", 1.0, 1), ("small", 1.0, 3), ("none", 2.0, 4), ("zero", 0.0, 2), (None, 5.0, 1)]
    mix, report, margins = M.mix(spark.createDataFrame(rows, DOC), spark.createDataFrame(goals, GOAL))
    got = {r.source: r for r in report.collect()}
    assert set(got) == {"big", "small", "none", "zero"} and got["none"].used_tokens == 0
    assert got["small"].most_copies == 3 and abs(got["small"].used_tokens - 3 * got["small"].tokens) == 0  # the cap binds
    assert all(r.converged for r in got.values()) and abs(got["small"].actual_share - 0.5) < 0.03
    assert {(r.dimension, r.value) for r in margins.collect()} == {("language", "en"), ("language", "fr"), ("topic", "story")}
    used = mix.collect()
    assert {r.source for r in used} == {"big", "small"} and max(r.copies for r in used if r.source == "big") == 1
    mix2, report2, _ = M.mix(spark.createDataFrame(rows, DOC), spark.createDataFrame(goals, GOAL), total_tokens=3.0 * got["small"].tokens, stratum_rows=50)
    for r in report2.collect():
        if r.source in ("big", "small"):
            assert abs(r.actual_share - 0.5) < 0.03


@have_files
def test_empty_tables(spark):
    mix, report, _ = M.mix(spark.createDataFrame([], DOC), spark.createDataFrame([("a", 1.0, 2)], GOAL))
    assert mix.count() == 0 and report.first().actual_share == 0.0
    mix, report, _ = M.mix(spark.createDataFrame([(1, "x", "en", "a", "story", 0)], DOC), spark.createDataFrame([], GOAL))
    assert mix.count() == 0 and report.count() == 0
