"""Grid, imputation, baseline and continuity."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from evidentia.operators import series as S
from evidentia.operators.regular_grid import impute_blocks, missing_days, read_date, regular_grid

SCHEMA = "reading_id bigint, series_id string, date string, observed_at timestamp, aircraft int, navy_ships int, official_ships int, parse_ok boolean, value double, block int"


def at(day, hour=0):
    return dt.datetime(2026, 1, day, hour)


def test_read_date(spark):
    cases = {"2026-01-05": "2026-01-05", "2026/1/5": "2026-01-05", "115.01.05": "2026-01-05", "20260105": "2026-01-05", " 2026.1.5": "2026-01-05", "pending": None, "": None, None: None, "2026-13-40": None, "1150105": "2026-01-05"}
    df = spark.createDataFrame([(k,) for k in cases], "d string").select("d", F.date_format(read_date("d"), "yyyy-MM-dd"))
    assert {r[0]: r[1] for r in df.collect()} == cases


def test_grid_cases(spark):
    rows = [
        (1, "a", "2026-01-01", at(1), 1, 5, 1, True, 9.0, 7), (2, "a", "2026-01-01", at(1, 5), 1, 6, None, True, 9.0, 7),  # the later one counts, field by field
        (2, "a", "2026-01-01", at(1, 5), 1, 6, None, True, 9.0, 7),  # repeated
        (3, "a", "2026-01-03", at(3), 1, -1, 2, True, 9.0, 7), (4, "a", "2026-01-04", at(4), 1, 7, 2, False, 9.0, 7), (5, "a", "2026-01-05", None, 1, 7, 3, True, 9.0, 7),
        (6, "a", "bad", at(9), 1, 7, 3, True, 9.0, 7), (7, None, "2026-01-02", at(2), 1, 1, 1, None, 9.0, 7),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.series_id, r.field, str(r.on_date)): (r.value, r.state) for r in regular_grid(df).collect()}
    assert got["a", "navy_ships", "2026-01-01"] == (6.0, "observed") and got["a", "official_ships", "2026-01-01"] == (1.0, "observed")
    assert {k[2] for k in got if k[0] == "a"} == {f"2026-01-0{d}" for d in range(1, 6)}
    assert got["a", "navy_ships", "2026-01-04"][1] == "median" and got[None, "navy_ships", "2026-01-02"] == (None, "missing")
    missing = {(r.series_id, r.field, r.on_date) for r in missing_days(regular_grid(df)).collect()}
    assert missing == {("a", "navy_ships", f"2026-01-0{d}") for d in (2, 3, 4)} | {("a", "official_ships", "2026-01-02"), ("a", "official_ships", "2026-01-04"), (None, "navy_ships", "2026-01-02"), (None, "official_ships", "2026-01-02")}


def test_empty(spark):
    assert regular_grid(spark.createDataFrame([], SCHEMA)).count() == 0


def test_blocks_cover_long_series_once(spark):
    rows = [(i, "a", str(dt.date(2025, 1, 1) + dt.timedelta(days=i)), None, 1, i % 7, 1, True, 0.0, 0) for i in range(0, 700, 2)]
    got = regular_grid(spark.createDataFrame(rows, SCHEMA), block_days=100, margin=10)
    assert got.count() == 2 * 699 and got.select("field", "on_date").distinct().count() == 2 * 699


def test_imputation_follows_a_cycle():
    t = np.arange(140)
    true = 20 + 8 * np.sin(2 * np.pi * t / 7)
    y = true.copy()
    gone = np.random.default_rng(1).choice(140, 30, replace=False)
    y[gone] = np.nan
    (filled, none), how = impute_blocks([y, np.full(5, np.nan)])
    assert np.abs(filled - true)[gone].mean() < 1.0 and np.array_equal(filled[~np.isnan(y)], y[~np.isnan(y)])
    assert np.isnan(none).all() and how == ["filled", "missing"]
    assert impute_blocks([y], rounds=1)[1] == ["unsettled"] and impute_blocks([y[:5]])[1] == ["median" if np.isnan(y[:5]).any() else "filled"]


def test_a_stack_gives_what_single_blocks_give():
    rng = np.random.default_rng(6)
    ys = []
    for n in (3, 9, 20, 40, 41, 120, 200):
        y = 10 + 5 * np.sin(np.arange(n) / 5) + rng.normal(0, 1, n)
        y[rng.random(n) < 0.2] = np.nan
        ys.append(y)
    together, how = impute_blocks(ys)
    for y, z, h in zip(ys, together, how):
        (alone,), (k,) = impute_blocks([y])
        assert h == k and np.allclose(alone, z, equal_nan=True, atol=1e-6)


def test_baseline_needs_rows_and_skips_today(spark):
    def last(n, value=4):
        df = spark.createDataFrame([(dt.date(2026, 1, 1) + dt.timedelta(days=i), i if value is None else value) for i in range(n + 1)], "date date, index int")
        return S.trailing_baseline(df).orderBy(F.col("date").desc()).first()

    assert last(13).baseline is None and last(14).baseline == 4.0 and last(14).ratio == 1.0
    assert last(91, None).baseline == 45.5  # the median of rows 1 to 90, without row 91 itself
    zero = last(20, 0)
    assert zero.baseline == 0.0 and zero.ratio is None


def test_bulletin_sentences(spark):
    pages = spark.createDataFrame([("<p>PLA Activities 2026.1.5</p> 12 PLA aircraft and 7 PLAN vessels and 2 official ships were detected as of 6 a.m.; 9 sorties crossed the median line, 1 balloon",), ("PLA Activities 2026.1.6 were detected as of 6 a.m.",), ("nothing",), ("PLA Activities 2026.1.7 3 PLA aircraft were detected by noon; none crossed the median line",)], "html string")
    got = {str(r.date): r for r in S.parse_bulletin(pages, "html").collect()}
    a = got["2026-01-05"]
    assert (a.aircraft, a.navy_ships, a.official_ships, a.balloons, a.crossed_median, a.parse_ok) == (12, 7, 2, 1, 9, True)
    assert not got["2026-01-06"].parse_ok and got["2026-01-07"].crossed_median == 0 and len(got) == 3


def test_list_links_take_the_date_after_them(spark):
    page = spark.createDataFrame([('2026.1.1 <a href="/x/Act/11">one</a> 2026.1.2 <a href="/x/Act/12">two</a> 2026.1.3 <a href="/x/Act/11">again</a>',)], "html string")
    assert [(r.number, str(r.date)) for r in S.list_links(page, "html", "/Act/").orderBy("number").collect()] == [("11", "2026-01-02"), ("12", "2026-01-03")]


def test_continuity(spark):
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    df = spark.createDataFrame([("a", d) for d in days] + [("b", d) for d in days[::2]], "s string, date date")
    got = {r.s: r for r in S.continuity(df, by=["s"]).collect()}
    assert got["a"].continuous and not got["b"].continuous and got["b"].two_day_share == 1.0


def test_bulletin_sentence_forms(spark):
    pages = spark.createDataFrame(
        [
            ("Activities 2024.2.1 27 PLA aircraft and 7 PLAN vessels operating around Taiwan were detected up until 6 a.m. 19 of the aircraft crossed the median line",),
            ("Activities 2026.2.2 3 sorties of PLA aircraft, 7 PLAN ships and 4 official ships were detected as of 6 a.m. 1 out of 3 sorties crossed the median line",),
            ("Activities 2026.2.3 5 PLAAF warplanes detected by noon, 12 PLAN ships; no sorties crossed the median line",),
            ("Activities 2026.2.4 5 PLA planes and 12 PLAN ships detected by noon; none of them crossed the median line",),
            ("Activities 2026.2.5 3 PLA planes detected by noon; 9 sorties had crossed the median line",),
        ],
        "html string",
    )
    got = [(r.aircraft, r.navy_ships, r.official_ships, r.crossed_median, r.parse_ok) for r in S.parse_bulletin(pages, "html").orderBy("date").collect()]
    assert got == [(27, 7, 0, 19, True), (3, 7, 4, 1, True), (5, 12, 0, 0, True), (5, 12, 0, 0, True), (3, 0, 0, 3, True)]
