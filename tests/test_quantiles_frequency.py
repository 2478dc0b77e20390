"""Quantiles by ranks, and series of steps other than a day."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import diagnostics as D
from panelcast.operators import evaluate as E
from panelcast.operators import features as FE
from panelcast.operators import frequency as FR
from panelcast.operators.quantiles import approximate_quantiles, exact_quantiles

PROBS = [0.0, 0.025, 0.5, 0.9, 1.0]


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(8)
    rows = [("ties", float(x)) for x in rng.integers(0, 3, 3000)] + [("wide", float(x)) for x in rng.normal(size=999) * 10.0 ** rng.integers(-5, 9, 999)]
    rows += [("one", 4.0), (None, 1.0), (None, 2.0), ("gaps", None), ("gaps", float("nan")), ("gaps", 7.0), ("none", None)]
    return spark.createDataFrame(rows, "g string, v double").repartition(5).cache()


def test_exact_quantiles(values):
    got = {r.g: (r.n, r.q) for r in exact_quantiles(values, ["g"], F.col("v"), PROBS).collect()}
    by = {}
    for r in values.collect():
        by.setdefault(r.g, []).append(r.v)
    by = {g: [x for x in v if x is not None and x == x] for g, v in by.items()}
    assert got.keys() == {g for g, v in by.items() if v}
    for g, (n, q) in got.items():
        assert n == len(by[g]) and q == pytest.approx(np.quantile(by[g], PROBS).tolist(), rel=1e-12)
    assert exact_quantiles(values.limit(0), ["g"], F.col("v"), PROBS).count() == 0


def test_no_task_holds_a_group(spark):
    big = spark.range(200_000).select(F.lit("g").alias("g"), (F.rand(3) * 1000).alias("v"))
    out = exact_quantiles(big, ["g"], F.col("v"), [0.5])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "SinglePartition" not in plan
    assert out.first().q[0] == pytest.approx(big.select(F.median("v")).first()[0])


def test_approximate_quantiles_keep_their_rank_error(values):
    wide = np.sort([r.v for r in values.where("g = 'wide'").collect()])
    for r in approximate_quantiles(values.where("g = 'wide'"), ["g"], F.col("v"), [0.1, 0.9], 0.01).collect():
        for p, q in zip([0.1, 0.9], r.q):
            assert abs(np.searchsorted(wide, q) - p * len(wide)) <= 0.01 * len(wide) + 1


def test_large_forms_equal_the_plain_ones(spark):
    rng = np.random.default_rng(2)
    pred = spark.createDataFrame([(s, k, dt.date(2020, 1, 1) + dt.timedelta(days=i), float(rng.normal()), float(rng.normal()))
                                  for s in "ab" for k in (0, 1) for i in range(60)], "series_id string, fold_idx int, ds date, y double, yhat double")
    for plain, large in ((E.error_analysis(pred, ["series_id", "fold_idx"]), E.error_analysis(pred, ["series_id", "fold_idx"], large=True)),
                         (D.prediction_intervals(pred, pred.drop("y"), ["series_id"]), D.prediction_intervals(pred, pred.drop("y"), ["series_id"], large=True))):
        a, b = (sorted(tuple(r[c] for c in plain.columns) for r in x.collect()) for x in (plain, large))
        for x, y in zip(a, b, strict=True):
            assert x[:2] == y[:2] and [v for v in x if isinstance(v, float)] == pytest.approx([v for v in y if isinstance(v, float)], rel=1e-9)


def at(minutes):
    return dt.datetime(2024, 3, 30, 22) + dt.timedelta(minutes=minutes)


@pytest.fixture()
def steps(spark):
    rows = [("half", at(30 * i), float(i)) for i in range(20) if i not in (3, 4, 11)]
    rows += [("week", at(7 * 1440 * i), float(i)) for i in range(6) if i != 2] + [("one", at(0), 1.0)]
    rows += [("seconds", at(0) + dt.timedelta(seconds=0.5 * i), float(i)) for i in range(8) if i != 5]
    return spark.createDataFrame(rows, "series_id string, ds timestamp_ntz, y double")


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])  # the night of 31 March loses an hour there
def test_steps_are_inferred_and_filled(spark, steps, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {r.series_id: r.step for r in FR.inferred_steps(steps).collect()}
        assert got == {"half": 1800 * 10 ** 6, "week": 7 * 86_400 * 10 ** 6, "seconds": 500_000}
        missing = sorted((r.series_id, r.ds) for r in FR.missing_steps(steps).collect())
        assert missing == sorted([("half", at(90)), ("half", at(120)), ("half", at(330)), ("week", at(14 * 1440)),
                                  ("seconds", at(0) + dt.timedelta(seconds=2.5))])
        dense = FR.densify_steps(steps)
        assert dense.where("NOT is_gap").count() == steps.count() and dense.where("is_gap AND y IS NOT NULL").count() == 0
        fixed = FR.missing_steps(steps.where("series_id = 'half'"), seconds=900)
        assert fixed.count() == 19 * 2 + 1 - 17
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_daily_terms_need_times(spark, steps, panel_df):
    with pytest.raises(ValueError, match="daily"):
        FE.add_fourier_features(panel_df({"s": [("2020-01-01", 1.0)]}), daily=4)
    rows = FE.add_fourier_features(steps, yearly=0, weekly=1, daily=4).where("series_id = 'half'").collect()
    for r in rows:
        day = (r.ds - dt.datetime(1970, 1, 1)) / dt.timedelta(days=1)
        assert r.fourier_daily_cos4 == pytest.approx(np.cos(2 * np.pi * 4 * day), abs=1e-6)
        assert r.fourier_weekly_sin1 == pytest.approx(np.sin(2 * np.pi * day / 7), abs=1e-6)


def test_rollup_and_lags_by_time(spark):
    raw = spark.createDataFrame([(1, at(m), float(m)) for m in (0, 5, 61, 1441, 1500)], "k int, t timestamp_ntz, v double")
    hours = FR.step_rollup(raw, "k", "t", "v", 3600)
    assert sorted((r.ds, r.y) for r in hours.collect()) == [(at(0), 5.0), (at(60), 61.0), (at(1440), 1441.0), (at(1500), 1500.0)]
    lagged = {r.ds: r["lag_1d"] for r in FR.season_lags(hours, days=(1,)).collect()}
    assert lagged == {at(0): None, at(60): None, at(1440): 5.0, at(1500): 61.0}
