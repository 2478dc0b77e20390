"""Holidays that move with Easter, and forecast paths."""
import datetime as dt

import numpy as np
import pytest
from conftest import daily
from pyspark.sql import functions as F

from panelcast.operators import holidays as H

# Known Easter Sundays, with the earliest and latest possible ones.
EASTERS = ["1818-03-22", "1954-04-18", "1981-04-19", "2000-04-23", "2008-03-23", "2011-04-24", "2024-03-31", "2025-04-20", "2038-04-25", "2049-04-18", "2076-04-19"]


def test_easter_sundays(spark):
    df = spark.createDataFrame([(int(e[:4]),) for e in EASTERS], "year int")
    assert [str(r.e) for r in df.select(H.easter(F.col("year")).alias("e")).collect()] == EASTERS


@pytest.mark.parametrize("country", ["US", "DE", "FR", "GB"])
def test_flag_equals_calendar(spark, country):
    days = spark.range(0, 366 * 30).select(F.date_add(F.lit(dt.date(1999, 12, 25)), F.col("id").cast("int")).alias("ds"))
    cal = {r.ds for r in H.holiday_calendar(spark.range(1999, 2032).select(F.col("id").cast("int").alias("year")), country).collect()}
    flags = {r.ds: r.is_holiday for r in H.add_holidays(days, country=country).collect()}
    assert {d for d, f in flags.items() if f} == {d for d in flags if d in cal}


def test_known_days(spark):
    def on(country, *days):
        df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "ds date")
        return {str(r.ds): r.is_holiday for r in H.add_holidays(df, country=country).collect()}
    assert on("GB", "2022-01-03", "2021-12-27", "2021-12-28", "2022-12-27", "2022-12-26", "2022-12-28", "2020-12-28", "2023-01-02") == {
        "2022-01-03": 1, "2021-12-27": 1, "2021-12-28": 1, "2022-12-27": 1, "2022-12-26": 1, "2022-12-28": 0, "2020-12-28": 1, "2023-01-02": 1}
    assert on("DE", "2024-05-09", "2024-05-20", "2024-10-03", "1989-10-03") == {"2024-05-09": 1, "2024-05-20": 1, "2024-10-03": 1, "1989-10-03": 0}
    assert on("FR", "2024-07-14", "2024-03-29", "2024-04-01") == {"2024-07-14": 1, "2024-03-29": 0, "2024-04-01": 1}


def test_windows_and_unknown_countries(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, d),) for d in (27, 28, 29, 30, 31)], "ds date")
    got = [tuple(r)[1:] for r in H.add_holiday_windows(df, "GB", 1, 1).orderBy("ds").collect()]
    assert got == [(0, 0), (1, 0), (0, 0), (0, 1), (1, 0)]
    with pytest.raises(ValueError, match="XX"):
        H.add_holidays(df, country="XX")


# paths


def ar1(n, phi=0.7, seed=3):
    rng = np.random.default_rng(seed)
    y = [0.0]
    for _ in range(n - 1):
        y.append(phi * y[-1] + rng.normal())
    return y


def test_paths_have_the_variance_of_the_process(spark, panel_df):
    from panelcast.operators import forecast as FC
    from panelcast.plans import workflow as WF
    cfg = FC.LinearARConfig(n_lags=1, max_changepoints=0, weekly_order=0, yearly_order=0, ridge=0.0, trend=False)
    panel = panel_df({"s": daily("2016-01-01", ar1(1500)), "short": daily("2016-01-01", [1.0, None])})
    _, pred, coefs = WF.final_fit(panel, cfg)
    out = WF.forecast_paths(panel, coefs, pred, cfg, periods=40, paths=6000, quantiles=(0.16, 0.5, 0.84))
    rows = sorted(map(tuple, out.where("series_id = 's'").collect()), key=lambda r: r[2])
    assert [tuple(r) for r in out.where("series_id = 'short'").select("status", "error").collect()] == [("failed", "the last 1 values are not all present")]
    phi = coefs.where("series_id = 's'").first().coef[1]
    errors = np.array([r.y - r.yhat for r in pred.where("series_id = 's' AND yhat IS NOT NULL").collect()])
    for k in (1, 2, 5, 40):
        sd = errors.std() * np.sqrt((1 - phi ** (2 * k)) / (1 - phi ** 2))
        assert (rows[k - 1][6] - rows[k - 1][4]) / 2 == pytest.approx(sd * 0.9945, rel=0.06)
    again = WF.forecast_paths(panel.repartition(3), coefs, pred, cfg, periods=40, paths=6000, quantiles=(0.16, 0.5, 0.84))
    assert sorted(map(tuple, again.where("series_id = 's'").collect()), key=lambda r: r[2]) == rows


def test_blocks_go_on_from_their_own_values(spark, panel_df):
    from panelcast.operators import forecast as FC
    from panelcast.plans import workflow as WF
    cfg = FC.LinearARConfig(n_lags=2, n_forecasts=3, max_changepoints=0, weekly_order=1, yearly_order=0, ridge=0.0)
    panel = panel_df({"s": daily("2016-01-01", ar1(500))})
    _, pred, coefs = WF.final_fit(panel, cfg)
    exact = pred.withColumn("y", F.col("yhat"))  # no errors: every path is the plain forecast
    paths = WF.forecast_paths(panel, coefs, exact, cfg, periods=8, paths=5).orderBy("step").collect()
    plain = WF.future_forecast(panel, coefs, cfg, periods=8).orderBy("step").collect()
    assert [r["mean"] for r in paths] == pytest.approx([r.yhat for r in plain]) and [r.q97_5 for r in paths] == pytest.approx([r.yhat for r in plain])
    assert [r.ds for r in paths] == [r.ds for r in plain]
