"""Splits, folds and the holiday calendar."""
import datetime as dt

import pytest
from conftest import daily
from pyspark.sql import functions as F

from panelcast.operators import holidays as H
from panelcast.operators import splits as S


@pytest.mark.parametrize("n", range(1, 21))
def test_split_sizes_truncate(spark, panel_df, n):
    df = S.split_temporal(panel_df({"s": daily("2020-01-01", [1.0] * n)}))
    sizes = {r.split: r.n_rows for r in S.split_sizes(df).collect()}
    assert sizes.get("train", 0) == int(n * 0.7)
    assert sizes.get("val", 0) == int(n * 0.15)
    assert sum(sizes.values()) == n


def test_yearly_folds(spark, panel_df):
    five = daily("2016-06-01", [1.0] * (365 * 5))
    one = daily("2020-02-01", [1.0] * 10)
    df = panel_df({"five": five, "one": one})
    assert S.yearly_folds(df).count() == 5  # no cap unless asked for
    folds = S.yearly_folds(df, max_folds=3).orderBy("series_id", "fold_idx").collect()
    assert [(f.series_id, f.fold_idx, f.train_years, f.test_year) for f in folds] == [
        ("five", 0, [2016], 2017), ("five", 1, [2016, 2017], 2018), ("five", 2, [2016, 2017, 2018], 2019)]
    rows = S.expand_yearly_folds(df)
    bad = (rows.groupBy("series_id", "fold_idx")
           .agg(F.max(F.when(F.col("role") == "train", F.col("ds"))).alias("tmax"),
                F.min(F.when(F.col("role") == "test", F.col("ds"))).alias("tmin"))
           .where("tmax >= tmin").count())
    assert bad == 0
    assert rows.where("series_id = 'one'").count() == 0


def test_rolling_origin_rows(spark, panel_df):
    df = panel_df({"s": daily("2020-01-01", [1.0] * 100)})
    rows = S.rolling_origin_rows(df, initial_train_size=50, test_size=10, step_size=10, gap_size=2,
                                 expanding=False, max_folds=3)
    got = {(r.fold_idx, r.role): (r.lo, r.hi, r.n) for r in rows.groupBy("fold_idx", "role").agg(
        F.min("rn").alias("lo"), F.max("rn").alias("hi"), F.count("*").alias("n")).collect()}
    assert got[(0, "train")] == (0, 49, 50) and got[(0, "test")] == (52, 61, 10)
    assert got[(2, "train")] == (20, 69, 50) and got[(2, "test")] == (72, 81, 10)
    assert {k for k, _ in got} == {0, 1, 2}


def test_holiday_calendar_known_dates(spark):
    years = spark.createDataFrame([(2020,), (2021,), (2022,)], "year int")
    cal = {(str(r.ds), r.name) for r in H.holiday_calendar(years).collect()}
    for d, name in [("2020-11-26", "Thanksgiving"), ("2020-07-03", "Independence Day (observed)"),
                    ("2021-12-31", "New Year's Day (observed)"), ("2020-05-25", "Memorial Day"),
                    ("2021-06-18", "Juneteenth National Independence Day (observed)"),
                    ("2021-01-18", "Martin Luther King Jr. Day"), ("2020-09-07", "Labor Day")]:
        assert (d, name) in cal
    assert not any(n.startswith("Juneteenth") for d, n in cal if d.startswith("2020"))


def test_holiday_flag_expression_equals_calendar(spark):
    days = spark.range(0, 366 * 12).select(F.date_add(F.lit(dt.date(2015, 1, 1)), F.col("id").cast("int")).alias("ds"))
    years = spark.range(1990, 2032).select(F.col("id").cast("int").alias("year"))
    cal = H.holiday_calendar(years).select(F.col("ds").alias("h")).distinct()
    joined = days.join(cal, days.ds == cal.h, "left").select("ds", F.col("h").isNotNull().cast("int").alias("a"))
    mism = joined.withColumn("b", H.holiday_flag(F.col("ds"))).where("a != b").count()
    assert mism == 0
