"""Long series: equal to the plain operators on irregular data, one series over many tasks, no window over a series."""
import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from panelcast.operators import clean as C
from panelcast.operators import features as FE
from panelcast.operators import longseries as L
from panelcast.operators import splits as S
from panelcast.operators.ranges import in_ranges, rank


@pytest.fixture(scope="module")
def irregular(spark):
    """Gaps of days to years, bursts, long runs without a value, a series without any, one of a single row, a missing key."""
    rnd = random.Random(5)
    rows = []
    for name, n in (("long", 700), ("b", 60), ("one", 1), ("none", 40), (None, 90)):
        day, empty = dt.date(2015, 1, 1), 0
        for i in range(n):
            day += dt.timedelta(days=rnd.choice([1, 1, 1, 1, 2, 3, 40] + ([400] if i % 97 == 0 else [])))
            empty = empty - 1 if empty > 0 else rnd.choice([0] * 60 + [35])
            y = None if name == "none" or empty or i < 3 else float(rnd.choice([0, 0, 1, 5, 7.25, -3]))
            rows.append((name, day, y))
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "series_id string, ds date, y double").repartition(3).cache()


def same(a, b):
    assert a.columns == b.columns
    key = lambda r: tuple((x is None, str(x)) for x in r[:2])
    left, right = sorted(map(tuple, a.collect()), key=key), sorted(map(tuple, b.collect()), key=key)
    assert len(left) == len(right)
    for x, y in zip(left, right):
        for c, u, v in zip(a.columns, x, y):
            assert u == v or (u == pytest.approx(v, rel=1e-9, abs=1e-9) if isinstance(u, float) and isinstance(v, float) else False), (c, x, y)


@pytest.mark.parametrize("size", [1, 50, 100_000])
def test_bounded_windows(irregular, size):
    same(L.add_lag_features(irregular, [1, 7, 20], size=size), FE.add_lag_features(irregular, [1, 7, 20]))
    same(L.add_rolling_stats(irregular, [7, 14], size=size), FE.add_rolling_stats(irregular, [7, 14]))
    same(L.add_differencing_features(irregular, [1, 30], size=size), FE.add_differencing_features(irregular, [1, 30]))


def test_fills_positions_splits(irregular):
    same(L.forward_fill(irregular), C.forward_fill(irregular))
    same(L.interpolate_linear(irregular), C.interpolate_linear(irregular))
    same(L.positions(irregular), C.add_position(irregular))
    same(L.split_temporal(irregular), S.split_temporal(irregular))
    same(L.densify(irregular), C.densify(irregular, flag=None).select(*irregular.columns))


@pytest.mark.parametrize("missing", ["interpolate", "forward_fill", "drop"])
def test_preprocessing(irregular, missing):
    short = irregular.where("ds < date'2021-01-01'")
    want = C.preprocess_complete(short, missing=missing)
    same(L.preprocess_complete(short, missing=missing), want.select("series_id", "ds", "y", "pos", "y_raw", "is_outlier"))


@pytest.mark.parametrize("size", [95, 100_000])
def test_all_features(irregular, size):
    panel = C.add_position(irregular)
    same(L.create_all_features(panel, size=size), FE.create_all_features(panel))


def test_empty_panel(irregular):
    nothing = irregular.limit(0)
    assert L.create_all_features(nothing).count() == L.preprocess_complete(nothing).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def as_many_tasks(spark):
    """Small stages keep their partitions, as large ones do."""
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", was)


def test_one_series_spans_many_tasks(spark, as_many_tasks):
    one = spark.range(40_000).select(F.lit("s").alias("series_id"), F.col("id").cast("timestamp").alias("ds"), F.rand(1).alias("y"))
    out = L.add_rolling_stats(one, [7], size=1000)
    tasks = out.groupBy(F.spark_partition_id().alias("t")).count().collect()
    assert sum(r["count"] for r in tasks) == 40_000 and max(r["count"] for r in tasks) < 20_000
    p = plan(out)
    assert "SinglePartition" not in p and "CartesianProduct" not in p and "NestedLoop" not in p
    # no window is partitioned by the series alone but those over the units' summaries
    for w in re.findall(r"Window \[.*?\](?=\n|$)", p):
        assert "_bucket" in w or "_unit" in w, w


def test_equal_rows_are_cut_into_ranges(spark):
    same_value = spark.range(20_000).select(F.lit("g").alias("g"), F.lit(0.0).alias("x"))
    cut = in_ranges(same_value, ["g"], ["x"], 8)
    sizes = [r["count"] for r in cut.groupBy("_unit").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 10_000
    ranks = [r.pos for r in rank(cut, ["x", "_tie"]).select("pos").collect()]
    assert sorted(ranks) == list(range(20_000))
