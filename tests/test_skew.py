"""Hot keys: one series and one day hold most rows; results stay exact and no group is gathered raw."""
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelcast.operators import clean as C
from panelcast.sources import tables as T


def hot_raw(spark):
    # 3,000 rows: 2,000 on one (series, day), the rest spread over 50 days and 4 series
    hot = spark.range(2000).select(F.lit("hot").alias("series_id"), F.lit(dt.date(2020, 1, 5)).alias("ds"),
                                   (F.col("id") % 97).cast("double").alias("y"), (F.col("id") * 7 % 2003).alias("k"))
    cold = spark.range(1000).select((F.col("id") % 5).cast("string").alias("series_id"),
                                    F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 50).cast("int")).alias("ds"),
                                    F.col("id").cast("double").alias("y"), (F.col("id") + 5000).alias("k"))
    return hot.unionByName(cold)


def test_positions_exact_under_skew(spark):
    raw = hot_raw(spark)
    got = C.sort_and_position(raw, tie="k", partitions=16)
    exp = raw.withColumn("p2", F.row_number().over(
        Window.partitionBy("series_id").orderBy(F.col("ds").asc_nulls_last(), "k")) - 1)
    bad = got.join(exp.select("series_id", "k", "p2"), ["series_id", "k"]).where("pos != p2").count()
    assert bad == 0 and got.count() == 3000


def test_dedup_and_rollup_aggregate_before_shuffle(spark):
    raw = hot_raw(spark)
    d = C.dedup_keep_first(raw, tie="k")
    assert d.where("series_id = 'hot'").collect()[0]["y"] == 0.0  # k = 0 is the first row
    plan = T.daily_rollup(raw.withColumnRenamed("series_id", "s"), "s", "ds", "y")._jdf.queryExecution() \
        .executedPlan().toString()
    # a partial HashAggregate sits below the exchange: hot keys are combined map-side
    assert plan.index("Exchange") < plan.rindex("HashAggregate")
    assert "partial_sum" in plan


def test_supplier_series_are_dealt_by_their_days(spark, tmp_path, monkeypatch):
    """a task of the supplier cross-validation holds whole series, but no more of them for a larger table."""
    from panelcast.functions import windows
    from panelcast.plans import catalog
    from panelcast.plans import workflow as WF

    day = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    rows = [(k, day(7 * k + 40 * i), float(k + i * i % 11)) for k in range(30) for i in range(25)]
    rows += [(3, None, 5.0), (None, day(9), 1.0), (None, day(500), 2.0), (4, day(28), 1.5), (50, day(3), 2.0)]
    (spark.createDataFrame(rows, "l_suppkey long, l_shipdate timestamp, l_quantity double")
     .select("l_suppkey", "l_quantity", "l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet"))
    panel = C.preprocess_complete(T.lineitem_supplier_panel(spark, str(tmp_path))).select("series_id", "ds", "y")
    plain = catalog.round_doubles(WF.cv_seasonal_naive(panel)).collect()
    days = T.lineitem_supplier_days(spark, str(tmp_path))
    assert days == panel.count() == 30 * 961 + 492 + 1
    monkeypatch.setattr(windows, "ROWS_PER_TASK", 1000)
    dealt = catalog.QUERIES["cv_supplier_seasonal_naive"](spark, str(tmp_path))
    assert sorted(map(repr, dealt.collect())) == sorted(map(repr, plain))
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [series_id" in plan and plan.count(f"], {-(-days // 1000)}") == 1
    cleaned = C.preprocess_complete(T.lineitem_supplier_panel(spark, str(tmp_path)), partitions=30)
    assert cleaned.rdd.getNumPartitions() == 30 and max(cleaned.rdd.glom().map(len).collect()) < 7000
