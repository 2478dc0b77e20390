"""Look-back features on a stream: a replay in files, out of order, equals the batch operators."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelcast.operators import features as FE
from panelcast.streaming import stateful as ST

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def test_features_of_a_row():
    assert ST.features_of([1.0, 2.0], 4.0, [1, 2, 3], [3]) == [2.0, 1.0, None, pytest.approx(7 / 3), pytest.approx(1.527525), 1.0, 4.0, 3.0]
    assert ST.features_of([], 4.0, [1], [2]) == [None] * 6
    assert ST.features_of([float("nan")], 4.0, [1], [2]) == [None] * 6


def test_replay_equals_batch(spark, tmp_path):
    rnd = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(s, start + dt.timedelta(hours=i), None if rnd.random() < 0.05 else round(rnd.random() * 10, 3)) for i in range(60) for s in "ab" if rnd.random() < 0.9]
    # out of order by up to two hours; the watermark waits three
    rows.sort(key=lambda r: r[1] + dt.timedelta(hours=rnd.random() * 2))
    schema = "series_id string, ds timestamp, y double"
    for k in range(4):
        part = rows[k * len(rows) // 4:(k + 1) * len(rows) // 4]
        if k == 2:
            part = [*part, ("a", start, 99.0)]  # long gone
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={k}"))
    closing = spark.createDataFrame([(s, start + dt.timedelta(days=30), 0.0) for s in "ab"], schema)
    closing.coalesce(1).write.parquet(str(tmp_path / "in" / "part=9"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        stream = spark.readStream.schema(schema + ", part int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        out = ST.look_back_stream(stream, lags=(1, 3), windows=(4,), watermark="3 hours")
        query = out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option(
            "path", str(tmp_path / "out")).trigger(availableNow=True).start()
        assert query.awaitTermination(240)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = spark.read.parquet(str(tmp_path / "out")).where("NOT late")
    batch = FE.add_rolling_stats(FE.add_lag_features(spark.createDataFrame(rows, schema), [1, 3]), [4])
    want = {(r.series_id, r.ds): r for r in batch.collect()}
    found = {(r.series_id, r.ds): r for r in got.collect()}
    assert found.keys() >= {k for k in want if k[1] < start + dt.timedelta(hours=56)}
    for k, r in found.items():
        if k in want:
            for c in ["y", *ST.feature_columns([1, 3], [4])]:
                assert r[c] == (pytest.approx(want[k][c]) if want[k][c] is not None else None), (k, c)
    assert not any(r.y == 99.0 for r in got.collect())
    scores = ST.naive_scores_stream(got.withColumn("late", F.lit(False)), 1).where("yhat IS NOT NULL AND y IS NOT NULL").collect()
    assert scores and all(r.abs_error == pytest.approx(abs(r.y - r.yhat)) for r in scores)
