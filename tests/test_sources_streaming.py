"""Preamble CSV source, run sink and the streaming extensions."""
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.sources import files as FS
from panelcast.streaming import ops as ST


def write_csv(path, n=40, nan_at=(3,), empty_at=(5,)):
    lines = ["Report title", "Generated by test", "Units: MW", "", "notes line"]
    lines.append("Date,Daily Load,Other")
    for i in range(n):
        v = "NaN" if i in nan_at else ("" if i in empty_at else f"{100 + i}.5")
        lines.append(f"2020-01-{i % 28 + 1:02d},{v},x{i}")
    path.write_text("\n".join(lines) + "\n")


def test_preamble_csv(spark, tmp_path):
    f = tmp_path / "data.csv"
    write_csv(f, n=20)
    df = FS.read_preamble_csv(spark, str(f), "Date", "Daily Load")
    assert df.columns == ["Date", "Daily Load", "Other"]
    assert df.count() == 20
    assert df.where(F.col("Daily Load").isNull()).count() == 2  # NaN and empty both NULL
    assert dict(df.dtypes)["Date"] == "date"
    head = FS.csv_head(df, "Date", "Daily Load").collect()
    assert len(head) == 5
    with pytest.raises(ValueError):
        FS.read_preamble_csv(spark, str(f), "Date", "Missing")


def test_run_record(spark, tmp_path):
    rec = FS.run_record(spark, {"a": 1, "f": np.float64(2.5)}, "failed", "boom", {"x": object()})
    FS.append_run(rec, str(tmp_path / "runs"))
    FS.append_run(FS.run_record(spark, {"a": 2}, "success"), str(tmp_path / "runs"))
    runs = spark.read.parquet(str(tmp_path / "runs"))
    assert runs.count() == 2
    payload = json.loads(runs.where("status = 'failed'").collect()[0]["payload"])
    assert payload["config"]["a"] == 1


def test_streaming_rollup_matches_batch(spark, tmp_path):
    import shutil
    src_dir = tmp_path / "events"
    src_dir.mkdir()
    shutil.copy("/root/testdata/sf0.001/events.parquet", src_dir / "part-0.parquet")
    schema = spark.read.parquet(str(src_dir)).schema
    stream = spark.readStream.schema(schema).parquet(str(src_dir))
    out = ST.daily_rollup_stream(stream, "event_type", "ts", "value", watermark="0 seconds")
    q = (out.writeStream.format("memory").queryName("roll").outputMode("update")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {(r.series_id, r.ds): r.y for r in spark.sql("select series_id, ds, y from roll").collect()}
    batch = (spark.read.parquet(str(src_dir)).groupBy(F.col("event_type").alias("series_id"),
                                                      F.to_date("ts").alias("ds"))
             .agg(F.sum("value").alias("y")))
    exp = {(r.series_id, r.ds): r.y for r in batch.collect()}
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) < 1e-6 for k in exp)


def test_foreach_batch_scoring_is_idempotent(spark, tmp_path):
    import datetime as dt
    fc = spark.createDataFrame([("s", dt.date(2020, 1, i), float(i)) for i in range(1, 5)],
                               "series_id string, ds date, yhat double")
    actual = spark.createDataFrame([("s", dt.date(2020, 1, i), float(i) + 1) for i in range(1, 5)],
                                   "series_id string, ds date, y double")
    fn = ST.score_batches(fc, str(tmp_path / "sums"))
    fn(actual, 0)
    fn(actual, 0)  # a replay of batch 0 replaces it
    m = ST.streaming_metrics(spark.read.parquet(str(tmp_path / "sums"))).collect()[0]
    assert m["n"] == 4 and m["mae"] == pytest.approx(1.0)
