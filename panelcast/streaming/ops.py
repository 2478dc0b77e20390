"""Structured Streaming versions of the panel operators (optional extensions).

The reference has no streaming code; these are the streaming forms of its
rollup, scaling and scoring steps:

* ``daily_rollup_stream``: event-time daily rollup with a watermark
  (append mode emits each day once the watermark passes it);
* ``apply_scaler_stream``: stream-static join with a frozen scaler table
  (CL-13 semantics on arriving data);
* ``score_batches``: a ``foreachBatch`` sink that joins arriving actuals to
  stored forecasts and writes per-batch metric sums keyed by batch id, so
  a replayed batch overwrites its own partition instead of double counting.

Row-count lags and rolling statistics need state per series: see
``stateful``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clean import apply_minmax
from ..sources.tables import series_key


def daily_rollup_stream(events: DataFrame, keys: str | Sequence[str], time_col: str, value_col: str,
                        watermark: str = "1 day") -> DataFrame:
    """Daily sums per series on event time.  ``TIMESTAMP_NTZ`` input is cast to ``TIMESTAMP`` (UTC)."""
    ts = F.col(time_col).cast("timestamp").alias("_ts")
    src = events.select(series_key(keys).alias("series_id"), ts, F.col(value_col).cast("double").alias("_v"))
    return (src.withWatermark("_ts", watermark)
            .groupBy("series_id", F.window("_ts", "1 day").alias("w"))
            .agg(F.sum("_v").alias("y"), F.count(F.lit(1)).alias("n_events"))
            .select("series_id", F.to_date(F.col("w.start")).alias("ds"), "y", "n_events"))


def apply_scaler_stream(stream_panel: DataFrame, scaler: DataFrame) -> DataFrame:
    """CL-13 on a stream: join the static scaler table, output ``y_scaled``."""
    return apply_minmax(stream_panel, scaler, out="y_scaled")


def score_batches(forecasts: DataFrame, out_path: str):
    """A ``foreachBatch`` function scoring arriving actuals against stored forecasts.

    Writes ``(batch_id, series_id, n, sum_abs_error, sum_sq_error)`` into a
    table partitioned by ``batch_id`` with dynamic partition overwrite, so a
    retried batch replaces its own rows (idempotent).  MAE/RMSE over any
    set of batches are sums of these columns divided by ``n``.
    """
    fc = forecasts.select("series_id", "ds", "yhat")

    def run(batch: DataFrame, batch_id: int) -> None:
        e = F.col("y") - F.col("yhat")
        sums = (batch.join(fc, ["series_id", "ds"], "inner")
                .groupBy("series_id").agg(F.count(F.lit(1)).alias("n"),
                                          F.sum(F.abs(e)).alias("sum_abs_error"),
                                          F.sum(e * e).alias("sum_sq_error"))
                .withColumn("batch_id", F.lit(int(batch_id))))
        (sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))

    return run


def streaming_metrics(sums: DataFrame) -> DataFrame:
    """MAE and RMSE per series from the per-batch sums."""
    agg = sums.groupBy("series_id").agg(F.sum("n").alias("n"), F.sum("sum_abs_error").alias("sae"),
                                        F.sum("sum_sq_error").alias("sse"))
    return agg.select("series_id", "n", (F.col("sae") / F.col("n")).alias("mae"),
                      F.sqrt(F.col("sse") / F.col("n")).alias("rmse"))
