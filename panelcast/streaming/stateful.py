"""Look-back features on a stream (WN-1..WN-5, WN-9), with state per series.

A series' state is a ring of its last values, the time of the last row given
out, and the rows that wait.  Rows may come out of order within the
watermark's delay: a row waits until an event-time timer tells that the
watermark has passed it, so rows leave in the order of time and every lag and
rolling statistic equals the batch operators' on the same rows.  The state
holds ``back`` values and the rows of the delay, however long the series.

A row that comes after its time has left is ``late``: it is given out without
features and changes nothing (Spark itself drops rows older than the watermark).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STATISTICS = ("mean", "std", "min", "max", "range")


def feature_columns(lags: Sequence[int], windows: Sequence[int]) -> list[str]:
    return [f"lag_{k}" for k in lags] + [f"rolling_{s}_{w}" for w in windows for s in STATISTICS]


def features_of(ring: list[float], y: float, lags: Sequence[int], windows: Sequence[int]) -> list[float | None]:
    """Features of a row with target ``y`` after the values of ``ring`` (the last one last; NaN: missing)."""
    out = [ring[-k] if k <= len(ring) and not math.isnan(ring[-k]) else None for k in lags]
    row = [*ring, y]
    for w in windows:
        frame = np.array(row[-w:])
        if len(frame) < w or np.isnan(frame).any():
            out += [None] * len(STATISTICS)
        else:
            std = float(frame.std(ddof=1)) if w > 1 else None
            out += [float(frame.mean()), std, float(frame.min()), float(frame.max()), float(frame.max() - frame.min())]
    return out


class LookBack(StatefulProcessor):
    def __init__(self, lags: Sequence[int], windows: Sequence[int]):
        self.lags, self.windows = list(lags), list(windows)
        self.back = max([*self.lags, *(w - 1 for w in self.windows), 1])
        self.names = ["series_id", "ds", "y", *feature_columns(lags, windows), "late"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.done = handle.getValueState("done", "last long, ring array<double>")
        self.waiting = handle.getListState("waiting", "at long, y double")

    def _given(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            out = pd.DataFrame(rows, columns=self.names)
            out["ds"] = pd.to_datetime(out["ds"], unit="us")
            yield out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.done.get()[0] if self.done.exists() else None
        late = []
        for pdf in rows:
            for at, y in zip(pdf["at"].tolist(), pdf["y"].tolist()):
                value = math.nan if y is None else float(y)
                if last is not None and at <= last:
                    late.append((key[0], at, None if math.isnan(value) else value, *[None] * len(feature_columns(self.lags, self.windows)), True))
                else:
                    self.waiting.appendValue((at, value))
                    self.handle.registerTimer(-(-at // 1000))
        yield from self._given(late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = expiredTimerInfo.getExpiryTimeInMs() * 1000
        waiting = sorted(tuple(r) for r in self.waiting.get()) if self.waiting.exists() else []
        ready, rest = [r for r in waiting if r[0] <= upto], [r for r in waiting if r[0] > upto]
        if not ready:
            return
        ring = [math.nan if v is None else v for v in self.done.get()[1]] if self.done.exists() else []
        out = []
        for at, y in ready:
            value = math.nan if y is None else y
            out.append((key[0], at, None if math.isnan(value) else value, *features_of(ring, value, self.lags, self.windows), False))
            ring = [*ring, value][-self.back:]
        self.done.update((ready[-1][0], ring))
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        yield from self._given(out)

    def close(self) -> None:
        pass


def look_back_stream(panel: DataFrame, lags: Sequence[int] = (1, 7), windows: Sequence[int] = (7,), watermark: str = "1 day") -> DataFrame:
    """Stream of (series_id, ds, y, lags, rolling statistics, late) from a stream of (series_id, ds timestamp, y).

    Needs the RocksDB state store
    (``spark.sql.streaming.stateStore.providerClass``).
    """
    ts = F.col("ds").cast("timestamp")
    src = panel.select(F.col("series_id").cast("string").alias("series_id"), ts.alias("ts"),
                       F.unix_micros(ts).alias("at"), F.col("y").cast("double").alias("y")).withWatermark("ts", watermark)
    schema = "series_id string, ds timestamp, y double, " + ", ".join(f"{c} double" for c in feature_columns(lags, windows)) + ", late boolean"
    return src.groupBy("series_id").transformWithStateInPandas(
        statefulProcessor=LookBack(lags, windows), outputStructType=schema, outputMode="Append", timeMode="EventTime")


def naive_scores_stream(featured: DataFrame, season: int = 1) -> DataFrame:
    """WN-9 on the stream: the value ``season`` rows before as the forecast, and its error (``lag_{season}`` must be there)."""
    return featured.where(~F.col("late")).select(
        "series_id", "ds", "y", F.col(f"lag_{season}").alias("yhat"), F.abs(F.col("y") - F.col(f"lag_{season}")).alias("abs_error"))
