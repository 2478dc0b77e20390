"""Series of any step: seconds to weeks (CL-16, DK-7, PF-1).

The daily operators work on dates.  Here ``ds`` is a timestamp without zone.
The step of a series is read from its own gaps, the spine follows from each
row and the next, and the time axis of Fourier terms has fractions of a day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import TWO_PI
from ..functions.numeric import nan_to_null
from ..functions.windows import DS, Y, by_series, keys_of
from ..sources.tables import series_key

SECOND = 1_000_000  # microseconds


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a timestamp without zone, whatever the session's zone is."""
    t = ts.cast("timestamp_ntz")
    minutes = F.unix_date(t.cast("date")).cast("long") * 1440 + F.hour(t) * 60 + F.minute(t)
    return minutes * (60 * SECOND) + (F.extract(F.lit("SECOND"), t) * SECOND).cast("long")


def at_micros(m: Column) -> Column:
    return F.timestamp_add("MICROSECOND", m, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def step_rollup(df: DataFrame, keys: str | Sequence[str], time_col: str, value_col: str, seconds: int, how: str = "sum") -> DataFrame:
    """PF-1 for a step of so many seconds: one row per series and step, named by the step's start."""
    agg = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count}[how]
    width = seconds * SECOND
    start = at_micros(F.floor(micros(F.col(time_col)) / width) * width)
    return (df.select(series_key(keys).alias("series_id"), start.alias(DS), nan_to_null(F.col(value_col)).alias(Y))
            .groupBy("series_id", DS).agg(agg(Y).cast("double").alias(Y)))


def inferred_steps(panel: DataFrame, keys=None) -> DataFrame:
    """(keys, step): the commonest gap between a series' different times, in microseconds; the smallest on a tie.

    A series with one time has no step.
    """
    ks = keys_of(keys)
    times = panel.select(*ks, micros(F.col(DS)).alias("_t")).where(F.col("_t").isNotNull()).distinct()
    gaps = times.withColumn("step", F.col("_t") - F.lag("_t").over(by_series(ks, "_t"))).where(F.col("step").isNotNull())
    counted = gaps.groupBy(*ks, "step").agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*ks).agg(F.max_by("step", F.struct(F.col("_n"), -F.col("step"))).alias("step"))


def densify_steps(panel: DataFrame, keys=None, seconds: int | None = None, flag: str | None = "is_gap") -> DataFrame:
    """CL-16 on a step of so many seconds, or on each series' own: a row without target for every missing step.

    A row that is off the step's grid stays and starts its grid anew.
    """
    ks = keys_of(keys)
    typed = panel.withColumn(DS, F.col(DS).cast("timestamp_ntz"))
    if seconds is None:
        from .quantiles import with_groups
        typed = with_groups(typed, inferred_steps(typed, ks).withColumnRenamed("step", "_step"), ks)
    else:
        typed = typed.withColumn("_step", F.lit(seconds * SECOND).cast("long"))
    typed = typed.withColumn("_own", micros(F.col(DS)))
    typed = typed.withColumn("_next", F.lead("_own").over(by_series(ks, "_own")))
    missing = F.greatest(F.ceil((F.col("_next") - F.col("_own")) / F.col("_step")) - 1, F.lit(0))
    rows = typed.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(missing, F.lit(0)).cast("long"))))
    others = [c for c in panel.columns if c not in (*ks, DS)]
    return rows.select(*ks, at_micros(F.col("_own") + F.col("_k") * F.coalesce("_step", F.lit(0))).alias(DS),
                       *[F.when(F.col("_k") == 0, F.col(c)).alias(c) for c in others],
                       *([(F.col("_k") > 0).alias(flag)] if flag else []))


def missing_steps(panel: DataFrame, keys=None, seconds: int | None = None) -> DataFrame:
    """CL-16: the steps absent inside each series' span."""
    ks = keys_of(keys)
    return densify_steps(panel.select(*ks, DS), ks, seconds).where("is_gap").drop("is_gap")


def day_fraction(ts: Column) -> Column:
    """Days since 1970-01-01 with their fraction."""
    return micros(ts) / F.lit(86_400.0 * SECOND)


def fourier_terms(ts: Column, period_days: float, order: int, prefix: str) -> list[Column]:
    """``sin/cos(2 pi k t / period)`` on the axis of fractional days, by the phase within the period."""
    phase = micros(ts) % F.lit(round(period_days * 86_400 * SECOND)) / F.lit(period_days * 86_400 * SECOND)
    out = []
    for k in range(1, order + 1):
        angle = F.lit(TWO_PI * k) * phase
        out += [F.sin(angle).alias(f"{prefix}_sin{k}"), F.cos(angle).alias(f"{prefix}_cos{k}")]
    return out


def season_lags(panel: DataFrame, keys=None, value: str = Y, days: Sequence[float] = (1, 7)) -> DataFrame:
    """WN-1 by time: ``lag_{d}d``, the value exactly d days before, whatever the step (missing if there is no such row)."""
    ks = keys_of(keys)
    cols = []
    for d in days:
        back = round(d * 86_400 * SECOND)
        w = Window.partitionBy(*ks).orderBy("_at").rangeBetween(-back, -back)
        cols.append(F.last(value).over(w).alias(f"lag_{d:g}d"))
    return panel.withColumn("_at", micros(F.col(DS))).select("*", *cols).drop("_at")
