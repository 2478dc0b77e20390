"""Long series: one series over many tasks (CL-6, CL-7, CL-10, CL-12, CL-15, CL-16, SL-1, WN-1..WN-8, WN-11, WN-12).

The plain operators window over a whole series, which one task must hold and
sort.  That is right for days (a few hundred rows a year); series of raw
events or of seconds don't fit.  The operators here give the same rows and
columns and never bring a series together:

* look-back and look-ahead of so many rows: stretches of the series with a
  halo of neighbouring rows, whose own rows are kept (``ranges.with_halo``);
* fills, interpolation, positions, next dates: two passes, unit summaries
  and a scan over them (``ranges.carry``, ``ranges.rank``);
* statistics of a series: partial aggregates, joined back per stretch
  (``ranges.spread``).

Rows are ordered by ``ds``; a series should have one row per ``ds`` (rows of
one ``ds`` are in an open but fixed order).  A missing target, a series of
one row or without any value, and an empty panel give what the plain
operators give.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import TEMPORAL_FEATURE_NAMES
from ..functions.numeric import nan_to_null
from ..functions.windows import DS, Y, keys_of
from ..session import cut_lineage
from . import clean as C
from . import features as FE
from .holidays import add_holidays
from .ranges import BUCKET, GROUP, HALO, TIE, carry, in_ranges, plain, rank, spread, with_halo

ROWS = 100_000
ORDER = [DS, TIE]
IN_STRETCH = [GROUP, BUCKET]


def positions(panel: DataFrame, keys=None, name: str = "pos") -> DataFrame:
    """0-based row position per series."""
    return plain(rank(in_ranges(panel, keys_of(keys), [DS]), ORDER, name))


def split_temporal(panel: DataFrame, train_ratio: float = 0.7, val_ratio: float = 0.15, keys=None, name: str = "split") -> DataFrame:
    """SL-1 by global positions."""
    at = rank(in_ranges(panel, keys_of(keys), [DS]), ORDER, "_at", "_all")
    n_train, n_val = F.floor(F.col("_all") * F.lit(float(train_ratio))), F.floor(F.col("_all") * F.lit(float(val_ratio)))
    label = F.when(F.col("_at") < n_train, "train").when(F.col("_at") < n_train + n_val, "val").otherwise("test")
    return plain(at.withColumn(name, label).drop("_at", "_all"))


def _forward_filled(rows: DataFrame, value: str) -> DataFrame:
    return carry(rows, ORDER, forward={value: F.col(value)})


def _interpolated(rows: DataFrame, value: str) -> DataFrame:
    at = rank(rows, ORDER, "_rn")
    point = F.when(F.col(value).isNotNull(), F.struct(F.col("_rn").alias("i"), F.col(value).alias("v")))
    near = carry(at, ORDER, forward={"_before": point}, backward={"_after": point})
    before, after = F.col("_before"), F.col("_after")
    filled = (F.when(F.col(value).isNotNull(), F.col(value)).when(before.isNull(), F.lit(None).cast("double"))
              .when(after.isNull(), before["v"])
              .otherwise(before["v"] + (after["v"] - before["v"]) * ((F.col("_rn") - before["i"]) / (after["i"] - before["i"]))))
    return near.withColumn(value, filled).drop("_rn", "_before", "_after")


def forward_fill(panel: DataFrame, keys=None, value: str = Y) -> DataFrame:
    """CL-7."""
    return plain(_forward_filled(in_ranges(panel, keys_of(keys), [DS]), value)).select(*panel.columns)


def interpolate_linear(panel: DataFrame, keys=None, value: str = Y) -> DataFrame:
    """CL-6."""
    return plain(_interpolated(in_ranges(panel, keys_of(keys), [DS]), value)).select(*panel.columns)


def _densified(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every missing day of a series; a row's days stay in its unit, in order."""
    nxt = carry(rows, ORDER, following={"_next": F.col(DS)})
    last_day = F.when(F.col("_next") > F.col(DS), F.date_sub("_next", 1)).otherwise(F.col(DS))
    days = nxt.select("*", F.posexplode_outer(F.sequence(F.col(DS), last_day)).alias("_k", "_d"))
    first = F.coalesce(F.col("_k"), F.lit(0)) == 0
    out = {DS: F.coalesce("_d", DS)} | {c: F.when(first, F.col(c)) for c in columns}
    return days.withColumns(out).drop("_next", "_k", "_d")


def densify(panel: DataFrame, keys=None) -> DataFrame:
    """CL-16."""
    ks = keys_of(keys)
    return plain(_densified(in_ranges(panel, ks, [DS]), [c for c in panel.columns if c not in (*ks, DS)])).select(*panel.columns)


def preprocess_complete(panel: DataFrame, keys=None, missing: str = "interpolate", outlier_threshold: float = 3.0,
                        normalize: bool = True, fill_calendar: bool = True, tie: str | None = None) -> DataFrame:
    """CL-15: the columns and values of ``clean.preprocess_complete``."""
    ks = keys_of(keys)
    p = C.coerce_dates(panel.withColumn(Y, nan_to_null(Y)))
    order = F.col(tie) if tie else F.coalesce(F.col(Y), F.lit(float("inf")))
    p = p.groupBy(*ks, DS).agg(F.min_by(F.struct(Y), order)[Y].alias(Y)).where(F.col(DS).isNotNull())
    rows = in_ranges(p, ks, [DS])
    if fill_calendar:
        rows = _densified(rows, [Y])
    rows = rank(rows, ORDER, "pos")
    fill = {"interpolate": _interpolated, "forward_fill": _forward_filled, "drop": lambda r, v: r.where(F.col(v).isNotNull())}
    rows = cut_lineage(fill[missing](rows, Y) if missing in fill else C.handle_missing(rows, missing, ks))
    stats = rows.groupBy(GROUP).agg(F.avg(Y).alias("_mean"), F.stddev_samp(Y).alias("_std"), F.min(Y).alias("_lo"), F.max(Y).alias("_hi"))
    rows = spread(rows, stats).withColumn("y_raw", F.col(Y))
    z = F.abs(F.try_divide(F.col(Y) - F.col("_mean"), F.col("_std")))
    rows = rows.withColumn("is_outlier", F.coalesce(z > F.lit(float(outlier_threshold)), F.lit(False)))
    if normalize:
        rows = rows.withColumn(Y, C._scaled(Y, "_lo", "_hi"))
    return plain(rows.drop("_mean", "_std", "_lo", "_hi")).select(*ks, DS, Y, "pos", "y_raw", "is_outlier")


def look_back(panel: DataFrame, make, back: int, keys=None, size: int = ROWS, pos: str | None = None) -> DataFrame:
    """``make(rows, keys)`` over stretches with a halo of ``back`` rows: any plain operator that looks back so far and takes ``keys``."""
    rows = rank(in_ranges(panel, keys_of(keys), [DS]), ORDER, pos or "_at")
    made = make(with_halo(rows, back, size=size, pos=pos or "_at"), IN_STRETCH)
    out = plain(made.where(~F.col(HALO)))
    return out if pos else out.drop("_at")


def add_lag_features(panel: DataFrame, lags: Sequence[int] = FE.DEFAULT_LAGS, keys=None, value: str = Y, size: int = ROWS) -> DataFrame:
    """WN-1."""
    return look_back(panel, lambda r, k: FE.add_lag_features(r, lags, k, value), max(lags, default=0), keys, size)


def add_rolling_stats(panel: DataFrame, windows: Sequence[int] = FE.DEFAULT_WINDOWS, keys=None, value: str = Y, size: int = ROWS) -> DataFrame:
    """WN-2..WN-5."""
    return look_back(panel, lambda r, k: FE.add_rolling_stats(r, windows, k, value), max(windows, default=1) - 1, keys, size)


def add_differencing_features(panel: DataFrame, diffs: Sequence[int] = FE.DEFAULT_DIFFS, keys=None, value: str = Y, size: int = ROWS) -> DataFrame:
    """WN-7."""
    return look_back(panel, lambda r, k: FE.add_differencing_features(r, diffs, k, value), max(diffs, default=0), keys, size)


def seasonal_means(rows: DataFrame, periods: Sequence[int], value: str = Y, pos: str = "pos") -> DataFrame:
    """Per ``GROUP`` an array ``_mean_p`` with the mean of each phase of period p (at most the periods' sum of numbers)."""
    phases = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), (F.col(pos) % p).cast("int").alias("at")) for p in periods]))
    means = (rows.select(GROUP, F.col(value).alias("_v"), phases.alias("_ph")).groupBy(GROUP, "_ph").agg(F.avg("_v").alias("_m")))
    of = lambda p: F.map_from_entries(F.collect_list(F.when(F.col("_ph.p") == p, F.struct("_ph.at", "_m"))))
    maps = means.groupBy(GROUP).agg(*[of(p).alias(f"_map_{p}") for p in periods])

    def listed(p: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(p - 1)), lambda i: F.col(f"_map_{p}")[i])

    return maps.select(GROUP, *[listed(p).alias(f"_mean_{p}") for p in periods])


def create_all_features(panel: DataFrame, keys=None, value: str = Y, pos: str = "pos", lags: Sequence[int] = FE.DEFAULT_LAGS,
                        windows: Sequence[int] = FE.DEFAULT_WINDOWS, seasonal_periods: Sequence[int] = FE.DEFAULT_SEASONAL_PERIODS,
                        diffs: Sequence[int] = FE.DEFAULT_DIFFS, pct_periods: Sequence[int] = FE.DEFAULT_PCT_PERIODS,
                        calendar: DataFrame | None = None, country: str = "US", size: int = ROWS) -> DataFrame:
    """WN-12: the 44 features and the two-way fill of ``features.create_all_features``.

    Three moves of the rows: into ranges, into stretches, and (the features
    being written once) none for the fills, which use the stretches again.
    """
    ks, before = keys_of(keys), list(panel.columns)
    rows = in_ranges(panel, ks, [DS])
    rows = rank(rows, ORDER, "_at")
    if pos not in before:
        rows, before = rows.withColumn(pos, F.col("_at")), [*before, pos]
    rows = carry(rows, ORDER, forward={"_filled": F.col(value)})
    back = max([*lags, *diffs, *pct_periods, *(w - 1 for w in windows), 0])
    out = with_halo(rows, back, size=size, pos="_at")
    out = FE.add_lag_features(out, lags, IN_STRETCH, value)
    out = FE.add_rolling_stats(out, windows, IN_STRETCH, value)
    out = FE.add_differencing_features(out, diffs, IN_STRETCH, value)
    out = FE.add_pct_change_features(out, pct_periods, IN_STRETCH, "_filled").where(~F.col(HALO))
    out = spread(out, seasonal_means(rows, seasonal_periods, value, pos), BUCKET)
    for p in seasonal_periods:
        mean: Column = F.col(f"_mean_{p}")[(F.col(pos) % p).cast("int")]
        out = out.withColumn(f"seasonal_mean_{p}", mean).withColumn(f"deseasonalized_{p}", F.col(value) - F.col(f"seasonal_mean_{p}"))
    rolled = [f"rolling_{s}_{w}" for w in windows for s in ("mean", "std", "min", "max", "range")]
    seasonal = [c for p in seasonal_periods for c in (f"seasonal_mean_{p}", f"deseasonalized_{p}")]
    lagged, changes = [f"lag_{k}" for k in lags], [f"diff_{k}" for k in diffs] + [f"pct_change_{k}" for k in pct_periods]
    fills = [value, *lagged, *rolled, *seasonal, *changes]
    fills += [c for c in before if c not in (*ks, DS, pos, *fills)]
    made = cut_lineage(out.select(*before, GROUP, BUCKET, TIE, *[c for c in fills if c not in before]))
    near = carry(made, ORDER, forward={f"_up_{c}": F.col(c) for c in fills}, backward={f"_down_{c}": F.col(c) for c in fills}, unit=BUCKET)
    filled = near.withColumns({c: F.coalesce(f"_down_{c}", f"_up_{c}") for c in fills})
    done = add_holidays(FE.add_temporal_features(filled.select(*before, *[c for c in fills if c not in before])), calendar, country, DS)
    return done.select(*before, *TEMPORAL_FEATURE_NAMES, *lagged, *rolled, *seasonal, "is_holiday", *changes)
