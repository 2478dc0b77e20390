"""Window-function feature operators (SC-8, WN-1..WN-8, WN-11, WN-12, DK-7).

Look-back is counted in rows, as in the reference; densify the panel first
(``clean.densify``) when day semantics are wanted.  All per-row windows use
the same ``partitionBy(series).orderBy(ds)`` spec, so Catalyst plans one
exchange on the series keys and one sort for the whole feature table; the
seasonal means partition by (series, phase), which the series hash
partitioning already satisfies, so they add a sort but no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import TEMPORAL_FEATURE_NAMES, fourier_columns, temporal_columns
from ..functions.numeric import signed_inf_div
from ..functions.windows import DS, Y, by_series, following, keys_of, preceding, whole
from .holidays import add_holidays

# The reference's default option lists.
DEFAULT_LAGS = [7, 14, 30, 90]
DEFAULT_WINDOWS = [7, 14, 30]
DEFAULT_SEASONAL_PERIODS = [7, 30, 365]
DEFAULT_DIFFS = [1, 7, 30]
DEFAULT_PCT_PERIODS = [1, 7, 30]


def add_temporal_features(df: DataFrame, date_col: str = DS) -> DataFrame:
    """SC-8: the twelve calendar columns."""
    return df.select("*", *temporal_columns(date_col))


def lag_columns(lags: Sequence[int], keys=None, value: str = Y) -> list[Column]:
    w = by_series(keys)
    return [F.lag(F.col(value), k).over(w).alias(f"lag_{k}") for k in lags]


def add_lag_features(df: DataFrame, lags: Sequence[int] = DEFAULT_LAGS, keys=None, value: str = Y) -> DataFrame:
    """WN-1: ``lag_k`` = value k rows back, NULL for the first k rows."""
    return df.select("*", *lag_columns(lags, keys, value))


def _joined(a: dict[str, Column], n: int, b: dict[str, Column], m: int) -> dict[str, Column]:
    """Sum, squared deviations from the mean, least and most of two neighbouring stretches of n and m values; missing if either sum is."""
    shift = a["s"] / F.lit(float(n)) - b["s"] / F.lit(float(m))
    return {"s": a["s"] + b["s"], "q": a["q"] + b["q"] + shift * shift * F.lit(n * m / (n + m)),
            "l": F.least(a["l"], b["l"]), "h": F.greatest(a["h"], b["h"])}


def add_rolling_stats(df: DataFrame, windows: Sequence[int] = DEFAULT_WINDOWS, keys=None,
                      value: str = Y) -> DataFrame:
    """WN-2..WN-5: a statistic is defined only when all w rows of the frame hold a value.

    Statistics of 1, 2, 4, ... rows are put together from two of half their
    length, and those of w rows from w's binary digits, with lags only: a row
    costs some lags per power of two, where a sliding frame would go over all w rows
    for each.  Nothing is subtracted and no sum reaches past its frame, so a
    spike or an infinite value is gone from the results once it leaves the
    frame.  All lags share one partitioning and ordering.
    """
    if not windows:
        return df
    over = by_series(keys_of(keys))
    v = F.col(value).cast("double")
    out = df.withColumns({"_s1": v, "_q1": F.when(v.isNotNull(), F.lit(0.0)), "_l1": v, "_h1": v})
    powers = [1]
    while 2 * powers[-1] <= max(windows):
        p = powers[-1]
        out = out.withColumns({f"_{c}_": F.lag(f"_{c}{p}", p).over(over) for c in "sqlh"})
        both = _joined({c: F.col(f"_{c}{p}") for c in "sqlh"}, p, {c: F.col(f"_{c}_") for c in "sqlh"}, p)
        out = out.withColumns({f"_{c}{2 * p}": x for c, x in both.items()}).drop(*[f"_{c}_" for c in "sqlh"])
        powers.append(2 * p)
    lags, parts = {}, {}
    for w in windows:
        done, parts[w] = 0, []
        for p in reversed(powers):
            if w & p:
                for c in "sqlh":
                    lags[f"_{c}{p}_{done}"] = F.lag(f"_{c}{p}", done).over(over) if done else F.col(f"_{c}{p}")
                parts[w].append((p, done))
                done += p
    out = out.withColumns(lags)
    made = []
    for w in windows:
        (n, at), *rest = parts[w]
        whole = {c: F.col(f"_{c}{n}_{at}") for c in "sqlh"}
        for p, at in rest:
            whole, n = _joined(whole, n, {c: F.col(f"_{c}{p}_{at}") for c in "sqlh"}, p), n + p
        full = whole["s"].isNotNull()
        std = F.sqrt(whole["q"] / F.lit(float(w - 1))) if w > 1 else F.lit(None).cast("double")
        made += [
            (whole["s"] / F.lit(float(w))).alias(f"rolling_mean_{w}"),
            std.alias(f"rolling_std_{w}"),
            F.when(full, whole["l"]).alias(f"rolling_min_{w}"),
            F.when(full, whole["h"]).alias(f"rolling_max_{w}"),
            F.when(full, whole["h"] - whole["l"]).alias(f"rolling_range_{w}"),
        ]
    return out.select(*df.columns, *made)


def seasonal_columns(periods: Sequence[int], keys=None, value: str = Y, pos: str = "pos",
                     leak_safe: bool = False) -> list[Column]:
    """WN-6 / AG-18: mean of the target over rows with the same ``pos mod p``.

    Parity mode uses the whole series (it leaks future values); with
    ``leak_safe`` only earlier rows of the same phase are averaged.
    """
    ks = keys_of(keys)
    out = []
    for p in periods:
        phase = F.pmod(F.col(pos), F.lit(p))
        if leak_safe:
            w = by_series(ks + [phase]).rowsBetween(Window.unboundedPreceding, -1)
        else:
            w = whole(ks + [phase])
        m = F.avg(F.col(value)).over(w)
        out += [m.alias(f"seasonal_mean_{p}"), (F.col(value) - m).alias(f"deseasonalized_{p}")]
    return out


def add_seasonality_features(df: DataFrame, periods: Sequence[int] = DEFAULT_SEASONAL_PERIODS,
                             keys=None, value: str = Y, pos: str = "pos", leak_safe: bool = False) -> DataFrame:
    return df.select("*", *seasonal_columns(periods, keys, value, pos, leak_safe))


def diff_columns(diffs: Sequence[int], keys=None, value: str = Y) -> list[Column]:
    """WN-7: ``y - lag(y, k)``."""
    w = by_series(keys)
    return [(F.col(value) - F.lag(F.col(value), k).over(w)).alias(f"diff_{k}") for k in diffs]


def add_differencing_features(df: DataFrame, diffs: Sequence[int] = DEFAULT_DIFFS, keys=None,
                              value: str = Y) -> DataFrame:
    return df.select("*", *diff_columns(diffs, keys, value))


def add_pct_change_features(df: DataFrame, periods: Sequence[int] = DEFAULT_PCT_PERIODS, keys=None,
                            value: str = Y) -> DataFrame:
    """WN-8: forward-fill, then ``y / lag(y, k) - 1``; a zero base gives signed inf, 0/0 NULL."""
    ks = keys_of(keys)
    filled = "_y_ffill"
    df = df.withColumn(filled, F.last(F.col(value), ignorenulls=True).over(preceding(ks)))
    w = by_series(ks)
    cols = []
    for k in periods:
        base = F.lag(F.col(filled), k).over(w)
        ratio = F.when(base == 0, signed_inf_div(F.col(filled), base)).otherwise(F.col(filled) / base - 1.0)
        cols.append(ratio.alias(f"pct_change_{k}"))
    return df.select("*", *cols).drop(filled)


def fill_both_ways(df: DataFrame, columns: Sequence[str], keys=None) -> DataFrame:
    """WN-11: backward fill, then forward fill, per series.  ``inf`` is a value and stays."""
    ks = keys_of(keys)
    fol, pre = following(ks), preceding(ks)
    repl = {c: F.coalesce(F.last(F.col(c), ignorenulls=True).over(fol),
                          F.last(F.col(c), ignorenulls=True).over(pre)).alias(c) for c in columns}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def forward_fill_columns(df: DataFrame, columns: Sequence[str], keys=None) -> DataFrame:
    pre = preceding(keys_of(keys))
    repl = {c: F.last(F.col(c), ignorenulls=True).over(pre).alias(c) for c in columns}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def add_fourier_features(df: DataFrame, date_col: str = DS, yearly: int = 10, weekly: int = 3,
                         daily: int = 0) -> DataFrame:
    """DK-7: Fourier terms on the day axis; ``daily`` ones need times of day, dates have none (0 = off)."""
    cols = []
    if daily and not dict(df.dtypes)[date_col].startswith("timestamp"):
        raise ValueError(f"daily terms need timestamps, {date_col} is a {dict(df.dtypes)[date_col]}")
    if dict(df.dtypes)[date_col].startswith("timestamp"):
        from .frequency import fourier_terms
        for period, order, prefix in ((365.25, yearly, "yearly"), (7.0, weekly, "weekly"), (1.0, daily, "daily")):
            cols += fourier_terms(F.col(date_col), period, order, f"fourier_{prefix}")
        return df.select("*", *cols)
    if yearly:
        cols += fourier_columns(date_col, 365.25, yearly, "fourier_yearly")
    if weekly:
        cols += fourier_columns(date_col, 7.0, weekly, "fourier_weekly")
    return df.select("*", *cols)


def create_all_features(df: DataFrame, keys=None, date_col: str = DS, value: str = Y, pos: str = "pos",
                        lags: Sequence[int] = DEFAULT_LAGS, windows: Sequence[int] = DEFAULT_WINDOWS,
                        seasonal_periods: Sequence[int] = DEFAULT_SEASONAL_PERIODS,
                        diffs: Sequence[int] = DEFAULT_DIFFS, pct_periods: Sequence[int] = DEFAULT_PCT_PERIODS,
                        add_lags: bool = True, add_rolling: bool = True, add_holiday_flag: bool = True,
                        add_seasonality: bool = True, fourier: bool = False,
                        calendar: DataFrame | None = None, country: str = "US",
                        leak_safe: bool = False) -> DataFrame:
    """WN-12: every feature block in the reference's order, then the fill.

    The 44 default columns are 12 calendar, 4 lag, 15 rolling, 6 seasonal,
    1 holiday, 3 difference and 3 percent-change columns.  ``leak_safe``
    replaces the backward fill by a forward fill only and uses past-only
    seasonal means.
    """
    ks = keys_of(keys)
    if pos not in df.columns:
        df = df.withColumn(pos, (F.row_number().over(by_series(ks)) - 1).cast("long"))
    before = list(df.columns)
    # Window features first, on the narrow input: every Window operator
    # buffers and copies whole rows, so the calendar columns (pure functions
    # of the date, never null) are added after the windows and the fill.
    # The seasonal means come first of all, as each of them sorts the rows
    # once more; the others share one order.
    out = df
    fillable = [value]
    lag_names = roll_names = seas_names = []
    if add_seasonality:
        out = add_seasonality_features(out, seasonal_periods, ks, value, pos, leak_safe)
        seas_names = [c for p in seasonal_periods for c in (f"seasonal_mean_{p}", f"deseasonalized_{p}")]
    if add_rolling:
        out = add_rolling_stats(out, windows, ks, value)
        roll_names = [c for w in windows for c in (f"rolling_mean_{w}", f"rolling_std_{w}", f"rolling_min_{w}",
                                                   f"rolling_max_{w}", f"rolling_range_{w}")]
    if add_lags:
        out = add_lag_features(out, lags, ks, value)
        lag_names = [f"lag_{k}" for k in lags]
    out = add_differencing_features(out, diffs, ks, value)
    out = add_pct_change_features(out, pct_periods, ks, value)
    diff_names = [f"diff_{k}" for k in diffs]
    pct_names = [f"pct_change_{k}" for k in pct_periods]
    fillable += lag_names + roll_names + seas_names + diff_names + pct_names
    extra_nullable = [c for c in before if c not in ks and c not in (date_col, pos) and c not in fillable]
    if leak_safe:
        out = forward_fill_columns(out, fillable, ks)
    else:
        out = fill_both_ways(out, fillable + extra_nullable, ks)
    out = add_temporal_features(out, date_col)
    if add_holiday_flag:
        out = add_holidays(out, calendar, country, date_col)
    if fourier:
        out = add_fourier_features(out, date_col)
    order = (before + TEMPORAL_FEATURE_NAMES + lag_names + roll_names + seas_names
             + (["is_holiday"] if add_holiday_flag else []) + diff_names + pct_names)
    order += [c for c in out.columns if c not in order]
    return out.select(*order)


def feature_names(df_before: DataFrame, df_after: DataFrame) -> list[str]:
    """ST-1: names the feature pipeline added (driver-side, schema only)."""
    before = set(df_before.columns)
    return [c for c in df_after.columns if c not in before]
