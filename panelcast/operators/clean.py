"""Panel cleaning and scaling operators (CL-1..CL-16, DK-6).

Every operator is a ``DataFrame -> DataFrame`` plan over the panel
``(series_id, ds, y, ...)``; windows are partitioned by the series keys so
Spark shuffles the panel once on ``series_id`` and runs each series' window
in one task.  Operators that come one after another reuse that partitioning
(Catalyst sees the same ``partitionBy``), so a whole cleaning chain costs
one exchange plus sorts.

Row position semantics follow the reference: ``pos`` is the 0-based
position after sorting by date and *before* dropping duplicate dates or
missing targets (so it can have gaps), while interpolation and the
chronological split count rows of the current frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import nan_to_null
from ..functions.windows import DS, Y, by_series, following, keys_of, preceding, whole


def coerce_dates(df: DataFrame, col: str = DS, fmt: str | None = None) -> DataFrame:
    """CL-1: parse text dates; values that are already dates pass through.

    Under ANSI mode (the Spark 4 default) unparsable text raises, as in
    the reference.
    """
    dtype = dict(df.dtypes)[col]
    if dtype == "date":
        return df
    if dtype.startswith("timestamp"):
        return df.withColumn(col, F.to_date(F.col(col)))
    return df.withColumn(col, F.to_date(F.col(col), fmt) if fmt else F.to_date(F.col(col)))


def sort_and_position(raw: DataFrame, tie: str, keys=None, partitions: int | None = None) -> DataFrame:
    """CL-2: 0-based ``pos`` of every raw row after a sort by date (missing dates last), ties by ``tie``.

    Never gathers a series or a date in one task (zipWithIndex-style):

    1. range-partition on (series, date, tie): the sampled range bounds
       split even a single hot (series, day) across many partitions;
    2. count rows per (partition, series) -- a small table -- and turn the
       counts into per-partition offsets with a running sum per series;
    3. inside each partition the local rank is a window over (partition,
       series), which needs no further shuffle of the rows than by
       partition; ``pos`` = offset + local rank.

    The range-partitioned rows are checkpointed once, as range bounds are
    sampled anew on every evaluation.  A missing key is a series of its own.
    """
    ks = keys_of(keys)
    n = partitions or int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dkey = F.coalesce(F.col(DS), F.lit("9999-12-31").cast("date"))
    from ..session import cut_lineage
    parts = cut_lineage(raw.withColumn("_dk", dkey)
                        .repartitionByRange(n, *[F.col(k) for k in ks], F.col("_dk"), F.col(tie))
                        .withColumn("_pid", F.spark_partition_id()))
    here = Window.partitionBy("_pid", *ks).orderBy("_dk", tie)
    ranked = parts.withColumn("_local", F.row_number().over(here) - 1)
    counts = parts.groupBy("_pid", *ks).agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        F.col("_pid").alias("_opid"), *[F.col(k).alias(f"_o{k}") for k in ks],
        F.coalesce(F.sum("_cnt").over(by_series(ks, "_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    same = F.col("_pid") == F.col("_opid")
    for k in ks:
        same = same & F.col(k).eqNullSafe(F.col(f"_o{k}"))
    return (ranked.join(offsets, same)
            .select(*raw.columns, (F.col("_off") + F.col("_local")).cast("long").alias("pos")))


def duplicate_count(raw: DataFrame, keys=None) -> DataFrame:
    """CL-3: rows after the first per date, per series (missing dates count as one value)."""
    ks = keys_of(keys)
    return raw.groupBy(*ks).agg(
        (F.count(F.lit(1)) - F.count_distinct(DS)
         - F.max(F.col(DS).isNull().cast("int"))).cast("long").alias("n_duplicates"))


def dedup_keep_first(raw: DataFrame, tie: str, keys=None, value: str = Y) -> DataFrame:
    """CL-4 (+CL-2): one row per (series, date), the first by ``tie``; ``pos`` keeps gaps.

    Built from aggregates only: ``min_by`` picks the kept row (partially
    aggregated before the shuffle, so a hot date is no problem) and the
    kept row's ``pos`` is the number of raw rows on earlier dates.
    """
    ks = keys_of(keys)
    daily = raw.groupBy(*ks, DS).agg(
        F.min_by(F.struct(value), F.col(tie))[value].alias(value),
        F.count(F.lit(1)).alias("_n"))
    w = by_series(ks, [F.col(DS).asc_nulls_last()])
    return daily.select(
        *ks, DS, value,
        F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long").alias("pos"))


def add_position(panel: DataFrame, keys=None, name: str = "pos") -> DataFrame:
    """0-based row position per series, ordered by date."""
    return panel.withColumn(name, (F.row_number().over(by_series(keys)) - 1).cast("long"))


def densify(panel: DataFrame, keys=None, flag: str | None = "is_gap") -> DataFrame:
    """CL-16: add a NULL-target row for every missing day inside each series' span.

    No spine table and no join: each row expands to itself plus the days
    up to (not including) the next row's date, found with ``lead``.  The
    result keeps the ``series_id`` hash partitioning of the window, so the
    next window over the series needs a sort but no new shuffle.
    """
    ks = keys_of(keys)
    nxt = F.lead(DS).over(by_series(ks))
    # a repeated date stands for itself only
    last_day = F.when(nxt > F.col(DS), F.date_sub(nxt, 1)).otherwise(F.col(DS))
    expanded = (panel.withColumn("_last", last_day)
                .select("*", F.posexplode_outer(F.sequence(F.col(DS), F.col("_last"))).alias("_k", "_d")))
    others = [c for c in panel.columns if c not in ks and c != DS]  # noqa: E501
    out = expanded.select(
        *ks,
        F.coalesce(F.col("_d"), F.col(DS)).alias(DS),
        *[F.when(F.coalesce(F.col("_k"), F.lit(0)) == 0, F.col(c)).alias(c) for c in others],
        *([(F.coalesce(F.col("_k"), F.lit(0)) > 0).alias(flag)] if flag else []),
    )
    return out


def missing_days(panel: DataFrame, keys=None) -> DataFrame:
    """CL-16: the days absent inside each series' first..last span."""
    ks = keys_of(keys)
    return densify(panel.select(*ks, DS), ks, flag="is_gap").where("is_gap").select(*ks, DS)


def missing_count(panel: DataFrame, keys=None, value: str = Y) -> DataFrame:
    """CL-5: missing targets per series."""
    return panel.groupBy(*keys_of(keys)).agg(F.count_if(F.col(value).isNull()).alias("n_missing"))


def interpolate_linear(panel: DataFrame, keys=None, value: str = Y) -> DataFrame:
    """CL-6: linear in row position; leading gaps stay missing, trailing gaps take the last value."""
    ks = keys_of(keys)
    rn = "_rn"
    df = panel.withColumn(rn, F.row_number().over(by_series(ks)))
    v = F.col(value)
    prev_v = F.last(v, ignorenulls=True).over(preceding(ks))
    prev_i = F.last(F.when(v.isNotNull(), F.col(rn)), ignorenulls=True).over(preceding(ks))
    next_v = F.last(v, ignorenulls=True).over(following(ks))
    next_i = F.last(F.when(v.isNotNull(), F.col(rn)), ignorenulls=True).over(following(ks))
    filled = (
        F.when(v.isNotNull(), v)
        .when(prev_v.isNull(), F.lit(None).cast("double"))
        .when(next_v.isNull(), prev_v)
        .otherwise(prev_v + (next_v - prev_v) * ((F.col(rn) - prev_i) / (next_i - prev_i)))
    )
    return df.withColumn(value, filled).drop(rn)


def forward_fill(panel: DataFrame, keys=None, value: str = Y) -> DataFrame:
    """CL-7: carry the last value forward; leading gaps stay."""
    return panel.withColumn(value, F.last(F.col(value), ignorenulls=True).over(preceding(keys)))


def drop_missing(panel: DataFrame, value: str = Y) -> DataFrame:
    """CL-8: drop rows with a missing target (``pos`` keeps its gaps)."""
    return panel.where(F.col(value).isNotNull())


def handle_missing(panel: DataFrame, method: str = "interpolate", keys=None, value: str = Y) -> DataFrame:
    """CL-9: dispatch on the method name; an unknown method leaves the data unchanged."""
    if method == "interpolate":
        return interpolate_linear(panel, keys, value)
    if method == "forward_fill":
        return forward_fill(panel, keys, value)
    if method == "drop":
        return drop_missing(panel, value)
    import warnings
    warnings.warn(f"unknown missing-value method {method!r}; data left unchanged")
    return panel


def flag_outliers(panel: DataFrame, threshold: float = 3.0, enabled: bool = True, keys=None,
                  value: str = Y, name: str = "is_outlier") -> DataFrame:
    """CL-10: ``|y - mean| / sample_std > threshold`` per series; missing y or zero std -> False."""
    if not enabled:
        return panel.withColumn(name, F.lit(False))
    w = whole(keys)
    z = F.abs(F.try_divide(F.col(value) - F.avg(value).over(w), F.stddev_samp(value).over(w)))
    return panel.withColumn(name, F.coalesce(z > F.lit(float(threshold)), F.lit(False)))


def outlier_count(flagged: DataFrame, keys=None, name: str = "is_outlier") -> DataFrame:
    """CL-11."""
    return flagged.groupBy(*keys_of(keys)).agg(F.count_if(F.col(name)).alias("n_outliers"))


def fit_minmax(panel: DataFrame, keys=None, value: str = Y) -> DataFrame:
    """CL-12 fit: the scaler table ``(series_id, y_min, y_max)``; missing values ignored."""
    return panel.groupBy(*keys_of(keys)).agg(F.min(value).alias("y_min"), F.max(value).alias("y_max"))


def _scaled(value, lo, hi):
    rng = F.col(hi) - F.col(lo)
    return F.when(rng == 0, F.when(F.col(value).isNotNull(), F.lit(0.0))).otherwise(
        (F.col(value) - F.col(lo)) / rng)


def minmax_scale(panel: DataFrame, keys=None, value: str = Y, out: str | None = None,
                 enabled: bool = True, fit_on: Column | None = None) -> DataFrame:
    """CL-12 fit + transform on the same panel, via whole-series window min/max.

    ``fit_on`` names the rows that the range is taken from (say, the train
    rows of a split); other rows may then leave [0, 1].

    No scaler join is needed: the series window shares the panel's
    partitioning.  A constant series maps to 0.
    """
    out = out or value
    if not enabled:
        return panel if out == value else panel.withColumn(out, F.col(value))
    w = whole(keys)
    fitted = F.col(value) if fit_on is None else F.when(fit_on, F.col(value))
    return (panel.withColumn("_lo", F.min(fitted).over(w)).withColumn("_hi", F.max(fitted).over(w))
            .withColumn(out, _scaled(value, "_lo", "_hi")).drop("_lo", "_hi"))


def apply_minmax(panel: DataFrame, scaler: DataFrame, keys=None, value: str = Y,
                 out: str | None = None) -> DataFrame:
    """CL-13: apply a stored (frozen) scaler; values may leave [0, 1].

    Works on static or streaming input.  The scaler has one row per series;
    the join is left to AQE, which broadcasts it at run time when it is
    small and shuffles otherwise.
    """
    ks = keys_of(keys)
    out = out or value
    j = panel.join(scaler.select(*ks, "y_min", "y_max"), ks, "left")
    missing = F.col("y_min").isNull() & F.col(value).isNotNull()
    return (j.withColumn(out, F.when(missing, F.raise_error(F.lit("scaler not fitted for series")))
                         .otherwise(_scaled(value, "y_min", "y_max")))
            .drop("y_min", "y_max"))


def inverse_minmax(panel: DataFrame, scaler: DataFrame | None, keys=None, value: str = Y,
                   out: str | None = None) -> DataFrame:
    """CL-14: ``y * (max - min) + min``; identity without a scaler."""
    out = out or value
    if scaler is None:
        return panel if out == value else panel.withColumn(out, F.col(value))
    ks = keys_of(keys)
    j = panel.join(scaler.select(*ks, "y_min", "y_max"), ks, "left")
    return j.withColumn(out, F.col(value) * (F.col("y_max") - F.col("y_min")) + F.col("y_min")).drop("y_min", "y_max")


def log_transform(panel: DataFrame, value: str = Y, out: str | None = None) -> DataFrame:
    """DK-6: ``ln(1 + y)``."""
    return panel.withColumn(out or value, F.log1p(F.col(value)))


def inverse_log_transform(panel: DataFrame, value: str = Y, out: str | None = None) -> DataFrame:
    """DK-6 inverse: ``exp(y) - 1``."""
    return panel.withColumn(out or value, F.expm1(F.col(value)))


def preprocess_complete(panel: DataFrame, keys=None, missing: str = "interpolate",
                        outliers: bool = True, outlier_threshold: float = 3.0,
                        normalize: bool = True, fill_calendar: bool = True,
                        log: bool = False, tie: str | None = None, fit_on: Column | None = None,
                        partitions: int | None = None) -> DataFrame:
    """CL-15: validate (dates, order, duplicates), missing values, outlier flags, scaling.

    Output: the keys, ``ds``, ``pos``, ``y_raw`` (the target before scaling),
    ``is_outlier`` and the scaled ``y``.  Of several rows of a day the first
    by ``tie`` stays; without a tie column, the one with the least target,
    missing last.  ``fit_on`` limits the rows that fit the scale.  Days are aggregated before any window, so a series is at
    most one row per day from there on.  ``fill_calendar`` first adds the
    missing days (the reference expects a gap-free daily series).
    ``partitions`` deals the series over so many tasks: for panels of many
    series, whose rows with the missing days Spark can't tell beforehand
    (``windows.partitions_for``).
    """
    ks = keys_of(keys)
    p = coerce_dates(panel.withColumn(Y, nan_to_null(Y)))
    if partitions:
        p = p.repartition(partitions, *ks)
    order = F.col(tie) if tie else F.coalesce(F.col(Y), F.lit(float("inf")))
    p = p.groupBy(*ks, DS).agg(F.min_by(F.struct(Y), order)[Y].alias(Y)).where(F.col(DS).isNotNull())
    if fill_calendar:
        p = densify(p, ks, flag=None)
    p = add_position(p, ks)
    p = handle_missing(p, missing, ks)
    if log:
        p = log_transform(p)
    p = p.withColumn("y_raw", F.col(Y))
    p = flag_outliers(p, outlier_threshold, outliers, ks)
    p = minmax_scale(p, ks, enabled=normalize, fit_on=fit_on)
    return p
