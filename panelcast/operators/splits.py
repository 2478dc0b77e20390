"""Chronological splits and rolling-origin folds (SL-1..SL-3, JN-3, PF-4, AG-19, AG-20, DK-1..DK-4).

Folds are labels, not copies: the fold dimension is derived per series from
its distinct years, and a row's fold memberships come from its own year
rank, expanded with ``explode(sequence(...))``.  No theta join and no
cross join is planned; every window shares the ``series_id`` partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import DS, by_series, keys_of, whole

DEFAULT_MAX_FOLDS: int | None = None  # every fold; a cap is an explicit argument


def split_temporal(panel: DataFrame, train_ratio: float = 0.7, val_ratio: float = 0.15,
                   keys=None, name: str = "split") -> DataFrame:
    """SL-1: first ``int(n*train)`` rows train, next ``int(n*val)`` val, rest test."""
    ks = keys_of(keys)
    n = F.count(F.lit(1)).over(whole(ks))
    rn = F.row_number().over(by_series(ks)) - 1
    n_train = F.floor(n * F.lit(float(train_ratio)))
    n_val = F.floor(n * F.lit(float(val_ratio)))
    label = F.when(rn < n_train, "train").when(rn < n_train + n_val, "val").otherwise("test")
    return panel.withColumn(name, label)


def split_sizes(split_panel: DataFrame, keys=None, name: str = "split") -> DataFrame:
    """AG-20: rows per split label."""
    return split_panel.groupBy(*keys_of(keys), name).agg(F.count(F.lit(1)).alias("n_rows"))


def year_filter(panel: DataFrame, years: Sequence[int], date_col: str = DS) -> DataFrame:
    """PF-4: rows whose calendar year is in ``years``."""
    return panel.where(F.year(date_col).isin([int(y) for y in years]))


def yearly_train_test_split(panel: DataFrame, train_years: Sequence[int], test_years: Sequence[int],
                            date_col: str = DS) -> tuple[DataFrame, DataFrame]:
    """PF-4 as in the reference's helper: any train and test year lists."""
    return year_filter(panel, train_years, date_col), year_filter(panel, test_years, date_col)


def distinct_years(panel: DataFrame, keys=None, date_col: str = DS) -> DataFrame:
    """AG-19: sorted distinct years per series, with their 0-based rank."""
    ks = keys_of(keys)
    yrs = panel.select(*ks, F.year(date_col).alias("year")).distinct()
    return yrs.withColumn("year_rank", (F.row_number().over(by_series(ks, "year")) - 1))


def yearly_folds(panel: DataFrame, keys=None, date_col: str = DS,
                 max_folds: int | None = DEFAULT_MAX_FOLDS) -> DataFrame:
    """SL-2/SL-3: fold dimension ``(series, fold_idx, train_years, test_year)``.

    Fold i (0-based) trains on the first i+1 years and tests on year i+1,
    for i < min(max_folds, n_years - 1).  A series with one year has no fold.
    """
    ks = keys_of(keys)
    yrs = distinct_years(panel, ks, date_col)
    earlier = by_series(ks, "year").rowsBetween(Window.unboundedPreceding, -1)
    folds = yrs.select(
        *ks,
        (F.col("year_rank") - 1).alias("fold_idx"),
        F.collect_list("year").over(earlier).alias("train_years"),
        F.col("year").alias("test_year"),
    ).where(F.col("fold_idx") >= 0)
    if max_folds is not None:
        folds = folds.where(F.col("fold_idx") < max_folds)
    return folds


def with_year_rank(panel: DataFrame, keys=None, date_col: str = DS,
                   max_folds: int | None = DEFAULT_MAX_FOLDS) -> DataFrame:
    """Adds ``year_rank`` (0-based dense rank of the row's year) and ``n_folds`` per series."""
    ks = keys_of(keys)
    yr = F.year(date_col)
    ranked = panel.withColumn("year_rank", F.dense_rank().over(by_series(ks, yr)) - 1)
    n_years = F.max("year_rank").over(whole(ks)) + 1
    n_folds = F.greatest(n_years - 1, F.lit(0))
    if max_folds is not None:
        n_folds = F.least(n_folds, F.lit(int(max_folds)))
    return ranked.withColumn("n_folds", n_folds.cast("int"))


def expand_yearly_folds(panel: DataFrame, keys=None, date_col: str = DS,
                        max_folds: int | None = DEFAULT_MAX_FOLDS, roles: str = "both") -> DataFrame:
    """JN-3: every row once per fold it belongs to, with ``role`` train/test.

    A row of year rank r is the test row of fold r-1 and a train row of
    folds r..n_folds-1.  ``roles='test'`` keeps only test rows (each row in
    at most one fold, so no blow-up); ``'train'`` only train rows.
    """
    ranked = with_year_rank(panel, keys, date_col, max_folds)
    r = F.col("year_rank")
    lo = F.greatest(r - 1, F.lit(0))
    hi = F.col("n_folds") - 1
    if roles == "test":
        hi = F.least(hi, r - 1)
    idx = F.when(lo <= hi, F.sequence(lo, hi))
    out = ranked.withColumn("fold_idx", F.explode(idx))
    out = out.withColumn("role", F.when(F.col("fold_idx") == r - 1, "test").otherwise("train"))
    if roles == "train":
        out = out.where(F.col("role") == "train")
    elif roles == "test":
        out = out.where(F.col("role") == "test")
    return out.drop("n_folds")


def fold_sizes(expanded: DataFrame, keys=None) -> DataFrame:
    """AG-20 for folds: rows per (series, fold, role)."""
    return expanded.groupBy(*keys_of(keys), "fold_idx", "role").agg(F.count(F.lit(1)).alias("n_rows"))


def rolling_origin_rows(panel: DataFrame, keys=None, initial_train_size: int = 365, test_size: int = 30,
                        step_size: int = 30, max_folds: int | None = None, gap_size: int = 0,
                        expanding: bool = True, roles: str = "both") -> DataFrame:
    """DK-1..DK-4: row-count folds.

    Fold k has origin ``o = initial + k*step``; test rows are positions
    ``[o+gap, o+gap+test)``, train rows ``[0 or o-initial, o)``.  Only folds
    with a full test window exist.  Rows are expanded with ``explode`` over
    the folds they belong to, computed arithmetically from the position.
    ``roles='test'`` expands test rows only: each into test_size / step_size
    folds, however long the series.  Train rows belong to a number of folds
    that grows with the series, so fit from sums per block rather than from
    copies, and see ``rolling_origin_bounds`` for sizes.
    """
    ks = keys_of(keys)
    rn = (F.row_number().over(by_series(ks)) - 1).cast("long")
    n = F.count(F.lit(1)).over(whole(ks))
    df = panel.withColumn("rn", rn).withColumn("_n", n)
    span = F.col("_n") - F.lit(initial_train_size + gap_size + test_size)
    k_count = F.when(span >= 0, F.floor(span / F.lit(step_size)) + 1).otherwise(F.lit(0))
    if max_folds is not None:
        k_count = F.least(k_count, F.lit(int(max_folds)))
    df = df.withColumn("_K", k_count.cast("long"))
    x = F.col("rn")
    s = F.lit(step_size)
    # test: o_k + gap <= rn < o_k + gap + test
    t_lo = F.greatest(F.ceil((x - F.lit(gap_size + test_size - 1 + initial_train_size)) / s), F.lit(0))
    t_hi = F.least(F.floor((x - F.lit(gap_size + initial_train_size)) / s), F.col("_K") - 1)
    # train: lo_k <= rn < o_k
    r_lo = F.greatest(F.floor((x - F.lit(initial_train_size)) / s) + 1, F.lit(0))
    r_hi = F.col("_K") - 1
    if not expanding:
        r_hi = F.least(r_hi, F.floor(x / s))
    test_ids = F.when(t_lo <= t_hi, F.sequence(t_lo.cast("long"), t_hi.cast("long")))
    train_ids = F.when(r_lo <= r_hi, F.sequence(r_lo.cast("long"), r_hi.cast("long")))
    if roles == "test":
        train_ids = F.lit(None).cast("array<bigint>")
    members = F.concat(
        F.coalesce(F.transform(test_ids, lambda k: F.struct(k.alias("fold_idx"), F.lit("test").alias("role"))),
                   F.array().cast("array<struct<fold_idx:bigint,role:string>>")),
        F.coalesce(F.transform(train_ids, lambda k: F.struct(k.alias("fold_idx"), F.lit("train").alias("role"))),
                   F.array().cast("array<struct<fold_idx:bigint,role:string>>")),
    )
    return (df.withColumn("_m", F.explode(members))
            .select(*[c for c in panel.columns], "rn", F.col("_m.fold_idx").cast("int").alias("fold_idx"),
                    F.col("_m.role").alias("role")))


def rolling_origin_bounds(panel: DataFrame, keys=None, initial_train_size: int = 365, test_size: int = 30,
                          step_size: int = 30, max_folds: int | None = None, gap_size: int = 0,
                          expanding: bool = True) -> DataFrame:
    """Rows, first and last position and date of every fold and role, by arithmetic: no row is copied per fold."""
    ks = keys_of(keys)
    at = panel.select(*ks, DS, (F.row_number().over(by_series(ks)) - 1).cast("long").alias("rn"))
    n = at.groupBy(*ks).agg(F.count(F.lit(1)).alias("_n"))
    span = F.col("_n") - F.lit(initial_train_size + gap_size + test_size)
    count = F.when(span >= 0, F.floor(span / F.lit(step_size)) + 1).otherwise(F.lit(0))
    if max_folds is not None:
        count = F.least(count, F.lit(int(max_folds)))
    folds = n.withColumn("_k", count.cast("long")).where(F.col("_k") > 0).select(
        *ks, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1)).alias("_f"))
    origin = F.lit(initial_train_size) + F.col("_f") * step_size
    train_from = F.lit(0).cast("long") if expanding else origin - initial_train_size
    role = lambda name, a, b: F.struct(F.lit(name).alias("role"), a.cast("long").alias("first_rn"), b.cast("long").alias("last_rn"))
    bounds = folds.select(*ks, F.col("_f").cast("int").alias("fold_idx"), F.explode(F.array(
        role("train", train_from, origin - 1), role("test", origin + gap_size, origin + gap_size + test_size - 1))).alias("_b"))
    bounds = bounds.select(*ks, "fold_idx", "_b.*").withColumn("n_rows", F.col("last_rn") - F.col("first_rn") + 1)
    for side in ("first", "last"):
        named = at.select(*ks, F.col(DS).alias(f"{side}_ds"), F.col("rn").alias(f"{side}_rn"))
        bounds = bounds.join(named, [*ks, f"{side}_rn"])
    return bounds
