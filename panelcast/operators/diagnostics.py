"""Plot-data tables and residual diagnostics (PL-1..PL-11, SL-5, ST-2, DK-9..DK-11).

The reference renders matplotlib figures; here each figure becomes the
table it would draw, keyed by the same group columns as the metrics.  The
only Python step is the inverse normal CDF of the Q-Q table, a vectorised
pandas UDF over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import DS, Y, by_series, whole
from .evaluate import YHAT, valid_pairs
from .quantiles import exact_quantiles, with_groups
from .ranges import TIE, in_ranges, plain, rank


def actual_vs_predicted(pred: DataFrame, group: Sequence[str], y: str = Y, yhat: str = YHAT) -> DataFrame:
    """PL-2: ``(idx, ds, actual, predicted)`` per group."""
    g = list(group)
    return pred.select(*g, (F.row_number().over(by_series(g)) - 1).alias("idx"), DS,
                       F.col(y).alias("actual"), F.col(yhat).alias("predicted"))


def residuals(pred: DataFrame, group: Sequence[str], y: str = Y, yhat: str = YHAT) -> DataFrame:
    """PL-3: residual ``actual - predicted`` by index over the valid pairs."""
    g = list(group)
    v = valid_pairs(pred, y, yhat)
    return v.select(*g, (F.row_number().over(by_series(g)) - 1).alias("idx"), DS,
                    (F.col(y) - F.col(yhat)).alias("residual"))


def histogram(df: DataFrame, value: str, group: Sequence[str], bins: int = 30) -> DataFrame:
    """PL-4: ``bins`` equal-width bins from min to max per group, the last bin closed.

    A constant group gets the range ``[v - 0.5, v + 0.5]`` like numpy.
    Empty bins are listed with count 0.  Everything is aggregate-sized
    (groups x bins); no values are collected.
    """
    g = list(group)
    vals = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    stats = vals.groupBy(*g).agg(F.min(value).alias("_mn"), F.max(value).alias("_mx"))
    stats = stats.select(
        *g,
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("lo"),
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    binned = (vals.join(stats, g, "inner")
              .select(*g, F.least(F.floor((F.col(value) - F.col("lo")) / width), F.lit(bins - 1))
                      .cast("int").alias("bin")))
    counts = binned.groupBy(*g, "bin").agg(F.count(F.lit(1)).alias("count"))
    spine = stats.select(*g, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (spine.join(counts, g + ["bin"], "left")
            .select(*g, "bin",
                    (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def residual_histogram(pred: DataFrame, group: Sequence[str], bins: int = 30) -> DataFrame:
    return histogram(residuals(pred, group), "residual", group, bins)


# Acklam's rational approximation of the normal quantile
# (relative error below 1.2e-9): numerator and denominator of the centre, then of the tails.
QUANTILE_CENTRE = ([-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.357751867269, -30.66479806614716, 2.506628277459239],
                   [-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0])
QUANTILE_TAIL = ([-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783],
                 [0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0])
QUANTILE_SPLIT = 0.02425


def normal_quantile(p: Column) -> Column:
    """The standard normal's quantile; missing outside (0, 1)."""
    def poly(x: Column, c: list[float]) -> Column:
        out = F.lit(c[0])
        for v in c[1:]:
            out = out * x + F.lit(v)
        return out

    def tail(q: Column) -> Column:
        r = F.sqrt(F.lit(-2.0) * F.log(q))
        return poly(r, QUANTILE_TAIL[0]) / poly(r, QUANTILE_TAIL[1])

    x = p - 0.5
    centre = x * poly(x * x, QUANTILE_CENTRE[0]) / poly(x * x, QUANTILE_CENTRE[1])
    return (F.when((p <= 0) | (p >= 1), F.lit(None).cast("double")).when(p < QUANTILE_SPLIT, tail(p))
            .when(p > 1 - QUANTILE_SPLIT, -tail(1.0 - p)).otherwise(centre))


def qq_table(pred: DataFrame, group: Sequence[str], y: str = Y, yhat: str = YHAT) -> DataFrame:
    """PL-5: ordered residuals against normal quantiles (Filliben plotting positions).

    Ranks come from range partitions, so a group may have any number of residuals.
    """
    g = list(group)
    r = valid_pairs(pred, y, yhat).select(*g, (F.col(y) - F.col(yhat)).alias("residual"))
    ranked = plain(rank(in_ranges(r, g, ["residual"]), ["residual", TIE], "i", "n")).withColumn("i", (F.col("i") + 1).cast("int"))
    last = F.pow(F.lit(0.5), 1.0 / F.col("n"))
    m = (F.when(F.col("i") == F.col("n"), last)
         .when(F.col("i") == 1, 1.0 - last)
         .otherwise((F.col("i") - 0.3175) / (F.col("n") + 0.365)))
    return ranked.select(*g, "i", "residual", m.alias("plotting_position")) \
        .withColumn("theoretical", normal_quantile(F.col("plotting_position")))


def qq_fit(qq: DataFrame, group: Sequence[str]) -> DataFrame:
    """PL-5 fit line: slope, intercept and correlation of residual on theoretical quantile."""
    return qq.groupBy(*group).agg(
        F.regr_slope("residual", "theoretical").alias("slope"),
        F.regr_intercept("residual", "theoretical").alias("intercept"),
        F.corr("residual", "theoretical").alias("r"))


def scatter_table(pred: DataFrame, group: Sequence[str], y: str = Y, yhat: str = YHAT) -> DataFrame:
    """PL-6: (actual, predicted) points plus the identity line's min/max of the actuals."""
    g = list(group)
    w = whole(g)
    v = valid_pairs(pred, y, yhat)
    return v.select(*g, DS, F.col(y).alias("actual"), F.col(yhat).alias("predicted"),
                    F.min(y).over(w).alias("line_min"), F.max(y).over(w).alias("line_max"))


def cv_scores(fold_metrics: DataFrame, group: Sequence[str], metric: str = "mape") -> DataFrame:
    """PL-8: per fold label ``Fold i``, score, mean, mean +- population std, strict above-mean flag."""
    g = list(group)
    ok = fold_metrics.where(F.col("status") == "success")
    w = whole(g)
    mean = F.avg(metric).over(w)
    std = F.stddev_pop(metric).over(w)
    return ok.select(*g, "fold_idx", F.concat(F.lit("Fold "), (F.col("fold_idx") + 1).cast("string")).alias("label"),
                     F.col(metric).alias("score"), mean.alias("mean"),
                     (mean + std).alias("upper"), (mean - std).alias("lower"),
                     (F.col(metric) > mean).alias("above_mean"))


def error_distribution(pred: DataFrame, group: Sequence[str], bins: int = 30, y: str = Y,
                       yhat: str = YHAT) -> DataFrame:
    """PL-9: histograms of |e| and of e/actual*100 (zero actuals excluded and counted)."""
    g = list(group)
    v = valid_pairs(pred, y, yhat).select(
        *g, F.abs(F.col(y) - F.col(yhat)).alias("abs_error"),
        (F.try_divide(F.col(y) - F.col(yhat), F.col(y)) * 100.0).alias("pct_error"))
    means = v.groupBy(*g).agg(F.avg("abs_error").alias("mean_abs_error"), F.avg("pct_error").alias("mean_pct_error"),
                              F.count_if(F.col("pct_error").isNull()).alias("n_zero_actual"))
    h1 = histogram(v, "abs_error", g, bins).withColumn("kind", F.lit("abs_error"))
    h2 = histogram(v, "pct_error", g, bins).withColumn("kind", F.lit("pct_error"))
    return h1.unionByName(h2).join(means, g, "left")


def overlay(history: DataFrame, forecast: DataFrame, keys: Sequence[str], y: str = Y,
            yhat: str = YHAT) -> DataFrame:
    """ST-2 / PL-1: history and forecast rows on one axis, with a ``kind`` column."""
    k = list(keys)
    h = history.select(*k, DS, F.lit("history").alias("kind"), F.col(y).alias("value"),
                       F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"))
    fc_cols = forecast.columns
    f = forecast.select(*k, DS, F.lit("forecast").alias("kind"), F.col(yhat).alias("value"),
                        (F.col("lower") if "lower" in fc_cols else F.lit(None).cast("double")).alias("lower"),
                        (F.col("upper") if "upper" in fc_cols else F.lit(None).cast("double")).alias("upper"))
    return h.unionByName(f)


def tail_slices(forecast: DataFrame, keys: Sequence[str], periods: Sequence[int] = (30, 180, 365)) -> DataFrame:
    """SL-5 / PL-10: the last p rows of each series' forecast, for each p (all rows if fewer)."""
    k = list(keys)
    rd = F.row_number().over(by_series(k, F.col(DS).desc()))
    ranked = forecast.withColumn("_rd", rd)
    per = ranked.withColumn("period", F.explode(F.array(*[F.lit(int(p)) for p in periods])))
    return per.where(F.col("_rd") <= F.col("period")).drop("_rd")


def prediction_intervals(cv_pred: DataFrame, forecast: DataFrame, keys: Sequence[str], level: float = 0.95,
                         y: str = Y, yhat: str = YHAT, large: bool = False) -> DataFrame:
    """DK-9: empirical residual quantiles of the CV predictions added to the forecast.

    ``large``: for groups with more residuals than a task should hold; the same quantiles by ranks.
    """
    k = list(keys)
    a = (1.0 - level) / 2.0
    if large:
        q = exact_quantiles(valid_pairs(cv_pred, y, yhat), k, F.col(y) - F.col(yhat), [a, 1.0 - a]).drop("n")
        return (with_groups(forecast, q, k).withColumn("lower", F.col(yhat) + F.col("q")[0])
                .withColumn("upper", F.col(yhat) + F.col("q")[1]).drop("q"))
    q = valid_pairs(cv_pred, y, yhat).groupBy(*k).agg(
        F.percentile(F.col(y) - F.col(yhat), F.lit(a)).alias("_qlo"),
        F.percentile(F.col(y) - F.col(yhat), F.lit(1.0 - a)).alias("_qhi"))
    return (forecast.join(q, k, "left")
            .withColumn("lower", F.col(yhat) + F.col("_qlo"))
            .withColumn("upper", F.col(yhat) + F.col("_qhi")).drop("_qlo", "_qhi"))


def residual_acf(pred: DataFrame, group: Sequence[str], max_lag: int = 10, y: str = Y,
                 yhat: str = YHAT) -> DataFrame:
    """DK-10: residual autocorrelation by lag and the cumulative Ljung-Box statistic."""
    g = list(group)
    r = residuals(pred, group, y, yhat)
    mean = F.avg("residual").over(whole(g))
    c = r.withColumn("_c", F.col("residual") - mean)
    w = by_series(g)
    c = c.select(*g, "_c", *[F.lag("_c", k).over(w).alias(f"_l{k}") for k in range(1, max_lag + 1)])
    sums = c.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_c") * F.col("_c")).alias("_den"),
                             *[F.sum(F.col("_c") * F.col(f"_l{k}")).alias(f"_num{k}") for k in range(1, max_lag + 1)])
    long = sums.select(*g, "n", "_den", F.explode(F.array(*[
        F.struct(F.lit(k).alias("lag"), F.col(f"_num{k}").alias("num")) for k in range(1, max_lag + 1)])).alias("_e"))
    acf = long.select(*g, "n", F.col("_e.lag").alias("lag"), F.try_divide(F.col("_e.num"), F.col("_den")).alias("acf"))
    term = F.col("acf") * F.col("acf") / (F.col("n") - F.col("lag"))
    q = F.col("n") * (F.col("n") + 2) * F.sum(term).over(by_series(g, "lag").rowsBetween(Window.unboundedPreceding, 0))
    return acf.select(*g, "lag", "n", "acf", q.alias("ljung_box"))


def dickey_fuller(panel: DataFrame, keys: Sequence[str], y: str = Y) -> DataFrame:
    """DK-11: Dickey-Fuller regression dy_t = a + rho * y_{t-1}; t statistic of rho."""
    k = list(keys)
    lagged = panel.withColumn("_yl", F.lag(y).over(by_series(k))).withColumn("_dy", F.col(y) - F.col("_yl"))
    agg = lagged.groupBy(*k).agg(
        F.regr_count("_dy", "_yl").alias("n"),
        F.regr_slope("_dy", "_yl").alias("rho"),
        F.regr_intercept("_dy", "_yl").alias("intercept"),
        F.regr_sxx("_dy", "_yl").alias("_sxx"),
        F.regr_syy("_dy", "_yl").alias("_syy"),
        F.regr_sxy("_dy", "_yl").alias("_sxy"))
    ssr = F.col("_syy") - F.try_divide(F.col("_sxy") * F.col("_sxy"), F.col("_sxx"))
    se = F.sqrt(F.try_divide(F.try_divide(ssr, F.col("n") - 2), F.col("_sxx")))
    return agg.select(*k, "n", "rho", "intercept", F.try_divide(F.col("rho"), se).alias("t_stat"))


def plot_tables(pred: DataFrame, group: Sequence[str], bins: int = 30) -> dict[str, DataFrame]:
    """PL-11: every table ``generate_visualizations`` would draw, keyed alike (lazy plans)."""
    g = list(group)
    return {
        "actual_vs_predicted": actual_vs_predicted(pred, g),
        "residuals": residuals(pred, g),
        "residual_histogram": residual_histogram(pred, g, bins),
        "qq": qq_table(pred, g),
        "scatter": scatter_table(pred, g),
        "error_distribution": error_distribution(pred, g, bins),
    }
