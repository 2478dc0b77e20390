"""Distributed linear autoregressive forecaster (FC-1..FC-7, FC-9, IO-6).

The function class is the one the reference's logs describe: additive
linear auto-regression on ``n_lags`` past values, a piecewise-linear trend,
and weekly/yearly Fourier seasonality, one direct model per horizon.  It is
fitted by (ridge-regularised) least squares, Huber loss or the pinball loss of
a quantile; newer rows can weigh more.

Execution plan
--------------
1. ``design``: lags, trend, trend hinges and Fourier terms are Spark window
   and scalar expressions over the panel (one exchange on ``series_id``).
2. ``partial_grams``: ``mapInPandas`` turns every Arrow batch into augmented
   Gram matrices ``[X y]^T [X y]`` (upper triangle) per (series, block).
   One matrix over all ``n_lags + H - 1`` lags holds every horizon's system
   as a sub-matrix; only the few rows that some horizons can use and others
   can't (a series' head, gaps) have matrices of their own.  Blocks are
   calendar years (yearly CV) or the training split (final fit).  Rows are
   never copied per fold or horizon.
3. ``solve``: partials are shuffled by series -- some kilobytes per block --
   and one ``applyInPandas`` call per series adds them up, forms each fold's
   system as a prefix sum over blocks (expanding window), and solves the
   small p x p system of every horizon.  The group holds sufficient
   statistics only, never the series' rows, so a long or hot series costs
   more batches, not more memory in one task.
4. ``predict``: a model's coefficients of all horizons are one row; they are
   joined once on (series, fold) and the dot products are JVM-side
   ``zip_with`` + ``aggregate``.  The panel is scanned once whatever H is.

Huber and quantile fits are reweighted least squares.  Every fold has weights
of its own, so a training row carries one array with a weight for each (fold,
horizon) that it trains, and a pass is one weighted matrix per (series, fold,
horizon): folds are refitted together and no row is copied.  The pinball loss
is bounded by a parabola at the last residuals (weights 1 / (eps + |r|) and a
shifted target); each pass lowers it.  At the end the intercept moves by the
exact quantile of the residuals, its best value given all other terms.

Recency weights depend on a fold's end, which a block does not know.  A block
keeps a second matrix weighted with time (``newest_weight``: weights rise
linearly to the newest row), or one matrix decayed to its own end
(``half_life_days``); the solver combines them exactly for each fold's end.

Trend hinges sit on a fixed grid (every ``changepoint_every_days`` from the
series start, over the longest series' whole span) so the design does not
depend on the fold; per fold, only hinges inside the first
``changepoint_range`` of the training span are active.  Yearly terms are
active after ``yearly_min_days`` of training history (0: always).  Every fit
records the terms that were active.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import day_number
from ..functions.windows import DS, Y, by_series, keys_of, whole


@dataclass
class LinearARConfig:
    """FC-3: the model's parameter record (``initialize_model``)."""

    name: str = "linear_ar"
    n_lags: int = 30
    n_forecasts: int = 1
    changepoint_every_days: int = 120
    max_changepoints: int | None = None  # None: as many as the longest series' span holds
    changepoint_range: float = 0.8
    weekly_order: int = 3
    yearly_order: int = 6
    yearly_min_days: int = 730  # an explicit setting; every fit records its active terms (0: always)
    ridge: float = 1e-4
    loss: str = "ls"  # "ls", "huber" or "quantile"
    huber_delta: float = 1.345
    irls_iterations: int = 3
    trend: bool = True  # the linear trend term (hinges need it)
    quantile: float = 0.5  # of the pinball loss
    quantile_eps: float = 1e-3  # smoothing of the pinball loss, in residual scales
    newest_weight: float = 1.0  # newest row against the oldest of a fold's training rows, linear in time
    half_life_days: float | None = None  # a training row's weight halves with every so many days before the fold's end

    def __post_init__(self):
        if self.loss not in ("ls", "huber", "quantile"):
            raise ValueError(f"unknown loss {self.loss!r}")
        if (self.newest_weight != 1.0) + (self.half_life_days is not None) + (self.loss != "ls") > 1:
            raise ValueError("choose one of a robust loss, newest_weight and half_life_days")
        if self.max_changepoints and not self.trend:
            raise ValueError("trend hinges need the trend")

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    def max_lag(self) -> int:
        return self.n_forecasts + self.n_lags - 1

    def base_terms(self) -> list[str]:
        names = ["trend"] * self.trend + [f"cp_{j}" for j in range(1, (self.max_changepoints or 0) + 1)]
        names += [f"weekly_{f}{k}" for k in range(1, self.weekly_order + 1) for f in ("sin", "cos")]
        names += [f"yearly_{f}{k}" for k in range(1, self.yearly_order + 1) for f in ("sin", "cos")]
        return names

    def terms(self) -> list[str]:
        return ["intercept"] + [f"ar_{j}" for j in range(1, self.n_lags + 1)] + self.base_terms()


def resolved(cfg: LinearARConfig, panel: DataFrame, keys=None) -> LinearARConfig:
    """``cfg`` with the number of hinges that the panel's longest series needs (one aggregate, if it is open)."""
    if cfg.max_changepoints is not None:
        return cfg
    if not cfg.trend:
        return replace(cfg, max_changepoints=0)
    days = (panel.groupBy(*keys_of(keys)).agg(F.datediff(F.max(DS), F.min(DS)).alias("d")).agg(F.max("d")).first()[0]) or 0
    return replace(cfg, max_changepoints=int(cfg.changepoint_range * days // cfg.changepoint_every_days))


def _base_columns(cfg: LinearARConfig, ds: Column, start: Column) -> list[Column]:
    t_days = day_number(ds) - start
    t = t_days / 365.25
    cols = [t.alias("trend")] * cfg.trend
    for j in range(1, (cfg.max_changepoints or 0) + 1):
        c = j * cfg.changepoint_every_days / 365.25
        cols.append(F.greatest(t - F.lit(c), F.lit(0.0)).alias(f"cp_{j}"))
    absolute = day_number(ds)
    for period, order, prefix in ((7.0, cfg.weekly_order, "weekly"), (365.25, cfg.yearly_order, "yearly")):
        for k in range(1, order + 1):
            angle = F.lit(2.0 * math.pi * k / period) * absolute
            cols += [F.sin(angle).alias(f"{prefix}_sin{k}"), F.cos(angle).alias(f"{prefix}_cos{k}")]
    return cols


def base_terms_np(day: np.ndarray, start: np.ndarray, cfg: LinearARConfig) -> np.ndarray:
    """The base terms of ``_base_columns`` in numpy (same formulas; tested equal)."""
    t = (day - start) / 365.25
    cols = [t] * cfg.trend
    for j in range(1, (cfg.max_changepoints or 0) + 1):
        cols.append(np.maximum(t - j * cfg.changepoint_every_days / 365.25, 0.0))
    for period, order in ((7.0, cfg.weekly_order), (365.25, cfg.yearly_order)):
        for k in range(1, order + 1):
            angle = (2.0 * math.pi * k / period) * day
            cols += [np.sin(angle), np.cos(angle)]
    return np.column_stack(cols) if cols else np.empty((len(day), 0))


def design(panel: DataFrame, cfg: LinearARConfig, keys=None, value: str = Y,
           with_base: bool = True) -> DataFrame:
    """FC-1: lag columns ``lag_1..lag_{H+L-1}`` and the base terms for every row.

    ``_start`` (the series' first day) anchors the trend.  With
    ``with_base=False`` only lags, ``_day`` and ``_start`` are produced and
    the base terms are computed later in numpy (the fitting path), which
    keeps the Spark plan and the Arrow transfer narrow.
    """
    ks = keys_of(keys)
    w = by_series(ks)
    start = F.min(day_number(F.col(DS))).over(whole(ks))
    df = panel.withColumn("_start", start).withColumn("_day", day_number(F.col(DS)))
    lags = [F.lag(F.col(value), k).over(w).alias(f"lag_{k}") for k in range(1, cfg.max_lag() + 1)]
    out = df.select("*", *lags)
    return out.select("*", *_base_columns(cfg, F.col(DS), F.col("_start"))) if with_base else out


# --- step 2: partial Gram matrices --------------------------------------------

SHARED = 0  # the horizon number of the matrix that all horizons share


def horizon_columns(cfg: LinearARConfig, horizon: int) -> list[int]:
    """Columns of horizon ``horizon`` in the matrix of (1, all lags, base terms, y)."""
    rest = 1 + cfg.max_lag()
    return [0, *range(horizon, horizon + cfg.n_lags), *range(rest, rest + len(cfg.base_terms()) + 1)]

PARTIAL_SCHEMA = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("horizon", T.IntegerType()),
    T.StructField("block", T.IntegerType()),
    T.StructField("n_folds", T.IntegerType()),
    T.StructField("moment", T.IntegerType()),
    T.StructField("n", T.LongType()),
    T.StructField("t_max", T.DoubleType()),
    T.StructField("g", T.ArrayType(T.DoubleType())),
])


def _moments(t: np.ndarray, cfg: LinearARConfig) -> list[np.ndarray | None]:
    """The row weights of a block's matrices; None stands for 1."""
    if cfg.half_life_days is not None:
        return [0.5 ** ((t.max() - t) * 365.25 / cfg.half_life_days)]
    return [None, t] if cfg.newest_weight != 1.0 else [None]


def _grams(z: np.ndarray, t: np.ndarray, keys: pd.DataFrame, horizon: int, cfg: LinearARConfig):
    """Rows for each (series, block) of ``z``'s rows."""
    iu = np.triu_indices(z.shape[1])
    for (sid, blk, nf), idx in keys.groupby(["series_id", "block", "n_folds"], sort=False).indices.items():
        zz, tt = z[idx], t[idx]
        for moment, w in enumerate(_moments(tt, cfg)):
            g = zz.T @ zz if w is None else (zz * w[:, None]).T @ zz
            yield sid, horizon, int(blk), int(nf), moment, len(idx), float(tt.max()), g[iu]


def _weighted_grams(z: np.ndarray, t: np.ndarray, weights: pd.Series, keys: pd.DataFrame, cfg: LinearARConfig):
    """Rows for each series, fold and horizon: a row of block b trains the folds from b on, each with its own weight."""
    H, tilt = cfg.n_forecasts, 2.0 * cfg.quantile - 1.0 if cfg.loss == "quantile" else 0.0
    for (sid, blk, nf), idx in keys.groupby(["series_id", "block", "n_folds"], sort=False).indices.items():
        w = np.array([weights.iloc[i] for i in idx], dtype=float).reshape(len(idx), -1, H)
        for h in range(1, H + 1):
            own = z[idx][:, horizon_columns(cfg, h)]
            whole = ~np.isnan(own).any(axis=1)
            iu = np.triu_indices(own.shape[1])
            for j in range(w.shape[1]):
                ok = whole & ~np.isnan(w[:, j, h - 1])
                if not ok.any():
                    continue
                zz, ww = own[ok].copy(), w[ok, j, h - 1]
                if tilt:
                    zz[:, -1] += tilt / ww
                g = (zz * ww[:, None]).T @ zz
                yield sid, h, int(blk) + j, int(nf), 0, int(ok.sum()), float(t[idx][ok].max()), g[iu]


def _partials_fn(cfg: LinearARConfig, weighted: bool):
    M = cfg.max_lag()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            out = []
            day, start = pdf["_day"].to_numpy(dtype=float), pdf["_start"].to_numpy(dtype=float)
            t = (day - start) / 365.25
            lags = pdf[[f"lag_{k}" for k in range(1, M + 1)]].to_numpy(dtype=float)
            z = np.column_stack([np.ones(len(pdf)), lags, base_terms_np(day, start, cfg), pdf[Y].to_numpy(dtype=float)])
            keys = pdf[["series_id", "block", "n_folds"]]
            if weighted:
                out += _weighted_grams(z, t, pdf["_w"], keys, cfg)
            else:
                every = ~np.isnan(z).any(axis=1)
                if every.any():
                    out += _grams(z[every], t[every], keys[every], SHARED, cfg)
                for h in range(1, cfg.n_forecasts + 1):
                    own = z[:, horizon_columns(cfg, h)]
                    ok = ~np.isnan(own).any(axis=1) & ~every
                    if ok.any():
                        out += _grams(own[ok], t[ok], keys[ok], h, cfg)
            if out:
                yield pd.DataFrame(out, columns=[f.name for f in PARTIAL_SCHEMA.fields])

    return run


def partial_grams(design_df: DataFrame, cfg: LinearARConfig, weight: str | None = None) -> DataFrame:
    """Per-batch sufficient statistics.  Input needs ``series_id, block, n_folds``, ``y``, lags, ``_day``, ``_start``.

    With ``weight`` (an array per row, see ``with_weights``) ``block`` of the result is the fold.
    """
    cols = ["series_id", "block", "n_folds", Y, "_day", "_start"] + [f"lag_{k}" for k in range(1, cfg.max_lag() + 1)]
    src = design_df.select(*cols, *([F.col(weight).alias("_w")] if weight else []))
    return src.mapInPandas(_partials_fn(cfg, weight is not None), PARTIAL_SCHEMA)


# --- step 3: solve per series ---------------------------------------------------

COEF_SCHEMA = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("fold_idx", T.IntegerType()),
    T.StructField("horizon", T.IntegerType()),
    T.StructField("coef", T.ArrayType(T.DoubleType())),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("train_mse", T.DoubleType()),
    T.StructField("active", T.ArrayType(T.StringType())),
])


def _solver_fn(cfg: LinearARConfig, mode: str):
    L = cfg.n_lags
    terms = cfg.terms()
    p = len(terms)
    cp_at = np.array([j * cfg.changepoint_every_days / 365.25 for j in range(1, (cfg.max_changepoints or 0) + 1)])
    first_cp = 1 + L + cfg.trend
    first_year = first_cp + len(cp_at) + 2 * cfg.weekly_order

    def whole(triangle: np.ndarray) -> np.ndarray:
        size = int((math.sqrt(8 * len(triangle) + 1) - 1) / 2)
        full = np.zeros((size, size))
        full[np.triu_indices(size)] = triangle
        return full + np.triu(full, 1).T

    def solve_one(G: np.ndarray, n: int, t_max: float):
        if n == 0:
            return None, "failed", NO_ROWS, float("nan"), None
        xtx, xty, yty = G[:p, :p], G[:p, p], G[p, p]
        active = np.diag(xtx) > 0
        active[0] = True
        span = t_max
        for j, c in enumerate(cp_at):
            if c >= cfg.changepoint_range * span:
                active[first_cp + j] = False
        if span * 365.25 < cfg.yearly_min_days:
            active[first_year:first_year + 2 * cfg.yearly_order] = False
        a = xtx[np.ix_(active, active)]
        d = np.diag(a).copy()
        d[0] = 0.0
        a = a + np.diag(cfg.ridge * d + 1e-12)
        try:
            beta_a = np.linalg.solve(a, xty[active])
        except np.linalg.LinAlgError as e:
            return None, "failed", f"singular system: {e}", float("nan"), None
        beta = np.zeros(p)
        beta[active] = beta_a
        sse = yty - 2.0 * beta @ xty + beta @ xtx @ beta
        weight = n if cfg.newest_weight == 1.0 and cfg.half_life_days is None else xtx[0, 0]
        mse = float(max(sse, 0.0) / weight) if cfg.loss != "quantile" else float("nan")
        return beta, "success", None, mse, [t for t, on in zip(terms, active) if on]

    def decay(years: float) -> float:
        return 1.0 if cfg.half_life_days is None else 0.5 ** (years * 365.25 / cfg.half_life_days)

    def at_end(sums: list[np.ndarray], t_max: float) -> np.ndarray:
        """The matrix for a fold that ends at ``t_max``."""
        if cfg.newest_weight == 1.0:
            return sums[0]
        return (sums[0] + (cfg.newest_weight - 1.0) * (sums[1] / t_max if t_max > 0 else 0.0)) / cfg.newest_weight

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sid, n_folds = pdf["series_id"].iloc[0], int(pdf["n_folds"].max())
        parts: dict[tuple[int, int], tuple] = {}
        for (h, blk), grp in pdf.groupby(["horizon", "block"]):
            end = float(grp["t_max"].max())
            sums = [whole(sum(decay(end - t) * np.asarray(g) for g, t in zip(m["g"], m["t_max"])))
                    for _, m in grp.groupby("moment")]
            parts[int(h), int(blk)] = (sums, int(grp.loc[grp["moment"] == 0, "n"].sum()), end)
        rows = []
        folds = [0] if mode == "single" else range(n_folds)
        for h in range(1, cfg.n_forecasts + 1):
            cols = np.ix_(horizon_columns(cfg, h), horizon_columns(cfg, h))
            sums, n, t_max, at = [], 0, 0.0, sorted(parts, key=lambda x: x[1])
            for k in folds:
                if mode == "fold":
                    sums, n, t_max = [], 0, 0.0
                while at and at[0][1] <= k:
                    own = at.pop(0)
                    if own[0] not in (SHARED, h):
                        continue
                    part, rows_in, end = parts[own]
                    part = [g[cols] if own[0] == SHARED else g for g in part]
                    last, t_max = t_max, max(t_max, end)
                    sums = [decay(t_max - last) * s + decay(t_max - end) * g for s, g in zip(sums, part)] if sums else \
                        [decay(t_max - end) * g for g in part]
                    n += rows_in
                beta, status, err, mse, active = solve_one(at_end(sums, t_max) if n else None, n, t_max)
                rows.append((sid, k, h, None if beta is None else beta.tolist(), status, err, n, mse, active))
        return pd.DataFrame(rows, columns=[f.name for f in COEF_SCHEMA.fields])

    return run


NO_ROWS = "no training rows"


def solve(partials: DataFrame, cfg: LinearARConfig, mode: str = "expanding", models: DataFrame | None = None) -> DataFrame:
    """Coefficients per (series, fold, horizon).  ``mode``: ``expanding`` (fold k = blocks <= k), ``fold`` (fold k = block k) or ``single``.

    ``models`` (series_id, fold_idx) lists the models that must have a row: one
    without any training row is ``failed``.
    """
    fitted = partials.groupBy("series_id").applyInPandas(_solver_fn(cfg, mode), COEF_SCHEMA)
    if models is None:
        return fitted
    every = models.select("series_id", F.col("fold_idx").cast("int").alias("fold_idx"),
                          F.explode(F.sequence(F.lit(1), F.lit(cfg.n_forecasts))).alias("horizon"))
    missing = F.col("status").isNull()
    return (every.join(fitted, ["series_id", "fold_idx", "horizon"], "left")
            .withColumn("error", F.when(missing, NO_ROWS).otherwise(F.col("error")))
            .withColumn("n_rows", F.coalesce("n_rows", F.lit(0)).cast("long"))
            .withColumn("status", F.coalesce("status", F.lit("failed")))
            .select(*[f.name for f in COEF_SCHEMA.fields]))


# --- step 4: predict --------------------------------------------------------------

def dot(x: Column, coef: Column) -> Column:
    return F.aggregate(F.zip_with(x, coef, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def _horizon_models(coefs: DataFrame, cfg: LinearARConfig) -> DataFrame:
    """(series_id, fold_idx, _models): an array with the coefficients of horizons 1..H, missing where the fit failed."""
    own = F.map_from_entries(F.collect_list(F.when(F.col("status") == "success", F.struct("horizon", "coef"))))
    horizons = F.sequence(F.lit(1), F.lit(cfg.n_forecasts))
    return (coefs.groupBy("series_id", "fold_idx").agg(own.alias("_own"))
            .select("series_id", "fold_idx", F.transform(horizons, lambda h: F.col("_own")[h]).alias("_models"), F.size("_own").alias("_n")))


def _with_terms(rows: DataFrame, cfg: LinearARConfig) -> DataFrame:
    lags = F.array(*[F.col(f"lag_{k}") for k in range(1, cfg.max_lag() + 1)]).cast("array<double>")
    base = F.array(*[F.col(c) for c in cfg.base_terms()]).cast("array<double>")
    return rows.withColumn("_lags", lags).withColumn("_base", base)


def _forecasts(models: Column, cfg: LinearARConfig) -> Column:
    """One dot product per horizon: horizon h reads ``n_lags`` lags from lag h on."""
    return F.transform(models, lambda coef, i: dot(
        F.concat(F.array(F.lit(1.0)), F.slice("_lags", i + 1, F.lit(cfg.n_lags)), F.col("_base")), coef))


def with_yhats(design_rows: DataFrame, coefs: DataFrame, cfg: LinearARConfig) -> DataFrame:
    """The rows with ``yhats``, the forecasts of horizons 1..H (missing where the fit failed).

    A model is one array of H coefficient arrays, put together on the few rows
    of ``coefs``, so a row costs H dot products.
    """
    models = _horizon_models(coefs, cfg).where(F.col("_n") > 0).drop("_n")
    rows = _with_terms(design_rows, cfg).join(models, ["series_id", "fold_idx"])
    return rows.withColumn("yhats", _forecasts(F.col("_models"), cfg)).drop("_lags", "_base", "_models")


def predict_rows(design_rows: DataFrame, coefs: DataFrame, cfg: LinearARConfig, extra: Sequence[str] = ()) -> DataFrame:
    """FC-4/FC-5: ``yhat`` for each row and horizon.

    ``design_rows`` carries ``series_id, fold_idx, ds, y`` and the design columns.
    """
    have = {r: F.col(r) for r in ("series_id", "fold_idx", DS, Y, *extra)}
    fitted = with_yhats(design_rows, coefs, cfg)
    # outer: the arrays are never empty, and a plain explode would first filter by them, at the cost of all forecasts again
    return (fitted.select(*have.values(), F.posexplode_outer("yhats").alias("_h", "yhat"))
            .select("series_id", "fold_idx", DS, (F.col("_h") + 1).alias("horizon"), Y, *extra, "yhat"))


def with_fits(train: DataFrame, coefs: DataFrame, cfg: LinearARConfig) -> DataFrame:
    """Training rows with ``_fits``: their forecasts by every model that they train, flat: horizons of fold ``block``, of the next ..."""
    by_fold = _horizon_models(coefs, cfg).groupBy("series_id").agg(
        F.array_sort(F.collect_list(F.struct("fold_idx", "_models"))).alias("_folds"))
    rows = _with_terms(train, cfg).join(by_fold, "series_id")
    own = F.slice("_folds", F.col("block") + 1, F.greatest(F.size("_folds") - F.col("block"), F.lit(0)))
    fits = F.flatten(F.transform(own, lambda f: _forecasts(f["_models"], cfg)))
    return rows.withColumn("_fits", fits).drop("_lags", "_base", "_folds")


def _residuals(fitted: DataFrame, cfg: LinearARConfig) -> DataFrame:
    """(series_id, fold_idx, horizon, r) of every training row and model."""
    one = fitted.select("series_id", "block", Y, F.posexplode_outer("_fits").alias("_i", "_f"))
    return one.select("series_id", (F.col("block") + F.floor(F.col("_i") / cfg.n_forecasts)).cast("int").alias("fold_idx"),
                      (F.col("_i") % cfg.n_forecasts + 1).alias("horizon"), (F.col(Y) - F.col("_f")).alias("r"))


def with_weights(train: DataFrame, coefs: DataFrame, cfg: LinearARConfig) -> DataFrame:
    """``train`` with ``_w``, the weights of the next pass by model (as ``_fits``).

    Huber: ``min(1, delta * s / |r|)``; pinball: ``1 / (eps * s + |r|)``.  ``s``
    is a robust residual scale per (series, fold, horizon).
    """
    fitted = with_fits(train, coefs, cfg)
    scale = _residuals(fitted, cfg).groupBy("series_id", "fold_idx", "horizon").agg((F.median(F.abs("r")) / 0.6745).alias("_s"))
    at = (F.col("fold_idx") * cfg.n_forecasts + F.col("horizon") - 1).alias("_at")
    per = (scale.groupBy("series_id").agg(F.array_sort(F.collect_list(F.struct(at, "_s"))).alias("_scales")))
    fitted = fitted.join(per, "series_id")

    def weight(f: Column, s: Column) -> Column:
        r, limit = F.abs(F.col(Y) - f), F.lit(cfg.huber_delta) * s["_s"]
        w = (F.lit(1.0) / (F.greatest(F.lit(cfg.quantile_eps) * s["_s"], F.lit(1e-12)) + r) if cfg.loss == "quantile" else
             F.when((limit > 0) & (r > limit), limit / r).otherwise(F.lit(1.0)))
        return F.when(f.isNull() | F.col(Y).isNull(), F.lit(None).cast("double")).otherwise(w)

    own = F.slice("_scales", F.col("block") * cfg.n_forecasts + 1, F.greatest(F.size("_fits"), F.lit(0)))
    return fitted.withColumn("_w", F.zip_with("_fits", own, weight)).drop("_fits", "_scales")


def with_best_intercepts(train: DataFrame, coefs: DataFrame, cfg: LinearARConfig) -> DataFrame:
    """Quantile models with the intercept moved by the exact quantile of their training residuals."""
    moved = (_residuals(with_fits(train, coefs, cfg), cfg).groupBy("series_id", "fold_idx", "horizon")
             .agg(F.percentile("r", F.lit(cfg.quantile)).alias("_by")))
    new = F.transform("coef", lambda c, i: F.when(i == 0, c + F.coalesce("_by", F.lit(0.0))).otherwise(c))
    return coefs.join(moved, ["series_id", "fold_idx", "horizon"], "left").withColumn("coef", new).drop("_by")


def refit(train: DataFrame, coefs: DataFrame, cfg: LinearARConfig, models: DataFrame, keep) -> DataFrame:
    """The reweighting passes of a robust loss from the least-squares fit on; ``keep`` writes a pass's coefficients.

    ``train`` has ``block`` (the first fold that a row trains), the lags and base terms.
    """
    for _ in range(cfg.irls_iterations):
        coefs = keep(solve(partial_grams(with_weights(train, coefs, cfg), cfg, weight="_w"), cfg, "fold", models))
    return keep(with_best_intercepts(train, coefs, cfg)) if cfg.loss == "quantile" else coefs


COEF_TABLE_COLUMNS = ["model", "series_id", "fold_idx", "horizon", "terms", "coef", "status", "error",
                      "n_rows", "train_mse", "active"]


def coefficient_table(coefs: DataFrame, cfg: LinearARConfig) -> DataFrame:
    """FC-2 output with the model name and term names (the IO-6 model artefact)."""
    terms = F.array(*[F.lit(t) for t in cfg.terms()])
    return coefs.select(F.lit(cfg.name).alias("model"), "series_id", "fold_idx", "horizon",
                        terms.alias("terms"), "coef", "status", "error", "n_rows", "train_mse", "active")
