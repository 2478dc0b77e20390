"""Composed plans: the reference's cross-validation and pipeline steps, keyed by series.

The reference loops over folds and fits one after another; here every fold
of every series is one DataFrame keyed by ``(series_id, fold_idx)`` and the
whole cross-validation is a single Spark job graph.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Sequence
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.windows import keys_of
from ..operators import evaluate as E
from ..operators.naive import fold_test_predictions
from ..operators.splits import DEFAULT_MAX_FOLDS, yearly_folds


def cv_seasonal_naive(panel: DataFrame, season: int = 7, keys=None, context: str = "with_history",
                      max_folds: int | None = DEFAULT_MAX_FOLDS, value: str = "y",
                      checkpoint_input: bool = True, partitions: int | None = None) -> DataFrame:
    """FC-8 with the seasonal-naive model: per (series, fold) metrics and status.

    A series with a single year has no fold and yields one ``failed`` row
    with ``fold_idx`` NULL.  The narrow input is checkpointed first (reliable
    checkpoint folder): the fold dimension, the predictions and the no-fold
    check all read it, so the upstream cleaning plan runs once instead of
    three times (measured 15 s -> 10 s at sf0.1).  ``partitions`` deals the
    series over so many tasks for the predictions (``windows.partitions_for``).
    """
    ks = keys_of(keys)
    if checkpoint_input:
        from ..session import cut_lineage
        panel = cut_lineage(panel.select(*ks, "ds", value))
    folds = yearly_folds(panel, ks, max_folds=max_folds).select(*ks, "fold_idx", "test_year")
    dealt = panel.repartition(partitions, *ks) if partitions else panel
    pred = fold_test_predictions(dealt, season, ks, value, context, max_folds)
    scored = E.score_folds(pred, folds, ks + ["fold_idx"])
    return scored.unionByName(without_folds(panel, folds, ks), allowMissingColumns=True)


ONE_YEAR = "the series spans a single year, which makes no fold"


def without_folds(panel: DataFrame, folds: DataFrame, ks: Sequence[str]) -> DataFrame:
    """One ``failed`` row for every series that has no fold."""
    return (panel.select(*ks).distinct()
            .join(folds.select(*ks).distinct(), list(ks), "left_anti")
            .select(*ks, F.lit(None).cast("int").alias("fold_idx"), F.lit(None).cast("int").alias("test_year"),
                    F.lit(0).cast("long").alias("n"), F.lit("failed").alias("status"), F.lit(ONE_YEAR).alias("error")))


# --- linear forecaster plans (FC-5..FC-12) -----------------------------------

from ..operators import forecast as FC  # noqa: E402
from ..operators.splits import split_temporal, with_year_rank  # noqa: E402
from ..functions.windows import DS, Y, by_series  # noqa: E402
from ..session import cut_lineage  # noqa: E402

MODEL_KEYS = ["series_id", "fold_idx"]


def _test_only_lags(rows: DataFrame, cfg: FC.LinearARConfig) -> DataFrame:
    """Q13 parity: lags recomputed inside each fold's test rows (history unseen)."""
    w = by_series(MODEL_KEYS)
    return rows.select(*[c for c in rows.columns if not c.startswith("lag_")],
                       *[F.lag(F.col(Y), k).over(w).alias(f"lag_{k}") for k in range(1, cfg.max_lag() + 1)])


def cv_linear(panel: DataFrame, cfg: FC.LinearARConfig | None = None,
              max_folds: int | None = DEFAULT_MAX_FOLDS, context: str = "with_history",
              checkpoint_input: bool = True):
    """FC-7/FC-8 with the linear model: all folds of all series in one job graph.

    Returns ``(fold_metrics, predictions, coefficient_table)``.  Fold k's
    model is fitted on years ranked <= k from a prefix sum of per-year
    partial Gram matrices and scored on year k+1, each horizon on its own.
    A series without a fold has one ``failed`` metrics row.  The narrow input
    panel is checkpointed to the reliable checkpoint folder first: the
    training and scoring branches both read it, and a lost executor replays
    from there.  A robust loss starts from that fit and is refined for all
    folds together (``forecast.refit``); a pass's coefficients are written
    before the next one.
    """
    cfg = cfg or FC.LinearARConfig()
    if checkpoint_input:
        panel = cut_lineage(panel.select("series_id", DS, Y))
    cfg = FC.resolved(cfg, panel)
    d = with_year_rank(FC.design(panel.select("series_id", DS, Y), cfg, with_base=False), max_folds=max_folds)
    train = d.where(F.col("year_rank") < F.col("n_folds")).withColumn("block", F.col("year_rank"))
    folds = yearly_folds(panel, max_folds=max_folds).select("series_id", "fold_idx", "test_year")
    # a few kilobytes per model, read by the predictions, the status and the table
    coefs = cut_lineage(FC.solve(FC.partial_grams(train, cfg), cfg, "expanding", folds))
    base = FC._base_columns(cfg, F.col(DS), F.col("_start"))
    d = d.select("*", *base)
    if cfg.loss != "ls":
        coefs = FC.refit(train.select("*", *base), coefs, cfg, folds, cut_lineage)
    test = (d.where((F.col("year_rank") >= 1) & (F.col("year_rank") <= F.col("n_folds")))
            .withColumn("fold_idx", (F.col("year_rank") - 1).cast("int")))
    if context == "test_only":
        test = _test_only_lags(test, cfg)
    pred = FC.predict_rows(test, coefs, cfg)
    metrics = _scored(pred, folds, coefs, cfg).unionByName(without_folds(panel, folds, ["series_id"]), allowMissingColumns=True)
    model = F.lit(cfg.name)
    return metrics.withColumn("model", model), pred.withColumn("model", model), FC.coefficient_table(coefs, cfg)


def _scored(pred: DataFrame, models: DataFrame, coefs: DataFrame, cfg: FC.LinearARConfig) -> DataFrame:
    """Metrics of every model and horizon; a failed fit keeps its own error."""
    keys = MODEL_KEYS + ["horizon"]
    every = models.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(cfg.n_forecasts))))
    fit = coefs.select(*keys, F.col("status").alias("_fs"), F.col("error").alias("_fe"))
    failed = F.col("_fs") == "failed"
    return (E.score_folds(pred, every, keys).join(fit, keys, "left")
            .withColumn("status", F.when(failed, "failed").otherwise(F.col("status")))
            .withColumn("error", F.when(failed, F.col("_fe")).otherwise(F.col("error")))
            .drop("_fs", "_fe"))


def final_fit(panel: DataFrame, cfg: FC.LinearARConfig | None = None, train_ratio: float = 0.7,
              val_ratio: float = 0.15, checkpoint_input: bool = True):
    """FC-9: fit on the chronological train split, score on the test split, per series and horizon.

    A robust loss is refined by reweighting passes (``forecast.refit``); a
    pass's coefficients are written before the next one, so the plan doesn't
    grow with the passes.  Every series has a row for every horizon,
    ``failed`` if it could not be fitted or scored.
    """
    cfg = cfg or FC.LinearARConfig()
    if checkpoint_input:
        panel = cut_lineage(panel.select("series_id", DS, Y))
    cfg = FC.resolved(cfg, panel)
    models = panel.select("series_id").distinct().withColumn("fold_idx", F.lit(0))
    d = FC.design(split_temporal(panel.select("series_id", DS, Y), train_ratio, val_ratio), cfg)
    d = d.withColumn("fold_idx", F.lit(0)).withColumn("n_folds", F.lit(1)).withColumn("block", F.lit(0))
    train = d.where(F.col("split") == "train")
    coefs = cut_lineage(FC.solve(FC.partial_grams(train, cfg), cfg, "single", models))
    if cfg.loss != "ls":
        coefs = FC.refit(train, coefs, cfg, models, cut_lineage)
    test = d.where(F.col("split") == "test")
    pred = FC.predict_rows(test, coefs, cfg)
    metrics = _scored(pred, models, coefs, cfg).drop("fold_idx").withColumn("model", F.lit(cfg.name))
    return metrics, pred.withColumn("model", F.lit(cfg.name)), FC.coefficient_table(coefs, cfg)


def quantile_column(q: float) -> str:
    return f"q{100 * q:g}".replace(".", "_")


def cv_quantiles(panel: DataFrame, cfg: FC.LinearARConfig, quantiles: Sequence[float] = (0.1, 0.5, 0.9),
                 max_folds: int | None = DEFAULT_MAX_FOLDS) -> DataFrame:
    """FC-2, DK-9: a model per quantile, all folds and horizons; one row per forecast with a column per quantile.

    The columns never cross: a row's forecasts are put in order, which does
    not raise any of their losses.  A row has a forecast for every quantile or
    for none.
    """
    panel = cut_lineage(panel.select("series_id", DS, Y))
    stacked = None
    for q in sorted(quantiles):
        _, pred, _ = cv_linear(panel, replace(cfg, loss="quantile", quantile=q), max_folds, checkpoint_input=False)
        stacked = pred if stacked is None else stacked.unionByName(pred)
    rows = stacked.groupBy("series_id", "fold_idx", DS, "horizon").agg(
        F.first(Y).alias(Y), F.array_sort(F.collect_list("yhat")).alias("_q"))
    whole = F.size("_q") == len(quantiles)
    return rows.select("series_id", "fold_idx", DS, "horizon", Y, *[
        F.when(whole, F.col("_q")[i]).alias(quantile_column(q)) for i, q in enumerate(sorted(quantiles))])


def coverage(bounds: DataFrame, quantiles: Sequence[float], group: Sequence[str]) -> DataFrame:
    """Share of actual values at or below each quantile forecast, per group and quantile."""
    known = bounds.where(F.col(Y).isNotNull())
    each = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("quantile"), F.col(quantile_column(q)).alias("bound")) for q in sorted(quantiles)]))
    return (known.select(*group, Y, each.alias("_e")).where(F.col("_e.bound").isNotNull())
            .groupBy(*group, F.col("_e.quantile").alias("quantile"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg((F.col(Y) <= F.col("_e.bound")).cast("double")).alias("covered")))


def wide_forecast(pred: DataFrame, n_forecasts: int) -> DataFrame:
    """FC-5 wide form: ``yhat1..yhatH`` columns by pivot on horizon (values listed, no extra job)."""
    return (pred.groupBy("series_id", "fold_idx", DS).pivot("horizon", list(range(1, n_forecasts + 1)))
            .agg(F.first("yhat")).select("series_id", "fold_idx", DS,
                                         *[F.col(str(h)).alias(f"yhat{h}") for h in range(1, n_forecasts + 1)]))


FUTURE_SCHEMA = "series_id string, ds date, step int, yhat double, status string, error string"


def _future_fn(cfg: FC.LinearARConfig):
    L, H = cfg.n_lags, cfg.n_forecasts
    base = cfg.base_terms()

    columns = ["series_id", "ds", "step", "yhat", "status", "error"]

    def failed(key, error: str) -> pd.DataFrame:
        return pd.DataFrame([(key[0], None, None, None, "failed", error)], columns=columns)

    def run(key, tail: pd.DataFrame, future: pd.DataFrame, coefs: pd.DataFrame) -> pd.DataFrame:
        if coefs.empty:
            return failed(key, "no fitted model")
        hist = list(tail.sort_values(DS)[Y].astype(float))[-L:]
        if len(hist) < L or any(np.isnan(hist)):
            return failed(key, f"the last {L} values are not all present")
        fut = future.sort_values(DS).reset_index(drop=True)
        by_h = {int(r.horizon): np.asarray(r.coef, dtype=float) for r in coefs.itertuples()}
        gaps = [h for h in range(1, min(H, len(fut)) + 1) if h not in by_h]
        if gaps:  # blocks of H days are fed back whole
            return failed(key, f"no fitted model for horizon {gaps[0]}")
        out = []
        i = 0
        while i < len(fut):
            recent = hist[::-1][:L]
            block = []
            for h in range(1, H + 1):
                if i + h - 1 >= len(fut):
                    break
                row = fut.iloc[i + h - 1]
                x = np.concatenate([[1.0], recent, row[base].to_numpy(dtype=float)])
                block.append(float(x @ by_h[h]))
            for j, v in enumerate(block):
                out.append((key[0], fut.iloc[i + j][DS], i + j + 1, v, "success", None))
            hist.extend(block)
            i += len(block)
        return pd.DataFrame(out, columns=columns)

    return run


def future_forecast(panel: DataFrame, coef_table: DataFrame, cfg: FC.LinearARConfig, periods: int = 365,
                    fold_idx: int = 0) -> DataFrame:
    """FC-6: forecast ``periods`` days past each series' last date.

    Direct models cover horizons 1..H; beyond that, blocks of H are fed
    back recursively.  Each group holds one series' last ``n_lags`` values,
    its future calendar rows (``periods``) and its H coefficient rows: all
    bounded by the configuration, never by the data volume.  A series that
    cannot be forecast, for want of values or of the model of any horizon, has
    one ``failed`` row that says so.  ``coef_table`` fixes the number of hinges.
    """
    parts, cfg = _future_parts(panel, coef_table, cfg, periods, fold_idx)
    return _cogroup(parts, _future_fn(cfg), FUTURE_SCHEMA)


def _future_parts(panel: DataFrame, coef_table: DataFrame, cfg: FC.LinearARConfig, periods: int, fold_idx: int):
    """Each series' last values, future calendar and models, and the settings with the table's number of hinges."""
    hinges = coef_table.select("terms").first()
    cfg = replace(cfg, max_changepoints=sum(t.startswith("cp_") for t in hinges[0]) if hinges else 0)
    p = panel.select("series_id", DS, Y)
    rd = F.row_number().over(by_series(["series_id"], F.col(DS).desc()))
    tail = p.withColumn("_rd", rd).where(F.col("_rd") <= cfg.n_lags).drop("_rd")
    span = p.groupBy("series_id").agg(F.min(DS).alias("_first"), F.max(DS).alias("_last"))
    fut = span.select("series_id", "_first",
                      F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", periods))).alias(DS))
    fut = fut.select("series_id", DS, *FC._base_columns(cfg, F.col(DS), FC.day_number(F.col("_first"))))
    coefs = coef_table.where((F.col("fold_idx") == fold_idx) & (F.col("status") == "success")).select(
        "series_id", "horizon", "coef")
    return {"tail": tail, "future": fut, "coef": coefs}, cfg


def _paths_fn(cfg: FC.LinearARConfig, paths: int, seed: int, quantiles: Sequence[float]):
    L, H = cfg.n_lags, cfg.n_forecasts
    base = cfg.base_terms()
    columns = ["series_id", "ds", "step", "mean", *map(quantile_column, quantiles), "status", "error"]

    def failed(key, error: str) -> pd.DataFrame:
        return pd.DataFrame([(key[0], None, None, None, *[None] * len(quantiles), "failed", error)], columns=columns)

    def run(key, tail: pd.DataFrame, future: pd.DataFrame, coefs: pd.DataFrame, residuals: pd.DataFrame) -> pd.DataFrame:
        last = tail.sort_values(DS)[Y].astype(float).to_numpy()[::-1][:L]
        if len(last) < L or np.isnan(last).any():
            return failed(key, f"the last {L} values are not all present")
        by_h = {int(r.horizon): np.asarray(r.coef, dtype=float) for r in coefs.itertuples()}
        gaps = [h for h in range(1, H + 1) if h not in by_h]
        if gaps:
            return failed(key, f"no fitted model for horizon {gaps[0]}")
        if residuals.empty:
            return failed(key, "no residuals of all horizons")
        beta = np.stack([by_h[h] for h in range(1, H + 1)], axis=1)  # terms x horizons
        blocks = np.stack(residuals.sort_values("origin")["block"].to_numpy()).astype(float)
        blocks = blocks - blocks.mean(axis=0)
        rng = np.random.default_rng([seed, zlib.crc32(str(key[0]).encode())])
        fut = future.sort_values(DS)
        terms = fut[base].to_numpy(dtype=float).reshape(len(fut), len(base))
        recent, out = np.tile(last, (paths, 1)), []
        for at in range(0, len(fut), H):
            own = np.einsum("hb,bh->h", terms[at:at + H], beta[1 + L:, :len(terms[at:at + H])])
            step = beta[0, :len(own)] + own + recent @ beta[1:1 + L, :len(own)]
            step = step + blocks[rng.integers(0, len(blocks), paths)][:, :len(own)]
            out.append(step)
            recent = np.concatenate([step[:, ::-1], recent], axis=1)[:, :L]
        made = np.concatenate(out, axis=1)
        rows = pd.DataFrame({"series_id": key[0], "ds": fut[DS].to_numpy(), "step": np.arange(1, len(fut) + 1), "mean": made.mean(axis=0)})
        for q, values in zip(quantiles, np.quantile(made, quantiles, axis=0)):
            rows[quantile_column(q)] = values
        return rows.assign(status="success", error=None)[columns]

    return run


def forecast_paths(panel: DataFrame, coef_table: DataFrame, pred: DataFrame, cfg: FC.LinearARConfig, periods: int = 365,
                   paths: int = 500, quantiles: Sequence[float] = (0.025, 0.5, 0.975), seed: int = 0, fold_idx: int = 0) -> DataFrame:
    """FC-6, DK-9: quantiles of future paths, with the errors of blocks that are fed back.

    A path goes on from a series' last values in blocks of H days; each block
    adds the errors that one day's forecasts of horizons 1..H had in ``pred``
    (drawn anew, all horizons together, centred), and the next block's lags
    hold the path's own values.  All paths of a series are one matrix.  The
    draws depend on ``seed`` and the series' name only.  A group holds one
    series' last values, future calendar, models and one block of errors per
    scored day; a series that has not all of them has a ``failed`` row.
    """
    if cfg.n_lags < 1:
        raise ValueError("paths are fed back through lags")
    parts, cfg = _future_parts(panel, coef_table, cfg, periods, fold_idx)
    error = (pred.where(F.col(Y).isNotNull() & F.col("yhat").isNotNull())
             .select("series_id", F.date_sub(DS, F.col("horizon").cast("int")).alias("origin"), "horizon", (F.col(Y) - F.col("yhat")).alias("r")))
    listed = F.array_sort(F.collect_list(F.struct("horizon", "r")))
    blocks = (error.groupBy("series_id", "origin").agg(listed.alias("b")).where(F.size("b") == cfg.n_forecasts)
              .select("series_id", "origin", F.transform("b", lambda x: x["r"]).alias("block")))
    schema = "series_id string, ds date, step int, mean double, " + ", ".join(f"{quantile_column(q)} double" for q in quantiles) + ", status string, error string"
    return _cogroup(parts | {"residuals": blocks}, _paths_fn(cfg, paths, seed, quantiles), schema)


def _cogroup(parts: dict[str, DataFrame], fn, schema: str) -> DataFrame:
    """Bundle the per-series inputs into one tagged frame and run ``fn`` per series, with a frame for each tag."""
    cols = sorted(set().union(*(df.columns for df in parts.values())) - {"series_id"})
    tags, typed = list(parts), {}
    for df in parts.values():
        for f in df.schema.fields:
            typed.setdefault(f.name, f.dataType)
    allrows = None
    for tag, df in parts.items():
        t = df.select("series_id", F.lit(tag).alias("_tag"),
                      *[(F.col(c) if c in df.columns else F.lit(None).cast(typed[c])).alias(c)
                        for c in cols if c != "series_id"])
        allrows = t if allrows is None else allrows.unionByName(t)

    def run(key, pdf):  # no annotations: applyInPandas takes the (key, frame) form
        return fn(key, *[pdf[pdf["_tag"] == tag] for tag in tags])

    return allrows.groupBy("series_id").applyInPandas(run, schema)


def train_all(panel: DataFrame, configs: Sequence[FC.LinearARConfig], max_folds: int | None = DEFAULT_MAX_FOLDS):
    """FC-10: cross-validate several model settings on the same panel; results keyed by ``model``."""
    metrics = preds = coefs = None
    panel = cut_lineage(panel.select("series_id", DS, Y))
    for cfg in configs:
        m, p, c = cv_linear(panel, cfg, max_folds, checkpoint_input=False)
        metrics = m if metrics is None else metrics.unionByName(m)
        preds = p if preds is None else preds.unionByName(p)
        coefs = c if coefs is None else coefs.unionByName(c)
    return metrics, preds, coefs


def ensemble_predict(preds: DataFrame, n_models: int, method: str = "mean", weights: DataFrame | None = None):
    """FC-11: combine member predictions per (series, fold, ds, horizon); members stay rows."""
    from ..operators.ensemble import ensemble
    return ensemble(preds, ["series_id", "fold_idx", DS, "horizon"], method, n_models=n_models, weights=weights)


def run_settings(cfg: FC.LinearARConfig, **sections) -> dict:
    """IO-8: the settings of a run in six sections: model, data, cv, features, evaluation, visualization."""
    from ..functions.metrics import ALL_METRICS
    from ..operators.features import DEFAULT_LAGS, DEFAULT_WINDOWS
    out = {"model": json.loads(cfg.to_json()), "data": {}, "cv": {},
           "features": {"lag_values": list(DEFAULT_LAGS), "rolling_windows": list(DEFAULT_WINDOWS)},
           "evaluation": {"metrics": list(ALL_METRICS)}, "visualization": {}}
    for name, values in sections.items():
        out[name] = out[name] | values
    return out


def settings_table(spark, configs: Sequence[FC.LinearARConfig]) -> DataFrame:
    """UD-4: one row per model setting: model, settings (JSON)."""
    return spark.createDataFrame([(c.name, c.to_json()) for c in configs], "model string, settings string")


def configs_of(settings: DataFrame) -> list[FC.LinearARConfig]:
    """The settings of a ``settings_table`` (a handful of rows) as records."""
    return [FC.LinearARConfig(**json.loads(r.settings)) for r in settings.select("settings").collect()]


def execute_pipeline(panel: DataFrame, out_dir: str, cfg: FC.LinearARConfig | None = None,
                     missing: str = "interpolate", normalize: bool = True,
                     max_folds: int | None = DEFAULT_MAX_FOLDS) -> dict:
    """FC-12: clean, features, split, CV, final fit; every product written under ``out_dir``.

    A failure in any step is data, not an exception: the run record gets
    ``status='failed'`` and the message, and is appended to ``runs`` either
    way (the reference saves partial results after a failure too).
    """
    from ..operators.clean import preprocess_complete
    from ..operators.diagnostics import plot_tables
    from ..operators.features import create_all_features
    from ..sources.files import append_run, run_record, save_coefficients

    cfg = cfg or FC.LinearARConfig()
    spark = panel.sparkSession
    written: dict[str, str] = {}
    status, error = "success", None
    try:
        clean = preprocess_complete(panel, missing=missing, normalize=normalize)
        clean.write.mode("overwrite").parquet(f"{out_dir}/cleaned")
        written["cleaned"] = f"{out_dir}/cleaned"
        # later steps read the written table: lineage is cut at a reliable copy
        clean = spark.read.parquet(f"{out_dir}/cleaned")
        create_all_features(clean.select("series_id", DS, Y, "pos")).write.mode("overwrite").parquet(
            f"{out_dir}/features")
        written["features"] = f"{out_dir}/features"
        model_in = clean.select("series_id", DS, Y)

        def keep(name: str, df: DataFrame) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{out_dir}/{name}")
            written[name] = f"{out_dir}/{name}"
            return spark.read.parquet(f"{out_dir}/{name}")

        keep("split", split_temporal(model_in))
        # the written table is the reliable copy: nothing is checkpointed again
        cv_metrics, cv_pred, _ = cv_linear(model_in, cfg, max_folds, checkpoint_input=False)
        cv_metrics = keep("cv_metrics", cv_metrics)
        cv_pred = keep("cv_predictions", cv_pred)
        keep("cv_summary", E.cv_summary(cv_metrics, ["model", "series_id"]))
        final_metrics, final_pred, final_coefs = final_fit(model_in, cfg, checkpoint_input=False)
        saved = save_coefficients(final_coefs, f"{out_dir}/coefficients")
        if not saved:
            raise RuntimeError("the coefficients could not be written")
        written["coefficients"] = f"{out_dir}/coefficients"
        keep("final_metrics", final_metrics)
        keep("final_predictions", final_pred)
        first = cv_pred.where(F.col("horizon") == 1).drop("horizon", "model")
        for name, table in plot_tables(first, MODEL_KEYS).items():
            keep(f"plot_{name}", table)
    except Exception as e:  # noqa: BLE001 - recorded, as in the reference
        status, error = "failed", f"{type(e).__name__}: {e}"
    settings = run_settings(cfg, data={"missing": missing, "normalize": normalize}, cv={"max_folds": max_folds},
                            visualization={"tables": sorted(t for t in written if t.startswith("plot_"))})
    record = run_record(spark, settings, status, error, written)
    append_run(record, f"{out_dir}/runs")
    return {"status": status, "error": error, "tables": written}
