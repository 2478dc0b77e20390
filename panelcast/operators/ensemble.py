"""Prediction stacks and ensembles (ST-3, FC-10, FC-11, DK-5).

Members stay rows of one long table ``(model, keys..., ds, yhat)``; the
ensemble is one ``groupBy`` over the row key.  A member that is missing or
NULL for a row makes the mean missing, as a NaN does in ``numpy.mean``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

YHAT = "yhat"


def stack_predictions(members: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """ST-3: union of member predictions with a ``model`` column."""
    out = None
    for name, df in members.items():
        part = df.select(F.lit(name).alias("model"), *columns)
        out = part if out is None else out.unionByName(part)
    return out


def ensemble(stacked: DataFrame, row_keys: Sequence[str], method: str = "mean", n_models: int | None = None,
             weights: DataFrame | None = None) -> DataFrame:
    """FC-11 / DK-5: combine member predictions per row.

    ``mean`` and ``median`` need every member present and non-NULL (when
    ``n_models`` is given, rows with fewer members are also missing);
    ``weighted`` uses a ``(model, ..., weight)`` table joined on its key
    columns, with missing members dropped from both sums.
    """
    rk = list(row_keys)
    present = F.count(F.col(YHAT))
    complete = present == F.count(F.lit(1))
    if n_models is not None:
        complete = complete & (present == F.lit(int(n_models)))
    if method == "mean":
        val = F.when(complete, F.avg(YHAT))
    elif method == "median":
        val = F.when(complete, F.median(YHAT))
    elif method == "weighted":
        if weights is None:
            raise ValueError("weighted ensemble needs a weights table")
        wkeys = [c for c in weights.columns if c != "weight"]
        stacked = stacked.join(weights, wkeys, "left")
        val = F.try_divide(F.sum(F.col("weight") * F.col(YHAT)), F.sum(F.when(F.col(YHAT).isNotNull(), F.col("weight"))))
    else:
        raise ValueError(f"unknown ensemble method {method!r}")
    return stacked.groupBy(*rk).agg(val.alias(YHAT), present.alias("n_members"))


def inverse_error_weights(fold_metrics: DataFrame, keys: Sequence[str], metric: str = "mae") -> DataFrame:
    """Weights ``1 / mean CV error`` per (model, keys) from successful folds (our choice for DK-5)."""
    ok = fold_metrics.where(F.col("status") == "success")
    return ok.groupBy("model", *keys).agg(F.try_divide(F.lit(1.0), F.avg(metric)).alias("weight"))

