"""Plan shape: panel operators never plan a single-partition exchange or a cartesian product."""
import re

import numpy as np
from conftest import daily

from panelcast.operators import clean as C
from panelcast.operators import features as FE
from panelcast.plans import workflow as WF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_table_single_shuffle(spark, panel_df):
    df = panel_df({"a": daily("2020-01-01", np.arange(50.0)), "b": daily("2020-01-01", np.arange(50.0))})
    p = plan(FE.create_all_features(C.preprocess_complete(df).select("series_id", "ds", "y", "pos")))
    assert "SinglePartition" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    # one exchange to combine a day's rows (partial aggregates first), one for all windows of the panel
    assert len(re.findall(r"Exchange hashpartitioning\(series_id#\d+, \d+\)", p)) == 1
    assert p.count("Exchange hashpartitioning(series_id") == 2
    assert "Join" not in p  # the holiday flag is computed from the date


def test_horizons_share_one_scan_and_passes_add_nothing(spark, panel_df, tmp_path):
    from panelcast.operators import forecast as FC
    panel_df({"a": daily("2018-01-01", np.arange(900.0))}).write.parquet(str(tmp_path / "p"))
    src = spark.read.parquet(str(tmp_path / "p"))

    def shape(h, loss="ls", passes=1):
        cfg = FC.LinearARConfig(n_lags=3, n_forecasts=h, weekly_order=1, yearly_order=0, loss=loss, irls_iterations=passes)
        metrics, pred, _ = (WF.final_fit if loss == "huber" else WF.cv_linear)(src, cfg, checkpoint_input=False)
        p = plan(pred)
        return p.count("FileScan") + p.count("Scan parquet"), len(re.findall(r"\bWindow\b", p)), p.count("MapInPandas")

    one, many = shape(1), shape(30)
    assert one == many
    assert shape(2, "huber", 1) == shape(2, "huber", 3)


def test_cv_plan_has_no_single_partition(spark, panel_df):
    df = panel_df({"a": daily("2018-01-01", np.arange(900.0))})
    p = plan(WF.cv_seasonal_naive(df))
    assert "SinglePartition" not in p and "CartesianProduct" not in p


def test_scan_prunes_columns(spark):
    from panelcast.sources import tables as T
    p = T.lineitem_supplier_panel(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in p


def test_cv_reuses_series_partitioning_after_checkpoint(spark, panel_df):
    # the checkpointed input keeps its series_id hash partitioning: windows and per-series aggregates reuse
    # it, so no row-level shuffle happens; only the per-fold join may exchange fold-level rows
    df = panel_df({"a": daily("2018-01-01", np.arange(900.0)), "b": daily("2018-01-01", np.arange(900.0))})
    src = C.preprocess_complete(df).select("series_id", "ds", "y")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(WF.cv_seasonal_naive(src))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert all(re.match(r"series_id#\d+, fold_idx#\d+, \d+$", k) for k in keys), keys
