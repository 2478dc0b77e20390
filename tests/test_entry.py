"""Driver contract."""
import importlib


def test_entry_and_registry(spark):
    mod = importlib.import_module("__spark_entry__")
    df = mod.entry(spark)
    assert df.count() >= 0
    assert {"series_id", "fold_idx", "mae", "status"} <= set(df.columns)
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70
