"""File sources and sinks (IO-1, IO-2, IO-5..IO-9, SC-13, SC-14).

* ``read_preamble_csv``: CSV files whose first ``skip`` physical lines are a
  preamble and whose next line is the header (the reference's input).
* ``append_run`` / ``save_coefficients`` / ``load_coefficients`` /
  ``model_summary``: result tables instead of pickles and loose JSON files.
"""

from __future__ import annotations

import csv
import json
import logging
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


LOG = logging.getLogger(__name__)

def read_preamble_csv(spark: SparkSession, path: str, date_col: str, target_col: str, skip: int = 5,
                      date_format: str | None = None, sep: str = ",") -> DataFrame:
    """IO-1: skip the first ``skip`` lines of every file, use the next line as header.

    The preamble can only sit in a file's first block, so only first-block
    lines are numbered (a window per file over that block, bounded by the
    block size); later blocks pass straight through.  Line order inside a
    block follows the scan order, recorded with ``monotonically_increasing_id``.
    The headers of all files must be equal (one distinct value is fetched).
    Names may hold spaces and be quoted.  A line with another number of
    fields raises.  Every column is read as text, then the date and target
    are typed; the target's NaN becomes NULL.
    """
    raw = (spark.read.text(path)
           .select("value", F.col("_metadata.file_path").alias("_f"),
                   F.col("_metadata.file_block_start").alias("_b"),
                   F.monotonically_increasing_id().alias("_i")))
    first_block = raw.where(F.col("_b") == 0)
    numbered = first_block.withColumn("_ln", F.row_number().over(Window.partitionBy("_f").orderBy("_i")))
    header_rows = numbered.where(F.col("_ln") == skip + 1).select("value").distinct().limit(2).collect()
    if not header_rows:
        raise ValueError(f"{path}: fewer than {skip + 1} lines")
    if len(header_rows) > 1:
        raise ValueError(f"{path}: the files' headers differ: {[r[0] for r in header_rows]}")
    names = [h.strip() for h in next(csv.reader([header_rows[0][0]], delimiter=sep, skipinitialspace=True))]
    missing = [c for c in (date_col, target_col) if c not in names]
    if missing:
        raise ValueError(f"{path}: required column(s) {missing} not in header {names}")
    body = numbered.where(F.col("_ln") > skip + 1).select("value").unionByName(
        raw.where(F.col("_b") > 0).select("value"))
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    parsed = body.where(F.length(F.trim("value")) > 0).select(
        F.from_csv("value", schema, {"sep": sep, "mode": "FAILFAST"}).alias("r")).select("r.*")
    d = F.to_date(F.col(date_col), date_format) if date_format else F.to_date(F.col(date_col))
    t = F.col(target_col).cast("double")
    return parsed.withColumn(date_col, d).withColumn(
        target_col, F.when(F.isnan(t), F.lit(None).cast("double")).otherwise(t))


def csv_stats(df: DataFrame, date_col: str) -> DataFrame:
    """IO-9: row count, column count and first date (one global aggregate)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(date_col).alias("first_date")).withColumn(
        "n_columns", F.lit(len(df.columns)))


def csv_head(df: DataFrame, date_col: str, target_col: str, head: int = 5) -> DataFrame:
    """IO-9: the first ``head`` targets by date (a top-k; the limit is the feature)."""
    return df.orderBy(date_col).limit(head).select(date_col, target_col)


# --- result sinks -----------------------------------------------------------

def run_record(spark: SparkSession, config: Mapping, status: str, error: str | None = None,
               results: Mapping | None = None) -> DataFrame:
    """IO-5/IO-8/SC-13/SC-14: one run row; values JSON cannot encode become strings."""
    payload = json.dumps({"config": config, "results": results or {}}, default=str, sort_keys=True)
    return spark.createDataFrame(
        [(uuid.uuid4().hex, payload, status, error)],
        "run_id string, payload string, status string, error string",
    ).select("run_id", F.current_timestamp().alias("ts"),
             F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss").alias("stamp"),
             "payload", "status", "error")


def append_run(record: DataFrame, path: str) -> None:
    """IO-5: append to the ``runs`` table (Parquet), one file per run."""
    record.coalesce(1).write.mode("append").parquet(path)


def save_coefficients(coef_table: DataFrame, path: str) -> bool:
    """IO-6: write the coefficient table partitioned by model; False on error or nothing to save."""
    try:
        if coef_table is None:
            return False
        coef_table.write.mode("overwrite").partitionBy("model").parquet(path)
        return True
    except Exception:  # noqa: BLE001 - failure is the return value, its cause goes to the log
        LOG.exception("the coefficients were not written to %s", path)
        return False


def load_coefficients(spark: SparkSession, path: str, model: str | None = None) -> DataFrame | None:
    """IO-6: read a saved coefficient table (optionally one model: partition pruning); None on error."""
    try:
        df = spark.read.parquet(path)
        return df.where(F.col("model") == model) if model else df
    except Exception:  # noqa: BLE001
        LOG.exception("no coefficients were read from %s", path)
        return None


def model_summary(coef_table: DataFrame, config_json: str) -> DataFrame:
    """IO-7: one row per model: settings, creation time, fitted series/folds and training rows."""
    return coef_table.groupBy("model").agg(
        F.count_distinct("series_id").alias("n_series"),
        F.count(F.lit(1)).alias("n_fits"),
        F.count_if(F.col("status") == "success").alias("n_success"),
        F.sum("n_rows").alias("training_rows"),
    ).select("model", F.current_timestamp().alias("created_at"), F.lit(config_json).alias("architecture"),
             "n_series", "n_fits", "n_success", "training_rows")


def save_metadata(summary: DataFrame, path: str) -> bool:
    """IO-7: model metadata as JSON lines."""
    try:
        summary.coalesce(1).write.mode("overwrite").json(path)
        return True
    except Exception:  # noqa: BLE001
        LOG.exception("the metadata were not written to %s", path)
        return False
