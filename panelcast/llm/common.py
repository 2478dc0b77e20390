"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelcast.session import ensure_checkpoint_dir, ship_package

#: ASCII white space of the word rule; a word is a maximal run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps.

    Spark deletes them when the driver's collector finds that nothing refers
    to them any more; until it runs, the executors' disks hold the files of
    all steps at once.  What still refers to a shuffle keeps it.  The first
    collection frees Python's handles, the second what they held.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def materialise(df: DataFrame, tidy: bool = True) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and go on from there, without the shuffles before (``tidy``)."""
    ensure_checkpoint_dir(df.sparkSession)
    if tidy:
        release(df.sparkSession)
    return df.checkpoint(eager=True)


def exact_id(name: str) -> tuple[Column, Column]:
    """The id as a long that is never null, and ``no_id``: pandas turns a column with nulls into floats, which hold 53 bits."""
    return F.coalesce(F.col(name).cast("long"), F.lit(0)).alias(name), F.col(name).isNull().alias("no_id")


def id_values(ids) -> pd.Series:
    """Whole numbers and None as a column of nullable 64-bit integers."""
    return pd.Series(pd.array(list(ids), dtype="Int64"))


def ids_of(pdf: pd.DataFrame, name: str) -> list:
    """Ids of rows of ``exact_id``, None for null."""
    return [None if none else i for i, none in zip(pdf[name].tolist(), pdf["no_id"].tolist())]


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text; a null or blank text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def text_key(text: Column) -> Column:
    """128 bits and the length: stands for the whole text in shuffles."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b"), F.length(text).alias("n"))


def running_total(df: DataFrame, order: list, value: str, out: str) -> DataFrame:
    """``out``: sum of ``value`` over all rows up to this one in the global ``order``.

    Range partitions keep the order, each is summed on its own, and the sums
    of the partitions before (one row per partition) are added.  No task sees
    more than one range.  Rows that are equal in ``order`` should be equal in
    every column that matters, as their order among themselves is open.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    here = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    parts = ranged.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = parts.select("_part", (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_before"))
    return (ranged.withColumn(out, F.sum(value).over(here)).join(before, "_part")
            .withColumn(out, F.col(out) + F.col("_before")).drop("_part", "_before"))
