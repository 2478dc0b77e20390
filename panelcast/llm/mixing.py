"""Mixing sources to target weights by weighted fair queueing (built-in functions only).

Every document is queued once per allowed epoch in its source's shuffled
order.  A queued copy finishes at (tokens of its source up to and with it) /
(weight of the source).  All copies are sorted by finish time and taken until
the budget is reached.  A source that runs out of copies stops, and the rest
share what is left by weight: the water-filling targets of ``targets``.

Defined results: a null text has size 0; a null source is a source of its
own, ordered last; repeated rows queue as often as they occur; documents of
size 0 are taken 0 words; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, materialise, running_total

WEIGHTS = (5, 2, 1)
BUDGET_SHARE = 1.5
EPOCHS = 2
SEED = 20


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("source").alias("src"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = BUDGET_SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(src, source_size, weight, target, budget): one row per source.

    A source stops at its cap, ``epochs`` times its size.  Filled in the order
    of cap / weight, the level (budget - caps before) / weights left rises
    while sources are capped and falls after them, so the final level is the
    largest.
    """
    # one row per source: the windows without a key see that small table only
    per = (sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
           .withColumn("i", F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1)
           .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("i") % len(weights) + 1).cast("int")))
           .withColumn("cap", epochs * F.col("source_size")))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "i")
    everything = Window.partitionBy(F.lit(0))
    level = (F.col("budget") - F.col("caps_before")) / F.col("weights_left")
    return (per.withColumn("budget", share * F.sum("source_size").over(everything))
            .withColumn("caps_before", F.sum("cap").over(filling) - F.col("cap"))
            .withColumn("weights_left", F.sum("weight").over(everything) - F.sum("weight").over(filling) + F.col("weight"))
            .withColumn("level", F.max(level).over(everything))
            .withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")))
            .select("src", "source_size", "weight", "target", "budget"))


def mix(sizes: DataFrame, weights=WEIGHTS, share: float = BUDGET_SHARE, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of (doc_id, src, size)."""
    sizes = materialise(sizes)
    per = materialise(targets(sizes, weights, share, epochs))
    shuffled = sizes.withColumn("turn", F.xxhash64(F.lit(seed), "doc_id", "size"))
    # cumulative tokens within each source: the running total over (source, shuffled order), less all sources before
    queue = running_total(shuffled, [F.col("src").asc_nulls_last(), "turn", "doc_id", "size"], "size", "upto")
    starts = per.select(F.col("src").alias("src_"), "source_size", "weight", "target", "budget",
                        (F.sum("source_size").over(Window.orderBy(F.col("src").asc_nulls_last())) - F.col("source_size")).alias("before"))
    # repeated rows are told apart from here on; the id is fixed by the write
    queue = materialise(queue.join(starts, F.col("src").eqNullSafe(F.col("src_"))).drop("src_")
                        .withColumn("row", F.monotonically_increasing_id()))
    copies = (queue.select("row", "src", "turn", "size", "source_size", "weight", "budget",
                           (F.col("upto") - F.col("before")).alias("cum"), F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
              .withColumn("finish", (F.col("cum") + F.col("epoch") * F.col("source_size")) / F.col("weight")))
    order = ["finish", F.col("src").asc_nulls_last(), "epoch", "turn", "row"]
    taken = (running_total(copies, order, "size", "total").where(F.col("total") <= F.col("budget"))
             .groupBy("row").agg(F.sum("size").alias("taken"), F.count("*").alias("copies")))
    return queue.join(taken, "row", "left").select(
        "doc_id", "src", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("copies", F.lit(0)).alias("copies"))


def mix_report(docs: DataFrame, **how) -> DataFrame:
    return mix(sized(docs), **how).drop("src", "copies")


def mix_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents as often as the mix takes them, with the columns they came with.

    Rows with the same id, source and size are taken alike, as often as the first of them in the queue.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    plan = (mix(sized(docs), **how).groupBy("doc_id", "src", "size").agg(F.max("copies").cast("int").alias("__mix_copies"))
            .where("__mix_copies > 0").select(F.col("doc_id").alias("__mix_id"), F.col("src").alias("__mix_src"), F.col("size").alias("__mix_size"), "__mix_copies"))
    same = F.col("doc_id").eqNullSafe(F.col("__mix_id")) & F.col("source").eqNullSafe(F.col("__mix_src")) & (size == F.col("__mix_size"))
    once = docs.join(plan, same)
    return (once.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
            .drop("__mix_id", "__mix_src", "__mix_size", "__mix_copies", "__mix_copy"))
