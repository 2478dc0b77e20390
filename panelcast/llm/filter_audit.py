"""How filters interact: every order of five filters at once, by wide packed counters.

A document's outcome under all 120 orders follows from its mask, the set of
filters that it fails, and its two labels.  A table maps every mask to one big
integer with a field for each (order, step, count): 600 steps of six counts.
Adding up the integers of a part's documents adds up all its counts.  A field
is wide enough for the number of all documents, so no sum runs over into the
next field.  Tasks add up what they hold, the sums of a part are added in two
rounds, and each part's integer is unpacked at the end.

Whether a text has a smaller id is decided per text: rows are combined by
(id, text hash, part) and then by (text hash, part, mask) before they meet,
so a group of copies of any size is a few rows.

Defined results: a null text is empty; a null lang is the part ``""``; rows
with a null id come after all others and have no labels, so they fail E if any
row with an id holds their text; rows of one id are not smaller than each
other, and each counts; a label counts if any of the id's label rows has it;
an empty table gives no part and no row; only ``doc_id``, ``text``, ``lang``
and the labels' ``doc_id``, ``quality``, ``toxic`` are read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

FILTERS = "ABCDE"
ORDERS = list(itertools.permutations(range(len(FILTERS))))
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
STEPS = len(ORDERS) * len(FILTERS)
#: Bits of a code above the five filters'.
GOOD, TOXIC, CODES = 32, 64, 128
#: A task passes its sums on when it holds so many parts; a part's sums are first added in so many lots.
PARTS_HELD, LOTS = 64, 32

CAPITALS = bytes(range(65, 91))
FOLLOWING = bytes(range(0x80, 0xC0))  # UTF-8 bytes that start no code point
SYMBOL = re.compile(rb"[#$%&*|]")


def own_failures(text: bytes) -> int:
    """The filters A to D that a UTF-8 text fails, as bits."""
    words = text.split()  # bytes are split at \x20 and \x09-\x0D
    few = len(words) < 200
    repetitive = 100 * len(set(words)) < 50 * len(words)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    loud = 100 * capitals > 3 * len(text.translate(None, FOLLOWING))
    return few + 2 * repetitive + 4 * loud + 8 * bool(SYMBOL.search(text))


def _judge(batches):
    for batch in batches:
        bits, keys = [], []
        for text in batch.column(2):
            raw = text.as_py()
            bits.append(own_failures(raw))
            keys.append(hashlib.blake2b(raw, digest_size=16).digest())
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(bits, pa.int32()), pa.array(keys, pa.binary())],
                              names=["doc_id", "part", "bits", "key"])


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, code, n): documents of a part by the filters they fail and their labels."""
    raw = docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("part"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw"))
    kind = dict(raw.dtypes)["doc_id"]
    judged = raw.mapInArrow(_judge, f"doc_id {kind}, part string, bits int, key binary")
    rows = materialise(judged.groupBy("doc_id", "part", "bits", "key").agg(F.count("*").alias("c")))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id_")).agg(
        F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0)).alias("toxic"))
    found = rows.where(F.col("doc_id").isNotNull()).join(known, F.col("doc_id") == F.col("id_"), "left").drop("id_")
    nameless = rows.where(F.col("doc_id").isNull()).withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    coded = found.unionByName(nameless).withColumn(
        "code", F.col("bits") + F.coalesce("good", F.lit(0)) + F.coalesce("toxic", F.lit(0)))
    # the rows of the least id here, ids before none
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("c").alias("c")))
    per_text = coded.groupBy("key", "part", "code").agg(F.sum("c").alias("n"), first.alias("first"))
    least = F.min(F.struct(F.col("first")["none"].alias("none"), F.col("first")["id"].alias("id"))).over(Window.partitionBy("key"))
    firsts = (F.when(F.col("least")["none"], F.col("n"))
              .when(F.col("first")["id"] == F.col("least")["id"], F.col("first")["c"]).otherwise(F.lit(0)))
    both = F.array(F.struct(F.col("code").alias("code"), F.col("firsts").alias("n")),
                   F.struct((F.col("code") + 16).alias("code"), (F.col("n") - F.col("firsts")).alias("n")))
    return (per_text.withColumn("least", least).withColumn("firsts", firsts)
            .select("part", F.explode(both).alias("x")).select("part", "x.code", "x.n").where("n > 0"))


def outcomes(code: int) -> np.ndarray:
    """(600, 6): what a document with this code counts at every step of every order."""
    failed = [bool(code >> f & 1) for f in range(len(FILTERS))]
    out = np.zeros((STEPS, len(COUNTS)), np.uint8)
    at = 0
    for order in ORDERS:
        gone = False
        for f in order:
            now = failed[f] and not gone
            redundant, gone = failed[f] and gone, gone or failed[f]
            out[at] = (not gone, now, redundant, failed[f] and sum(failed) == 1, now and bool(code & GOOD), now and bool(code & TOXIC))
            at += 1
    return out


@functools.lru_cache(maxsize=None)
def packed(code: int, width: int) -> int:
    """The code's outcomes as one integer with fields of ``width`` bytes."""
    fields = np.zeros((STEPS * len(COUNTS), width), np.uint8)
    fields[:, 0] = outcomes(code).ravel()
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(total: int, width: int) -> np.ndarray:
    """(600, 6) counts."""
    size = STEPS * len(COUNTS)
    fields = np.frombuffer(total.to_bytes(size * width, "little"), np.uint8).reshape(size, width).astype(np.int64)
    return (fields << (8 * np.arange(width))).sum(axis=1).reshape(STEPS, len(COUNTS))


def _frame(totals: dict[str, int], width: int) -> pd.DataFrame:
    size = STEPS * len(COUNTS) * width
    return pd.DataFrame({"part": list(totals), "total": [x.to_bytes(size, "little") for x in totals.values()]})


def _packer(width: int):
    """Each task's integers, one per part that it holds."""
    def run(batches):
        totals: dict[str, int] = {}
        for pdf in batches:
            for (part, code), n in pdf.groupby(["part", "code"])["n"].sum().items():
                totals[part] = totals.get(part, 0) + int(n) * packed(int(code), width)
            if len(totals) > PARTS_HELD:
                yield _frame(totals, width)
                totals = {}
        yield _frame(totals, width)
    return run


def _adder(width: int):
    """Sums of neighbouring rows of one part; the rows come sorted by part."""
    def run(batches):
        part, total = None, 0
        for pdf in batches:
            for p, raw in zip(pdf["part"], pdf["total"]):
                if p != part and part is not None:
                    yield _frame({part: total}, width)
                    total = 0
                part, total = p, total + int.from_bytes(raw, "little")
        if part is not None:
            yield _frame({part: total}, width)
    return run


def _unpacker(width: int):
    letters = ["".join(FILTERS[f] for f in order) for order in ORDERS]
    at = np.array(ORDERS).ravel()

    def run(batches):
        for pdf in batches:
            for part, raw in zip(pdf["part"], pdf["total"]):
                counts = pd.DataFrame(unpacked(int.from_bytes(raw, "little"), width), columns=list(COUNTS))
                counts.insert(0, "part", part)
                counts.insert(1, "filter_order", np.repeat(letters, len(FILTERS)))
                counts.insert(2, "step", np.tile(np.arange(1, len(FILTERS) + 1), len(ORDERS)))
                counts["shapley"] = np.bincount(at, counts["removed"], len(FILTERS)).astype(np.int64)[at]
                yield counts
    return run


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order and step with its counts over all documents of the part."""
    coded = materialise(masks(docs, labels))
    n = coded.agg(F.sum("n")).first()[0] or 0
    width = max(1, (n.bit_length() + 7) // 8)  # bytes that hold n, which no field exceeds
    kind = "part string, total binary"
    sums = coded.mapInPandas(_packer(width), kind).withColumn("lot", F.spark_partition_id() % LOTS)
    lots = sums.repartition("part", "lot").sortWithinPartitions("part").select("part", "total").mapInPandas(_adder(width), kind)
    whole = lots.repartition("part").sortWithinPartitions("part").mapInPandas(_adder(width), kind)
    return whole.mapInPandas(_unpacker(width), "part string, filter_order string, step int, "
                             + ", ".join(f"{c} long" for c in (*COUNTS, "shapley")))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT doc_id, part,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), doc_id IS NULL AND min(doc_id) OVER (PARTITION BY text) IS NOT NULL)
      THEN 16 ELSE 0 END AS mask FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
codes AS (SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM m LEFT JOIN l ON m.doc_id = l.doc_id GROUP BY 1, 2, 3, 4),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS own,
    list_sum([1 << (ascii(filter_order[i]) - 65) for i in range(1, step)]) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)),
counted AS (SELECT part, filter_order, step, own,
    sum(CASE WHEN mask & (own | coalesce(before, 0)::BIGINT) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & own > 0 AND mask & coalesce(before, 0)::BIGINT = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & own > 0 AND mask & coalesce(before, 0)::BIGINT > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN good AND mask & own > 0 AND mask & coalesce(before, 0)::BIGINT = 0 THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN toxic AND mask & own > 0 AND mask & coalesce(before, 0)::BIGINT = 0 THEN n ELSE 0 END) AS toxic_lost
  FROM codes, steps GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""
