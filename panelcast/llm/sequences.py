"""Documents packed into blocks, and questions put by blocks to buckets of hashes.

A block holds the texts of some document rows, compressed.  Blocks are
hash-partitioned and written once to the shared folder; later steps read them
from there, in place.  A step asks: every block sends each bucket one row with
all it has for it (sorted, without repeats), a bucket answers each block that
asked with one row.  So a value that a third of all documents hold is sent
once per block, not once per document, and no text moves after the packing.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import exact_id, ids_of, materialise, release

BLOCK_BYTES = 1 << 20
#: Compressed bytes of text that a bucket stands for at most, and buckets per shuffle partition at least.
BUCKET_BYTES, BUCKETS_PER_PARTITION = 8 << 20, 4

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
S32 = np.uint64(32)
#: The block number of what a bucket keeps.
TABLE = -1
#: Where ids are compared, a null one comes after all others.
NO_ID = np.int64(2 ** 63 - 1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def squeeze(x, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(x, protocol=5))


def unsqueeze(x: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(x))


class Block:
    """Some document rows: ids, and their texts one after the other."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, data: bytes, no_id: np.ndarray | None = None):
        self.ids, self.sizes = ids, sizes
        self.no_id = np.zeros(len(ids), bool) if no_id is None else no_id
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.bytes = np.frombuffer(data, np.uint8)

    @classmethod
    def read(cls, payload: bytes) -> Block:
        return cls(*unsqueeze(payload))


def pack(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, payload) of all rows of (doc_id, text); a null text is empty.  Partitioned by block, written."""
    def write(batches):
        part, made = TaskContext.get().partitionId() << 32, 0
        ids, none, texts, held = [], [], [], 0

        def row():
            sizes = np.array([len(x) for x in texts], np.int64)
            return pd.DataFrame({"block": [part + made], "payload": [
                squeeze((np.array(ids, np.int64), sizes, b"".join(texts), np.array(none, bool)), 6)]})

        for pdf in batches:
            for key, text in zip(ids_of(pdf, "doc_id"), pdf["text"]):
                ids.append(int(NO_ID) if key is None else key)
                none.append(key is None)
                texts.append(text.encode("utf-8", "replace") if isinstance(text, str) else b"")
                held += len(texts[-1])
                if held >= block_bytes:
                    yield row()
                    made, ids, none, texts, held = made + 1, [], [], [], 0
        if ids:
            yield row()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.select(*exact_id("doc_id"), "text").mapInPandas(write, "block long, payload binary")
    return _written_in_place(packed.repartition(n, "block"))


def _written_in_place(df: DataFrame) -> DataFrame:
    """Checkpoint that keeps the partitioning, so later steps don't shuffle the rows again.

    Adaptive plans don't tell theirs, so this one write runs without.
    """
    conf, key = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    was = conf.get(key)
    conf.set(key, "false")
    try:
        return materialise(df)
    finally:
        conf.set(key, was)


def bucket_count(blocks: DataFrame) -> int:
    total = blocks.agg(F.sum(F.length("payload"))).first()[0] or 0
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(BUCKETS_PER_PARTITION * n, -(-total // BUCKET_BYTES))


def ask(blocks: DataFrame, said: DataFrame | None, question: Callable[[Block, dict], Iterable[tuple[int, object]]]) -> DataFrame:
    """(bucket, block, message): what each block asks each bucket; ``question`` gets the answers so far, by bucket."""
    def one(block: int, payload: bytes, answers: dict) -> pd.DataFrame:
        rows = [(bucket, block, squeeze(x)) for bucket, x in question(Block.read(payload), answers)]
        return pd.DataFrame(rows, columns=["bucket", "block", "message"])

    form = "bucket int, block long, message binary"
    if said is None:
        def alone(batches):
            for pdf in batches:
                for block, payload in zip(pdf["block"], pdf["payload"]):
                    yield one(block, payload, {})
        return blocks.mapInPandas(alone, form)

    def both(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        answers = {b: unsqueeze(x) for b, x in zip(right["bucket"], right["message"])}
        return pd.concat([one(b, p, answers) for b, p in zip(left["block"], left["payload"])], ignore_index=True)
    return blocks.groupBy("block").cogroup(said.groupBy("block")).applyInPandas(both, form)


def answer(asked: DataFrame, reply: Callable[[list], tuple[list, object]]) -> DataFrame:
    """(bucket, block, message): ``reply`` maps a bucket's messages to one answer each (None: nothing to say).

    It also returns what the bucket itself keeps, a row of block TABLE if it isn't None.
    """
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        answers, table = reply([unsqueeze(x) for x in pdf["message"]])
        bucket = int(pdf["bucket"].iloc[0])
        rows = [(bucket, b, squeeze(x)) for b, x in zip(pdf["block"], answers) if x is not None]
        rows += [(bucket, TABLE, squeeze(table))] if table is not None else []
        return pd.DataFrame(rows, columns=["bucket", "block", "message"])
    return asked.groupBy("bucket").applyInPandas(one, "bucket int, block long, message binary")


def conclude(blocks: DataFrame, said: DataFrame, finish: Callable[[Block, dict], pd.DataFrame], form: str) -> DataFrame:
    """Rows made of each block and all answers to it, by bucket; by (kind, bucket) if ``said`` has a column kind."""
    def both(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        keys = zip(right["kind"], right["bucket"]) if "kind" in right else right["bucket"]
        answers = {k: unsqueeze(x) for k, x in zip(keys, right["message"])}
        return pd.concat([finish(Block.read(p), answers) for p in left["payload"]], ignore_index=True)
    release(blocks.sparkSession)
    return blocks.groupBy("block").cogroup(said.groupBy("block")).applyInPandas(both, form)


def id_column(block: Block) -> pd.Series:
    return pd.Series(block.ids, dtype="Int64").mask(block.no_id)


def small(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in the narrowest type."""
    if len(x) and x.min() < 0:
        return x
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


# hashing

def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> S32)
    h *= MIX
    h ^= h >> S32
    return h


def _powers(x: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), np.uint64(x), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse modulo 2**64."""
    size = 1 << max(n - 1, 1023).bit_length()
    if size not in _POWERS:
        _POWERS[size] = _powers(int(ODD), size), _powers(pow(int(ODD), -1, 1 << 64), size)
    return _POWERS[size]


def gram_hashes(tokens: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of each run of ``k`` tokens, by prefix hashes; tokens are 64-bit."""
    if len(tokens) < k:
        return np.zeros(0, np.uint64)
    up, down = powers(len(tokens))
    prefix = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(tokens * up[:len(tokens)], out=prefix[1:])
    return mix((prefix[k:] - prefix[:-k]) * down[:len(tokens) - k + 1])


class Words:
    """The words of a block: hash of each, first and end byte, and the documents' first words."""

    #: Documents are read in runs of about so many bytes: what is needed per byte stays small.
    RUN = 1 << 19

    def __init__(self, block: Block, lower: bool = False):
        parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        doc, n = 0, len(block.sizes)
        while doc < n:
            to = max(int(np.searchsorted(block.starts, block.starts[doc] + self.RUN, "right")) - 1, doc + 1)
            a, b = int(block.starts[doc]), int(block.starts[to])
            if b > a:
                h, first, end = _words(block.bytes[a:b], block.starts[doc + 1:to] - a, lower)
                parts.append((h, first + a, end + a))
            doc = to
        self.hash, self.first, self.end = (np.concatenate(x) for x in zip(*parts))
        self.starts = np.searchsorted(self.first, block.starts)


def _words(data: np.ndarray, cuts: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, end byte) of the words; a word ends at a cut, where a document begins."""
    data = LOWER[data] if lower else data
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins = solid.copy()
    ends = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    if len(cuts):
        begins[cuts] = solid[cuts]
        ends[cuts - 1] = solid[cuts - 1]
    first = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    size = end - first
    if not len(size):
        return np.zeros(0, np.uint64), first, end
    up, _ = powers(int(size.max()))
    at = np.flatnonzero(solid)
    within = at - np.repeat(first, size)
    value = (data[at].astype(np.uint64) + np.uint64(1)) * up[within]
    offsets = np.concatenate(([0], np.cumsum(size)[:-1]))
    return mix(np.add.reduceat(value, offsets) + size.astype(np.uint64) * MIX), first, end
