"""Packing documents into sequences by non-negative least squares.

Documents are encoded once and cut into windows of ``length`` ids.  Full
windows are sequences of their own.  For the rest, short of a window, lengths
are counted in units of ``GRID`` ids, rounded up.  All combinations of at most
three lengths that fill a window exactly are the columns of a matrix; the
counts of combinations that come closest to the histogram of lengths are found
by non-negative least squares, rounded, and taken while pieces last.  What is
left is packed greedily, longest first, on a line that is cut at every window,
so at most one document per sequence is cut; the line's end, less than a
window, is cut at powers of two, which need no padding.

The histogram has at most ``length`` rows, so the plan (some thousand
intervals) depends on the parameters only, not on the input.  Pieces are
numbered by length with range partitions; a piece's number tells its interval,
and with it its sequence and offset, by binary search in any task.  The ids
stay where they were written and are joined to their places by row.

Defined results: a null or empty text is its end id alone; repeated rows and
ids are packed as often as they occur; null ids are kept as such; an empty
table gives no piece; only ``doc_id`` and ``text`` are read.  Sequence numbers
are unique, those of full windows have gaps between them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.session import ensure_checkpoint_dir

from .common import running_total
from .tokens import encoder, in_batches

LENGTH, END_ID = 2048, 1
GRID, DEPTH = 4, 3


# step 1: encode


def _pieces_of(tokenizer: str, length: int, end_id: int):
    def run(batches):
        coder = encoder(tokenizer)
        for batch in batches:
            keys, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            for a, b in in_batches(texts):
                rows, sizes, starts, lengths, ids = [], [], [], [], []
                for i, got in zip(range(a, b), coder.ids(texts[a:b])):
                    own = np.append(got, np.uint32(end_id)).astype("<u4")
                    for at in range(0, len(own), length):
                        part = own[at:at + length]
                        rows.append(i)
                        sizes.append(len(own))
                        starts.append(at)
                        lengths.append(len(part))
                        ids.append(part.tobytes())
                yield pa.record_batch([keys.take(pa.array(rows)), pa.array(sizes, pa.int64()), pa.array(starts, pa.int64()),
                                       pa.array(lengths, pa.int32()), pa.array(ids, pa.binary())],
                                      names=["doc_id", "doc_tokens", "start", "length", "ids"])
    return run


def encoded_pieces(docs: DataFrame, folder: str, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Write and read (row, doc_id, doc_tokens, start, length, ids): windows of the documents' ids, ``row`` numbers them."""
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    cut = texts.mapInArrow(_pieces_of(tokenizer, length, end_id),
                           f"doc_id {dict(texts.dtypes)['doc_id']}, doc_tokens long, start long, length int, ids binary")
    cut = cut.withColumn("row", F.monotonically_increasing_id())
    cut.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(cut.schema).parquet(folder)


# step 2: the plan


def combinations(units: int, depth: int = DEPTH) -> np.ndarray:
    """All non-decreasing lengths, ``depth`` at most, that add up to ``units``; zeros come first."""
    found = [np.array([[units]])]
    for d in range(1, depth):  # split the largest part of each combination
        last = found[-1]
        more = []
        for row in last:
            least = row[-2] if d > 1 else 1
            first = np.arange(least, row[-1] // 2 + 1)
            more.append(np.column_stack([np.tile(row[:-1], (len(first), 1)), first, row[-1] - first]))
        found.append(np.concatenate(more).astype(np.int64).reshape(-1, d + 1))
    return np.concatenate([np.pad(f, ((0, 0), (depth - f.shape[1], 0))) for f in found])


def least_squares(columns: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Non-negative x with the least distance between the combinations' lengths, x times, and ``wanted`` (by active sets).

    ``columns`` has the lengths of each combination; row u of the matrix that
    they stand for counts how often a combination has length u.
    """
    size = len(wanted)
    x, used = np.zeros(len(columns)), []
    matrix = np.zeros((size, 0))
    left = wanted.astype(float)
    enough = 1e-9 * max(1.0, np.abs(wanted).max(initial=0))
    for _ in range(3 * size):
        weighed = left.copy()
        weighed[0] = 0.0  # the padding of short combinations
        gain = weighed[columns].sum(axis=1)
        gain[used] = -np.inf
        new = int(gain.argmax())
        if gain[new] <= enough:
            break
        used.append(new)
        matrix = np.column_stack([matrix, np.bincount(columns[new], minlength=size)])
        matrix[0] = 0.0
        while True:
            best = np.linalg.lstsq(matrix, wanted, rcond=None)[0] if len(used) > size else np.linalg.solve(
                matrix.T @ matrix + 1e-12 * np.eye(len(used)), matrix.T @ wanted)
            if (best > 0).all():
                x[used] = best
                break
            now, low = x[used], best <= 0
            step = (now[low] / np.maximum(now[low] - best[low], 1e-300)).min()
            now = now + step * (best - now)
            keep = ~(low & (now <= enough))
            if keep.all():
                keep[np.flatnonzero(low)[now[low].argmin()]] = False
            x[used] = np.where(keep, now, 0.0)
            used, matrix = [u for u, k in zip(used, keep) if k], matrix[:, keep]
            if not used:
                break
        left = wanted - matrix @ x[used]
    return x


@dataclass
class Plan:
    """Where the pieces shorter than a window go.  A piece's rank is its number by (length, row)."""

    length: int
    upto: np.ndarray  # ranks of pieces of at most so many ids
    first: np.ndarray  # first rank of each interval, ascending
    sequence: np.ndarray  # of the interval's first piece, -1: on the line
    before: np.ndarray  # first ranks of the intervals whose pieces stand before in the same sequences, -1: none
    line: np.ndarray  # place on the line of the interval's first piece
    cuts: np.ndarray  # ends of the line's last, short sequences
    line_sequence: int
    sequences: int

    def length_of(self, rank: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.upto, rank, "right")

    def ids_before(self, rank: np.ndarray) -> np.ndarray:
        """Ids of all pieces of lower rank."""
        sizes = np.arange(len(self.upto))
        counts = np.diff(self.upto, prepend=0)
        total = np.cumsum(counts * sizes)
        own = self.length_of(rank)
        lower = np.where(own > 0, total[own - 1], 0)
        return lower + (rank - np.where(own > 0, self.upto[own - 1], 0)) * own

    def places(self, ranks: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(index of the rank, from, length, sequence, offset) of every part of the pieces."""
        sizes, at = self.length_of(ranks), np.searchsorted(self.first, ranks, "right") - 1
        nth = ranks - self.first[at]
        offset = np.zeros(len(ranks), np.int64)
        for slot in range(self.before.shape[1]):
            there = self.before[at, slot]
            offset += np.where(there >= 0, self.length_of(np.maximum(there, 0) + nth), 0)
        place = self.line[at] + self.ids_before(ranks) - self.ids_before(self.first[at])
        out = []
        for i, (size, seq, k, off, pos) in enumerate(zip(sizes.tolist(), self.sequence[at].tolist(), nth.tolist(), offset.tolist(), place.tolist())):
            if seq >= 0:
                out.append((i, 0, size, seq + k, off))
                continue
            done = 0
            while done < size:
                n, off, end = self._on_line(pos + done)
                take = min(size - done, end - off)
                out.append((i, done, take, self.line_sequence + n, off))
                done += take
        return out

    def _on_line(self, pos: int) -> tuple[int, int, int]:
        """Number of the line's sequence, offset in it, its length."""
        whole = (int(self.cuts[0]) if len(self.cuts) else pos + self.length) // self.length
        if pos < whole * self.length or not len(self.cuts):
            return pos // self.length, pos % self.length, self.length
        k = int(np.searchsorted(self.cuts, pos, "right"))
        return whole + k - 1, pos - int(self.cuts[k - 1]), int(self.cuts[k] - self.cuts[k - 1])


def make_plan(histogram: dict[int, int], length: int = LENGTH, grid: int = GRID, depth: int = DEPTH) -> Plan:
    """The plan for ``histogram``: how many pieces have each length below ``length``."""
    counts = np.zeros(length, np.int64)
    for size, n in histogram.items():
        counts[size] = n
    upto = np.cumsum(counts)
    units = -(-length // grid)
    edges = np.minimum(np.arange(units + 1) * grid, length - 1)
    rank_end = upto[edges]  # ranks of all pieces of at most so many units
    have = np.diff(rank_end, prepend=0)
    free, left = np.concatenate([[0], rank_end[:-1]]), have.copy()
    columns = combinations(units, depth)
    solved = least_squares(columns, have.astype(float))
    intervals, sequence = [], 0  # first rank, first sequence, ranks before, place on the line
    for c in np.argsort(-solved, kind="stable"):
        if solved[c] < 0.5:
            break
        lengths = columns[c][columns[c] > 0]
        kinds, times = np.unique(lengths, return_counts=True)
        n = int(min(round(solved[c]), (left[kinds] // times).min()))
        if n <= 0:
            continue
        slots: list[int] = []
        for u in lengths.tolist():
            intervals.append((int(free[u]), sequence, slots + [-1] * (depth - 1 - len(slots)), 0))
            slots = [*slots, int(free[u])]
            free[u] += n
            left[u] -= n
        sequence += n
    # the rest, longest first, stands on a line
    line = 0
    sizes = np.arange(length)
    total = np.concatenate([[0], np.cumsum(counts * sizes)])
    ids_upto = total[1:][edges]
    plan = Plan(length, upto, *(np.zeros(0, np.int64),) * 4, np.zeros(0, np.int64), sequence, 0)
    for u in range(units, 0, -1):
        if left[u]:
            intervals.append((int(free[u]), -1, [-1] * (depth - 1), line))
            line += int(ids_upto[u] - plan.ids_before(np.array([free[u]]))[0])
    intervals.sort()
    whole, tail = divmod(line, length)
    cuts = [whole * length]
    for bit in reversed(range(length.bit_length())):
        if tail >> bit & 1:
            cuts.append(cuts[-1] + (1 << bit))
    plan.first = np.array([i[0] for i in intervals], np.int64)
    plan.sequence = np.array([i[1] for i in intervals], np.int64)
    plan.before = np.array([i[2] for i in intervals], np.int64).reshape(len(intervals), depth - 1)
    plan.line = np.array([i[3] for i in intervals], np.int64)
    plan.cuts = np.array(cuts if tail else [], np.int64)
    plan.sequences = sequence + whole + max(0, len(cuts) - 1)
    return plan


# step 3: pieces to places


def _placer(plan: Plan):
    def run(batches):
        for batch in batches:
            rows, ranks = batch.column("row"), batch.column("rank").to_numpy(zero_copy_only=False)
            if not len(ranks):
                continue
            i, begin, size, sequence, offset = map(np.array, zip(*plan.places(ranks)))
            yield pa.record_batch([rows.take(pa.array(i)), pa.array(begin, pa.int32()), pa.array(size, pa.int32()),
                                   pa.array(sequence, pa.int64()), pa.array(offset, pa.int32())],
                                  names=["row_", "begin", "size", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer: str, folder: str | None = None, length: int = LENGTH, end_id: int = END_ID,
         grid: int = GRID, depth: int = DEPTH) -> DataFrame:
    """Per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    The encoded windows are written under ``folder``, without it under the session's shared folder.
    """
    folder = folder or f"{ensure_checkpoint_dir(docs.sparkSession)}/packing-{uuid.uuid4().hex}"
    pieces = encoded_pieces(docs, folder, tokenizer, length, end_id)
    short = pieces.where(F.col("length") < length)
    plan = make_plan({r["length"]: r["n"] for r in short.groupBy("length").agg(F.count("*").alias("n")).collect()}, length, grid, depth)
    ranked = running_total(short.select("row", "length", F.lit(1).alias("one")), ["length", "row"], "one", "upto")
    placed = ranked.select("row", (F.col("upto") - 1).alias("rank")).mapInArrow(
        _placer(plan), "row_ long, begin int, size int, sequence_id long, offset int")
    cut = short.join(placed, F.col("row") == F.col("row_"))
    whole = pieces.where(F.col("length") == length)
    return cut.select("doc_id", (F.col("start") + F.col("begin")).alias("start"), F.col("size").cast("long").alias("length"),
                      F.substring(F.col("ids"), 4 * F.col("begin") + 1, 4 * F.col("size")).alias("ids"), "doc_tokens",
                      "sequence_id", F.col("offset").cast("long").alias("offset")).unionByName(
        whole.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids", "doc_tokens",
                     (F.col("row") + plan.sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))


def padded_length(tokens: Column, length: int = LENGTH) -> Column:
    """Ids of a sequence with its padding: a power of two stays, others fill the window."""
    return F.when(F.bit_count(tokens) == 1, tokens).otherwise(F.lit(length))


def packed_sequences(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """(sequence_id, tokens, padded, ids, documents): a sequence's pieces put together, at most ``length`` ids."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "start", "length")))
    return (pieces.groupBy("sequence_id").agg(ordered.alias("p"))
            .select("sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("tokens"),
                    F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
                    F.transform("p", lambda x: F.struct(x["doc_id"], x["start"], x["offset"], x["length"])).alias("documents"))
            .withColumn("padded", padded_length(F.col("tokens"), length)))


def packing_report(docs: DataFrame, tokenizer: str, **how) -> DataFrame:
    pieces = pack(docs, tokenizer, **how)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
