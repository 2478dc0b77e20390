"""Benchmark decontamination: BM25 over an inverted index of test items, block-max WAND, overlap check.

Every training document is cut into passages of twice the longest item's
words, overlapping by half, so an item's copy lies whole in one of them.
Each passage is a query against the index of the items; all items that
score at or above their threshold are retrieved.  An item's threshold is its
score against itself less its heaviest terms, as many as a copy may lack, so
no pair that the check below would accept is missed.  The check compares
five-word shingles: a document is contaminated by an item when a passage
holds at least 80 % of the item's shingles, and some of both its question
(all sentences but the last) and its answer (the last sentence).

The index is built by Spark and read in chunks of bounded items and text;
each chunk is broadcast on its own and meets every document, so the benchmark
may be of any size.

Defined results: items and documents with a null or blank text match
nothing; items of under five words have one shingle, the whole; null ids are
kept as they are; repeated rows are judged each; equal items match alike;
further columns of any name pass through ``clean_documents`` unread.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import repeat
from math import fsum

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import exact_id, id_values, ids_of, materialise, words

K1, B = 1.2, 0.75
SHINGLE, OVERLAP = 5, 0.8
#: Items and characters of a chunk of the index at most (a single longer item is a chunk).
CHUNK_ITEMS, CHUNK_CHARS = 4096, 8 << 20
#: Items of a block of a posting list.
BLOCK = 16
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tokens(text) -> list[bytes]:
    """Words with A-Z lower-cased; a bytes split cuts at the same ASCII white space as the word rule."""
    return text.encode("utf-8", "replace").lower().split() if isinstance(text, str) else []


def shingles(w: list[bytes]) -> set[tuple]:
    return set(zip(*(w[i:] for i in range(SHINGLE)))) if len(w) >= SHINGLE else ({tuple(w)} if w else set())


def question_answer(w: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """The words up to the last sentence, and the last sentence; one sentence alone is halved."""
    ends = [i + 1 for i, x in enumerate(w[:-1]) if x[-1:] in b".?!"]
    at = ends[-1] if ends else len(w) // 2
    return w[:at], w[at:]


class Index:
    """Inverted index of one chunk: impacts divided by the item's threshold, so that 1 is the threshold of all."""

    def __init__(self, rows, n_items: int, mean_words: float, longest: int | None = None):
        """rows: (item_id, words as text, document frequency of each distinct word in order of first use).

        ``longest``: words of the longest item of the whole benchmark, so that passages don't depend on the chunk.
        """
        parsed = sorted(((len(w), i, key, w, df) for i, (key, w, df) in enumerate(rows)), key=lambda x: x[:2])
        self.ids = [p[2] for p in parsed]
        self.words = [p[3] for p in parsed]
        self.shingles = [shingles(w) for w in self.words]
        self.longest = longest or max((len(w) for w in self.words), default=1)
        postings: dict[bytes, list] = {}
        for item, (n, _, _, w, df) in enumerate(parsed):
            tf: dict[bytes, int] = {}
            for x in w:
                tf[x] = tf.get(x, 0) + 1
            norm = K1 * (1 - B + B * n / mean_words)
            impact = {x: np.log1p((n_items - df[x] + 0.5) / (df[x] + 0.5)) * c * (K1 + 1) / (c + norm) for x, c in tf.items()}
            may_lack = int((1 - OVERLAP) * len(self.shingles[item]) + 1e-9)
            heavy = sorted(impact.values(), reverse=True)
            least = max(sum(heavy[may_lack:]), 1e-9)
            for x, v in impact.items():
                postings.setdefault(x, []).append((item, v / least))
        self.term = {x: i for i, x in enumerate(postings)}
        self.items = [[p[0] for p in v] for v in postings.values()]
        self.impacts = [[p[1] for p in v] for v in postings.values()]
        self.n_blocks = -(-len(parsed) // BLOCK)
        self.block_max = np.zeros((len(postings) + 1, max(self.n_blocks, 1)))  # the last row: words of no item
        for t, v in enumerate(postings.values()):
            for item, x in v:
                b = item // BLOCK
                self.block_max[t, b] = max(self.block_max[t, b], x)
        self.term_max = self.block_max.max(axis=1)

    def retrieve(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """(item, score) of all items with a score of 1 or more for the distinct ``terms``: block-max WAND."""
        bound = self.block_max[terms].sum(axis=0) >= 1 - 1e-9
        if not bound.any():
            return []
        live = np.append(np.flatnonzero(bound), self.n_blocks).tolist()
        found, first = [], live[0] * BLOCK
        cursors = []  # [item, position, term]
        for t in terms.tolist():
            at = bisect_left(self.items[t], first)
            if at < len(self.items[t]):
                cursors.append([self.items[t][at], at, t])
        top = self.term_max

        def move(cursor, to) -> bool:
            items = self.items[cursor[2]]
            cursor[1] = bisect_left(items, to, cursor[1])
            if cursor[1] < len(items):
                cursor[0] = items[cursor[1]]
                return True
            return False

        while cursors:
            cursors.sort()
            reach, pivot = 0.0, None
            for c in cursors:
                reach += top[c[2]]
                if reach >= 1 - 1e-9:
                    pivot = c[0]
                    break
            if pivot is None:
                break
            block = pivot // BLOCK
            if not bound[block]:
                to = live[bisect_left(live, block)] * BLOCK
                cursors = [c for c in cursors if c[0] >= to or move(c, to)]
            elif cursors[0][0] == pivot:
                score = fsum(self.impacts[c[2]][c[1]] for c in cursors if c[0] == pivot)  # whatever the terms' order in the index
                if score >= 1 - 1e-9:
                    found.append((pivot, float(score)))
                cursors = [c for c in cursors if c[0] > pivot or move(c, pivot + 1)]
            else:
                cursors = [c for c in cursors if c[0] >= pivot or move(c, pivot)]
        return found

    def matches(self, text) -> dict[int, tuple]:
        """item -> (overlap, score, first word of the passage, question's and answer's overlap), the best passage of each."""
        w = tokens(text)
        none = len(self.term)
        ids = np.array(list(map(self.term.get, w, repeat(none))), np.int64)
        step = self.longest
        starts = np.arange(0, max(len(w) - step, 1), step)
        upto = np.concatenate(([0.0], np.cumsum(self.term_max[ids])))
        ends = np.minimum(starts + 2 * step, len(w))
        best: dict[int, tuple] = {}
        # the first pivot test of WAND for all passages at once: without a reach of 1 there is no pivot
        for a, b in zip(starts[upto[ends] - upto[starts] >= 1 - 1e-6], ends[upto[ends] - upto[starts] >= 1 - 1e-6]):
            distinct = np.unique(ids[a:b])
            hits = self.retrieve(distinct[distinct < none])
            here = shingles(w[a:b]) if hits else None
            for item, score in hits:
                own = self.shingles[item]
                if len(self.words[item]) < SHINGLE:
                    k = len(self.words[item])
                    share = float(tuple(self.words[item]) in set(zip(*(w[a:b][i:] for i in range(k)))))
                    q = r = share
                else:
                    share = len(own & here) / len(own)
                    q, r = (self._part(x, w[a:b], here) for x in question_answer(self.words[item]))
                if share >= OVERLAP and q > 0 and r > 0 and best.get(item, (0,))[0] < share:
                    best[item] = (share, score, int(a), q, r)
        return best

    @staticmethod
    def _part(part: list[bytes], passage: list[bytes], here: set) -> float:
        """Share of the part's shingles in the passage; of its words, if it is shorter than a shingle."""
        if len(part) >= SHINGLE:
            own = shingles(part)
            return len(own & here) / len(own)
        return len(set(part) & set(passage)) / max(len(set(part)), 1)


def index_chunks(benchmark: DataFrame):
    """The index, chunk by chunk, each within CHUNK_ITEMS and CHUNK_CHARS."""
    lower = F.translate("text", ASCII_UPPER, ASCII_LOWER)
    items = materialise(benchmark.select(F.col("item_id").alias("item"), words(lower).alias("w"), F.length("text").alias("chars"))
                        .where(F.size("w") > 0).distinct())
    n, mean, chars, longest = items.agg(F.count("*"), F.avg(F.size("w")), F.sum("chars"), F.max(F.size("w"))).first()
    if not n:
        return
    df = items.select(F.explode(F.array_distinct("w")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    chunks = max(-(-n // (CHUNK_ITEMS // 2)), -(-chars // (CHUNK_CHARS // 2)))
    chunk = F.pmod(F.xxhash64("item", "w"), F.lit(chunks))
    terms = items.withColumn("chunk", chunk)
    for c in range(chunks):
        own = terms.where(F.col("chunk") == c) if chunks > 1 else terms
        counts = {r[0].encode(): r[1] for r in
                  own.select(F.explode("w").alias("term")).distinct().join(df, "term").collect()}
        yield Index([(r[0], [x.encode("utf-8", "replace") for x in r[1]], counts) for r in own.select("item", "w").collect()], n, mean, longest)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and item that contaminates it."""
    columns = "doc_id long, item_id long, overlap double, question_overlap double, answer_overlap double, bm25 double, word long"
    found = None
    for index in index_chunks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches, shared=shared):
            index = shared.value
            for pdf in batches:
                rows = [(key, index.ids[item], share, q, r, score, a) for key, text in zip(ids_of(pdf, "doc_id"), pdf["text"])
                        for item, (share, score, a, q, r) in sorted(index.matches(text).items())]
                out = pd.DataFrame(rows, columns=[x.split()[0] for x in columns.split(", ")])
                yield out.assign(doc_id=id_values(r[0] for r in rows), item_id=id_values(r[1] for r in rows))

        part = docs.select(*exact_id("doc_id"), "text").mapInPandas(search, columns)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], columns) if found is None else found


def _is_clean(shared):
    @F.pandas_udf(T.BooleanType())
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not shared.value.matches(x) for x in texts], dtype=bool)
    return clean


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no item contaminates, with the columns they came with."""
    for index in index_chunks(benchmark):
        docs = docs.where(_is_clean(docs.sparkSession.sparkContext.broadcast(index))("text"))
    return docs
