"""LM scoring: a Katz back-off bigram model with Good-Turing discounts.

Tokens are lower-cased (A-Z) words and an end token per document; the end
token is also the history of a document's first token.  Counts up to CUT are
discounted by Good-Turing estimates from the counts of counts; what is taken
away goes to what has not been seen.  Every history's back-off weight is the
mass left over divided by the unigram mass of its unseen words, from exact
integer sums, so each distribution adds up to one: unigrams over the known
words and one class of unknown words, bigrams over the same.

The count tables are partitioned by hash: a row per bucket of the unigram and
of the bigram table.  Blocks of documents send a bucket their distinct
n-grams with counts and get back totals, so a frequent n-gram is sent once
per block; a frequent history is dealt over as many buckets as its share
needs, and its sums are added up by the asker.

Defined results: a null or blank text is its end token; a null id counts as
the empty string for the hold-out; repeated rows count each; without training
text every token has probability 1 of being unknown; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .repeats import runs
from .sequences import TABLE, Block, Words, answer, ask, bucket_count, conclude, id_column, mix, pack, small, unsqueeze

CUT = 5
BLOCK_BYTES = 8 << 20
END = np.uint64(0x5851F42D4C957F2D)
FOLDS, HELD_OUT = 7, 2


def held_out(block: Block) -> np.ndarray:
    names = (b"" if none else str(i).encode() for i, none in zip(block.ids.tolist(), block.no_id.tolist()))
    return np.array([zlib.crc32(x) % FOLDS == HELD_OUT for x in names], bool)


class Tokens:
    """A block's token stream: the words of each document and then END."""

    def __init__(self, block: Block):
        words = Words(block, lower=True)
        per_doc = np.diff(words.starts) + 1
        self.starts = np.concatenate(([0], np.cumsum(per_doc)))
        self.doc = np.repeat(np.arange(len(per_doc)), per_doc)
        stream = np.empty(self.starts[-1], np.uint64)
        ends = self.starts[1:] - 1
        inner = np.ones(len(stream), bool)
        inner[ends] = False
        stream[inner], stream[ends] = words.hash, END
        self.types, self.type = np.unique(stream, return_inverse=True)
        self.out = held_out(block)
        self.train = ~self.out[self.doc]
        self.before = np.empty_like(self.type)  # the type before, END's at a document's start
        self.before[1:] = self.type[:-1]
        if len(stream):
            self.before[self.starts[:-1]] = np.searchsorted(self.types, END)

    def pairs(self):
        """Distinct (history, word) types, ascending: both, the training count, and each token's pair."""
        key, of = np.unique(self.before * np.int64(max(len(self.types), 1)) + self.type, return_inverse=True)
        count = np.bincount(of, weights=self.train, minlength=len(key)).astype(np.int64)
        return key // max(len(self.types), 1), key % max(len(self.types), 1), count, of


def discounts(of_counts: np.ndarray) -> np.ndarray:
    """Good-Turing factors for the counts 0..CUT + 1 (1 for the last); ``of_counts[r]`` n-grams have count r.

    Where the estimate is not between 0 and 1, as on small data, half a count is taken off.
    """
    n = of_counts.astype(float)
    out = np.ones(CUT + 2)
    common = (CUT + 1) * n[CUT + 1] / n[1] if n[1] else 1.0
    for r in range(1, CUT + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common != 1 else 0.0
        out[r] = d if 0 < d < 1 else 1 - 0.5 / r
    return out


class Discounted:
    """Discounted mass from sums of counts by class: ``sums[:, r]`` adds up the counts r, column 0 all above CUT."""

    def __init__(self, factors: np.ndarray):
        self.factors = factors
        self.by_class = np.concatenate(([1.0], factors[1:CUT + 1]))

    def mass(self, sums: np.ndarray) -> np.ndarray:
        return sums @ self.by_class

    def count(self, c: np.ndarray) -> np.ndarray:
        return c * self.factors[np.minimum(c, CUT + 1)]


def by_class(count: np.ndarray) -> np.ndarray:
    return np.where(count > CUT, 0, count)


def class_sums(count: np.ndarray, value: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """(n, CUT + 1) sums of ``value`` by group and class of ``count``."""
    flat = np.bincount(group * (CUT + 1) + by_class(count), weights=value, minlength=n * (CUT + 1))
    return np.rint(flat).astype(np.int64).reshape(n, CUT + 1)


class Unigrams:
    """The unigram distribution: known words, and one class of unknown ones."""

    def __init__(self, total: int, of_counts: np.ndarray, sums: np.ndarray):
        self.total, self.types = total, 0
        self.discounted = Discounted(discounts(of_counts))
        mass = float(self.discounted.mass(sums)) if total else 0.0
        # without a discounted count one more is added, the unknown word's
        self.scale = total if total - mass > 0 else total + 1
        self.unknown = (self.scale - mass) / self.scale

    def probability(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.discounted.count(c) / self.scale, self.unknown)

    def mass(self, sums: np.ndarray) -> np.ndarray:
        return self.discounted.mass(sums) / self.scale


def steps(x: np.ndarray) -> np.ndarray:
    """An ascending array as its differences."""
    return small(np.diff(x, prepend=0))


def unstep(x: np.ndarray) -> np.ndarray:
    return np.cumsum(x.astype(np.int64))


def _figures(said: DataFrame, columns: int) -> np.ndarray:
    """The buckets' own figures, added up by Spark; one row reaches the driver."""
    def read(batches):
        for pdf in batches:
            yield pd.DataFrame([[int(x) for x in unsqueeze(m)["figures"]] for m in pdf["message"]], columns=names)
    names = [f"f{i}" for i in range(columns)]
    each = said.where(F.col("block") == TABLE).mapInPandas(read, ", ".join(f"{x} long" for x in names))
    return np.array([x or 0 for x in each.agg(*[F.sum(x) for x in names]).first()], np.int64)


def _of_counts(total: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(total, CUT + 2), minlength=CUT + 3)[1:CUT + 2]


def _buckets(h: np.ndarray, n: int):
    bucket = (mix(h) % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    for part in np.split(order, runs(bucket[order])[1:]) if len(order) else []:
        yield int(bucket[part[0]]), part


def score_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    blocks = pack(docs, block_bytes)
    n = bucket_count(blocks)

    def unigrams_of(block: Block, _):
        t = Tokens(block)
        count = np.bincount(t.type, weights=t.train, minlength=len(t.types)).astype(np.int64)
        for b, part in _buckets(t.types, n):
            yield b, (t.types[part], small(count[part]))

    def unigram_table(messages: list):
        word = np.concatenate([m[0] for m in messages])
        order = np.argsort(word, kind="stable")
        first = runs(word[order])
        total = np.add.reduceat(np.concatenate([m[1].astype(np.int64) for m in messages])[order], first)
        rank = np.empty(len(word), np.int64)
        rank[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(word))))
        cuts = np.cumsum([len(m[0]) for m in messages])[:-1]
        answers = [(small(total[r]), small(r)) for r in np.split(rank, cuts)]
        seen = total[total > 0]
        figures = [len(seen), int(seen.sum()), *_of_counts(seen), *class_sums(seen, seen, np.zeros(len(seen), np.int64), 1)[0]]
        return answers, {"figures": figures, "word": word[order][first], "count": small(total)}

    unigram = materialise(answer(ask(blocks, None, unigrams_of), unigram_table))
    figures = _figures(unigram, 2 + 2 * (CUT + 1))
    types, train_tokens = (int(x) for x in figures[:2])
    of_counts, sums = figures[2:2 + CUT + 1], figures[2 + CUT + 1:]
    base = Unigrams(train_tokens, np.concatenate(([0], of_counts)), sums)

    def known(t: Tokens, answers: dict):
        """Count and number of each type of the block, from the unigram table; buckets number their words in turn."""
        count, number = np.zeros(len(t.types), np.int64), np.zeros(len(t.types), np.int64)
        for b, part in _buckets(t.types, n):
            total, rank = answers[b]
            count[part], number[part] = total, rank.astype(np.int64) * n + b
        return count, number

    def spread(count: np.ndarray) -> np.ndarray:
        """Buckets that a history is dealt over: its share of all tokens, in buckets."""
        return 1 + count * n // max(train_tokens, 1)

    def requests(t: Tokens, count: np.ndarray, number: np.ndarray):
        """(bucket, its histories, its pairs) of the block's questions; both as positions.

        Only pairs of known words are asked for; a history is asked for in all of its buckets.
        """
        h, w, c, of = t.pairs()
        asked = np.flatnonzero((count[h] > 0) & (count[w] > 0))
        histories = np.unique(h)
        histories = histories[count[histories] > 0]
        deal = spread(count)
        share = (mix(number[w[asked]].astype(np.uint64) + np.uint64(1)) % deal[h[asked]].astype(np.uint64)).astype(np.int64)
        place = lambda at, s: (mix((number[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + s.astype(np.uint64)) % np.uint64(n)).astype(np.int64)
        all_h = np.repeat(histories, deal[histories])
        all_s = np.arange(len(all_h)) - np.repeat(np.cumsum(deal[histories]) - deal[histories], deal[histories])
        h_bucket, p_bucket = place(all_h, all_s), place(h[asked], share)
        h_order, p_order = np.lexsort((all_s, number[all_h], h_bucket)), np.lexsort((number[w[asked]], share, number[h[asked]], p_bucket))
        h_cuts, p_cuts = (np.searchsorted(x, np.arange(n + 1)) for x in (h_bucket[h_order], p_bucket[p_order]))
        for b in np.unique(h_bucket).tolist():
            own = h_order[h_cuts[b]:h_cuts[b + 1]]
            pairs = p_order[p_cuts[b]:p_cuts[b + 1]]
            keys = number[all_h[own]] * np.int64(n + 1) + all_s[own]
            size = np.bincount(np.searchsorted(keys, number[h[asked[pairs]]] * np.int64(n + 1) + share[pairs]), minlength=len(own))
            yield b, all_h[own], all_s[own], size, asked[pairs], (h, w, c, of)

    def bigrams_of(block: Block, answers: dict):
        t = Tokens(block)
        count, number = known(t, answers)
        for b, hs, ss, size, pairs, (_, w, c, _) in requests(t, count, number):
            # histories and words ascend, so their numbers are sent as steps; a word's number and count are sent once
            word, one, which = np.unique(number[w[pairs]], return_index=True, return_inverse=True)
            yield b, (steps(number[hs]), small(ss), small(size), small(which), small(c[pairs]), steps(word), small(count[w[pairs[one]]]))

    def bigram_table(messages: list):
        hist, part = np.concatenate([unstep(m[0]) for m in messages]), np.concatenate([m[1].astype(np.int64) for m in messages])
        size, count = (np.concatenate([m[i].astype(np.int64) for m in messages]) for i in (2, 4))
        word = np.concatenate([unstep(m[5])[m[3]] for m in messages])
        of_word = np.concatenate([m[6].astype(np.int64)[m[3]] for m in messages])
        order = np.lexsort((part, hist))
        first = runs(hist[order], part[order])
        group = np.empty(len(hist), np.int64)
        group[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(hist))))
        of_pair = np.repeat(group, size)
        p_order = np.lexsort((word, of_pair))
        p_first = runs(of_pair[p_order], word[p_order])
        total = np.add.reduceat(count[p_order], p_first) if len(p_first) else np.zeros(0, np.int64)
        every = np.empty(len(word), np.int64)
        every[p_order] = np.repeat(total, np.diff(np.append(p_first, len(word))))
        at = p_order[p_first[total > 0]]  # one row per pair seen in training
        seen = total[total > 0]
        k = len(first)
        sums = np.concatenate((class_sums(seen, seen, of_pair[at], k), class_sums(of_word[at], of_word[at], of_pair[at], k)), axis=1)
        h_cuts, p_cuts = np.cumsum([len(m[0]) for m in messages])[:-1], np.cumsum([len(m[3]) for m in messages])[:-1]
        answers = [(small(x), [small(sums[g, i]) for i in range(sums.shape[1])])
                   for x, g in zip(np.split(every, p_cuts), np.split(group, h_cuts))]
        # the bucket's part of the bigram table: by history, its words ascending
        table = {"figures": _of_counts(seen), "history": steps(hist[order][first]), "size": small(np.bincount(of_pair[at], minlength=k)),
                 "word": small(word[at]), "count": small(seen)}
        return answers, table

    to_blocks = F.col("block") != TABLE
    bigram = materialise(answer(ask(blocks, unigram.where(to_blocks), bigrams_of), bigram_table))
    pair = Discounted(discounts(np.concatenate(([0], _figures(bigram, CUT + 1)))))

    def end(block: Block, answers: dict) -> pd.DataFrame:
        t = Tokens(block)
        one, two = ({b: m for (k, b), m in answers.items() if k == kind} for kind in (1, 2))
        count, number = known(t, one)
        sums = np.zeros((len(t.types), 2 * (CUT + 1)), np.int64)
        total = None
        for b, hs, _, _, pairs, (h, w, c, of) in requests(t, count, number):
            if total is None:
                total = np.zeros(len(h), np.int64)
            per_pair, columns = two[b]
            total[pairs] = per_pair
            np.add.at(sums, hs, np.stack([x.astype(np.int64) for x in columns], axis=1))
        unigram_p = base.probability(count)
        scale, weight = backoff(count, sums, pair, base)
        if total is None:  # no history is known
            h, w, c, of = t.pairs()
            total = np.zeros(len(h), np.int64)
        p = np.where(total > 0, pair.count(total) / scale[h], weight[h] * unigram_p[w])
        log_p, base_p = np.log10(p)[of], np.log10((count + 1) / (train_tokens + types + 1))[t.type]
        out = pd.DataFrame({"doc_id": id_column(block), "held_out": t.out, "n_tokens": np.diff(t.starts),
                            "n_known": np.add.reduceat((count > 0)[t.type].astype(np.int64), t.starts[:-1])})
        out["train_tokens"] = train_tokens
        out["base_score"], out["score"] = (np.add.reduceat(x, t.starts[:-1]) for x in (base_p, log_p))
        return out

    told = [x.where(to_blocks).withColumn("kind", F.lit(kind)) for kind, x in ((1, unigram), (2, bigram))]
    return conclude(blocks, told[0].unionByName(told[1]), end,
                    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def backoff(count: np.ndarray, sums: np.ndarray, pair: Discounted, base: Unigrams) -> tuple[np.ndarray, np.ndarray]:
    """(scale, weight) of each history from its sums over seen words: of pair counts by class, and of their word counts.

    P(w | h) is the discounted count / scale for a seen pair, weight * P(w) otherwise.  An unseen history has
    weight 1; one without any discounted count gets one count more, for all its unseen words.
    """
    mass = pair.mass(sums[:, :CUT + 1])
    scale = np.where(count - mass > 1e-9 * np.maximum(count, 1), count, count + 1).astype(float)
    weight = np.where(count > 0, (scale - mass) / scale / (1 - base.mass(sums[:, CUT + 1:])), 1.0)
    return scale, weight
