"""Substring dedup by prefix-partitioned suffix trees: removes words that repeat from a document with a smaller id.

A word goes if a window of WIDTH words that covers it also starts in a
document with a smaller id.  The suffixes of the texts are split by their
prefixes: those that start with the same ANCHOR words form a group (see
``repeats`` for which suffixes suffice), and a group that would outgrow memory
is split on by prefixes of the whole window's length.  A group's suffixes are
built into a tree, from the common prefix down, a word at a time; suffixes
that have gone alone down a branch are leaves and are left there.  The inner
nodes at a window's depth are the repeats, and the least id below a node
decides what is removed.

Words are compared by 64-bit hashes of their bytes, each word of a window on its own.

Defined results: a null or blank text has no words; a null id comes after all
others; rows of equal id don't remove from each other; texts under WIDTH words stay whole; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .repeats import Sequences, least_of_class, runs, shared_windows
from .sequences import Block, Words, id_column

WIDTH, ANCHOR = 50, 20


class SuffixTree:
    """The tree of a partition's suffixes: ``levels[depth]`` has the node that each suffix passes at that depth.

    A node's number is the first of its suffixes, which no other node of the depth has.
    """

    def __init__(self, suffixes: np.ndarray, group: np.ndarray):
        inner = np.argsort(group, kind="stable")
        node = np.empty(len(group), np.int64)
        self.levels = []
        for depth in range(-1, suffixes.shape[1]):
            if len(inner):
                if depth < 0:
                    first = runs(group[inner])
                else:
                    word = suffixes[inner, depth]
                    by = np.lexsort((word, node[inner]))
                    inner, word = inner[by], word[by]
                    first = runs(node[inner], word)
                size = np.diff(np.append(first, len(inner)))
                node = node.copy()
                node[inner] = np.repeat(np.minimum.reduceat(inner, first), size)
                inner = inner[np.repeat(size > 1, size)]
            self.levels.append(node)


def solve(contexts: np.ndarray, anchor: np.ndarray, least: np.ndarray, reach: int, width: int):
    """For each offset of the anchor in a window, the least id among rows with the same window there.

    A window is a node of the tree of what follows the prefix and one of the
    tree of what comes before it, read backwards.
    """
    after = SuffixTree(contexts[:, reach:], anchor)
    before = SuffixTree(contexts[:, :reach][:, ::-1], anchor)
    for offset in range(reach + 1):
        keys = (after.levels[width - offset], before.levels[offset])
        yield offset, least_of_class(np.lexsort(keys), keys, least)


def read(block: Block) -> Sequences:
    words = Words(block)
    seq = Sequences(block, words.hash, words.starts)
    seq.words = words
    return seq


def finish(seq: Sequences, covered: np.ndarray) -> pd.DataFrame:
    rows, words, data = [], seq.words, seq.block.bytes
    for a, b in zip(seq.starts[:-1], seq.starts[1:]):
        stay = np.arange(a, b)[~covered[a:b]]
        kept = b" ".join([data[i:j].tobytes() for i, j in zip(words.first[stay].tolist(), words.end[stay].tolist())])
        rows.append((int(b - a), int(b - a) - len(stay), hashlib.sha256(kept).hexdigest(), kept))
    out = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "kept"])
    out.insert(0, "doc_id", id_column(seq.block))
    return out


FORM = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def remove_repeats(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, texts: bool = True, **how) -> DataFrame:
    """Per document row: counts, digest and (``texts``) the kept words joined by spaces, UTF-8."""
    def end(seq: Sequences, covered: np.ndarray) -> pd.DataFrame:
        out = finish(seq, covered)
        return out if texts else out.drop(columns="kept")
    return shared_windows(docs, read, width, anchor, solve, end, FORM + ", kept binary" * texts, **how)
