"""Suffix-array dedup: removes bytes that repeat from a document with a smaller id.

A byte goes if a string of WIDTH bytes that covers it also starts in a
document with a smaller id.  The candidates (see ``repeats``) are sorted as
suffixes by a merge sort whose comparisons look up the longest common
extension by binary search over polynomial prefix hashes: a comparison of
two suffixes takes logarithmically many steps.  The common extensions of
neighbours are then verified byte by byte; where a hash collision shows, the
group is sorted again by its bytes.

Defined results: a null or empty text has no bytes and nothing removed; a
null id comes after all others; rows of equal id don't remove from each other; texts under WIDTH
bytes stay whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .repeats import Sequences, least_of_class, runs, shared_windows
from .sequences import Block, id_column, powers

WIDTH, ANCHOR = 50, 20


def suffix_sort(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): rows sorted by group and bytes, and how far each agrees with the row before it in its group.

    Merge sort within the groups; ``group`` must be sorted.
    """
    n, depth = rows.shape
    up, _ = powers(depth)
    prefix = np.zeros((n, depth + 1), np.uint64)
    np.cumsum((rows.astype(np.uint64) + np.uint64(1)) * up[:depth], axis=1, out=prefix[:, 1:])
    flat_prefix, flat_rows = prefix.ravel(), rows.ravel()
    step = 1 << max(depth.bit_length() - 1, 0)

    def extension(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common prefix by binary search over the prefix hashes."""
        agree = np.zeros(len(a), np.int64)
        size = step
        while size:
            longer = agree + size
            fits = longer <= depth
            longer = np.minimum(longer, depth)
            same = fits & (flat_prefix[a * (depth + 1) + longer] == flat_prefix[b * (depth + 1) + longer])
            agree = np.where(same, longer, agree)
            size //= 2
        return agree

    def before(a: np.ndarray, b: np.ndarray, on_tie: np.ndarray) -> np.ndarray:
        """Row a comes before row b; ``on_tie`` where they are equal."""
        agree = extension(a, b)
        at = np.minimum(agree, depth - 1)
        return np.where(agree == depth, on_tie, flat_rows[a * depth + at] < flat_rows[b * depth + at])

    first = runs(group)
    size = np.diff(np.append(first, n))
    start, count = np.repeat(first, size), np.repeat(size, size)
    order, run = np.arange(n), 1
    active = np.flatnonzero(count > 1)
    while len(active):
        # each row of a run of ``run`` rows finds its place in the neighbouring run
        base, within = start[active], active - start[active]
        mine = within // run
        low = np.minimum((mine ^ 1) * run, count[active])
        high = np.minimum(low + run, count[active])
        rank, upper = low.copy(), high.copy()
        right = (mine & 1).astype(bool)  # equal rows of the left run stay before those of the right one
        me = order[active]
        while (todo := np.flatnonzero(rank < upper)).size:
            middle = (rank[todo] + upper[todo]) // 2
            less = before(order[base[todo] + middle], me[todo], right[todo])
            rank[todo] = np.where(less, middle + 1, rank[todo])
            upper[todo] = np.where(less, upper[todo], middle)
        place = base + np.minimum(mine, mine ^ 1) * run + (within - mine * run) + (rank - low)
        merged = order.copy()
        merged[place] = me
        order, run = merged, run * 2
        active = active[count[active] > run]
    common = _verified(rows, group, order)
    return order, common


def _verified(rows: np.ndarray, group: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common bytes of neighbours, compared as bytes; groups that a hash collision left unsorted are sorted again in ``order``."""
    depth = rows.shape[1]

    def compare():
        differ = rows[order[1:]] != rows[order[:-1]]
        agree = np.where(differ.any(axis=1), np.argmax(differ, axis=1), depth)
        at = np.minimum(agree, depth - 1)
        same_group = group[order[1:]] == group[order[:-1]]
        wrong = same_group & (agree < depth) & (rows[order[1:], at] < rows[order[:-1], at])
        return np.concatenate(([0], np.where(same_group, agree, 0))), np.flatnonzero(wrong)

    common, wrong = compare()
    if len(wrong):
        for g in np.unique(group[order[wrong]]):
            own = np.flatnonzero(group == g)
            order[own] = own[np.lexsort(rows[own].T[::-1])]
        common, _ = compare()
    return common


def solve(contexts: np.ndarray, anchor: np.ndarray, least: np.ndarray, reach: int, width: int):
    """For each offset of the anchor in a window, the least id among rows with the same window there."""
    by_anchor = np.argsort(anchor, kind="stable")
    group_of = anchor[by_anchor]
    right, left = contexts[by_anchor, reach:], np.ascontiguousarray(contexts[by_anchor, :reach][:, ::-1])
    r_order, r_common = suffix_sort(np.ascontiguousarray(right), group_of)
    l_order, l_common = suffix_sort(left, group_of)
    head_r, head_l = np.zeros(len(anchor), bool), np.zeros(len(anchor), bool)
    group_first = runs(group_of)
    values = least[by_anchor]
    for offset in range(reach + 1):
        # a class agrees with the row before it in the suffix array as far as the window reaches
        head_r[:] = r_common < width - offset
        head_l[:] = l_common < offset
        head_r[group_first] = head_l[group_first] = True
        right_class, left_class = np.empty(len(anchor), np.int64), np.empty(len(anchor), np.int64)
        right_class[r_order], left_class[l_order] = np.cumsum(head_r), np.cumsum(head_l)
        both = right_class * (len(anchor) + 1) + left_class
        smallest = np.empty_like(least)
        smallest[by_anchor] = least_of_class(np.argsort(both, kind="stable"), (both,), values)
        yield offset, smallest


def read(block: Block) -> Sequences:
    return Sequences(block, block.bytes, block.starts)


def finish(seq: Sequences, covered: np.ndarray) -> pd.DataFrame:
    rows = []
    data = seq.tokens
    for a, b in zip(seq.starts[:-1], seq.starts[1:]):
        gone = covered[a:b]
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()) if gone.any() else 0
        kept = data[a:b][~gone] if spans else data[a:b]
        rows.append((int(b - a), int(gone.sum()) if spans else 0, spans, hashlib.sha256(kept.tobytes()).hexdigest(), kept.tobytes()))
    out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    out.insert(0, "doc_id", id_column(seq.block))
    return out


FORM = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, texts: bool = True, **how) -> DataFrame:
    """Per document row: counts, digest and (``texts``) the kept bytes."""
    def end(seq: Sequences, covered: np.ndarray) -> pd.DataFrame:
        out = finish(seq, covered)
        return out if texts else out.drop(columns="kept")
    return shared_windows(docs, read, width, anchor, solve, end, FORM + ", kept binary" * texts, **how)
