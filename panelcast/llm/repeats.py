"""Windows that also start in a document with a smaller id: what the two substring deduplications share.

A text is a sequence of tokens (bytes, or hashes of words).  Of every window
of ``W`` tokens the ``k`` tokens with the least hash are its anchor, so equal
windows have their anchors at equal places.  First, buckets of anchor hashes
tell the blocks which anchors occur in more than one document.  Then the
blocks send the surroundings of those (everything a window with that anchor
can reach), equal ones once, with the places where they stand.  The bucket
finds, for each place of an anchor in the window, the classes of equal
windows and the smallest id of each, by the method of the operator, and sends
back the covered stretches.  Every window has its anchor in all its
occurrences, so none is missed, and classes are of whole windows, so none is
wrong.

An anchor that stands in very many places (a line that a third of all
documents hold) isn't sent to one bucket: its windows are sent each to the
bucket of their own hash, equal ones once per block.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import materialise
from .sequences import Block, answer, ask, bucket_count, conclude, gram_hashes, mix, pack, powers, small

#: An anchor with more places than this is split by whole windows.
HOT = 50_000
CHUNK = 1 << 17
BLOCK_BYTES = 4 << 20
ALONE, SHARED, SPLIT = 0, 1, 2


def _slide(op, x: np.ndarray, w: int) -> np.ndarray:
    """``op`` over each run of ``w`` values, by doubling."""
    size = 1
    n = len(x) - w + 1
    while size * 2 <= w:
        x = op(x[:-size], x[size:])
        size *= 2
    return op(x[:n], x[w - size:w - size + n]) if size < w else x[:n]


def anchors(tokens: np.ndarray, starts: np.ndarray, width: int, k: int) -> tuple[np.ndarray, ...]:
    """(position, hash, first window, last window) of all runs of tokens that are the least of some window.

    The windows, by their first tokens, lie within one document; those that
    have a run as their least are neighbours.
    """
    n, w = len(tokens), width - k + 1
    none = np.zeros(0, np.int64)
    if n < width:
        return none, np.zeros(0, np.uint64), none, none
    valid = np.zeros(n + 1, np.int8)  # windows that start here lie in one document
    size = np.diff(starts)
    long = size >= width
    np.add.at(valid, starts[:-1][long], 1)
    np.add.at(valid, (starts[1:] - width + 1)[long], -1)
    valid = np.cumsum(valid[:-1]).astype(bool)[:n - width + 1]
    found, done = [], 0
    while done < len(valid):
        # windows [done, to); their runs [done, to + w - 1)
        to = min(done + CHUNK, len(valid))
        h = gram_hashes(tokens[done:to + width - 1].astype(np.uint64) + np.uint64(1), k) | np.uint64(1)
        least = np.where(valid[done:to], _slide(np.minimum, h, w), np.uint64(0))
        edge = np.zeros(w - 1, np.uint64)
        padded = np.concatenate((edge, least, edge))
        at = np.flatnonzero(_slide(np.maximum, padded, w) == h)  # the most over the windows that hold a run
        mine = np.lib.stride_tricks.sliding_window_view(padded, w)[at] == h[at][:, None]
        first = at + done - (w - 1) + np.argmax(mine, axis=1)
        found.append((at + done, h[at], first, at + done - np.argmax(mine[:, ::-1], axis=1)))
        done = to
    at, h, first, last = (np.concatenate(x) for x in zip(*found))
    if len(found) > 1:  # runs at the chunks' edges were seen twice
        order = np.argsort(at, kind="stable")
        new = runs(at[order])
        if len(new):
            first, last = np.minimum.reduceat(first[order], new), np.maximum.reduceat(last[order], new)
        at, h = at[order][new], h[order][new]
    return at, h, first, last


def runs(*keys: np.ndarray) -> np.ndarray:
    """First positions of the runs of equal keys in sorted arrays."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for x in keys:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def least_of_class(order: np.ndarray, keys: tuple, values: np.ndarray) -> np.ndarray:
    """For each row the least value among the rows with the same keys; ``order`` sorts the keys."""
    first = runs(*(x[order] for x in keys))
    least = np.minimum.reduceat(values[order], first)
    out = np.empty_like(values)
    out[order] = np.repeat(least, np.diff(np.append(first, len(order))))
    return out


class Sequences:
    """A block as tokens: values, each document's first token, and what to send of a stretch of tokens."""

    def __init__(self, block: Block, tokens: np.ndarray, starts: np.ndarray):
        self.block, self.tokens, self.starts = block, tokens, starts

    def around(self, at: np.ndarray, before: int, after: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Tokens [at - before, at + after); those outside [at - left, at + right) are the largest value."""
        fill = np.iinfo(self.tokens.dtype).max
        padded = np.concatenate((np.full(before, fill, self.tokens.dtype), self.tokens, np.full(after, fill, self.tokens.dtype)))
        rows = np.lib.stride_tricks.sliding_window_view(padded, before + after)[at]
        place = np.arange(-before, after)
        return np.where((place >= -left[:, None]) & (place < right[:, None]), rows, fill)


def _sorted_anchors(seq: Sequences, width: int, k: int):
    at, h, first, last = anchors(seq.tokens, seq.starts, width, k)
    owner = seq.block.ids[np.searchsorted(seq.starts, at, "right") - 1]
    order = np.lexsort((owner, h))
    h = h[order]
    return at[order], h, owner[order], runs(h), first[order], last[order]


def _short(h: np.ndarray) -> np.ndarray:
    """48 bits of each hash, as bytes: two anchors that agree in them only cost a comparison."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def _long(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), 8), np.uint8)
    out[:, :6] = x
    return out.view("<u8").ravel()


def _by_bucket(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(20)) % np.uint64(n)).astype(np.int64)


def equal_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an order that puts equal rows together, the first of each run), comparing whole rows."""
    flat = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel()
    order = np.argsort(flat, kind="stable")
    rows = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return order, np.flatnonzero(new)


def shared_windows(docs: DataFrame, read: Callable[[Block], Sequences], width: int, k: int,
                   solve: Callable[..., tuple[np.ndarray, np.ndarray]], finish: Callable[[Sequences, np.ndarray], pd.DataFrame],
                   form: str, hot: int = HOT) -> DataFrame:
    """``finish(sequences, covered)`` of every block; ``covered`` marks the tokens of repeated windows.

    ``solve(contexts, group, least, left, right)`` gets rows of tokens around an
    anchor, the anchor's number, and the least id of each row; it yields for
    each offset the least id of all rows with the same window.
    """
    blocks = pack(docs, BLOCK_BYTES)
    n = bucket_count(blocks)
    reach = width - k

    def offer(block: Block, _):
        _, h, owner, first, _, _ = _sorted_anchors(read(block), width, k)
        if not len(first):
            return
        last = np.append(first[1:], len(h)) - 1
        count = np.minimum(last - first + 1, 255).astype(np.uint8)
        several = owner[first] != owner[last]
        u = h[first]
        bucket = _by_bucket(u, n)
        order = np.argsort(bucket, kind="stable")
        for at in np.split(order, runs(bucket[order])[1:]):
            yield int(bucket[at[0]]), (_short(u[at]), count[at], several[at])

    def compare(messages: list) -> tuple[list, None]:
        u = np.concatenate([_long(m[0]) for m in messages])
        order = np.argsort(u, kind="stable")
        first = runs(u[order])
        size = np.diff(np.append(first, len(u)))
        count = np.add.reduceat(np.concatenate([m[1] for m in messages]).astype(np.int64)[order], first)
        several = np.logical_or.reduceat(np.concatenate([m[2] for m in messages])[order], first) | (size > 1)
        state = np.empty(len(u), np.int8)
        state[order] = np.repeat(np.where(several, np.where(count > hot, SPLIT, SHARED), ALONE).astype(np.int8), size)
        parts = np.split(state, np.cumsum([len(m[0]) for m in messages])[:-1])
        return [x if x.any() else None for x in parts], None

    def send(block: Block, states: dict):
        seq = read(block)
        at, h, owner, first, low, high = _sorted_anchors(seq, width, k)
        bucket = _by_bucket(h[first], n)
        state = np.zeros(len(first), np.int8)
        order = np.argsort(bucket, kind="stable")
        for own in np.split(order, runs(bucket[order])[1:]) if len(order) else []:
            if int(bucket[own[0]]) in states:
                state[own] = states[int(bucket[own[0]])]
        per = np.repeat(state, np.diff(np.append(first, len(h))))
        out: dict[int, list] = {}
        # equal surroundings are sent once, with all their places
        held = per == SHARED
        p, a, o = at[held], h[held], owner[held]
        if len(p):
            around = seq.around(p, reach, width, p - low[held], high[held] + width - p)
            for b, part in _shares(_by_bucket(a, n)):
                order, new = equal_rows(around[part])
                part = part[order]
                size = np.diff(np.append(new, len(part)))
                out.setdefault(b, [None, None])[0] = (around[part[new]], small(size), small(p[part]), small(o[part]))
        held = per == SPLIT
        if held.any():
            low, high = low[held], high[held]
            begin = np.unique(np.repeat(low, high - low + 1) + np.concatenate([np.arange(x) for x in (high - low + 1).tolist()]))
            size = np.full(len(begin), width)
            whole = seq.around(begin, 0, width, 0 * size, size)
            up, _ = powers(width)
            sums = mix(((whole.astype(np.uint64) + np.uint64(1)) * up[:width]).sum(axis=1, dtype=np.uint64))
            own = seq.block.ids[np.searchsorted(seq.starts, begin, "right") - 1]
            for b, part in _shares(_by_bucket(sums, n)):
                order, new = equal_rows(whole[part])
                part = part[order]
                size = np.diff(np.append(new, len(part)))
                out.setdefault(b, [None, None])[1] = (whole[part[new]], small(size), small(begin[part]), small(own[part]))
        for b, x in out.items():
            yield b, x

    def cover(messages: list) -> tuple[list, None]:
        spans: list[list] = [[] for _ in messages]
        held = [(i, m[0]) for i, m in enumerate(messages) if m[0]]
        if held:
            sizes, place, owner = (np.concatenate([m[x].astype(np.int64) for _, m in held]) for x in (1, 2, 3))
            row = np.repeat(np.arange(len(sizes)), sizes)
            sender = np.repeat([i for i, _ in held], [len(m[2]) for _, m in held])
            least = np.minimum.reduceat(owner, np.cumsum(sizes) - sizes)
            contexts = np.concatenate([m[0] for _, m in held])
            up, _ = powers(k)
            anchor = mix(((contexts[:, reach:width].astype(np.uint64) + np.uint64(1)) * up[:k]).sum(axis=1, dtype=np.uint64))
            from_, to = np.full(len(row), -1, np.int64), np.full(len(row), -1, np.int64)
            fill = np.iinfo(contexts.dtype).max
            inside = contexts != fill
            left = reach - np.argmax(inside, axis=1)
            right = width - np.argmax(inside[:, ::-1], axis=1)
            for offset, smallest in solve(contexts, anchor, least, reach, width):
                good = (left >= offset) & (right >= width - offset)
                hit = good[row] & (owner > smallest[row])
                from_[hit] = offset  # offsets ascend, so the last one starts first
                to[hit & (to < 0)] = width - offset
            hit = from_ >= 0
            for i in np.unique(sender[hit]):
                own = hit & (sender == i)
                spans[i].append(np.stack((place[own] - from_[own], place[own] + to[own])))
        split = [(i, m[1]) for i, m in enumerate(messages) if m[1]]
        if split:
            whole = np.concatenate([m[0] for _, m in split])
            sizes, place, owner = (np.concatenate([m[x].astype(np.int64) for _, m in split]) for x in (1, 2, 3))
            order, new = equal_rows(whole)
            least = np.minimum.reduceat(owner, np.cumsum(sizes) - sizes)
            smallest = np.empty_like(least)
            smallest[order] = np.repeat(np.minimum.reduceat(least[order], new), np.diff(np.append(new, len(order))))
            hit = owner > np.repeat(smallest, sizes)
            sender = np.repeat([i for i, _ in split], [len(m[2]) for _, m in split])
            for i in np.unique(sender[hit]):
                p = place[hit & (sender == i)]
                spans[i].append(np.stack((p, p + width)))
        return [small(np.concatenate(x, axis=1)) if x else None for x in spans], None

    def end(block: Block, answers: dict) -> pd.DataFrame:
        seq = read(block)
        change = np.zeros(len(seq.tokens) + 1, np.int64)
        for from_, to in answers.values():
            np.add.at(change, from_.astype(np.int64), 1)
            np.add.at(change, to.astype(np.int64), -1)
        return finish(seq, np.cumsum(change[:-1]) > 0)

    # both answers are small, and once they are written the questions' shuffles can go
    states = materialise(answer(ask(blocks, None, offer), compare))
    spans = materialise(answer(ask(blocks, states, send), cover))
    return conclude(blocks, spans, end, form)


def _shares(bucket: np.ndarray):
    order = np.argsort(bucket, kind="stable")
    for part in np.split(order, runs(bucket[order])[1:]):
        yield int(bucket[part[0]]), part
