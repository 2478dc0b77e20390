"""Chat formatting: minimum-cost repair of role sequences, then rendering.

The legal conversations are the walks of a small automaton: an optional
system turn, then user and assistant turns in alternation, the last one an
assistant's.  A turn may be kept, relabelled, or merged into the turn before
it; an empty turn may be inserted.  Dynamic programming over the automaton
finds the cheapest repair.

A turn's costs depend on its role alone, so each role has one matrix of
min-plus steps between states, and the matrices of neighbouring turns can be
combined in any grouping.  Conversations are therefore range-partitioned by
(conversation, turn): each partition reduces its stretch of a conversation to
one matrix, the few matrices of a conversation fix the states at the
stretches' ends, and every stretch is repaired on its own.  A conversation of
any length is spread over the tasks.

Defined results: unknown or null roles cost a relabelling whatever they
become; a null text counts as empty; equal turns are ordered by role and
text; a null conversation id is a conversation of its own; a conversation
without turns does not occur; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import exact_id, id_values, ids_of, materialise

#: States: the role of the turn written last, or START.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLE = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
STATE = {v: k for k, v in ROLE.items()}
#: Legal next turns of each state, and the states a conversation may end in.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = (ASSISTANT,)
COST = {"keep": 0, "merge": 2, "relabel": 3, "insert": 4}
FAR = 10 ** 9
TEMPLATE = "<|{role}|>\n{text}\n"


def _inserts() -> tuple[np.ndarray, dict]:
    """Cheapest insertions between two states: cost[s, t], and the inserted turns path[s, t]."""
    cost, path = np.full((4, 4), FAR, np.int64), {}
    for s in range(4):
        cost[s, s], path[s, s] = 0, []
        todo = [s]
        while todo:
            at = todo.pop(0)
            for t in NEXT[at]:
                if cost[s, at] + COST["insert"] < cost[s, t]:
                    cost[s, t], path[s, t] = cost[s, at] + COST["insert"], [*path[s, at], t]
                    todo.append(t)
    return cost, path


INSERT_COST, INSERT_PATH = _inserts()


def _steps(role: int | None) -> tuple[np.ndarray, dict]:
    """One input turn: the cheapest way from state s to t, as cost[s, t] and how[s, t] = (inserted turns, action)."""
    cost, how = np.full((4, 4), FAR, np.int64), {}
    for s in range(4):
        for t in (SYSTEM, USER, ASSISTANT):
            label = 0 if role == t else COST["relabel"]
            options = []
            if s == t:
                options.append((COST["merge"] + label, 0, [], "merge" if not label else "relabel+merge"))
            for mid in range(4):
                if t in NEXT[mid]:
                    options.append((int(INSERT_COST[s, mid]) + label, 1, INSERT_PATH.get((s, mid), []), "keep" if not label else "relabel"))
            best = min(options, key=lambda x: (x[0], x[1], len(x[2])), default=None)
            if best and best[0] < FAR:
                cost[s, t], how[s, t] = best[0], (best[2], best[3])
    return cost, how


STEPS = {role: _steps(role) for role in (None, SYSTEM, USER, ASSISTANT)}


def plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The min-plus product: the cheapest way through both stretches."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def stretch_cost(roles: list[str | None]) -> np.ndarray:
    out = np.where(np.eye(4, dtype=bool), 0, FAR).astype(np.int64)
    for r in roles:
        out = plus(out, STEPS[STATE.get(r)][0])
    return out


def repair(roles: list[str | None], texts: list[str], start: int, end: int, finish: bool) -> list[tuple]:
    """Output turns (role, text, action, cost) of the cheapest way from ``start`` to ``end``.

    With ``finish`` the insertions that a last turn needs are added.  A merge
    at the head of a stretch is given as such: it belongs to the turn before.
    """
    best = [{start: (0, None)}]
    for r in roles:
        cost, here = STEPS[STATE.get(r)][0], {}
        for s, (c, _) in best[-1].items():
            for t in range(1, 4):
                now = c + int(cost[s, t])
                if now < min(FAR, here.get(t, (FAR,))[0]):
                    here[t] = (now, s)
        best.append(here)
    states = [end]
    for here in best[:0:-1]:
        states.append(here[states[-1]][1])
    states.reverse()
    out = []
    for r, text, s, t in zip(roles, texts, states, states[1:]):
        cost, how = STEPS[STATE.get(r)]
        inserted, action = how[s, t]
        out += [(ROLE[x], "", "insert", COST["insert"]) for x in inserted]
        out.append((ROLE[t], text, action, int(cost[s, t]) - COST["insert"] * len(inserted)))
    if finish:
        last = min(FINAL, key=lambda f: INSERT_COST[end, f])
        out += [(ROLE[x], "", "insert", COST["insert"]) for x in INSERT_PATH[end, last]]
    return out


def _joined(turns: list[tuple]) -> list[tuple]:
    """Merges carried out within the stretch; a merge at its head stays, it belongs to the stretch before."""
    out: list[list] = []
    for role, text, action, cost in turns:
        if action.endswith("merge") and out:
            out[-1][1] = f"{out[-1][1]}\n{text}" if out[-1][1] and text else out[-1][1] or text
            out[-1][2] = f"{out[-1][2]}, {action}"
            out[-1][3] += cost
        else:
            out.append([role, text, action, cost])
    return [tuple(x) for x in out]


def _stretches(batches):
    """(conv_id, part, roles, texts) of each conversation's rows in a sorted partition."""
    key, roles, texts, part = None, [], [], None
    for pdf in batches:
        for c, p, r, t in zip(ids_of(pdf, "conv_id"), pdf["part"], pdf["role"], pdf["text"]):
            if roles and c != key:
                yield key, part, roles, texts
                roles, texts = [], []
            key, part = c, int(p)
            roles.append(r)
            texts.append(t)
    if roles:
        yield key, part, roles, texts


def _plan(rows) -> dict:
    """(conversation, partition) -> (stretch, state from, state to, is last), of conversations over several partitions."""
    by_key: dict = {}
    for r in sorted(rows, key=lambda r: r["part"]):
        by_key.setdefault(r["conv_id"], {})[r["part"]] = np.array(r["cost"], np.int64).reshape(4, 4)
    out = {}
    for key, costs in by_key.items():
        if len(costs) < 2:
            continue
        upto = [np.where(np.arange(4) == START, 0, FAR)]
        for c in costs.values():
            upto.append(np.minimum((upto[-1][:, None] + c).min(axis=0), FAR))
        states = [_best_end(upto[-1])]
        for before, c in zip(upto[-2::-1], list(costs.values())[::-1]):
            states.append(int(np.argmin(before + c[:, states[-1]])))
        states.reverse()
        for i, part in enumerate(costs):
            out[key, part] = (i, states[i], states[i + 1], i == len(costs) - 1)
    return out


def _best_end(cost: np.ndarray) -> int:
    return int(np.argmin(cost + INSERT_COST[:, list(FINAL)].min(axis=1)))


def repair_conversations(turns: DataFrame) -> DataFrame:
    """Repaired turns: conv_id, stretch, turn, role, text, action, cost, rendered.

    A conversation that lies in one partition has the one stretch 0.  Reading
    a conversation's rows by (stretch, turn) gives its rendered sequence; the
    first row of a later stretch may be a merge, which goes on with the turn
    before it.
    """
    spark = turns.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    role = F.lower(F.trim(F.coalesce("role", F.lit(""))))
    order = [F.col("conv_id").asc_nulls_last(), F.col("turn").asc_nulls_last(), "role", "text"]
    ranged = materialise(turns.select("conv_id", "turn", role.alias("role"), F.coalesce("text", F.lit("")).alias("text"))
                         .repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))

    def edges(batches):
        """Only a partition's first and last conversation can go on in another one."""
        ends: list = []
        for key, part, roles, _ in _stretches(batches):
            ends[1:] = [(key, part, roles)] if ends else []
            ends = ends or [(key, part, roles)]
        out = pd.DataFrame([(key, part, stretch_cost(roles).ravel().tolist()) for key, part, roles in ends],
                           columns=["conv_id", "part", "cost"])
        yield out.assign(conv_id=id_values(e[0] for e in ends))

    ranged = ranged.select(*exact_id("conv_id"), "role", "text", "part")
    # at most two rows per partition
    plan = spark.sparkContext.broadcast(_plan(ranged.mapInPandas(edges, "conv_id long, part int, cost array<long>").collect()))

    def write(batches):
        rows = []
        for key, part, roles, texts in _stretches(batches):
            whole = (key, part) not in plan.value
            stretch, a, b, last = (0, START, _best_end(stretch_cost(roles)[START]), True) if whole else plan.value[key, part]
            for i, (r, text, action, cost) in enumerate(_joined(repair(roles, texts, a, b, last))):
                goes_on = i == 0 and action.split(",")[0].endswith("merge")
                rows.append((key, stretch, i, r, text, action, cost, f"{text}\n" if goes_on else TEMPLATE.format(role=r, text=text)))
            if len(rows) >= 5000:
                yield _frame(rows)
                rows = []
        yield _frame(rows)

    return ranged.mapInPandas(write, OUTPUT)


OUTPUT = "conv_id long, stretch int, turn int, role string, text string, action string, cost long, rendered string"


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in OUTPUT.split(", ")]).assign(conv_id=id_values(r[0] for r in rows))
