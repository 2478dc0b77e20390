"""Packing, clustering and the filter audit against their plain versions."""

import hashlib
import itertools
import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelcast.llm import filter_audit, orchard, packing
from panelcast.llm.queries import TOKENIZER

from . import brute
from .conftest import SF, odd_rows

BIG = 1 << 60


@pytest.fixture(params=["driver", "odd", "empty"])
def docs(request, sf_docs, make_docs):
    odd = [*odd_rows(), (BIG + 1, "one", "a"), (BIG + 2, "two", "a"), (None, "three", "a")]
    return {"driver": lambda: sf_docs, "odd": lambda: make_docs(odd), "empty": lambda: sf_docs.limit(0)}[request.param]()


# packing


def encoded(docs, end_id=1):
    coder = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    return [(r.doc_id, [*coder.encode(r.text or "", add_special_tokens=False).ids, end_id]) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("length, grid", [(2048, 4), (128, 1)])
def test_packing(docs, length, grid):
    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER), length=length, grid=grid).collect()
    wanted = defaultdict(list)
    for d, ids in encoded(docs):
        wanted[d, len(ids)].append(ids)
    got = defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        got[p.doc_id, p.doc_tokens].append((p.start, p.length, np.frombuffer(p.ids, "<u4").tolist()))
    assert got.keys() == wanted.keys()
    for key, copies in wanted.items():  # texts of one id and length are told apart by their ids
        at = Counter((s + i, x) for s, n, ids in got[key] for i, x in enumerate(ids))
        assert at == Counter((i, x) for ids in copies for i, x in enumerate(ids))
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    padding = 0
    for parts in sequences.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= length
        padding += 0 if end & (end - 1) == 0 else length - end
    total = sum(p.length for p in pieces)
    assert padding <= 0.005 * total


def test_packing_report_and_sequences(sf_docs):
    path = public_tokenizers.path(TOKENIZER)
    rows = packing.packing_report(sf_docs, path).collect()
    ids = dict(encoded(sf_docs))
    for r in rows:
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert (r.ids_crc32, r.doc_tokens, r.length) == (zlib.crc32(part.tobytes()), len(ids[r.doc_id]), len(part))
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for s in packing.packed_sequences(packing.pack(sf_docs, path)).collect():
        whole = np.frombuffer(s.ids, "<u4").tolist()
        assert len(whole) == s.tokens <= s.padded <= 2048
        for d in s.documents:
            assert whole[d.offset:d.offset + d.length] == ids[d.doc_id][d.start:d.start + d.length]


def test_combinations_fill_the_window():
    for units, depth in ((12, 3), (9, 2), (7, 4)):
        got = {tuple(x for x in row if x) for row in packing.combinations(units, depth).tolist()}
        want = {c for d in range(1, depth + 1) for c in itertools.combinations_with_replacement(range(1, units + 1), d) if sum(c) == units}
        assert got == want


def test_least_squares_is_optimal():
    rnd = np.random.default_rng(7)
    columns = packing.combinations(16)
    matrix = np.stack([np.bincount(c, minlength=17) for c in columns], axis=1).astype(float)
    matrix[0] = 0
    for _ in range(5):
        wanted = np.concatenate([[0], rnd.integers(0, 50, 16)]).astype(float)
        x = packing.least_squares(columns, wanted)
        gradient = matrix.T @ (matrix @ x - wanted)  # the optimality conditions
        assert (x >= 0).all() and gradient.min() > -1e-6 and np.abs(gradient[x > 0]).max(initial=0) < 1e-6


@pytest.mark.parametrize("n", [1, 40, 3000])
def test_plan_places_every_piece_once(n):
    rnd = np.random.default_rng(n)
    sizes = np.sort(np.where(rnd.random(n) < 0.3, 700, np.minimum(rnd.lognormal(6, 1, n).astype(int) + 1, 2047)))
    values, counts = np.unique(sizes, return_counts=True)
    plan = packing.make_plan(dict(zip(values.tolist(), counts.tolist())))
    filled = defaultdict(list)
    parts = defaultdict(int)
    for i, begin, size, sequence, offset in plan.places(np.arange(n)):
        assert parts[i] == begin
        parts[i] += size
        filled[sequence].append((offset, size))
    assert [parts[i] for i in range(n)] == sizes.tolist()
    assert sorted(filled) == list(range(plan.sequences))
    for inside in filled.values():
        ends = np.cumsum([s for _, s in sorted(inside)])
        assert [o for o, _ in sorted(inside)] == [0, *ends[:-1]] and ends[-1] <= 2048


# clustering


def lloyd(rows, k=8, rounds=10, dimensions=64):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: ("g" if r[0] is None else hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        cents = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if groups[j] else c for j, c in enumerate(cents)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return [(i, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, c, d in found]


def vectors(kind):
    rnd = np.random.default_rng(5)
    if kind == "driver":
        return None
    if kind == "empty":
        return []
    grid = rnd.integers(-2, 3, (60, 64)) / 4  # many ties
    rows = [(i, v.tolist()) for i, v in enumerate(grid)]
    rows += [(100, rows[3][1]), (100, rows[3][1]), (None, rows[4][1]), (BIG + 1, rows[5][1]), (BIG + 2, rows[5][1])]
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [None, *[1.0] * 63]), (205, [float("nan"), *[1.0] * 63]),
             (206, [float("-inf"), *[1.0] * 63])]
    return rows[:5] if kind == "few" else rows


@pytest.mark.parametrize("kind", ["driver", "odd", "few", "empty"])
def test_clusters(spark, kind):
    rows = vectors(kind)
    df = (spark.read.parquet(f"{SF}/embeddings.parquet") if rows is None
          else spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, cluster string, v int"))
    got = [tuple(r) for r in orchard.cluster_report(df).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()]
    plain = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(lloyd(plain), key=repr)


def test_search_measures_few_and_finds_the_nearest():
    rnd = np.random.default_rng(2)
    centroids = rnd.integers(-500, 500, (40, 2))
    centroids[7] = centroids[3]  # doubles: the smaller number wins
    points = np.concatenate([rnd.integers(-500, 500, (500, 2)), centroids])
    best, dist = orchard.nearest(points, centroids, *orchard.neighbour_lists(centroids))
    every = ((points[:, None] - centroids[None]) ** 2).sum(2)
    assert (dist == every.min(1)).all() and (best == every.argmin(1)).all()


def test_too_large_components_are_named(spark):
    df = spark.createDataFrame([(1, [1e6] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        orchard.cluster_report(df).collect()


# the filter audit


def audit_rows(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, _, t in docs:
        least[t or ""] = min(least.get(t or "", math.inf), brute.key(d))
    seen = []
    for d, lang, t in docs:
        t = t or ""
        w = brute.WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": brute.key(d) > least[t]}
        seen.append((lang or "", {f for f, x in fails.items() if x}, d in good, d in toxic))
    out = []
    for part in {s[0] for s in seen}:
        own, rows, lost = [s for s in seen if s[0] == part], [], Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                before = set(order[:step - 1])
                here = [s for s in own if f in s[1] and not s[1] & before]
                lost[f] += len(here)
                rows.append((part, order, step, sum(not s[1] & (before | {f}) for s in own), len(here), sum(f in s[1] and bool(s[1] & before) for s in own),
                             sum(s[1] == {f} for s in own), sum(s[2] for s in here), sum(s[3] for s in here)))
        out += [(*r, lost[r[1][r[2] - 1]]) for r in rows]
    return sorted(out)


COLUMNS = ["part", "filter_order", "step", *filter_audit.COUNTS, "shapley"]


@pytest.mark.parametrize("kind", ["driver", "odd", "empty"])
def test_audit(spark, kind):
    if kind == "driver":
        docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    else:
        texts = ["", None, "a b c", "Ab " * 250, "ab " * 250, " ".join(f"w{i}é" for i in range(300)), "x|y\x0bz", "W " + " ".join(f"w{i}" for i in range(220))]
        rows = [(d, lang, t) for i, t in enumerate(texts) for d, lang in ((i, "en"), (i + 20, "de"), (None, None), (i + 40, ""), (i, "en"), (BIG + i, "en"))]
        rows = rows if kind == "odd" else []
        docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, lang string, text string, bits int, part string")
        marks = [(0, 1, 0), (0, 0, 1), (3, 1, 1), (BIG + 5, 1, 0), (BIG + 4, 0, 1), (None, 1, 1), (7, None, None), (20, 1, None), (99, 1, 1)]
        labels = spark.createDataFrame(marks if kind == "odd" else [], "doc_id long, quality int, toxic int")
    got = sorted(tuple(r) for r in filter_audit.audit(docs, labels).select(*COLUMNS).collect())
    want = audit_rows([(r.doc_id, r.lang, r.text) for r in docs.collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert got == want
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    con.register("labels", labels.toArrow())
    assert sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({filter_audit.ORACLE})").fetchall()) == want


def test_packed_fields_do_not_run_over():
    n, width = 255, 1  # as many documents as a field can hold
    for code in (0, 31, 5 + filter_audit.GOOD, 18 + filter_audit.TOXIC):
        assert (filter_audit.unpacked(n * filter_audit.packed(code, width), width) == n * filter_audit.outcomes(code).astype(int)).all()
    mixed = sum(filter_audit.packed(c, 2) * (c + 1) for c in range(filter_audit.CODES))
    want = sum(filter_audit.outcomes(c).astype(int) * (c + 1) for c in range(filter_audit.CODES))
    assert (filter_audit.unpacked(mixed, 2) == want).all()


@pytest.mark.parametrize("lots", [1, 32])
def test_a_part_over_many_tasks(spark, sf_docs, monkeypatch, lots):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    monkeypatch.setattr(filter_audit, "LOTS", lots)
    few = filter_audit.audit(sf_docs.withColumn("lang", F.lit("en")).repartition(40), labels)
    assert few.count() == 600 and few.agg(F.max("kept"), F.max("removed")).first()[0] > 0
