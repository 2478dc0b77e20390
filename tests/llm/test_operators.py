"""Chat repair, quality rules, decontamination, token counts, the mix and the pipeline."""

import itertools
import os
import re
import subprocess
import sys

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from panelcast.llm import chat, decontaminate, katz, mixing, near_dedup, quality, suffix_dedup, suffix_trees, token_counts, token_files, tokens
from panelcast.llm.queries import ORACLE, QUERIES, TOKENIZER
from panelcast.llm.tokens import PieceEncoder

from . import brute
from .conftest import SF, odd_rows


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# chat


def cheapest(roles):
    """Dijkstra-free brute force: all walks by dynamic programming over explicit choices, insertions one at a time."""
    best = {chat.START: 0}

    def close(costs):
        costs = dict(costs)
        for _ in range(4):
            for s, t in itertools.product(list(costs), range(1, 4)):
                if t in chat.NEXT[s]:
                    costs[t] = min(costs.get(t, 10 ** 9), costs[s] + chat.COST["insert"])
        return costs

    for r in roles:
        here, before = {}, close(best)
        for t in range(1, 4):
            label = 0 if chat.STATE.get(r) == t else chat.COST["relabel"]
            options = [c + label for s, c in before.items() if t in chat.NEXT[s]]
            options += [best[t] + chat.COST["merge"] + label] if t in best else []
            if options:
                here[t] = min(options)
        best = here
    return min(c for s, c in close(best).items() if s in chat.FINAL)


def test_repairs_are_legal_and_cheapest(spark):
    rnd = np.random.default_rng(1)
    names = ["system", "user", "assistant", "tool", None, " USER "]
    convs = {i: [names[j] for j in rnd.integers(0, len(names), rnd.integers(1, 9))] for i in range(60)}
    convs[99] = ["user", "assistant"] * 300 + ["user", "user"]
    rows = [(c, t, r, f"t{t}", 0) for c, roles in convs.items() for t, r in enumerate(roles)]
    rows += [(None, 0, "user", None, 0)]
    out = chat.repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, stretch int")).collect()
    by = {}
    for r in sorted(out, key=lambda r: (r.stretch, r.turn)):
        by.setdefault(r.conv_id, []).append(r)
    convs[None] = ["user"]
    assert set(by) == set(convs)
    for c, roles in convs.items():
        clean = [(r or "").strip().lower() for r in roles]
        assert sum(r.cost for r in by[c]) == cheapest(clean), (c, roles)
        state = chat.START
        for r in by[c]:
            if not (r.turn == 0 and r.stretch and r.action.split(",")[0].endswith("merge")):
                assert chat.STATE[r.role] in chat.NEXT[state]
            state = chat.STATE[r.role]
        assert state in chat.FINAL
        texts = "\n".join(r.text for r in by[c] if r.text).split("\n")
        assert texts == ([f"t{t}" for t in range(len(roles))] if c is not None else [""])
    assert by[None][0].rendered == "<|user|>\n\n" and by[99][0].rendered == "<|user|>\nt0\n"


def test_a_conversation_over_many_partitions(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", str(t)) for t in range(3000)]
    whole = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.repair_conversations(whole).collect()
    assert len({r.stretch for r in out}) > 1
    assert sum(r.cost for r in out) == cheapest([r[2] for r in rows])


def test_stretches_combine():
    roles = ["user", "tool", "assistant", "system", "user"]
    assert (chat.plus(chat.stretch_cost(roles[:2]), chat.stretch_cost(roles[2:])) == chat.stretch_cost(roles)).all()


# quality


def test_quality_rules_match_sql(make_docs, sf_docs):
    boiler = "this line stands in very many pages of the host"
    rows = odd_rows() + [(100 + i, f"{boiler}\nown words {i} here", "h") for i in range(30)]
    rows += [(200 + i, "  ".join(f"w{i}x{j}" for j in range(60)) + f"\n{boiler}\t\n\n", "h") for i in range(30)]
    rows += [(300, "a b c d e f g h " * 9, "h"), (301, "x\nx\n \nx\r\n" + "q r s t u v w x y z " * 3, "h")]
    for docs in (make_docs(rows), sf_docs, make_docs(rows[:0])):
        con = duckdb.connect()
        con.register("documents", docs.select("doc_id", "text", "source").toPandas())
        want = con.sql(f"SELECT * FROM ({ORACLE['op4_quality_rules']})").fetchall()
        names = [d[0] for d in con.description] if con.description else None
        got = quality.quality_report(docs)
        names = names or got.columns
        assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_depleted_documents_go_and_clean_ones_stay(make_docs):
    boiler = " ".join(f"menu{i}" for i in range(40))
    rows = [(i, f"{boiler}\nown text number {i}", "h") for i in range(20)]
    rows += [(100 + i, " ".join(f"w{j}" for j in range(60)), "h") for i in range(20)]  # copies of one clean text
    rows += [(200 + i, " ".join(f"u{i}v{j}" for j in range(60)), None) for i in range(5)]
    docs = make_docs(rows)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {*range(100, 120), *range(200, 205)}


def family(n, lines=12):
    """Near copies of one clean text: each has one line changed in one word."""
    words = [[f"k{i}w{j}" for j in range(10)] for i in range(lines)]
    out = []
    for i in range(n):
        own = [list(w) for w in words]
        own[i % lines][i // lines] = f"edit{i}"
        out.append("\n".join(map(" ".join, own)))
    return out


def test_near_copies_of_a_clean_text_are_not_depleted(spark, make_docs):
    boiler = " ".join(f"menu{i}" for i in range(40))
    rows = [(i, t, "h") for i, t in enumerate(family(20))] + [(100 + i, f"{boiler}\nown text number {i}", "h") for i in range(20)]
    rows += [(200 + i, f"{boiler}\n" + "\n".join(" ".join(f"a{i}b{j}c{k}" for k in range(12)) for j in range(6)), "h") for i in range(20)]
    docs = make_docs(rows)
    kept = quality.keep_good(docs)
    assert {r.doc_id for r in kept.collect()} == {*range(20), *range(200, 220)}
    assert [r.doc_id for r in near_dedup.drop_near_duplicates(kept, 80).where("doc_id < 100").collect()] == [0]
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas())
    want = con.sql(f"SELECT doc_id, kept FROM ({ORACLE['op4_quality_rules']})").fetchall()
    assert sorted((r.doc_id, r.kept) for r in quality.quality_report(docs).collect()) == sorted(want)


def test_a_family_of_copies_costs_rows_in_proportion(spark, make_docs, monkeypatch):
    def counted(n):
        monkeypatch.setattr(near_dedup, "TILE", 32)
        monkeypatch.setattr(near_dedup, "LARGE", 1)
        rnd = np.random.default_rng(n)
        rows = []
        for i in range(n):
            words = [f"k{j}" for j in range(200)]
            for at in rnd.integers(0, 200, 3 if i % 20 else 9):  # some of them further out
                words[at] = f"e{i}x{at}"
            rows.append((i, " ".join(words), "h"))
        total = 0

        def tiled(members, key, size, plain=near_dedup.tiled):
            nonlocal total
            out = plain(members, key, size)
            total += out.count()
            return out
        monkeypatch.setattr(near_dedup, "tiled", tiled)
        docs = make_docs(rows)
        got = rows_of(near_dedup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept")
        monkeypatch.undo()
        assert got == sorted(brute.near_rows([r[:2] for r in rows]), key=repr)
        return total

    few, many = counted(150), counted(450)
    assert many < 5 * few + 1000  # by tiles alone: nine times


# ids


BIG = [(2 ** 60 + 1, "one fish two fish red fish", "a"), (None, "blue fish " * 70, "a"), (2 ** 60 + 2, "blue fish " * 70, "a"),
       (2 ** 63 - 1, "old fish", None)]


def test_large_ids_beside_a_null_stay_as_they_are(spark, make_docs, tmp_path):
    docs = make_docs(BIG).coalesce(1)
    path, ids = public_tokenizers.path(TOKENIZER), sorted((str(d) for d, *_ in BIG))
    bench = spark.createDataFrame([(2 ** 60 + 5, "blue fish " * 6), (None, None)], "item_id long, text string").coalesce(1)
    for out in (token_files.token_output(docs, path), katz.score_documents(docs), suffix_dedup.remove_repeats(docs),
                token_counts.count_tokens(docs, path), suffix_trees.remove_repeats(docs)):
        assert sorted(str(r.doc_id) for r in out.collect()) == ids
    assert [(d, n) for d, n, *_ in sorted(map(tuple, suffix_trees.remove_repeats(docs).select("doc_id", "n_removed").collect()), key=repr)] == [
        (2 ** 60 + 1, 0), (2 ** 60 + 2, 0), (2 ** 63 - 1, 0), (None, 140)]
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()} == {(2 ** 60 + 2, 2 ** 60 + 5), (None, 2 ** 60 + 5)}
    turns = spark.createDataFrame([(d, i, "user", t) for i, (d, t, _) in enumerate(BIG)], "conv_id long, turn int, role string, text string").coalesce(1)
    assert {str(r.conv_id) for r in chat.repair_conversations(turns).collect()} == set(ids)


# decontamination


def overlap(item, text):
    w, v = decontaminate.tokens(item), decontaminate.tokens(text)
    if not w:
        return 0
    if len(w) < 5:
        return float(any(v[i:i + len(w)] == w for i in range(len(v))))
    return len(decontaminate.shingles(w) & decontaminate.shingles(v)) / len(decontaminate.shingles(w))


def test_decontamination_finds_every_leak(spark, sf_docs, make_docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    leak = items[3][1].upper().replace(" ", "\t")
    words = items[5][1].split()
    rows = odd_rows() + [(500, "before it " * 200 + leak + " and after " * 100, "z"), (501, items[4][1], None),
                         (502, " ".join(words[:len(words) // 3]), "z"), (503, " ".join(words[:-1] + ["other"]), "z"),
                         (504, "short one here", "z")]
    extra = spark.createDataFrame([(900, "short one"), (901, None), (902, " "), (None, "one two three four five six")], bench.schema)
    both = bench.unionByName(extra)
    every = items + [(900, "short one"), (None, "one two three four five six")]
    for docs in (sf_docs, make_docs(rows), make_docs([])):
        found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, both).collect()}
        want = {(r.doc_id, i) for r in docs.collect() for i, t in every if overlap(t, r.text) >= 0.8}
        assert found == want
        clean = decontaminate.clean_documents(docs, both)
        assert clean.columns == docs.columns
        assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - {d for d, _ in want}
    assert decontaminate.contaminated(sf_docs, bench.limit(0)).count() == 0


def test_chunks_of_the_index_change_nothing(spark, sf_docs, monkeypatch):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(map(tuple, decontaminate.contaminated(sf_docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "CHUNK_ITEMS", 30)
    assert sorted(map(tuple, decontaminate.contaminated(sf_docs, bench).collect())) == whole != []


def test_wand_retrieves_what_a_full_scan_does():
    rnd = np.random.default_rng(5)
    vocab = [f"w{i}".encode() for i in range(200)]
    items = [(i, [vocab[int(j)] for j in rnd.zipf(1.3, rnd.integers(3, 30)) % 200]) for i in range(300)]
    df = {}
    for _, w in items:
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    index = decontaminate.Index([(i, w, df) for i, w in items], len(items), float(np.mean([len(w) for _, w in items])))
    some = 0
    for _ in range(50):
        terms = np.unique(rnd.integers(0, len(index.term), 60))
        scores = {}
        for t in terms:
            for item, x in zip(index.items[t], index.impacts[t]):
                scores[item] = scores.get(item, 0) + x
        want = {i for i, s in scores.items() if s >= 1 - 1e-9}
        assert {i for i, _ in index.retrieve(terms)} == want
        some += len(want)
    assert some


# tokens


def test_pieces_give_the_tokenizers_ids(make_docs):
    path = public_tokenizers.path(TOKENIZER)
    ours, theirs = PieceEncoder(path), Tokenizer.from_file(path)
    texts = [t or "" for _, t, _ in odd_rows()] + ["a b  c\x1fd\x85e​f \t\n g  \n", "don't we'll  'S\n\n\n", " <|endoftext|>x", "\U0001f600́ ñ"]
    for text, ids, spans in zip(texts, ours.ids(texts), ours.spans(texts)):
        want = theirs.encode(text, add_special_tokens=False)
        assert ids.tolist() == want.ids and [tuple(x) for x in spans.tolist()] == want.offsets


class _Counted:
    """A tokenizer that notes what it is asked to encode."""

    def __init__(self, tokenizer):
        self.tokenizer, self.asked = tokenizer, []

    def encode(self, text, **how):
        self.asked.append(text)
        return self.tokenizer.encode(text, **how)

    def encode_batch(self, texts, **how):
        self.asked += texts
        return self.tokenizer.encode_batch(texts, **how)


def test_new_words_go_straight_to_the_model():
    """op2, op11: encoding lists of new words with their offsets took most of the time."""
    path = public_tokenizers.path(TOKENIZER)
    letters = re.findall(f"[{tokens.LETTER}]", "".join(map(chr, range(0x250))))
    texts = [" ".join(letters), "".join(letters), " ".join(x + y for x, y in zip(letters, reversed(letters))), " a" + "é" * 300]
    ours = PieceEncoder(path)
    ours.tokenizer = counted = _Counted(ours.tokenizer)
    assert [x.tolist() for x in ours.ids(texts)] == [Tokenizer.from_file(path).encode(x).ids for x in texts]
    assert not counted.asked


def test_pieces_in_use_stay_remembered(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_PIECES", 20)
    path = public_tokenizers.path(TOKENIZER)
    ours, theirs = PieceEncoder(path), Tokenizer.from_file(path)
    ours.tokenizer = counted = _Counted(ours.tokenizer)
    for i in range(100):
        text = f"12 {i + 1000} "
        assert ours.ids([text])[0].tolist() == theirs.encode(text).ids
    assert counted.asked.count("12") == 1
    assert all(len(x) + len(x.older) <= 20 for x in ours.known.values())


def test_random_access(sf_docs, tmp_path):
    path = public_tokenizers.path(TOKENIZER)
    files = token_files.write_sequences(sf_docs, str(tmp_path / "out"), path, length=64).orderBy("part", "file").collect()
    assert sorted(os.listdir(tmp_path / "out")) == sorted(os.path.basename(f.path) for f in files)
    tokenizer = Tokenizer.from_file(path)
    want = [i for d, t in sorted((r.doc_id, r.text) for r in sf_docs.collect()) for i in [*tokenizer.encode(t).ids, 0]]
    got = []
    for f in files:
        seqs = token_files.SequenceFile(f.path)
        assert len(seqs) == f.n_sequences
        rows = [seqs[i] for i in range(len(seqs))]
        ids = np.concatenate([r[0] for r in rows])[np.concatenate([r[1].to_numpy(zero_copy_only=False) for r in rows])]
        assert len(ids) == f.n_tokens and all(len(r[0]) == 64 for r in rows)
        got += ids.tolist()
    assert got == want


def test_token_counts_add_up(make_docs, sf_docs):
    path = public_tokenizers.path(TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    for docs in (make_docs(odd_rows()), sf_docs, make_docs([])):
        texts = {}
        for r in docs.collect():
            whole = "\n".join(x or "" for x in (r.source, r.lang, r.text))
            texts.setdefault(r.doc_id, []).append((len(tokenizer.encode(whole).ids), max((r.text or "").count("\n") + (not (r.text or "").endswith("\n")), 1)))
        out = token_counts.count_tokens(docs, path).collect()
        assert len(out) == sum(map(len, texts.values()))
        for r in out:
            assert (r.n_tokens, r.n_sections) in texts[r.doc_id]
            assert r.source_tokens + r.lang_tokens + r.text_tokens == r.n_tokens and sum(r.section_tokens) == r.text_tokens


def sections_by_character(coder, parts):
    """Tokens of every section: each character belongs to the section it stands in, a token to the one with most of its characters."""
    owner = [k for k, p in enumerate(parts) for _ in p]
    counts, crossing = [0] * len(parts), 0
    for a, b in coder.encode("".join(parts), add_special_tokens=False).offsets:
        own = [owner[i] for i in range(a, max(b, a + 1))]
        counts[max(dict.fromkeys(own), key=own.count)] += 1  # the first on a tie
        crossing += len(set(own)) > 1
    return counts, crossing


def test_token_counts_by_character(sf_docs, make_docs):
    path = public_tokenizers.path(TOKENIZER)
    coder = Tokenizer.from_file(path)
    own = [(1, "é\n\n\nab  c\n", "s"), (2, "\n", None), (3, None, "x y"), (4, "naïve 日本\n語 text\r\nend", "")]
    for docs in (sf_docs.where("n_chars < 4000"), make_docs(own)):
        got = {r.doc_id: r for r in token_counts.count_tokens(docs, path).collect()}
        for r in docs.collect():
            text = r.text or ""
            lines = text.split("\n")
            lines = [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] or len(lines) == 1 else [])
            counts, crossing = sections_by_character(coder, [f"{r.source or ''}\n", f"{r.lang or ''}\n", *lines])
            mine = got[r.doc_id]
            assert [mine.source_tokens, mine.lang_tokens, *mine.section_tokens] == counts
            assert (mine.text_tokens, mine.crossing_tokens, mine.n_sections) == (sum(counts[2:]), crossing, len(lines))


def test_a_crossing_token_goes_to_its_larger_part():
    where, crossing = token_counts.attribute(np.array([[0, 2], [2, 5], [5, 7], [7, 8]]), np.array([0, 3, 6]))
    assert where.tolist() == [0, 1, 1, 2] and crossing.tolist() == [False, True, True, False]


# mix


def filled(sizes, weights=(5, 2, 1)):
    """Targets by sharing again and again until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        level = (budget - sum(target.values())) / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * level > 2 * sizes[s]}
        if not full:
            return target | {s: w[s] * level for s in open_}
        target |= {s: 2.0 * sizes[s] for s in full}
        open_ -= full
    return target


def test_mix_meets_its_targets(make_docs, sf_docs):
    rows = odd_rows() + [(1000 + i, "w " * (i % 7), "hot") for i in range(400)] + [(2000, None, "none"), (2001, " ", "none")]
    for docs in (make_docs(rows), sf_docs, make_docs([])):
        sizes, largest = {}, {}
        for r in docs.collect():
            n = len(brute.WORD.findall(r.text or ""))
            sizes[r.source] = sizes.get(r.source, 0) + n
            largest[r.source] = max(largest.get(r.source, 0), n)
        want = filled(sizes)
        out = mixing.mix(mixing.sized(docs)).collect()
        assert len(out) == docs.count()
        taken = {}
        for r in out:
            assert r.source_size == sizes[r.src] and abs(r.target - want[r.src]) < 1e-6 * max(1, want[r.src])
            assert r.taken in (0, r.size, 2 * r.size)
            taken[r.src] = taken.get(r.src, 0) + r.taken
        slack = max(largest.values(), default=0)
        assert all(abs(taken[s] - want[s]) <= 2 * slack for s in taken)
        again = mixing.mix(mixing.sized(docs.repartition(5))).collect()
        key = lambda r: (repr(r.doc_id), r.size, r.taken)
        assert sorted(map(key, out)) == sorted(map(key, again))


def test_mix_takes_what_a_plain_queue_takes(sf_docs):
    hashed = mixing.sized(sf_docs).withColumn("turn", F.xxhash64(F.lit(mixing.SEED), "doc_id", "size"))
    rows = sorted(map(tuple, hashed.select("src", "turn", "doc_id", "size").collect()), key=lambda r: (r[0] is None, r[0] or "", r[1:]))
    names = list(dict.fromkeys(r[0] for r in rows))
    total = {s: sum(r[3] for r in rows if r[0] == s) for s in names}
    queue, taken, left = [], dict.fromkeys((r[2] for r in rows), 0), 1.5 * sum(total.values())
    for i, s in enumerate(names):  # virtual finish time: words of the source so far, over its weight
        done = 0
        for epoch in (0, 1):
            for _, turn, doc_id, size in (r for r in rows if r[0] == s):
                done += size
                queue.append((done / mixing.WEIGHTS[i % 3], i, epoch, turn, doc_id, size))
    for *_, doc_id, size in sorted(queue):
        left -= size
        if left < 0:
            break
        taken[doc_id] += size
    assert {r.doc_id: r.taken for r in mixing.mix_report(sf_docs).collect()} == taken


def test_mixed_documents(sf_docs):
    mixed = mixing.mix_documents(sf_docs)
    assert mixed.columns == sf_docs.columns
    report = {r.doc_id: r for r in mixing.mix(mixing.sized(sf_docs)).collect()}
    seen = {}
    for r in mixed.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {d: r.copies for d, r in report.items() if r.copies}


# pieces of the methods


def test_suffix_sort_orders_by_bytes():
    rnd = np.random.default_rng(2)
    rows = rnd.integers(0, 2, (300, 12)).astype(np.uint8)
    group = np.sort(rnd.integers(0, 12, 300))
    order, common = suffix_dedup.suffix_sort(rows, group)
    keys = [(group[i], rows[i].tobytes()) for i in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(300))
    for i in range(1, 300):
        a, b = rows[order[i - 1]], rows[order[i]]
        if group[order[i]] == group[order[i - 1]]:
            assert common[i] == (12 if (a == b).all() else int(np.argmax(a != b)))


def test_a_hash_collision_is_mended():
    rows = np.array([[3, 1], [1, 2], [2, 9], [1, 1]], np.uint8)
    order = np.array([0, 1, 2, 3])
    common = suffix_dedup._verified(rows, np.zeros(4, np.int64), order)
    assert order.tolist() == [3, 1, 2, 0] and common.tolist() == [0, 1, 0, 0]


def test_signatures_within_the_distance_share_a_key():
    rnd = np.random.default_rng(4)
    a = rnd.integers(0, 256, (200, near_dedup.SYMBOLS)).astype(np.uint8)
    b = a.copy()
    for row in b:
        row[rnd.choice(near_dedup.SYMBOLS, near_dedup.DISTANCE, replace=False)] ^= 1
    assert (near_dedup.chunk_keys(a) == near_dedup.chunk_keys(b)).any(axis=1).all()


def test_good_turing_stays_between_zero_and_one():
    d = katz.discounts(np.array([0, 100, 40, 20, 12, 8, 6]))
    assert ((d[1:katz.CUT + 1] > 0) & (d[1:katz.CUT + 1] < 1)).all() and d[katz.CUT + 1] == 1
    assert katz.discounts(np.zeros(katz.CUT + 2))[1] == 0.5


# the whole


def test_pipeline_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    report = {r.doc_id: r.kept for r in quality.quality_report(docs).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if report[r.doc_id]]
    stay = {d for d, _, _, kept in brute.near_rows(rows, corpus_pipeline.NEAR_PERCENT) if kept}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d: t for d, t in rows if d in stay and not any(overlap(i, t) >= 0.8 for i in items)}
    left = docs.where(docs.doc_id.isin(list(clean)))
    copies = {r.doc_id: r.copies for r in mixing.mix(mixing.sized(left)).collect()}
    repeated = [(d, t) for d, t in clean.items() for _ in range(copies[d])]
    want = brute.token_rows(repeated, Tokenizer.from_file(public_tokenizers.path(TOKENIZER)))
    got = corpus_pipeline.run(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_every_operator_is_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("module", ["panelcast.plans.catalog", "panelcast.session"])
def test_nothing_else_imports_this(module):
    code = f"import sys, {module}; sys.exit(any('.llm' in m for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(corpus_pipeline.__file__)).returncode == 0


def test_components(spark):
    from panelcast.llm.components import components
    rnd = np.random.default_rng(6)
    links = [(i, i + 1) for i in range(0, 60)] + [tuple(map(int, x)) for x in rnd.integers(100, 200, (70, 2))] + [(500, 500), (7, 6), (300, 999)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    want = {x: root(x) for x in parent if x != 500}
    alone = {x for a, b in links if a == b for x in (a,)} - {x for a, b in links if a != b for x in (a, b)}
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: r for x, r in want.items() if x not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# near copies at the pipeline's similarity


def edited(words, at):
    return " ".join(f"edit{i}" if i in at else w for i, w in enumerate(words))


def test_distances_follow_the_similarity():
    assert near_dedup.distance(85) == near_dedup.DISTANCE == 24 and near_dedup.distance(80) == 28
    rnd = np.random.default_rng(7)
    for percent in (90, 85, 80, 70, 50):
        most = near_dedup.distance(percent)
        assert sum(rnd.binomial(near_dedup.SYMBOLS, 1 - percent / 100, 100_000) > most) <= 8
        a = rnd.integers(0, 1 << 16, (100, near_dedup.SYMBOLS)).astype(np.uint16)
        b = a.copy()
        for row in b:
            row[rnd.choice(near_dedup.SYMBOLS, most, replace=False)] ^= 1
        assert (near_dedup.chunk_keys(a, most) == near_dedup.chunk_keys(b, most)).any(axis=1).all()


def test_links_at_lower_similarities(make_docs):
    rnd = np.random.default_rng(8)
    rows = []
    for k in range(150):
        words = [f"d{k}w{j}" for j in range(120)]
        n = int(rnd.integers(1, 9))
        rows += [(2 * k, " ".join(words), "s"), (2 * k + 1, edited(words, {10 + 13 * i for i in range(n)}), "s")]
    for percent in (80, 60):
        got = near_dedup.near_duplicates(make_docs(rows), percent).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted(brute.near_rows([r[:2] for r in rows], percent))


def test_full_sets_decide_within_a_family():
    sets = [np.arange(100, dtype=np.uint64), np.arange(8, 108, dtype=np.uint64)]
    assert near_dedup.similar(sets, 80)(0, np.array([1])).all() and not near_dedup.similar(sets, 90)(0, np.array([1])).any()


def test_one_row_of_each_group_stays_whatever_its_id(make_docs):
    words = [f"word{i}" for i in range(120)]
    text, near = " ".join(words), edited(words, {60})
    unique = [" ".join(f"u{k}x{i}" for i in range(30)) for k in range(4)]
    rows = [(5, text, "a"), (None, near, "a"), (None, unique[0], "a"), (5, unique[1], "b"), (9, text, "b"), (9, unique[2], "b"),
            (None, None, "c"), (None, "  ", "c"), (2 ** 60 + 1, unique[3], "a"), (2 ** 60 + 1, unique[3], "a"), (2 ** 60 + 2, unique[3], "a")]
    for same_id in (None, 7):
        rows += [(same_id, f"only {same_id} " + " ".join(f"c{same_id}x{i}" for i in range(30)), "d")] * 6
    docs = make_docs(rows)
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.source) for r in kept.collect()), key=repr)
    gone = [(None, near, "a"), (9, text, "b"), rows[9], rows[10]] + [rows[11]] * 5 + [rows[17]] * 5
    want = list(rows)
    for r in gone:
        want.remove(r)
    assert got == sorted(want, key=repr)


def test_the_pipelines_stage_links_at_eighty_percent(spark, sf_docs, make_docs):
    words = [f"word{i}" for i in range(120)]
    rows = [(1, " ".join(words), "a"), (2, edited(words, {30, 90}), "a"), (3, edited(words, {20, 50, 80}), "b")]  # 0.841 and 0.771
    for docs in (make_docs(rows), sf_docs):
        plain = [(r.doc_id, r.text) for r in docs.collect()]
        want = {d for d, _, _, kept in brute.near_rows(plain, 80) if kept}
        assert want < {d for d, _, _, kept in brute.near_rows(plain, 85) if kept}
        assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()) == sorted(want)
