"""Each operator against its plain Python version."""

import math

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelcast.llm import katz, near_dedup, suffix_dedup, suffix_trees, token_files
from panelcast.llm.queries import TOKENIZER

from . import brute
from .conftest import odd_rows


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.fixture(params=["driver", "odd", "empty"])
def docs(request, sf_docs, make_docs):
    return {"driver": lambda: sf_docs, "odd": lambda: make_docs(odd_rows()), "empty": lambda: sf_docs.limit(0)}[request.param]()


def plain(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_token_files(docs):
    path = public_tokenizers.path(TOKENIZER)
    got = token_files.token_output(docs, path, length=128, file_ids=20_000)
    want = brute.token_rows(plain(docs), Tokenizer.from_file(path))
    order = lambda rows: sorted((repr(d), n, c) for d, _, n, c in rows)
    found = rows_of(got, "doc_id", "start", "n_tokens", "ids_crc32")
    assert order(found) == order(want)
    # rows of one id may stand in either order
    assert sorted((s, d) for d, s, *_ in found if d is not None)[:1] == sorted((s, d) for d, s, *_ in want if d is not None)[:1]
    at = 0
    for d, s, n, _ in sorted(found, key=lambda r: r[1]):
        assert s == at
        at += n
    keys = [brute.key(d) for d, *_ in sorted(found, key=lambda r: r[1])]
    assert keys == sorted(keys)


def test_suffix_dedup(docs):
    got = suffix_dedup.remove_repeats(docs)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute.byte_rows(plain(docs)), key=repr)


def test_suffix_trees(docs):
    got = suffix_trees.remove_repeats(docs)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.word_rows(plain(docs)), key=repr)


def test_hot_anchors_are_split(docs):
    rows = plain(docs)
    got = suffix_trees.remove_repeats(docs, hot=1)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.word_rows(rows), key=repr)
    got = suffix_dedup.remove_repeats(docs, hot=1)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute.byte_rows(rows), key=repr)


@pytest.mark.parametrize("tile, large", [(near_dedup.TILE, near_dedup.LARGE), (3, near_dedup.LARGE), (3, 1)])
def test_near_dedup(docs, tile, large, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE", tile)
    monkeypatch.setattr(near_dedup, "LARGE", large)
    got = near_dedup.near_duplicates(docs)
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(brute.near_rows(plain(docs)), key=repr)


def test_katz(docs):
    rows = plain(docs)
    got = katz.score_documents(docs, block_bytes=50_000)
    found = rows_of(got, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    want = sorted(brute.base_scores(rows), key=repr)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert all(math.isclose(a[5], b[5], rel_tol=1e-9) for a, b in zip(found, want))
    scores, p1, p2, uni, unknown = brute.katz_scores(rows)
    found, want = sorted(rows_of(got, "doc_id", "score"), key=repr), sorted(scores, key=repr)
    for (a, x), (b, y) in zip(sorted(found, key=lambda r: (repr(r[0]), r[1])), sorted(want, key=lambda r: (repr(r[0]), r[1]))):
        assert a == b and math.isclose(x, y, rel_tol=1e-9)
    if uni:  # the model adds up to one over the known words and one unknown word
        assert math.isclose(sum(map(p1, uni)) + unknown, 1, rel_tol=1e-9)
        for h in list(uni)[:5]:
            assert math.isclose(sum(p2(h, w) for w in uni) + p2(h, "\0"), 1, rel_tol=1e-9)
