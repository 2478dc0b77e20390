"""Tokenizing inside tasks: the library's tokenizer, each distinct piece encoded once."""

from __future__ import annotations

import functools
import os
import re
from array import array

import numpy as np

#: Unicode White_Space, as the byte-level pre-tokenizer's \s means it (fixed values).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Letters that a run of letters is looked for in (fixed ranges, all of them letters to the pre-tokenizer).
LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
#: The pre-tokenizer never joins what this splits: a whole run of letters with at most one space before it,
#: what is left of a run of non-blanks, and blanks.
PIECE = re.compile(f" ?[{LETTER}]+(?![^\\W\\d_])| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
WORD_PIECE = re.compile(f" ?[{LETTER}]+")
#: Longer pieces are encoded but not remembered; so many pieces are remembered at most.
MAX_PIECE, MAX_PIECES = 64, 1_000_000


class _Remembered(dict):
    """What pieces were encoded to.  When half of the pieces allowed are held, those not asked for since the last time go."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.older = encode, most, {}

    def __missing__(self, piece: str) -> bytes:
        made = self.older.get(piece)
        if made is None:
            made = self.encode(piece)
        if len(piece) <= MAX_PIECE:
            if len(self) >= self.most // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = made
        return made


class PieceEncoder:
    """Encodes whole texts with a byte-level tokenizer file, remembering pieces.

    The pre-tokenizer cuts a text before the merges and no merge crosses a
    cut, so the ids of a text are those of its pieces in order.  A run of
    letters is one word to the pre-tokenizer, so its new ones go straight to
    the library's model; all other new pieces take the library's whole way.
    Texts that hold a special token's string are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.vocabulary = self.tokenizer.get_vocab_size()
        written = self.tokenizer.pre_tokenizer.pre_tokenize_str
        #: how the model writes the characters of words
        self.letters = {ord(x): written(x)[0][0] for x in (" ", *re.findall(f"[{LETTER}]", "".join(map(chr, range(0x250)))))}
        self.known = {"ids": _Remembered(self._ids, MAX_PIECES), "offsets": _Remembered(self._offsets, MAX_PIECES)}

    def _ids(self, piece: str) -> bytes:
        if WORD_PIECE.fullmatch(piece):
            word = piece.replace(" ", self.letters[32]) if piece.isascii() else piece.translate(self.letters)
            return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def _offsets(self, piece: str) -> bytes:
        """First and end character of each token."""
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).offsets, "<u4").tobytes()

    def _pieces(self, text: str) -> list[str]:
        return [text] if any(s in text for s in self.special) else PIECE.findall(text)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        known = self.known["ids"].__getitem__
        return [np.frombuffer(b"".join(map(known, self._pieces(x))), "<u4") for x in texts]

    def spans(self, texts: list[str]) -> list[np.ndarray]:
        """Per text an (n_tokens, 2) array of the characters each token covers, from and to."""
        known, out = self.known["offsets"].__getitem__, []
        for pieces in map(self._pieces, texts):
            got = list(map(known, pieces))
            rel = np.frombuffer(b"".join(got), "<u4").reshape(-1, 2).astype(np.int64)
            starts = np.cumsum([0, *map(len, pieces)])[:-1]
            out.append(rel + np.repeat(starts, [len(g) // 8 for g in got])[:, None] if len(rel) else rel)
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One per worker process and file."""
    return PieceEncoder(path)


def in_batches(texts, limit: int = 1 << 20):
    """Runs of texts of about ``limit`` characters, as (first, last + 1)."""
    first = size = 0
    for i, x in enumerate(texts):
        size += len(x)
        if size >= limit:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)
