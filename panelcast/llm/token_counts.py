"""Token counts by offset-mapped attribution.

The fields of a document are joined by line feeds and encoded once, as a
whole.  Sections are the fields, and the last field's lines; a line feed
belongs to what it ends.  Every token's character span is joined to the
sections it overlaps.  Rule: a token goes to the section that holds most of
its characters, on a tie to the first of them; so counts add up to the
tokens of the whole.

Defined results: a null field counts as empty; an empty field still has its
line feed; repeated rows are counted each; an empty table gives an empty
result; only the id and the named fields are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import exact_id, id_values, ids_of
from .tokens import encoder, in_batches

FIELDS = ("source", "lang", "text")


def attribute(spans: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether it crosses a boundary; ``starts``: ascending first characters, the first 0."""
    first = np.searchsorted(starts, spans[:, 0], "right") - 1
    last = np.searchsorted(starts, np.maximum(spans[:, 1] - 1, spans[:, 0]), "right") - 1
    crossing = first != last
    where = first.copy()
    for i in np.flatnonzero(crossing):
        a, b = spans[i]
        edges = np.concatenate(([a], starts[first[i] + 1:last[i] + 1], [b]))
        where[i] = first[i] + int(np.argmax(np.diff(edges)))
    return where, crossing


def count_tokens(docs: DataFrame, tokenizer: str, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Per document: n_tokens, one count per field, crossing_tokens, n_sections, section_tokens of the last field's lines."""
    names = [f"{f}_tokens" for f in fields]

    def count(batches):
        coder = encoder(tokenizer)
        for pdf in batches:
            rows = []
            whole = list(pdf["whole"])
            heads = pdf[[f"_len{i}" for i in range(len(fields) - 1)]].to_numpy(np.int64)
            for a, b in in_batches(whole):
                for text, head, spans in zip(whole[a:b], heads[a:b], coder.spans(whole[a:b])):
                    field_starts = np.concatenate(([0], np.cumsum(head + 1)))
                    body = int(field_starts[-1])
                    lines = body + 1 + np.flatnonzero(np.frombuffer(text[body:].encode("utf-32-le"), "<u4") == 10)
                    lines = lines[lines < len(text)]  # nothing follows a last line feed
                    starts = np.concatenate((field_starts, lines))
                    where, crossing = attribute(spans, starts)
                    per = np.bincount(where, minlength=len(starts)) if len(spans) else np.zeros(len(starts), np.int64)
                    k = len(fields) - 1
                    rows.append((len(spans), *per[:k].tolist(), int(per[k:].sum()), int(crossing.sum()), len(starts) - k,
                                 per[k:].tolist()))
            out = pd.DataFrame(rows, columns=["n_tokens", *names, "crossing_tokens", "n_sections", "section_tokens"])
            out.insert(0, "doc_id", id_values(ids_of(pdf, "doc_id")))
            yield out

    texts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    rendered = docs.select(*exact_id("doc_id"), F.concat_ws("\n", *texts).alias("whole"),
                           *[F.length(x).cast("long").alias(f"_len{i}") for i, x in enumerate(texts[:-1])])
    kinds = ", ".join(f"{n} long" for n in ("n_tokens", *names, "crossing_tokens", "n_sections"))
    return rendered.mapInPandas(count, f"doc_id long, {kinds}, section_tokens array<long>")
