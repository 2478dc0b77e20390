"""Token-ID output: Arrow files of equal-length sequences and masks.

Documents are encoded in ascending id order, each followed by an end id, and
cut into sequences of ``length`` ids.  A file is an Arrow IPC file whose
batches hold fixed-size-list columns ``input_ids`` and ``mask`` (false: the
padding after a file's last document) and, per sequence, its documents'
``segments``.  Batches have equal numbers of sequences, so sequence i lies in
batch i // BATCH and is read without a copy from a mapped file.

Files lie in the shared folder; a task writes a file aside and renames it, so
a task that runs again replaces its files by equal ones.

Defined results: a null or empty text is its end id alone; null ids come
last; documents of equal id keep one order among themselves; an empty table
gives no file and no row; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.session import ensure_checkpoint_dir

from .common import exact_id, id_values, ids_of, materialise, running_total
from .tokens import encoder, in_batches

LENGTH = 2048
BATCH = 64
#: A file ends with the document that takes it over so many ids.
FILE_IDS = 4 << 20
END_ID = 0


def _place(uri: str):
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def schema(length: int, vocabulary: int) -> pa.Schema:
    segment = pa.struct([("doc_id", pa.int64()), ("n", pa.int32()), ("starts", pa.bool_())])
    kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
    return pa.schema([("input_ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length)),
                      ("segments", pa.list_(segment))])


class _FileWriter:
    """One file: takes documents, writes full batches as they come up, pads the last sequence."""

    def __init__(self, folder: str, name: str, length: int, vocabulary: int):
        self.fs, base = _place(folder)
        self.fs.create_dir(base, recursive=True)
        self.path, self.uri = f"{base}/{name}", f"{folder}/{name}"
        self.aside = f"{base}/.{name}.{uuid.uuid4().hex}"
        self.schema, self.length = schema(length, vocabulary), length
        self.kind = self.schema.field("input_ids").type.value_type.to_pandas_dtype()
        self.sink = self.fs.open_output_stream(self.aside)
        self.out = pa.ipc.new_file(self.sink, self.schema)
        self.parts, self.held, self.segments, self.tokens, self.sequences = [], 0, [[]], 0, 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.parts.append(ids.astype(self.kind))
        left, starts = len(ids), True
        while left:
            room = self.length - (self.tokens % self.length)
            n = min(room, left)
            self.segments[-1].append({"doc_id": doc_id, "n": n, "starts": starts})
            self.tokens, left, starts = self.tokens + n, left - n, False
            if n == room:
                self.segments.append([])
        self.held += len(ids)
        if self.held >= BATCH * self.length:
            self._write(False)

    def _write(self, last: bool) -> None:
        flat = np.concatenate(self.parts) if self.parts else np.zeros(0, self.kind)
        size = BATCH * self.length
        for at in range(0, len(flat) if last else len(flat) - size + 1, size):
            piece = flat[at:at + size]
            rows = -(-len(piece) // self.length)
            padded = np.zeros(rows * self.length, self.kind)
            padded[:len(piece)] = piece
            mask = np.arange(rows * self.length) < len(piece)
            segments, self.segments = self.segments[:rows], self.segments[rows:]
            ids = pa.FixedSizeListArray.from_arrays(pa.array(padded), self.length)
            self.out.write_batch(pa.record_batch(
                [ids, pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
                 pa.array(segments, self.schema.field("segments").type)], schema=self.schema))
            self.sequences += rows
        rest = flat[len(flat) // size * size:]
        self.parts, self.held = ([], 0) if last else ([rest], len(rest))

    def close(self) -> tuple:
        self._write(True)
        self.out.close()
        self.sink.close()
        self.fs.move(self.aside, self.path)
        return self.uri, self.sequences, self.tokens


def write_sequences(docs: DataFrame, folder: str, tokenizer: str, length: int = LENGTH,
                    end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the files under ``folder``; the manifest has (part, file, path, n_sequences, n_tokens) of each."""
    def write(batches):
        coder, part = encoder(tokenizer), TaskContext.get().partitionId()
        made, out = [], None
        for pdf in batches:
            texts, keys = list(pdf["text"]), ids_of(pdf, "doc_id")
            for a, b in in_batches(texts):
                for key, ids in zip(keys[a:b], coder.ids(texts[a:b])):
                    out = out or _FileWriter(folder, f"part-{part:06d}-{len(made):05d}.arrow", length, coder.vocabulary)
                    out.add(key, np.append(ids, np.uint32(end_id)))
                    if out.tokens >= file_ids:
                        made.append((part, len(made), *out.close()))
                        out = None
        if out:
            made.append((part, len(made), *out.close()))
        yield pd.DataFrame(made, columns=["part", "file", "path", "n_sequences", "n_tokens"])

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text"), F.lit(""))
    order = [F.col("doc_id").asc_nulls_last(), "tie"]
    ranged = (docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie"))
              .repartitionByRange(n, *order).sortWithinPartitions(*order).select(*exact_id("doc_id"), "text"))
    return materialise(ranged.mapInPandas(write, "part int, file int, path string, n_sequences long, n_tokens long"))


class SequenceFile:
    """Random access to the sequences of one file: ``file[i]`` is (ids, mask), views of the mapped file."""

    def __init__(self, uri: str):
        fs, path = _place(uri)
        source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(source)
        self.per_batch = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else BATCH

    def __len__(self) -> int:
        n = self.reader.num_record_batches
        return (n - 1) * self.per_batch + self.reader.get_batch(n - 1).num_rows if n else 0

    def __getitem__(self, i: int):
        batch, row = self.reader.get_batch(i // self.per_batch), i % self.per_batch
        ids, mask = batch.column("input_ids"), batch.column("mask")
        length = ids.type.list_size
        whole = ids.values.to_numpy(zero_copy_only=True)
        return (whole[(ids.offset + row) * length:(ids.offset + row + 1) * length],
                mask.values.slice((mask.offset + row) * length, length))

    def documents(self):
        """(doc_id, pieces of ids) of each document in order; a document may take several sequences."""
        key, pieces = None, []
        for b in range(self.reader.num_record_batches):
            batch = self.reader.get_batch(b)
            ids = batch.column("input_ids").values.to_numpy(zero_copy_only=True)
            length = batch.column("input_ids").type.list_size
            for row, segments in enumerate(batch.column("segments").to_pylist()):
                at = row * length
                for s in segments:
                    if s["starts"] and pieces:
                        yield key, pieces
                        pieces = []
                    key = s["doc_id"]
                    pieces.append(ids[at:at + s["n"]])
                    at += s["n"]
        if pieces:
            yield key, pieces


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, read back from the files: doc_id, start, n_tokens, ids_crc32, path."""
    def read(batches):
        for pdf in batches:
            for part, file, path in zip(pdf["part"], pdf["file"], pdf["path"]):
                rows = []
                for at, (key, pieces) in enumerate(SequenceFile(path).documents()):
                    crc = 0
                    for x in pieces:
                        crc = zlib.crc32(x.astype("<u4").tobytes(), crc)
                    rows.append((part, file, at, key, sum(map(len, pieces)), crc, path))
                out = pd.DataFrame(rows, columns=["part", "file", "at", "doc_id", "n_tokens", "ids_crc32", "path"])
                yield out.assign(doc_id=id_values(r[3] for r in rows))

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_file = manifest.select("part", "file", "path").repartition(n, "path")
    found = per_file.mapInPandas(read, "part int, file int, at long, doc_id long, n_tokens long, ids_crc32 long, path string")
    placed = running_total(found, ["part", "file", "at"], "n_tokens", "upto")
    return placed.select("doc_id", (F.col("upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32", "path")


def token_output(docs: DataFrame, tokenizer: str, folder: str | None = None, **how) -> DataFrame:
    """Write the files and read them back; without ``folder`` they go under the session's shared folder."""
    folder = folder or f"{ensure_checkpoint_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    return read_documents(write_sequences(docs, folder, tokenizer, **how))
