"""Token ids as flat unsigned files with 64-bit document offsets, read back through memory maps.

``write_ids`` deals documents to ranges of ``doc_id``, encodes each range in
order and writes three files for it under a folder that all executors share:

* ``part-N.tokens``: the ids, little-endian unsigned 16 bits if the vocabulary fits, else 32;
* ``part-N.offsets``: for each document and the end, the ids before it in this file, 64 bits;
* ``part-N.documents``: the documents' ids, 64 bits.

A part's base, the ids in all parts before it, is a prefix sum over one number
per part; a document's place is base plus offset. ``read_ids`` gives each part
to one task, which maps its files. Files are written under an attempt's own
name and renamed, so a lost executor's work is simply done again.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate
from typing import NamedTuple
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm.common import id_and_text, shuffle_width, slices, store_of
from tallyhouse.llm.tokens import word_ids
from tallyhouse.session import new_table_path

#: Stands for a null id in the documents file.
NO_ID = -(1 << 63)


class Part(NamedTuple):
    """One range of documents: file stem, ids before it, ids and documents in it."""
    stem: str
    base: int
    n_tokens: int
    n_documents: int


class FlatIds(NamedTuple):
    """What ``write_ids`` wrote: the folder, the type of an id and the parts in order."""
    folder: str
    dtype: str
    parts: list[Part]


def _write_part(folder: str, tokenizer: str, end_id: int, batches: Iterator[pa.RecordBatch]):
    encoder = word_ids(tokenizer)
    end = np.array([end_id], encoder.dtype).tobytes()
    store, root = store_of(folder)
    context = TaskContext.get()
    stem, attempt = f"part-{context.partitionId():06d}", f"{context.taskAttemptId()}-{uuid4().hex}"
    names = {kind: f"{root}/{stem}.{kind}" for kind in ("tokens", "offsets", "documents")}
    at, documents = 0, 0
    streams = {}
    for batch in slices(batches):
        if not streams:
            streams = {kind: store.open_output_stream(f"{name}.{attempt}") for kind, name in names.items()}
        lengths = []
        for text in batch.column("text").to_pylist():
            ids = encoder.encode(text) + end
            lengths.append(len(ids) // encoder.dtype.itemsize)
            streams["tokens"].write(ids)
        starts = at + np.concatenate([[0], np.cumsum(lengths)])
        streams["offsets"].write(starts[:-1].astype("<i8").tobytes())
        streams["documents"].write(batch.column("doc_id").fill_null(NO_ID).to_numpy().astype("<i8").tobytes())
        at, documents = int(starts[-1]), documents + batch.num_rows
    if not streams:
        return
    streams["offsets"].write(np.array([at], "<i8").tobytes())
    for kind, stream in streams.items():
        stream.close()
        try:
            store.move(f"{names[kind]}.{attempt}", names[kind])
        except OSError:  # a store whose rename does not replace: another attempt was first, with the same content
            store.delete_file(f"{names[kind]}.{attempt}")
    yield pa.RecordBatch.from_pydict({"stem": [stem], "n_tokens": [at], "n_documents": [documents]},
                                     pa.schema([("stem", pa.string()), ("n_tokens", pa.int64()),
                                                ("n_documents", pa.int64())]))


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, id_column: str = "doc_id",
              text_column: str = "text", folder: str | None = None) -> FlatIds:
    """Write the ids of all documents, each followed by ``end_id``, in ascending order of id.

    A null text is empty and gives the end id alone. Null ids come first;
    rows that share an id stay next to each other and may lie in two parts,
    so one id with very many rows does not make one task. An empty table
    gives no part. Control strings inside texts are ordinary text.
    """
    spark = docs.sparkSession
    folder = folder or new_table_path(spark, "flat-ids")
    store, root = store_of(folder)
    store.create_dir(root, recursive=True)
    ordered = (id_and_text(docs, id_column, text_column)
               .withColumn("tie", F.monotonically_increasing_id())
               .repartitionByRange(shuffle_width(spark), "doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))
    sizes = ordered.mapInArrow(lambda batches: _write_part(folder, tokenizer, end_id, batches),
                               "stem string, n_tokens long, n_documents long")
    found = sorted(sizes.collect())  # one row for each part
    bases = [0, *accumulate(row.n_tokens for row in found)]
    return FlatIds(folder, word_ids(tokenizer).dtype.str,
                   [Part(row.stem, base, row.n_tokens, row.n_documents)
                    for row, base in zip(found, bases)])


def _mapped(store: fs.FileSystem, name: str, dtype: str) -> np.ndarray:
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(name, dtype, "r")
    with store.open_input_file(name) as file:
        return np.frombuffer(file.read_buffer(), dtype)


def read_ids(spark: SparkSession, flat: FlatIds, per_document: Callable[[np.ndarray], dict],
             columns: str, fields: list[tuple[str, pa.DataType]]) -> DataFrame:
    """One row per stored document: doc_id, start, n_tokens and what ``per_document`` makes of its ids.

    ``columns`` and ``fields`` name and type the latter for Spark and for Arrow.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), *fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(flat.folder)
        for batch in batches:
            for number in batch.column("id").to_pylist():
                part = flat.parts[number]
                stem = f"{root}/{part.stem}"
                offsets, documents = (_mapped(store, f"{stem}.{kind}", "<i8") for kind in ("offsets", "documents"))
                tokens = _mapped(store, f"{stem}.tokens", flat.dtype)
                for first in range(0, len(documents), 4096):
                    ids = documents[first:first + 4096]
                    starts = offsets[first:first + len(ids) + 1]
                    made = [per_document(tokens[a:b]) for a, b in zip(starts[:-1], starts[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, mask=np.asarray(ids) == NO_ID), pa.array(part.base + starts[:-1]),
                         pa.array(np.diff(starts)),
                         *(pa.array([m[name] for m in made], kind) for name, kind in fields)], schema=schema)

    numbers = spark.range(0, len(flat.parts), 1, max(1, len(flat.parts)))
    return numbers.mapInArrow(read, f"doc_id long, start long, n_tokens long, {columns}")


def crc_of_ids(ids: np.ndarray) -> dict:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}
