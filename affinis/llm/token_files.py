"""Token ids of all documents in Arrow files of equal-length sequences, and random access to them.

The documents are laid out in ascending order of id, each followed by an end id, as one stream. A file holds one range of that
order, cut into sequences of ``length`` ids; its last sequence is filled up with the end id. Each file is an Arrow IPC file whose
record batches have two fixed-size-list columns, ``ids`` and ``mask`` (true: an id of the stream, false: filling), uncompressed, so
a memory-mapped file gives any sequence without copying or reading the others. An index table tells for every document its file and
the place of its first id there.

Tasks write to names of their own, and the index holds the names of those that ended well, so a lost executor or a task
that ran twice leaves at most files that nothing refers to.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinis.llm import words as W
from affinis.llm.common import text_of
from affinis.llm.tokens import BATCH_BYTES, encoder
from affinis.operators.staging import materialize, staging_root

LENGTH = 1024
SEQUENCES = 1024
END_ID = 2


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that all executors share, whatever store it is in."""
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def _schema(length: int, id_type: str) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(np.dtype(id_type)), length)), ("mask", pa.list_(pa.bool_(), length))])


def _sequences(ids: np.ndarray, used: int, schema: pa.Schema) -> pa.RecordBatch:
    length = schema.field("ids").type.list_size
    mask = np.arange(len(ids)) < used
    return pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(ids), length),
                                       pa.FixedSizeListArray.from_arrays(pa.array(mask), length)], schema=schema)


def write_token_files(docs: DataFrame, path: str, folder: str, doc_id: str = "doc_id", text: str = "text",
                      length: int = LENGTH, end_id: int = END_ID, id_type: str = "<u2") -> DataFrame:
    """Write the token files of ``docs`` to ``folder`` (a path or URI that all executors reach); the index as a stored table.

    Index: ``doc_id``, ``file`` (name), ``part`` (files in order of ``part`` hold ascending ids), ``first`` (place of the document's
    first id in the file), ``n_tokens`` (with the end id). Null ids come first; rows of one id are ordered by their text. A null or
    empty text has the end id only. An empty table writes no file.
    """
    schema = _schema(length, id_type)
    room = length * SEQUENCES

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, id_type)
        end = np.array([end_id], id_type).tobytes()
        fs, root = _place(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.arrow"
        writer = stream = None
        waiting, held, place = [], 0, 0
        for batch in batches:
            texts = W.plain(batch.column("text"))
            for i, j in W.chunks(texts, BATCH_BYTES):
                if writer is None:
                    fs.create_dir(root, recursive=True)
                    stream = fs.open_output_stream(f"{root}/{name}")
                    writer = pa.ipc.new_file(stream, schema)
                encoded = [ids + end for ids in own.ids(texts.slice(i, j - i).to_pylist())]
                counts = np.array([len(x) // own.width for x in encoded], np.int64)
                waiting += encoded
                held += int(counts.sum())
                if held >= room:
                    ids = np.frombuffer(b"".join(waiting), id_type)
                    whole = held // room * room
                    for k in range(0, whole, room):
                        writer.write_batch(_sequences(ids[k: k + room], room, schema))
                    waiting, held = [ids[whole:].tobytes()], held - whole
                first = place + np.cumsum(counts) - counts
                place += int(counts.sum())
                rows = j - i
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, rows), pa.array([name] * rows), pa.array([part] * rows, pa.int32()),
                    pa.array(first), pa.array(counts)], names=["doc_id", "file", "part", "first", "n_tokens"])
        if writer is not None:
            if held:
                ids = np.full(-(-held // length) * length, end_id, id_type)
                ids[:held] = np.frombuffer(b"".join(waiting), id_type)
                writer.write_batch(_sequences(ids, held, schema))
            writer.close()
            stream.close()

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    # the hash and a number spread the rows of one id, or without one, over many files
    keys = ["doc_id", "_mark", "_number"]
    rows = rows.withColumns({"_mark": F.xxhash64("text"), "_number": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    return materialize(ordered.mapInArrow(write, f"doc_id {kind}, file string, part int, first long, n_tokens long"),
                       "token-index")


class TokenFile:
    """Random access to the sequences of one file; memory-mapped where the store is local."""

    def __init__(self, folder: str, name: str):
        fs, root = _place(folder)
        local = isinstance(fs, pafs.LocalFileSystem)
        self.source = pa.memory_map(f"{root}/{name}") if local else fs.open_input_file(f"{root}/{name}")
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.at, self.batch = -1, None

    def sequences(self, number: int) -> pa.RecordBatch:
        """The record batch with the given number."""
        if self.at != number:
            self.at, self.batch = number, self.reader.get_batch(number)
        return self.batch

    def ids(self, first: int, count: int) -> np.ndarray:
        """``count`` ids of the stream from place ``first``: a view if they lie in one batch."""
        room = self.length * SEQUENCES
        found = []
        while count:
            number, inside = divmod(first, room)
            column = self.sequences(number).column("ids")
            take = min(count, room - inside)
            values = column.flatten()
            found.append(values.slice(inside, take).to_numpy(zero_copy_only=True))
            first, count = first + take, count - take
        return found[0] if len(found) == 1 else np.concatenate(found)

    def close(self) -> None:
        self.source.close()


def read_documents(index: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` for each row of the index, from the files.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is the CRC of its ids as little-endian 32-bit numbers.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = opened = None
        for batch in batches:
            sums = []
            columns = (batch.column(c).to_pylist() for c in ("file", "first", "n_tokens"))
            for file, first, count in zip(*columns, strict=True):
                if file != name:
                    if opened is not None:
                        opened.close()
                    name, opened = file, TokenFile(folder, file)
                sums.append(zlib.crc32(opened.ids(first, count).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start", "n_tokens")),
                                              pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
        if opened is not None:
            opened.close()

    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = index.groupBy(F.col("part").alias("_part")).agg(F.sum("n_tokens").alias("_size"))
    # one row per file
    starts = F.broadcast(sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")))
    rows = index.join(starts, F.col("part") == F.col("_part")).select(
        "doc_id", "file", "first", "n_tokens", (F.col("_before") + F.col("first")).alias("start"))
    kind = index.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(read, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def tokens_by_document(docs: DataFrame, path: str, folder: str | None = None, **options) -> DataFrame:
    """Write the token files (to a new folder in the shared one, if none is given) and read every document back from them."""
    folder = folder or f"{staging_root(docs.sparkSession)}/affinis/tokens-{uuid.uuid4().hex}"
    return read_documents(write_token_files(docs, path, folder, **options), folder)
