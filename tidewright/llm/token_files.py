"""Token ids in Arrow's random-access file format, as sequences of equal length.

Documents are dealt to tasks by ranges of their id. Each task writes the ids of
its documents, one after the other, into one Arrow file of record batches with
two columns of fixed-size lists: ``ids`` and ``mask`` (true where an id is real;
only the last sequence of a file is padded). As every list has the same length,
id number n of a file is at place n of one flat buffer, which a reader maps into
memory and slices without copying.

The index (document, file, first id in the file, number of ids) is a Spark
table; the place of a file in the whole stream is a running sum over files. A
task that is repeated writes another file; only files named by the index count.

Cases: a null text counts as empty and has only its end id. Null ids come last,
equal ids in the order of their texts. An empty table gives no file and an empty
result. Other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm import tokens
from tidewright.llm.common import id_and_text, id_order, written
from tidewright.llm.text import binary
from tidewright.settings import fresh_folder

LENGTH = 2048  # ids in a sequence
SEQUENCES = 256  # sequences in a record batch
END = 1

INDEX = "file string, row bigint, doc_id bigint, start bigint, n_tokens bigint, rank bigint, hash bigint"


def schema(kind: np.dtype, length: int) -> pa.Schema:
    return pa.schema(
        [("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))]
    )


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{folder}")


class Writer:
    """Appends ids to one file, a record batch at a time."""

    def __init__(self, folder: str, name: str, kind: np.dtype, length: int):
        store, path = filesystem(folder)
        store.create_dir(path)
        self.kind, self.length = kind, length
        self.sink = store.open_output_stream(f"{path}/{name}")
        self.file = ipc.new_file(self.sink, schema(kind, length))
        self.waiting: list[bytes] = []
        self.size = 0

    def add(self, ids: bytes) -> None:
        self.waiting.append(ids)
        self.size += len(ids) // self.kind.itemsize
        if self.size >= SEQUENCES * self.length:
            self._write(self.size // self.length * self.length)

    def _write(self, n: int, padding: int = 0) -> None:
        flat = np.frombuffer(b"".join(self.waiting), self.kind)
        self.waiting, self.size = [flat[n:].tobytes()], len(flat) - n
        real = np.ones(n + padding, bool)
        real[n:] = False
        ids = np.concatenate([flat[:n], np.zeros(padding, self.kind)])
        for at in range(0, n + padding, SEQUENCES * self.length):
            part = slice(at, at + SEQUENCES * self.length)
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(v[part]), self.length) for v in (ids, real)]
            self.file.write_batch(pa.RecordBatch.from_arrays(columns, ["ids", "mask"]))

    def close(self) -> None:
        if self.size:
            self._write(self.size, -self.size % self.length)
        self.file.close()
        self.sink.close()


class Reader:
    """Random access to the ids of one file; nothing is copied from a local file."""

    def __init__(self, folder: str, name: str):
        store, path = filesystem(folder)
        local = isinstance(store, fs.LocalFileSystem)
        source = pa.memory_map(f"{path}/{name}") if local else store.open_input_file(f"{path}/{name}")
        self.file = ipc.open_file(source)
        self.length = self.file.schema.field("ids").type.list_size
        # All record batches but the last have as many sequences as the first at least.
        self.rows = [self.file.get_batch(k).num_rows for k in range(self.file.num_record_batches)]
        self.first = np.concatenate([[0], np.cumsum(self.rows)]) * self.length

    def _flat(self, column: int, start: int, n: int) -> np.ndarray:
        parts = []
        k = int(np.searchsorted(self.first, start, "right")) - 1
        while n > 0:
            flat = self.file.get_batch(k).column(column).flatten()
            at = start - int(self.first[k])
            part = flat.slice(at, n).to_numpy(zero_copy_only=column == 0)
            parts.append(part)
            start, n, k = start + len(part), n - len(part), k + 1
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def ids(self, start: int, n: int) -> np.ndarray:
        return self._flat(0, start, n)

    def mask(self, start: int, n: int) -> np.ndarray:
        return self._flat(1, start, n)


def _writes(folder: str, tokenizer: str | None, length: int, end: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer or tokens.default_path())
        last = np.array([end], encode.kind).tobytes()
        name, file, start, row = f"{uuid.uuid4().hex}.arrow", None, 0, 0
        for batch in batches:
            file = file or Writer(folder, name, encode.kind, length)
            starts, sizes = [], []
            for text in binary(batch.column("text")):
                ids = encode.packed(text.as_py()) + last
                file.add(ids)
                starts.append(start)
                sizes.append(len(ids) // encode.kind.itemsize)
                start += sizes[-1]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * n, pa.string()),
                    pa.array(range(row, row + n), pa.int64()),
                    batch.column("doc_id"),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    batch.column("rank"),
                    batch.column("hash"),
                ],
                ["file", "row", "doc_id", "start", "n_tokens", "rank", "hash"],
            )
            row += n
        if file:
            file.close()

    return write


def write_token_files(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    folder: str | None = None,
    tokenizer: str | None = None,
    length: int = LENGTH,
    end: int = END,
) -> tuple[str, DataFrame]:
    """(folder of the files, their index): the ids of all documents in ascending
    order of their ids, each document with ``end`` appended."""
    folder = folder or fresh_folder(docs.sparkSession, "token-files")
    source = id_and_text(docs, id_column, text_column).select(
        "*", id_order().alias("rank"), F.xxhash64("text").alias("hash")
    )
    # Equal ids are told apart by their texts, so no id can fill a range alone.
    placed = source.repartitionByRange("rank", "hash").sortWithinPartitions("rank", "hash", "text")
    return folder, written(placed.mapInArrow(_writes(folder, tokenizer, length, end), INDEX), "token-index")


def _reads(folder: str):
    def read(table: pa.Table) -> pa.Table:
        reader = Reader(folder, table.column("file")[0].as_py())
        sums = []
        for start, n in zip(table.column("local").to_pylist(), table.column("n_tokens").to_pylist()):
            sums.append(zlib.crc32(reader.ids(start, n).astype("<u4")))
        return table.select(["doc_id", "start", "n_tokens"]).append_column(
            "ids_crc32", pa.array(sums, pa.int64())
        )

    return read


def read_token_files(folder: str, index: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before
    it), n_tokens, ids_crc32 (of its ids as little-endian unsigned 32-bit)."""
    files = index.groupBy("file").agg(
        F.sum("n_tokens").alias("size"), F.min(F.struct("rank", "hash")).alias("place")
    )
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    placed = index.join(files, "file").select(
        "file", "doc_id", F.col("start").alias("local"), (F.col("base") + F.col("start")).alias("start"), "n_tokens"
    )
    return placed.groupBy("file").applyInArrow(
        _reads(folder), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_files(docs: DataFrame, **options) -> DataFrame:
    """Writes the files and reads every document back from them."""
    return read_token_files(*write_token_files(docs, **options))
