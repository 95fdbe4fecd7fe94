"""Token ids in Arrow files of equal-length sequences, with masks.

Documents are dealt out by ranges of their key, sorted, encoded and written, one
file per task: the ids of its documents in one row after another, cut into
sequences of ``length`` ids.  A file's record batches hold a fixed-size list of
ids (the smallest unsigned type that takes the vocabulary) and a fixed-size list
of mask bits; only a file's last sequence is padded, with mask 0.  All batches but the
last have the same number of sequences, so sequence k lies in batch k // rows at
row k % rows, and a memory-mapped file gives it without a copy.  Beside each file lies
one with its documents: key, first id's place in the file, count of ids.

Tasks write under names of their own and hand back one row per file; those rows,
stored, are the manifest.  Files of failed or repeated attempts are in no
manifest and are never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm.tokens import WORD_BPE, encoded, encoder
from gleanery.sources.scratch import written

END, LENGTH, ROWS = 1, 2048, 256

_MANIFEST = "part int, file string, n_docs bigint, n_ids bigint"


class _Writer:
    """One file of sequences, and the one of its documents."""

    def __init__(self, root: str, part: int, key: pa.Field, ids: pa.DataType, length: int, rows: int):
        self._fs, folder = fs.FileSystem.from_uri(root)
        self._fs.create_dir(folder, recursive=True)
        self.file = f"part-{part:06d}-{uuid.uuid4().hex}"
        self._ids, self._length, self._rows, self._key = ids, length, rows, key
        schema = pa.schema([pa.field("ids", pa.list_(ids, length)), pa.field("mask", pa.list_(pa.bool_(), length))])
        self._out = pa.ipc.new_file(self._fs.open_output_stream(f"{folder}/{self.file}.arrow"), schema)
        self._docs = pa.ipc.new_file(
            self._fs.open_output_stream(f"{folder}/{self.file}.docs.arrow"),
            pa.schema([key, pa.field("start", pa.int64()), pa.field("n_tokens", pa.int64())]),
        )
        self._rest, self.n_docs, self.n_ids = b"", 0, 0

    def add(self, keys: pa.Array, packed: list[bytes]) -> None:
        counts = np.array([len(p) // 4 for p in packed], np.int64)
        starts = self.n_ids + np.cumsum(counts) - counts
        self._docs.write_batch(pa.record_batch([keys, pa.array(starts), pa.array(counts)], schema=self._docs_schema))
        self.n_docs += len(packed)
        self.n_ids += int(counts.sum())
        self._rest += b"".join(packed)
        step = 4 * self._length * self._rows
        whole = len(self._rest) // step * step
        for at in range(0, whole, step):
            self._write(np.frombuffer(self._rest, "<u4", step // 4, at))
        self._rest = self._rest[whole:]

    @property
    def _docs_schema(self) -> pa.Schema:
        return pa.schema([self._key, pa.field("start", pa.int64()), pa.field("n_tokens", pa.int64())])

    def _write(self, ids: np.ndarray) -> None:
        padding = -len(ids) % self._length
        values = pa.array(np.append(ids, np.zeros(padding, "<u4")).astype(self._ids.to_pandas_dtype()))
        mask = pa.array(np.arange(len(ids) + padding) < len(ids))
        self._out.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(x, self._length) for x in (values, mask)], names=["ids", "mask"]))

    def close(self) -> None:
        if self._rest:
            self._write(np.frombuffer(self._rest, "<u4"))
        self._out.close()
        self._docs.close()


def write_tokens(docs: DataFrame, root: str, key: str = "doc_id", text: str = "text", tokenizer: str = WORD_BPE, length: int = LENGTH, rows: int = ROWS) -> DataFrame:
    """Writes the ids of *docs*, each followed by ``END``, below *root* in ascending order of *key*; returns the manifest.

    NULL texts are empty: their ids are ``END`` alone.  A NULL *key* sorts first;
    rows with equal keys lie side by side in any order.  Rows with one key are
    split over tasks like any others.  An empty table gives no file and an empty
    manifest.  Other columns are not read.
    """
    ordered = (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("tie"))
        .repartitionByRange("key", "tie")
        .sortWithinPartitions("key", "tie")
        .select("key", "text")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, part, end = None, TaskContext.get().partitionId(), END.to_bytes(4, "little")
        for batch, packed in encoded(batches, "text", tokenizer):
            if out is None:
                ids = pa.uint16() if encoder(tokenizer).size <= 1 << 16 else pa.uint32()
                out = _Writer(root, part, batch.schema.field("key"), ids, length, rows)
            out.add(batch.column("key"), [p + end for p in packed])
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [out.file], "n_docs": [out.n_docs], "n_ids": [out.n_ids]})

    return written(ordered.mapInArrow(run, _MANIFEST), "manifest", f"{root}/manifest", compact=True)


class TokenFile:
    """A file opened for random access; memory-mapped where it is local."""

    def __init__(self, root: str, file: str):
        store, folder = fs.FileSystem.from_uri(root)
        path = f"{folder}/{file}.arrow"
        source = pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)
        self._file = pa.ipc.open_file(source)
        self._docs = pa.ipc.open_file(store.open_input_file(f"{folder}/{file}.docs.arrow"))
        self._rows = self._file.get_batch(0).num_rows if self._file.num_record_batches else 0

    def sequence(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """The ids of sequence *k* and its mask, packed as bits: both are views of the file."""
        batch = self._file.get_batch(k // self._rows)
        ids, mask = batch.column(0)[k % self._rows].values, batch.column(1)[k % self._rows].values
        return ids.to_numpy(), mask

    def ids(self) -> Iterator[np.ndarray]:
        """The ids under the mask, batch by batch."""
        for i in range(self._file.num_record_batches):
            batch = self._file.get_batch(i)
            ids, mask = batch.column(0).flatten(), batch.column(1).flatten()
            yield (ids if mask.true_count == len(mask) else ids.filter(mask)).to_numpy()

    def documents(self) -> Iterator[pa.RecordBatch]:
        for i in range(self._docs.num_record_batches):
            yield self._docs.get_batch(i)


def _checksums(source: TokenFile, counts: Iterable[int]) -> Iterator[int]:
    blocks, block = source.ids(), np.empty(0, "<u4")
    for n in counts:
        crc = 0
        while n:
            if not len(block):
                block = next(blocks).astype("<u4")
            crc = zlib.crc32(block[:n], crc)
            n, block = n - len(block[:n]), block[n:]
        yield crc


def read_tokens(spark: SparkSession, root: str, key: T.DataType | None = None) -> DataFrame:
    """Per document of the files below *root*: key, start among all ids, count, and CRC-32 of its ids as 32-bit integers."""
    manifest = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")
    # One row per file: the running sum is over files, not documents.
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # A number is given, or so little data would be gathered into one task.
    files = manifest.select("part", "file", before.alias("before")).repartitionByRange(max(1, manifest.count()), "part")
    schema = T.StructType([T.StructField("key", key or T.LongType()), *(T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32"))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                source = TokenFile(root, row["file"])
                counts = (n for docs in source.documents() for n in docs.column(2).to_pylist())
                crcs = _checksums(source, counts)
                for docs in source.documents():
                    start = pa.array(docs.column(1).to_numpy() + row["before"])
                    crc = pa.array([next(crcs) for _ in range(docs.num_rows)], pa.int64())
                    yield pa.RecordBatch.from_arrays([docs.column(0), start, docs.column(2), crc], names=["key", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, schema)
