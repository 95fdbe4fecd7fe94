"""First-fit decreasing packing of token pieces, in randomised groups.

Documents are cut into whole sequences and one remainder.  Remainders are dealt at
random, by a hash of where their row is stored, to groups of bounded size, however
often a key repeats.  Each group is packed alone: pieces from long to short, each
into the first open sequence that has room, which a tournament tree over the room left
finds in logarithmic time.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm.tokens import BYTE_BPE, encoded
from gleanery.llm.words import tidied
from gleanery.sources.scratch import written

END, LENGTH = 1, 2048
#: Pieces a group holds on average.
GROUP = 4_000


def first_fit_decreasing(sizes: np.ndarray, room: int) -> np.ndarray:
    """For each piece the number of its bin, bins numbered from 0 as they open; each size is from 0 to *room*.

    Leaf b of the tree holds the room left in bin b and an inner node the most below
    it, so the way down that prefers the left child ends at the first bin that fits.
    """
    n = len(sizes)
    leaves = 1 << max(n - 1, 0).bit_length()
    tree = [room] * (2 * leaves)
    bins = np.empty(n, np.int64)
    for piece in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[piece]), 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[piece] = node - leaves
        tree[node] -= size
        while node > 1:
            node //= 2
            a, b = tree[2 * node], tree[2 * node + 1]
            most = a if a > b else b
            if tree[node] == most:
                break
            tree[node] = most
    return bins


def cut(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = BYTE_BPE, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Pieces of at most *length* ids of each document, its ids followed by ``END``.

    One row per piece: the key, start, length, ids_crc32, doc_tokens, and the ids
    if *with_ids*.  NULL texts are empty and give ``END`` alone.
    """
    kept = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    fields = [T.StructField("key", kept.schema["key"].dataType), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens"))]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, step = END.to_bytes(4, "little"), 4 * length
        for batch, packed in encoded(batches, "text", tokenizer):
            whole = [p + end for p in packed]
            rows = [(i, at) for i, p in enumerate(whole) for at in range(0, len(p), step)]
            pieces = [whole[i][at : at + step] for i, at in rows]
            columns = [
                batch.column("key").take(pa.array([i for i, _ in rows], pa.int64())),
                pa.array([at // 4 for _, at in rows], pa.int64()),
                pa.array([len(p) // 4 for p in pieces], pa.int64()),
                pa.array([zlib.crc32(p) for p in pieces], pa.int64()),
                pa.array([len(whole[i]) // 4 for i, _ in rows], pa.int64()),
            ]
            if with_ids:
                offsets = np.cumsum([0, *map(len, pieces)]) // 4
                columns.append(pa.ListArray.from_arrays(offsets.astype(np.int32), np.frombuffer(b"".join(pieces), "<i4")))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return kept.mapInArrow(tidied(run), T.StructType(fields))


def place(pieces: DataFrame, length: int = LENGTH, group: int = GROUP, seed: int = 42) -> DataFrame:
    """Stored *pieces* with sequence_id and offset.

    *pieces* must be read from parquet: a row's group is a hash of its place in the
    files, so that equal rows spread and repeated tasks agree.  Pieces of the whole
    *length* are sequences by themselves and not shuffled.  A sequence_id holds the
    group (or task) above its 32 low bits, so ids are unique without a count over all
    rows; whole sequences have odd high parts.
    """
    n = pieces.filter(F.col("length") < length).count()
    groups = max(1, math.ceil(n / group))
    spot = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"), F.lit(seed))
    rest = pieces.withColumn("group", F.pmod(spot, F.lit(groups))).filter(F.col("length") < length)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def fill(rows: pa.Table) -> pa.Table:
        number = rows.column("group")[0].as_py()
        rows = rows.drop_columns("group").sort_by([("length", "descending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        sizes = rows.column("length").to_numpy()
        bins = first_fit_decreasing(sizes, length)
        order = np.argsort(bins, kind="stable")
        till = np.cumsum(sizes[order])
        first = np.flatnonzero(np.diff(bins[order], prepend=-1))
        before = np.repeat(till[first] - sizes[order][first], np.diff(np.append(first, len(order))))
        offset = np.empty(len(order), np.int64)
        offset[order] = till - sizes[order] - before
        return rows.append_column("sequence_id", pa.array(bins + (2 * number << 32))).append_column("offset", pa.array(offset))

    packed = rest.groupBy("group").applyInArrow(fill, schema)
    task = F.monotonically_increasing_id()  # task number above 33 bits, row below
    alone = (F.shiftright(task, 33) * 2 + 1) * F.lit(1 << 32) + task.bitwiseAND(F.lit((1 << 33) - 1))
    whole = pieces.filter(F.col("length") == length).withColumns({"sequence_id": alone, "offset": F.lit(0).cast("long")})
    return packed.unionByName(whole)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = BYTE_BPE, length: int = LENGTH, group: int = GROUP, with_ids: bool = False) -> DataFrame:
    """*docs* as pieces placed in sequences of at most *length* ids.

    Empty tables give no rows; repeated rows are packed each; a NULL key is kept.
    Columns beside *key* and *text* are not read.
    """
    return place(written(cut(docs, key, text, tokenizer, length, with_ids), "pieces"), length, group).withColumnRenamed("key", key)


def padded(lengths: DataFrame, length: int = LENGTH) -> DataFrame:
    """Of placed pieces: per sequence its ids and its stored length, which is *length* unless it holds a power of two."""
    used = lengths.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"))
    power = F.bit_count(F.col("n_ids")) == 1
    return used.withColumn("stored", F.when(power, F.col("n_ids")).otherwise(F.lit(length).cast("long")))
