"""Large single files of multi-line records, read by many tasks.

Spark cuts a file at a separator byte by itself: line ends for CSV, closing braces for JSON.  Whether such a
place also ends a record depends on all that stands before it, so each block of the file is
first summarised as a function: for either state in which the block may begin (outside or
inside quotes) the state in which it ends, and by how much it changes the depth of
nesting.  These functions compose, so the state at each block's start is a running composition
over one row per block.  With it every task cuts its own blocks at true record ends.  A
record that crosses blocks leaves a piece in each; only these pieces, at most two a block, are
gathered and joined.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.sources.readers import BAD, Paths, scan_csv, typed_columns

#: Takes a unit of text and whether it begins inside quotes; whether it ends inside, and the change of depth.
Step = Callable[[str, bool], tuple[bool, int]]

_PLACE = "source string, block bigint, row bigint"
#: What goes on after a quoted part: an even run of quotes, then the one that closes it.
_CLOSE = re.compile(r'[^"]*(?:""[^"]*)*"(?!")')
_STRING_END = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.S)
_STRING = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"', re.S)


def csv_step(line: str, inside: bool) -> tuple[bool, int]:
    """A physical line of CSV: quotes count at the start of a field alone; the depth is always 0."""
    at = 0
    while True:
        if not inside:
            if line[at : at + 1] != '"':
                at = line.find(',"', at)
                if at < 0:
                    return False, 0
                at += 1
            at += 1
        closed = _CLOSE.match(line, at)
        if closed is None:
            return True, 0
        at = line.find(",", closed.end())
        if at < 0:
            return False, 0
        at, inside = at + 1, False


def json_step(piece: str, inside: bool) -> tuple[bool, int]:
    """Text up to a closing brace, which is part of it."""
    if inside:
        ended = _STRING_END.match(piece)
        if ended is None:
            return True, 0
        piece = piece[ended.end() :]
    bare = _STRING.sub("", piece)
    open_at = bare.find('"')
    if open_at >= 0:
        bare = bare[:open_at]
    return open_at >= 0, bare.count("{") + bare.count("[") - bare.count("}") - bare.count("]")


def _units(spark: SparkSession, path: Paths, separator: str) -> DataFrame:
    place = [F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")]
    return spark.read.option("lineSep", separator).text(path).select(F.col("value"), *place)


def _summaries(units: DataFrame, step: Step, end: str) -> DataFrame:
    """One row per block: where it leads from either state."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list[tuple[bool, int]]] = {}
        for batch in batches:
            for value, source, block in zip(*(batch.column(c).to_pylist() for c in ("value", "source", "block")), strict=True):
                at = held.setdefault((source, block), [(False, 0), (True, 0)])
                if '"' not in value and end != "}":
                    continue
                for state in (0, 1):
                    inside, depth = step(value + end, at[state][0])
                    at[state] = (inside, at[state][1] + depth)
        columns = zip(*((s, b, f[0][0], f[0][1], f[1][0], f[1][1]) for (s, b), f in held.items()), strict=True) if held else [[]] * 6
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["source", "block", "s0", "d0", "s1", "d1"])

    return units.mapInArrow(run, "source string, block bigint, s0 boolean, d0 bigint, s1 boolean, d1 bigint")


def _starts(summaries: DataFrame) -> DataFrame:
    """The state and depth at each block's start; a file's blocks, one row each, are composed in order."""

    def compose(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("block")
        inside, depth, out = False, 0, []
        for b in blocks.itertuples():
            out.append((b.source, b.block, inside, depth))
            inside, depth = (b.s1, depth + b.d1) if inside else (b.s0, depth + b.d0)
        return pd.DataFrame(out, columns=["source", "block", "inside", "depth"])

    return summaries.groupBy("source").applyInPandas(compose, "source string, block bigint, inside boolean, depth bigint")


def records(spark: SparkSession, path: Paths, separator: str, step: Step, deepest: int = 0) -> DataFrame:
    """``source, block, row, text``: the records of the files at *path*, each placed where it begins.

    A record ends at a separator outside quotes and at most *deepest* levels deep.  Blocks are those
    into which Spark cuts the files (``spark.sql.files.maxPartitionBytes``).  What is open at a file's end is a record.
    """
    end = "" if separator == "\n" else separator
    units = _units(spark, path, separator)
    starts = _starts(_summaries(units, step, end))
    # One row per block of input: 1 in some 100 MB.
    placed = units.join(F.broadcast(starts), ["source", "block"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, depth, open_row, held = None, False, 0, None, []
        begun = False  # whether the open record began in this block
        out: list[tuple] = []

        def close(kind: str) -> None:
            out.append((*key, open_row, kind, ("\n" if separator == "\n" else "").join(held)))
            held.clear()

        for batch in batches:
            names = ("value", "source", "block", "row", "inside", "depth")
            for value, source, block, row, was_inside, was_deep in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if key != (source, block):
                    if held:
                        close("head" if begun else "middle")
                    key, inside, depth = (source, block), was_inside, was_deep
                    begun = not (inside or depth > deepest)
                if not held:
                    open_row = row
                held.append(value + end)
                if inside or end or '"' in value:
                    inside, change = step(value + end, inside)
                    depth += change
                if not inside and depth <= deepest:
                    close("whole" if begun else "tail")
                    begun = True
            if out:
                yield _rows(out)
                out = []
        if held:
            close("head" if begun else "middle")
        if out:
            yield _rows(out)

    cut = placed.select("value", "source", "block", "row", "inside", "depth").mapInArrow(run, f"{_PLACE}, kind string, text string")
    pieces = cut.filter("kind <> 'whole'")
    # Pieces of one record follow its head; a file's pieces are few, so each is told its head by a running one.
    order = Window.partitionBy("source").orderBy("block", "row")
    head = F.last(F.when(F.col("kind") == "head", F.struct("block", "row")), ignorenulls=True).over(order)
    joined = (
        pieces.withColumn("_head", head)
        .groupBy("source", "_head")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "row", "text"))), lambda p: p["text"]), "\n" if separator == "\n" else "").alias("text"))
        .select("source", "_head.block", "_head.row", "text")
    )
    return cut.filter("kind = 'whole'").select("source", "block", "row", "text").unionByName(joined)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["source", "block", "row", "kind", "text"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def scan_csv_split(spark: SparkSession, path: Paths, schema: T.StructType | None = None, ordered: bool = True) -> DataFrame:
    """``scan_csv`` of UTF-8 files with line ends inside quotes, where one file is read by many tasks.

    The same rows, in the same ``src_order``, but for CR LF inside quotes, which stays as it is.  A quote
    within an unquoted field is itself; empty lines are no records; every file's first record is its header.
    """
    header = scan_csv(spark, path, ordered=False).columns  # of the first file; reads no more than that
    found = records(spark, path, "\n", csv_step)
    found = found.filter(~F.col("text").isin("", "\r")).select(F.regexp_replace("text", "\r\\z", "").alias("text"), "source", "block", "row")
    tops = found.filter("block = 0").select("source", "row").groupBy("source").agg(F.min("row").alias("row"))
    rows = found.join(F.broadcast(tops), ["source", "row"], "left_anti")  # one row per file
    texts = ", ".join(f"`{c.replace('`', '``')}` string" for c in header)
    options = {"mode": "PERMISSIVE", "quote": '"', "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    parsed = rows.select(F.from_csv("text", texts, options).alias("r"), "source", "block", "row")
    out = parsed.select("r.*", F.struct("source", "block", "row").alias("src_order"))
    if schema is not None:
        out = out.select(*typed_columns(out, schema), "src_order")
    return out if ordered else out.drop("src_order")


def scan_json_split(spark: SparkSession, path: Paths, schema: T.StructType, ordered: bool = False) -> DataFrame:
    """``scan_json`` of files with one JSON array each, where one file is read by many tasks.

    The same rows, in any layout of the files.  What is no object, or no JSON, is kept as text
    in ``bad_record`` with NULL in all other columns, for ``split_bad`` to part and count.
    """
    found = records(spark, path, "}", json_step, deepest=1)

    def elements(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, *place in zip(*(batch.column(c).to_pylist() for c in ("text", "source", "block", "row")), strict=True):
                begin = _object_start(text)
                before, own = (text, "") if begin < 0 else (text[:begin], text[begin:])
                # What stands before the object: brackets and commas of the array, or elements that are no objects.
                out += [(*place, e) for e in _others(before)]
                if own:
                    out.append((*place, own))
            columns = zip(*out, strict=True) if out else [[]] * 4
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["source", "block", "row", "text"])

    single = found.select("text", "source", "block", "row").mapInArrow(elements, f"{_PLACE}, text string")
    kinds = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    parsed = F.from_json("text", kinds, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}).alias("r")
    out = single.select(parsed, F.struct("source", "block", "row").alias("src_order")).select("r.*", "src_order")
    return out if ordered else out.drop("src_order")


def _object_start(text: str) -> int:
    """Where the record's object begins: the first brace outside strings and inner arrays, -1 without one."""
    at, depth = 0, 0
    for m in re.finditer(r'"[^"\\]*(?:\\.[^"\\]*)*"|[{\[\]]', text, re.S):
        if m.group() == "{" and depth <= 1:
            return m.start()
        depth += {"[": 1, "]": -1}.get(m.group(), 0)
    return -1


def _others(before: str) -> list[str]:
    """Elements of an array that are no objects, each as its own text."""
    inner = before.strip().lstrip("\ufeff").strip()
    inner = re.sub(r"\}\Z", "", inner)  # the separator that stands for the end of the file
    if inner.startswith("[") and inner.count("[") > inner.count("]"):
        inner = inner[1:]
    elif inner.endswith("]") and inner.count("]") > inner.count("["):
        inner = inner[:-1]
    inner = inner.strip().strip(",").strip()
    if not inner or inner in ("]", "[]"):
        return []
    try:
        return [json.dumps(e, ensure_ascii=False) for e in json.loads(f"[{inner}]")]
    except ValueError:
        return [inner]
