"""Readers of landed review files and of stored artefacts."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators.align import lenient
from gleanery.schemas import FEED_PAGE, LABELED, UNIFIED
from gleanery.sources.deltas import read_table

Paths = str | list[str]


def source_order() -> Column:
    """Where a row stands in its files: path, block start, position in the task.

    A task reads its blocks front to back, so rows of one file compare in file
    order whether or not the file was split.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _ordered(rows: DataFrame, ordered: bool) -> DataFrame:
    return rows.select("*", source_order().alias("src_order")) if ordered else rows


def scan_csv(
    spark: SparkSession,
    path: Paths,
    schema: T.StructType | None = None,
    encoding: str = "utf-8",
    multi_line: bool = True,
    ordered: bool = True,
) -> DataFrame:
    """CSV with a header; quoted text may hold quotes and line ends, a BOM is skipped.

    Without *schema* the header names the columns and all are text.  Only an
    empty field is NULL.  Columns are matched to the header by name.  A file
    with line ends inside fields is read by one task: use ``ranges.scan_csv_split`` for large ones, or pass
    ``multi_line=False`` where no field has any, and files are split.
    """
    options = {
        "header": True,
        "multiLine": multi_line,
        "quote": '"',
        "escape": '"',
        "encoding": encoding,
        "mode": "PERMISSIVE",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    rows = spark.read.options(**options, inferSchema=False).csv(path)
    if schema is not None:
        return rows.select(*typed_columns(rows, schema), *([source_order().alias("src_order")] if ordered else []))
    return _ordered(rows, ordered)


def typed_columns(rows: DataFrame, schema: T.StructType) -> list[Column]:
    """The columns of *schema*, which *rows* has as text, NULL for values of another type."""
    missing = [f.name for f in schema.fields if f.name not in rows.columns]
    if missing:
        raise ValueError(f"columns missing from the CSV header: {missing}")
    return [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]


#: The source order where a format has no nested columns.
_FLAT = {"src_source": "source", "src_block": "block", "src_row": "row"}


def with_flat_order(rows: DataFrame) -> DataFrame:
    """*rows* with ``src_order`` as three plain columns, for CSV."""
    if "src_order" not in rows.columns:
        return rows
    return rows.withColumns({flat: F.col(f"src_order.{part}") for flat, part in _FLAT.items()}).drop("src_order")


def with_order(rows: DataFrame) -> DataFrame:
    """The reverse: the order that was exported, in place of that of the export's files."""
    if not set(_FLAT) <= set(rows.columns):
        return rows
    kinds = {"src_source": "string", "src_block": "long", "src_row": "long"}
    order = F.struct(*(F.col(flat).cast(kinds[flat]).alias(part) for flat, part in _FLAT.items()))
    return rows.withColumn("src_order", order).drop(*_FLAT)


def scan_table(spark: SparkSession, path: str, file_format: str = "auto") -> DataFrame:
    """A stage's table: parquet, csv, json (lines) or json-array, extra columns included.

    ``auto`` goes by the path: its last ending, or the name of an artefact's folder.
    """
    if file_format == "auto":
        named = re.findall(r"[._](csv|json)(?=/|$)", path.rstrip("/"))
        file_format = named[-1] if named else "parquet"
    if file_format == "csv":
        return with_order(scan_csv(spark, path))
    if file_format in ("json", "json-array"):
        return scan_json(spark, path, None, file_format == "json-array", extra=True)
    return read_table(spark, path) if file_format == "parquet" else spark.read.format(file_format).load(path)


def scan_merged(spark: SparkSession, path: Paths, encoding: str = "utf-8") -> DataFrame:
    """Merged reviews as CSV."""
    return scan_csv(spark, path, UNIFIED, encoding, ordered=False)


def scan_json(
    spark: SparkSession,
    path: Paths,
    schema: T.StructType | None = LABELED,
    array_file: bool = False,
    ordered: bool = False,
    extra: bool = False,
) -> DataFrame:
    """Records as JSON lines, or with *array_file* as one JSON array per file.

    Records that cannot be parsed have NULL in every column.  Keys outside *schema*
    are left out, unless *extra* asks for them: then they are inferred, by one more pass.
    """
    reader = spark.read.option("multiLine", array_file).option("mode", "PERMISSIVE")
    if extra:
        found = reader.json(path).schema
        own = schema.fields if schema is not None else []
        more = [f for f in found.fields if f.name not in {o.name for o in own} and f.name != BAD]
        schema = T.StructType([*own, *more])
    rows = (reader.schema(schema) if schema is not None else reader).json(path)
    return _ordered(rows, ordered)


#: A line that is no record; such rows are NULL in all other columns.
BAD = "bad_record"


def scan_records(
    spark: SparkSession, path: Paths, schema: T.StructType, file_format: str = "json", ordered: bool = True
) -> DataFrame:
    """A landed record dump, newest first: JSON lines, CSV or parquet.

    No line is dropped.  Of JSON lines every value is read as text and then as its
    type: a number may be written ``4.0``, a value of another type is NULL, and a
    line that is no JSON object is kept in ``bad_record``, for ``split_bad``.
    """
    if file_format == "csv":
        return scan_csv(spark, path, schema, ordered=ordered)
    if file_format != "json":
        return _ordered(spark.read.schema(schema).format(file_format).load(path), ordered)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]).add(BAD, T.StringType())
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = F.from_json("value", texts, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}).alias("r")
    rows = lines.select(parsed, *([source_order().alias("src_order")] if ordered else [])).select("r.*", *(["src_order"] if ordered else []))
    typed = [lenient(rows, f.name, f.dataType).alias(f.name) for f in schema.fields]
    return rows.select(*typed, BAD, *(["src_order"] if ordered else []))


def split_bad(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that are records, without ``bad_record``, and the lines that are none."""
    if BAD not in rows.columns:
        return rows, rows.limit(0).select(F.lit(None).cast("string").alias(BAD))
    return rows.filter(F.col(BAD).isNull()).drop(BAD), rows.filter(F.col(BAD).isNotNull()).select(BAD)


def scan_pages(spark: SparkSession, path: Paths, file_format: str = "parquet") -> DataFrame:
    """Landed feed pages ``app_id, country, page, body``; a body may be anything."""
    return spark.read.schema(FEED_PAGE).format(file_format).load(path)


def scan_page_files(spark: SparkSession, path: Paths) -> DataFrame:
    """Feed pages landed one file each under ``app_id=/country=/page=`` folders."""
    schema = "value string, app_id string, country string, page int"
    rows = spark.read.schema(schema).text(path, wholetext=True)
    return rows.select("app_id", "country", "page", F.col("value").alias("body"))


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def source_or_empty(
    spark: SparkSession, schema: T.StructType, read: Callable[[], DataFrame] | None, failed: Callable[[str], None] | None = None
) -> DataFrame:
    """What *read* gives; no rows if the source is switched off or cannot be opened.

    Opening covers listing and schema, not bad records inside: those are the
    reader's to keep or drop.  *failed* is told why a source cannot be opened.
    """
    if read is None:
        return empty(spark, schema)
    try:
        return read()
    except PySparkException as failure:
        logging.getLogger("gleanery").error("source cannot be read, taken as empty: %s", failure)
        if failed:
            failed(str(failure))
        return empty(spark, schema)


def rows_per_file(rows: DataFrame) -> DataFrame:
    """``file, n`` of a table read from files."""
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))


def json_key_profile(rows: DataFrame, body: str, path: str = "$") -> DataFrame:
    """Keys of the JSON objects found at *path*, with the type of their values.

    ``key, type, n``: the type is a SQL type name, for an object with its keys.
    Where *path* leads to an array, its elements' keys are counted; elements
    themselves have no key and are not.
    """
    node = F.try_variant_get(F.try_parse_json(F.col(body)), path, "variant")
    nodes = F.coalesce(F.try_variant_get(node, "$", "array<variant>"), F.array(node))
    spark = rows.sparkSession
    found = rows.select(F.explode(nodes).alias("_node"))
    pairs = found.lateralJoin(spark.tvf.variant_explode(F.col("_node").outer()).select("key", F.col("value").alias("_value")))
    return (
        pairs.filter(F.col("key").isNotNull())
        .groupBy("key", F.schema_of_variant("_value").alias("type"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
