"""Bring platform tables to one schema, union them, keep one row per id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions.dates import clock_text
from gleanery.schemas import APP_STORE, GOOGLE_PLAY, GOOGLE_PLAY_RAW, UNIFIED
from gleanery.sources.scratch import written

ORDER = "src_order"

# Columns of the record dump that are copied under a second name.
_RECORD_COPIES = {"rating": "score", "date": "at", "review": "content"}


def normalise_records(records: DataFrame) -> DataFrame:
    """Record dump with ``rating``, ``date`` and ``review`` copies added.

    A copy is made only where its source column exists, the originals stay, and
    ``date`` becomes wall-clock text, NULL where it cannot be read.
    """
    copies = {new: F.col(old) for new, old in _RECORD_COPIES.items() if old in records.columns}
    out = records.withColumns(copies) if copies else records
    if "date" in out.columns:
        out = out.withColumn("date", clock_text(F.col("date"), out.schema["date"].dataType))
    return out


def project_records(records: DataFrame, schema: T.StructType = GOOGLE_PLAY_RAW) -> DataFrame:
    """Exactly the columns of *schema*, NULL for those *records* lacks and for values of another type."""
    return records.select(
        *[
            (lenient(records, f.name, f.dataType) if f.name in records.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def lenient(rows: DataFrame, column: str, kind: T.DataType) -> Column:
    """*column* as *kind*, NULL where it has no such value; whole numbers may be written with a point."""
    value = F.col(column)
    if isinstance(rows.schema[column].dataType, type(kind)):
        return value
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return F.coalesce(value.try_cast(kind), value.try_cast("double").try_cast(kind))
    return value.try_cast(kind)


def align(raw: DataFrame, platform: str, keep: Sequence[str] = ()) -> DataFrame:
    """One platform's table as the unified columns, then those named in *keep*.

    A missing column is an error.  The text is ``review`` or else ``content``.
    """
    missing = [c for c in ("reviewId", "userName", "rating", "date", *keep) if c not in raw.columns]
    texts = [F.col(c) for c in ("review", "content") if c in raw.columns]
    if missing or not texts:
        raise ValueError(f"columns missing from {platform}: {missing or ['content']}")
    date = F.col("date")
    if not isinstance(raw.schema["date"].dataType, T.StringType):
        date = clock_text(date, raw.schema["date"].dataType)
    return raw.select(
        F.lit(platform).alias("platform"),
        F.col("reviewId").cast("string").alias("reviewId"),
        F.col("userName").cast("string").alias("userName"),
        lenient(raw, "rating", T.IntegerType()).alias("rating"),
        F.coalesce(date, F.lit("")).alias("date"),
        F.coalesce(*texts, F.lit("")).alias("content"),
        *keep,
    )


def with_place(stored: DataFrame) -> DataFrame:
    """*stored*, read from parquet, with the place of each row as _file and _row."""
    return stored.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def keep_first(rows: DataFrame, key: str, order_by: Sequence[str], placed: bool = False) -> DataFrame:
    """The first row per *key* in *order_by* order; NULL and empty keys are one group.

    Rows are stored, so that each has a place: of rows that tie the first stored stays,
    and a loser is taken out by its place, which no other row has.  Keys held
    more than once and what they lose are found on keys, order and place alone.  A key held by a third of
    all rows is no heavier than any other, since each task hands on one row per key.

    *placed* rows are stored already and have ``with_place``'s columns.  Their losers are stored before whole
    rows are read: Spark then sees how few there are, and broadcasts them instead of shuffling the rows.
    """
    at_place = rows if placed else with_place(written(rows, "rows"))
    narrow = at_place.select(F.nullif(F.col(key).cast("string"), F.lit("")).alias("_key"), F.struct(*order_by).alias("_order"), "_file", "_row")
    at = F.struct("_order", "_file", "_row")
    first = narrow.groupBy("_key").agg(F.min(at).alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    later = (F.col("_file") != F.col("_first._file")) | (F.col("_row") != F.col("_first._row"))
    lost = narrow.join(first, narrow["_key"].eqNullSafe(first["_key"])).filter(later).select("_file", "_row")
    if placed:
        lost = written(lost, "lost", compact=True)
    return at_place.join(lost, ["_file", "_row"], "left_anti").drop("_file", "_row")


def union_reviews(
    google: DataFrame | None = None, app_store: DataFrame | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Both platforms in the unified schema, duplicates included."""
    sides = [(google, GOOGLE_PLAY), (app_store, APP_STORE)]
    frames = [align(df, platform, keep) for df, platform in sides if df is not None]
    if not frames:
        return SparkSession.active().createDataFrame([], UNIFIED)
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def merge_reviews(
    google: DataFrame | None = None,
    app_store: DataFrame | None = None,
    order_by: Sequence[str] = (ORDER,),
    stored: bool = False,
) -> DataFrame:
    """Unified table with one row per ``reviewId``.

    Of several rows with one id the first platform's wins, within a platform
    the first in *order_by*, and of rows equal in it any one.  The readers add ``src_order``, which is
    the order in the source files; columns of the unified schema are taken as they are there.
    *stored*: both tables are parquet as read, whose rows have places without being written again.
    """
    if google is None and app_store is None:
        return union_reviews()
    keep = [c for c in order_by if c not in UNIFIED.names]
    if stored:
        google, app_store = (None if side is None else with_place(side) for side in (google, app_store))
        keep += ["_file", "_row"]
    rows = union_reviews(google, app_store, keep=keep)
    rank = F.when(F.col("platform") == GOOGLE_PLAY, 0).otherwise(1)
    ranked = rows.withColumn("_rank", rank)
    if not stored:
        ranked = with_place(written(ranked, "rows"))
    return keep_first(ranked, "reviewId", ["_rank", *order_by], placed=True).select(*UNIFIED.names)
