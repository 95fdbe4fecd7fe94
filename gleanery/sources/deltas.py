"""A stored table and the rows that replace some of its rows, merged when it is read.

A delta holds changed rows, each with the file and the row of the base table whose place it
takes.  Nothing of the base is written again, so what a change costs grows with
the changed rows.  On disk a changed table is a folder with ``_delta`` and ``_base``, the
latter naming the base table relative to the folder.  Both are hidden from Spark's readers, which
find no file there: the delta can't be taken for the table.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gleanery.sources.artefacts import Artefacts

#: Where the base table holds the row that a row of the delta replaces.
FILE, ROW = "_base_file", "_base_row"


def placed(base: DataFrame) -> DataFrame:
    """*base*, read from parquet, with the place of each row.  Spark names files apart, so that a copied table keeps its places."""
    return base.withColumns({FILE: F.col("_metadata.file_name"), ROW: F.col("_metadata.row_index")})


def merged(base: DataFrame, delta: DataFrame) -> DataFrame:
    """*base* with the rows of *delta* in the places that they name.

    Columns that only *delta* has are NULL in rows of *base*.  Spark broadcasts the
    places if they are few; else rows are shuffled by their places, which no value repeats.
    """
    kept = placed(base).join(delta.select(FILE, ROW), [FILE, ROW], "left_anti").drop(FILE, ROW)
    return kept.unionByName(delta.drop(FILE, ROW), allowMissingColumns=True)


def store_delta(out: Artefacts, name: str, base: str, delta: DataFrame) -> DataFrame:
    """Artefact *name*: artefact *base* with *delta*'s rows in their places.

    The manifest gets ``name`` with the rows of the whole table, and ``name_changed`` with those of the delta.
    """
    path, counted = out.path(name), Observation("delta")
    folder, files = _folder(out.spark, path)
    files.delete(folder, True)  # a whole table or a delta of an earlier run of the same id
    delta.observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/_delta")
    stream = files.create(_folder(out.spark, f"{path}/_base")[0], False)
    try:
        stream.write(bytearray(posixpath.relpath(out.paths[base], path).encode()))
    finally:
        stream.close()
    out.note(f"{name}_changed", f"{path}/_delta", counted.get["n"])
    out.note(name, path, out.rows[base])
    return read_table(out.spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The parquet table at *path*, or what a base and its delta make of one."""
    pointer, files = _folder(spark, f"{path.rstrip('/')}/_base")
    if not files.exists(pointer):
        return spark.read.parquet(path)
    stream = files.open(pointer)  # hidden from spark.read as well
    try:
        base = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return merged(spark.read.parquet(f"{path.rstrip('/')}/{base}"), spark.read.parquet(f"{path}/_delta"))


def _folder(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
