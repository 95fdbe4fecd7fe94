"""Rows of a stored table chosen by where they lie, without moving the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.sources.scratch import written

#: Rows of the table that one row of marks stands for, 64 to a number.
BLOCK = 256
#: Rows of marks that are sent to all tasks; with more, the table is shuffled to them.
SENT = 1 << 18


def rows_at(stored: DataFrame, places: DataFrame, inside: bool = True, path: str | None = None, sent: int = SENT) -> DataFrame:
    """Those rows of *stored*, read from parquet files, that lie at *places* (_file, _row), or with *inside* false the others.

    Places are marked bit by bit, so what all tasks get has one row for ``BLOCK`` rows of the table at most.  Repeated
    places do no harm.  The marks are stored below *path*, if given.  Columns stay as they were, and none may be named _file, _row, _block or _marks.
    """
    at, block = F.expr("int(_row % 64)"), F.expr(f"_row div {BLOCK}").alias("_block")
    word = F.expr(f"_row % {BLOCK} div 64")
    marks = [F.coalesce(F.bit_or(F.when(word == i, F.expr("shiftleft(1L, int(_row % 64))"))), F.lit(0).cast("long")) for i in range(BLOCK // 64)]
    blocks = written(places.groupBy("_file", block).agg(F.array(*marks).alias("_marks")), "marks", path, compact=True)
    if blocks.count() <= sent:
        blocks = F.broadcast(blocks)
    spot = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    joined = stored.select("*", *spot).select("*", block).join(blocks, ["_file", "_block"], "left")
    marked = F.coalesce(F.bit_get(F.get("_marks", word.cast("int")), at) == 1, F.lit(False))
    return joined.filter(marked if inside else ~marked).select(*stored.columns)
