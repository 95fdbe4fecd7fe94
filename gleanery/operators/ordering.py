"""Row numbering and top-k without single-task windows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.sources.scratch import written

_WITHIN = 33  # bits Spark gives the position within a partition


def with_dense_index(rows: DataFrame, order_by: Sequence[str], index: str = "index") -> DataFrame:
    """*rows* with positions 0..n-1 in *order_by* order.

    Rows are range-partitioned and sorted once and stored with their partition
    and place; a row's index is its place plus the sizes of the partitions
    before.  Ties are told apart by content and then by reading position, so
    that a value, or a set of copies, held by many rows still spreads over
    partitions.  *rows* should be a stored table or a projection of one, which
    a lost task reads again in the same order.
    """
    tied = rows.withColumns({"_hash": F.xxhash64(*rows.columns), "_row": F.monotonically_increasing_id()})
    keys = [*order_by, "_hash", "_row"]
    placed = tied.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(placed.withColumn("_at", F.monotonically_increasing_id()).drop("_hash", "_row"), "placed")
    part = F.shiftright("_at", _WITHIN)
    sizes = placed.groupBy(part.alias("_part")).count().orderBy("_part").collect()  # one row per partition
    start, starts = 0, []
    for size in sizes:
        starts.append((size["_part"], start))
        start += size["count"]
    offsets = rows.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
    place = F.col("_at").bitwiseAND(F.lit((1 << _WITHIN) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*rows.columns, (F.col("_start") + place).alias(index))
    )


def top_recent(
    rows: DataFrame, n: int, by: str | Sequence[str], order_by: Sequence[Column], spread: int = 64
) -> DataFrame:
    """The first *n* rows of every group in *order_by* order.

    Two levels: each group is cut to *n* within *spread* hash parts, then as a
    whole, so that no task ever sorts a large group.  *order_by* must be total
    for a repeatable result.
    """
    by = [by] if isinstance(by, str) else list(by)
    salted = rows.withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.lit(spread)))
    for keys in ([*by, "_part"], by):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
        salted = salted.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")
    return salted.select(*rows.columns)


def first_n(rows: DataFrame, n: int, by: str | Sequence[str], order_by: Sequence[tuple[str, bool]]) -> DataFrame:
    """Exactly the first *n* rows of every group, for an *n* of any size; a group with fewer is kept whole.

    *order_by* names columns and whether each descends; NULL comes last either way, and rows
    that tie go by a hash of all columns.  Only group, order and hash are shuffled, once, by range,
    so that a group spreads over as many tasks as it needs.  Sizes of a group's pieces tell in which the *n*-th row lies; rows are then compared
    with their group's *n*-th where they are.  Of the rows that equal it in all columns as many
    are given back as belong to the first *n*.  *rows* is read more than once and should be
    a stored table; hashing takes no maps.
    """
    if n < 1:
        return rows.limit(0)
    by = [by] if isinstance(by, str) else list(by)
    groups, values = [f"_by_{i}" for i in range(len(by))], [f"_value_{i}" for i in range(len(order_by))]
    content = F.xxhash64(*rows.columns)
    narrow = rows.select(
        *(F.col(c).alias(g) for c, g in zip(by, groups, strict=True)),
        *(F.col(c).alias(v) for (c, _), v in zip(order_by, values, strict=True)),
        content.alias("_content"),
    ).withColumn("_row", F.monotonically_increasing_id())
    sorts = [F.col(v).desc_nulls_last() if down else F.col(v).asc_nulls_last() for v, (_, down) in zip(values, order_by, strict=True)]
    keys = [*groups, *sorts, "_content", "_row"]
    placed = narrow.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(placed.withColumn("_at", F.monotonically_increasing_id()).drop("_row"), "ordered")

    # One row per group and task that holds some of it.
    pieces = placed.groupBy(*groups, F.shiftright("_at", _WITHIN).alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_start"))
    upto = F.sum("_n").over(Window.partitionBy(*groups).orderBy("_part"))
    reached = pieces.withColumn("_upto", upto).filter(F.lit(n).between(F.col("_upto") - F.col("_n") + 1, F.col("_upto")))
    last = reached.select((F.col("_start") + n - 1 - (F.col("_upto") - F.col("_n"))).alias("_at"))
    cuts = written(placed.join(last, "_at").withColumnRenamed("_at", "_last"), "cuts")
    cuts = cuts.toDF(*(f"_cut{c}" if c != "_last" else c for c in cuts.columns))
    equal = [F.col(c).eqNullSafe(F.col(f"_cut{c}")) for c in (*groups, *values, "_content")]
    among = placed.join(cuts, reduce(Column.__and__, equal)).filter(F.col("_at") <= F.col("_last"))
    ties = among.groupBy(*(f"_cut{g}" for g in groups)).agg(F.count(F.lit(1)).alias("_take"))
    ties = ties.toDF(*(f"_tie{g}" for g in groups), "_take")
    mine = reduce(Column.__and__, [F.col(f"_tie{g}").eqNullSafe(F.col(f"_cut{g}")) for g in groups])
    cuts = written(cuts.join(ties, mine).select(*(c for c in cuts.columns if c != "_last"), "_take"), "cuts")

    before, tied = content < F.col("_cut_content"), content == F.col("_cut_content")
    for (name, down), value in reversed(list(zip(order_by, values, strict=True))):
        own, cut = F.col(f"_own.{name}"), F.col(f"_cut{value}")
        less = F.coalesce(own > cut if down else own < cut, own.isNotNull() & cut.isNull())
        before, tied = less | (own.eqNullSafe(cut) & before), own.eqNullSafe(cut) & tied
    same = reduce(Column.__and__, [F.col(f"_own.{c}").eqNullSafe(F.col(f"_cut{g}")) for c, g in zip(by, groups, strict=True)])
    marked = rows.alias("_own").join(cuts, same, "left")
    sure = marked.filter(F.col("_take").isNull() | before).select("_own.*")
    # Rows that share order, hash and group with the n-th: one set of copies, but for a clash of hashes.
    edge = marked.filter(F.col("_take").isNotNull() & tied).groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"), F.first("_take").alias("_take"))
    ahead = F.sum("_n").over(Window.partitionBy(*by).orderBy(*rows.columns)) - F.col("_n")
    edge = edge.withColumn("_times", F.greatest(F.least(F.col("_n"), F.col("_take") - ahead), F.lit(0)).cast("int"))
    return sure.unionByName(edge.select(*rows.columns, F.explode(F.array_repeat(F.lit(0), F.col("_times"))).alias("_again")).drop("_again"))
