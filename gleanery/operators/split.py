"""Exact stratified train/test split."""

from __future__ import annotations

import logging
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.params import SplitParams
from gleanery.sources.scratch import written

#: Leading hex digits of the hash that form a bucket.
_PREFIX = 4


def split_hash(id_: Column, seed: int) -> Column:
    """Seeded, engine-independent random order of ids."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))))


def class_quotas(classes: DataFrame, by: str, params: SplitParams) -> DataFrame:
    """``by, n, n_train, n_test`` from class counts ``by, n``.

    ``ceil(test_size * N)`` test rows in double arithmetic; train rows by share,
    rounded down, and one more for the classes with the largest remainders (the
    smaller class value first among equals).
    """
    total, n_classes, smallest, nulls = classes.agg(
        F.sum("n"), F.count(F.lit(1)), F.min("n"), F.count_if(F.col(by).isNull())
    ).first()
    if not total:
        raise ValueError("the table to split is empty")
    if nulls:
        raise ValueError(f"stratify column {by!r} contains nulls")
    if smallest < 2:
        logging.getLogger("gleanery").warning("a class of %r has fewer than two rows", by)
        if params.on_small_class == "error":
            raise ValueError(f"every class of {by!r} needs at least two rows")
        small = classes.filter("n < 2").select(by, "n", F.col("n").alias("n_train"), F.lit(0).cast("long").alias("n_test"))
        rest = classes.filter("n >= 2")
        if rest.isEmpty():
            return small
        return class_quotas(rest, by, params).unionByName(small)
    test = math.ceil(params.test_size * total)
    train = total - test
    if min(train, test) < n_classes:
        raise ValueError(f"{train} train and {test} test rows are too few for {n_classes} classes")
    share = F.col("n") / F.lit(float(total)) * F.lit(float(train))
    shares = classes.withColumns({"base": F.floor(share), "left": share - F.floor(share)})
    spare = train - shares.agg(F.sum("base")).first()[0]
    one_more = shares.orderBy(F.desc("left"), by).limit(spare).select(by, F.lit(1).alias("extra"))
    n_train = F.col("base") + F.coalesce(F.col("extra"), F.lit(0))
    return shares.join(one_more, by, "left").select(
        by, "n", n_train.cast("long").alias("n_train"), (F.col("n") - n_train).cast("long").alias("n_test")
    )


def split_quotas(rows: DataFrame, params: SplitParams = SplitParams()) -> DataFrame:
    """Class counts of *rows* with their train and test quotas."""
    _check_column(rows, params.by)
    classes = written(rows.groupBy(params.by).agg(F.count(F.lit(1)).alias("n")), "classes")
    return class_quotas(classes, params.by, params)


def stratified_split(rows: DataFrame, id_col: str, params: SplitParams = SplitParams()) -> DataFrame:
    """*rows* with a ``split`` column, ``train`` or ``test``.

    Within a class the rows with the smallest hash of (seed, *id_col*) are the
    test rows, exactly as many as its quota.  The cut is found on ids and
    classes alone: counts per hash prefix give the prefix it falls into, and
    only that prefix is ranked.  The rows themselves are then compared with
    their class's cut where they lie, without a shuffle.  Ids should be unique;
    rows that share one are never torn apart.
    """
    by = params.by
    _check_column(rows, by)
    keys = rows.select(F.col(by).alias("_by"), F.col(id_col).alias("_id")).withColumn("_h", split_hash(F.col("_id"), params.seed))
    keys = keys.withColumn("_b", F.substring("_h", 1, _PREFIX))
    buckets = written(keys.groupBy("_by", "_b").agg(F.count(F.lit(1)).alias("n")), "buckets")
    counts = buckets.groupBy(F.col("_by").alias(by)).agg(F.sum("n").alias("n"))
    quotas = class_quotas(counts, by, params).withColumnRenamed(by, "_by")

    # At most 16 ** _PREFIX rows per class.
    running = F.sum("n").over(Window.partitionBy("_by").orderBy("_b"))
    reached = buckets.select("_by", "_b", (running - F.col("n")).alias("before"), running.alias("upto"))
    edges = reached.join(quotas.select("_by", "n_test"), "_by").filter(
        (F.col("before") < F.col("n_test")) & (F.col("n_test") <= F.col("upto"))
    )
    edges = written(edges.select("_by", "_b", (F.col("n_test") - F.col("before")).alias("rank")), "edges")
    # One row per id, so that an id on many rows is no heavy group; such rows
    # stay on one side, which may then exceed its quota.
    near = keys.join(edges, ["_by", "_b"]).groupBy("_by", "rank", "_h", "_id").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("_by").orderBy("_h", F.asc_nulls_first("_id")))
    cuts = near.withColumn("_upto", upto).filter(F.col("rank").between(F.col("_upto") - F.col("n") + 1, F.col("_upto")))
    cuts = written(cuts.select("_by", F.col("_h").alias("_cut_h"), F.col("_id").alias("_cut_id")), "cuts")

    h, id_ = split_hash(F.col(id_col), params.seed), F.col(id_col)
    same = (h == F.col("_cut_h")) & (id_.isNull() | F.coalesce(id_ <= F.col("_cut_id"), F.lit(False)))
    is_test = F.coalesce((h < F.col("_cut_h")) | same, F.lit(False))
    # One row per class, read from a stored table of known size: Spark
    # broadcasts it if it is small and joins by shuffle if it is not.
    marked = rows.join(cuts, rows[by] == cuts["_by"], "left")
    return marked.select(*rows.columns, F.when(is_test, "test").otherwise("train").alias("split"))


def split_counts(split: DataFrame, by: str = "primary") -> DataFrame:
    return split.groupBy("split", by).agg(F.count(F.lit(1)).alias("n"))


def _check_column(rows: DataFrame, by: str) -> None:
    if by not in rows.columns:
        raise ValueError(f"stratify column {by!r} is not in the table")
