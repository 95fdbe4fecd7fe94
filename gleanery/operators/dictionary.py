"""Spelling dictionaries of any size, as tables.

An entry says that one spelling means another, which may itself be an entry.  Chains are
resolved by pointer jumping: each round replaces what a spelling means by what that means, so the
length that is left halves.  Entries that lead round in a circle mean nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.labels import label_form
from gleanery.sources.scratch import written


@dataclass(frozen=True)
class Resolved:
    """``form, meaning`` with one row per spelling; and ``form, problem, meanings`` of the entries at fault."""

    entries: DataFrame
    problems: DataFrame


def resolve(entries: DataFrame, alias: str = "alias", target: str = "target") -> Resolved:
    """What each *alias* means in the end.

    Spellings count in the form labels have (upper case, stripped, underscores).  NULL aliases or targets and
    entries that mean themselves are left out.  An alias with several targets is a ``conflict``: the least
    counts.  An alias whose chain never ends is a ``cycle`` and has no row in ``entries``.
    Rounds are as many as the logarithm of the longest chain, or of the number of entries where there are cycles.
    """
    forms = entries.select(label_form(F.col(alias).cast("string")).alias("form"), label_form(F.col(target).cast("string")).alias("meaning"))
    grouped = forms.filter("form is not null and meaning is not null and form <> meaning").groupBy("form").agg(
        F.min("meaning").alias("meaning"), F.array_sort(F.collect_set("meaning")).alias("meanings")
    )
    first = written(grouped, "dictionary", compact=True)
    n = first.count()
    now, reach = first.select("form", "meaning"), 1
    while n:
        step = now.select(F.col("form").alias("meaning"), F.col("meaning").alias("_next"))
        now = written(now.join(step, "meaning", "left").select("form", F.coalesce("_next", "meaning").alias("meaning"), F.col("_next").isNotNull().alias("_moved")), "dictionary", compact=True)
        open_ends = now.filter("_moved").limit(1).count()
        now, reach = now.select("form", "meaning"), 2 * reach
        if not open_ends or reach > 2 * n:
            break
    ends = now.join(first.select(F.col("form").alias("meaning")), "meaning", "left_anti")
    cycles = first.join(ends.select("form"), "form", "left_anti")
    problems = first.filter(F.size("meanings") > 1).select("form", F.lit("conflict").alias("problem"), "meanings")
    return Resolved(ends.select("form", "meaning"), problems.unionByName(cycles.select("form", F.lit("cycle").alias("problem"), "meanings")))


def with_canonical(rows: DataFrame, values: dict[str, Resolved], allow: dict[str, Sequence[str]], fallback: dict[str, str]) -> DataFrame:
    """*rows* with each column named in *values* as the allowed label it means, else its fallback.

    First the forms that occur are matched, each once: what *rows* join with afterwards is stored, no larger than
    the forms in use, and broadcast by Spark where that is small; else both sides meet by form.
    NULL means nothing and gets the fallback.
    """
    out = rows
    for column, dictionary in values.items():
        form: Column = label_form(F.col(column))
        used = rows.select(form.alias("form")).filter("form is not null").distinct()
        meant = used.join(dictionary.entries, "form", "left").select("form", F.coalesce("meaning", "form").alias("_label"))
        meant = written(meant.filter(F.col("_label").isin(*allow[column])), "forms", compact=True)
        out = out.withColumn("_form", form).join(meant.withColumnRenamed("form", "_form"), "_form", "left")
        out = out.withColumn(column, F.coalesce("_label", F.lit(fallback[column]))).drop("_form", "_label")
    return out.select(*rows.columns)
