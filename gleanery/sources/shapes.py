"""The shape of JSON bodies of any depth: which paths they have, with which types and how often."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_:]*\Z")
#: Kinds of values, as they are counted; "absent" marks a body that is NULL, "unreadable" one that is no JSON.
KINDS = ("null", "boolean", "integer", "double", "string", "object", "array", "absent", "unreadable")
_MOST = 50_000  # counters a task holds before it hands them on


def _refuse(name: str) -> None:
    raise ValueError(name)


def _kind(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "integer"
    return {float: "double", str: "string", dict: "object", list: "array"}[type(value)]


def _step(path: str, key: str) -> str:
    return f"{path}.{key}" if _PLAIN.match(key) else f"{path}[{json.dumps(key, ensure_ascii=False)}]"


def _count(body: str | None, into: Counter) -> None:
    """Adds every value of *body* to counters of (path, parent's path, kind)."""
    if body is None:
        into["$", None, "absent"] += 1
        return
    try:
        left = [("$", None, json.loads(body, parse_constant=_refuse))]
    except (ValueError, RecursionError):
        into["$", None, "unreadable"] += 1
        return
    while left:
        path, parent, value = left.pop()
        into[path, parent, _kind(value)] += 1
        if isinstance(value, dict):
            left += [(_step(path, key), path, each) for key, each in value.items()]
        elif isinstance(value, list):
            left += [(f"{path}[]", path, each) for each in value]


def shape_counts(rows: DataFrame, body: str) -> DataFrame:
    """``path, parent, kind, n`` of all values in the JSON texts of column *body*.

    Elements of an array share the path ``...[]``; keys that are no plain words stand in
    brackets and quotes.  Of keys that an object holds twice the last counts.  A text that is no
    JSON, holds NaN or is nested too deep for the parser counts as an unreadable root, NULL as
    an absent one.  Tasks count before the shuffle, and hand on what they have when they hold
    many counters, so that keys made of data (ids as keys) don't fill a task.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()

        def table() -> pa.RecordBatch:
            path, parent, kind = zip(*counted, strict=True)
            return pa.RecordBatch.from_pydict(
                {"path": pa.array(path, pa.string()), "parent": pa.array(parent, pa.string()), "kind": pa.array(kind, pa.string()), "n": pa.array(counted.values(), pa.int64())}
            )

        for batch in batches:
            for text in batch.column(0):
                _count(text.as_py(), counted)
                if len(counted) > _MOST:
                    yield table()
                    counted.clear()
        if counted:
            yield table()

    partial = rows.select(F.col(body).cast("string").alias("body")).mapInArrow(run, "path string, parent string, kind string, n bigint")
    return partial.groupBy("path", "parent", "kind").agg(F.sum("n").alias("n"))


def _merged(counts: dict[str, Column]) -> Column:
    """The least type that holds all values: integer below double, null below all, else mixed."""
    has = {kind: n > 0 for kind, n in counts.items()}
    kinds = ("boolean", "string", "object", "array")
    number = has["integer"] | has["double"]
    several = sum((F.when(has[k], 1).otherwise(0) for k in kinds), F.when(number, 1).otherwise(0))
    named = F.coalesce(*(F.when(has[k], k) for k in kinds), F.when(has["double"], "double"), F.when(has["integer"], "integer"), F.when(has["null"], "null"))
    return F.when(several > 1, "mixed").otherwise(named)


def shape_profile(rows: DataFrame, body: str) -> DataFrame:
    """One row per path of the JSON texts in column *body*: ``path, type, n, n_null, n_missing``.

    *n* counts the values at the path, nulls included; *n_missing* the parent objects without
    it (0 for array elements; for the root, texts that are NULL or no JSON).  The type is the least one that holds all
    values: ``integer`` and ``double`` make ``double``, ``null`` goes with any, other kinds together are
    ``mixed``; a root without any value has none.
    """
    counts = shape_counts(rows, body)
    each = {kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)) for kind in KINDS}
    paths = counts.groupBy("path", "parent").agg(*(n.alias(f"_{kind}") for kind, n in each.items()))
    found = {kind: F.col(f"_{kind}") for kind in KINDS}
    lost = found["absent"] + found["unreadable"]
    paths = paths.select(
        "path", "parent", _merged(found).alias("type"), sum((found[k] for k in KINDS[1:7]), found["null"]).alias("n"),
        found["null"].alias("n_null"), lost.alias("_lost"),
    )
    objects = counts.filter("kind = 'object'").select(F.col("path").alias("_path"), F.col("n").alias("_objects"))
    missing = F.when(F.col("parent").isNull(), F.col("_lost")).when(F.endswith("path", F.lit("[]")), 0).otherwise(F.col("_objects") - F.col("n"))
    joined = paths.join(objects, F.col("parent") == F.col("_path"), "left")
    return joined.select("path", "type", "n", "n_null", missing.cast("long").alias("n_missing"))
