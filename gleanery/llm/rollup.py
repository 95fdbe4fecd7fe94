"""Token totals by source, language and tokenizer version, kept up by signed batches.

A batch of changes (inserts, deletes, revised counts) becomes signed contributions, summed per
key before anything is shuffled, and is stored as one small table.  Totals
are the sum of the stored batches, so batches may come in any order.

A batch is committed by creating, once, a file named after its id that holds the
name of its table.  Whoever comes second, a retry or another job, finds the file and
changes nothing; tables that no such file names are never read.  Compaction folds
batches into a snapshot, whose file lists the batches in it, and is committed alike.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm.tokens import encoded

KEYS = ("source", "lang", "version")
_TOTALS = "source string, lang string, version string, n_docs bigint, n_tokens bigint"


def counted(docs: DataFrame, tokenizers: dict[str, str], text: str = "text") -> DataFrame:
    """*docs* with one column of token counts per entry of *tokenizers* (column name to vocabulary path); NULL texts count 0."""
    rows = docs.drop(*tokenizers)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = []
            for path in tokenizers.values():
                counts = [len(p) // 4 for _, packed in encoded([batch], text, path) for p in packed]
                columns.append(pa.array(counts, pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *tokenizers])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in tokenizers)]))


def _part(sign: int, prefix: str = "") -> Column:
    tokens = F.coalesce(F.col(f"{prefix}n_tokens"), F.lit(0)).cast("long")
    return F.struct(*(F.col(prefix + k).cast("string").alias(k) for k in KEYS), F.lit(sign).cast("long").alias("n_docs"), (sign * tokens).alias("n_tokens"))


def signed(changes: DataFrame) -> DataFrame:
    """Contributions per key of *changes*.

    *changes* has op, the keys and n_tokens; a revise also old_source, old_lang,
    old_version and old_n_tokens, what it takes back.  A NULL count is 0, a NULL key
    value is a group of its own, and repeated rows count each.  Any other op is an error.
    """
    old = _part(-1, "old_") if "old_n_tokens" in changes.columns else _part(-1)
    parts = (
        F.when(F.col("op") == "insert", F.array(_part(1)))
        .when(F.col("op") == "delete", F.array(_part(-1)))
        .when(F.col("op") == "revise", F.array(old, _part(1)))
        .otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("op", F.lit("NULL")))))
    )
    return _summed(changes.select(F.inline(parts)))


def _summed(rows: DataFrame) -> DataFrame:
    totals = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return totals.filter("n_docs <> 0 or n_tokens <> 0")


class Rollups:
    """Totals below a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self._root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds *changes* unless a batch of that id was committed; whether it was added."""
        name = f"commits/{quote(batch, safe='')}"
        if self._exists(name) or batch in self._snapshot()[1]:
            return False
        return self._create(name, self._store(signed(changes)))

    def totals(self) -> DataFrame:
        """Rows (source, lang, version, n_docs, n_tokens); keys whose totals are all 0 are left out."""
        return self._total(self._tables())

    def _total(self, tables: list[str]) -> DataFrame:
        rows = [self._spark.read.schema(_TOTALS).parquet(f"{self._root}/{t}") for t in tables]
        empty = self._spark.createDataFrame([], _TOTALS)
        return _summed(reduce(DataFrame.unionByName, rows, empty))

    def compact(self) -> None:
        """Folds all batches into a new snapshot; readers see the old one or the new."""
        # One listing decides what is folded: a batch committed meanwhile is in neither the table nor the list.
        (number, batches, held), commits = self._snapshot(), self._commits()
        new = sorted({*batches, *commits})
        table = self._store(self._total([*([held] if held else []), *(t for b, t in commits.items() if b not in batches)]))
        self._create(f"snapshots/{number + 1:010d}", json.dumps({"table": table, "batches": new}))

    def _tables(self) -> list[str]:
        _, batches, table = self._snapshot()
        return [*([table] if table else []), *(t for b, t in self._commits().items() if b not in batches)]

    def _commits(self) -> dict[str, str]:
        from urllib.parse import unquote

        return {unquote(n): self._read(f"commits/{n}") for n in self._list("commits")}

    def _snapshot(self) -> tuple[int, set[str], str | None]:
        names = self._list("snapshots")
        if not names:
            return 0, set(), None
        found = json.loads(self._read(f"snapshots/{max(names)}"))
        return int(max(names)), set(found["batches"]), found["table"]

    def _store(self, totals: DataFrame) -> str:
        name = f"tables/{uuid.uuid4().hex}"
        totals.hint("rebalance").write.parquet(f"{self._root}/{name}")
        return name

    def _exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self._root}/{name}"))

    def _list(self, folder: str) -> list[str]:
        if not self._exists(folder):
            return []
        found = [f.getPath().getName() for f in self._fs.listStatus(self._path(f"{self._root}/{folder}"))]
        return [n for n in found if not n.startswith("_")]

    def _create(self, name: str, content: str) -> bool:
        """A file that appears whole and once: written aside, then linked by a rename that must not overwrite."""
        aside, target = (self._path(f"{self._root}/{n}") for n in (f"aside/{uuid.uuid4().hex}", name))
        out = self._fs.create(aside, False)
        out.write(bytearray(content.encode()))
        out.close()
        self._fs.mkdirs(target.getParent())
        return not self._fs.exists(target) and self._fs.rename(aside, target)

    def _read(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self._root}/{name}"))
        text = self._spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return text
