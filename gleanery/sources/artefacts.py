"""Writers, run ids and the manifest of a run's artefacts."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN = "run_id"

_COUNTED = "manifest"


def new_run_id(now: datetime | None = None) -> str:
    """Version key of one run: ``yyyymmdd_hhmmss``."""
    return (now or datetime.now()).strftime("%Y%m%d_%H%M%S")


def write_csv(rows: DataFrame, path: str, encoding: str = "utf-8") -> None:
    """CSV with a header that :func:`scan_csv` reads back unchanged."""
    rows.write.mode("overwrite").options(
        header=True,
        quote='"',
        escape='"',
        encoding=encoding,
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    """JSON lines; NULL fields are written."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_split(rows: DataFrame, path: str) -> None:
    """JSON lines under ``split=train`` and ``split=test``, in one pass."""
    rows.write.mode("overwrite").partitionBy("split").option("ignoreNullFields", False).json(path)


@dataclass
class Artefacts:
    """Where the tables of one run go, and what has been written.

    A table is stored below ``<root>/<name>/run_id=<run>``, so that readers of
    ``<root>/<name>`` find all runs and prune by ``run_id``.
    """

    spark: SparkSession
    root: str
    run_id: str = field(default_factory=new_run_id)
    paths: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    #: Stages of a resumed run that had been done before.
    reused: tuple[str, ...] = ()

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}/{RUN}={self.run_id}"

    def store(self, name: str, rows: DataFrame, file_format: str = "parquet") -> DataFrame:
        """Write *rows* as artefact *name*, note path and row count, read it back.

        The count is taken by the write itself.
        """
        counted = Observation(_COUNTED)
        seen = rows.observe(counted, F.count(F.lit(1)).alias("n"))
        path = self.path(name)
        if file_format == "parquet":
            seen.write.mode("overwrite").parquet(path)
        elif file_format == "csv":
            write_csv(seen, path)
        elif file_format == "json":
            write_json(seen, path)
        elif file_format == "split":
            write_split(seen, path)
        else:
            raise ValueError(f"unknown format {file_format!r}")
        self.note(name, path, counted.get["n"])
        if file_format == "parquet":
            return self.spark.read.schema(rows.schema).parquet(path)
        return rows

    def note(self, name: str, path: str, n_rows: int) -> None:
        """Enter an artefact in the manifest."""
        self.paths[name], self.rows[name] = path, n_rows

    def forget(self, name: str) -> str:
        """Take an artefact out of the manifest; its path."""
        del self.rows[name]
        return self.paths.pop(name)

    def manifest(self) -> DataFrame:
        """``artefact, path, n_rows`` of everything stored; what is absent has no row."""
        found = [(name, path, self.rows[name]) for name, path in self.paths.items()]
        return self.spark.createDataFrame(found, "artefact string, path string, n_rows bigint")


def read_artefact(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None, run_id: str | None = None, file_format: str = "parquet") -> DataFrame:
    """All runs of artefact *name* with their ``run_id``, or one run's rows."""
    reader = spark.read.format(file_format)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(RUN, T.StringType(), True)]))
    rows = reader.load(f"{root.rstrip('/')}/{name}")
    return rows if run_id is None else rows.filter(F.col(RUN) == run_id)
