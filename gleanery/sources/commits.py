"""Commits of a run's stages, so that a run that was cut off goes on where it stopped.

A stage is committed by one small file, made only if there is none and written after all of its
tables.  The file holds the stage's fingerprint: its settings, and the fingerprint of the
stage before, the first one's being that of the files read.  A stage is taken as done only if its
commit is whole, has the fingerprint of today's run, and its tables are there.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.sources.artefacts import RUN, Artefacts
from gleanery.sources.deltas import read_table


def source_identity(rows: DataFrame | None) -> str:
    """Changes whenever the files of *rows* (path, length, time of change), its schema or its plan do.

    A table that is not read from files is never the same twice.  The files are looked at by
    tasks, none is opened.
    """
    if rows is None:
        return "none"
    files = rows.inputFiles()
    if not files:
        return uuid.uuid4().hex
    listed = rows.sparkSession.read.format("binaryFile").load(files)
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    n_files, total = listed.agg(F.count(F.lit(1)), F.sum(each)).first()
    plan = re.sub(r"#\d+L?", "", rows._jdf.queryExecution().analyzed().toString())  # without this session's numbers
    return f"{n_files} {total} {rows.schema.json()} {plan}"


class Stages:
    """Runs the stages of *out*'s run in order; with *resume* those that are done are not run again.

    ``reused`` names the stages that were found done.  One driver at a time may work on a run:
    a second one's commit fails.
    """

    def __init__(self, out: Artefacts, resume: bool = False):
        self.out, self.resume, self.reused = out, resume, []
        self._before = ""
        self._root = f"{out.root.rstrip('/')}/_stages/{RUN}={out.run_id}"

    def run(self, stage: str, settings: object, work: Callable[[], object]) -> None:
        """*work* stores its tables in ``out``, whose manifest then has them, whether it ran or was found done."""
        mark = hashlib.sha256(f"{self._before}\n{stage}\n{settings!r}".encode("utf-8", "surrogatepass")).hexdigest()
        self._before = mark
        held = self._held(stage) if self.resume else None
        if held and held["fingerprint"] == mark and all(self._exists(path) for path, _ in held["artefacts"].values() if path):
            for name, (path, n_rows) in held["artefacts"].items():
                self.out.note(name, path, n_rows)
            self.reused.append(stage)
            return
        self._clear(stage)  # before the first table is overwritten
        known = set(self.out.paths)
        work()
        made = {name: (path, self.out.rows[name]) for name, path in self.out.paths.items() if name not in known}
        self._commit(stage, {"fingerprint": mark, "artefacts": made})

    def table(self, name: str) -> DataFrame | None:
        """A parquet artefact of this run, None if it has none of the name."""
        return read_table(self.out.spark, self.out.paths[name]) if name in self.out.paths else None

    def _file(self, path: str):
        found = self.out.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.out.spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        found, files = self._file(path)
        return files.exists(found)

    def _held(self, stage: str) -> dict | None:
        if not self._exists(f"{self._root}/{stage}.json"):
            return None
        lines = self.out.spark.read.text(f"{self._root}/{stage}.json", wholetext=True).collect()  # one small file
        try:
            return json.loads(lines[0]["value"]) if lines else None
        except ValueError:  # cut off while it was written
            return None

    def _clear(self, stage: str) -> None:
        found, files = self._file(f"{self._root}/{stage}.json")
        files.delete(found, False)

    def _commit(self, stage: str, content: dict) -> None:
        found, files = self._file(f"{self._root}/{stage}.json")
        stream = files.create(found, False)  # fails if the file is there
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
