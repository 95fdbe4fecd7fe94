"""What a labeler has answered, kept where a lost task's successor finds it, and when it may be called.

A ledger is a folder that all executors share, with one file per batch, named by a digest of what was
asked.  A task looks there before each call and writes each answer once, under its final
name only when it is whole.  A batch that was never answered leaves its file in a folder of its own: it is
counted, and asked again by the next run.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ANSWERED, _FAILED = "answered", "failed"


@dataclass(frozen=True)
class Ledger:
    """Answers below *root*, a URI or path that ``pyarrow.fs`` and Spark both reach; one folder per labeler and its settings."""

    root: str

    def _store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.root) if "://" in self.root or self.root.startswith("file:") else (fs.LocalFileSystem(), self.root)

    @staticmethod
    def digest(batch: pd.DataFrame) -> str:
        """Names a batch by the columns and values it holds, in order."""
        rows = [list(batch.columns), *([None if v is None or v != v else str(v) for v in row] for row in batch.itertuples(index=False))]
        return hashlib.sha256(json.dumps(rows, ensure_ascii=False).encode("utf-8", "surrogatepass")).hexdigest()

    def read(self, digest: str) -> pd.DataFrame | None:
        """The batch's answer, None if there is none."""
        store, root = self._store()
        path = f"{root}/{_ANSWERED}/{digest[:2]}/{digest}.json"
        if store.get_file_info(path).type != fs.FileType.File:
            return None
        with store.open_input_stream(path) as file:
            held = json.loads(file.read())
        return pd.DataFrame(held["labels"], columns=["primary", "secondary"], dtype=object)

    def write(self, digest: str, answer: pd.DataFrame | None, n_rows: int) -> None:
        """Keeps *answer*, or that there was none; an answer that is there already stays."""
        store, root = self._store()
        folder = f"{root}/{_ANSWERED if answer is not None else _FAILED}/{digest[:2]}"
        path = f"{folder}/{digest}.json"
        if store.get_file_info(path).type == fs.FileType.File:
            return
        labels = None if answer is None else answer[["primary", "secondary"]].astype(object).where(answer[["primary", "secondary"]].notna(), None).to_numpy().tolist()
        store.create_dir(folder, recursive=True)
        aside = f"{folder}/_{digest}.{uuid.uuid4().hex}"  # Spark reads no names that begin so
        with store.open_output_stream(aside) as file:
            file.write(json.dumps({"digest": digest, "n_rows": n_rows, "labels": labels}, ensure_ascii=False).encode())
        store.move(aside, path)

    def report(self, spark: SparkSession) -> DataFrame:
        """``state, n_batches, n_rows``: answered, and failed without an answer since."""
        store, root = self._store()
        found = []
        for state in (_ANSWERED, _FAILED):
            if store.get_file_info(f"{root}/{state}").type == fs.FileType.Directory:
                path = f"{self.root}/{state}"
                found.append(spark.read.schema("digest string, n_rows bigint").option("recursiveFileLookup", True).json(path).withColumn("state", F.lit(state)))
        if not found:
            return spark.createDataFrame([], "state string, n_batches bigint, n_rows bigint")
        rows = found[0] if len(found) == 1 else found[0].unionByName(found[1])
        last = rows.groupBy("digest").agg(F.min("state").alias("state"), F.max("n_rows").alias("n_rows"))  # answered sorts first
        return last.groupBy("state").agg(F.count("*").alias("n_batches"), F.sum("n_rows").alias("n_rows"))


@dataclass
class Slots:
    """Times at which task *index* of *width* may start a call, so that all tasks together make at most *rate* a second.

    Time is cut into slots of ``1 / rate`` seconds, dealt out in turn by the clock.  A task uses each of
    its slots once, however often it retries, so the bound holds whether tasks run at once or one by one.
    """

    rate: float
    width: int
    index: int
    clock: Callable[[], float] = time.time
    _used: int = -1

    def wait(self, sleep: Callable[[float], None] = time.sleep) -> None:
        """Returns at the start of this task's next unused slot."""
        while True:
            slot = int(self.clock() * self.rate)
            turn = slot + (self.index - slot) % self.width
            if turn <= self._used:
                turn = self._used + self.width
            left = turn / self.rate - self.clock()
            if left <= 0:
                self._used = turn
                return
            sleep(left)
