import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gleanery.operators.labeling import label
from gleanery.operators.ledger import Ledger, Slots
from gleanery.params import LabelingParams
from gleanery.plans.flow import FlowParams, run_labeling
from gleanery.schemas import UNLABELED
from gleanery.sources.artefacts import Artefacts

PARAMS = LabelingParams(batch_size=5, max_retries=0, retry_delay=0, batch_pause=0)


def table(spark, n, path):
    rows = spark.range(n).select(F.col("id").cast("string").alias("reviewId"), F.lit("p").alias("platform"), F.concat(F.lit("t"), "id").alias("text"))
    rows.withColumns({"primary": F.lit(""), "secondary": F.lit("")}).coalesce(2).write.parquet(path)
    return spark.read.schema(UNLABELED).parquet(path)


def logging_labeler(log, stop=None):
    """Notes every call; ends its whole process at its call number *stop*, as a lost executor does."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        if stop is not None and len(os.listdir(log)) >= stop:
            os._exit(1)
        open(f"{log}/{time.time_ns()}-{os.getpid()}-{batch['text'].iloc[0]}", "w").close()
        return pd.DataFrame({"primary": ["BUG"] * len(batch), "secondary": [None] * len(batch)})

    return run


def test_a_lost_task_repeats_no_answered_batch(spark, tmp_path):
    rows = table(spark, 60, str(tmp_path / "t"))
    logs = [tmp_path / "one", tmp_path / "two"]
    for log in logs:
        log.mkdir()
    ledger = Ledger(str(tmp_path / "ledger"))
    with pytest.raises(Exception):  # noqa: B017  (the kind differs with where Spark notices)
        label(rows, logging_labeler(str(logs[0]), stop=4), PARAMS, ledger=ledger)
    answered = {r["state"]: r["n_batches"] for r in ledger.report(spark).collect()}
    before = {name.split("-")[2] for name in os.listdir(logs[0])}
    assert 3 <= answered["answered"] <= len(before)
    out = label(rows, logging_labeler(str(logs[1])), PARAMS, ledger=ledger)
    assert out.filter("primary = 'BUG' and secondary = 'GENERAL'").count() == 60
    # Batches answered before are not asked again; the rest is asked once.
    assert len(os.listdir(logs[1])) == 12 - answered["answered"]
    assert [tuple(r) for r in ledger.report(spark).collect()] == [("answered", 12, 60)]


def test_failed_batches_are_counted_and_asked_again(spark, tmp_path):
    rows = table(spark, 20, str(tmp_path / "t"))

    def fails(batch):
        if (batch["text"] == "t7").any():
            raise RuntimeError("no answer")
        return pd.DataFrame({"primary": "BUG", "secondary": "GENERAL"}, index=range(len(batch)))

    out = Artefacts(spark, str(tmp_path / "out"), "r")
    params = FlowParams(labeling=PARAMS, validate=False, ledger=str(tmp_path / "ledger"))
    labeled, _ = run_labeling(out, rows, fails, params)
    n = labeled.filter("primary = 'INVALID'").count()
    assert n == 5 and {r["artefact"]: r["n_rows"] for r in out.manifest().collect()} == {"labeled": 20, "labeled_fallback": 5}
    assert {tuple(r) for r in Ledger(params.ledger).report(spark).collect()} == {("answered", 3, 15), ("failed", 1, 5)}
    again = label(rows, logging_labeler(str(tmp_path)), PARAMS, ledger=Ledger(params.ledger))
    assert again.filter("primary = 'BUG'").count() == 20
    assert {tuple(r) for r in Ledger(params.ledger).report(spark).collect()} == {("answered", 4, 20)}


def test_digest_tells_batches_apart():
    a, b = pd.DataFrame({"text": ["a", None]}), pd.DataFrame({"text": ["a", "None"]})
    assert Ledger.digest(a) == Ledger.digest(a.copy()) != Ledger.digest(b)
    assert Ledger.digest(pd.DataFrame({"text": ["ab", "c"]})) != Ledger.digest(pd.DataFrame({"text": ["a", "bc"]}))


@pytest.mark.parametrize("width", [1, 8])
def test_slots_bound_the_rate(width):
    starts = []
    for index in range(width):
        now = [100.0 + 0.013 * index]
        slots = Slots(4.0, width, index, clock=lambda now=now: now[0])
        for _ in range(40 // width):
            slots.wait(lambda s, now=now: now.__setitem__(0, now[0] + s))
            starts.append(now[0])
            now[0] += 0.001
    starts.sort()
    assert all(sum(t <= u < t + 0.999 for u in starts) <= 4 for t in starts)
    assert starts[-1] - starts[0] < 11  # and no slot is left out


@pytest.mark.parametrize("tasks", [1, 8])
def test_rate_over_tasks(spark, tmp_path, tasks):
    rows = table(spark, 40, str(tmp_path / "t"))
    (tmp_path / "log").mkdir()
    params = LabelingParams(batch_size=5 if tasks == 1 else 2, max_retries=0, batch_pause=0, max_rate=10.0)
    out = label(rows, logging_labeler(str(tmp_path / "log")), params, parallelism=tasks)
    assert out.filter("primary = 'BUG'").count() == 40
    starts = sorted(int(name.split("-")[0]) / 1e9 for name in os.listdir(tmp_path / "log"))
    assert len(starts) >= 8 and all(sum(t <= u < t + 1 for u in starts) <= 11 for t in starts)
