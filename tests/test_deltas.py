"""Repair as a delta: nothing unchanged is written, and reading merges."""

import shutil
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.errors import AnalysisException

from gleanery.operators.validation import repair, repair_delta, valid_labels
from gleanery.params import LabelingParams
from gleanery.plans.flow import FlowParams, run_labeling, run_split
from gleanery.sources.artefacts import Artefacts
from gleanery.sources.deltas import FILE, ROW, merged, placed, read_table
from gleanery.sources.readers import scan_table

# The labelers below run on workers that cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUICK = LabelingParams(batch_size=7, max_retries=0, retry_delay=0, batch_pause=0, max_rounds=3)
COLUMNS = "id int, reviewId string, primary string, secondary string, text string"


def by_length(batch):
    return pd.DataFrame({"primary": ["BUG" if len(t) % 2 else "UX" for t in batch["text"]], "secondary": ["GENERAL"] * len(batch)})


def stored(spark, tmp_path, rows, name="labeled"):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def some(n=50):
    """Valid rows, rows with a wrong or no label, repeated rows, texts that are NULL or empty."""
    rows = [(i, f"r{i}", "BUG" if i % 4 else None, "GENERAL" if i % 5 else "what", [None, "", "a" * i][min(i % 7, 2)]) for i in range(n)]
    return rows + rows[:10]


def content(df):
    return sorted(map(str, df.select("id", "reviewId", "primary", "secondary", "text").collect()))


def test_delta_equals_repair(spark, tmp_path):
    base = stored(spark, tmp_path, some())
    whole, delta = repair(base, by_length, QUICK), repair_delta(base, by_length, QUICK)
    assert content(merged(base, delta.rows)) == content(whole.rows)
    assert delta.rounds.collect() == whole.rounds.collect()
    assert delta.rows.count() == base.filter(~valid_labels()).count() < base.count()
    spots = delta.rows.select(FILE, ROW).collect()
    assert len(set(spots)) == len(spots)
    assert merged(base, delta.rows).columns == base.columns


def test_nothing_or_everything_is_wrong(spark, tmp_path):
    good = stored(spark, tmp_path, [(1, "a", "BUG", "GENERAL", "x")] * 3, "good")
    delta = repair_delta(good, by_length, QUICK)
    assert delta.rows.isEmpty() and content(merged(good, delta.rows)) == content(good)
    bad = stored(spark, tmp_path, [(1, "a", "?", None, "x")] * 30, "bad")
    delta = repair_delta(bad, by_length, QUICK)
    assert delta.rows.count() == 30 and {r["primary"] for r in merged(bad, delta.rows).collect()} == {"BUG"}
    empty = stored(spark, tmp_path, [], "empty")
    assert merged(empty, repair_delta(empty, by_length, QUICK).rows).count() == 0


def test_rows_without_a_text_column(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "BUG", "GENERAL", "a"), (2, "x", "y", "b")], "id int, primary string, secondary string, review string").write.parquet(path)
    base = spark.read.parquet(path)
    out = merged(base, repair_delta(base, by_length, QUICK).rows)
    assert {r["id"]: (r["primary"], r["text"]) for r in out.collect()} == {1: ("BUG", None), 2: ("BUG", "b")}


def test_places_are_few_and_broadcast(spark, tmp_path):
    base = stored(spark, tmp_path, some())
    changed = str(tmp_path / "changed")
    repair_delta(base, by_length, QUICK).rows.write.parquet(changed)
    plan = merged(base, spark.read.parquet(changed))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert FILE in placed(base).columns


@pytest.mark.parametrize("moved", [False, True])
def test_flow_stores_changes_alone(spark, tmp_path, moved):
    unlabeled = stored(spark, tmp_path, some(), "unlabeled")
    out = Artefacts(spark, str(tmp_path / "out"), "r")
    labeled, fixed = run_labeling(out, unlabeled, by_length, FlowParams(labeling=QUICK, export=False))
    wrong = labeled.filter(~valid_labels()).count()
    assert wrong and out.rows["fixed_changed"] == wrong and out.rows["fixed"] == out.rows["labeled"] == 60
    expected = content(fixed)
    assert expected == content(repair(labeled, by_length, QUICK).rows)
    with pytest.raises(AnalysisException):
        spark.read.parquet(out.paths["fixed"])
    at = out.paths["fixed"]
    if moved:
        at = at.replace(str(tmp_path / "out"), str(tmp_path / "copy"))
        shutil.copytree(tmp_path / "out", tmp_path / "copy")
    assert content(read_table(spark, at)) == content(scan_table(spark, at)) == expected
    split = run_split(out, scan_table(spark, at))
    assert split.count() == 60 and split.filter(~valid_labels()).isEmpty()
    # The same run again, now without anything to repair, and with it once more.
    run_labeling(out, unlabeled.filter(valid_labels()), by_length, FlowParams(labeling=QUICK, export=False))
    assert out.paths["fixed"] == out.paths["labeled"]
    run_labeling(out, unlabeled, by_length, FlowParams(labeling=QUICK, export=False))
    assert content(read_table(spark, out.paths["fixed"])) == expected
