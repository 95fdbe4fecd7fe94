"""Runs that are cut off and repeated."""

from dataclasses import replace

import pandas as pd
import pytest
from test_flow import PARAMS, sources

from gleanery.plans import flow
from gleanery.plans.flow import run_all
from gleanery.schemas import FEED_PAGE
from gleanery.sources.artefacts import Artefacts
from gleanery.sources.commits import Stages, source_identity

STAGES = ("land", "merge", "prepare", "label", "split")


class Cut(Exception):
    pass


@pytest.fixture()
def stored(spark, tmp_path):
    records, pages = sources(spark, tmp_path)
    pages.write.parquet(str(tmp_path / "pages"))
    return records, spark.read.schema(FEED_PAGE).parquet(str(tmp_path / "pages"))


def tables(spark, out):
    return {
        name: sorted(map(str, (spark.read.parquet if name in ("merged", "unlabeled", "labeled", "fixed") else spark.read.json)(path).drop("src_order").toJSON().collect()))
        for name, path in out.paths.items()
        if not name.endswith("_csv") and path and name not in ("google_play", "app_store")
    }


@pytest.mark.parametrize("at", range(1, 5))
def test_run_cut_after_a_stage(spark, stored, tmp_path, monkeypatch, at):
    whole = run_all(spark, str(tmp_path / "whole"), *stored, params=PARAMS, run_id="r")
    step = ("run_land", "run_merge", "run_prepare", "run_labeling", "run_split")[at]
    with monkeypatch.context() as patch:

        def cut(*args, **kwargs):
            raise Cut

        patch.setattr(flow, step, cut)
        with pytest.raises(Cut):
            run_all(spark, str(tmp_path / "cut"), *stored, params=PARAMS, run_id="r")
    out = run_all(spark, str(tmp_path / "cut"), *stored, params=PARAMS, run_id="r", resume=True)
    assert out.reused == STAGES[:at]
    assert out.rows == whole.rows and tables(spark, out) == tables(spark, whole)
    again = run_all(spark, str(tmp_path / "cut"), *stored, params=PARAMS, run_id="r", resume=True)
    assert again.reused == STAGES and again.rows == whole.rows


def test_changes_are_seen(spark, stored, tmp_path):
    root = str(tmp_path / "out")
    calls = []

    def run(params=PARAMS, frames=stored, labeler="rules", resume=True, failed=()):
        calls.append(run_all(spark, root, *frames, labeler, params, "r", resume, failed))
        return calls[-1].reused

    assert run(resume=False) == ()
    assert run(replace(PARAMS, split=replace(PARAMS.split, seed=7))) == STAGES[:4]
    assert run(replace(PARAMS, cleaning=replace(PARAMS.cleaning, min_length=3))) == STAGES[:2]
    assert run() == STAGES[:2]
    assert run(labeler=lambda rows: pd.DataFrame({"primary": ["ui"] * len(rows), "secondary": ["cc"] * len(rows)})) == STAGES[:3]
    assert run(frames=(stored[0].filter("score > 1"), stored[1])) == ()  # same files, other rows
    assert run(frames=(stored[0], None)) == ()
    assert run(frames=(None, stored[1]), failed=("google_play",)) == ()
    assert calls[-1].rows["google_play_failed"] == 0
    assert run(resume=False) == ()
    assert run(resume=False) == ()  # asked for anew
    with (tmp_path / "dump.json").open("a") as file:
        file.write('\n{"reviewId": "late", "content": "太慢了 late", "userName": "u", "score": 1, "at": ""}')
    assert run() == ()


def test_damaged_commits(spark, stored, tmp_path):
    root = str(tmp_path / "out")
    run_all(spark, root, *stored, params=PARAMS, run_id="r")
    commit = tmp_path / "out" / "_stages" / "run_id=r" / "prepare.json"
    for crc in commit.parent.glob(".*.crc"):
        crc.unlink()
    commit.write_text(commit.read_text()[:20])
    assert run_all(spark, root, *stored, params=PARAMS, run_id="r", resume=True).reused == ("land", "merge", "label", "split")
    out = Artefacts(spark, root, "r")
    stages = Stages(out)
    stages.run("land", 1, lambda: None)
    with pytest.raises(Exception, match="exist"):
        stages._commit("land", {})  # a second driver
    with pytest.raises(ValueError, match="id of the run"):
        run_all(spark, root, *stored, resume=True)


def test_identity(spark, stored):
    assert source_identity(None) == source_identity(None)
    assert source_identity(stored[1]) == source_identity(stored[1])
    made = spark.range(3)
    assert source_identity(made) != source_identity(made)
