import json

import pandas as pd
import pytest

from gleanery.operators.labeling import label
from gleanery.params import CleaningParams, FeedParams, LabelingParams, SplitParams
from gleanery.plans.flow import FlowParams, run_all, run_merge, run_prepare, run_split
from gleanery.schemas import FEED_PAGE, GOOGLE_PLAY_RAW, LABELED
from gleanery.sources.artefacts import Artefacts
from gleanery.sources.readers import scan_json, scan_merged, scan_records

PARAMS = FlowParams(
    feed=FeedParams(review_count=None),
    cleaning=CleaningParams(min_length=2),
    labeling=LabelingParams(batch_size=4, batch_pause=0, retry_delay=0),
    split=SplitParams(test_size=0.25),
)
WORDS = ["閃退了", "介面很醜", "太慢了", "希望新增", "很好用"]


def sources(spark, tmp_path):
    lines = [
        {"reviewId": f"g{i}", "userName": "u", "score": 1 + i % 5, "at": "2025-01-01 10:00:00", "content": f"{WORDS[i % 5]}！{i}"}
        for i in range(40)
    ]
    lines += [{"reviewId": "g0", "content": "太慢了 again", "userName": "u", "score": 1, "at": ""}, {"reviewId": "short", "content": "x", "userName": "u", "score": 1, "at": ""}]
    (tmp_path / "dump.json").write_text("\n".join(json.dumps(x) for x in lines))
    entries = [
        {
            "author": {"name": {"label": "a"}}, "content": {"label": f"{WORDS[i % 5]} 👍 {i}"}, "im:rating": {"label": "5"},
            "title": {"label": ""}, "id": {"label": f"a{i}" if i else "g1"}, "updated": {"label": "2025-01-01T10:00:00-07:00"},
        }
        for i in range(21)
    ]
    body = json.dumps({"feed": {"entry": [{}, *entries]}})
    pages = spark.createDataFrame([("1", "tw", 1, body), ("1", "tw", 2, "gone")], FEED_PAGE)
    return scan_records(spark, str(tmp_path / "dump.json"), GOOGLE_PLAY_RAW), pages


def test_whole_run(spark, tmp_path):
    records, pages = sources(spark, tmp_path)
    out = run_all(spark, str(tmp_path / "out"), records, pages, "rules", PARAMS, "r1")
    assert out.rows == {
        "google_play": 42, "google_play_csv": 42, "app_store": 21, "app_store_csv": 21, "merged": 61, "merged_csv": 61, "unlabeled": 60, "unlabeled_json": 60,
        "labeled": 60, "labeled_json": 60, "fixed": 60, "fixed_json": 60, "train_json": 45, "test_json": 15,
    }
    assert {r["artefact"] for r in out.manifest().collect()} == set(out.rows)
    assert all(p.startswith(str(tmp_path / "out")) and "run_id=r1" in p for p in out.paths.values())
    assert scan_merged(spark, out.paths["merged_csv"]).count() == 61
    labeled = {r["reviewId"]: (r["text"], r["primary"]) for r in scan_json(spark, out.paths["labeled_json"]).collect()}
    assert labeled["g0"] == ("閃退了!0", "BUG") and labeled["g1"] == ("介面很醜!1", "UI/UX") and labeled["a4"] == ("很好用 4", "POSITIVE")
    sides = [spark.read.schema(LABELED).json(out.paths[s]).select("reviewId") for s in ("train_json", "test_json")]
    assert sides[0].intersect(sides[1]).isEmpty() and sides[0].union(sides[1]).distinct().count() == 60


def test_one_source_and_own_labeler(spark, tmp_path):
    records, _ = sources(spark, tmp_path)

    def labeler(batch):
        return pd.DataFrame({"primary": ["crash" if k % 2 else "ui" for k in range(len(batch))], "secondary": ["cc"] * len(batch)})

    plain = FlowParams(cleaning=PARAMS.cleaning, labeling=PARAMS.labeling, split=PARAMS.split, validate=False, export=False)
    out = run_all(spark, str(tmp_path / "out"), records, None, labeler, plain)
    assert set(out.rows) == {"google_play", "merged", "unlabeled", "labeled", "train_json", "test_json"}
    assert out.rows["train_json"] + out.rows["test_json"] == 40


def test_stages_alone(spark, tmp_path):
    records, pages = sources(spark, tmp_path)
    out = Artefacts(spark, str(tmp_path / "out"))
    with pytest.raises(ValueError, match="at least one"):
        run_merge(out, None, None)
    empty = run_merge(out, None, None, required=False)
    assert run_prepare(out, empty).isEmpty()
    with pytest.raises(ValueError, match="empty"):
        run_split(out, label(empty.selectExpr("reviewId", "content AS text"), "rules"))
    with pytest.raises(ValueError, match="empty"):  # nothing landed, nothing to split
        run_all(spark, str(tmp_path / "none"), params=PARAMS)


def test_job_stages(spark, tmp_path):
    """The stages chained through the command line, as the whole run does it."""
    from gleanery.__main__ import arguments, run

    _, pages = sources(spark, tmp_path)
    pages.write.parquet(str(tmp_path / "pages"))
    common = ["--out", str(tmp_path / "out"), "--run-id", "r", "--min-length", "2", "--test-size", "0.25"]

    def stage(*args):
        return run(spark, arguments([args[0], *common, *map(str, args[1:])]))

    landed = stage("land", "--records", tmp_path / "dump.json", "--pages", tmp_path / "pages")
    assert set(landed) == {"google_play", "google_play_csv", "app_store", "app_store_csv"}
    merged = stage("merge", "--google", landed["google_play"], "--app-store", landed["app_store"])
    prepared = stage("prepare", "--table", merged["merged"])
    labeled = stage("label", "--table", prepared["unlabeled"])
    done = stage("split", "--table", labeled["fixed"])
    assert spark.read.json(done["train_json"]).count() == 45
    whole = run(spark, arguments(["run-all", "--out", str(tmp_path / "all"), "--pages", str(tmp_path / "pages"), "--no-export"]))
    assert set(whole) == {"app_store", "merged", "unlabeled", "labeled", "fixed", "train_json", "test_json"}
    with pytest.raises(ValueError, match="--table"):
        stage("split")
