"""The stages of a curation run, one by one and as a whole."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.align import ORDER, merge_reviews, normalise_records
from gleanery.operators.feed import flatten_feed
from gleanery.operators.labeling import RULES, Labeler, label
from gleanery.operators.ledger import Ledger
from gleanery.operators.prepare import prepare
from gleanery.operators.split import stratified_split
from gleanery.operators.validation import repair_delta
from gleanery.params import CleaningParams, FeedParams, LabelingParams, LabelRules, SplitParams
from gleanery.sources.artefacts import Artefacts
from gleanery.sources.commits import Stages, source_identity
from gleanery.sources.deltas import store_delta
from gleanery.sources.readers import BAD, split_bad, with_flat_order


@dataclass(frozen=True)
class FlowParams:
    feed: FeedParams = field(default_factory=FeedParams)
    cleaning: CleaningParams = field(default_factory=CleaningParams)
    labeling: LabelingParams = field(default_factory=LabelingParams)
    rules: LabelRules = field(default_factory=LabelRules)
    split: SplitParams = field(default_factory=SplitParams)
    validate: bool = True
    #: Also write the raw and merged tables as CSV, the later ones as JSON lines.
    export: bool = True
    #: Folder of a user's labeler's answers, which a repeated run takes instead of calls.
    ledger: str | None = None


def run_land(
    out: Artefacts,
    records: DataFrame | None = None,
    pages: DataFrame | None = None,
    params: FlowParams = FlowParams(),
) -> tuple[DataFrame | None, DataFrame | None]:
    """Raw tables of both platforms, stored; a source without rows leaves none.

    Lines that are no record are stored as ``google_play_bad``; the manifest also
    counts feed entries that could not be read or lie beyond a cap, where there are any.
    """
    landed: list[DataFrame | None] = []
    if records is not None:
        records, bad = split_bad(records)
        if BAD in bad.columns and not bad.isEmpty():
            out.store("google_play_bad", bad)
    feed = Observation("feed")
    for name, rows in (
        ("google_play", None if records is None else normalise_records(records)),
        ("app_store", None if pages is None else flatten_feed(pages, params.feed, counts=feed)),
    ):
        table = None if rows is None else out.store(name, rows)
        if table is not None and not out.rows[name]:
            out.forget(name)
            table = None
        if table is not None and params.export:
            out.store(f"{name}_csv", with_flat_order(table), "csv")
        landed.append(table)
    if pages is not None:
        for artefact, count in (("app_store_unread", feed.get["n_unread"]), ("app_store_cut", feed.get["n_cut"])):
            if count:
                out.note(artefact, "", count)
    return landed[0], landed[1]


def run_merge(
    out: Artefacts,
    google: DataFrame | None,
    app_store: DataFrame | None,
    export: bool = False,
    required: bool = True,
    stored: bool = False,
) -> DataFrame:
    """Unified table, stored.  On its own it needs at least one input; *stored* inputs are parquet tables as read."""
    if required and google is None and app_store is None:
        raise ValueError("give at least one platform's table")
    merged = out.store("merged", merge_reviews(google, app_store, stored=stored))
    if export:
        out.store("merged_csv", merged, "csv")
    return merged


def run_prepare(out: Artefacts, merged: DataFrame, params: CleaningParams = CleaningParams(), export: bool = False) -> DataFrame:
    """Unlabeled rows, stored."""
    unlabeled = out.store("unlabeled", prepare(merged, params))
    if export:
        out.store("unlabeled_json", unlabeled, "json")
    return unlabeled


def run_labeling(
    out: Artefacts,
    unlabeled: DataFrame,
    labeler: Labeler | str = RULES,
    params: FlowParams = FlowParams(),
    export: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """Labeled rows, and the repaired ones unless validation is off or nothing is there.

    The manifest counts the rows that a user's labeler gave no label, where there are any.  Repaired
    rows are stored as a delta of the labeled table, which ``read_table`` merges.
    """
    path = out.path("labeled")
    asked = Observation("labels") if callable(labeler) else None
    ledger = Ledger(params.ledger) if params.ledger else None
    labeled = label(unlabeled, labeler, params.labeling, params.rules, path=path, ledger=ledger, counts=asked)
    out.note("labeled", path, labeled.count())  # from parquet footers
    if asked is not None and asked.get["n_fallback"]:
        out.note("labeled_fallback", "", asked.get["n_fallback"])
    if export:
        out.store("labeled_json", labeled, "json")
    fixed = None
    if params.validate and out.rows["labeled"]:
        repaired = repair_delta(labeled, labeler, params.labeling, params.rules)
        if repaired.rounds.filter("n_invalid > 0").isEmpty():
            out.note("fixed", path, out.rows["labeled"])  # nothing to repair: the same table, not a copy
            fixed = labeled
        else:
            fixed = store_delta(out, "fixed", "labeled", repaired.rows)
        if export:
            out.store("fixed_json", fixed, "json")
    return labeled, fixed


def run_split(out: Artefacts, labeled: DataFrame, id_col: str = "reviewId", params: SplitParams = SplitParams()) -> DataFrame:
    """Labeled rows with their ``split``, stored in one pass as JSON per side."""
    split = stratified_split(labeled, id_col, params)
    sides, counted = ("train", "test"), Observation("sides")
    split = split.observe(counted, *[F.count_if(F.col("split") == side).alias(side) for side in sides])
    out.store("split", split, "split")
    path = out.forget("split")
    for side in sides:
        if counted.get[side]:
            out.note(f"{side}_json", f"{path}/split={side}", counted.get[side])
    return out.spark.read.schema(split.schema).json(path)


def run_all(
    spark: SparkSession,
    root: str,
    records: DataFrame | None = None,
    pages: DataFrame | None = None,
    labeler: Labeler | str = RULES,
    params: FlowParams = FlowParams(),
    run_id: str | None = None,
    resume: bool = False,
    failed: Sequence[str] = (),
) -> Artefacts:
    """Land, merge, prepare, label, repair, split.

    Every stage reads what the one before has stored, so a lost executor costs
    at most the running stage and no labeler call is repeated by a later one.
    With *resume* a run of the same *run_id* goes on behind the stages that it has
    committed, unless their inputs or settings changed since; a user's labeler is
    known by its name, not its code.  *failed* names sources that could not be
    read: each has a row in the manifest.
    """
    if resume and not run_id:
        raise ValueError("give the id of the run to resume")
    out = Artefacts(spark, root, run_id) if run_id else Artefacts(spark, root)
    stages = Stages(out, resume)

    def land() -> None:
        for source in failed:
            out.note(f"{source}_failed", "", 0)
        run_land(out, records, pages, params)

    read = (source_identity(records), source_identity(pages)) if resume or run_id else None
    stages.run("land", (read, tuple(failed), params.feed, params.export), land)
    google, app_store = stages.table("google_play"), stages.table("app_store")
    stages.run("merge", params.export, lambda: run_merge(out, google, app_store, params.export, required=False, stored=True))
    stages.run("prepare", (params.cleaning, params.export), lambda: run_prepare(out, stages.table("merged"), params.cleaning, params.export))
    asked = f"{labeler.__module__}:{labeler.__qualname__}" if hasattr(labeler, "__qualname__") else repr(labeler)
    stages.run(
        "label",
        (asked, params.labeling, params.rules, params.validate, params.export),
        lambda: run_labeling(out, stages.table("unlabeled"), labeler, params, params.export),
    )
    final = "fixed" if "fixed" in out.paths else "labeled"
    stages.run("split", params.split, lambda: run_split(out, stages.table(final), "reviewId", params.split))
    out.reused = tuple(stages.reused)
    return out
