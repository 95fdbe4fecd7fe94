"""Label texts with keyword rules or a user's batch labeler."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gleanery.functions.labels import canonical_primary, canonical_secondary, parse_labels
from gleanery.operators.ledger import Ledger, Slots
from gleanery.params import LabelingParams, LabelRules
from gleanery.schemas import PRIMARY_FALLBACK, SECONDARY_FALLBACK
from gleanery.sources.scratch import written

#: Takes a frame of at most ``batch_size`` rows, returns one with the columns
#: ``primary`` and ``secondary``, in the same order.
Labeler = Callable[[pd.DataFrame], pd.DataFrame]

RULES = "rules"

_LABELS = "primary string, secondary string"


def is_pending(primary: Column) -> Column:
    """Not labeled yet: NULL or empty."""
    return F.coalesce(primary, F.lit("")) == ""


def split_pending(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows still to be labeled, and those that are."""
    pending = is_pending(F.col("primary"))
    return rows.filter(pending), rows.filter(~pending)


def rule_labels(text: Column, rules: LabelRules = LabelRules()) -> tuple[Column, Column]:
    """Primary and secondary label of *text* by keyword rules.

    The nature is the most severe one that matches.  The area is the one that
    matches, if it is the only one; otherwise the text is ambiguous there.
    """
    return _lowered_rules(F.lower(F.coalesce(text, F.lit(""))), rules)


def _lowered_rules(lowered: Column, rules: LabelRules) -> tuple[Column, Column]:
    nature = F.lit(rules.primary_fallback)
    for label, pattern in reversed(rules.nature):
        nature = F.when(lowered.rlike(pattern), label).otherwise(nature)
    touched = F.array_compact(F.array(*[F.when(lowered.rlike(p), label) for label, p in rules.area]))
    area = F.when(F.size(touched) == 1, F.get(touched, F.lit(0))).otherwise(rules.secondary_fallback)
    return nature, area


def batched(
    labeler: Labeler, params: LabelingParams, pause: float, sleep: Callable[[float], None], ledger: Ledger | None = None, width: int | None = None
):
    """An iterator function that calls *labeler* on full batches of wanted rows.

    Input frames carry a boolean ``_wanted`` first; rows without it get NULL
    labels and take no place in a batch.  Output keeps the input's row order.
    A batch that *ledger* has an answer for is not asked again.  With *width*, the number of
    tasks, ``max_rate`` bounds the calls of all of them.
    """
    slots: list[Slots] = []  # of the task that runs this

    def attempt(batch: pd.DataFrame) -> pd.DataFrame | None:
        for turn in range(params.max_retries + 1):
            if turn:
                sleep(params.retry_delay)
            if params.max_rate and width:
                if not slots:
                    slots.append(Slots(params.max_rate, width, TaskContext.get().partitionId() % width))
                slots[0].wait(sleep)
            try:
                found = labeler(batch)
            except Exception as failure:
                logging.getLogger("gleanery").warning("labeler attempt %d failed: %s", turn + 1, failure)
                continue
            if found is not None and len(found):
                return found
        return None

    def labels_of(batch: pd.DataFrame) -> pd.DataFrame:
        digest = ledger.digest(batch) if ledger else None
        found = ledger.read(digest) if ledger else None
        if found is None:
            found = attempt(batch)
            if found is not None:
                found = found.reset_index(drop=True).reindex(columns=["primary", "secondary"])
                found = found.map(lambda v: getattr(v, "value", v))
            if ledger:
                ledger.write(digest, found, len(batch))
            sleep(pause)
        if found is None:
            found = pd.DataFrame()
        # By position: what is missing at the end stays empty, surplus is cut.
        found = found.reset_index(drop=True).reindex(index=range(len(batch)), columns=["primary", "secondary"])
        found = found.astype(object).where(found.notna(), None)
        return found.map(lambda v: v if v is None else str(getattr(v, "value", v)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queued: list[pd.DataFrame] = []  # wanted rows not labeled yet
        labels: list[pd.DataFrame] = []  # labels not handed out yet
        masks: list[np.ndarray] = []  # input frames not answered yet
        ready = 0

        def answers(last: bool) -> Iterator[pd.DataFrame]:
            nonlocal labels, ready
            while masks and (last or masks[0].sum() <= ready):
                mask = masks.pop(0)
                stock = pd.concat(labels, ignore_index=True) if labels else pd.DataFrame(columns=["primary", "secondary"])
                need = int(mask.sum())
                out = pd.DataFrame({"primary": None, "secondary": None}, index=range(len(mask)), dtype=object)
                out.loc[mask, ["primary", "secondary"]] = stock.iloc[:need].to_numpy()
                labels, ready = [stock.iloc[need:]], ready - need
                yield out

        for frame in frames:
            mask = frame["_wanted"].to_numpy(dtype=bool)
            masks.append(mask)
            queued.append(frame.loc[mask].drop(columns="_wanted"))
            if sum(map(len, queued)) >= params.batch_size:
                rows = pd.concat(queued, ignore_index=True)
                full = len(rows) - len(rows) % params.batch_size
                for start in range(0, full, params.batch_size):
                    labels.append(labels_of(rows.iloc[start : start + params.batch_size].reset_index(drop=True)))
                ready += full
                queued = [rows.iloc[full:]]
            yield from answers(last=False)
        rest = pd.concat(queued, ignore_index=True) if queued else pd.DataFrame()
        if len(rest):
            labels.append(labels_of(rest))
            ready += len(rest)
        yield from answers(last=True)

    return run


def labeler_column(
    labeler: Labeler,
    wanted: Column,
    inputs: Sequence[str],
    params: LabelingParams,
    pause: float,
    sleep: Callable[[float], None] = time.sleep,
    ledger: Ledger | None = None,
    width: int | None = None,
) -> Column:
    """``struct<primary, secondary>`` as returned by *labeler*, NULL where not *wanted*.

    Only *inputs* travel to Python.  Declared non-deterministic: Spark calls it
    once per row and moves no filter below it.
    """
    run = batched(labeler, params, pause, sleep, ledger, width)

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from run(frames)

    apply = F.pandas_udf(call, _LABELS).asNondeterministic()
    texts = [F.coalesce(F.col(c), F.lit("")).alias(c) if c == "text" else F.col(c) for c in inputs]
    return apply(F.struct(wanted.alias("_wanted"), *texts))


def with_labels(
    rows: DataFrame,
    labeler: Labeler | str,
    wanted: Column,
    params: LabelingParams = LabelingParams(),
    rules: LabelRules = LabelRules(),
    inputs: Sequence[str] = ("text",),
    sanitise: bool = True,
    pause: float = 0.0,
    sleep: Callable[[float], None] = time.sleep,
    ledger: Ledger | None = None,
    width: int | None = None,
    counts: Observation | None = None,
) -> DataFrame:
    """*rows* with new labels where *wanted*; the rest keeps its own.

    *counts* gets ``n_fallback``, the wanted rows that the labeler gave no label.
    """
    if isinstance(labeler, str):
        if labeler != RULES:
            raise ValueError(f"unknown labeler {labeler!r}; use {RULES!r} or a function")
        # Lower-cased once, as a column of its own, for all the patterns.
        primary, secondary = _lowered_rules(F.col("_lowered"), rules)
        new = rows.withColumn("_lowered", F.when(wanted, F.lower(F.coalesce(F.col("text"), F.lit("")))))
        new = new.withColumn("_new", F.when(wanted, F.struct(primary.alias("primary"), secondary.alias("secondary"))))
        new = new.drop("_lowered")
    else:
        new = rows.withColumn("_new", labeler_column(labeler, wanted, inputs, params, pause, sleep, ledger, width))
    primary, secondary = F.col("_new.primary"), F.col("_new.secondary")
    if counts is not None:
        new = new.observe(counts, F.count_if(wanted & primary.isNull() & secondary.isNull()).alias("n_fallback"))
    if sanitise:
        primary, secondary = canonical_primary(primary), canonical_secondary(secondary)
    else:
        primary = F.coalesce(primary, F.lit(PRIMARY_FALLBACK))
        secondary = F.coalesce(secondary, F.lit(SECONDARY_FALLBACK))
    return new.withColumns(
        {
            "text": F.when(wanted, F.coalesce(F.col("text"), F.lit(""))).otherwise(F.col("text")),
            "primary": F.when(wanted, primary).otherwise(F.col("primary")),
            "secondary": F.when(wanted, secondary).otherwise(F.col("secondary")),
        }
    ).drop("_new")


def label(
    rows: DataFrame,
    labeler: Labeler | str = RULES,
    params: LabelingParams = LabelingParams(),
    rules: LabelRules = LabelRules(),
    inputs: Sequence[str] = ("text",),
    sanitise: bool = True,
    parallelism: int | None = None,
    path: str | None = None,
    sleep: Callable[[float], None] = time.sleep,
    ledger: Ledger | None = None,
    counts: Observation | None = None,
) -> DataFrame:
    """Label the pending rows of *rows* in one pass; other columns pass through.

    A user's labeler is called on batches of exactly ``batch_size`` pending rows
    (the last of each partition may be shorter), as many at a time as there are
    tasks; an input column that is missing counts as NULL; *parallelism* sets that number.  Its result is written once, to *path*
    or a scratch table, so that no later job calls the labeler again.

    With *ledger* an answered batch is not asked again by a task that replaces a lost one, or by a
    run that is repeated on the same stored rows.  ``max_rate`` bounds the calls a second over all tasks;
    their number is then fixed, to *parallelism* or else to that of the session's cores.
    *counts* gets ``n_fallback``.
    """
    columns = rows.columns
    for name in ("primary", "secondary", *inputs):
        if name not in columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    pending = is_pending(F.col("primary"))
    if callable(labeler) and params.max_rate and not parallelism:
        parallelism = rows.sparkSession.sparkContext.defaultParallelism
    if callable(labeler) and parallelism:
        rows = rows.repartition(parallelism)
    # The old label decides what is pending, so it is settled before the new one.
    rows = rows.withColumn("_pending", pending)
    out = with_labels(
        rows, labeler, F.col("_pending"), params, rules, inputs, sanitise, params.batch_pause, sleep, ledger, parallelism, counts
    ).drop("_pending")
    if callable(labeler) or path:
        out = written(out, "labeled", path)
    return out


def batch_payloads(rows: DataFrame, batch_size: int = 100, index: str = "index", text: str = "text") -> DataFrame:
    """One request body per batch of consecutive *index* values.

    ``batch_id, n, body`` with ``body`` = ``{"reviews": [{"text": ...}, ...]}``
    in index order.  A group never exceeds *batch_size* rows.
    """
    item = F.struct(F.col(index).alias("at"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    reviews = F.transform(F.array_sort(F.collect_list(item)), lambda r: F.struct(r["text"].alias("text")))
    return (
        rows.withColumn("batch_id", F.floor(F.col(index) / batch_size))
        .groupBy("batch_id")
        .agg(F.count(F.lit(1)).alias("n"), F.to_json(F.struct(reviews.alias("reviews"))).alias("body"))
    )


def response_labels(responses: DataFrame, batch: str = "batch_id", body: str = "body") -> DataFrame:
    """Responses exploded to ``batch, pos, raw_primary, raw_secondary``."""
    return responses.select(batch, F.posexplode(parse_labels(F.col(body))).alias("pos", "found")).select(
        batch, "pos", F.col("found.primary").alias("raw_primary"), F.col("found.secondary").alias("raw_secondary")
    )


def one_response(responses: DataFrame, batch: str = "batch_id", body: str = "body", order_by: Sequence[str] = ()) -> DataFrame:
    """One response per batch: the first in *order_by*, else the one with most labels, then the least text."""
    rank = F.struct(*order_by, (-F.coalesce(F.size(parse_labels(F.col(body))), F.lit(-1))).alias("_few"), F.col(body).alias("_body"))
    return responses.groupBy(batch).agg(F.min_by(body, rank).alias(body))


def apply_responses(
    rows: DataFrame, responses: DataFrame, batch: str = "batch_id", pos: str = "pos", order_by: Sequence[str] = ()
) -> DataFrame:
    """*rows* with the labels that landed responses give them by position.

    Rows a response does not reach, and those of unreadable responses, get the
    fallback labels.  Surplus response items are ignored.  Of several responses to
    one batch, as retries leave them, ``one_response`` counts.
    """
    found = response_labels(one_response(responses, batch, order_by=order_by), batch).withColumnRenamed("pos", pos)
    kept = [c for c in rows.columns if c not in ("primary", "secondary")]
    joined = rows.select(*kept).join(found.withColumn(pos, F.col(pos).cast(rows.schema[pos].dataType)), [batch, pos], "left")
    return joined.select(
        *kept,
        canonical_primary(F.col("raw_primary")).alias("primary"),
        canonical_secondary(F.col("raw_secondary")).alias("secondary"),
    )
