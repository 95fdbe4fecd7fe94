"""Find invalid labels and repair them in bounded rounds."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.labels import is_label
from gleanery.functions.text import preview
from gleanery.operators.labeling import Labeler, with_labels
from gleanery.params import LabelingParams, LabelRules
from gleanery.schemas import PRIMARY_FALLBACK, PRIMARY_LABELS, SECONDARY_FALLBACK, SECONDARY_LABELS
from gleanery.sources.deltas import placed
from gleanery.sources.scratch import written

#: Characters that Python's ``repr`` escapes by number: all that don't print, the plain space aside.
_UNPRINTED = r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}\p{Zl}\p{Zp}\p{Zs}&&[^ ]]"
_ROUNDS = "round int, n_invalid bigint, n_primary bigint, n_secondary bigint"


def valid_labels() -> Column:
    return is_label(F.col("primary"), PRIMARY_LABELS) & is_label(F.col("secondary"), SECONDARY_LABELS)


def _numbered(char: Column) -> Column:
    point = F.ascii(char)
    digits = F.lower(F.hex(point))
    wide = F.when(point > 0xFFFF, F.concat(F.lit("\\U"), F.lpad(digits, 8, "0"))).when(point > 0xFF, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
    return F.when(char.rlike(_UNPRINTED), wide.otherwise(F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))).otherwise(char)


def _quoted(value: Column) -> Column:
    """The value as Python prints it: quoted, or None.

    Characters that the JVM's Unicode version doesn't know yet are escaped, though Python's may print them.
    """
    text = value
    for char, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(char), F.lit(shown))
    text = F.when(text.rlike(_UNPRINTED), F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), _numbered), "")).otherwise(text)
    plain = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), text, F.lit('"'))
    shown = F.when(F.contains(value, F.lit("'")) & ~F.contains(value, F.lit('"')), double).otherwise(plain)
    return F.coalesce(shown, F.lit("None"))


def validate(rows: DataFrame, index: str = "index") -> DataFrame:
    """One diagnostic per row whose labels are not both allowed.

    ``index, reasons, primary, secondary, text_preview``; *index* names the
    column that tells rows apart (a dense index or an id).
    """

    def reason(name: str, allow: Sequence[str]) -> Column:
        wrong = F.concat(F.lit(f"{name} invalid: "), _quoted(F.col(name)))
        return F.when(~is_label(F.col(name), allow), wrong)

    reasons = F.array_compact(F.array(reason("primary", PRIMARY_LABELS), reason("secondary", SECONDARY_LABELS)))
    return rows.filter(~valid_labels()).select(
        F.col(index).alias("index"),
        reasons.alias("reasons"),
        "primary",
        "secondary",
        preview(F.col("text")).alias("text_preview"),
    )


def validation_report(diagnostics: DataFrame) -> DataFrame:
    """Number of diagnostics per reason."""
    return diagnostics.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def fallback_text(rows: DataFrame) -> Column:
    """First non-empty of ``text``, ``content`` and ``review``, else empty."""
    names = [c for c in ("text", "content", "review") if c in rows.columns]
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in names], F.lit(""))


@dataclass(frozen=True)
class Repaired:
    """The repaired rows and what each round found."""

    rows: DataFrame
    rounds: DataFrame


def repair(
    rows: DataFrame,
    labeler: Labeler | str,
    params: LabelingParams = LabelingParams(),
    rules: LabelRules = LabelRules(),
    inputs: Sequence[str] = ("text",),
    sanitise: bool = True,
    samples: int = 10,
    parallelism: int | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> Repaired:
    """Relabel invalid rows until none is left or ``max_rounds`` is reached.

    Only the invalid rows are read whole, each round's from a stored table;
    valid rows are passed on untouched.  A row without any text is set to the
    fallback labels and not sent to the labeler.  *rows* is read more than once
    and should be a stored table.  *parallelism* is the number of concurrent
    calls of a user's labeler.
    """
    settled, rounds = _rounds(rows.filter(~valid_labels()), labeler, params, rules, inputs, sanitise, samples, parallelism, sleep)
    out = rows.filter(valid_labels())
    for part in settled:
        out = out.unionByName(part, allowMissingColumns=True)
    return Repaired(out, rounds)


def repair_delta(
    base: DataFrame,
    labeler: Labeler | str,
    params: LabelingParams = LabelingParams(),
    rules: LabelRules = LabelRules(),
    inputs: Sequence[str] = ("text",),
    sanitise: bool = True,
    samples: int = 10,
    parallelism: int | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> Repaired:
    """As ``repair``, of which only the rows that were invalid are returned, with their places in *base*.

    *base* is a stored parquet table; ``deltas.merged`` gives the repaired one.
    """
    settled, rounds = _rounds(placed(base).filter(~valid_labels()), labeler, params, rules, inputs, sanitise, samples, parallelism, sleep)
    out = placed(base).limit(0)
    for part in settled:
        out = out.unionByName(part, allowMissingColumns=True)
    return Repaired(out, rounds)


def _rounds(invalid, labeler, params, rules, inputs, sanitise, samples, parallelism, sleep) -> tuple[list[DataFrame], DataFrame]:
    """What *invalid* rows become, in parts, and what each round found."""
    log, spark = logging.getLogger("gleanery"), invalid.sparkSession
    settled: list[DataFrame] = []
    rounds: list[tuple[int, int, int, int]] = []
    for turn in range(1, params.max_rounds + 1):
        bad_primary = F.count_if(~is_label(F.col("primary"), PRIMARY_LABELS))
        bad_secondary = F.count_if(~is_label(F.col("secondary"), SECONDARY_LABELS))
        n, n_primary, n_secondary = invalid.agg(F.count(F.lit(1)), bad_primary, bad_secondary).first()
        rounds.append((turn, n, n_primary, n_secondary))
        if not n:
            break
        log.warning("validation round %d: %d invalid rows", turn, n)
        if turn == 1:
            invalid = written(invalid, "invalid", compact=True)
        if samples and log.isEnabledFor(logging.DEBUG):
            for sample in invalid.limit(samples).collect():
                log.debug("invalid row: %s", sample)
        if callable(labeler) and parallelism:
            invalid = invalid.repartition(parallelism)
        relabeled = _relabel(invalid, labeler, params, rules, inputs, sanitise, sleep)
        relabeled = written(relabeled, "relabeled")
        settled.append(relabeled.filter(valid_labels()))
        invalid = relabeled.filter(~valid_labels())
    else:
        log.warning("stopped after %d validation rounds; invalid labels may remain", params.max_rounds)
        settled.append(invalid)
    return settled, spark.createDataFrame(rounds, _ROUNDS)


def _relabel(invalid, labeler, params, rules, inputs, sanitise, sleep) -> DataFrame:
    invalid = invalid.withColumn("text", fallback_text(invalid))
    has_text = F.col("text") != ""
    out = with_labels(invalid, labeler, has_text, params, rules, inputs, sanitise, 0.0, sleep)
    return out.withColumns(
        {
            "primary": F.when(has_text, F.col("primary")).otherwise(PRIMARY_FALLBACK),
            "secondary": F.when(has_text, F.col("secondary")).otherwise(SECONDARY_FALLBACK),
        }
    )
