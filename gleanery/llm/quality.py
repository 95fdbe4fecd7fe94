"""Quality rules whose cutoffs are chosen at a controlled risk of false rejection.

Each rule compares a ratio (symbols per word, shouted letters per letter, …) with a
cutoff.  A fixed ladder of steps tightens all cutoffs together, from lenient to
strict.  Per stratum, labelled good documents are counted by the first step that would
reject them, and steps are tested in order: a step passes if the exact binomial
upper bound on its rate of false rejection is at most ``risk``.  Of the steps before
the first that fails, the most lenient applies that rejects as many labelled bad documents
as the strictest.  Testing in a fixed order needs no correction over
steps; over what is tested the error is divided by its number (Bonferroni).  So with
probability ``1 - error``, in no tested stratum more than ``risk`` of good documents go.

Strata with too few good labels to pass by themselves, whatever those show, are pooled
and tested once, as one; strata without labels take the pool's step.  For these the
risk holds over the pool and not in each.  Only numbers of good labels decide
what is pooled.  A pool that still has too few takes in the labels of the smallest
other stratum, and then its step goes no further than its own good labels bear out.  If
that is not to be had either, or the pool has no good label, it rejects nothing beyond
the base rules.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm.words import forget, slices, tidied
from gleanery.sources.scratch import written

WINDOW, SLICE = 8, 4_000_000
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
RISK, ERROR = 0.01, 0.05

SYMBOLS, SPACES = "#*$%&|<>", " \t\n\v\f\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts", "n_capitals")
#: Per rule: numerator, denominator, most lenient and strictest cutoff; any ratio above its cutoff rejects.
RULES = (
    ("n_symbols", "n_words", 1.0, 0.1),
    ("n_shouts", "n_words", 1.0, 0.1),
    ("n_capitals", "word_chars", 0.8, 0.3),
    ("n_dup_lines", "n_lines", 0.9, 0.5),
)
STEPS = 16

#: Random odd factors that make a window's words one 64-bit number.
_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, WINDOW + 1, np.uint64) * np.uint64(2) + np.uint64(1)


def repeated_words(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per document, the words that lie in windows found twice or more in it.

    *words* are the numbers of all documents' words in a row, *counts* the words of each.
    """
    n = len(words)
    doc = np.repeat(np.arange(len(counts)), counts)
    if n < WINDOW:
        return np.zeros(len(counts), np.int64)
    inside = np.flatnonzero(doc[: n - WINDOW + 1] == doc[WINDOW - 1 :])
    code = doc[inside].astype(np.uint64) * _FACTORS[WINDOW]
    for i in range(WINDOW):
        code += words[inside + i].astype(np.uint64) * _FACTORS[i]
    order = np.argsort(code)
    same = code[order][1:] == code[order][:-1]
    found = np.zeros(len(code), bool)
    found[order[1:][same]] = found[order[:-1][same]] = True
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, inside[found], 1)
    np.add.at(edges, inside[found] + WINDOW, -1)
    return np.bincount(doc[np.cumsum(edges[:n]) > 0], minlength=len(counts))


def _capitals(text: str) -> int:
    """Code points that lower-casing changes."""
    if text.isascii():
        raw = np.frombuffer(text.encode(), np.uint8)
        return int(((raw >= 65) & (raw <= 90)).sum())
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    known, at = np.unique(points, return_inverse=True)
    return int(np.array([c != c.lower() for c in map(chr, known.tolist())], bool)[at].sum())


def _counts(texts: list[str]) -> dict[str, np.ndarray]:
    words = [t.encode().split() for t in texts]  # ASCII white space only
    counts = np.array([len(w) for w in words], np.int64)
    flat = [x for w in words for x in w]
    numbers = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy() if flat else np.empty(0, np.int32)
    lines = [[x for x in t.split("\n") if x.strip(SPACES)] for t in texts]
    long = lambda values: np.array(values, np.int64)
    return {
        "n_words": counts,
        "word_chars": long([len(t) - sum(map(t.count, SPACES)) for t in texts]),
        "n_symbols": long([sum(map(t.count, SYMBOLS)) for t in texts]),
        "n_dup_lines": long([len(x) - len(set(x)) for x in lines]),
        "n_repeat_words": repeated_words(numbers, counts),
        "n_lines": long([len(x) for x in lines]),
        "n_shouts": long([t.count("!") for t in texts]),
        "n_capitals": long([_capitals(t) for t in texts]),
    }


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """*docs* with the counts of *text*, as longs, and base_failed; NULL texts have no words.

    Columns named like a count are replaced.
    """
    rows = docs.drop(*COUNTS, "base_failed")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            for part in slices([len(t) for t in texts], SLICE):
                found = _counts(texts[part])
                kept = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([*kept.columns, *map(pa.array, found.values())], names=[*batch.schema.names, *COUNTS])

    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in COUNTS)])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.mapInArrow(tidied(run), schema).withColumn("base_failed", failed)


def first_step() -> Column:
    """The first step of the ladder that rejects a row, ``STEPS`` + 1 if none does.

    Step i has the cutoffs lenient * (strict / lenient) ** ((i - 1) / (STEPS - 1)).
    """
    firsts = []
    for above, below, lenient, strict in RULES:
        ratio = F.col(above) / F.greatest(F.col(below), F.lit(1))
        cutoffs = [lenient * (strict / lenient) ** (i / (STEPS - 1)) for i in range(STEPS)]
        # Cutoffs fall, so the steps that let a ratio pass come first.
        firsts.append(F.lit(1) + sum((ratio <= c).cast("int") for c in cutoffs))
    return F.least(*firsts)


def passes(rejected: int, n: int, risk: float, error: float) -> bool:
    """Whether *rejected* of *n* shows, at *error*, a rate of at most *risk*: the exact binomial test."""
    if n == 0 or rejected > risk * n:
        return False
    # P(at most `rejected` of n at rate `risk`), summed from the largest term down.
    i = np.arange(1, rejected + 1, dtype=float)
    logs = n * np.log1p(-risk) + np.append(0.0, np.cumsum(np.log((n - i + 1) / i) + np.log(risk / (1 - risk))))
    return float(np.exp(logs).sum()) <= error


def least_labels(tests: int, risk: float, error: float) -> int:
    """The good labels that one of *tests* needs to pass if none is rejected."""
    n = max(1, math.floor(math.log(error / tests) / math.log1p(-risk)) - 1)
    while not passes(0, n, risk, error / tests):
        n += 1
    return n


def tests_and_bar(goods: list[int], risk: float, error: float) -> tuple[int, int]:
    """The fewest tests that do, and the good labels from which on a stratum is tested by itself; the rest is one test."""
    for tests in range(1, len(goods) + 1):
        bar = least_labels(tests, risk, error)
        alone = sum(n >= bar for n in goods)
        if alone + (alone < len(goods)) <= tests:
            return tests, bar
    return 1, least_labels(1, risk, error)


def choose_steps(labelled: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Rows (stratum, step), step 0 rejecting nothing; *labelled* has stratum, first_step and good.

    Stratum NULL, if there, is the pool: its step is for all strata not named.
    """
    counted = written(labelled.groupBy("stratum", "first_step", "good").count(), "holdout", compact=True)
    goods = counted.groupBy("stratum").agg(F.sum(F.when(F.col("good"), F.col("count")).otherwise(0)).alias("n"))
    known = sorted((r.n, r.stratum) for r in goods.filter("n > 0").collect())  # one per stratum
    tests, bar = tests_and_bar([n for n, _ in known], risk, error)
    alone = [s for n, s in known if n >= bar]
    lender = alone[:1] if 0 < sum(n for n, _ in known if n < bar) < bar else []
    own = counted.join(goods, "stratum").withColumns({"part": F.when(F.col("n") >= bar, F.col("stratum")), "lent": F.lit(False)})
    lent = own.filter(F.col("stratum").isin(lender)).withColumns({"part": F.lit(None).cast("string"), "lent": F.lit(True)})
    parts = own.unionByName(lent).groupBy("part", "first_step", "good", "lent").agg(F.sum("count").alias("count"))

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        def up_to(of: pd.Series) -> np.ndarray:
            return np.cumsum(np.bincount(rows["first_step"][of], rows["count"][of], STEPS + 2)).astype(int)

        good, bad, without = up_to(rows["good"]), up_to(~rows["good"]), up_to(rows["good"] & ~rows["lent"])
        step = 0
        while step < STEPS and without[step + 1] <= risk * without[-1] and passes(int(good[step + 1]), int(good[-1]), risk, error / tests):
            step += 1
        step = int(np.searchsorted(bad, bad[step]))
        return pd.DataFrame({"stratum": rows["part"].iloc[:1], "step": step})

    # At most 2 * (STEPS + 1) rows per stratum, twice as many in the pool.
    return parts.groupBy("part").applyInPandas(choose, "stratum string, step int")


def _judged(rows: DataFrame, labels: DataFrame, key: str, risk: float, error: float) -> DataFrame:
    marks = labels.filter(F.col(key).isNotNull() & F.col("quality").isNotNull()).groupBy(key).agg((F.min("quality") == 1).alias("_good"))
    labelled = rows.filter("not base_failed").join(marks, key).select(F.col("_stratum").alias("stratum"), F.col("_first").alias("first_step"), F.col("_good").alias("good"))
    steps = written(choose_steps(labelled, risk, error).toDF("_stratum", "_step"), "steps", compact=True)
    pool = steps.filter("_stratum IS NULL").first()
    kept = ~F.col("base_failed") & (F.col("_first") > F.coalesce("_step", F.lit(pool["_step"] if pool else 0)))
    return rows.join(steps, "_stratum", "left").withColumn("kept", kept).drop("_stratum", "_first", "_step")


def _prepared(docs: DataFrame, text: str, stratum: str) -> DataFrame:
    marked = docs.withColumn("_stratum", F.coalesce(F.col(stratum).cast("string"), F.lit("")))
    return measured(marked, text).withColumn("_first", first_step())


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Rows of *docs* by *key*, with their counts, base_failed and kept; kept is never NULL.

    *labels* has *key* and quality (1: good); a key labelled more than once is
    good if all its labels are.  Labels without quality or key are not used.  A NULL
    *stratum* is a stratum of its own, the one of the empty string.  Good documents that
    fail the base rules are not in the holdout.  Repeated rows are judged each; an empty
    table, or one without labels, is judged by the base rules alone.
    """
    rows = _prepared(docs.select(key, text, F.col(stratum).alias("_s")), text, "_s").drop(text, "_s")
    return _judged(written(rows, "measured"), labels, key, risk, error)


def keep(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The rows of *docs* that ``judge`` keeps, with their columns as they were, whatever their names.

    Texts are measured once and never shuffled: the chosen steps, a row per stratum, are joined to them.
    """
    # Columns of docs that the counts would replace stand aside under other names.
    aside = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c not in (key, text, stratum)}
    renamed = docs.select(*(F.col(c).alias(aside.get(c, c)) for c in docs.columns))
    rows = written(_prepared(renamed, text, stratum), "measured")
    judged = _judged(rows, labels, key, risk, error).filter("kept")
    return judged.select(*(F.col(aside.get(c, c)).alias(c) for c in docs.columns))
