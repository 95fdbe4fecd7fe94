"""Every operator as a query over the stored tables, with its SQL statement.

``QUERIES`` maps a name to a function of the session and the table folder;
``SQL`` maps the same name to the equivalent statement where one exists.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions import text as tx
from gleanery.functions.dates import wall_clock
from gleanery.functions.labels import canonical_primary, canonical_secondary, choose_payload
from gleanery.operators.align import (
    align,
    merge_reviews,
    normalise_records,
    project_records,
    union_reviews,
)
from gleanery.operators.dictionary import resolve, with_canonical
from gleanery.operators.feed import flatten_feed, last_pages, page_stats
from gleanery.operators.labeling import (
    apply_responses,
    batch_payloads,
    is_pending,
    label,
    split_pending,
)
from gleanery.operators.ledger import Ledger
from gleanery.operators.ordering import first_n, top_recent, with_dense_index
from gleanery.operators.prepare import prepare
from gleanery.operators.split import split_counts, split_quotas, stratified_split
from gleanery.operators.validation import repair, repair_delta, validate, validation_report
from gleanery.params import CleaningParams, FeedParams, LabelingParams, LabelRules
from gleanery.plans import inputs
from gleanery.plans.flow import FlowParams, run_all
from gleanery.schemas import (
    PRIMARY_LABELS,
    PRIMARY_SPELLINGS,
    SECONDARY_LABELS,
    SECONDARY_SPELLINGS,
    UNIFIED,
    UNLABELED,
)
from gleanery.sources.artefacts import Artefacts, read_artefact, write_csv
from gleanery.sources.deltas import merged
from gleanery.sources.ranges import scan_csv_split, scan_json_split
from gleanery.sources.readers import json_key_profile, rows_per_file, scan_csv, scan_json, scan_pages, scan_records, split_bad
from gleanery.sources.scratch import scratch_path, written
from gleanery.sources.shapes import shape_profile

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own or another name, together with its SQL."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key], SQL[key] = function, sql
        return function

    return register


_UNIFIED = 'platform, "reviewId", "userName", rating, date, content'

# --- SQL fragments ---------------------------------------------------------------

_WS = f"[{tx.class_body(tx.WHITESPACE)}]"
_EMOJI = f"[{tx.class_body(tx.EMOJI)}]"
_CJK = f"[{tx.class_body(tx.CJK_IDEOGRAPHS)}]"
_WIDE = tx.FULL_WIDTH.replace("'", "''")
_NARROW = tx.HALF_WIDTH.replace("'", "''")


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_WS}+', ''), '{_WS}+$', '')"


def _fold(x: str) -> str:
    return f"translate({x}, '{_WIDE}', '{_NARROW}')"


def _compat(x: str) -> str:
    """Compatibility forms that occur in the mixed texts."""
    return f"translate({_fold(x)}, 'ｱ①', 'ア1')"


def _clean(x: str) -> str:
    no_emoji = f"regexp_replace({_compat(x)}, '{_EMOJI}', '', 'g')"
    return _strip(f"regexp_replace({no_emoji}, '{_WS}+', ' ', 'g')")


def _cjk_count(x: str) -> str:
    return f"(length({x}) - length(regexp_replace({x}, '{_CJK}', '', 'g')))"


def _canonical(x: str, labels, spellings, fallback: str) -> str:
    form = f"replace(upper({_strip(x)}), ' ', '_')"
    cases = " ".join(
        f"WHEN {form} IN ({', '.join(repr(v) for v in (label, *spellings.get(label, ())))}) THEN '{label}'"
        for label in labels
    )
    return f"CASE {cases} ELSE '{fallback}' END"


def _primary(x: str) -> str:
    return _canonical(x, PRIMARY_LABELS, PRIMARY_SPELLINGS, "INVALID")


def _secondary(x: str) -> str:
    return _canonical(x, SECONDARY_LABELS, SECONDARY_SPELLINGS, "GENERAL")


def _in(labels) -> str:
    return "(" + ", ".join(f"'{v}'" for v in labels) + ")"


def _rule_sql(x: str, rules: LabelRules) -> tuple[str, str]:
    nature = " ".join(f"WHEN regexp_matches(lower({x}), '{p}') THEN '{v}'" for v, p in rules.nature)
    hits = " + ".join(f"CAST(regexp_matches(lower({x}), '{p}') AS INTEGER)" for _, p in rules.area)
    area = " ".join(f"WHEN regexp_matches(lower({x}), '{p}') THEN '{v}'" for v, p in rules.area)
    return f"CASE {nature} ELSE 'INVALID' END", f"CASE WHEN {hits} <> 1 THEN 'GENERAL' {area} END"


_FIRST = f"""SELECT {_UNIFIED} FROM (
  SELECT *, row_number() OVER (PARTITION BY "reviewId" ORDER BY platform = 'app_store', doc_id) AS rn FROM %s)
WHERE rn = 1"""


def _quotas(rows: str) -> str:
    """Quotas of the classes of *rows* (a table with a column ``primary``)."""
    return f"""classes AS (SELECT "primary", count(*) AS n FROM {rows} GROUP BY ALL),
totals AS (SELECT CAST(sum(n) AS BIGINT) AS total,
                  CAST(ceil(CAST(0.2 AS DOUBLE) * sum(n)) AS BIGINT) AS test FROM classes),
shares AS (SELECT "primary", n, CAST(n AS DOUBLE) / CAST(total AS DOUBLE) * CAST(total - test AS DOUBLE) AS share, total, test
           FROM classes, totals),
ranked AS (SELECT *, row_number() OVER (ORDER BY share - floor(share) DESC, "primary") AS place,
                  total - test - sum(floor(share)) OVER () AS spare FROM shares),
quotas AS (SELECT "primary", n, CAST(floor(share) + CASE WHEN place <= spare THEN 1 ELSE 0 END AS BIGINT) AS n_train
           FROM ranked)"""


# --- alignment and merge ---------------------------------------------------------


@query(
    f"""WITH {inputs.REVIEWS}
SELECT 'google_play' AS platform, "reviewId", "userName", rating,
       CASE WHEN doc_id % 13 = 0 OR doc_id % 17 = 0 THEN '' ELSE date END AS date, content
FROM reviews"""
)
def align_google(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(normalise_records(inputs.record_dump(inputs.reviews(spark, sf_dir))), "google_play")


@query(f"""WITH {inputs.REVIEWS} SELECT * EXCLUDE (doc_id) REPLACE ('app_store' AS platform) FROM reviews""")
def align_app_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(inputs.feed_rows(inputs.reviews(spark, sf_dir)), "app_store")


@query(f"""WITH {inputs.REVIEWS} SELECT {_UNIFIED} FROM reviews""")
def merge_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    google, app_store = inputs.by_platform(inputs.reviews(spark, sf_dir))
    return union_reviews(google, inputs.feed_rows(app_store))


@query(f"""WITH {inputs.REVIEWS} {_FIRST % 'reviews'}""")
def merge_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    google, app_store = inputs.by_platform(inputs.reviews(spark, sf_dir))
    return merge_reviews(google, inputs.feed_rows(app_store), order_by=["doc_id"])


@query(f"""WITH {inputs.REVIEWS}, one AS (SELECT * REPLACE ('app_store' AS platform) FROM reviews) {_FIRST % 'one'}""")
def merge_empty_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_reviews(None, inputs.feed_rows(inputs.reviews(spark, sf_dir)), order_by=["doc_id"])


@query(
    """SELECT md5(text) AS "reviewId", CAST(NULL AS VARCHAR) AS "userName", CAST(doc_id % 5 + 1 AS INTEGER) AS score,
       CAST(NULL AS VARCHAR) AS at, text AS content, CAST(NULL AS VARCHAR) AS "replyContent",
       CAST(NULL AS INTEGER) AS "thumbsUpCount"
FROM documents"""
)
def legacy_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.reviews(spark, sf_dir)
    return project_records(rows.select("reviewId", F.col("rating").alias("score"), "content", "platform"))


@query(
    """SELECT event_id, CASE event_id % 5 WHEN 4 THEN NULL WHEN 3 THEN strftime(ts, '%Y-%m-%d 00:00:00')
       ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS clock FROM events"""
)
def date_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    way = F.col("event_id") % 5
    day, time = (F.substring(F.col("ts").cast("timestamp_ntz").cast("string"), at, n) for at, n in ((1, 10), (12, 8)))
    written = (
        F.when(way == 0, F.concat(day, F.lit("T"), time, F.lit("Z")))
        .when(way == 1, F.concat(day, F.lit("T"), time, F.lit(".125+08:00")))
        .when(way == 2, F.concat(day, F.lit(" "), time))
        .when(way == 3, day)
        .otherwise(F.concat(day, F.lit("T"), time, F.lit(" o'clock")))
    )
    return inputs.table(spark, sf_dir, "events").select("event_id", wall_clock(written).alias("clock"))


# --- text --------------------------------------------------------------------------


def _texts(spark: SparkSession, sf_dir: str, **columns) -> DataFrame:
    return inputs.reviews_mixed(spark, sf_dir).select("doc_id", *[c.alias(n) for n, c in columns.items()])


@query(f"""WITH {inputs.REVIEWS_MIXED} SELECT doc_id, {_fold('content')} AS text FROM reviews_mixed""")
def text_fullwidth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, text=tx.fold_width(F.col("content")))


@query(f"""WITH {inputs.REVIEWS_MIXED} SELECT doc_id, {_compat('content')} AS text FROM reviews_mixed""")
def text_nfkc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, text=tx.compose_compat(F.col("content")))


@query(f"""WITH {inputs.REVIEWS_MIXED} SELECT doc_id, regexp_replace(content, '{_EMOJI}', '', 'g') AS text FROM reviews_mixed""")
def text_strip_emoji(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, text=tx.strip_symbols(F.col("content")))


@query(
    f"""WITH {inputs.REVIEWS_MIXED} SELECT doc_id, {_strip('content')} AS stripped,
       {_strip(f"regexp_replace(content, '{_WS}+', ' ', 'g')")} AS text FROM reviews_mixed"""
)
def text_collapse_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, stripped=tx.strip_space(F.col("content")), text=tx.squeeze_space(F.col("content")))


@query(
    f"""WITH {inputs.REVIEWS_MIXED}, counted AS (
  SELECT doc_id, CAST(length(content) AS INTEGER) AS n_chars, CAST({_cjk_count('content')} AS INTEGER) AS n_script
  FROM reviews_mixed WHERE {_strip('content')} <> '')
SELECT * FROM counted WHERE n_chars >= 400 AND n_script >= 60"""
)
def text_length_cjk_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.col("content")
    rows = inputs.reviews_mixed(spark, sf_dir).filter(tx.strip_space(content) != "")
    rows = rows.filter((F.length(content) >= 400) & tx.has_script(content, 60))
    return rows.select("doc_id", F.length(content).alias("n_chars"), tx.script_count(content).alias("n_script"))


def _prepared(rows: str) -> str:
    return f"""prepared AS (
  SELECT "reviewId", platform, {_clean('content')} AS text FROM {rows} WHERE {_strip('content')} <> ''
), unlabeled AS (
  SELECT *, '' AS "primary", '' AS secondary FROM prepared WHERE length(text) >= 5 AND {_cjk_count('text')} >= 2)"""


@query(f"""WITH {inputs.REVIEWS_MIXED}, {_prepared('reviews_mixed')} SELECT * FROM unlabeled""")
def prepare_unlabeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(inputs.reviews_mixed(spark, sf_dir), CleaningParams(min_length=5))


# --- labels ------------------------------------------------------------------------


@query(
    f"""WITH {inputs.LABELS_DIRTY}
SELECT doc_id, {_primary('primary_raw')} AS "primary", {_secondary('secondary_raw')} AS secondary FROM labels_dirty"""
)
def label_canonicalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.labels_dirty(spark, sf_dir).select(
        "doc_id",
        canonical_primary(F.col("primary_raw")).alias("primary"),
        canonical_secondary(F.col("secondary_raw")).alias("secondary"),
    )


@query(
    f"""WITH {inputs.LABELS_DIRTY}
SELECT doc_id, {_primary('primary_raw')} AS "primary", {_secondary('secondary_raw')} AS secondary FROM labels_dirty"""
)
def label_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings from tables: each means the spelling before it in its label's list, the first the label."""
    rows = inputs.labels_dirty(spark, sf_dir).select("doc_id", F.col("primary_raw").alias("primary"), F.col("secondary_raw").alias("secondary"))
    found = {}
    for column, spellings in (("primary", PRIMARY_SPELLINGS), ("secondary", SECONDARY_SPELLINGS)):
        chains = [(forms[i], forms[i - 1] if i else label) for label, forms in spellings.items() for i in range(len(forms))]
        found[column] = resolve(spark.createDataFrame(chains, "alias string, target string"))
    allow = {"primary": PRIMARY_LABELS, "secondary": SECONDARY_LABELS}
    return with_canonical(rows, found, allow, {"primary": "INVALID", "secondary": "GENERAL"})


@query(
    f"""WITH {inputs.NUMBERED}, answered AS (
  SELECT *, NOT (batch_id % 7 = 3 AND pos >= n - 2) AS reached FROM numbered)
SELECT doc_id, CASE WHEN reached THEN {_primary('primary_raw')} ELSE 'INVALID' END AS "primary",
       CASE WHEN reached THEN {_secondary('secondary_raw')} ELSE 'GENERAL' END AS secondary FROM answered"""
)
def label_response_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.numbered_labels(spark, sf_dir).select("doc_id", "batch_id", "pos")
    responses = inputs.model_responses(spark, sf_dir)
    again = responses.filter("batch_id % 4 = 1").unionByName(responses.filter("batch_id % 4 = 2").withColumn("body", F.lit("oops")))
    found = apply_responses(rows, responses.unionByName(again))
    return found.select("doc_id", "primary", "secondary")


@query(
    """SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN md5('[' || text || ']') WHEN turn % 3 = 1 THEN md5(text)
       END AS payload FROM (SELECT conv_id, turn, trim(replace(replace(text, chr(10), ' '), ';', '')) AS text FROM conversations)
WHERE text <> ''"""
)
def label_payload_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers whose text is filled, blank with a filled part, or blank throughout."""
    rows = inputs.table(spark, sf_dir, "conversations")
    plain = F.trim(F.replace(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), F.lit(";"), F.lit("")))
    rows = rows.select("conv_id", "turn", plain.alias("text")).filter("text <> ''")
    way, body = F.col("turn") % 3, F.col("text")
    answer = F.when(way == 0, F.concat(F.lit("```\n["), body, F.lit("]\n```"))).when(way == 1, "```\n```").otherwise(" ")
    parts = F.array(F.lit("``` ```"), F.when(way == 1, F.concat(F.lit(" "), body, F.lit(" ;"))), F.lit(None).cast("string"))
    return rows.select("conv_id", "turn", F.md5(choose_payload(answer, parts)).alias("payload"))


@query(
    """WITH numbered AS (SELECT text, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)
SELECT i // 100 AS batch_id, count(*) AS n,
       md5(CAST(to_json({'reviews': list({'text': text} ORDER BY i)}) AS VARCHAR)) AS body
FROM numbered GROUP BY ALL"""
)
def label_batch_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_dense_index(inputs.table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    return batch_payloads(rows, 100).withColumn("body", F.md5("body"))


_RULES = _rule_sql("text", inputs.RULES)


@query(f"""SELECT doc_id, {_RULES[0]} AS "primary", {_RULES[1]} AS secondary FROM documents""")
def label_rule_based(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "documents").select("doc_id", "text")
    return label(rows, "rules", rules=inputs.RULES).select("doc_id", "primary", "secondary")


@query(
    f"""WITH {inputs.LABELED_TEXTS}, marked AS (
  SELECT *, coalesce("primary", '') = '' AS pending FROM labeled_texts)
SELECT pending, doc_id, length(text) AS n_chars FROM marked"""
)
def label_pending_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending, done = split_pending(inputs.labeled_texts(spark, sf_dir))
    rows = done.unionByName(pending, allowMissingColumns=True)
    return rows.select(is_pending(F.col("primary")).alias("pending"), "doc_id", F.length("text").cast("long").alias("n_chars"))


def length_labeler(batch: pd.DataFrame) -> pd.DataFrame:
    """A labeler that goes by text length, in spellings that need canonicalising."""
    n = batch["text"].str.len()
    primary = n.map(lambda k: ("crash", "praise", "ui", "no idea")[k % 4])
    return pd.DataFrame({"primary": primary, "secondary": n.map(lambda k: ("pay", "login", None)[k % 3])})


_BY_LENGTH = (
    "CASE length(text) % 4 WHEN 0 THEN 'BUG' WHEN 1 THEN 'POSITIVE' WHEN 2 THEN 'UI/UX' ELSE 'INVALID' END",
    "CASE length(text) % 3 WHEN 0 THEN 'TRANSACTION' WHEN 1 THEN 'ACCOUNT' ELSE 'GENERAL' END",
)


@query(
    f"""WITH {inputs.LABELED_TEXTS}
SELECT doc_id, CASE WHEN coalesce("primary", '') = '' THEN {_BY_LENGTH[0]} ELSE "primary" END AS "primary",
       CASE WHEN coalesce("primary", '') = '' THEN {_BY_LENGTH[1]} ELSE secondary END AS secondary FROM labeled_texts"""
)
def label_batch_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.labeled_texts(spark, sf_dir)
    return label(rows, length_labeler, LabelingParams(batch_pause=0)).select("doc_id", "primary", "secondary")


@query(
    f"""WITH {inputs.LABELED_TEXTS}
SELECT doc_id, CASE WHEN coalesce("primary", '') = '' THEN {_BY_LENGTH[0]} ELSE "primary" END AS "primary",
       CASE WHEN coalesce("primary", '') = '' THEN {_BY_LENGTH[1]} ELSE secondary END AS secondary FROM labeled_texts"""
)
def label_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled twice with one ledger; the second run's labeler fails whenever it is called."""
    rows = written(inputs.labeled_texts(spark, sf_dir), "texts")
    ledger, params = Ledger(scratch_path(spark, "ledger")), LabelingParams(batch_pause=0, max_retries=0)
    label(rows, length_labeler, params, ledger=ledger)
    return label(rows, never_labeler, params, ledger=ledger).select("doc_id", "primary", "secondary")


def never_labeler(batch: pd.DataFrame) -> pd.DataFrame:
    raise RuntimeError("asked again")


def failing_labeler(batch: pd.DataFrame) -> pd.DataFrame:
    """Gives up on texts of some lengths."""
    if (batch["text"].str.len() % 5 == 0).any():
        raise RuntimeError("no answer")
    return length_labeler(batch)


@query(
    f"""WITH {inputs.LABELED_TEXTS}, marked AS (SELECT *, coalesce("primary", '') = '' AS pending, length(text) % 5 = 0 AS fails FROM labeled_texts)
SELECT doc_id, CASE WHEN NOT pending THEN "primary" WHEN fails THEN 'INVALID' ELSE {_BY_LENGTH[0]} END AS "primary",
       CASE WHEN NOT pending THEN secondary WHEN fails THEN 'GENERAL' ELSE {_BY_LENGTH[1]} END AS secondary FROM marked"""
)
def label_failing_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of one row; those that fail, retried or not, get the fallback."""
    params = LabelingParams(batch_size=1, max_retries=1, retry_delay=0, batch_pause=0)
    return label(inputs.labeled_texts(spark, sf_dir), failing_labeler, params).select("doc_id", "primary", "secondary")


def hesitant_labeler(batch: pd.DataFrame) -> pd.DataFrame:
    """Needs to be asked twice about texts of odd length."""
    first = (batch["text"].str.len() % 2 == 1) & (batch["primary"] != "again")
    return pd.DataFrame({"primary": first.map({True: "again", False: "BUG"}), "secondary": "GENERAL"})


_VALID = f'coalesce("primary" IN {_in(PRIMARY_LABELS)}, false) AND coalesce(secondary IN {_in(SECONDARY_LABELS)}, false)'
_REASONS = f"""concat_ws('; ',
  CASE WHEN NOT coalesce("primary" IN {_in(PRIMARY_LABELS)}, false)
       THEN 'primary invalid: ' || coalesce('''' || "primary" || '''', 'None') END,
  CASE WHEN NOT coalesce(secondary IN {_in(SECONDARY_LABELS)}, false)
       THEN 'secondary invalid: ' || coalesce('''' || secondary || '''', 'None') END)"""


@query(
    f"""WITH {inputs.LABELED_TEXTS}
SELECT doc_id AS index, {_REASONS} AS reasons, "primary", secondary,
       CASE WHEN length(text) > 80 THEN substr(text, 1, 80) || '...' ELSE text END AS text_preview
FROM labeled_texts WHERE NOT ({_VALID})"""
)
def validate_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = validate(inputs.labeled_texts(spark, sf_dir), "doc_id")
    return found.withColumn("reasons", F.array_join("reasons", "; "))


@query(
    f"""WITH {inputs.LABELED_TEXTS}, reasons AS (
  SELECT unnest(string_split({_REASONS}, '; ')) AS reason FROM labeled_texts WHERE NOT ({_VALID}))
SELECT reason, count(*) AS n FROM reasons GROUP BY ALL"""
)
def validate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation_report(validate(inputs.labeled_texts(spark, sf_dir), "doc_id"))


@query(
    f"""WITH {inputs.LABELED_TEXTS}, texts AS (
  SELECT * REPLACE (CASE WHEN doc_id % 9 <> 0 OR {_VALID} OR doc_id % 2 = 0 THEN text ELSE '' END AS text), {_VALID} AS ok
  FROM labeled_texts)
SELECT doc_id,
       CASE WHEN ok THEN "primary" WHEN text = '' THEN 'INVALID' ELSE {_BY_LENGTH[0]} END AS "primary",
       CASE WHEN ok THEN secondary WHEN text = '' THEN 'GENERAL' ELSE {_BY_LENGTH[1]} END AS secondary
FROM texts"""
)
def repair_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ninth id has no text; the even ones of these have it as content."""
    d = F.col("doc_id")
    rows = inputs.labeled_texts(spark, sf_dir).withColumns(
        {
            "content": F.when(d % 2 == 0, F.col("text")),
            "text": F.when(d % 9 != 0, F.col("text")).otherwise(""),
        }
    )
    done = repair(rows, length_labeler, LabelingParams(batch_pause=0))
    return done.rows.select("doc_id", "primary", "secondary")


# --- split -------------------------------------------------------------------------

_STRATA = f"""{inputs.LABELS_DIRTY}, strata AS (SELECT doc_id, primary_label AS "primary" FROM labels_dirty)"""
_ASSIGNED = f"""{_quotas('%(rows)s')},
assigned AS (SELECT r.*, CASE WHEN row_number() OVER (PARTITION BY r."primary" ORDER BY md5('42:' || CAST(%(id)s AS VARCHAR)), %(id)s)
                    <= n - n_train THEN 'test' ELSE 'train' END AS split
             FROM %(rows)s r JOIN quotas q ON r."primary" = q."primary")"""
_SPLIT = f"WITH {_STRATA}, {_ASSIGNED % {'rows': 'strata', 'id': 'doc_id'}}"


@query(
    f"""WITH {inputs.LABELED_TEXTS}, bad AS (SELECT *, NOT coalesce("primary" IN {_in(PRIMARY_LABELS)}, false) AS p,
  NOT coalesce(secondary IN {_in(SECONDARY_LABELS)}, false) AS s FROM labeled_texts WHERE NOT ({_VALID}))
SELECT 1 AS round, count(*) AS n_invalid, count(*) FILTER (p) AS n_primary, count(*) FILTER (s) AS n_secondary FROM bad
UNION ALL SELECT 2, count(*), count(*), 0 FROM bad WHERE length(text) % 2 = 1 UNION ALL SELECT 3, 0, 0, 0"""
)
def repair_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each round finds with a labeler that needs two of them."""
    rows = written(inputs.labeled_texts(spark, sf_dir), "labeled")
    params = LabelingParams(batch_pause=0)
    return repair(rows, hesitant_labeler, params, inputs=("text", "primary"), sanitise=False).rounds


@query(
    f"""WITH {inputs.LABELED_TEXTS}
SELECT doc_id, CASE WHEN {_VALID} THEN "primary" ELSE {_BY_LENGTH[0]} END AS "primary",
       CASE WHEN {_VALID} THEN secondary ELSE {_BY_LENGTH[1]} END AS secondary, NOT ({_VALID}) AS rewritten
FROM labeled_texts"""
)
def repair_merge_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table and the delta of its repair, which alone is written; what the delta rewrote is told by its key."""
    base = written(inputs.labeled_texts(spark, sf_dir), "labeled")
    delta = written(repair_delta(base, length_labeler, LabelingParams(batch_pause=0)).rows, "delta")
    changed = delta.select("doc_id", F.lit(True).alias("rewritten"))
    rows = merged(base, delta).join(changed, "doc_id", "left")
    return rows.select("doc_id", "primary", "secondary", F.coalesce("rewritten", F.lit(False)).alias("rewritten"))


@query(f"""WITH {_STRATA}, {_quotas('strata')} SELECT "primary", n, n_train, n - n_train AS n_test FROM quotas""")
def split_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_quotas(inputs.strata(spark, sf_dir))


@query(f"""{_SPLIT} SELECT doc_id, "primary", split FROM assigned""")
def split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_split(inputs.strata(spark, sf_dir), "doc_id")


@query(f"""{_SPLIT} SELECT split, "primary", count(*) AS n FROM assigned GROUP BY ALL""", "split_counts")
def split_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_counts(stratified_split(inputs.strata(spark, sf_dir), "doc_id"))


# --- feed --------------------------------------------------------------------------

_FEED_COLUMNS = 'app_id, page, pos, "reviewId", "userName", rating, date, title, review, "isEdited"'
_FEED_NAMES = [c.strip('" ') for c in _FEED_COLUMNS.split(",")]


def _feed(spark: SparkSession, sf_dir: str, params: FeedParams) -> DataFrame:
    return flatten_feed(inputs.feed_pages(spark, sf_dir), params).select(*_FEED_NAMES)


@query(f"""WITH {inputs.FEED} SELECT {_FEED_COLUMNS} FROM usable""")
def feed_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(spark, sf_dir, FeedParams(review_count=None))


@query(
    f"""WITH {inputs.FEED} SELECT CAST(app AS VARCHAR) AS app_id, CASE WHEN app % 4 <> 0 THEN 'tw' END AS country,
       CAST(coalesce(max(raw_page) FILTER (raw_page < stop), 0) AS BIGINT) AS last_page
FROM numbered_pages GROUP BY ALL"""
)
def feed_stop_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_pages(page_stats(inputs.feed_pages(spark, sf_dir), count_reviews=False))


@query(f"""WITH {inputs.FEED} SELECT {_FEED_COLUMNS} FROM usable WHERE page <= 4""")
def feed_max_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(spark, sf_dir, FeedParams(review_count=None, max_pages=4))


@query(
    f"""WITH {inputs.FEED}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY app_id ORDER BY page, pos) AS rn FROM usable)
SELECT {_FEED_COLUMNS} FROM ranked WHERE rn <= 70"""
)
def feed_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some pages were landed again, whole or without a body."""
    pages = inputs.feed_pages(spark, sf_dir)
    again = pages.filter("page = 1").unionByName(pages.filter("page = 2").withColumn("body", F.lit(None).cast("string")))
    return flatten_feed(pages.unionByName(again), FeedParams(review_count=70)).select(*_FEED_NAMES)


@query(
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Unknown' ELSE source END AS "userName",
       CASE WHEN doc_id % 5 = 0 THEN '' ELSE lang END AS title,
       CASE WHEN doc_id % 7 = 0 THEN 0 ELSE CAST(doc_id % 5 + 1 AS INTEGER) END AS rating FROM documents"""
)
def feed_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries without author, title or rating."""
    pages = inputs.sparse_feed(spark, sf_dir)
    return flatten_feed(pages).select(F.col("reviewId").cast("long").alias("doc_id"), "userName", "title", "rating")


@query(
    f"""WITH {inputs.REVIEWS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY platform ORDER BY date DESC, "reviewId") AS rn FROM reviews)
SELECT platform, "reviewId", date FROM ranked WHERE rn <= 25"""
)
def topk_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.reviews(spark, sf_dir).select("platform", "reviewId", "date")
    return top_recent(rows, 25, "platform", [F.desc("date"), F.asc("reviewId")])


@query(
    """SELECT * EXCLUDE rn FROM (
  SELECT l_returnflag, l_extendedprice, l_orderkey, l_linenumber,
         row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn FROM lineitem)
WHERE rn <= 2500"""
)
def topk_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More rows per group than a task should sort."""
    rows = inputs.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice", "l_orderkey", "l_linenumber")
    return first_n(rows, 2500, "l_returnflag", [("l_extendedprice", True), ("l_orderkey", False), ("l_linenumber", False)])


@query(
    f"""WITH {inputs.FEED}, pages AS (
  SELECT CAST(app AS VARCHAR) AS app_id, raw_page AS page, app % 4 AS kind, count(*) AS n,
         count(*) FILTER (doc_id % 11 <> 0 AND doc_id % 13 <> 0) AS n_ok FROM numbered_pages GROUP BY ALL
), stats AS (SELECT *, (kind = 1 AND page = 3) OR (kind = 2 AND page = 4) AS broken FROM pages)
SELECT app_id, CAST(count(*) AS BIGINT) AS n_pages, CAST(sum(CAST(broken AS INTEGER)) AS BIGINT) AS n_bad,
       CAST(sum(CASE WHEN broken THEN 0 ELSE n_ok END) AS BIGINT) AS n_reviews FROM stats GROUP BY ALL"""
)
def landed_pages_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written out as JSON lines and scanned from where they landed."""
    path = scratch_path(spark, "pages")
    inputs.feed_pages(spark, sf_dir).write.json(path)
    stats = page_stats(scan_pages(spark, path, "json"))
    return stats.groupBy("app_id").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.count_if(F.coalesce(F.col("n_entries"), F.lit(0)) <= 1).alias("n_bad"),
        F.coalesce(F.sum("n_reviews"), F.lit(0)).alias("n_reviews"),
    )


@query(
    """WITH keys AS (SELECT unnest(json_keys(props)) AS key FROM events)
SELECT key, 'BIGINT' AS type, count(*) AS n FROM keys GROUP BY ALL""",
    "json_key_profile",
)
def json_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_key_profile(inputs.table(spark, sf_dir, "events"), "props")


@query(
    f"""WITH {inputs.REVIEWS}, keys AS (
  SELECT unnest(['author', 'content', 'im:rating', 'title', 'id', 'updated']) AS key, doc_id FROM reviews
  UNION ALL SELECT DISTINCT 'id', doc_id // 50 FROM reviews)
SELECT key, CASE key WHEN 'author' THEN 'OBJECT<name: OBJECT<label: STRING>>' ELSE 'OBJECT<label: STRING>' END AS type,
       count(*) AS n FROM keys GROUP BY ALL"""
)
def json_entry_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shape of the entries of faultless feed pages."""
    pages = inputs.whole_feed(inputs.reviews(spark, sf_dir))
    return json_key_profile(pages, "body", "$.feed.entry")


@query(
    """WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 > 0 THEN l_linestatus END AS mode FROM lineitem
  WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
o AS (SELECT count(DISTINCT l_orderkey) FILTER (l_orderkey % 5 > 0) AS n_full FROM l),
t AS (SELECT count(*) AS n_all, count(*) FILTER (o_orderkey % 5 = 0) AS n_bad FROM orders),
i AS (SELECT count(*) AS n, count(mode) AS n_mode FROM l WHERE l_orderkey % 5 > 0)
SELECT '$' AS path, 'object' AS type, n_all - n_bad AS n, 0 AS n_null, n_bad AS n_missing FROM t
UNION ALL SELECT '$.key', 'integer', n_all - n_bad, 0, 0 FROM t
UNION ALL SELECT '$.lines', 'array', n_full, 0, n_all - n_bad - n_full FROM t, o WHERE n_full > 0
UNION ALL SELECT '$.lines[]', 'object', n, 0, 0 FROM i WHERE n > 0
UNION ALL SELECT '$.lines[].at', 'object', n, 0, 0 FROM i WHERE n > 0
UNION ALL SELECT '$.lines[].at.no', 'mixed', n, 0, 0 FROM i WHERE n > 0
UNION ALL SELECT '$.lines[].mode', 'string', n_mode, 0, n - n_mode FROM i WHERE n_mode > 0"""
)
def json_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines as nested bodies, some cut off; line numbers are numbers or texts."""
    number = F.col("l_linenumber")
    mode = F.when(number % 3 > 0, F.to_json(F.struct(F.col("l_linestatus").alias("mode"))))
    no = F.when(number % 2 == 0, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number.cast("string"))
    line = F.concat(F.lit('{"at":{"no":'), no, F.lit("}"), F.coalesce(F.concat(F.lit(","), F.substring(mode, F.lit(2), F.length(mode) - 2)), F.lit("")), F.lit("}"))
    lines = inputs.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.concat_ws(",", F.collect_list(line)).alias("lines"))
    orders = inputs.table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    listed = F.coalesce(F.concat(F.lit(',"lines":['), F.col("lines"), F.lit("]")), F.lit(""))
    end = F.when(F.col("o_orderkey") % 5 > 0, "}").otherwise("")
    return shape_profile(orders.select(F.concat(F.lit('{"key":'), F.col("o_orderkey"), listed, end).alias("body")), "body")


# --- files -------------------------------------------------------------------------


@query(f"""WITH {inputs.REVIEWS} SELECT {_UNIFIED} FROM reviews""")
def roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(inputs.reviews(spark, sf_dir).select(*UNIFIED.names), path)
    return scan_csv(spark, path, UNIFIED, ordered=False)


@query(
    f"""WITH {inputs.REVIEWS} SELECT * EXCLUDE (doc_id) REPLACE (translate(content, 'aq', '",') AS content) FROM reviews"""
)
def csv_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line ends, quotes and commas, each file cut at its records."""
    path = scratch_path(spark, "csv")
    rows = inputs.reviews(spark, sf_dir).withColumn("content", F.translate("content", "aq", '",'))
    write_csv(rows.select(*UNIFIED.names), path)
    return scan_csv_split(spark, path, UNIFIED, ordered=False)


@query(
    f"""WITH {inputs.LABELED_TEXTS}
SELECT CAST(doc_id AS VARCHAR) AS "reviewId", 'app_store' AS platform, text, "primary", secondary, 'b' AS run_id FROM labeled_texts"""
)
def roundtrip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs stored under one name; the second is read back."""
    rows = inputs.labeled_texts(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("reviewId"), F.lit("app_store").alias("platform"), "text", "primary", "secondary"
    )
    root = scratch_path(spark, "runs")
    Artefacts(spark, root, "a").store("labeled_json", rows.withColumn("primary", F.lit("")), "json")
    Artefacts(spark, root, "b").store("labeled_json", rows, "json")
    return read_artefact(spark, root, "labeled_json", UNLABELED, "b", "json")


@query(f"""WITH {inputs.REVIEWS} SELECT "reviewId", "userName", rating AS score, date AS at, content FROM reviews""")
def roundtrip_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record dump landed as JSON lines and scanned."""
    rows = inputs.reviews(spark, sf_dir).select(
        "reviewId", "userName", F.col("rating").alias("score"), F.col("date").alias("at"), "content"
    )
    path = scratch_path(spark, "records")
    rows.write.json(path)
    return split_bad(scan_records(spark, path, rows.schema, ordered=False))[0]


@query(
    """SELECT CASE WHEN doc_id % 11 <> 0 THEN doc_id END AS doc_id,
       CASE WHEN doc_id % 11 <> 0 AND doc_id % 7 <> 0 THEN CAST(doc_id % 5 AS INTEGER) END AS score,
       CASE WHEN doc_id % 11 = 0 THEN '{broken ' || doc_id END AS bad_record FROM documents"""
)
def records_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose scores are words or have a point, and lines that are no record; none is lost."""
    d = F.col("doc_id")
    score = F.when(d % 7 == 0, '"five"').when(d % 7 == 1, F.concat((d % 5).cast("string"), F.lit(".0"))).otherwise((d % 5).cast("string"))
    line = F.concat(F.lit('{"doc_id":'), d, F.lit(',"score":'), score, F.lit(',"content":'), F.to_json(F.array("text")), F.lit("}"))
    path = scratch_path(spark, "dirty")
    docs = inputs.table(spark, sf_dir, "documents")
    docs.select(F.when(d % 11 == 0, F.concat(F.lit("{broken "), d)).otherwise(line)).write.text(path)
    return scan_records(spark, path, T.StructType().add("doc_id", "long").add("score", "integer"), ordered=False)


@query("SELECT doc_id, quality, 'q' || toxic AS note FROM labels")
def json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one JSON array each, with a key outside the schema."""
    item = F.to_json(F.struct("doc_id", "quality", F.concat(F.lit("q"), F.col("toxic")).alias("note")))
    rows = inputs.table(spark, sf_dir, "labels").select(F.floor(F.col("doc_id") / 1000).alias("file"), item.alias("item"))
    arrays = rows.groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("item"), ","), F.lit("]")).alias("value"))
    path = scratch_path(spark, "arrays")
    arrays.write.partitionBy("file").text(path)
    schema = T.StructType().add("doc_id", "long").add("quality", "integer")
    return scan_json(spark, path, schema, array_file=True, extra=True).select("doc_id", "quality", "note")


@query("SELECT doc_id, quality, CASE WHEN doc_id % 3 > 0 THEN '}\"{' || toxic END AS note FROM labels")
def json_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same arrays with braces inside texts, each file cut at its records."""
    note = F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit('}"{'), F.col("toxic")))
    item = F.to_json(F.struct("doc_id", "quality", note.alias("note")))
    rows = inputs.table(spark, sf_dir, "labels").select(F.floor(F.col("doc_id") / 1000).alias("file"), item.alias("item"))
    arrays = rows.groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("item"), ",\n"), F.lit("]")).alias("value"))
    path = scratch_path(spark, "arrays")
    arrays.write.partitionBy("file").text(path)
    schema = T.StructType().add("doc_id", "long").add("quality", "integer").add("note", "string")
    return split_bad(scan_json_split(spark, path, schema))[0]


@query(f"""{_SPLIT} SELECT split, count(*) AS n FROM assigned GROUP BY ALL""")
def split_file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = Artefacts(spark, scratch_path(spark, "splits"), "r")
    out.store("split", stratified_split(inputs.strata(spark, sf_dir), "doc_id"), "split")
    files = rows_per_file(spark.read.schema("doc_id bigint, primary string").json(out.path("split")))
    side = F.regexp_extract("file", r"/split=(\w+)/", 1)
    return files.groupBy(side.alias("split")).agg(F.sum("n").alias("n"))


# --- whole runs --------------------------------------------------------------------

_FLOW = FlowParams(
    feed=FeedParams(review_count=None),
    cleaning=CleaningParams(min_length=5),
    rules=inputs.MIXED_RULES,
    export=False,
)
_MIXED_RULES = _rule_sql("text", inputs.MIXED_RULES)
_FLOW_SQL = f"""WITH {inputs.REVIEWS_MIXED}, merged AS ({_FIRST % 'reviews_mixed'}), {_prepared('merged')},
labeled AS (SELECT "reviewId", {_MIXED_RULES[0]} AS "primary" FROM unlabeled),
{_ASSIGNED % {'rows': 'labeled', 'id': '"reviewId"'}}"""


def _run(spark: SparkSession, sf_dir: str) -> Artefacts:
    google, app_store = inputs.by_platform(inputs.reviews_mixed(spark, sf_dir))
    order = F.struct(F.lit("dump").alias("source"), F.lit(0).cast("long").alias("block"), F.col("doc_id").alias("row"))
    records = inputs.record_dump(google).withColumn("src_order", order).drop("doc_id")
    pages = inputs.whole_feed(app_store)
    return run_all(spark, scratch_path(spark, "flow"), records, pages, "rules", _FLOW, "r")


@query(
    f"""{_FLOW_SQL}
SELECT 'google_play' AS artefact, count(*) AS n_rows FROM reviews WHERE platform = 'google_play'
UNION ALL SELECT 'app_store', count(*) FROM reviews WHERE platform = 'app_store'
UNION ALL SELECT 'merged', count(*) FROM merged UNION ALL SELECT 'unlabeled', count(*) FROM unlabeled
UNION ALL SELECT 'labeled', count(*) FROM labeled UNION ALL SELECT 'fixed', count(*) FROM labeled
UNION ALL SELECT split || '_json', count(*) FROM assigned GROUP BY ALL"""
)
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).manifest().select("artefact", "n_rows")


@query(f"""{_FLOW_SQL} SELECT split, "primary", count(*) AS n FROM assigned GROUP BY ALL""")
def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _run(spark, sf_dir)
    return split_counts(spark.read.schema("primary string, split string").json(out.path("split")))
