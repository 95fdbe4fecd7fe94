"""Operator inputs derived from the stored tables.

The tables hold prose, labels and events rather than reviews, so each operator's
input is a projection or grouping of a whole table.  ``SQL`` states the same
derivations in SQL, as named common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.params import LabelRules
from gleanery.schemas import APP_STORE, GOOGLE_PLAY
from gleanery.sources.scratch import written

#: Letters replaced to get ideographs, full-width forms, an emoji, wide space,
#: a half-width kana and a circled digit into the texts.
LATIN, MIXED = "aeotrnsu", "的不Ａｂ😀　ｱ①"

PAGE_SIZE = 50
BATCH = 25

RULES = LabelRules(
    nature=(
        ("BUG", "license|[#$%&!]{2}"),
        ("UI/UX", "[0-9]{3}"),
        ("PERFORMANCE", "free|share"),
        ("FEATURE_REQUEST", "que "),
        ("POSITIVE", "tion "),
    ),
    area=(("ACCOUNT", "was"), ("TRANSACTION", "ich "), ("CREDIT_CARD", "mente|@")),
)
MIXED_RULES = LabelRules(
    nature=(
        ("BUG", "lic"),
        ("UI/UX", "[0-9]{3}"),
        ("PERFORMANCE", "wh"),
        ("FEATURE_REQUEST", "q"),
        ("POSITIVE", "h"),
    ),
    area=(("ACCOUNT", "w"), ("TRANSACTION", "ch"), ("CREDIT_CARD", "qm|mm")),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str | None], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), at.cast("int"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a review of one of the platforms; copies share an id."""
    d = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.length("source") == 4, GOOGLE_PLAY).otherwise(APP_STORE).alias("platform"),
        F.md5("text").alias("reviewId"),
        F.concat(F.lit("user_"), (d % 97).cast("string")).alias("userName"),
        (d % 5 + 1).cast("int").alias("rating"),
        F.timestamp_add("HOUR", d, F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")).cast("string").alias("date"),
        F.col("text").alias("content"),
    )


def mixed(text: Column) -> Column:
    return F.translate(text, LATIN, MIXED)


def reviews_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews in mixed script."""
    return reviews(spark, sf_dir).withColumn("content", mixed(F.col("content")))


def record_dump(rows: DataFrame) -> DataFrame:
    """Reviews as the first platform's records; some have no readable date."""
    bad = F.when(F.col("doc_id") % 13 == 0, "soon").when(F.col("doc_id") % 17 == 0, F.lit(None).cast("string"))
    iso = F.concat(F.replace(F.col("date"), F.lit(" "), F.lit("T")), F.lit("+08:00"))
    return rows.select(
        "reviewId",
        "userName",
        F.col("rating").alias("score"),
        F.when((F.col("doc_id") % 13 == 0) | (F.col("doc_id") % 17 == 0), bad).otherwise(iso).alias("at"),
        "content",
        "doc_id",
    )


def feed_rows(rows: DataFrame) -> DataFrame:
    """Reviews as the second platform's flattened rows."""
    return rows.select(
        "reviewId", "userName", "rating", "date", F.lit("").alias("title"),
        F.col("content").alias("review"), F.lit(False).alias("isEdited"), "doc_id",
    )


def by_platform(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.filter(F.col("platform") == GOOGLE_PLAY), rows.filter(F.col("platform") == APP_STORE)


def _label(value: Column) -> Column:
    return F.struct(value.alias("label"))


def _entry(rating: Column, updated: Column) -> Column:
    return F.struct(
        F.struct(_label(F.col("userName")).alias("name")).alias("author"),
        _label(F.col("content")).alias("content"),
        _label(rating).alias("im:rating"),
        _label(F.lit("t")).alias("title"),
        _label(F.col("reviewId")).alias("id"),
        _label(updated).alias("updated"),
    )


def _bodies(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One body per page of at most ``PAGE_SIZE`` entries, head entry first."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "entry"))), lambda e: F.to_json(e["entry"]))
    body = F.concat(F.lit('{"feed":{"entry":[{"id":{"label":"app"}},'), F.array_join(listed, ","), F.lit("]}}"))
    return rows.groupBy(*keys).agg(body.alias("body"))


def feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as feed pages, 250 per app.

    Of every four apps the first has no country, the second has an unreadable page 3, the third an empty
    page 4, and the fourth no page 3; some entries have a bad rating or date.
    """
    d = F.col("doc_id")
    app = F.floor(d / 250)
    page = F.floor(d % 250 / PAGE_SIZE) + 1
    rating = F.when(d % 11 == 0, "x").otherwise(F.col("rating").cast("string"))
    updated = F.when(d % 13 == 0, "").otherwise(
        F.concat(F.replace(F.col("date"), F.lit(" "), F.lit("T")), F.lit("-07:00"))
    )
    rows = reviews(spark, sf_dir).select(
        app.alias("app"),
        F.when((app % 4 == 3) & (page >= 3), page + 1).otherwise(page).cast("int").alias("page"),
        (d % PAGE_SIZE + 1).alias("pos"),
        _entry(rating, updated).alias("entry"),
    )
    pages = _bodies(rows, ["app", "page"])
    body = (
        F.when((F.col("app") % 4 == 1) & (F.col("page") == 3), "oops")
        .when((F.col("app") % 4 == 2) & (F.col("page") == 4), '{"feed":{}}')
        .otherwise(F.col("body"))
    )
    country = F.when(F.col("app") % 4 != 0, "tw")
    pages = pages.select(F.col("app").cast("string").alias("app_id"), country.alias("country"), "page", body.alias("body"))
    return written(pages, "pages")


def sparse_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as faultless pages whose entries may lack author, title or rating."""
    d = F.col("doc_id")
    entry = F.struct(
        F.when(d % 3 != 0, F.struct(_label(F.col("source")).alias("name"))).alias("author"),
        _label(F.col("text")).alias("content"),
        F.when(d % 7 != 0, _label((d % 5 + 1).cast("string"))).alias("im:rating"),
        F.when(d % 5 != 0, _label(F.col("lang"))).alias("title"),
        _label(d.cast("string")).alias("id"),
        _label(F.lit("2025-01-02T03:04:05Z")).alias("updated"),
    )
    rows = table(spark, sf_dir, "documents").select(
        F.floor(d / 1000).cast("string").alias("app_id"), F.lit("tw").alias("country"),
        (F.floor(d % 1000 / PAGE_SIZE) + 1).cast("int").alias("page"), d.alias("pos"), entry.alias("entry"),
    )
    return _bodies(rows, ["app_id", "country", "page"])


def whole_feed(rows: DataFrame) -> DataFrame:
    """Reviews as feed pages without faults, one app per thousand ids."""
    d = F.col("doc_id")
    entries = rows.select(
        F.floor(d / 1000).cast("string").alias("app_id"),
        F.lit("tw").alias("country"),
        (F.floor(d % 1000 / PAGE_SIZE) + 1).cast("int").alias("page"),
        d.alias("pos"),
        _entry(F.col("rating").cast("string"), F.replace(F.col("date"), F.lit(" "), F.lit("T"))).alias("entry"),
    )
    return _bodies(entries, ["app_id", "country", "page"])


def labels_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels in all states: spelled oddly, blank, unknown, missing."""
    quality, toxic, d = F.col("quality"), F.col("toxic"), F.col("doc_id")
    return table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when((quality == 1) & (toxic == 0), "POSITIVE").when(quality == 1, "FEATURE_REQUEST")
        .when(toxic == 0, "BUG").otherwise("INVALID").alias("primary_label"),
        _pick([" crash ", "UI", "bug report", "slow", "n/a", "POSITIVE", "whatever", None, "", "ui/ux"], d % 10).alias("primary_raw"),
        _pick(["login", "Credit Card", "qr", "GENERAL", None, "pay", "xx"], d % 7).alias("secondary_raw"),
    )


def labeled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty labels with their documents' texts."""
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = labels_dirty(spark, sf_dir)
    return labels.join(texts, "doc_id").select(
        "doc_id", "text", F.col("primary_raw").alias("primary"), F.col("secondary_raw").alias("secondary")
    )


def numbered_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty labels with batch and position; batches are 25 consecutive ids."""
    place = F.row_number().over(Window.partitionBy("batch_id").orderBy("doc_id")) - 1
    rows = labels_dirty(spark, sf_dir).withColumn("batch_id", F.floor(F.col("doc_id") / BATCH))
    return rows.withColumn("pos", place)


def model_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per batch: plain, fenced, with other keys, cut short, with a semicolon."""
    rows = numbered_labels(spark, sf_dir)
    b = F.col("batch_id")
    plain = F.to_json(F.struct(F.col("primary_raw").alias("primary"), F.col("secondary_raw").alias("secondary")))
    other = F.to_json(F.struct(F.col("primary_raw").alias("primary_label"), F.col("secondary_raw").alias("secondaryCategory")))
    rows = rows.select("batch_id", "pos", F.when(b % 5 == 2, other).otherwise(plain).alias("item"))
    items = F.transform(F.array_sort(F.collect_list(F.struct("pos", "item"))), lambda r: r["item"])
    listed = rows.groupBy("batch_id").agg(items.alias("items"))
    kept = F.when(b % 7 == 3, F.slice("items", F.lit(1), F.greatest(F.size("items") - 2, F.lit(0)))).otherwise(F.col("items"))
    body = F.concat(F.lit("["), F.array_join(kept, ","), F.lit("]"))
    body = F.when(b % 3 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body)
    return listed.select("batch_id", F.when(b % 11 == 5, F.concat(body, F.lit(";"))).otherwise(body).alias("body"))


def strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels_dirty(spark, sf_dir).select("doc_id", F.col("primary_label").alias("primary"))


# --- the same derivations in SQL ------------------------------------------------

REVIEWS = """reviews AS (
  SELECT doc_id, CASE WHEN length(source) = 4 THEN 'google_play' ELSE 'app_store' END AS platform,
         md5(text) AS "reviewId", 'user_' || CAST(doc_id % 97 AS VARCHAR) AS "userName",
         CAST(doc_id % 5 + 1 AS INTEGER) AS rating,
         strftime(TIMESTAMP '2025-01-01 00:00:00' + to_hours(doc_id), '%Y-%m-%d %H:%M:%S') AS date,
         text AS content
  FROM documents)"""

REVIEWS_MIXED = f"""{REVIEWS}, reviews_mixed AS (
  SELECT * REPLACE (translate(content, '{LATIN}', '{MIXED}') AS content) FROM reviews)"""

LABELS_DIRTY = """labels_dirty AS (
  SELECT doc_id,
    CASE WHEN quality = 1 AND toxic = 0 THEN 'POSITIVE' WHEN quality = 1 THEN 'FEATURE_REQUEST'
         WHEN toxic = 0 THEN 'BUG' ELSE 'INVALID' END AS primary_label,
    ([' crash ', 'UI', 'bug report', 'slow', 'n/a', 'POSITIVE', 'whatever', NULL, '', 'ui/ux'])
      [CAST(doc_id % 10 + 1 AS INTEGER)] AS primary_raw,
    (['login', 'Credit Card', 'qr', 'GENERAL', NULL, 'pay', 'xx'])
      [CAST(doc_id % 7 + 1 AS INTEGER)] AS secondary_raw
  FROM labels)"""

LABELED_TEXTS = f"""{LABELS_DIRTY}, labeled_texts AS (
  SELECT doc_id, text, primary_raw AS "primary", secondary_raw AS secondary
  FROM labels_dirty JOIN documents USING (doc_id))"""

NUMBERED = f"""{LABELS_DIRTY}, numbered AS (
  SELECT *, doc_id // 25 AS batch_id,
         row_number() OVER (PARTITION BY doc_id // 25 ORDER BY doc_id) - 1 AS pos,
         count(*) OVER (PARTITION BY doc_id // 25) AS n
  FROM labels_dirty)"""

FEED = f"""{REVIEWS}, placed AS (
  SELECT *, doc_id // 250 AS app, doc_id % 250 // 50 + 1 AS raw_page, doc_id % 50 + 1 AS pos FROM reviews
), numbered_pages AS (
  SELECT * REPLACE (CAST(CASE WHEN app % 4 = 3 AND raw_page >= 3 THEN raw_page + 1 ELSE raw_page END AS INTEGER) AS raw_page),
         CASE app % 4 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 3 ELSE 1000 END AS stop
  FROM placed
), readable AS (
  SELECT CAST(app AS VARCHAR) AS app_id, 'tw' AS country, raw_page AS page, CAST(pos AS INTEGER) AS pos, stop,
         "reviewId", "userName", rating, date, 't' AS title, content AS review, false AS "isEdited"
  FROM numbered_pages WHERE doc_id % 11 <> 0 AND doc_id % 13 <> 0
), usable AS (SELECT * FROM readable WHERE page < stop)"""
