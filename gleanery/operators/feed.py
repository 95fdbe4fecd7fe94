"""Flatten landed feed pages into review rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from gleanery.functions.dates import wall_clock
from gleanery.functions.text import strip_space
from gleanery.params import FeedParams
from gleanery.schemas import APP_STORE_RAW
from gleanery.sources.scratch import written

FEED = ("app_id", "country")

_BLOCK = 1024  # pages per step of the running total

# Where each text of an entry stands, and what it is when absent.
_PARTS = {
    "reviewId": ("$.id.label", ""),
    "userName": ("$.author.name.label", "Unknown"),
    "rating": ("$['im:rating'].label", "0"),
    "updated": ("$.updated.label", ""),
    "title": ("$.title.label", ""),
    "review": ("$.content.label", ""),
}
#: An entry with everything in place, read in one go.
_REGULAR = (
    "struct<author: struct<name: struct<label: string>>, content: struct<label: string>, "
    "`im:rating`: struct<label: string>, title: struct<label: string>, id: struct<label: string>, "
    "updated: struct<label: string>>"
)


def feed_entries(body: Column) -> Column:
    """``array<variant>`` of a page's entries, head entry included.

    NULL when the body is no JSON, has no entries or has something else there.
    """
    return F.try_variant_get(F.try_parse_json(body), "$.feed.entry", "array<variant>")


def _leaves(entry: Column) -> Column:
    """Texts of an irregular entry: absent parts take defaults, a part that is
    present but no object spoils the entry and gives NULL."""

    def node(path: str) -> Column:
        return F.try_variant_get(entry, path, "variant")

    def spoiled(path: str) -> Column:
        return F.coalesce(~F.startswith(F.schema_of_variant(node(path)), F.lit("OBJECT")), F.lit(False))

    def leaf(path: str, default: str) -> Column:
        return F.when(node(path).isNull(), default).otherwise(F.try_variant_get(entry, path, "string"))

    bad = spoiled("$")
    for path in sorted({path.rpartition(".")[0] for path, _ in _PARTS.values()} | {"$.author"}):
        bad = bad | spoiled(path)
    return F.when(~bad, F.struct(*[leaf(*part).alias(name) for name, part in _PARTS.items()]))


def page_reviews(entries: Column) -> Column:
    """Readable reviews among a page's entries, in page order.

    ``array<struct<pos, rating, date, text>>``; the head entry describes the app
    and is left out, as are entries whose rating or date cannot be read.  Each
    step hands its values on to the next, so that none is worked out twice.
    """
    typed = F.transform(
        F.slice(entries, F.lit(2), F.size(entries)),
        lambda entry, at: F.struct(
            (at + 1).alias("pos"), entry.alias("entry"), F.try_variant_get(entry, "$", _REGULAR).alias("typed")
        ),
    )

    def texts(r: Column) -> Column:
        parts = {name: _typed_leaf(r["typed"], path) for name, (path, _) in _PARTS.items()}
        regular = parts["reviewId"].isNotNull()
        for leaf in list(parts.values())[1:]:
            regular = regular & leaf.isNotNull()
        plain = F.struct(*[leaf.alias(name) for name, leaf in parts.items()])
        return F.struct(r["pos"].alias("pos"), F.when(regular, plain).otherwise(_leaves(r["entry"])).alias("text"))

    def values(r: Column) -> Column:
        return F.struct(
            r["pos"].alias("pos"),
            strip_space(r["text"]["rating"]).try_cast("int").alias("rating"),
            wall_clock(r["text"]["updated"]).alias("date"),
            r["text"].alias("text"),
        )

    reviews = F.transform(F.transform(typed, texts), values)
    return F.filter(reviews, lambda r: r["rating"].isNotNull() & r["date"].isNotNull())


def _typed_leaf(typed: Column, path: str) -> Column:
    for key in path.replace("['", ".").replace("']", "").split(".")[1:]:
        typed = typed.getField(key)
    return typed


def page_stats(pages: DataFrame, keys: Sequence[str] = FEED, count_reviews: bool = True) -> DataFrame:
    """Per page: number of entries (NULL if unreadable) and of readable reviews."""
    parsed = pages.select(*keys, "page", feed_entries(F.col("body")).alias("entries"))
    entries = F.col("entries")
    reviews = F.size(page_reviews(entries)) if count_reviews else F.lit(None).cast("int")
    return parsed.select(*keys, "page", F.size(entries).alias("n_entries"), reviews.alias("n_reviews"))


def _as_one(keys: Sequence[str]) -> Column:
    """The keys of a feed as one value; structs are equal where both lack the same key, NULLs are not."""
    return F.struct(*keys).alias("_feed")


def _as_keys(keys: Sequence[str]) -> list[Column]:
    return [F.col("_feed")[k].alias(k) for k in keys]


def last_pages(stats: DataFrame, keys: Sequence[str] = FEED) -> DataFrame:
    """Per feed, the end of the unbroken run of good pages from page 1 (0 if none).

    A page is good if it has more than its head entry.  A run ends where the
    next page is bad or absent, which an anti-join on (feed, page) finds; no
    task has to see all pages of a feed.  A feed may lack keys.
    """
    rows = stats.select(_as_one(keys), F.col("page").cast("long").alias("page"), "n_entries")
    good = rows.filter((F.col("n_entries") > 1) & (F.col("page") >= 1)).select("_feed", "page")
    starts = rows.select("_feed").distinct().withColumn("page", F.lit(0).cast("long"))
    followed = good.withColumn("page", F.col("page") - 1)
    ends = good.unionByName(starts).join(followed, ["_feed", "page"], "left_anti")
    return ends.groupBy("_feed").agg(F.min("page").alias("last_page")).select(*_as_keys(keys), "last_page")


def cap_pages(stats: DataFrame, review_count: int, keys: Sequence[str] = FEED) -> DataFrame:
    """Per feed that reaches *review_count*: the page where, and how many it may give.

    *stats* holds usable pages only, each once.  The running total goes over
    blocks of pages first and then inside the one block in which the count is reached.
    """
    blocks = stats.select(_as_one(keys), "page", "n_reviews", F.floor(F.col("page") / _BLOCK).alias("_block"))
    sums = blocks.groupBy("_feed", "_block").agg(F.sum("n_reviews").alias("_n"))
    so_far = Window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("_n").over(so_far.partitionBy("_feed").orderBy("_block")) - F.col("_n")
    reach = sums.withColumn("_before", before).filter(
        (F.col("_before") < review_count) & (F.col("_before") + F.col("_n") >= review_count)
    )
    inside = blocks.join(reach.select("_feed", "_block", "_before"), ["_feed", "_block"])
    ahead = F.col("_before") - F.col("n_reviews") + F.sum("n_reviews").over(
        so_far.partitionBy("_feed", "_block").orderBy("page")
    )
    return (
        inside.withColumn("_ahead", ahead)
        .filter((F.col("_ahead") < review_count) & (F.col("_ahead") + F.col("n_reviews") >= review_count))
        .select(*_as_keys(keys), F.col("page").cast("long").alias("cap_page"), (review_count - F.col("_ahead")).cast("int").alias("cap_rows"))
    )


def one_landing(stats: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Of pages landed more than once, one: the first in *order_by*, else the one with most entries, then the first stored."""
    rank = F.struct(*order_by, (-F.coalesce("n_entries", F.lit(-1))).alias("_few"), "_at")
    values = F.struct("n_entries", "n_reviews", "_at")
    return stats.groupBy("_feed", "page").agg(F.min_by(values, rank).alias("_v")).select("_feed", "page", "_v.*")


def flatten_feed(
    pages: DataFrame,
    params: FeedParams = FeedParams(),
    keys: Sequence[str] = FEED,
    order_by: Sequence[str] = (),
    counts: Observation | None = None,
) -> DataFrame:
    """Review rows of the usable pages, plus feed keys, ``page``, ``pos`` and ``src_order``.

    Pages are usable up to the first that is absent, unreadable or without
    reviews, and up to ``max_pages``; of these, the first ``review_count``
    readable reviews per feed are taken.  Each body is parsed once, into a stored
    table of reviews.  What to take is worked out on that table's page numbers
    and counts, and joined back by where a page is stored, so a feed with most of
    the pages is no heavier than others.  Of a page landed twice one landing counts, by
    *order_by* columns of *pages*.  *counts* receives n_taken, n_cut (readable reviews
    beyond the cap) and n_unread (entries without a readable rating or date).
    """
    if params.max_pages is not None:
        pages = pages.filter(F.col("page") <= params.max_pages)
    entries = pages.select(_as_one(keys), F.col("page").cast("long").alias("page"), *order_by, feed_entries(F.col("body")).alias("entries"))
    parsed = entries.select("_feed", "page", *order_by, F.size("entries").alias("n_entries"), page_reviews(F.col("entries")).alias("reviews"))
    parsed = written(parsed, "parsed-pages")
    stored_at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("_at")
    stats = parsed.select("_feed", "page", *order_by, "n_entries", F.size("reviews").alias("n_reviews"), stored_at)
    stats = written(one_landing(stats, order_by), "page-stats", compact=True)
    usable = stats.join(last_pages(stats, ["_feed"]), "_feed").filter(F.col("page").between(1, F.col("last_page")))
    take = F.col("n_reviews")
    if params.review_count is not None:
        usable = usable.join(cap_pages(usable, params.review_count, ["_feed"]), "_feed", "left")
        beyond = F.col("page") > F.col("cap_page")
        take = F.when(beyond, 0).when(F.col("page") == F.col("cap_page"), F.col("cap_rows")).otherwise(take)
    takes = usable.withColumn("take", take)
    if counts is not None:
        unread = F.sum(F.col("n_entries") - 1 - F.col("n_reviews"))
        sums = {"n_taken": F.sum("take"), "n_cut": F.sum(F.col("n_reviews") - F.col("take")), "n_unread": unread}
        takes = takes.observe(counts, *[F.coalesce(value, F.lit(0)).alias(name) for name, value in sums.items()])
    # One row per page, stored: Spark sees its size and broadcasts it only if small.
    takes = written(takes.select("_at", "take"), "page-takes", compact=True).filter("take > 0")
    rows = parsed.select("_feed", "page", "reviews", stored_at).join(takes, "_at")
    rows = rows.select(*_as_keys(keys), F.col("page").cast("int").alias("page"), F.explode(F.slice("reviews", F.lit(1), F.col("take"))).alias("r"))
    order = F.struct(
        F.concat_ws("/", *keys).alias("source"), F.col("page").cast("long").alias("block"), F.col("r.pos").cast("long").alias("row")
    )
    text = {name: F.col(f"r.text.{name}") for name in ("reviewId", "userName", "title", "review")}
    values = {**text, "rating": F.col("r.rating"), "date": F.col("r.date"), "isEdited": F.lit(False)}
    return rows.select(
        *keys,
        "page",
        F.col("r.pos").alias("pos"),
        *[values[name].alias(name) for name in APP_STORE_RAW.names],
        order.alias("src_order"),
    )
