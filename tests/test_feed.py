import json

import pytest
from pyspark.sql import functions as F

from gleanery.operators.feed import cap_pages, flatten_feed, last_pages, page_stats
from gleanery.params import FeedParams
from gleanery.schemas import APP_STORE_RAW, FEED_PAGE

ALL = FeedParams(review_count=None)


def entry(id_="1", **changes):
    leaf = {
        "author": {"name": {"label": "ann"}}, "content": {"label": "fine"}, "im:rating": {"label": "4"},
        "title": {"label": "t"}, "id": {"label": id_}, "updated": {"label": "2025-01-01T10:00:00-07:00"},
    }
    leaf.update({k.replace("rating", "im:rating"): v for k, v in changes.items()})
    return {k: v for k, v in leaf.items() if v != "absent"}


def body(*entries):
    return json.dumps({"feed": {"entry": [{"id": {"label": "app"}}, *entries]}})


def pages(spark, *rows):
    return spark.createDataFrame([(a, "tw", p, b) for a, p, b in rows], FEED_PAGE)


GOOD = ("1", "ann", 4, "2025-01-01 10:00:00", "t", "fine", False)


CASES = [
    ({}, GOOD),
    ({"author": "absent"}, ("1", "Unknown", *GOOD[2:])),
    ({"author": {}}, ("1", "Unknown", *GOOD[2:])),
    ({"author": None}, None),
    ({"author": {"name": None}}, None),
    ({"author": "ann"}, None),
    ({"author": {"name": {"label": None}}}, ("1", None, *GOOD[2:])),
    ({"content": "absent"}, (*GOOD[:5], "", False)),
    ({"content": {"label": None}}, (*GOOD[:5], None, False)),
    ({"content": None}, None),
    ({"title": [1]}, None),
    ({"id": "absent"}, ("", *GOOD[1:])),
    ({"rating": {"label": " 5 "}}, (*GOOD[:2], 5, *GOOD[3:])),
    ({"rating": {"label": "+3"}}, (*GOOD[:2], 3, *GOOD[3:])),
    ({"rating": {"label": 2}}, (*GOOD[:2], 2, *GOOD[3:])),
    ({"rating": {"label": "x"}}, None),
    ({"rating": {"label": "4.5"}}, None),
    ({"rating": {"label": None}}, None),
    ({"rating": "absent"}, (*GOOD[:2], 0, *GOOD[3:])),
    ({"updated": "absent"}, None),
    ({"updated": {"label": ""}}, None),
    ({"updated": {"label": "2025-01-01T10:00:00Z"}}, GOOD),
    ({"updated": {"label": "2025-01-01T10:00:00.5+08:00"}}, GOOD),
]


def test_entries(spark):
    """Each case as an app of its own."""
    df = pages(spark, *[(str(k), 1, body(entry(**changes))) for k, (changes, _) in enumerate(CASES)])
    rows = flatten_feed(df, ALL).select("app_id", *APP_STORE_RAW.names).collect()
    got = {int(r["app_id"]): tuple(r)[1:] for r in rows}
    for k, (changes, want) in enumerate(CASES):
        assert got.get(k) == want, changes


def test_entries_that_are_no_objects(spark):
    df = pages(spark, ("a", 1, body("s", None, 5, entry("9"))))
    assert [(r["pos"], r["reviewId"]) for r in flatten_feed(df, ALL).collect()] == [(4, "9")]


def test_run_of_good_pages(spark):
    full = body(entry())
    df = pages(
        spark,
        *[("gap", p, full) for p in (1, 2, 4)],
        ("text", 1, full), ("text", 2, "oops"), ("text", 3, full),
        ("object", 1, json.dumps({"feed": {"entry": entry()}})), ("object", 2, full),
        ("head", 1, full), ("head", 2, body()), ("none", 1, json.dumps({"feed": {}})),
        ("late", 2, full), ("null", 1, None), ("all", 1, full), ("all", 2, full),
    )
    got = {r["app_id"]: r["last_page"] for r in last_pages(page_stats(df, count_reviews=False)).collect()}
    assert got == {"gap": 2, "text": 1, "object": 0, "head": 1, "none": 0, "late": 0, "null": 0, "all": 2}
    rows = flatten_feed(df, ALL).groupBy("app_id").count().collect()
    assert dict(map(tuple, rows)) == {"gap": 2, "text": 1, "head": 1, "all": 2}
    rows = flatten_feed(df, FeedParams(review_count=None, max_pages=1)).groupBy("app_id").count().collect()
    assert dict(map(tuple, rows)) == {"gap": 1, "text": 1, "head": 1, "all": 1}


@pytest.mark.parametrize("cap", [1, 2, 4, 5, 100])
def test_cap_counts_readable_reviews_in_order(spark, cap):
    bad = entry(rating={"label": "x"})
    df = pages(
        spark,
        ("a", 1, body(entry("1"), bad, entry("2"))), ("a", 2, body(bad)), ("a", 3, body(entry("3"), entry("4"), bad, entry("5"))),
        ("b", 1, body(entry("9"))),
    )
    rows = flatten_feed(df, FeedParams(review_count=cap))
    got = [r["reviewId"] for r in rows.filter("app_id = 'a'").orderBy("src_order").collect()]
    assert got == ["1", "2", "3", "4", "5"][:cap]
    assert rows.filter("app_id = 'b'").count() == 1


def test_cap_over_many_pages(spark):
    """The running total crosses blocks of pages."""
    stats = spark.range(1, 5001).select(
        F.lit("a").alias("app_id"), F.lit("tw").alias("country"), F.col("id").cast("int").alias("page"), (F.col("id") % 4).cast("int").alias("n_reviews")
    )
    total, want = 0, None
    for page in range(1, 5001):
        if total < 7000 <= total + page % 4:
            want = (page, 7000 - total)
        total += page % 4
    assert [(r["cap_page"], r["cap_rows"]) for r in cap_pages(stats, 7000).collect()] == [want]
    assert cap_pages(stats, total + 1).isEmpty()


def test_bodies_are_parsed_once(spark, plan_of, tmp_path):
    pages(spark, ("a", 1, body(entry()))).write.parquet(str(tmp_path / "p"))
    plan = plan_of(flatten_feed(spark.read.parquet(str(tmp_path / "p"))))
    assert "body" not in plan and "parse_json" not in plan and "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_feeds_without_a_key(spark):
    df = pages(spark, ("a", 1, body(entry("1"))), (None, 1, body(entry("2"))), (None, 2, body(entry("3"))))
    df = df.withColumn("country", F.lit(None).cast("string"))
    assert {r["reviewId"] for r in flatten_feed(df).collect()} == {"1", "2", "3"}
    assert {r["reviewId"] for r in flatten_feed(df, FeedParams(review_count=1)).collect()} == {"1", "2"}


def test_a_page_landed_twice_counts_once(spark):
    full, short = body(entry("1"), entry("2"), entry("3")), body(entry("1"))
    df = pages(spark, ("a", 1, full), ("a", 1, short), ("a", 1, full), ("a", 2, body(entry("4"))), ("a", 2, None))
    assert sorted(r["reviewId"] for r in flatten_feed(df).collect()) == ["1", "2", "3", "4"]
    assert sorted(r["reviewId"] for r in flatten_feed(df, FeedParams(review_count=2)).collect()) == ["1", "2"]
    landed = df.withColumn("landed", F.length("body"))
    got = flatten_feed(landed, order_by=["landed"]).collect()
    assert sorted(r["reviewId"] for r in got) == ["1"]  # the second page came first without a body


def test_counts_of_what_is_left_out(spark):
    from pyspark.sql import Observation

    bad = entry(rating={"label": "x"})
    counts = Observation("counts")
    df = pages(spark, ("a", 1, body(entry("1"), bad, entry("2"))), ("a", 2, body(entry("3"))))
    flatten_feed(df, FeedParams(review_count=1), counts=counts).count()
    assert counts.get == {"n_taken": 1, "n_cut": 2, "n_unread": 1}
    assert flatten_feed(df).count() == 3  # no cap unless asked for


@pytest.mark.parametrize("bad", [{"review_count": 0}, {"max_pages": 0}])
def test_bounds(bad):
    with pytest.raises(ValueError):
        FeedParams(**bad)
