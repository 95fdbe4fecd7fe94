import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gleanery.operators import align as align_module
from gleanery.operators.align import (
    align,
    keep_first,
    merge_reviews,
    normalise_records,
    project_records,
    union_reviews,
)
from gleanery.schemas import GOOGLE_PLAY_RAW, UNIFIED
from gleanery.sources.scratch import written

RAW = "reviewId string, userName string, rating int, date string, content string, n int"


def raw(spark, *rows):
    full = [(i, "u", 3, "2025-01-01 00:00:00", text, n) for n, (i, text) in enumerate(rows)]
    return spark.createDataFrame(full, RAW)


def merged(google, app_store):
    rows = merge_reviews(google, app_store, order_by=["n"])
    assert rows.columns == UNIFIED.names
    return {(r["platform"], r["reviewId"], r["content"]) for r in rows.collect()}


def test_keep_first(spark):
    google = raw(spark, ("1", "first"), ("1", "second"), ("2", "g"), (None, "no id"), (None, "none"))
    app = raw(spark, ("2", "a"), ("3", "b"), ("01", "c"), (None, "x"))
    assert merged(google, app) == {
        ("google_play", "1", "first"),
        ("google_play", "2", "g"),
        ("google_play", None, "no id"),
        ("app_store", "3", "b"),
        ("app_store", "01", "c"),
    }


def test_ids_compare_as_text(spark):
    numbers = spark.createDataFrame([(1, "u", 3, "d", "g", 0)], "reviewId int, userName string, rating int, date string, content string, n int")
    assert merged(numbers, raw(spark, ("1", "a"))) == {("google_play", "1", "g")}


def test_one_side_and_none(spark):
    assert merged(None, raw(spark, ("1", "a"), ("1", "b"))) == {("app_store", "1", "a")}
    assert merged(raw(spark, ("1", "a")), raw(spark)) == {("google_play", "1", "a")}
    none = merge_reviews()
    assert none.schema == UNIFIED and none.isEmpty()
    assert union_reviews().isEmpty()


def test_merge_ignores_input_layout(spark):
    rng = random.Random(7)
    rows = [(str(rng.randrange(40)), f"t{k}") for k in range(300)]
    df = raw(spark, *rows)
    want = merged(df.repartition(1), df.repartition(1))
    assert want == merged(df.repartition(7), df.orderBy(F.desc("n")).repartition(3))
    assert len(want) == len({i for i, _ in rows})


def test_hot_key_is_combined_before_the_shuffle(spark, plan_of):
    plan = plan_of(keep_first(raw(spark, ("1", "a")), "reviewId", ["n"]))
    assert "partial_min" in plan and "Window" not in plan


def test_only_keys_and_losers_move(spark, plan_of, tmp_path):
    raw(spark, ("1", "a"), ("1", "b")).write.parquet(str(tmp_path / "t"))
    plan = plan_of(keep_first(spark.read.parquet(str(tmp_path / "t")), "reviewId", ["n"]))
    assert plan.count("content#") and all("content#" not in line for line in plan.splitlines() if "Exchange" in line)
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert sum("content:" in line for line in scans) == 1 and len(scans) == 3


def test_blank_and_missing_ids_are_one_group(spark):
    df = spark.createDataFrame([(None, 1), ("", 2), (None, 3), ("a", 4)], "reviewId string, n int")
    assert sorted(r["n"] for r in keep_first(df, "reviewId", ["n"]).collect()) == [1, 4]


def test_ties_leave_one_row_per_key(spark):
    rows = [("A", 1, "x"), ("A", 2, "y"), ("B", 2, "z"), ("C", 3, "c"), ("C", 3, "c"), (None, 2, "n"), ("", 2, "m"), ("D", None, "d"), ("D", None, "e")]
    df = spark.createDataFrame(rows, "reviewId string, t int, content string").repartition(3)
    got = keep_first(df, "reviewId", ["t"]).collect()
    assert sorted((r["reviewId"] or "", r["t"] or 0) for r in got) == [("", 2), ("A", 1), ("B", 2), ("C", 3), ("D", 0)]
    google = raw(spark, ("1", "a"), ("1", "b"), ("2", "c"), ("2", "c"))
    by_date = merge_reviews(google, raw(spark, ("2", "x"), ("3", "y")), order_by=["date"]).collect()
    assert sorted((r["reviewId"], r["platform"]) for r in by_date) == [("1", "google_play"), ("2", "google_play"), ("3", "app_store")]


def test_values_of_other_types_are_null(spark):
    df = spark.createDataFrame([("five",), ("4.0",), ("3",)], "score string")
    assert [r["score"] for r in project_records(df).select("score").collect()] == [None, 4, 3]
    odd = spark.sql("SELECT 'a' AS reviewId, 'u' AS userName, double('NaN') AS rating, 'd' AS date, 'c' AS content")
    assert align(odd, "p").first()["rating"] is None


def test_normalise_records(spark):
    df = spark.createDataFrame(
        [("1", 5, "2025-01-02T03:04:05Z", "c"), ("2", 4, "2025-02-30", None), ("3", None, None, "")],
        "reviewId string, score int, at string, content string",
    )
    got = normalise_records(df).orderBy("reviewId")
    assert got.columns == ["reviewId", "score", "at", "content", "rating", "date", "review"]
    assert [tuple(r)[4:] for r in got.collect()] == [(5, "2025-01-02 03:04:05", "c"), (4, None, None), (None, None, "")]
    stamps = spark.sql("SELECT timestamp_ntz'2025-03-09 02:30:00' AS at")
    assert normalise_records(stamps).first()["date"] == "2025-03-09 02:30:00"
    assert normalise_records(df.select("reviewId")).columns == ["reviewId"]


def test_align(spark):
    df = spark.createDataFrame(
        [("1", "u", "5", None, "r", "c"), ("2", None, "4.0", "d", None, "c"), (None, "u", "x", "d", None, None)],
        "reviewId string, userName string, rating string, date string, review string, content string",
    )
    assert [tuple(r) for r in align(df, "p").collect()] == [
        ("p", "1", "u", 5, "", "r"),
        ("p", "2", None, 4, "d", "c"),
        ("p", None, "u", None, "d", ""),
    ]
    assert align(df, "p").schema.simpleString() == UNIFIED.simpleString()
    with pytest.raises(ValueError, match="rating"):
        align(df.drop("rating"), "p")
    with pytest.raises(ValueError, match="content"):
        align(df.drop("review", "content"), "p")


def test_project_records(spark):
    got = project_records(spark.createDataFrame([("c", 1)], "content string, extra int"))
    assert got.columns == GOOGLE_PLAY_RAW.names
    assert tuple(got.first()) == (None, None, None, None, "c", None, None)


def test_rows_stay_where_they_lie(spark, plan_of, tmp_path, monkeypatch):
    """Stored tables aren't written again, and losers are stored first, so that a large table isn't shuffled for a few of them."""
    rows = [(f"k{i}", f"{i} " + hashlib.md5(str(i).encode()).hexdigest() * 8) for i in range(3000)]
    raw(spark, *rows, ("k1", "again"), ("k2", "again")).write.parquet(str(tmp_path / "google"))
    raw(spark, ("k3", "other side"), ("x", "only here")).write.parquet(str(tmp_path / "app_store"))
    names = []
    monkeypatch.setattr(align_module, "written", lambda rows, name, **options: names.append(name) or written(rows, name, **options))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50k")
    try:
        sides = [spark.read.parquet(str(tmp_path / name)) for name in ("google", "app_store")]
        plain = merge_reviews(*sides, order_by=["n"])
        assert names == ["rows", "lost"]
        stored = merge_reviews(*sides, order_by=["n"], stored=True)
        assert names[2:] == ["lost"]
        for merged in (plain, stored):
            assert "BroadcastHashJoin" in plan_of(merged) and "hashpartitioning" not in plan_of(merged)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert stored.count() == 3001 and sorted(stored.collect()) == sorted(plain.collect())
