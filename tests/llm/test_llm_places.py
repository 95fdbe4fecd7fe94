"""Rows chosen by place, components, and scratch tables that pass."""

import os

import pytest
from pyspark.sql import functions as F

from gleanery.llm import near_copies
from gleanery.llm.components import components
from gleanery.llm.places import rows_at
from gleanery.sources.scratch import passing, scratch_path, written

SPOT = ["_metadata.file_path AS _file", "_metadata.row_index AS _row"]


@pytest.mark.parametrize("sent", [0, 1 << 18])
def test_rows_at_places(spark, sent):
    stored = written(spark.range(0, 2100, 1, 3).withColumn("x", F.col("id") * 7), "stored")
    wanted = {0, 63, 64, 255, 256, 257, 699, 700, 1023, 1400, 2099}
    chosen = stored.selectExpr("id", *SPOT).filter(F.col("id").isin(*wanted)).select("_file", "_row")
    inside = rows_at(stored, chosen.unionAll(chosen), sent=sent)
    assert inside.columns == ["id", "x"]
    assert sorted(r.id for r in inside.collect()) == sorted(wanted)
    rest = rows_at(stored, chosen, inside=False, sent=sent)
    assert sorted(r.id for r in rest.collect()) == sorted(set(range(2100)) - wanted)
    assert rows_at(stored, chosen.limit(0), sent=sent).count() == 0


def test_few_marks_stand_for_many_rows_and_texts_are_not_shuffled(spark):
    stored = written(spark.range(0, 5000, 1, 1).withColumn("text", F.repeat(F.lit("word "), 500)), "stored")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = rows_at(stored, stored.selectExpr("id", *SPOT).filter("id % 2 = 0").select("_file", "_row"))
        assert out.count() == 2500
        assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("edges, want", [
    ([], {}),
    ([(1, 1)], {}),
    ([(2, 1), (1, 2), (3, 1)], {1: 1, 2: 1, 3: 1}),
    ([(1, 5), (5, 9), (9, 2), (7, 8)], {1: 1, 5: 1, 9: 1, 2: 1, 7: 7, 8: 7}),
    ([(i, i + 1) for i in range(40)], dict.fromkeys(range(41), 0)),
    ([(9, 4), (9, 3)], {9: 3, 4: 3, 3: 3}),
])
def test_components(spark, edges, want):
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == want and len(found) == len(want)


def test_scratch_that_passes(spark):
    kept = scratch_path(spark, "kept")
    with passing(spark):
        gone = scratch_path(spark, "gone")
        written(spark.range(3), "gone", gone)
        written(spark.range(3), "kept", kept)
        with passing(spark):
            inner = scratch_path(spark, "inner")
            written(spark.range(3), "inner", inner)
        assert not os.path.exists(inner.removeprefix("file:")) and os.path.exists(gone.removeprefix("file:"))
    assert not os.path.exists(gone.removeprefix("file:")) and spark.read.parquet(kept).count() == 3


def test_near_copies_leave_no_more_than_rows_and_marks(spark, tmp_path):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[:i] + ["x"] + words[i + 1 :])) for i in range(12)] + [(90 + i, f"alone {i} of its kind here") for i in range(9)]
    out = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    root = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    before = set(os.listdir(root))
    out = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {n.split("-")[0] for n in set(os.listdir(root)) - before} == {"documents", "gone"}
    assert sorted(r.doc_id for r in out.collect()) == [0, *range(90, 99)]
