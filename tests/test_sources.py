import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleanery.operators.align import merge_reviews, normalise_records
from gleanery.schemas import APP_STORE_RAW, FEED_PAGE, GOOGLE_PLAY_RAW, LABELED, UNIFIED
from gleanery.sources import scratch
from gleanery.sources.artefacts import Artefacts, new_run_id, read_artefact, write_csv
from gleanery.sources.readers import (
    split_bad,
    scan_table,
    with_flat_order,
    empty,
    json_key_profile,
    rows_per_file,
    scan_csv,
    scan_json,
    scan_merged,
    scan_page_files,
    scan_records,
    source_or_empty,
)

TEXTS = ['plain', 'a "quoted" word', 'two\nlines', 'cr\r\nlf', ' padded ', 'x,y', 'NA', 'null', '\\', '\\"', '"', "é，", None]


def reviews(spark):
    rows = [("p", str(i), None, i, "2025-01-01 00:00:00", t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, UNIFIED)


def test_csv_roundtrip(spark, tmp_path):
    write_csv(reviews(spark), str(tmp_path / "m"))
    got = scan_merged(spark, str(tmp_path / "m"))
    assert got.schema.simpleString() == UNIFIED.simpleString()
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in reviews(spark).collect()}


def test_csv_from_elsewhere(spark, tmp_path):
    file = tmp_path / "raw.csv"
    file.write_text('reviewId,extra,review,rating\n7,e,"a ""b""\nc",5\n,,,\n8,,d,x\n', encoding="utf-8-sig")
    rows = scan_csv(spark, str(file)).orderBy("src_order").collect()
    assert [tuple(r)[:4] for r in rows] == [("7", "e", 'a "b"\nc', "5"), (None, None, None, None), ("8", None, "d", "x")]
    typed = scan_csv(spark, str(file), StructType([APP_STORE_RAW["rating"], APP_STORE_RAW["reviewId"]]))
    assert [tuple(r)[:2] for r in typed.orderBy("src_order").collect()] == [(5, "7"), (None, None), (None, "8")]
    with pytest.raises(ValueError, match="userName"):
        scan_csv(spark, str(file), APP_STORE_RAW)


def test_first_in_file_order(spark, tmp_path):
    """Order survives splitting a file over tasks and reading files by size."""
    lines = ["reviewId,userName,rating,date,content"]
    lines += [f"{i % 50},u,3,2025-01-01,row {i} {'x' * 40}" for i in range(2000)]
    (tmp_path / "b.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "a.csv").write_text("\n".join([lines[0], "7,u,3,2025-01-01,from a", "7,u,3,2025-01-01,second"]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        rows = scan_csv(spark, str(tmp_path), multi_line=False)
        assert rows.rdd.getNumPartitions() > 8
        got = {r["reviewId"]: r["content"].rstrip("x ") for r in merge_reviews(rows).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {str(i): "from a" if i == 7 else f"row {i}" for i in range(50)}
    assert merge_reviews(scan_csv(spark, str(tmp_path))).count() == 50


def test_json_files(spark, tmp_path):
    items = [{"text": "a\nb", "primary": None, "reviewId": "1"}, {"text": "c", "primary": "BUG", "x": 1}]
    (tmp_path / "array.json").write_text(json.dumps(items, indent=2))
    got = scan_json(spark, str(tmp_path / "array.json"), array_file=True)
    assert got.columns == LABELED.names
    assert {(r["text"], r["primary"], r["reviewId"]) for r in got.collect()} == {("a\nb", None, "1"), ("c", "BUG", None)}
    (tmp_path / "lines.json").write_text('{"reviewId":"1","score":5,"other":1}\n{broken\n{"reviewId":"2"}\n')
    rows, bad = split_bad(scan_records(spark, str(tmp_path / "lines.json"), GOOGLE_PLAY_RAW))
    assert {r["reviewId"] for r in rows.collect()} == {"1", "2"}
    assert [r[0] for r in bad.collect()] == ["{broken"]
    more = scan_json(spark, str(tmp_path / "array.json"), array_file=True, extra=True)
    assert more.columns == [*LABELED.names, "x"] and {r["x"] for r in more.collect()} == {None, 1}
    assert normalise_records(rows).where("rating = 5").select("reviewId").count() == 1


def test_landed_page_files(spark, tmp_path):
    for page, text in ((1, '{"feed":\n{}}'), (2, "oops")):
        folder = tmp_path / "app_id=007" / "country=tw" / f"page={page}"
        folder.mkdir(parents=True)
        (folder / "body.json").write_text(text)
    got = scan_page_files(spark, str(tmp_path))
    assert got.schema.simpleString() == FEED_PAGE.simpleString()
    assert {tuple(r) for r in got.collect()} == {("007", "tw", 1, '{"feed":\n{}}'), ("007", "tw", 2, "oops")}


def test_absent_sources(spark):
    assert source_or_empty(spark, UNIFIED, None).schema == UNIFIED
    assert source_or_empty(spark, UNIFIED, lambda: spark.read.json("/no/such/place")).isEmpty()
    rows = reviews(spark)
    assert source_or_empty(spark, UNIFIED, lambda: rows) is rows
    assert empty(spark, LABELED).columns == LABELED.names


def test_artefacts(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = spark.range(10).withColumn("split", F.when(F.col("id") < 8, "train").otherwise("test"))
    one, two = Artefacts(spark, root, "one"), Artefacts(spark, root, "two")
    one.store("t", rows)
    back = two.store("t", rows.limit(4))
    two.store("s", rows, "split")
    assert back.count() == 4
    assert {(r["artefact"], r["n_rows"]) for r in two.manifest().collect()} == {("t", 4), ("s", 10)}
    assert read_artefact(spark, root, "t").groupBy("run_id").count().count() == 2
    assert read_artefact(spark, root, "t", run_id="two").count() == 4
    files = rows_per_file(spark.read.json(two.path("s"))).collect()
    assert sum(r["n"] for r in files) == 10 and all("/split=" in r["file"] for r in files)
    with pytest.raises(ValueError, match="format"):
        one.store("x", rows, "xml")


def test_run_id():
    from datetime import datetime

    assert new_run_id(datetime(2025, 9, 19, 12, 0, 5)) == "20250919_120005"


def test_one_run_is_pruned(spark, tmp_path, plan_of):
    Artefacts(spark, str(tmp_path), "one").store("t", spark.range(3))
    plan = plan_of(read_artefact(spark, str(tmp_path), "t", run_id="one"), "formatted")
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_key_profile(spark):
    body = '{"feed":{"entry":[{"a":{"label":"x"},"b":1},{"a":null}],"n":2.5}}'
    df = spark.createDataFrame([(body,), ("oops",), (None,)], "body string")

    def keys(path):
        return {(r["key"], r["type"], r["n"]) for r in json_key_profile(df, "body", path).collect()}

    assert keys("$.feed.entry") == {("a", "OBJECT<label: STRING>", 1), ("b", "BIGINT", 1), ("a", "VOID", 1)}
    assert keys("$.feed.entry[0]") == {("a", "OBJECT<label: STRING>", 1), ("b", "BIGINT", 1)}
    assert {k for k, _, _ in keys("$.feed")} == {"entry", "n"} and keys("$.none") == set()


class Session:
    """What the scratch folder looks at, for settings a live session cannot take."""

    def __init__(self, master, **settings):
        self.settings = {"spark.master": master, **settings}
        self.folder = None
        self.conf = self.sparkContext = self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def setCheckpointDir(self, folder):
        self.folder = folder

    def getCheckpointDir(self):
        return self.folder


def test_scratch_root():
    shared = {"spark.checkpoint.dir": "s3://bucket/tmp/"}
    assert scratch.scratch_root(Session("yarn", **shared)) == "s3://bucket/tmp"
    assert scratch.scratch_root(Session("local[2]", **shared)) == "s3://bucket/tmp"
    local = Session("local[2]")
    assert scratch.scratch_root(local) == scratch.scratch_root(local) == local.folder
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session("yarn"))


def test_records_of_other_types_are_kept(spark, tmp_path):
    """The same rows whichever columns are read; a value of another type is NULL."""
    lines = ['{"reviewId":"1","score":"five"}', '{"reviewId":"2","score":4.0}', '{"reviewId":"3","score":5,"thumbsUpCount":99999999999}', '{"reviewId":4}']
    (tmp_path / "r.json").write_text("\n".join(lines))
    rows = scan_records(spark, str(tmp_path / "r.json"), GOOGLE_PLAY_RAW)
    assert rows.count() == rows.select("reviewId").count() == 4
    got = {r["reviewId"]: (r["score"], r["thumbsUpCount"]) for r in rows.collect()}
    assert got == {"1": (None, None), "2": (4, None), "3": (5, None), "4": (None, None)}


def test_a_local_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session("local-cluster[2,1,1024]"))


def test_order_survives_csv(spark, tmp_path):
    rows = spark.sql("SELECT 'a' AS reviewId, struct('f' AS source, 0L AS block, id AS row) AS src_order FROM range(3)")
    with_flat_order(rows).write.option("header", True).csv(str(tmp_path / "t_csv" / "run_id=1"))
    back = scan_table(spark, str(tmp_path / "t_csv" / "run_id=1"))
    assert {tuple(r["src_order"]) for r in back.collect()} == {("f", 0, k) for k in range(3)}
