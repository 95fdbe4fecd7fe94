import json
import random

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from gleanery.schemas import LABELED
from gleanery.sources.ranges import csv_step, json_step, scan_csv_split, scan_json_split
from gleanery.sources.readers import scan_csv, scan_json, split_bad

PIECES = ["plain", 'a "quoted" word', "two\nlines", "cr\r\nlf", " padded ", "x,y", '"', '""', '"\n"', '\n,"', "", "é，", 'end"', "\n\n", "'", '5" wide']


def quoted(value: str) -> str:
    return '"' + value.replace('"', '""') + '"' if any(c in value for c in '",\n\r') else value


@pytest.fixture
def blocks(spark):
    """Blocks of a few bytes, so that every kind of place is a block's edge."""

    def set_size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_size
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def in_order(rows):
    return [tuple(r)[:-1] for r in rows.orderBy("src_order").collect()]


@pytest.mark.parametrize(("size", "line_end"), [(47, "\n"), (61, "\r\n"), (400, "\n")])
def test_csv_equals_one_task(spark, tmp_path, blocks, size, line_end):
    rnd = random.Random(size)
    for name, bom in (("a.csv", "\ufeff"), ("b.csv", "")):
        lines = ["id,text,other"] + [",".join([str(i), quoted(rnd.choice(PIECES) + rnd.choice(PIECES)), quoted(rnd.choice(PIECES))]) for i in range(24)]
        lines += ['900,5" wide,6" high', '901,"closed"junk,x', "902", ""]
        (tmp_path / name).write_bytes((bom + line_end.join(lines) + line_end).encode())
    want = in_order(scan_csv(spark, str(tmp_path)))
    blocks(size)
    got = in_order(scan_csv_split(spark, str(tmp_path)))
    assert len(want) == 54 and any("\r\n" in r[1] for r in got)

    # Where a file's lines end in CR LF, the one-task reader drops the CR in fields too.
    def plain(rows):
        return [tuple(v and v.replace("\r\n", "\n") for v in r) for r in rows]

    assert plain(got) == plain(want)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 3


def test_csv_types_and_edges(spark, tmp_path, blocks):
    (tmp_path / "long.csv").write_text('id,text\n1,"' + "line\n" * 200 + '"\n2,x\n3,"open\nend')
    blocks(40)
    schema = StructType([StructField("text", StringType())])
    rows = scan_csv_split(spark, str(tmp_path / "long.csv"), schema)
    assert [r["text"] for r in rows.orderBy("src_order").collect()] == ["line\n" * 200, "x", "open\nend"]
    with pytest.raises(ValueError, match="none"):
        scan_csv_split(spark, str(tmp_path), StructType([StructField("none", StringType())]))
    (tmp_path / "empty.csv").write_text("id,text\n")
    assert scan_csv_split(spark, str(tmp_path / "empty.csv")).count() == 0


def test_steps():
    assert csv_step('a,"b', False) == (True, 0) and csv_step('b",c', True) == (False, 0)
    assert csv_step('"a""', False) == (True, 0) and csv_step('a"b,c', False) == (False, 0)
    assert csv_step('x"" y', True) == (True, 0) and csv_step('"","', False) == (True, 0)
    assert json_step('{"a": "}', False) == (True, 1) and json_step('\\" { }', True) == (True, 0)
    assert json_step('x", [{}', True) == (False, 1) and json_step("}", False) == (False, -1)


@pytest.mark.parametrize(("indent", "size"), [(None, 90), (2, 400)])
def test_json_equals_one_task(spark, tmp_path, blocks, indent, size):
    rnd = random.Random(7)
    odd = ['}{"', "[1,", '\\"}', "\n}", 'a\\', "é", ""]
    items = [{"reviewId": str(i), "text": rnd.choice(odd) + rnd.choice(odd), "primary": rnd.choice([None, "BUG"]), "x": {"y": [{"z": "}"}]}} for i in range(30)]
    for name in ("a.json", "b.json"):
        (tmp_path / name).write_text(json.dumps(items, indent=indent, ensure_ascii=False))
    (tmp_path / "none.json").write_text("[]\n")
    want = sorted(map(str, scan_json(spark, str(tmp_path), LABELED, array_file=True).collect()))
    blocks(size)
    rows, bad = split_bad(scan_json_split(spark, str(tmp_path), LABELED))
    assert sorted(map(str, rows.collect())) == want and len(want) == 60 and bad.count() == 0


def test_json_keeps_bad_elements(spark, tmp_path):
    (tmp_path / "a.json").write_text('[null, {"text": "a"}, 5, "{", [1, 2], {"text": }, {"text": "b"}, 7]')
    rows, bad = split_bad(scan_json_split(spark, str(tmp_path), LABELED, ordered=True))
    assert sorted(r["text"] for r in rows.collect()) == ["a", "b"]
    assert sorted(r[0] for r in bad.collect()) == ['"{"', "5", "7", "[1, 2]", "null", '{"text": }']
