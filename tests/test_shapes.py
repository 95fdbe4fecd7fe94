"""Shapes of JSON bodies."""

import json

from gleanery.sources.shapes import shape_counts, shape_profile


def profile(spark, bodies):
    rows = spark.createDataFrame([(b,) for b in bodies], "body string").repartition(3)
    return {r["path"]: tuple(r)[1:] for r in shape_profile(rows, "body").collect()}


def test_paths_types_and_counts(spark):
    bodies = [
        json.dumps({"a": 1, "b": {"c": None, "d": [1, 2.5, None]}, "x.y": "t"}),
        json.dumps({"a": 2.0, "b": {"d": []}}),
        json.dumps({"a": None, "b": [{"k": True}, {"k": "t"}, {}]}),
        "oops", '{"a": NaN}', None, "", "[" * 100_000, "7",
    ]
    assert profile(spark, bodies) == {
        "$": ("mixed", 4, 0, 5),
        "$.a": ("double", 3, 1, 0),
        "$.b": ("mixed", 3, 0, 0),
        "$.b.c": ("null", 1, 1, 1),
        "$.b.d": ("array", 2, 0, 0),
        "$.b.d[]": ("double", 3, 1, 0),
        "$.b[]": ("object", 3, 0, 0),
        "$.b[].k": ("mixed", 2, 0, 1),
        '$["x.y"]': ("string", 1, 0, 2),
    }


def test_nothing_to_read(spark):
    assert profile(spark, []) == {}
    assert profile(spark, [None]) == {"$": (None, 0, 0, 1)}


def test_keys_made_of_data(spark):
    rows = spark.range(60_000).selectExpr("concat('{\"k', id, '\": {\"v\": ', id, '}}') AS body").coalesce(1)
    counts = shape_counts(rows, "body")
    assert counts.count() == 120_001
    assert counts.filter("path = '$' AND n = 60000").count() == 1


def test_depth(spark):
    body = "1"
    for _ in range(200):
        body = json.dumps({"k": json.loads(body)})
    found = profile(spark, [body, body])
    assert len(found) == 201 and found["$" + ".k" * 200] == ("integer", 2, 0, 0)
