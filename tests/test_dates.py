from datetime import datetime

from pyspark.sql import functions as F

from gleanery.functions.dates import wall_clock

READABLE = [
    "2025-09-18T10:00:00-07:00", "2025-09-18T10:00:00Z", "2025-09-18T10:00:00+08:00", "2025-09-18T10:00:00.123456+00:00",
    "2025-09-18 23:59:59", "2025-09-18T07:30", "2025-09-18T07", "2025-09-18", "2024-02-29", "2025-09-18T10:00:00-0700",
    "2025-03-09T02:30:00", "0001-01-01T00:00:00",
]
UNREADABLE = ["", "x", "2025-02-30", "2025-13-01", "2025-09-18T25:00:00", "2025-09-18T10:61:00", "18/09/2025", "2025-9-1", "2025", "2025-09-18T10:00:00 PM"]


def test_clock_is_kept(spark):
    df = spark.createDataFrame([(s,) for s in READABLE], "s string")
    for text, got in df.select("s", wall_clock(F.col("s"))).collect():
        want = datetime.fromisoformat(text.replace("Z", "+00:00")).replace(tzinfo=None)
        assert got == want.isoformat(" ", "seconds"), text


def test_unreadable_is_null(spark):
    df = spark.createDataFrame([(s,) for s in [*UNREADABLE, None]], "s string")
    assert {r[0] for r in df.select(wall_clock(F.col("s"))).collect()} == {None}
