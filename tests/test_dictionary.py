from pyspark.sql import functions as F

from gleanery.functions.labels import canonical_primary
from gleanery.operators.dictionary import resolve, with_canonical
from gleanery.schemas import PRIMARY_FALLBACK, PRIMARY_LABELS, PRIMARY_SPELLINGS


def table(spark, pairs):
    return spark.createDataFrame(pairs, "alias string, target string")


def test_equals_the_literal_map(spark):
    pairs = [(a, label) for label, forms in PRIMARY_SPELLINGS.items() for a in forms]
    found = resolve(table(spark, pairs))
    values = [" crash ", "ui", "Ux", "bug report", "slow", "n/a", "POSITIVE", "whatever", None, "", "ui/ux", "BUG"]
    rows = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "i int, raw string, primary string")
    got = with_canonical(rows, {"primary": found}, {"primary": PRIMARY_LABELS}, {"primary": PRIMARY_FALLBACK})
    assert got.columns == rows.columns and found.problems.isEmpty()
    assert got.filter(~F.col("primary").eqNullSafe(canonical_primary(F.col("raw")))).isEmpty() and got.count() == len(values)


def test_chains_cycles_and_conflicts(spark):
    pairs = [("a", "b"), ("b", "c c"), ("C_C", "BUG"), ("x", "y"), ("y", "z"), ("z", "x"), ("w", "x"), ("BUG", "bug"), (None, "q"), ("q", None)]
    pairs += [("k", "UI"), ("k", "BUG"), ("k", "bug ")]
    found = resolve(table(spark, pairs))
    assert {tuple(r) for r in found.entries.collect()} == {("A", "BUG"), ("B", "BUG"), ("C_C", "BUG"), ("K", "BUG")}
    problems = {(r["form"], r["problem"], tuple(r["meanings"])) for r in found.problems.collect()}
    assert problems == {("K", "conflict", ("BUG", "UI")), ("X", "cycle", ("Y",)), ("Y", "cycle", ("Z",)), ("Z", "cycle", ("X",)), ("W", "cycle", ("X",))}
    assert resolve(table(spark, [])).entries.isEmpty()


def test_a_million_entries(spark):
    """Chains of 64 among a million entries; a third of all rows hold one spelling."""
    n = 1_000_000
    entries = spark.range(n).select(F.concat(F.lit("f"), "id").alias("alias"), F.when(F.col("id") % 64 == 63, "BUG").otherwise(F.concat(F.lit("f"), F.col("id") + 1)).alias("target"))
    found = resolve(entries)
    assert found.entries.filter("meaning = 'BUG'").count() == n and found.problems.isEmpty()
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "f7").otherwise(F.concat(F.lit("F"), F.col("id") * 50)).alias("primary"))
    got = with_canonical(rows, {"primary": found}, {"primary": PRIMARY_LABELS}, {"primary": PRIMARY_FALLBACK})
    assert {tuple(r) for r in got.groupBy("primary").count().collect()} == {("BUG", 3 * 10_000 - sum(1 for i in range(30_000) if i % 3 and i * 50 >= n)), ("INVALID", sum(1 for i in range(30_000) if i % 3 and i * 50 >= n))}
