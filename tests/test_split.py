import hashlib
import math
from collections import Counter
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanery.operators.ordering import first_n, top_recent
from gleanery.operators.split import split_counts, split_quotas, stratified_split
from gleanery.params import SplitParams


def table(spark, sizes, offset=0):
    rows, n = [], offset
    for name, size in sizes.items():
        rows += [(f"id{n + k}", name) for k in range(size)]
        n += size
    return spark.createDataFrame(rows, "id string, primary string")


def quotas(sizes, test_size):
    total = sum(sizes.values())
    train = total - math.ceil(test_size * total)
    shares = {k: n / total * train for k, n in sizes.items()}
    out = {k: math.floor(s) for k, s in shares.items()}
    order = sorted(sizes, key=lambda k: (math.floor(shares[k]) - shares[k], k))
    for k in order[: train - sum(out.values())]:
        out[k] += 1
    return out


def assigned(df, **params):
    return {r["id"]: (r["primary"], r["split"]) for r in stratified_split(df, "id", SplitParams(**params)).collect()}


@pytest.mark.parametrize(
    "sizes, test_size",
    [
        ({"A": 97, "B": 41, "C": 7, "D": 2}, 0.2),
        ({"A": 10, "B": 10, "C": 10}, 0.25),  # tied remainders
        ({"A": 300, "B": 3}, 0.5),
        ({"A": 11}, 0.2),
        ({"x": 4, "y": 4, "": 4}, 0.7),
    ],
)
def test_split_is_exact_whole_and_repeatable(spark, sizes, test_size):
    df = table(spark, sizes)
    got = assigned(df.repartition(1), test_size=test_size)
    assert len(got) == sum(sizes.values())
    train = Counter(p for p, s in got.values() if s == "train")
    want = quotas(sizes, test_size)
    assert {k: train.get(k, 0) for k in sizes} == want
    assert got == assigned(df.repartition(7), test_size=test_size)
    listed = {r["primary"]: (r["n"], r["n_train"], r["n_test"]) for r in split_quotas(df, SplitParams(test_size=test_size)).collect()}
    assert listed == {k: (n, want[k], n - want[k]) for k, n in sizes.items()}
    for name in sizes:
        ids = sorted((i for i, (p, _) in got.items() if p == name), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
        assert all(got[i][1] == "test" for i in ids[: sizes[name] - want[name]])


def test_seed_changes_the_rows_but_not_the_counts(spark):
    df = table(spark, {"A": 60, "B": 40})
    one, two = assigned(df), assigned(df, seed=7)
    assert one != two and Counter(one.values()) == Counter(two.values())


def test_null_and_empty_ids(spark):
    df = spark.createDataFrame([(None, "A"), ("", "A"), ("x", "A"), ("y", "A")], "id string, primary string")
    for seed in range(6):
        counts = {r["split"]: r["n"] for r in split_counts(stratified_split(df, "id", SplitParams(test_size=0.5, seed=seed))).collect()}
        assert counts == {"train": 2, "test": 2}


def test_rows_of_one_id_stay_together(spark):
    df = spark.range(300).select(F.when(F.col("id") < 100, "hot").otherwise(F.col("id").cast("string")).alias("id"), F.lit("A").alias("primary"))
    for seed in range(4):
        rows = stratified_split(df, "id", SplitParams(seed=seed)).groupBy("id").agg(F.count_distinct("split").alias("sides"), F.count("*").alias("n")).collect()
        assert {r["sides"] for r in rows} == {1} and sum(r["n"] for r in rows) == 300


def test_numeric_ids_and_other_column(spark):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("kind"), F.lit("x").alias("text"))
    out = stratified_split(df, "id", SplitParams(by="kind"))
    assert out.columns == ["id", "kind", "text", "split"]
    assert {(r["split"], r["kind"], r["n"]) for r in split_counts(out, "kind").collect()} == {("train", 0, 40), ("train", 1, 40), ("test", 0, 10), ("test", 1, 10)}


@pytest.mark.parametrize(
    "sizes, message",
    [({}, "empty"), ({"A": 9, None: 3}, "null"), ({"A": 9, "B": 1}, "two rows"), ({"A": 2, "B": 2, "C": 2}, "too few")],
)
def test_refused(spark, sizes, message):
    with pytest.raises(ValueError, match=message):
        stratified_split(table(spark, sizes), "id")


def test_missing_column(spark):
    with pytest.raises(ValueError, match="not in the table"):
        stratified_split(table(spark, {"A": 9}), "id", SplitParams(by="secondary"))


def test_small_class_to_train(spark):
    got = assigned(table(spark, {"A": 9, "B": 1}), on_small_class="train")
    assert Counter(got.values()) == {("A", "train"): 7, ("A", "test"): 2, ("B", "train"): 1}
    assert set(assigned(table(spark, {"A": 1, "B": 1}), on_small_class="train").values()) == {("A", "train"), ("B", "train")}


@pytest.mark.parametrize("bad", [{"test_size": 0.0}, {"test_size": 1.0}, {"on_small_class": "drop"}])
def test_bounds(bad):
    with pytest.raises(ValueError):
        SplitParams(**bad)


def test_rows_are_not_shuffled(spark, plan_of, tmp_path):
    table(spark, {"A": 90, "B": 10}).write.parquet(str(tmp_path / "t"))
    plan = plan_of(stratified_split(spark.read.parquet(str(tmp_path / "t")), "id"))
    assert "BroadcastHashJoin" in plan and "Window" not in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("n", [1, 3, 50, 1000])
def test_top_recent(spark, n):
    df = spark.range(600).select(F.when(F.col("id") % 3 < 2, "hot").otherwise("cold").alias("g"), (F.col("id") % 100).alias("day"), "id")
    got = {}
    for r in top_recent(df, n, "g", [F.desc("day"), F.asc("id")], spread=4).collect():
        got.setdefault(r["g"], set()).add(r["id"])
    for name, rest in (("hot", (0, 1)), ("cold", (2,))):
        ids = sorted((i for i in range(600) if i % 3 in rest), key=lambda i: (-(i % 100), i))
        assert got[name] == set(ids[:n])


def test_top_recent_cuts_before_the_shuffle(spark, plan_of):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), "id")
    plan = plan_of(top_recent(df, 5, "g", [F.desc("id")]))
    assert "WindowGroupLimit" in plan[plan.rindex("Exchange hashpartitioning") :]


@pytest.mark.parametrize("n", [1, 7, 40, 250, 1000])
def test_first_n_of_any_size(spark, n):
    """Ties, copies, NULLs and NaN in groups and values, against a sort of each group."""
    rows = [(("hot", "cold", None)[i % 7 % 3], None if i % 11 == 0 else i % 5, float("nan") if i % 13 == 0 else None if i % 17 == 0 else float(i % 4), i % 6) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, day int, score double, _hash int").repartition(5)
    found = Counter((r["g"], r["day"], repr(r["score"]), r["_hash"]) for r in first_n(df, n, "g", [("day", True), ("score", False)]).collect())
    whole = Counter((g, d, repr(s), h) for g, d, s, h in rows)

    def place(row):
        day, score = row[1], row[2]
        return (day is None, -(day or 0), score == "None", score == "nan", 0.0 if score in ("None", "nan") else float(score))

    for group in ("hot", "cold", None):
        mine = sorted((r for r in whole.elements() if r[0] == group), key=place)
        got = sorted((r for r in found.elements() if r[0] == group), key=place)
        assert [place(r) for r in got] == [place(r) for r in mine[:n]]
    assert not found - whole


def test_first_n_of_a_million(spark, tmp_path):
    spark.range(1_500_000).selectExpr("'one' AS g", "id DIV 3 AS v", "id").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    out = first_n(df, 1_000_001, "g", [("v", True)])
    assert out.agg(F.count("*"), F.min("v"), F.countDistinct("id")).first()[:] == (1_000_001, 166_666, 1_000_001)


def test_first_n_of_copies_and_of_none(spark):
    df = spark.createDataFrame([("g", 1)] * 50 + [("g", 0)] * 3, "g string, v int")
    assert first_n(df, 20, "g", [("v", False)]).groupBy("v").count().orderBy("v").collect() == [(0, 3), (1, 17)]
    assert first_n(df, 0, "g", [("v", False)]).isEmpty() and first_n(df.limit(0), 5, "g", [("v", False)]).isEmpty()
