import json
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from gleanery.functions.labels import canonical_primary, canonical_secondary, choose_payload, parse_labels, strip_fence
from gleanery.operators.labeling import apply_responses, batch_payloads, label, rule_labels, split_pending
from gleanery.operators.ordering import with_dense_index
from gleanery.operators.validation import repair, validate, validation_report
from gleanery.params import LabelingParams, LabelRules
from gleanery.schemas import PRIMARY_LABELS, PRIMARY_SPELLINGS, SECONDARY_LABELS, SECONDARY_SPELLINGS

# The labelers below run on workers that cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUICK = LabelingParams(batch_size=7, max_retries=2, retry_delay=0, batch_pause=0, max_rounds=3)


def column(spark, values, function, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(function(F.col("v"))).collect()]


def test_canonical_labels(spark):
    for function, labels, spellings in (
        (canonical_primary, PRIMARY_LABELS, PRIMARY_SPELLINGS),
        (canonical_secondary, SECONDARY_LABELS, SECONDARY_SPELLINGS),
    ):
        want = {label: label for label in labels}
        want.update({s: label for label, forms in spellings.items() for s in forms})
        asked = [f"  {w.lower()}\n" for w in want]
        assert column(spark, asked, function) == list(want.values())
    assert column(spark, ["feature request", "Ui/Ux", "", None, "BUGS", "b u g"], canonical_primary) == [
        "FEATURE_REQUEST", "UI/UX", "INVALID", "INVALID", "INVALID", "INVALID"
    ]
    assert column(spark, ["credit card", "x", None], canonical_secondary) == ["CREDIT_CARD", "GENERAL", "GENERAL"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("[1]", "[1]"), ("  [1] ;  ", "[1]"), ("[1];;", "[1];"), ("```json\n[1]\n```", "[1]"), ("```\n[1]\n```\n```", "[1]"),
        ("```\n[1]\n\n```\n\n", "[1]"), ("```[1]```", ""), ("```", ""), ("```\n```", ""), ("```\n[1];\n```", "[1]"),
        ("[1]\n```", "[1]\n```"), ("", ""), ("```\n[1,\n2]", "[1,\n2]"), ("```\n[1]\n  ``` done", "[1]"),
    ],
)
def test_strip_fence(spark, text, want):
    assert column(spark, [text], strip_fence) == [want]


def test_parse_keeps_positions(spark):
    items = [{"primary": "a", "secondary": "b"}, {}, None, "x", {"primaryLabel": "c", "secondary_category": "d"}, {"primary": None, "primary_label": "e", "note": 1}, {"primary": 5}]
    got = column(spark, [json.dumps(items), "oops", '{"primary": "a"}', None, "[]"], parse_labels)
    assert [tuple(p) for p in got[0]] == [("a", "b"), (None, None), (None, None), (None, None), ("c", "d"), ("e", None), ("5", None)]
    assert got[1:] == [None, None, None, []]


def test_choose_payload(spark):
    df = spark.createDataFrame(
        [(" x ", ["y"]), (None, ["```\n```", "", "y;"]), ("```a```", []), ("", None)], "t string, parts array<string>"
    )
    assert [r[0] for r in df.select(choose_payload(F.col("t"), F.col("parts"))).collect()] == ["x", "y", None, None]


def test_payloads_and_dense_index(spark):
    df = spark.createDataFrame([(i, None if i == 3 else f'"{i}"\n') for i in range(25)], "id int, text string").repartition(5)
    rows = with_dense_index(df, ["id"])
    assert [(r["index"], r["id"]) for r in rows.orderBy("index").collect()] == [(i, i) for i in range(25)]
    got = {r["batch_id"]: (r["n"], json.loads(r["body"])) for r in batch_payloads(rows, 10).collect()}
    assert [got[b][0] for b in sorted(got)] == [10, 10, 5]
    assert got[0][1] == {"reviews": [{"text": "" if i == 3 else f'"{i}"\n'} for i in range(10)]}


def test_dense_index_of_copies(spark):
    df = spark.range(4000).select(F.lit("same").alias("k"), F.lit("copy").alias("text"))
    rows = with_dense_index(df, ["k"])
    got = rows.agg(F.count_distinct("index"), F.min("index"), F.max("index")).first()
    assert tuple(got) == (4000, 0, 3999)


def test_apply_responses(spark):
    rows = spark.createDataFrame([(b, p, f"{b}{p}") for b in range(4) for p in range(3)], "batch_id int, pos int, text string")
    answers = spark.createDataFrame(
        [
            (0, '[{"primary":"bug"},{},{"primary":"ui","secondary":"pay"}]'),
            (1, '```\n[{"primary":"slow"}]\n```'),
            (2, "sorry"),
        ],
        "batch_id int, body string",
    )
    got = {(r["batch_id"], r["pos"]): (r["primary"], r["secondary"]) for r in apply_responses(rows, answers).collect()}
    fallback = ("INVALID", "GENERAL")
    assert len(got) == 12
    assert got[0, 0] == ("BUG", "GENERAL") and got[0, 1] == fallback and got[0, 2] == ("UI/UX", "TRANSACTION")
    assert got[1, 0] == ("PERFORMANCE", "GENERAL") and got[1, 1] == got[2, 0] == got[3, 2] == fallback


def test_rules(spark):
    texts = ["App crash and slow", "介面很醜", "太慢了", "希望新增功能", "很好用", "???", "登入失敗", "信用卡帳單", "轉帳到信用卡", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    nature, area = rule_labels(F.col("t"))
    got = [tuple(r) for r in df.select(nature, area).collect()]
    assert [g[0] for g in got] == [
        "BUG", "UI/UX", "PERFORMANCE", "FEATURE_REQUEST", "POSITIVE", "INVALID", "BUG", "INVALID", "INVALID", "INVALID"
    ]
    assert [g[1] for g in got] == ["GENERAL"] * 6 + ["ACCOUNT", "CREDIT_CARD", "GENERAL", "GENERAL"]


def records(spark, n=40, parts=3):
    rows = [(i, f"t{i}", "POSITIVE" if i % 4 == 0 else ("" if i % 4 == 1 else None), None, i * 10) for i in range(n)]
    schema = "id int, text string, primary string, secondary string, extra int"
    return spark.createDataFrame(rows, schema).repartition(parts, "id")


def by_id(df):
    return {r["id"]: (r["primary"], r["secondary"]) for r in df.collect()}


def test_split_pending(spark):
    pending, done = split_pending(records(spark))
    assert (pending.count(), done.count()) == (30, 10)


def echo(batch):
    return pd.DataFrame({"primary": ["bug"] * len(batch), "secondary": ["login" if t.endswith("1") else "qr" for t in batch["text"]]})


@pytest.mark.parametrize("arrow_batch", [1, 5, 10000])
def test_label_only_pending_rows_in_full_batches(spark, arrow_batch):
    sizes = spark.sparkContext.accumulator([], _Join())

    def labeler(batch):
        assert list(batch.columns) == ["text"]
        sizes.add([len(batch)])
        return echo(batch)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", arrow_batch)
    try:
        out = label(records(spark, 100, 2), labeler, QUICK)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = by_id(out)
    assert out.columns == ["id", "text", "primary", "secondary", "extra"]
    for i in range(100):
        assert got[i] == (("POSITIVE", None) if i % 4 == 0 else ("BUG", "ACCOUNT" if str(i).endswith("1") else "TRANSACTION"))
    calls = sorted(sizes.value)
    assert sum(calls) == 75 and calls.count(7) >= len(calls) - 2 and max(calls) == 7
    out.count()
    assert sorted(sizes.value) == calls  # a later job does not call it again


def _Join():
    from pyspark.accumulators import AccumulatorParam

    class Join(AccumulatorParam):
        def zero(self, value):
            return []

        def addInPlace(self, a, b):
            return a + b

    return Join()


FALLBACK = ("INVALID", "GENERAL")


@pytest.mark.parametrize(
    "labeler, want",
    [
        (lambda b: echo(b).iloc[: len(b) // 2], {FALLBACK, ("BUG", "ACCOUNT"), ("BUG", "TRANSACTION")}),
        (lambda b: pd.concat([echo(b), echo(b)]), {("BUG", "ACCOUNT"), ("BUG", "TRANSACTION")}),
        (lambda b: pd.DataFrame(), {FALLBACK}),
        (lambda b: None, {FALLBACK}),
        (lambda b: 1 / 0, {FALLBACK}),
        (lambda b: pd.DataFrame({"primary": [1.5] * len(b)}), {FALLBACK}),
        (lambda b: pd.DataFrame({"secondary": ["cc"] * len(b)}, index=range(9, 9 + len(b))), {("INVALID", "CREDIT_CARD")}),
    ],
)
def test_odd_answers(spark, labeler, want):
    out = label(records(spark).filter("id % 4 <> 0"), labeler, QUICK)
    got = by_id(out)
    assert len(got) == 30 and set(got.values()) == want


def test_retries(spark):
    def third_time(box):
        def labeler(batch):
            box["n"] = box.get("n", 0) + 1
            if box["n"] % 3:
                raise OSError("busy")
            return echo(batch)

        return labeler

    rows = records(spark, 20, 1).filter("id % 4 <> 0").coalesce(1)
    assert FALLBACK not in by_id(label(rows, third_time({}), QUICK)).values()
    twice = LabelingParams(batch_size=100, max_retries=1, retry_delay=0, batch_pause=0)
    assert set(by_id(label(rows, third_time({}), twice)).values()) == {FALLBACK}


def test_waits():
    from gleanery.operators.labeling import batched

    waits = []

    def fails(batch):
        raise OSError

    run = batched(fails, LabelingParams(batch_size=2, max_retries=2, retry_delay=9), 0.3, waits.append)
    frames = [pd.DataFrame({"_wanted": [True, False, True], "text": ["a", "b", "c"]}), pd.DataFrame({"_wanted": [False, True], "text": ["d", "e"]})]
    assert [len(f) for f in run(iter(frames))] == [3, 2]
    assert waits == [9, 9, 0.3, 9, 9, 0.3]


def test_unknown_labeler(spark):
    with pytest.raises(ValueError, match="unknown labeler"):
        label(records(spark), "other")


def test_no_label_columns(spark):
    out = label(records(spark).drop("primary", "secondary"), "rules")
    assert set(by_id(out).values()) == {FALLBACK}


def test_validate(spark):
    rows = [
        (0, "BUG", "GENERAL", "ok"), (1, "bug", "GENERAL", "x" * 81), (2, None, "it's", None), (3, "BUG", 'a"b\n\\', "t"),
        (4, "BUG", "\u00a0x\u200b'\U000e0001\x07 😀é", "t"),
    ]
    df = spark.createDataFrame(rows, "index bigint, primary string, secondary string, text string")
    got = {r["index"]: r for r in validate(df).collect()}
    assert set(got) == {1, 2, 3, 4}
    for i in (1, 2, 3, 4):
        _, primary, secondary, text = rows[i]
        reasons = [f"{n} invalid: {v!r}" for n, v, ok in (("primary", primary, i >= 3), ("secondary", secondary, i == 1)) if not ok]
        assert got[i]["reasons"] == reasons and (got[i]["primary"], got[i]["secondary"]) == (primary, secondary)
    assert got[1]["text_preview"] == "x" * 80 + "..." and got[2]["text_preview"] == ""
    report = {r["reason"]: r["n"] for r in validation_report(validate(df)).collect()}
    assert report["primary invalid: 'bug'"] == 1 and len(report) == 5


def test_repair(spark):
    rows = [
        (1, "BUG", "GENERAL", "kept", None, None), (2, "x", "GENERAL", "t2", None, None), (3, None, None, "", "c1", None),
        (4, "", "", None, "", "r1"), (5, "x", "y", "", None, None),
    ]
    df = spark.createDataFrame(rows, "id int, primary string, secondary string, text string, content string, review string")
    seen = spark.sparkContext.accumulator([], _Join())

    def labeler(batch):
        seen.add(list(batch["text"]))
        return echo(batch)

    done = repair(df, labeler, QUICK)
    got = {r["id"]: (r["primary"], r["secondary"], r["text"]) for r in done.rows.collect()}
    assert got == {
        1: ("BUG", "GENERAL", "kept"), 2: ("BUG", "TRANSACTION", "t2"), 3: ("BUG", "ACCOUNT", "c1"),
        4: ("BUG", "ACCOUNT", "r1"), 5: ("INVALID", "GENERAL", ""),
    }
    assert sorted(seen.value) == ["c1", "r1", "t2"]  # once each, never the one without text
    assert [tuple(r) for r in done.rounds.collect()] == [(1, 4, 4, 3), (2, 0, 0, 0)]


def test_repair_of_rows_without_a_text_column(spark):
    df = spark.createDataFrame([(1, "BUG", "GENERAL", "a"), (2, "x", "y", "b1")], "id int, primary string, secondary string, review string")
    got = {r["id"]: (r["primary"], r["text"]) for r in repair(df, echo, QUICK).rows.collect()}
    assert got == {1: ("BUG", None), 2: ("BUG", "b1")}


def test_repair_stops(spark):
    df = spark.createDataFrame([(i, "x", "GENERAL", "t") for i in range(9)], "id int, primary string, secondary string, text string")

    def stubborn(batch):
        return pd.DataFrame({"primary": ["x"] * len(batch), "secondary": ["GENERAL"] * len(batch)})

    done = repair(df, stubborn, QUICK, sanitise=False)
    assert done.rounds.count() == QUICK.max_rounds
    assert [r["primary"] for r in done.rows.collect()] == ["x"] * 9
    assert set(by_id(repair(df, stubborn, QUICK).rows).values()) == {FALLBACK}


@pytest.mark.parametrize("bad", [{"batch_size": 0}, {"max_retries": -1}, {"retry_delay": -1}, {"max_rounds": 0}, {"batch_pause": -1}])
def test_bounds(bad):
    with pytest.raises(ValueError):
        LabelingParams(**bad)


def test_rule_labels_for_other_domains(spark):
    rules = LabelRules(nature=(("BUG", "kaputt"),), area=())
    df = spark.createDataFrame([("KAPUTT",), ("gut",)], "t string")
    nature, area = rule_labels(F.col("t"), rules)
    assert [tuple(r) for r in df.select(nature, area).collect()] == [("BUG", "GENERAL"), FALLBACK]
