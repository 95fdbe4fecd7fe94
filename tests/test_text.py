"""Text functions against Python's own, over every code point."""

import re
import sys
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.functions import text as tx
from gleanery.operators.prepare import prepare
from gleanery.params import CleaningParams

SURROGATES = range(0xD800, 0xE000)
ALL = [c for c in range(sys.maxunicode + 1) if c not in SURROGATES]
IN_EMOJI = {c for low, high in tx.EMOJI for c in range(low, high + 1)}
IN_CJK = {c for low, high in tx.CJK_IDEOGRAPHS for c in range(low, high + 1)}


def plain_clean(s, strip_emoji=True):
    s = unicodedata.normalize("NFKC", s.translate(str.maketrans(tx.FULL_WIDTH, tx.HALF_WIDTH)))
    if strip_emoji:
        s = "".join(c for c in s if ord(c) not in IN_EMOJI)
    return re.sub(r"\s+", " ", s).strip()


@pytest.fixture(scope="module")
def every_char(spark):
    """Each code point between two letters and on its own."""
    rows = [(c, f"x{chr(c)}y", chr(c)) for c in ALL]
    import pandas as pd

    frame = pd.DataFrame(rows, columns=["c", "inner", "alone"])
    return spark.createDataFrame(frame, "c int, inner string, alone string").repartition(4).persist()


def results(df, **columns):
    rows = df.select("c", *[e.alias(n) for n, e in columns.items()]).toPandas().set_index("c").loc[ALL]
    return {name: rows[name].tolist() for name in columns}


def test_full_width_table():
    assert len(tx.FULL_WIDTH) == len(tx.HALF_WIDTH) == 95
    for wide, narrow in zip(tx.FULL_WIDTH, tx.HALF_WIDTH):
        assert unicodedata.normalize("NFKC", wide) == narrow


def test_every_code_point(every_char):
    inner, alone = F.col("inner"), F.col("alone")
    got = results(
        every_char,
        strip=tx.strip_space(F.concat(alone, inner, alone)),
        fold=tx.fold_width(inner),
        nfkc=tx.compose_compat(inner),
        symbols=tx.strip_symbols(inner),
        squeeze=tx.squeeze_space(F.concat(inner, alone, inner, alone)),
        clean=tx.clean_text(inner),
        clean_kept=tx.clean_text(inner, strip_emoji=False),
        cjk=tx.script_count(inner),
        has=tx.has_script(F.concat(alone, inner, alone), 3),
    )
    table = str.maketrans(tx.FULL_WIDTH, tx.HALF_WIDTH)
    want = {
        "strip": lambda c, ch, mid: (ch + mid + ch).strip(),
        "fold": lambda c, ch, mid: mid.translate(table),
        "nfkc": lambda c, ch, mid: unicodedata.normalize("NFKC", mid),
        "symbols": lambda c, ch, mid: "xy" if c in IN_EMOJI else mid,
        "squeeze": lambda c, ch, mid: re.sub(r"\s+", " ", mid + ch + mid + ch).strip(),
        "clean": lambda c, ch, mid: plain_clean(mid),
        "clean_kept": lambda c, ch, mid: plain_clean(mid, False),
        "cjk": lambda c, ch, mid: int(c in IN_CJK),
        "has": lambda c, ch, mid: c in IN_CJK,
    }
    for name, values in got.items():
        expected = [want[name](c, chr(c), f"x{chr(c)}y") for c in ALL]
        wrong = [hex(c) for c, a, b in zip(ALL, values, expected) if a != b]
        assert not wrong, (name, wrong[:10])


def test_stable_characters_never_change():
    """None decomposes, none combines, none is the second half of a composite."""
    second = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    for c in ALL:
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            second.add(int(parts[1], 16))
    for low, high in tx.NFKC_STABLE:
        for c in range(low, high + 1):
            assert unicodedata.normalize("NFKC", chr(c)) == chr(c), hex(c)
            assert unicodedata.combining(chr(c)) == 0 and c not in second, hex(c)


ALPHABET = "ab的𠀀Ａ！　 \n\t  ‍️😀👨🇹🇼é́e①㈱ｱﾞ“”—가가"


def test_clean_on_random_texts(spark):
    texts = []

    @settings(max_examples=400, database=None, derandomize=True, suppress_health_check=list(HealthCheck))
    @given(st.text(alphabet=ALPHABET, max_size=30) | st.text(max_size=20))
    def collect(s):
        texts.append(s.encode("utf-8", "ignore").decode())

    collect()
    df = spark.createDataFrame([(s,) for s in texts], "s string").repartition(3)
    rows = df.select("s", tx.clean_text(F.col("s")), tx.clean_text(F.col("s"), False)).collect()
    for s, cleaned, kept in rows:
        assert cleaned == plain_clean(s)
        assert kept == plain_clean(s, False)
    again = [r[1] for r in rows if not any(unicodedata.combining(c) for c in unicodedata.normalize("NFD", r[0]))]
    again = [s for s in again if not any(0x1100 <= ord(c) < 0x1200 for c in s)]
    df = spark.createDataFrame([(s,) for s in again], "s string")
    assert all(a == b for a, b in df.select("s", tx.clean_text(F.col("s"))).collect())


@pytest.mark.parametrize(
    "text, want",
    [
        ("ｱ㈱①", "ア(株)1"),
        ("À la carte", "À la carte"),
        ("éte", "éte"),
        ("🇹🇼 flag", "flag"),
        ("👨‍👩‍👧家", "家"),
        ("❤️好", "好"),
        ("“好”—用", "好用"),
        ("Ａｐｐ　很好！！", "App 很好!!"),
    ],
)
def test_clean_examples(spark, text, want):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(tx.clean_text(F.col("s"))).first()[0] == want


def test_large_script_threshold(spark):
    df = spark.createDataFrame([("的" * 99 + "x",), ("的x" * 100,), (None,)], "s string")
    assert [r[0] for r in df.select(tx.has_script(F.col("s"), 100)).collect()] == [False, True, None]
    assert [r[0] for r in df.select(tx.has_script(F.col("s"), 0)).collect()] == [True, True, False]


def test_preview(spark):
    df = spark.createDataFrame([("𠀀" * 80,), ("a" * 81,), (None,)], "s string")
    got = [r[0] for r in df.select(tx.preview(F.col("s"))).collect()]
    assert got == ["𠀀" * 80, "a" * 80 + "...", ""]


def reviews(spark, *texts):
    rows = [(str(i), "p", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "reviewId string, platform string, content string")


def test_prepare_filters(spark):
    df = reviews(spark, "很好", " 　\n", None, "", "好 app", "ひらがな", "𠀀𠀀", "  很‍好  用 ")
    got = {r["reviewId"]: r["text"] for r in prepare(df).collect()}
    assert got == {"0": "很好", "6": "𠀀𠀀", "7": "很好 用"}
    got = prepare(df, CleaningParams(min_length=3)).collect()
    assert [(r["text"], r["primary"], r["secondary"]) for r in got] == [("很好 用", "", "")]
    latin = ((0x41, 0x5A), (0x61, 0x7A))
    assert [r["text"] for r in prepare(df, CleaningParams(script=latin)).collect()] == ["好 app"]
    assert prepare(df, CleaningParams(min_script_chars=0)).count() == 5


def test_prepare_plan(spark, plan_of, tmp_path):
    reviews(spark, "很好用", "ok").write.parquet(str(tmp_path / "r"))
    plan = plan_of(prepare(spark.read.parquet(str(tmp_path / "r"))), "formatted")
    assert plan.count("ArrowEvalPython") == 2  # once in the tree, once in its details
    assert "Not(EqualTo(content,))" in plan
    assert plan.count("regexp_replace") == 2 and "Exchange" not in plan


@pytest.mark.parametrize("bad", [{"min_length": -1}, {"min_script_chars": -1}])
def test_bounds(bad):
    with pytest.raises(ValueError):
        CleaningParams(**bad)
