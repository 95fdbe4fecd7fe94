"""Near copies against brute force over word sets, which shares no code with the operator."""

import itertools
import random
from fractions import Fraction

import numpy as np
import pytest

import corpus_pipeline
from gleanery.llm import near_copies


def similarity(a, b):
    return Fraction(len(a & b), len(a | b)) if a | b else Fraction(1)


def shingles(text, n=5):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def kept_by_brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if similarity(sets[i], sets[j]) >= Fraction(4, 5):
            root[find(i)] = find(j)
    groups = {}
    for i, (k, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(k)
    return sorted(min(g) for g in groups.values())


def planted(seed=5):
    """Chains and clusters of edited texts, texts that share half, short and blank ones."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    texts = [None, "", " \n", "One two", "one  TWO", "one two three"]
    for length in (40, 120, 400):
        for edits in (1, 2, 4, 8, 16):
            for _ in range(3):
                base = [word() for _ in range(length)]
                half = base[: length // 2] + [word() for _ in range(length // 2)]
                chain = list(base)
                texts += [" ".join(base), " ".join(half)]
                for _ in range(3):
                    for _ in range(edits):
                        chain[rng.randrange(length)] = word()
                    texts.append(" ".join(chain))
    one = [word() for _ in range(300)]
    for _ in range(60):  # one large group
        copy = list(one)
        for _ in range(rng.randrange(1, 9)):
            copy[rng.randrange(300)] = word()
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("crowded", [32, 4])
def test_stage_keeps_one_of_each_group(spark, monkeypatch, crowded):
    monkeypatch.setattr(near_copies, "CROWDED", crowded)
    rows = planted()
    df = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars int").repartition(5)
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, df, "")
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == kept_by_brute_force(rows)
    assert near_copies.keep_one(df.limit(0)).count() == 0


def test_threshold_is_met_exactly(spark):
    """Sets that share 8 of 10 and 7 of 9 shingles."""
    words = [f"w{i}" for i in range(20)]
    rows = [(0, " ".join(words[:13])), (1, " ".join(words[1:14])), (2, " ".join(w.upper() for w in words[:12]) + " x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = kept_by_brute_force(rows)
    assert similarity(shingles(rows[0][1]), shingles(rows[1][1])) == Fraction(4, 5) and want == [0]
    assert [r["doc_id"] for r in near_copies.keep_one(df).collect()] == want


def test_linked_fingerprints_are_compared(spark):
    """Near copies that share no band are met through equal or linked fingerprints, and compared exactly."""
    base = np.arange(100, dtype=np.int64)
    sets = {1: base, 2: base[:90], 3: base[5:], 4: base + 1000, 5: base + 2000, 6: base[:95]}
    fps = {1: 0, 2: 3, 3: 0, 4: 0, 5: 1 << 40, 6: -1}  # 4 is no copy, 6 is one that only a band would tell
    nodes = spark.createDataFrame([(k, len(v), [1000 * k + i for i in range(20)], fps[k]) for k, v in sets.items()], "node long, n int, bands array<long>, fp long")
    rows = [(k, v.tolist(), len(v), near_copies._marks(v).tolist()) for k, v in sets.items()]
    held = spark.createDataFrame(rows, "node long, shingles array<long>, n int, marks array<long>")
    found = near_copies.links(nodes, lambda wanted: held.join(wanted, "node")).collect()
    assert {frozenset((r["a"], r["b"])) for r in found} == {frozenset((1, 2)), frozenset((1, 3))}


def test_sketch_is_one_python_step(spark, plan_of):
    texts = [None, "", "a b", "One two three four five six", "one TWO\tthree four five\nsix", "x " * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = near_copies._sketched(df, "text", 5)
    assert plan_of(got).count("MapInArrow") == 1
    want = {r["doc_id"]: r["fp"] for r in near_copies.simhash.fingerprints(df, "text", "fp", 5).collect()}
    rows = {r["doc_id"]: r for r in got.collect()}
    assert {k: r["_fp"] for k, r in rows.items()} == want
    assert [rows[i]["_n"] for i in range(6)] == [0, 0, 1, 2, 2, 1]
    assert rows[3]["_node"] == rows[4]["_node"] and rows[3]["_bands"] == rows[4]["_bands"]
