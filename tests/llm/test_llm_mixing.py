"""The language model: counts by hand, tries by brute force, a proper distribution, held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import mixing

SF = "/root/testdata/sf0.001"


def small(monkeypatch, **values):
    for name, value in {"SLOT_BITS": 14, "SLICE_BITS": 12, **values}.items():
        monkeypatch.setattr(mixing, name, value)


def test_counts_and_base_by_hand(spark, monkeypatch):
    small(monkeypatch, RANGE_WORDS=40, FREQUENT=8)
    texts = {i: t for i, t in enumerate(["The cat. the CAT", None, "", "a\0b a\0b  x", "Ünï the", "the " * 300, "x" * 500, *[f"w{i % 9} the q{i}" for i in range(60)]])}
    rows = [(k, t, None if k % 2 else "en", 1) for k, t in texts.items()] + [(5, texts[5], "de", 1), (None, "the end", "en", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_known int").repartition(3)
    got = [r.asDict() for r in mixing.score(df).collect()]
    assert len(got) == len(rows)

    def tokens(t):
        words = [w for w in "".join(c.lower() if c.isascii() else c for c in t or "").replace("\n", " ").split(" ") if w]
        return [*words, "<end>"]

    out = {k: zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2 for k, *_ in rows}
    train = Counter(t for k, text, *_ in rows if not out[k] for t in tokens(text))
    total, types = sum(train.values()), len(train)
    for r in got:
        own = tokens(next(t for k, t, *_ in rows if k == r["doc_id"]))
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[r["doc_id"]], len(own), sum(t in train for t in own), total)
        assert math.isclose(r["base_score"], sum(math.log10((train[t] + 1) / (total + types + 1)) for t in own), rel_tol=1e-9)
        assert r["score"] < 0 and math.isfinite(r["bits_per_byte"])
    assert mixing.score(df.limit(0)).count() == 0
    alone = mixing.score(df.filter("doc_id = 2")).collect()  # nothing to learn from, or one empty text
    assert len(alone) == 1


def test_tries_count_every_beginning():
    rnd = np.random.default_rng(2)
    words = sorted({bytes(rnd.choice([1, 97, 98, 99, 255], rnd.integers(1, 22)).astype(np.uint8)) for _ in range(80)} | {b"a" * 70, b"a" * 71, b"\n"})
    counts = rnd.integers(0, 5, (2, len(words)))
    edges = mixing.Edges(mixing.Symbols(words))
    tries = mixing.Tries(edges, counts)
    bits = ["".join(f"{b:08b}" for b in w + b"\0") for w in words]
    flat = edges.own.flat
    for i in range(len(words)):
        for p in range(edges.own.sizes[i]):
            at = edges.own.starts[i] + p
            e = edges.edge[at]
            assert flat[edges.at[e]] == flat[at]
            same = [j for j in range(len(words)) if words[j][:p] + b"" == words[i][:p] and (words[j] + b"\0")[p] == (words[i] + b"\0")[p]]
            if p < mixing.COMMON:
                assert edges.own.word[edges.at[e]] == same[0]
                assert edges.weights(counts[0])[e] == counts[0][same].sum()
            if p < mixing.DEPTH:
                for bit in range(8):
                    stem = bits[i][: 8 * p + bit]
                    below = [j for j in range(len(words)) if bits[j].startswith(stem)]
                    ones = [j for j in below if bits[j][len(stem)] == "1"]
                    for kind, own in enumerate((*counts, counts.sum(axis=0))):
                        assert (tries.zeros[kind, bit, e], tries.ones[kind, bit, e]) == (own[below].sum() - own[ones].sum(), own[ones].sum())


def test_code_lengths_are_a_distribution(monkeypatch):
    """Over all words of one byte, and all longer ones: chances of what may follow add up to 1."""
    words = sorted([b"a", b"b", b"ab", b"ba", b"\n", *(bytes([i]) for i in range(1, 256) if i not in (9, 10, 11, 12, 13, 32, 97, 98))])
    counts = np.zeros((mixing.KINDS, len(words)), np.int64)
    counts[0, words.index(b"ab")], counts[0, words.index(b"a")] = 5, 3
    edges = mixing.Edges(mixing.Symbols(words))
    tables = np.zeros((len(mixing.ORDERS), 1 << 14, 2), np.float32)
    kept = [i for i in range(len(words)) if counts[0, i]]
    mixing.count_contexts([words[i] for i in kept], counts[0, kept], 0, tables)
    mixer, tries = mixing.Mixer(tables), mixing.Tries(edges, counts)
    weights = edges.weights(counts[0])
    mixer.learn(edges, tries, 0, weights, np.flatnonzero(weights))
    chance = 2.0 ** -mixer.bits_of(edges, tries, 0)
    assert chance.sum() < 1 and chance[words.index(b"ab")] > 10 * chance[words.index(b"ba")]


@pytest.mark.parametrize("words", [500, 1 << 20])
def test_ranges_of_any_size_see_whole_counts(spark, monkeypatch, words):
    """What is learnt may differ with the ranges; what is counted may not."""
    small(monkeypatch, RANGE_WORDS=words)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counted = mixing.written(mixing.word_counts(docs, mixing._kind(docs, mixing._training(F.col("doc_id")), "lang")), "words")
    n = max(1, -(-counted.count() // words))
    ranges = mixing.written(counted.repartitionByRange(n, "word").withColumn("part", F.spark_partition_id()), "ranges")
    rows = sorted(((bytes(r["word"]), *[r[c] for c in mixing._COUNTS]) for r in ranges.collect()))
    whole = {}
    for word, *c in rows:
        for p in range(min(len(word) + 1, mixing.DEPTH)):
            whole.setdefault((word + b"\0")[: p + 1], np.zeros(mixing.KINDS, int))
            whole[(word + b"\0")[: p + 1]] += c
    shared = mixing._shared(ranges).collect()
    assert len({r["part"] for r in shared}) == ranges.select("part").distinct().count() > (1 if words == 500 else 0)
    seen = 0
    for r in shared:
        key = bytes(r["key"])
        if key[0] % 8 == 0 and key[0]:  # a whole number of symbols
            beginning = int.from_bytes(key[1:]).to_bytes(mixing.DEPTH)[-(key[0] // 8) :]
            assert np.allclose(np.reshape(r["counts"], (2, -1)).sum(axis=0)[:-1], whole[beginning])
            seen += 1
    assert seen


def test_held_out_gain_and_no_peeking(spark, monkeypatch):
    """Held-out texts score better than by the add-one unigram with room to learn from, and change nothing about other scores."""
    small(monkeypatch, SLOT_BITS=18, SLICE_BITS=15)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first = {r["doc_id"]: r for r in mixing.score(docs).collect()}
    held = [r for r in first.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    changed = docs.withColumn("text", F.when(mixing._training(F.col("doc_id")), F.col("text")).otherwise(F.lit("the other the")))
    changed = changed.withColumn("lang", F.when(mixing._training(F.col("doc_id")), F.col("lang")))
    again = {r["doc_id"]: r for r in mixing.score(changed).collect()}
    assert all(again[k]["base_score"] == pytest.approx(r["base_score"]) and again[k]["train_tokens"] == r["train_tokens"] for k, r in first.items() if not r["held_out"])


def test_batches_for_python_are_bounded(spark, monkeypatch):
    small(monkeypatch)
    setting, stored, seen = "spark.sql.execution.arrow.maxBytesPerBatch", mixing.written, []
    monkeypatch.setattr(mixing, "written", lambda *a, **k: seen.append(spark.conf.get(setting, None)) or stored(*a, **k))
    before = spark.conf.get(setting, None)
    df = spark.createDataFrame([(i, f"the w{i}", "en") for i in range(9)], "doc_id long, text string, lang string")
    assert mixing.score(df).count() == 9
    assert len(seen) > 3 and set(seen) == {str(4 << 20)}
    assert spark.conf.get(setting, None) == before


def test_bytes_before_symbols_are_gathered_once_for_all_kinds(monkeypatch):
    calls, before = [], mixing.Symbols.before
    monkeypatch.setattr(mixing.Symbols, "before", lambda self, at: (calls.append(len(at)), before(self, at))[1])
    names = sorted({b"%d" % i for i in range(300)})
    counts = np.ones((mixing.KINDS, len(names)), np.int64)
    edges = mixing.Edges(mixing.Symbols(names))
    mixer, tries = mixing.Mixer(np.zeros((len(mixing.ORDERS), 1 << 10, 2), np.float32)), mixing.Tries(edges, counts)
    for kind in range(mixing.KINDS):
        mixer.learn(edges, tries, kind, edges.weights(counts[kind]), np.arange(len(edges.at)))
        mixer.bits_of(edges, tries, kind)
    assert calls == [len(edges.at)]


@pytest.mark.parametrize("values", [{}, {"PART_TOKENS": 150, "HOT": 20, "FREQUENT": 5}, {"PART_TOKENS": 150, "FREQUENT": 0}])
def test_words_are_scored_after_the_word_before_them(spark, monkeypatch, values):
    """Chances by hand, from the bits of each word and the training counts of neighbours, with parts and hot words or without."""
    small(monkeypatch, RANGE_WORDS=40, **values)
    rnd, stored, seen = np.random.default_rng(3), mixing.written, {}

    def kept(rows, name, *a, **k):
        out = stored(rows, name, *a, **k)
        if name == "scored":
            seen.update((r["hash"], r.asDict()) for r in out.collect())
        return out

    monkeypatch.setattr(mixing, "written", kept)
    texts = [" ".join(f"w{int(i)}" for i in rnd.zipf(1.4, rnd.integers(0, 40)) % 60) for _ in range(60)]
    texts += [None, "", "one rare sentence of few words", "one rare sentence of few words", "words few of sentence rare one", texts[0], texts[1]]
    rows = [(i, t, "en" if i % 3 else "de") for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in mixing.score(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)).collect()}
    tokens = {i: [w.encode() for w in (t or "").split()] + [b"\n"] for i, t, _ in rows}
    trains = [r for r in rows if not got[r[0]]["held_out"]]
    pairs = Counter(p for i, *_ in trains for p in zip([b"\n", *tokens[i]], tokens[i], strict=False))
    before, followers = Counter(), Counter(u for u, _ in pairs)
    for (u, _), n in pairs.items():
        before[u] += n
    once, twice = (sum(n == k for n in pairs.values()) for k in (1, 2))
    discount = once / (once + 2 * twice)
    names = sorted({w for own in tokens.values() for w in own})
    bits = {w: seen[h] for w, h in zip(names, mixing.hashes_of(names).view(np.int64).tolist(), strict=True)}
    assert 0 < discount < 1 and max(before.values()) > 40
    for i, *_ in rows:
        of_kinds = []
        for kind, lang in enumerate(sorted({k for *_, k in trains}, key=lambda k: (-sum(r[2] == k for r in trains), k))):
            chance = sum(r[2] == lang for r in trains) / len(trains)
            for u, w in zip([b"\n", *tokens[i]], tokens[i], strict=False):
                alone = 2.0 ** -bits[w][f"bits{kind}"]
                chance *= (max(pairs[u, w] - discount, 0) + discount * followers[u] * alone) / before[u] if before[u] else alone
            of_kinds.append(chance)
        assert got[i]["score"] == pytest.approx(math.log10(sum(of_kinds)), rel=1e-6)
    same, turned = len(texts) - 5, len(texts) - 3  # equal words, another order
    assert got[same]["base_score"] == pytest.approx(got[turned]["base_score"]) and abs(got[same]["score"] - got[turned]["score"]) > 0.1


def test_chances_after_a_word_are_a_distribution():
    rnd = np.random.default_rng(4)
    alone = rnd.dirichlet(np.ones(50))
    counts = rnd.integers(0, 4, 50)
    for discount in (0.05, 0.7, 1.0):
        after = mixing.follow(counts, np.full(50, counts.sum()), np.full(50, (counts > 0).sum()), discount)(-np.log2(alone))
        assert (2.0**after).sum() == pytest.approx(1)
    nothing = np.zeros(50, np.int64)
    assert np.allclose(mixing.follow(nothing, nothing, nothing, 0.7)(-np.log2(alone)), np.log2(alone))
    assert np.isfinite(mixing.follow(nothing[:1], np.ones(1), np.ones(1), 0.7)(np.full(1, 1e5))).all()


def test_words_are_what_bytes_split_gives():
    import pyarrow as pa

    texts = [None, "", " ", "\n a\tB\x0bc\x0cD\r ", "a\0b \0 x", "Ünï\u00a0the\u2003\x1cX\x85y", "ÀÉ the THE", "end"]
    names, places, sizes = mixing.numbered_words(pa.array(texts))
    want = [[w.replace(b"\0", b" ") for w in (t or "").encode().lower().split()] + [b"\n"] for t in texts]
    assert [names[p] for p in places] == [w for of_text in want for w in of_text] and sizes.tolist() == list(map(len, want))
    assert len(set(names)) == len(names)
