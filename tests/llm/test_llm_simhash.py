"""Fingerprints, links and components against brute force."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from gleanery.llm import simhash
from gleanery.llm.components import components
from gleanery.sources.scratch import written


def plain_fingerprint(text, words=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, distance=2):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= distance:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


TEXTS = [None, "", " \n\t", "one", "one two", "One TWO", "ÀÉ one two three", "àé one two three", "a b c d e", *("x y z " * 40 + str(i % 3) for i in range(9)), "w " * 20000]


def test_near_duplicates(spark):
    rows = [(i if i != 4 else None, t, 1, 2) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int, key int")
    got = simhash.near_duplicates(df).collect()
    fps = [plain_fingerprint(t) for t in TEXTS]
    roots = plain_components(fps)
    assert len(got) == len(TEXTS)
    for r in got:
        i = 4 if r["doc_id"] is None else r["doc_id"]
        assert r["fingerprint"] == f"{fps[i]:016x}"
        members = [j for j in range(len(TEXTS)) if roots[j] == roots[i] and j != 4]
        assert r["component_id"] == (min(members) if members else None)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    want = sorted(min((j for j in range(len(TEXTS)) if roots[j] == c), key=lambda j: (j == 4, j)) for c in set(roots))
    assert sorted(4 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == want
    assert simhash.near_duplicates(df.limit(0)).count() == simhash.keep_one(df.limit(0)).count() == 0
    twice = df.filter("doc_id = 3").unionByName(df.filter("doc_id = 3"))
    assert simhash.near_duplicates(twice).count() == 2 and simhash.keep_one(twice).count() == 1


@pytest.mark.parametrize("crowded", [128, 4])
def test_links_connect_as_brute_force_does(spark, monkeypatch, crowded):
    """Chains, clusters that share nearly all bits, and skewed bits, with and without crowded values."""
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(5)
    fps = set()
    for _ in range(25):
        seed = rng.getrandbits(64) & ((1 << 64) - 1 ^ 0xFFFF)
        for _ in range(12):
            fps.add(seed)
            seed ^= 1 << rng.randrange(64) | 1 << rng.randrange(64) if rng.random() < 0.8 else 0b111 << rng.randrange(60)
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    nodes = written(spark.createDataFrame([(f,) for f in signed], "fp long").repartition(5), "test-nodes")
    edges = simhash.links(nodes)
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 2 for r in edges.collect())
    found = {r.node: r.root for r in components(edges).collect()}
    groups = {}
    for f, s in zip(fps, signed, strict=True):
        groups.setdefault(found.get(s, s), set()).add(f)
    want = {}
    for f, c in zip(fps, plain_components(fps), strict=True):
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_thresholds_are_the_cheapest():
    spend = np.random.default_rng(3).integers(0, 50, (40, 4, 4)).astype(float)
    spend[:, :, 0] = 0
    thresholds, cost = simhash.allocate(spend)
    for row in range(40):
        options = [c for c in itertools.product(range(4), repeat=4) if sum(c) == 3]
        assert cost[row] == min(sum(spend[row, i, c] for i, c in enumerate(o)) for o in options)
        assert cost[row] == sum(spend[row, i, t + 1] for i, t in enumerate(thresholds[row])) and (thresholds[row] + 1).sum() == 3


def test_correlated_bits_share_a_part():
    fps = np.random.default_rng(4).integers(0, 1 << 62, 4000, np.int64)
    bits = simhash._bits(fps)
    for i in range(8):
        bits[:, 3 + 7 * i] = bits[:, 3]
    both = bits.astype(int).T @ bits.astype(int)
    groups = simhash.group_bits(len(fps), both, 3)
    assert sorted(b for g in groups for b in g) == list(range(64)) and {len(g) for g in groups} <= {21, 22}
    assert any({3 + 7 * i for i in range(8)} <= set(g) for g in groups)


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 302), (302, 300)]
    names = list(range(400))
    rng.shuffle(names)
    named = [(names[a], names[b]) for a, b in edges]
    got = {r.node: r.root for r in components(spark.createDataFrame(named, "a long, b long")).collect()}
    for part in (range(41), range(100, 160), range(300, 303)):
        members = [names[i] for i in part]
        assert {got[m] for m in members} == {min(members)}
    assert names[200] not in got and components(spark.createDataFrame([], "a long, b long")).count() == 0
