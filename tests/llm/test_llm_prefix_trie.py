"""Prefix tries against plain dictionaries; the query itself against SQL."""

import hashlib
import random

import pytest

from gleanery.llm import prefix_trie


def plain(strings, width):
    """Nodes by prefix, by hand: {prefix: (least, depth, parent's least, members, children, leaves, saved, ends)}."""
    nodes = {}
    for name, key, sizes in strings:
        for d in range(len(key) // width + 1):
            node = nodes.setdefault(key[: d * width], {"members": [], "ends": [], "size": sizes[d - 1] if d else 0})
            node["members"].append(name)
            if d * width == len(key):
                node["ends"].append(name)
    children = {p: [q for q in nodes if len(q) == len(p) + width and q.startswith(p)] for p in nodes}
    out = set()
    for p, node in nodes.items():
        below = [q for q in nodes if q.startswith(p)]
        saved = sum((len(nodes[q]["members"]) - 1) * nodes[q]["size"] for q in below)
        leaves = sum(not children[q] for q in below)
        parent = min(nodes[p[:-width]]["members"]) if p else None
        ends = hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest()
        out.add((min(node["members"]), len(p) // width, parent, len(node["members"]), len(children[p]), leaves, saved, ends))
    return out


def strings(seed, n, alphabet=3, longest=6, width=prefix_trie.WIDTH):
    rnd = random.Random(seed)
    units = [rnd.randbytes(width) for _ in range(alphabet)]
    units += [units[0][:-1] + b"\x00", units[0][: width // 2] + rnd.randbytes(width - width // 2)]  # ids that part within
    out = []
    for i in range(n):
        turns = [rnd.choice(units) for _ in range(rnd.randint(0, longest))]
        out.append((i * 7 - 20, b"".join(turns), [7 + sum(t) % 50 for t in turns]))
    return out


@pytest.mark.parametrize("rows", [1, 5, 50, 50_000])
def test_trie_over_parts_of_any_size(spark, monkeypatch, rows):
    """A third of all strings are one, so parts meet within it; lists of members cross pieces."""
    monkeypatch.setattr(prefix_trie, "PART_ROWS", rows)
    monkeypatch.setattr(prefix_trie, "PIECE", 4)
    own = strings(rows, 60)
    own += [(1000 + i, own[1][1], own[1][2]) for i in range(30)]
    df = spark.createDataFrame([(n, bytearray(k), s) for n, k, s in own], "conv_id long, key binary, sizes array<int>").repartition(4)
    got = [tuple(r) for r in prefix_trie.trie(df).collect()]
    assert set(got) == plain(own, prefix_trie.WIDTH) and len(got) == len(set(got))


def test_nodes_grow(spark):
    """First ids with all 256 first bytes take every layout; a single string is one path."""
    for n in (1, 4, 5, 16, 17, 48, 49, 256):
        order = random.Random(n).sample(range(256), n)
        tree = prefix_trie.RadixTree(2)
        for i in order:
            tree.insert(bytes([i, 1]), [1], i)
        assert [c.key[0] for c in tree.root.children] == sorted(order) and len(tree.root.children) == n
        assert tree.root.children.room == next(r for r in (4, 16, 48, 256) if n <= r)
        assert all((tree.root.children.get(i) is not None) == (i in order) for i in range(256))


def test_strings_of_turns(spark):
    rows = [(1, 2, "user", "b"), (1, None, None, None), (1, 1, "user", "ü"), (2, 1, "user", ""), (None, 1, "user", "x"), (3, 1, "us", "erx"), (4, 1, "use", "rx"), (1, 2, "user", "b")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, key int")
    got = {r["conv_id"]: (bytes(r["key"]), r["sizes"]) for r in prefix_trie.strings(df).collect()}
    assert set(got) == {1, 2, 3, 4} and got[1][1] == [0, 2, 1, 1] and len(got[1][0]) == 4 * prefix_trie.WIDTH
    assert got[3][0] != got[4][0] and got[1][0][32:48] == got[1][0][48:]
    empty = prefix_trie.strings(df.limit(0))
    assert prefix_trie.trie(empty).count() == 0
