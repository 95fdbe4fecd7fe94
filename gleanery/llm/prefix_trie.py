"""Prefix trie of conversations, built in adaptive radix trees over fixed-width turn ids.

A turn's id is the first 16 bytes of a digest of its role and text, so a conversation is one
byte string, and bytes order as big-endian numbers do.  The strings are range-partitioned with their ids,
so a prefix that many share, or a string itself, spreads over as many parts as it needs, and
every part is a run of the sorted order.  Each part becomes an adaptive radix tree: nodes of
4, 16, 48 or 256 children that grow as they fill, and paths without branches held as one stretch of a key.
Only byte depths that are whole turns emit nodes.

A prefix that other parts may hold too is a prefix of its part's first or last string: a
part has one chain of each.  All other nodes are complete and leave the part as
they are.  For the chains, counts and sums over subtrees add up across parts: a text's weight is taken off
once, by the first part that holds the node, and a node without children is counted once, by the last. Which
parts these are follows from how many turns a part's first and last strings share with its
neighbours', one row per part.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.sources.scratch import written

WIDTH = 16
#: Bytes of strings that a part holds on average, and rows at most on average.
PART_BYTES, PART_ROWS = 8 << 20, 50_000
#: Member ids in one piece of a chain node's list.
PIECE = 10_000

_NODES = (
    "node binary, parent binary, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string, chain boolean, piece bigint, ends string"
)


class Children:
    """A node's children by byte: sorted lists up to 16, an index of 256 up to 48, then a slot for each byte.

    Sorted lists of 4 and of 16 differ in how many they take before they are laid out anew.
    """

    __slots__ = ("room", "_keys", "_slots")

    def __init__(self):
        self.room, self._keys, self._slots = 4, bytearray(), []

    def get(self, byte: int):
        if self.room == 256:
            return self._slots[byte]
        if self.room == 48:
            at = self._keys[byte]
            return self._slots[at - 1] if at else None
        at = bisect_left(self._keys, byte)
        return self._slots[at] if at < len(self._keys) and self._keys[at] == byte else None

    def put(self, byte: int, child) -> None:
        """Adds *child*, or takes it in place of the one under *byte*."""
        if self.room <= 16:
            at = bisect_left(self._keys, byte)
            if at < len(self._keys) and self._keys[at] == byte:
                self._slots[at] = child
                return
            if len(self._slots) < self.room:
                self._keys.insert(at, byte)
                self._slots.insert(at, child)
                return
            self._grow()
        if self.room == 48:
            at = self._keys[byte]
            if at:
                self._slots[at - 1] = child
                return
            if len(self._slots) < 48:
                self._slots.append(child)
                self._keys[byte] = len(self._slots)
                return
            self._grow()
        if self.room == 16:
            self.put(byte, child)
        else:
            self._slots[byte] = child

    def _grow(self) -> None:
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            index = bytearray(256)
            for at, byte in enumerate(self._keys):
                index[byte] = at + 1
            self.room, self._keys = 48, index
        else:
            slots = [None] * 256
            for byte in range(256):
                if self._keys[byte]:
                    slots[byte] = self._slots[self._keys[byte] - 1]
            self.room, self._keys, self._slots = 256, bytearray(), slots

    def __iter__(self) -> Iterator:
        """Children in byte order."""
        if self.room == 256:
            return (c for c in self._slots if c is not None)
        if self.room == 48:
            return (self._slots[at - 1] for at in self._keys if at)
        return iter(self._slots)

    def __len__(self) -> int:
        return sum(1 for _ in self)


@dataclass(slots=True)
class Node:
    """Bytes *start* to *end* of *key* lead here; *ends* are the ids of strings that end here."""

    key: bytes
    sizes: list[int]
    start: int
    end: int
    children: Children = field(default_factory=Children)
    ends: list[int] = field(default_factory=list)


class RadixTree:
    """Strings of whole *width* units, each with an id and one size per unit."""

    def __init__(self, width: int = WIDTH):
        self.width, self.root = width, Node(b"", [], 0, 0)

    def insert(self, key: bytes, sizes: list[int], name: int) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = Node(key, sizes, at, len(key))
                node.children.put(key[at], child)
                node = child
                break
            same = _shared(child.key, key, child.start, min(child.end, len(key)))
            if same < child.end:  # the path ends or parts here
                fork = Node(child.key, child.sizes, child.start, same)
                child.start = same
                fork.children.put(child.key[same], child)
                node.children.put(key[at], fork)
                child = fork
            node, at = child, child.end
        node.ends.append(name)


def _shared(a: bytes, b: bytes, start: int, end: int) -> int:
    """How far *a* and *b* agree from *start*, at most to *end*."""
    if a[start:end] == b[start:end]:
        return end
    while start < end:
        step = (end - start + 1) // 2
        if a[start : start + step] == b[start : start + step]:
            start += step
        else:
            end = min(end, start + step - 1)
    return start


@dataclass(slots=True)
class _Sum:
    """What a subtree gives its parent: members, least id, leaves, saved bytes."""

    n: int
    least: int
    leaves: int
    saved: int


def common_turns(a: bytes, b: bytes, width: int = WIDTH) -> int:
    return _shared(a, b, 0, min(len(a), len(b))) // width


class Part:
    """One part's tree with its rows to emit; *before* and *after* are the turns shared with the neighbours, -1 at the edge."""

    def __init__(self, tree: RadixTree, first: bytes, last: bytes, before: int, after: int):
        self._tree, self._width = tree, tree.width
        self._first, self._last, self._before, self._after = first, last, before, after

    def rows(self) -> Iterator[tuple]:
        """Rows of ``_NODES``, from the leaves up, without recursion: paths may be long."""
        out: list[tuple] = []
        stack: list[tuple[Node, Iterator, list]] = [(self._tree.root, iter(self._tree.root.children), [])]
        while stack:
            node, children, below = stack[-1]
            child = next(children, None)
            if child is not None:
                stack.append((child, iter(child.children), []))
                continue
            stack.pop()
            lowest = stack[-1][0].end if stack else -1
            above = self._emit(node, below, lowest, out)
            if stack:
                stack[-1][2].extend(above)
            yield from out
            out.clear()

    def _emit(self, node: Node, below: list, floor: int, out: list[tuple]) -> list:
        """Emits the unit depths of *node*'s path, which begins after byte *floor*; *below* are the open nodes under its end.

        An open node (its _Sum, and the row that waits for its parent's least id) goes up to
        the next whole unit; what is left at the top of the path is handed on.
        """
        width, here = self._width, below
        on_first, on_last = (common_turns(node.key[: node.end], edge, width) for edge in (self._first, self._last))
        for depth in range(node.end // width, -1, -1):
            if depth * width <= floor:
                break
            ends = node.ends if depth * width == node.end else []
            chain = depth <= on_first or depth <= on_last
            owned = depth > self._before or depth > on_first  # no earlier part holds it
            final = depth > self._after or depth > on_last  # no later part does
            here = [self._node(node, depth, here, ends, chain, owned, final, out)]
        return here

    def _node(self, node: Node, depth: int, children: list, ends: list[int], chain: bool, owned: bool, final: bool, out: list[tuple]) -> tuple:
        size = node.sizes[depth - 1] if depth else 0
        n = len(ends) + sum(s.n for s, _, _ in children)
        least = min([*ends[:1], *(s.least for s, _, _ in children)])  # ends come in ascending order
        leaves = sum(s.leaves for s, _, _ in children) + (not children and final)
        saved = sum(s.saved for s, _, _ in children) + n * size - (size if owned else 0)
        name = _name(node.key[: depth * self._width]) if chain else None
        for _, row, _ in children:  # the parent of these is known now
            row["parent_conv_id"], row["parent"] = (None, name) if chain else (least, None)
            out.extend(self._out(row))
        row = {
            "node": name, "parent": None, "depth": depth, "conv_id": least, "parent_conv_id": None, "n_convs": n,
            "n_children": sum(new for _, _, new in children), "n_leaves": leaves, "saved_tokens": saved, "chain": chain, "ends": ends,
        }
        if depth == 0:
            out.extend(self._out(row))
        return _Sum(n, least, leaves, saved), row, owned

    @staticmethod
    def _out(row: dict) -> Iterator[tuple]:
        ends = row.pop("ends")
        row["ends_sha256"] = None if row["chain"] else hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        names = ("node", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "chain")
        yield (*(row[c] for c in names), None, None)
        if row["chain"]:
            for at in range(0, len(ends), PIECE):
                piece = ends[at : at + PIECE]
                yield (row["node"], None, row["depth"], None, None, 0, 0, 0, 0, None, True, at, ",".join(map(str, piece)))


def _name(key: bytes) -> bytes:
    return hashlib.sha256(key).digest()[:16]


def strings(turns: DataFrame) -> DataFrame:
    """One row per conversation of *turns* (conv_id, turn, role, text): conv_id, key (its turns' ids), sizes (UTF-8 bytes of their texts).

    Turns count in the order of turn, NULL first, then role and id; a NULL role or text is
    empty; rows without conv_id take no part.  One conversation's ids, 24 bytes a turn, lie in one row.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    name = F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 2 * WIDTH)
    item = F.struct(F.col("turn").isNotNull().alias("a"), F.col("turn").alias("b"), F.col("role").alias("c"), name.alias("id"), F.octet_length("text").alias("size"))
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("turns"))
    ids = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    return listed.select("conv_id", ids.alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


def trie(rows: DataFrame) -> DataFrame:
    """Nodes of the prefix trie over *rows* (conv_id, key, sizes), whole units each; conv_id is unique.

    ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``.  An empty key ends at the root; no rows give no nodes.
    """
    rows = written(rows.select("conv_id", F.coalesce("key", F.lit(bytearray())).alias("key"), "sizes"), "strings")
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("key") * F.lit(1.5)), F.lit(0.0))).first()
    parts = max(1, math.ceil(size / PART_BYTES), math.ceil(n / PART_ROWS))
    ranged = written(rows.repartitionByRange(parts, "key", "conv_id").withColumn("part", F.spark_partition_id()), "ranged")
    edges = ranged.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("part").collect()  # one row per part
    shared = [common_turns(a["last"], b["first"]) for a, b in zip(edges, edges[1:], strict=False)]
    sides = {e["part"]: side for e, side in zip(edges, zip([-1, *shared], [*shared, -1], strict=True), strict=False)}

    def grow(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows).sort_by([("key", "ascending"), ("conv_id", "ascending")])
        tree, keys = RadixTree(), table.column("key").to_pylist()
        for key, sizes, name in zip(keys, table.column("sizes").to_pylist(), table.column("conv_id").to_pylist(), strict=True):
            tree.insert(key, sizes, name)
        out = []
        for row in Part(tree, keys[0], keys[-1], *sides[table.column("part")[0].as_py()]).rows():
            out.append(row)
            if len(out) >= 4096:
                yield _batch(out)
                out = []
        yield _batch(out)

    nodes = written(ranged.groupBy("part").applyInArrow(grow, _NODES), "nodes")
    whole = nodes.filter("not chain")
    chains = nodes.filter("chain and piece is null").groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    chains = written(chains.join(_ends(nodes.filter("piece is not null")), "node", "left"), "chains", compact=True)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    both = whole.select(*columns, "parent").unionByName(
        chains.select("conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"), "parent")
    )
    tops = chains.select(F.col("node").alias("parent"), F.col("conv_id").alias("_top"))
    out = both.join(tops, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_top"))
    return out.select(*columns)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string(), pa.bool_(), pa.int64(), pa.string()]
    names = ["node", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "chain", "piece", "ends"]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _ends(pieces: DataFrame) -> DataFrame:
    """node, ends_sha256 of the chain nodes' lists: each list goes by piece by piece, in ascending order, and is never held whole."""
    ordered = pieces.select("node", F.split("ends", ",").getItem(0).cast("long").alias("at"), "ends").repartition("node").sortWithinPartitions("node", "at")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for key, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if key == node:
                    digest.update(b"," + ends.encode())
                    continue
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ends.encode())
            yield _digests(done)
        if node is not None:
            yield _digests([(node, digest.hexdigest())])

    return ordered.mapInArrow(run, "node binary, ends_sha256 string")


def _digests(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["node", "ends_sha256"])
