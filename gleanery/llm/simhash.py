"""SimHash fingerprints and their links within a few bits, by the generalised pigeonhole principle.

A fingerprint's 64 bits are grouped into parts, correlated bits together.  If two
fingerprints differ in at most d bits and part i gets the threshold t_i, with
sum(t_i + 1) = d + 1 over the parts (t_i = -1: part not used), then in some used part they
differ in at most t_i bits.  Each fingerprint chooses its own thresholds, by
dynamic programming over the number of candidates expected from each part and
threshold, looks up all values of a part within the threshold, and verifies
what it finds.  So skewed parts are avoided fingerprint by fingerprint.

Expected candidates come from counts over all fingerprints: exact for values that a
ten-thousandth of all fingerprints share (a bounded table), and the mean of the others
for the rest.

Equal fingerprints are one node from the start.  A value that very many
fingerprints share (near copies of one text) is not paired off: its fingerprints
are linked through the 65 codes within one bit of each, since two codes are within
two bits exactly if they share such a code, and at most 65 codes meet in one.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm.components import components
from gleanery.llm.places import rows_at
from gleanery.llm.words import slices
from gleanery.sources.scratch import written

BITS, WORDS, DISTANCE = 64, 3, 2
#: A value is frequent from this share of all fingerprints on, and crowded from this
#: many probes and entries on; candidate and probe costs are counted in rows.
FREQUENT, CROWDED, SLICE = 1e-4, 128, 4_000_000


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """A hash per shingle of *words* words, repeats included; a shorter text is one shingle, a blank one has none."""
    tokens = text.lower().split()  # ASCII letters and ASCII white space only
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    digest, seed = xxhash.xxh64_intdigest, 42
    return np.fromiter((digest(s, seed) for s in shingles), "<u8", max(1, len(tokens) - words + 1))


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bit by bit whether it is set in over half of *hashes*; 0 without any."""
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", into: str = "fp", words: int = WORDS) -> DataFrame:
    """*docs* with the 64-bit fingerprint of the word shingles of *text*, as a signed long.

    Bit by bit: 1 if set in over half of the shingles' hashes, repeats included.  A
    shorter text is one shingle; NULL or blank text has fingerprint 0.  A column named as
    *into* is replaced.
    """
    rows = docs.drop(into)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text)
            found = np.empty(batch.num_rows, np.uint64)
            for i in range(batch.num_rows):
                found[i] = fingerprint_of(shingle_hashes((texts[i].as_py() or "").encode(), words))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], names=[*batch.schema.names, into])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(into, T.LongType())]))


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each two bits how many have both set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            x = _bits(batch.column(0).to_numpy()).astype(np.float32)
            n, both = n + len(x), both + x.T @ x
        values = np.append(n, both.ravel()).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"k": np.arange(len(values), dtype=np.int32), "n": values})

    rows = nodes.select("fp").mapInArrow(run, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect()
    values = np.zeros(BITS * BITS + 1, np.int64)
    for row in rows:  # one row per pair of bits
        values[row.k] = row.n
    return int(values[0]), values[1:].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in *parts* groups of even width: each starts with the most skewed bit left and takes those it correlates with."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    left, groups = set(range(BITS)), []
    for i in range(parts):
        width = (BITS - sum(map(len, groups))) // (parts - i)
        group = [min(left, key=lambda b: (-abs(p[b] - 0.5), b))]
        left -= {group[0]}
        while len(group) < width:
            best = min(left, key=lambda b: (-related[b, group].sum(), b))
            group.append(best)
            left -= {best}
        groups.append(sorted(group))
    return groups


def _ball(width: int, radius: int) -> int:
    return sum(math.comb(width, r) for r in range(radius + 1))


def choose_groups(n: int, both: np.ndarray, distance: int) -> list[list[int]]:
    """The grouping, of 1 to distance + 2 parts, with the least expected probes and candidates."""
    p = np.diag(both) / max(n, 1)
    alike = np.log2(np.maximum(p * p + (1 - p) ** 2, 1e-9))

    def cost(groups: list[list[int]]) -> float:
        spend = np.array([[0.0, *(_ball(len(g), t) * (1 + n * 2 ** alike[g].sum()) for t in range(distance + 1))] for g in groups])
        return float(allocate(spend[None])[1][0]) + len(groups)

    return min((group_bits(n, both, m) for m in range(2, distance + 3)), key=cost)


def allocate(spend: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds of least cost.

    *spend* [row, part, t + 1] is the cost of threshold t (-1: none) in a part.  Of each
    row the thresholds with sum(t + 1) = distance + 1, and their cost.
    """
    rows, parts, choices = spend.shape
    total = choices - 1
    best = np.full((parts + 1, rows, total + 1), np.inf)
    best[0, :, 0] = 0
    taken = np.zeros((parts, rows, total + 1), np.int8)
    for i in range(parts):
        for have in range(total + 1):
            options = np.stack([best[i, :, have - c] + spend[:, i, c] if c <= have else np.full(rows, np.inf) for c in range(choices)])
            taken[i, :, have] = options.argmin(axis=0)
            best[i + 1, :, have] = options.min(axis=0)
    thresholds, left, row = np.empty((rows, parts), np.int8), np.full(rows, total), np.arange(rows)
    for i in reversed(range(parts)):
        c = taken[i, row, left]
        thresholds[:, i], left = c - 1, left - c
    return thresholds, best[parts, :, total]


def _part_values(fps: np.ndarray, groups: list[list[int]]) -> np.ndarray:
    bits = _bits(fps).astype(np.int64)
    return np.stack([bits[:, g] @ (1 << np.arange(len(g), dtype=np.int64)) for g in groups], axis=1)


def probes(nodes: DataFrame, groups: list[list[int]], frequent: dict[tuple[int, int], int], n: int, distance: int) -> DataFrame:
    """Rows (part, value, fp, entry): every fingerprint's entries, and the values it looks up by its thresholds.

    A value with threshold 0 is looked up where it is entered, by one row.
    """
    common = [{v: c for (i, v), c in frequent.items() if i == part} for part in range(len(groups))]
    rest = [(n - sum(c.values())) / max(1, min(n, 2 ** len(g)) - len(c)) for c, g in zip(common, groups, strict=True)]
    flips = [[[sum(1 << b for b in bits) for bits in itertools.combinations(range(len(g)), r)] for r in range(distance + 1)] for g in groups]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = [(np.array(list(c), np.int64), np.array(list(c.values()), float)) for c in common]
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fps = batch.column(0).to_numpy()[at : at + 4096]
                values = _part_values(fps, groups)
                spend = np.zeros((len(fps), len(groups), distance + 2))
                for i, (g, (known, counts)) in enumerate(zip(groups, heavy, strict=True)):
                    apart = np.bitwise_count(values[:, i, None] ^ known[None])
                    for t in range(distance + 1):
                        ball = _ball(len(g), t)
                        spend[:, i, t + 1] = ball * (1 + rest[i]) + (apart <= t) @ counts
                thresholds, _ = allocate(spend)
                out = []
                for i in range(len(groups)):
                    out.append((i, values[:, i], fps, np.where(thresholds[:, i] >= 0, 2, 1)))
                    for t in range(1, distance + 1):
                        reach = thresholds[:, i] >= t
                        for mask in flips[i][t]:
                            out.append((i, values[reach, i] ^ mask, fps[reach], np.zeros(reach.sum(), np.int64)))
                yield pa.RecordBatch.from_pydict({
                    "part": np.concatenate([np.full(len(f), i, np.int32) for i, _, f, _ in out]),
                    "value": np.concatenate([v for _, v, _, _ in out]),
                    "fp": np.concatenate([f for _, _, f, _ in out]),
                    "role": np.concatenate([r for _, _, _, r in out]).astype(np.int32),
                })

    return nodes.select("fp").mapInArrow(run, "part int, value bigint, fp bigint, role int")


def _near(a: Column, b: Column, distance: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= distance


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) that connect all of *nodes* (fp, distinct) within *distance* bits of each other.

    Every pair is verified.  In crowded values pairs are not all listed, but what
    they connect is connected by other verified edges.
    """
    n, both = bit_counts(nodes)
    groups = choose_groups(n, both, distance)
    width = nodes.select("fp")

    def entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _part_values(batch.column(0).to_numpy(), groups)
            parts = np.broadcast_to(np.arange(len(groups), dtype=np.int32), values.shape)
            yield pa.RecordBatch.from_pydict({"part": parts.ravel(), "value": values.ravel()})

    counted = width.mapInArrow(entries, "part int, value bigint").groupBy("part", "value").count()
    # At most 1 / FREQUENT values per part.
    frequent = {(r.part, r.value): r["count"] for r in counted.filter(F.col("count") >= max(2, FREQUENT * n)).collect()}
    rows = written(probes(nodes, groups, frequent, n, distance), "probes")
    sizes = rows.groupBy("part", "value").agg(F.count("*").alias("size"), F.count_if(F.col("role") > 0).alias("entries"))
    # A value that nothing else meets, or that is entered nowhere, gives no pair.
    useful = sizes.filter((F.col("size") > 1) & (F.col("entries") > 0))
    met = written(rows.join(useful.select("part", "value", "size"), ["part", "value"]), "met")
    few = met.filter(F.col("size") <= CROWDED)
    seek = few.filter("role <> 1").select("part", "value", F.col("fp").alias("a"))
    held = few.filter("role > 0").select("part", "value", F.col("fp").alias("b"))
    pairs = seek.join(held, ["part", "value"]).filter((F.col("a") != F.col("b")) & _near(F.col("a"), F.col("b"), distance))
    found = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    crowd = met.filter(F.col("size") > CROWDED).select("fp").distinct()
    return found.unionByName(_crowd_links(crowd, distance))


def _crowd_links(crowd: DataFrame, distance: int) -> DataFrame:
    """Edges among many fingerprints: those that share a code within half the distance, linked to the least of them."""
    if distance != 2:
        raise ValueError("crowded values are linked for a distance of 2")
    masks = F.array(F.lit(0).cast("long"), *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(BITS)])
    near = crowd.select("fp", F.explode(masks).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("code"))
    # Distinct fingerprints within one bit of a code: at most 65.
    met = near.groupBy("code").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    star = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b")
    return star.distinct()


def _classes(rows: DataFrame, distance: int) -> DataFrame:
    """Of stored rows (key, fp): each fingerprint's component, named by a fingerprint (root) and by its least key."""
    nodes = written(rows.groupBy("fp").agg(F.min("key").alias("least")), "nodes")
    found = written(components(links(nodes, distance)), "components")
    # Only fingerprints with links meet others; the rest are their own component.
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return written(rooted.join(least, "root").select("fp", "root", "component_id"), "classes")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """Per row of *docs*: key, fingerprint (16 hex digits) and component_id, the least key that links lead to.

    NULL and blank texts share fingerprint 0 and are linked like any others.  NULL
    keys are passed over for component_id, which is NULL only if a component has no other.
    Repeated rows stay; an empty table gives no rows.  Other columns are not read.
    """
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = written(fingerprints(own).select("key", "fp"), "fingerprints")
    classes = _classes(rows, distance)
    return rows.join(classes, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """One row of *docs* for each component: the one with its least key, NULL keys last.

    Blank and NULL texts are one component.  Of rows repeated with the least key one
    stays.  Columns stay as they were; *docs* must have no column _fp.
    """
    stored = written(fingerprints(docs, text, "_fp", words), "documents")
    spot = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    rows = stored.select(F.col(key).alias("key"), F.col("_fp").alias("fp"), *spot)
    placed = rows.join(_classes(rows, distance).select("fp", "root"), "fp")
    return first_of_groups(stored, placed).select(*docs.columns)


def first_of_groups(stored: DataFrame, placed: DataFrame, path: str | None = None) -> DataFrame:
    """Of each root in *placed* (key, root, _file, _row) the row of *stored* with the least key.

    The places of the others are stored below *path*, and nothing else is read later.
    """
    order = F.struct(F.col("key").isNull().alias("last"), "key", "_file", "_row")
    first = placed.groupBy("root").agg(F.min_by(F.struct("_file", "_row"), order).alias("first"), F.count("*").alias("n"))
    # Rows alone in their component, most of all, need no look-up.
    groups = first.filter("n > 1").select("root", "first")
    gone = placed.join(groups, "root").filter("first._file <> _file or first._row <> _row").select("_file", "_row")
    return rows_at(stored, gone, inside=False, path=path)
