"""Near copies by exact Jaccard similarity of word shingles, found through SimHash and min-hash bands.

Texts with the same set of shingles are one node.  Nodes whose SimHash fingerprints are equal or
within a few bits (``simhash.links``, by the generalised pigeonhole principle) are compared first.  At a similarity of
0.8 most pairs differ in more bits than that, so each node's set is hashed by
``BANDS * ROWS`` min-hashes too; two nodes are compared if all hashes of some band agree, which
two sets of similarity s miss by chance (1 - s ** ROWS) ** BANDS: one in 39,000 at 0.8.
Compared means that the sets themselves are intersected; nothing is linked on hashes.
Before the sets are shipped, a pair's marks are: one bit for the parity of the shingles of each of
``MARKS`` classes.  Two sets differ in at least as many shingles as marks, so that
pairs whose marks differ in more than the similarity allows are none, for certain.

In every band value the nodes are compared with a leader first, the node that is met in most bands.  Only nodes
that this leaves outside the value's main component are then compared with the nodes of other
components, so of two similar nodes that share a band both end in one component, without the
sets of a large group being shipped pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm import simhash
from gleanery.llm.components import components
from gleanery.llm.places import rows_at
from gleanery.llm.words import forget, tidied
from gleanery.sources.scratch import passing, scratch_path, written

WORDS, PERCENT = 5, 80
BANDS, ROWS = 20, 4
#: Bits of a set's marks, which tell sets apart up to some 4,000 shingles; beyond, the sets themselves do.
MARKS = 2048
#: Leaders are named while more than this many pairs an entry remain, in so many rounds at most.
CROWDED, LEADERS = 32, 4

_random = np.random.default_rng(11)
_MASKS = _random.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64)
_FACTORS = _random.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = np.arange(1, BANDS + 1, dtype=np.uint64)


def _shingles(text: str | None, words: int) -> np.ndarray:
    """The shingles' hashes, repeats included; ASCII case and white space don't count, and a shorter text is one shingle."""
    return simhash.shingle_hashes((text or "").encode(), words)


def _bands(hashes: np.ndarray) -> np.ndarray:
    """One number per band, from the least of each of its hash functions."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 4096):
        np.minimum(least, ((hashes[at : at + 4096] ^ _MASKS) * _FACTORS).min(axis=1), out=least)
    code = _BAND.copy()
    for of_row in least.reshape(BANDS, ROWS).T:
        code = (code ^ of_row ^ (of_row >> np.uint64(29))) * _FACTORS[0, 0]
        code ^= code >> np.uint64(32)
    return code


def _sketched(docs: DataFrame, text: str, words: int) -> DataFrame:
    """*docs* with the fingerprint _fp, _node, which texts with equal sets share, the set's size _n and its _bands.

    One pass makes all of them, as each Python step of a task has a worker of its own and hashes of its own.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            texts = batch.column(text)
            fps, nodes, sizes = np.empty(batch.num_rows, np.uint64), np.empty(batch.num_rows, np.uint64), np.empty(batch.num_rows, np.int32)
            bands = np.zeros((batch.num_rows, BANDS), np.uint64)
            for i in range(batch.num_rows):
                hashes = _shingles(texts[i].as_py(), words)
                found = np.unique(hashes)
                fps[i] = simhash.fingerprint_of(hashes)
                nodes[i], sizes[i] = xxhash.xxh64_intdigest(found.tobytes(), 42), len(found)
                bands[i] = _bands(found)
            ends = np.arange(0, bands.size + 1, BANDS, dtype=np.int32)
            lists = pa.ListArray.from_arrays(ends, bands.view(np.int64).ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64)), pa.array(nodes.view(np.int64)), pa.array(sizes), lists], names=[*batch.schema.names, *(f.name for f in more)])

    more = [T.StructField("_fp", T.LongType()), T.StructField("_node", T.LongType()), T.StructField("_n", T.IntegerType()), T.StructField("_bands", T.ArrayType(T.LongType()))]
    return docs.mapInArrow(tidied(run), T.StructType([*docs.schema.fields, *more]))


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """Rows (node, shingles, n, marks) of rows (node, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [np.unique(_shingles(t.as_py(), words)).view(np.int64) for t in part.column("text")]
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                marks = pa.FixedSizeListArray.from_arrays(np.concatenate([_marks(f) for f in found]), MARKS // 64).cast(pa.list_(pa.int64()))
                sizes = pa.array(np.diff(ends))
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.ListArray.from_arrays(ends, np.concatenate(found)), sizes, marks], names=["node", "shingles", "n", "marks"])

    return texts.mapInArrow(tidied(run), "node bigint, shingles array<bigint>, n int, marks array<bigint>")


def _marks(hashes: np.ndarray) -> np.ndarray:
    """Whether an odd number of hashes falls into each class, 64 classes to a number."""
    return np.packbits((np.bincount(hashes & (MARKS - 1), minlength=MARKS) & 1).astype(np.uint8)).view(np.int64)


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of *pairs* (hub, node) whose sets share at least *percent* of their union."""
    whole, near = sets.select("node", "shingles"), written(pairs.distinct(), "pairs", compact=True)
    both = F.size("own") + F.size("other")
    shared = F.size(F.array_intersect("own", "other"))
    # Stored pairs let Spark see how few they are, so that sets which none of them needs don't move.
    of_hub = whole.toDF("hub", "other").join(near.select("hub").distinct(), "hub", "left_semi")
    # Many pairs may have one hub, so its set is joined last, where Spark can split the pairs.
    joined = near.join(whole.toDF("node", "own"), "node").join(of_hub, "hub")
    return joined.filter((100 + percent) * shared.cast("bigint") >= percent * both).select(F.col("hub").alias("a"), F.col("node").alias("b"))


def _may_be_similar(percent: int) -> Column:
    """Whether sizes and marks of (n, marks) and (hub_n, hub_marks) allow the similarity."""
    sizes = 100 * F.least("n", "hub_n").cast("bigint") >= percent * F.greatest("n", "hub_n")
    apart = reduce(add, (F.bit_count(F.col("marks")[i].bitwiseXOR(F.col("hub_marks")[i])) for i in range(MARKS // 64)))
    return sizes & ((100 + percent) * apart.cast("bigint") <= (100 - percent) * (F.col("n") + F.col("hub_n")).cast("bigint"))


def _as_hub(rows: DataFrame, *more: str) -> DataFrame:
    return rows.withColumnsRenamed({"node": "hub", "n": "hub_n", "marks": "hub_marks", "root": "hub_root"}).select("band", "hub", "hub_n", "hub_root", *more)


def _alike(nodes: DataFrame) -> DataFrame:
    """Pairs (hub, node) of *nodes* (node, fp) with equal or linked fingerprints, each fingerprint's least node being its hub."""
    hubs = written(nodes.groupBy("fp").agg(F.min("node").alias("hub"), F.count("*").alias("n")), "hubs")
    equal = nodes.join(hubs.filter("n > 1"), "fp").select("hub", "node")
    linked = simhash.links(hubs.select("fp"))
    a, b = hubs.select(F.col("fp").alias("a"), "hub"), hubs.select(F.col("fp").alias("b"), F.col("hub").alias("node"))
    return equal.unionByName(linked.join(a, "a").join(b, "b").select("hub", "node")).filter("hub <> node")


def links(nodes: DataFrame, sets_of, percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) that connect all of *nodes* (node, n, bands, fp) that share a band, or whose fingerprints are linked, and at least *percent* of their union.

    Every edge is verified.  *sets_of* gives rows (node, shingles, n, marks) for the nodes of a table.
    """
    alike = written(_alike(nodes.select("node", "fp")), "alike")
    entries = nodes.select("node", F.explode("bands").alias("band"))
    size = entries.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    shared = written(entries.join(size, "band"), "bands")
    wanted = shared.select("node").unionByName(alike.select("node")).unionByName(alike.select(F.col("hub").alias("node"))).distinct()
    sets = written(sets_of(wanted), "sets")
    marked = sets.select("node", "n", "marks")
    often = shared.groupBy("node").agg(F.count("*").alias("often"))
    met = written(shared.select("band", "node").join(marked.drop("marks").join(often, "node"), "node"), "met")
    as_hubs = marked.toDF("hub", "hub_n", "hub_marks")
    near = alike.join(marked, "node").join(as_hubs, "hub").filter(_may_be_similar(percent)).select("hub", "node")
    found = written(_similar(near, sets, percent), "links")
    n_entries = met.count()
    for lead in range(LEADERS + 1) if n_entries else ():
        roots = written(components(found).withColumnRenamed("root", "_root"), "roots")
        rooted = met.join(roots, "node", "left").withColumn("root", F.coalesce("_root", "node")).drop("_root")
        parts = rooted.groupBy("band", "root").agg(F.count("*").alias("k"))
        main = parts.groupBy("band").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.sum("k").alias("all"), F.max("k").alias("most")).filter("all > most")
        main = written(main, "main")
        outside = rooted.join(main, "band").filter("root <> main")
        left = outside.agg(F.count("*").alias("n"), F.sum("all").alias("pairs")).first()
        if not left.n:
            break
        last = lead == LEADERS or (lead and left.pairs <= CROWDED * n_entries)
        if last:  # all that is left to compare, of two nodes outside once; marks go to the bands that need them
            crowd = rooted.join(main.select("band", "main"), "band").join(marked.select("node", "marks"), "node")
            hubs = _as_hub(crowd.filter("root <> main"), "hub_marks", "main")
            met_by = hubs.join(crowd.drop("main"), "band").filter((F.col("root") == F.col("main")) | (F.col("hub") < F.col("node")))
            met_by = met_by.filter((F.col("root") != F.col("hub_root")) & _may_be_similar(percent))
        else:
            rank = F.xxhash64("node", F.lit(lead)) if lead else F.struct(-F.col("often"), F.xxhash64("node"))
            of_band = outside if lead else rooted.join(main.select("band"), "band", "left_semi")
            leaders = of_band.groupBy("band").agg(F.min_by(F.struct("node", "n", "root"), rank).alias("first")).select("band", "first.*")
            # A pair meets in many bands, so marks are joined to it, once.
            pairs = _as_hub(leaders).join(rooted, "band").filter(F.col("root") != F.col("hub_root"))
            pairs = written(pairs.select("hub", "node").distinct(), "candidates")
            met_by = pairs.join(marked, "node").join(as_hubs, "hub").filter(_may_be_similar(percent))
        found = found.unionByName(written(_similar(met_by.select("hub", "node"), sets, percent), "links"))
        if last:
            break
    return found


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of *docs* for each group of near copies: the one with its least key, NULL keys last.

    Two texts whose distinct shingles of *words* words share at least *percent* of their union are
    near copies, and groups are what near copies connect.  Blank and NULL texts are one
    group.  Of rows repeated with the least key one stays.  Columns stay as they
    were; *docs* must have no column _fp, _node, _n or _bands.
    """
    spark = docs.sparkSession
    stored, kept = written(_sketched(docs, text, words), "documents"), scratch_path(spark, "gone")
    with passing(spark):
        spot = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
        rows = stored.select(F.col(key).alias("key"), F.col("_node").alias("node"), *spot)
        narrow = stored.select(F.col("_node").alias("node"), F.col("_n").alias("n"), F.col("_bands").alias("bands"), F.col("_fp").alias("fp"), *spot)
        # Equal sets may have different fingerprints, as these count repeats.
        firsts = [F.first("n").alias("n"), F.first("bands").alias("bands"), F.min("fp").alias("fp")]
        nodes = written(narrow.groupBy("node").agg(F.min(F.struct("_file", "_row")).alias("place"), *firsts), "nodes")

        def sets_of(wanted: DataFrame) -> DataFrame:
            places = nodes.join(wanted, "node").select("place._file", "place._row")
            return _sets(rows_at(stored, places).select(F.col(text).alias("text"), F.col("_node").alias("node")), words)

        found = components(links(nodes.filter("n > 0").select("node", "n", "bands", "fp"), sets_of, percent))
        placed = rows.join(found, "node", "left").withColumn("root", F.coalesce("root", "node")).drop("node")
        out = simhash.first_of_groups(stored, placed, kept)
    return out.select(*docs.columns)
