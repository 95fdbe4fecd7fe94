"""Nearest neighbours by inner product: multiprobe p-stable hashing with exact reranking.

Vectors are scaled by the largest norm and given one more component that makes all
norms 1, so that the largest inner product is the least distance.  Each table hashes a
vector by ``k`` Gaussian (2-stable) projections cut into slots of width ``w``.  A query
visits, per table, the ``probes`` buckets in which a neighbour most likely lies: slots
have a Gaussian chance given the query's projection, and the best products of slot
chances are enumerated in order.  Candidates of all tables are merged and ranked by
the inner product of the original vectors in double precision.

Only the number of probes is fitted, on a bounded sample, to a target recall there;
a sample has farther neighbours than the whole, so it errs on the safe side.  Every
vector is indexed.  Equal vectors are one entry with the ids that can be in a result.
Buckets are dealt to slices; one larger than ``BLOCK`` is split over several, each of
which its visitors visit.  Queries are dealt to blocks of about ``QUERIES``, so that a
task holds one slice's entries and one block's queries at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.sources.scratch import written

K, TABLES, WIDTH, SPREAD = 20, 2, 2.0, 1.1
#: Entries that a bucket should hold on average, and bits that a slot number of width ``WIDTH`` carries.
BUCKET, SLOT_BITS = 1024, 1.6
#: Entries of a slice, and queries scored at once; vectors and queries of the sample; recall aimed at there.
BLOCK, GROUP, SAMPLE, SAMPLE_QUERIES, RECALL = 16_384, 128, 4096, 200, 0.95

#: Queries that may meet in a slice at once, on average.
QUERIES = 8192

_RESULT = "query_id bigint, vec_id bigint, score double"


class Hashes:
    """Projections and slots of all tables."""

    def __init__(self, dimension: int, n: int, largest: float, tables: int = TABLES, seed: int = 42):
        random = np.random.default_rng(seed)
        self.k = int(np.clip(round(math.log2(max(n, 2) / BUCKET) / SLOT_BITS), 3, 16))
        self.tables, self.largest = tables, largest
        self._project = random.standard_normal((tables, dimension + 1, self.k))
        self._shift = random.uniform(0, WIDTH, (tables, 1, self.k))
        self._weights = random.integers(1 << 62, size=(tables, self.k)) * 2 + 1

    def _slots(self, x: np.ndarray) -> np.ndarray:
        return (x @ self._project + self._shift) / WIDTH

    def _codes(self, table: int, slots: np.ndarray) -> np.ndarray:
        return (slots.astype(np.int64) * self._weights[table]).sum(axis=-1) ^ table

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """Bucket codes [table, vector] of data vectors."""
        scaled = x / self.largest
        rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1, keepdims=True)))
        slots = np.floor(self._slots(np.hstack([scaled, rest])))
        return np.stack([self._codes(t, s) for t, s in enumerate(slots)])

    def visits(self, q: np.ndarray, probes: int) -> np.ndarray:
        """Bucket codes [table, query, visit] in falling order of chance."""
        unit = q / np.linalg.norm(q, axis=1, keepdims=True)
        at = self._slots(np.hstack([unit, np.zeros((len(q), 1))]))
        out = []
        for t in range(self.tables):
            own = np.floor(at[t]).astype(np.int64)
            near = own[..., None] + np.arange(-2, 3)
            low = (near - at[t][..., None]) * (WIDTH / SPREAD)
            chance = np.log(np.maximum(_normal(low + WIDTH / SPREAD) - _normal(low), 1e-12))
            best, slots = np.zeros((len(q), 1)), np.empty((len(q), 1, 0), np.int64)
            for j in range(self.k):  # the best sums so far, each with every slot of the next projection
                sums = (best[:, :, None] + chance[:, j, None, :]).reshape(len(q), -1)
                kept = np.argsort(-sums, axis=1, kind="stable")[:, :probes]
                best = np.take_along_axis(sums, kept, axis=1)
                before = np.take_along_axis(slots, (kept // 5)[..., None], axis=1)
                slots = np.concatenate([before, np.take_along_axis(near[:, j], kept % 5, axis=1)[..., None]], axis=2)
            out.append(self._codes(t, slots))
        return np.stack(out)


def _normal(z: np.ndarray) -> np.ndarray:
    """The normal distribution function, by a bounded series for its error function."""
    x = np.clip(np.abs(z) / math.sqrt(2), 0, 6)
    t = 1 / (1 + 0.3275911 * x)
    tail = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * np.exp(-x * x)
    return np.where(z > 0, 1 - tail / 2, tail / 2)


def usable(vector: str = "embedding") -> Column:
    """Whether a vector has components, all finite, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def fit(entries: DataFrame, n: int, largest: float, dimension: int, k: int, recall: float = RECALL) -> tuple[Hashes, int]:
    """Hash functions for *n* vectors, and the least number of probes with *recall* on a sample of ``SAMPLE``."""
    hashes = Hashes(dimension, n, largest)
    sample = _matrix(entries.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).toArrow()["vector"])
    queries = sample[:: max(1, len(sample) // SAMPLE_QUERIES)]
    scores = queries @ sample.T
    scores[np.arange(len(queries)), np.arange(len(queries)) * max(1, len(sample) // SAMPLE_QUERIES)] = -np.inf
    nearest = np.argsort(-scores, axis=1)[:, : min(k, len(sample) - 1)]
    codes = hashes.buckets(sample)
    most = 5**hashes.k
    probes = 1
    while True:
        visited = hashes.visits(queries, min(probes, most))
        found = [np.mean([np.isin(codes[t][of], visited[t, i]) for t in range(hashes.tables)], axis=0) > 0 for i, of in enumerate(nearest)]
        if nearest.size == 0 or np.mean(found) >= recall or probes >= most:
            return hashes, min(probes, most)
        probes = math.ceil(probes * 1.25)


def search(vectors: DataFrame, is_query: Column, k: int = K, key: str = "vec_id", vector: str = "embedding", recall: float = RECALL) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the *k* nearest found of each query among all other ids.

    Ranked by falling inner product, equal ones by id.  Vectors that are NULL, empty,
    zero or hold a NULL or non-finite component take no part, nor do rows with a
    NULL id or with another length than most.  Rows repeated with one id and vector
    count once; an id with several vectors asks with each.  Fewer than *k* rows come
    back if there are fewer candidates; an empty table gives none.
    """
    rows = vectors.filter(usable(vector) & F.col(key).isNotNull())
    rows = rows.select(F.col(key).alias("vec_id"), is_query.alias("asks"), F.transform(vector, lambda x: x.cast("double")).alias("vector"))
    rows = written(rows.distinct(), "vectors")
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.filter(F.size("vector") == lengths.d)
    # Of equal vectors the least ids that any result may hold: k, and one for the query itself.
    order = Window.partitionBy("vector").orderBy("vec_id")
    least = rows.select("vec_id", "vector").withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k + 1)
    entries = written(least.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "entries")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    n, largest = entries.agg(F.count("*"), F.max(norm)).first()
    hashes, probes = fit(entries, n, largest, lengths.d, k, recall)

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = hashes.buckets(_matrix(batch.column("vector")))
                for of_table in codes:
                    yield pa.RecordBatch.from_arrays([pa.array(of_table), batch.column("ids"), batch.column("vector")], names=["bucket", "ids", "vector"])

    def visit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                codes = hashes.visits(_matrix(part.column("vector")), probes)
                buckets = np.concatenate(list(codes), axis=1)
                lists = pa.ListArray.from_arrays(np.arange(0, buckets.size + 1, buckets.shape[1], dtype=np.int32), buckets.ravel())
                yield pa.RecordBatch.from_arrays([part.column("query"), lists], names=["query", "buckets"])

    indexed = written(entries.select("ids", "vector").mapInArrow(index, "bucket bigint, ids array<bigint>, vector array<double>"), "index")
    sizes = indexed.groupBy("bucket").agg(F.count("*").alias("size"))
    crowded = sizes.filter(F.col("size") > BLOCK).select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("splits"))
    slices = F.lit(max(1, math.ceil(n * hashes.tables / BLOCK)))
    splits = F.coalesce("splits", F.lit(1))
    held = indexed.join(crowded, "bucket", "left").withColumn("split", F.pmod(F.xxhash64("vector"), splits))
    place = F.xxhash64("bucket", "split")
    queries = written(rows.filter("asks").select(F.struct("vec_id", F.xxhash64("vector").alias("of")).alias("query"), "vector"), "queries")
    blocks = max(1, math.ceil(queries.count() / QUERIES))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks).cast("bigint"))
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    held = held.select(F.pmod(place, slices).alias("slice"), "block", place.alias("place"), "ids", "vector")
    asked = queries.mapInArrow(visit, "query struct<vec_id: bigint, of: bigint>, buckets array<bigint>")
    asked = asked.select("query", F.explode(F.array_distinct("buckets")).alias("bucket")).join(sizes.select("bucket"), "bucket", "left_semi")
    asked = asked.join(crowded, "bucket", "left").withColumn("split", F.explode(F.sequence(F.lit(0), splits - 1)))
    asked = asked.withColumn("split", F.col("split").cast("bigint")).select("query", F.pmod(place, slices).alias("slice"), place.alias("place"))
    asked = asked.groupBy("slice", "query").agg(F.collect_list("place").alias("places")).join(queries, "query")
    asked = asked.withColumn("block", block)
    near = asked.groupBy("slice", "block").cogroup(held.groupBy("slice", "block")).applyInArrow(_rank(k, hashes.tables), _RESULT)
    merged = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _rank(k: int, tables: int):
    """In one slice: each query against the entries of the buckets it visits, and its *k* best ids there.

    Queries are taken in groups that begin with the same places, so that a group's
    scores cover few entries that none of its queries visits.
    """

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        names, found, values = [], [], []
        if asked.num_rows and held.num_rows:
            places, of_entry = np.unique(held["place"].to_numpy(), return_inverse=True)
            x, ids = _matrix(held["vector"]), held["ids"].to_pylist()
            least = np.array([i[0] for i in ids])
            lists = asked["places"].combine_chunks()
            ends = np.cumsum(lists.value_lengths().to_numpy())
            flat = lists.flatten().to_numpy()
            at = np.minimum(np.searchsorted(places, flat), len(places) - 1)
            visits = np.zeros((asked.num_rows, len(places)), bool)
            known = places[at] == flat
            visits[np.repeat(np.arange(asked.num_rows), np.diff(ends, prepend=0))[known], at[known]] = True
            own = np.array([v["vec_id"] for v in asked["query"].to_pylist()])
            q = _matrix(asked["vector"])
            order = np.lexsort(visits.T[::-1]) if len(places) < 64 else np.argsort(visits.argmax(axis=1), kind="stable")
            for start in range(0, len(order), GROUP):
                group = order[start : start + GROUP]
                entries = np.flatnonzero(visits[group].any(axis=0)[of_entry])
                scores = np.where(visits[group][:, of_entry[entries]], q[group] @ x[entries].T, -np.inf)
                # An entry may be in a slice once per table.
                most = min((k + 1) * tables, len(entries))
                bar = np.partition(scores, len(entries) - most, axis=1)[:, len(entries) - most] if most else None
                for r, i in enumerate(group.tolist() if most else ()):
                    top = np.flatnonzero((scores[r] >= bar[r]) & (scores[r] > -np.inf))
                    once = {int(least[e]): (v, e) for v, e in zip(scores[r][top].tolist(), entries[top].tolist(), strict=True)}
                    best = _cut(sorted(once.values(), key=lambda f: (-f[0], least[f[1]])), k)
                    named = sorted(((-v, n) for v, e in best for n in ids[e] if n != own[i]))[:k]
                    names += [int(own[i])] * len(named)
                    found += [n for _, n in named]
                    values += [-v for v, _ in named]
        return pa.table({"query_id": pa.array(names, pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(values, pa.float64())})

    return run


def _cut(found: list[tuple[float, int]], k: int) -> list[tuple[float, int]]:
    """The first k + 1 entries and those equal to the last of them."""
    if len(found) <= k + 1:
        return found
    bar = found[k][0]
    return [f for f in found if f[0] >= bar]
