"""Language-model scores by online logistic mixing of bit predictors.

A text is a run of tokens: its words, ASCII capitals lowered, then one end.  A token is coded as its bytes and
a terminator, each byte as eight binary decisions.  For each decision predictors look up how
often 1 and 0 followed the same context in the training texts: hashed contexts of the kind of text and the last
1, 2, 3, 4 and 6 bytes of the word, in tables of fixed size, and the word's whole beginning, in exact
tries, of that kind and of all texts, that grow with the corpus.  Their log odds are mixed by a weight
vector that a gate selects (how well the beginning is known, how long a context is known, how far into the
byte), and an adaptive probability map corrects the mixture by what followed such predictions before.

The bits of a word depend on the word alone, so each distinct word is evaluated once per kind.  What the word
before it tells comes in above them: exact counts of all pairs of neighbours in the training texts, discounted by what leaving each
out of its own count would cost, and what the discount takes from a word's followers goes to all words by their bits.
The end of the last text stands before a first word.

Kinds are the most frequent values of a column of the training rows.  The kind of a text is never
looked at when it is scored: its probability is the sum over kinds, by their share of training texts, of
what each gives it.


1. words are counted, per task and then by word, and stored in ranges of their bytes, so that a range
   holds whole runs of every beginning; what two ranges share is added up apart;
2. context tables are summed over tasks in slices of slots;
3. each range learns weights online, batch by batch, and the map with them; a token is left out of its
   own counts, as it would not be known when it came.  Weights are averaged by evidence, over steps and ranges.
   What words that begin alike have in common is one trie edge, looked at once with their counts together;
4. every distinct word is scored;
5. texts become batches of word numbers.  A batch asks for what it needs, each distinct word and pair once,
   of the parts that hold them by hash: a part counts the pairs of all batches and answers each.  Pairs with the same
   word before are in one part, or in several by the second word where it is frequent; scores of frequent words,
   a bounded number, are broadcast;
6. each batch adds up its texts from the answers.

Words are told apart by 64 bits of a hash from step 5 on, second words of pairs by 48 bits below one first word.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm.words import tidied
from gleanery.sources.scratch import discard, passing, scratch_path, small_batches, written

ORDERS = (1, 2, 3, 4, 6)
#: Slots of a context table and of a slice (powers of two), symbols in the tries.
SLOT_BITS, SLICE_BITS, DEPTH = 21, 15, 16
#: Symbols of a word that may be edges in common; words and bytes of a range on average.
COMMON = 64
RANGE_WORDS, RANGE_BYTES = 32_768, 2 << 20
#: Bytes of words that a task counts, as each hands on whole tables.
COUNT_BYTES = 12 << 20
#: Words whose scores are broadcast, at most; symbols of one online step.
FREQUENT, STEP = 65_536, 1_024
#: Tokens whose pairs one part counts on average; tokens of one word above which pairs that it begins are spread over parts.
PART_TOKENS, HOT = 1_500_000, 190_000
#: Bytes of a batch of texts, at least where a task has as many.
BATCH_BYTES = 7 << 20
#: The least discount, so that words that never followed another have a chance there.
LEAST = 0.05
#: Kinds of text: the most frequent values, and one for all others.
KINDS = 5
END = b"\n"

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
#: What each of a byte's decisions adds to the hash of a context.
_SPREAD = np.arange(256, dtype=np.uint64) * _ODD[2]
_KNOWN = np.array([0.5, 1.5, 2.5, 4.5, 8.5, 32.5, 256.5], np.float32)
_BUCKETS, _REACH, _PRIOR, _RATE = 33, 8.0, 32.0, 0.15
_GATES, _MAPS = 8 * 2 * 5 * 2 * 2, 8 * 8
_INPUTS = len(ORDERS) + 3


def numbered_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of *texts*, last the end; of every token, a text's words and its end, the place among them; the number of tokens of each text.

    Words are what ASCII white space parts; NUL, which ends a word's code, stands as a blank inside words.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    filled = pc.greater(pc.binary_length(flat), 0)  # white space at an end leaves an empty word there
    text = np.repeat(np.arange(len(sizes)), sizes)[filled.to_numpy(zero_copy_only=False)]
    words, sizes = flat.filter(filled).dictionary_encode(), np.bincount(text, minlength=len(sizes)) + 1
    names = [w.replace(b"\0", b" ") if b"\0" in w else w for w in words.dictionary.cast(pa.binary()).to_pylist()]
    inside = np.ones(sizes.sum(), bool)
    inside[np.cumsum(sizes) - 1] = False
    places = np.full(len(inside), len(names), np.int32)
    places[inside] = words.indices.to_numpy()
    return [*names, END], places, sizes


def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of *batches* in batches of some ``BATCH_BYTES`` of text, none without rows."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows + (pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0)
        if size >= BATCH_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class Symbols:
    """Words as one run of bytes, each word with its terminator."""

    def __init__(self, words: list[bytes]):
        self.flat = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        self.sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.word = np.repeat(np.arange(len(words)), self.sizes)
        self.place = np.arange(len(self.flat)) - self.starts[self.word]

    def before(self, at: np.ndarray) -> np.ndarray:
        """For each order the bytes before the symbols *at* as one number, zeros before the word."""
        place, value, out = self.place[at], np.zeros(len(at), np.uint64), []
        for back in range(1, max(ORDERS) + 1):
            byte = np.where(place >= back, self.flat[np.maximum(at - back, 0)], 0).astype(np.uint64)
            value |= byte << np.uint64(8 * (back - 1))
            if back in ORDERS:
                out.append(value + np.uint64(back))
        return np.stack(out)


def _contexts(before: np.ndarray, kind: int) -> np.ndarray:
    """For each order a hash of *kind* and the bytes *before* the symbols."""
    mixed = before + (np.uint64(kind + 1) << np.uint64(52))
    mixed *= _ODD[0]
    mixed ^= mixed >> np.uint64(29)
    mixed *= _ODD[1]
    return mixed


def _slots(context: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    mixed = context ^ _SPREAD[node]
    mixed *= _ODD[0]
    mixed >>= np.uint64(64 - bits)
    return mixed.view(np.int64)


def _decision(wide: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """Which decision of its byte each symbol is at, and how it goes."""
    return (1 << bit) | (wide >> (8 - bit)), (wide >> (7 - bit)) & 1


def count_contexts(words: list[bytes], counts: np.ndarray, kind: int, tables: np.ndarray) -> None:
    """Adds what follows the hashed contexts of *words* in texts of *kind* to *tables* (order, slot, bit)."""
    own = Symbols(words)
    bits = tables.shape[1].bit_length() - 1
    weight = counts[own.word].astype(np.float32)
    for at in range(0, len(own.flat), 1 << 18):
        j = np.arange(at, min(at + (1 << 18), len(own.flat)))
        contexts, wide = _contexts(own.before(j), kind), own.flat[j].astype(np.int64)
        for bit in range(8):
            node, goes = _decision(wide, bit)
            for k, context in enumerate(contexts):
                np.add.at(tables[k].reshape(-1), _slots(context, node, bits) * 2 + goes, weight[j])


class Edges:
    """The symbols of sorted distinct words, those of equal beginnings once.

    ``at`` are the places of the edges in the words' bytes, ``edge`` the edge of every symbol.
    Symbols beyond ``COMMON`` are edges of their own.
    """

    def __init__(self, own: Symbols):
        n = len(own.sizes)
        self.own, self.heads = own, np.zeros((n, COMMON), np.uint8)
        for p in range(COMMON):
            alive = np.flatnonzero(own.sizes > p)
            if not len(alive):
                break
            self.heads[alive, p] = own.flat[own.starts[alive] + p]
        differ = self.heads[1:] != self.heads[:-1]
        self.alike = np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), COMMON)]) if n else np.zeros(0, int)
        fresh = (own.place >= self.alike[own.word]) | (own.place >= COMMON)
        self.at = np.flatnonzero(fresh)
        self.symbols = own.flat[self.at].astype(np.int64)
        rank = np.cumsum(fresh) - 1
        self.edge, rows = rank.copy(), np.arange(n)
        for p in range(COMMON):
            alive = np.flatnonzero(own.sizes > p)
            if not len(alive):
                break
            first = np.maximum.accumulate(np.where(self.alike <= p, rows, 0))[alive]
            self.edge[own.starts[alive] + p] = rank[own.starts[first] + p]

    @functools.cached_property
    def before(self) -> np.ndarray:
        return self.own.before(self.at)

    def weights(self, counts: np.ndarray) -> np.ndarray:
        """Counts of the words that each edge is part of."""
        return np.bincount(self.edge, weights=counts[self.own.word], minlength=len(self.at))


class Tries:
    """Counts below every beginning, to the bit, of sorted distinct words; one trie per row of *counts*, and last that of their sum.

    ``zeros`` and ``ones`` hold, per trie and for each decision of each edge in the first ``DEPTH`` symbols,
    the counts of what follows among all words that begin alike.  *shared* has the whole
    counts of beginnings that other ranges hold too; ``ends`` are this range's own of these.
    """

    def __init__(self, edges: Edges, counts: np.ndarray, shared: dict[bytes, np.ndarray] | None = None, ends_alone: bool = False):
        own, heads, n = edges.own, edges.heads[:, :DEPTH], len(edges.own.sizes)
        first = np.minimum(edges.alike[1:], DEPTH - 1)
        byte = heads[1:][np.arange(n - 1), first] ^ heads[:-1][np.arange(n - 1), first]
        parts = np.where((byte > 0) & (edges.alike[1:] < DEPTH), 8 * first + 7 - np.log2(np.maximum(byte, 1)).astype(np.int64), 8 * DEPTH)
        weight = np.concatenate([counts, counts.sum(axis=0, keepdims=True)])
        below = np.pad(np.cumsum(weight, axis=1), ((0, 0), (1, 0))).astype(np.float64)  # of all words before one
        self.zeros, self.ones = (np.zeros((len(weight), 8, 0 if ends_alone else len(edges.at)), np.float32) for _ in range(2))
        self.ends: dict[bytes, np.ndarray] = {}
        heads_of = [int.from_bytes(heads[i].tobytes()) for i in (0, n - 1)]
        for t in range(8 * DEPTH):
            p, bit = divmod(t, 8)
            if bit == 0:
                rows = np.flatnonzero((own.sizes > p) & (edges.alike <= p))  # edges of their own
                spot, rows = edges.edge[own.starts[rows] + p], np.append(rows, [0, n - 1])
                longest = own.sizes.max() > p
            if not longest:
                break
            new = np.concatenate([[True], parts < t])
            starts, run = np.append(np.flatnonzero(new), n), (np.cumsum(new) - 1)[rows]
            start, till = starts[run], starts[run + 1]
            high = np.append(0, np.cumsum((heads[:, p] >> (7 - bit)) & 1, dtype=np.int64))
            middle = till - high[till] + high[start]  # words are sorted: those that go on with 1 are last
            zeros, ones = below[:, middle] - below[:, start], below[:, till] - below[:, middle]
            for row, head, at in ((0, heads_of[0], -2), (n - 1, heads_of[1], -1)):
                if own.sizes[row] > p:
                    key = bytes([t]) + (head >> (8 * DEPTH - t)).to_bytes(DEPTH)
                    self.ends[key] = np.stack([zeros[:, at], ones[:, at]])
                    if shared is not None:
                        alike = run == run[at]
                        zeros[:, alike], ones[:, alike] = (c[:, None] for c in shared[key])
            if not ends_alone:
                self.zeros[:, bit, spot], self.ones[:, bit, spot] = zeros[:, :-2], ones[:, :-2]


def _odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.clip(np.log((ones + 0.4) / (zeros + 0.4)), -_REACH, _REACH)


def _chance(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -12.0, 12.0)))


class Mixer:
    """Gated weights and the probability map, with the context tables they read."""

    def __init__(self, tables: np.ndarray, weights: np.ndarray | None = None, seen: np.ndarray | None = None):
        self.tables, self.bits = tables, tables.shape[1].bit_length() - 1
        self._pairs = tables.view(np.uint64).reshape(tables.shape[:2])  # both counts of a slot as one item
        if weights is None:
            weights = np.full((_GATES, _INPUTS), 0.25)
            weights[:, -1] = 0.0
        centres = np.linspace(-_REACH, _REACH, _BUCKETS)
        base = _PRIOR * np.stack([1 - _chance(centres), _chance(centres)], axis=1)
        self.weights, self.seen = weights, np.broadcast_to(base, (_MAPS, _BUCKETS, 2)).copy() if seen is None else seen
        self.evidence, self.sums, self._squares = np.zeros(_GATES), np.zeros((_GATES, _INPUTS)), np.full((_GATES, _INPUTS), 1e-4)

    def _look(self, edges: Edges, tries: Tries, kind: int, at: np.ndarray, wide: np.ndarray, contexts: np.ndarray, bit: int, leave_out: bool):
        """Inputs, gates, map rows and outcomes of decision *bit* of the edges *at*, of symbols *wide*, in texts of *kind*."""
        node, goes = _decision(wide, bit)
        zeros, ones = (np.empty((len(ORDERS) + 2, len(at)), np.float32) for _ in range(2))
        for k, context in enumerate(contexts):
            found = self._pairs[k].take(_slots(context, node, self.bits)).view(np.float32)
            zeros[k], ones[k] = found[::2], found[1::2]
        for k, trie in ((len(ORDERS), kind), (len(ORDERS) + 1, -1)):
            zeros[k], ones[k] = tries.zeros[trie, bit].take(at), tries.ones[trie, bit].take(at)
        if leave_out:
            zeros, ones = np.maximum(zeros - (1 - goes), 0), np.maximum(ones - goes, 0)
        inputs = np.concatenate([_odds(zeros, ones), np.ones((1, len(at)), np.float32)])
        known = np.searchsorted(_KNOWN, zeros[-2] + ones[-2])
        reach = (zeros[1:-2] + ones[1:-2] > 0).sum(axis=0)
        sure = np.minimum(zeros[-2], ones[-2]) == 0
        anywhere = zeros[-1] + ones[-1] > 0
        gate = (((known * 2 + sure) * 5 + reach) * 2 + anywhere) * 2 + (bit < 3)
        return inputs, gate, known * 8 + bit, goes

    def _spots(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Map buckets beside *x*, and how far it is to the upper one."""
        spot = (np.clip(x, -_REACH, _REACH) + _REACH) * ((_BUCKETS - 1) / (2 * _REACH))
        low = np.minimum(spot.astype(np.int64), _BUCKETS - 2)
        return low, spot - low

    def learn(self, edges: Edges, tries: Tries, kind: int, weights: np.ndarray, order: np.ndarray) -> None:
        """One online pass over the edges in *order*, each for as many tokens as *weights* says."""
        for start in range(0, len(order), STEP):
            at = order[start : start + STEP]
            weight, wide, contexts = weights[at], edges.symbols[at], _contexts(edges.before[:, at], kind)
            for bit in range(8):
                inputs, gate, rows, goes = self._look(edges, tries, kind, at, wide, contexts, bit, True)
                x = np.einsum("nk,kn->n", self.weights[gate], inputs)
                error = weight * (goes - _chance(x))
                mass = np.bincount(gate, weights=weight, minlength=_GATES)
                slope = np.stack([np.bincount(gate, weights=error * i, minlength=_GATES) for i in inputs], axis=1) / np.maximum(mass, 1)[:, None]
                self._squares += slope * slope
                self.weights += _RATE * slope / np.sqrt(self._squares)
                self.evidence += mass
                self.sums += mass[:, None] * self.weights
                low, share = self._spots(x)
                spot = (rows * _BUCKETS + low) * 2 + goes
                seen = np.bincount(spot, weights=weight * (1 - share), minlength=self.seen.size) + np.bincount(spot + 2, weights=weight * share, minlength=self.seen.size)
                self.seen += seen.reshape(self.seen.shape)

    def bits_of(self, edges: Edges, tries: Tries, kind: int) -> np.ndarray:
        """The code length of every word in texts of *kind*, in bits."""
        spent, mapped = np.zeros(len(edges.at)), (self.seen[:, :, 1] / self.seen.sum(axis=2)).ravel()
        for start in range(0, len(spent), 16 * STEP):
            at = np.arange(start, min(start + 16 * STEP, len(spent)))
            wide, contexts = edges.symbols[at], _contexts(edges.before[:, at], kind)
            for bit in range(8):
                inputs, gate, rows, goes = self._look(edges, tries, kind, at, wide, contexts, bit, False)
                x = np.einsum("nk,kn->n", self.weights[gate], inputs)
                low, share = self._spots(x)
                low += rows * _BUCKETS
                chance = np.clip((_chance(x) + (mapped.take(low) * (1 - share) + mapped.take(low + 1) * share)) / 2, 2.0**-20, 1 - 2.0**-20)
                spent[at] -= np.log2(np.where(goes == 1, chance, 1 - chance))
        return np.bincount(edges.own.word, weights=spent[edges.edge], minlength=len(edges.own.sizes))


# --- over tables ------------------------------------------------------------------------


def _training(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 7 != 2


_COUNTS = [f"c{kind}" for kind in range(KINDS)]
_BITS = [f"bits{kind}" for kind in range(KINDS)]


def word_counts(docs: DataFrame, kind: Column, text: str = "text") -> DataFrame:
    """``word, c0, c1, ..., met`` of every word of *docs* and the end: its counts in training texts by *kind*, which is NULL for other texts, and in all."""
    rows = docs.select(F.col(text).alias("text"), F.coalesce(kind, F.lit(-1)).alias("kind"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            names, places, sizes = numbered_words(batch.column("text"))
            own = np.repeat(batch.column("kind").to_numpy().astype(np.int64) + 1, sizes)
            counts = np.bincount(own * len(names) + places, minlength=(KINDS + 1) * len(names))
            found = np.flatnonzero(counts)
            kinds, places = np.divmod(found, len(names))
            words = pa.array(names, pa.binary()).take(pa.array(places))
            yield pa.RecordBatch.from_arrays([words, pa.array(kinds - 1, pa.int32()), pa.array(counts[found], pa.int64())], names=["word", "kind", "c"])

    counted = rows.mapInArrow(tidied(run), "word binary, kind int, c bigint")
    of_kinds = (F.sum(F.when(F.col("kind") == k, F.col("c")).otherwise(0)).alias(c) for k, c in enumerate(_COUNTS))
    return counted.groupBy("word").agg(*of_kinds, F.sum("c").alias("met"))


def _matrix(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    """Counts by kind and word."""
    return np.stack([table.column(c).to_numpy() for c in _COUNTS])


def _tables(words: DataFrame, n_bytes: int) -> np.ndarray:
    """The context tables of the training words, of fixed size: per task, which reads some ``COUNT_BYTES`` of words, then summed slice by slice."""
    slots, step = 1 << SLOT_BITS, 1 << min(SLICE_BITS, SLOT_BITS)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((len(ORDERS), slots, 2), np.float32)
        for batch in batches:
            names = batch.column("word").to_pylist()
            for kind, counts in enumerate(_matrix(batch) if names else ()):
                found = np.flatnonzero(counts)
                if len(found):
                    count_contexts([names[i] for i in found], counts[found], kind, tables)
        for k in range(len(ORDERS)):
            for at in range(0, slots, step):
                part = tables[k, at : at + step]
                if part.any():
                    yield pa.RecordBatch.from_pydict({"k": pa.array([k], pa.int32()), "at": pa.array([at], pa.int32()), "counts": [part.tobytes()]})

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, k, at = np.zeros(2 * step), None, None
        for batch in rows:
            for i in range(batch.num_rows):
                k, at = batch.column("k")[i].as_py(), batch.column("at")[i].as_py()
                total += np.frombuffer(batch.column("counts")[i].as_buffer(), np.float32)
        yield pa.RecordBatch.from_pydict({"k": pa.array([k], pa.int32()), "at": pa.array([at], pa.int32()), "counts": [total.astype(np.float32).tobytes()]})

    schema = "k int, at int, counts binary"
    tables = np.zeros((len(ORDERS), slots, 2), np.float32)
    sums = written(words.select("word", *_COUNTS).coalesce(max(1, n_bytes // COUNT_BYTES)).mapInArrow(tidied(count), schema).groupBy("k", "at").applyInArrow(add, schema), "tables", compact=True)
    for row in sums.toLocalIterator():
        tables[row["k"], row["at"] : row["at"] + step] = np.frombuffer(row["counts"], np.float32).reshape(-1, 2)
    return tables


def _sorted(words: pa.Table) -> tuple[list[bytes], np.ndarray]:
    words = words.sort_by("word")
    return words.column("word").to_pylist(), _matrix(words)


def _shared(ranges: DataFrame) -> DataFrame:
    """``part, key, counts``: whole counts, by trie, of the beginnings of each range's first and last word, at most 256 a range."""

    def ends(words: pa.Table) -> pa.Table:
        names, counts = _sorted(words)
        found = Tries(Edges(Symbols(names)), counts, ends_alone=True).ends
        part = pa.repeat(words.column("part")[0], len(found))
        return pa.Table.from_pydict({"part": part, "key": pa.array(list(found), pa.binary()), "counts": [v.ravel() for v in found.values()]})

    found = written(ranges.groupBy("part").applyInArrow(ends, "part int, key binary, counts array<double>"), "ends", compact=True)
    size = range(2 * KINDS + 2)
    whole = found.groupBy("key").agg(F.array(*(F.sum(F.get("counts", F.lit(i))) for i in size)).alias("counts"))
    return written(found.select("part", "key").join(whole, "key"), "shared", compact=True)


def _held(shared: pa.Table) -> dict[bytes, np.ndarray]:
    return {k: np.reshape(v, (2, KINDS + 1)) for k, v in zip(shared.column("key").to_pylist(), shared.column("counts").to_pylist(), strict=True)}


def fit(ranges: DataFrame, shared: DataFrame, held, seed: int = 5) -> Mixer:
    """The model of stored *ranges* (word, counts by kind, part) with the broadcast tables *held*; *shared* are the counts that ranges share."""

    def learn(words: pa.Table, shared: pa.Table) -> pa.Table:
        names, counts = _sorted(words)
        edges, mixer, random = Edges(Symbols(names)), Mixer(held.value), np.random.default_rng(seed)
        before, tries = mixer.seen.copy(), Tries(edges, counts, _held(shared))
        for kind in range(KINDS):
            weights = edges.weights(counts[kind])
            mixer.learn(edges, tries, kind, weights, random.permutation(np.flatnonzero(weights)))
        learnt = np.concatenate([mixer.sums.ravel(), mixer.evidence, (mixer.seen - before).ravel()])
        at = np.flatnonzero(learnt)
        return pa.Table.from_pydict({"at": pa.array(at, pa.int32()), "value": learnt[at]})

    mixer = Mixer(np.zeros((len(ORDERS), 1, 2), np.float32))  # the driver needs no tables
    learnt = np.zeros(mixer.weights.size + _GATES + mixer.seen.size)
    found = ranges.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(learn, "at int, value double")
    for row in found.groupBy("at").agg(F.sum("value").alias("value")).collect():  # no more than the model has parameters
        learnt[row["at"]] = row["value"]
    weights, evidence, seen = np.split(learnt, [mixer.weights.size, mixer.weights.size + _GATES])
    taught = evidence > 0
    mixer.weights[taught] = weights.reshape(mixer.weights.shape)[taught] / evidence[taught, None]
    mixer.seen += seen.reshape(mixer.seen.shape)
    return mixer


def score_words(ranges: DataFrame, shared: DataFrame, held, mixer: Mixer, kinds: list[int]) -> DataFrame:
    """``hash, c, bits0, bits1, ...`` of every word of *ranges*: its count in all training texts, its code length in each of *kinds*, else 0."""
    learnt, seen = mixer.weights, mixer.seen

    def score(words: pa.Table, shared: pa.Table) -> pa.Table:
        names, counts = _sorted(words)
        edges, mixer = Edges(Symbols(names)), Mixer(held.value, learnt, seen)
        tries = Tries(edges, counts, _held(shared))
        bits = [mixer.bits_of(edges, tries, kind) if kind in kinds else np.zeros(len(names)) for kind in range(KINDS)]
        columns = [pa.array(hashes_of(names).view(np.int64)), pa.array(counts.sum(axis=0)), *(pa.array(b.astype(np.float32)) for b in bits)]
        return pa.Table.from_arrays(columns, names=["hash", "c", *_BITS])

    return ranges.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(score, f"hash bigint, c bigint, {', '.join(f'{b} float' for b in _BITS)}")


# --- neighbours -------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(odd)
    x ^= x >> np.uint64(31)
    return x


def hashes_of(words: Iterable[bytes]) -> np.ndarray:
    """64 bits of each word: a sum of numbers, as if drawn by chance, for every byte at every place, mixed."""
    own = list(words)
    if not own:
        return np.zeros(0, np.uint64)
    own = Symbols(own)
    drawn = _mixed((own.place.astype(np.uint64) * np.uint64(256) + own.flat + np.uint64(1)) * _ODD[0])
    return _mixed(np.add.reduceat(drawn, own.starts))


def _find(sorted_hashes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The place of each of *hashes* among the sorted ones, else -1."""
    if not len(sorted_hashes):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(sorted_hashes, hashes), len(sorted_hashes) - 1)
    return np.where(sorted_hashes[at] == hashes, at, -1)


def _runs(parts: np.ndarray, n_parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Items in the order of their parts, and where each part begins and ends."""
    order = np.argsort(parts.astype(np.min_scalar_type(n_parts)), kind="stable")  # linear in time for small types
    return order, np.append(0, np.cumsum(np.bincount(parts.astype(np.int64), minlength=n_parts)))


class Asked:
    """What a batch of texts asks for: distinct words that are not frequent, and distinct pairs, each in the order of the parts that know them.

    *hashes* are those of its distinct words, *tokens* the places in them of its texts' words, each text with its end.  *frequent*
    are sorted hashes of words known to all, *hot* those of words whose followers lie in as many parts as *spread* says.
    """

    def __init__(self, hashes: np.ndarray, tokens: np.ndarray, n_parts: int, frequent: np.ndarray, hot: np.ndarray, spread: np.ndarray):
        n, own = len(hashes), (hashes >> np.uint64(32)) % np.uint64(n_parts)
        self.frequent = _find(frequent, hashes)
        self.rare = np.flatnonzero(self.frequent < 0)
        order, self.word_bounds = _runs(own[self.rare], n_parts)
        self.rare = self.rare[order]
        pairs, which = np.unique(np.roll(tokens, 1).astype(np.int64) * n + tokens, return_inverse=True)
        first, second = np.divmod(pairs, n)
        self.hot = _find(hot, hashes)
        wide = self.hot[first] >= 0
        parts = own[first]
        parts[wide] = (parts[wide] + (hashes[second[wide]] >> np.uint64(32)) % spread[self.hot[first[wide]]]) % np.uint64(n_parts)
        order, self.bounds = _runs(parts, n_parts)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.first, self.second, self.which = first[order], second[order], rank[which]
        parts = parts[order]
        #: Where pairs with another first word begin.
        self.starts = np.flatnonzero(np.append(True, (self.first[1:] != self.first[:-1]) | (parts[1:] != parts[:-1])))
        self.start_bounds = np.searchsorted(self.starts, self.bounds)
        self.sizes = np.diff(np.append(self.starts, len(self.first)))


def packed(*values: np.ndarray) -> bytes:
    """Arrays as compressed bytes; first all items' first bytes, then the second, as high ones are alike."""
    planes = [np.ascontiguousarray(v).view(np.uint8).reshape(len(v), v.itemsize).T.tobytes() for v in values]
    return np.array([len(v) for v in values], np.int64).tobytes() + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpacked(data: bytes, *kinds: type) -> list[np.ndarray]:
    sizes, width = np.frombuffer(data, np.int64, len(kinds)), [np.dtype(k).itemsize for k in kinds]
    planes = np.frombuffer(pa.decompress(data[8 * len(kinds) :], int(sizes @ width), codec="zstd", asbytes=True), np.uint8)
    ends = np.cumsum(sizes * width)
    return [np.ascontiguousarray(planes[e - n * w : e].reshape(w, n).T).view(k).ravel() for e, n, w, k in zip(ends, sizes, width, kinds, strict=True)]


#: Kinds of rows between batches and parts: a batch itself, its words or pairs or the answers to them, and sums of a part.
_BATCH, _WORDS, _PAIRS, _SUMS = range(4)
#: Of a pair's second word the place among frequent words, or this and six bytes of its hash.
_OTHER = 65_535


def second_words(frequent: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Short names of words by their places among *frequent* ones, -1 for others, and *hashes*."""
    other = (frequent < 0) | (frequent >= _OTHER)
    return np.where(other, _OTHER, frequent).astype(np.uint16), hashes[other].view(np.uint8).reshape(-1, 8)[:, :6].ravel()


def count_pairs(sent: pa.Table, hot: np.ndarray) -> pa.Table:
    """Answers to the pairs sent to one part: to each batch the training counts of its pairs, and counts and followers of their first words; last sums over the part.

    The sums are how many pairs occur once and twice, and counts and followers within the part of the *hot* words.
    """
    asked = [unpacked(d, np.uint64, np.int32, np.uint16, np.uint8, np.int32) for d in sent.column("data").to_pylist()]
    starts, sizes, short, long, counts = (np.concatenate(v) for v in zip(*asked, strict=True))
    first, second = np.repeat(starts, sizes), short.astype(np.uint64)
    wide = np.zeros((len(long) // 6, 8), np.uint8)
    wide[:, :6] = long.reshape(-1, 6)
    second[short == _OTHER] = wide.view(np.uint64).ravel() | np.uint64(1 << 63)
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    other_first = np.append(True, first[1:] != first[:-1])
    other = other_first | np.append(True, second[1:] != second[:-1])
    pair = np.cumsum(other) - 1
    of_pair = np.bincount(pair, weights=counts[order]).astype(np.int64)
    word_of_pair = np.cumsum(other_first[other]) - 1
    of_word = np.bincount(word_of_pair, weights=of_pair).astype(np.int64)
    followers = np.bincount(word_of_pair, weights=of_pair > 0).astype(np.int64)
    found = np.empty(len(order), np.int64)
    found[order] = of_pair[pair]
    names = first[other_first]
    at = np.searchsorted(names, starts)
    whole = np.flatnonzero(_find(hot, names) >= 0)
    n_starts, n_pairs = (np.cumsum([len(a[k]) for a in asked])[:-1] for k in (0, 4))
    answers = map(packed, np.split(found, n_pairs), np.split(of_word[at], n_starts), np.split(followers[at], n_starts))
    sums = packed(np.array([(of_pair == 1).sum(), (of_pair == 2).sum()]), of_word[whole], followers[whole], names[whole])
    n = sent.num_rows
    columns = [
        pa.concat_arrays([*sent.column("batch").chunks, pa.nulls(1, pa.int64())]), pa.array([_PAIRS] * n + [_SUMS], pa.int32()),
        pa.concat_arrays([*sent.column("part").chunks, pa.nulls(1, pa.int32())]), pa.array([*answers, sums], pa.binary()),
    ]
    return pa.Table.from_arrays(columns, names=["batch", "what", "part", "data"])


def look_up(sent: pa.Table, words: pa.Table) -> pa.Table:
    """Answers to the words sent to one part, which has the scores of *words*: their counts, and their bits by kind."""
    hashes = words.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    hashes, c = hashes[order], words.column("c").to_numpy()[order]
    bits = [words.column(b).to_numpy()[order] for b in _BITS]
    asked = [_find(hashes, unpacked(d, np.uint64)[0]) for d in sent.column("data").to_pylist()]
    if any((at < 0).any() for at in asked):
        raise ValueError("a word of the texts was not counted")
    answers = [packed(c[at], *(b[at] for b in bits)) for at in asked]
    columns = [sent.column("batch"), pa.array([_WORDS] * len(asked), pa.int32()), sent.column("part"), pa.array(answers, pa.binary())]
    return pa.Table.from_arrays(columns, names=["batch", "what", "part", "data"])


_ANSWERS = "batch bigint, what int, part int, data binary"


def follow(counts: np.ndarray, of_first: np.ndarray, followers: np.ndarray, discount: float) -> Callable[[np.ndarray], np.ndarray]:
    """What gives the log2 chances of words, from their bits, after words met *of_first* times with so many *followers*, of which *counts* times with this one.

    Over all words chances add up to no more than those of bits do, or 1.
    """
    known, seen = of_first > 0, np.flatnonzero(counts > discount)
    rest = np.zeros(len(counts))
    rest[known] = np.log2(discount * followers[known] / of_first[known])
    kept = (counts[seen] - discount) / of_first[seen]

    def chances(bits: np.ndarray) -> np.ndarray:
        out = rest - bits
        out[seen] = np.log2(kept + np.exp2(out[seen]))
        return out

    return chances


def _kind(docs: DataFrame, training: Column, column: str | None) -> Column:
    """The number of a training row's kind, NULL for other rows."""
    if column is None:
        return F.when(training, 0)
    most = docs.filter(training & F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("kind")).count()
    names = [r["kind"] for r in most.orderBy(F.desc("count"), "kind").limit(KINDS - 1).collect()]
    number = F.lit(KINDS - 1)
    for at, name in enumerate(names):
        number = F.when(F.col(column).cast("string") == name, at).otherwise(number)
    return F.when(training, number)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", kind: str | None = "lang") -> DataFrame:
    """Every row of *docs* scored by a model of those whose crc32 of *key*, as text, mod 7 is not 2.

    *key*, ``held_out``, ``n_tokens`` (the end included), ``n_known`` (tokens that occur in training), ``train_tokens``,
    ``base_score`` (add-one unigram) and ``score``, both log10, and ``bits_per_byte`` of the text's bytes.
    *kind* is read of training rows only; NULL and rare values are one kind, None makes all rows one.
    A NULL text is empty, its one token the end; a NULL key is empty text and trains; rows repeated count
    and are scored each.  Without training rows every decision has even odds.
    Other columns are not read.
    """
    with small_batches(docs.sparkSession):  # what is returned has no Python step left
        return _scored(docs, key, text, kind)


def _scored(docs: DataFrame, key: str, text: str, kind: str | None) -> DataFrame:
    spark, path, training = docs.sparkSession, scratch_path(docs.sparkSession, "totals"), _training(F.col(key))
    with passing(spark):
        paths = {name: scratch_path(spark, name) for name in ("sent", "pairs", "answers")}
        with passing(spark):
            stored = scratch_path(spark, "scored")
            with passing(spark):
                counted = written(word_counts(docs, _kind(docs, training, kind), text), "words")
                whole = sum((F.col(c) for c in _COUNTS[1:]), F.col(_COUNTS[0]))
                n_train, n_types, n_words, n_bytes, n_met = counted.agg(
                    F.coalesce(F.sum(whole), F.lit(0)), F.count_if(whole > 0), F.count("*"), F.coalesce(F.sum(F.length("word")), F.lit(0)), F.coalesce(F.sum("met"), F.lit(0))
                ).first()
                hot = [(bytes(r["word"]), r["met"]) for r in counted.filter(F.col("met") > HOT).select("word", "met").collect()]  # at most one in HOT tokens
                n_ranges = max(1, math.ceil(n_words / RANGE_WORDS), math.ceil(n_bytes / RANGE_BYTES))
                ranges = written(counted.drop("met").repartitionByRange(n_ranges, "word").withColumn("part", F.spark_partition_id()), "ranges")
                ends = counted.filter(F.col("word") == F.lit(bytearray(END))).select(*_COUNTS).first()  # one a text
                texts = dict(enumerate(ends or ()))
                kinds = [k for k, n in texts.items() if n] or [0]
                shares = {k: math.log10(texts[k] / sum(texts.values())) if texts.get(k) else 0.0 for k in kinds}
                shared = _shared(ranges)
                held = spark.sparkContext.broadcast(_tables(ranges, n_bytes))
                scored = written(score_words(ranges, shared, held, fit(ranges, shared, held), kinds), "scored", stored)
                held.destroy()
            rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), training.alias("train"))
            model = _answered(rows, scored, hot, n_met, paths)
        totals = written(_totals(*model, rows.schema["key"].dataType, math.log10(n_train + n_types + 1), kinds), "totals", path)
    of_kinds = [F.col(_BITS[k]) + F.lit(share) for k, share in shares.items()]
    top = F.greatest(*of_kinds) if len(of_kinds) > 1 else of_kinds[0]
    whole = top + F.log10(sum((F.pow(F.lit(10.0), k - top) for k in of_kinds), F.lit(0.0)))
    return totals.select(
        F.col("key").alias(key), (~_training(F.col("key"))).alias("held_out"), "n_tokens", "n_known",
        F.lit(n_train).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), whole.alias("score"),
        (-whole / F.lit(math.log10(2)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )


def _frequent(scored: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes, counts and bits of the most frequent words, as many as are certainly no more than ``FREQUENT``."""
    size = F.floor(F.log2(F.col("c") + 1) * 32).cast("int")
    least, found = None, 0
    for row in sorted(scored.groupBy(size.alias("size")).count().collect(), key=lambda r: -r["size"]):  # some 32 sizes for each doubling
        found += row["count"]
        if found > FREQUENT:
            break
        least = row["size"]
    rows = scored.filter(size >= least if least is not None else F.lit(False)).select("hash", "c", *_BITS).toPandas()
    hashes = rows["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], rows["c"].to_numpy(np.int64)[order], rows[_BITS].to_numpy(np.float64)[order]


def _answered(rows: DataFrame, scored: DataFrame, hot: list[tuple[bytes, int]], n_tokens: int, paths: dict[str, str]):
    """*rows* (key, text, train) as batches, the answers to what they ask, and what all know: how parts are found, scores of frequent words and sums of hot ones, the discount.

    *scored* are all words, *hot* frequent ones with their counts in all texts, *n_tokens* those of all texts.
    """
    spark, n_parts = rows.sparkSession, max(1, math.ceil(n_tokens / PART_TOKENS))
    names = hashes_of(word for word, _ in hot)
    order = np.argsort(names)
    names, spread = names[order], np.array([min(n_parts, 1 + n // HOT) for _, n in hot], np.uint64)[order]
    frequent, *scores = _frequent(scored)
    known = spark.sparkContext.broadcast((n_parts, frequent, names, spread))
    schema = T.StructType([
        T.StructField("batch", T.LongType()), T.StructField("what", T.IntegerType()), T.StructField("part", T.IntegerType()),
        T.StructField("keys", T.ArrayType(rows.schema["key"].dataType)), T.StructField("data", T.BinaryType()),
    ])

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            names_of, tokens, sizes = numbered_words(batch.column("text"))
            hashes, n_bytes = hashes_of(names_of), pc.binary_length(pc.fill_null(batch.column("text"), "")).to_numpy().astype(np.int64)
            asked, train = Asked(hashes, tokens, *known.value), np.repeat(batch.column("train").to_numpy(zero_copy_only=False), sizes)
            counts = np.bincount(asked.which, weights=train, minlength=len(asked.first)).astype(np.int32)
            own = [(_BATCH, None, packed(hashes, tokens, sizes, n_bytes))]
            own += [(_WORDS, p, packed(hashes[asked.rare[slice(*asked.word_bounds[p : p + 2])]])) for p in np.flatnonzero(np.diff(asked.word_bounds))]
            for p in np.flatnonzero(np.diff(asked.bounds)):
                starts, pairs = slice(*asked.start_bounds[p : p + 2]), slice(*asked.bounds[p : p + 2])
                second = second_words(asked.frequent[asked.second[pairs]], hashes[asked.second[pairs]])
                own.append((_PAIRS, p, packed(hashes[asked.first[asked.starts[starts]]], asked.sizes[starts].astype(np.int32), *second, counts[pairs])))
            what, part, data = zip(*own, strict=True)
            n, keys = len(own), pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("key"))
            keys = pa.concat_arrays([keys, pa.nulls(n - 1, keys.type)])
            yield pa.RecordBatch.from_arrays([pa.repeat(batch.column("batch")[0], n), pa.array(what, pa.int32()), pa.array(part, pa.int32()), keys, pa.array(data, pa.binary())], names=schema.names)

    numbered = rows.select(F.monotonically_increasing_id().alias("batch"), "key", "text", "train")
    numbered.mapInArrow(tidied(ask), schema).write.partitionBy("what").parquet(paths["sent"])

    def sent(what: int, *columns: str) -> DataFrame:
        return spark.read.schema(schema).parquet(paths["sent"]).filter(F.col("what") == what).select("batch", *columns, "data")

    pairs = written(sent(_PAIRS, "part").groupBy("part").applyInArrow(lambda t: count_pairs(t, names), _ANSWERS), "pairs", paths["pairs"])
    discard(spark, f"{paths['sent']}/what={_PAIRS}")
    of_parts = scored.select("hash", "c", *_BITS, F.pmod(F.shiftrightunsigned("hash", 32), F.lit(n_parts)).cast("int").alias("part"))
    words = written(sent(_WORDS, "part").groupBy("part").cogroup(of_parts.groupBy("part")).applyInArrow(look_up, _ANSWERS), "answers", paths["answers"])
    discard(spark, f"{paths['sent']}/what={_WORDS}")
    once = twice = 0
    sums = np.zeros((2, len(names)), np.int64)
    for row in pairs.filter(F.col("what") == _SUMS).select("data").toLocalIterator():  # two numbers a part, and three for each part of a hot word
        n, *of_hot, found = unpacked(bytes(row["data"]), np.int64, np.int64, np.int64, np.uint64)
        once, twice = n + (once, twice)
        sums[:, _find(names, found)] += of_hot
    discount = min(max(once / max(once + 2 * twice, 1), LEAST), 1.0)
    answers = pairs.filter(F.col("what") == _PAIRS).unionByName(words)
    return sent(_BATCH, "keys"), answers, known, spark.sparkContext.broadcast((*scores, sums)), float(discount)


def _totals(batches: DataFrame, answers: DataFrame, known, scores, discount: float, key_type: T.DataType, base: float, kinds: list[int]) -> DataFrame:
    """``key, n_tokens, n_bytes, n_known, base, bits0, ...`` of every text of *batches*, the last log10 chances by kind."""

    def add(own: pa.Table, answers: pa.Table) -> pa.Table:
        hashes, tokens, sizes, n_bytes = unpacked(own.column("data")[0].as_py(), np.uint64, np.int32, np.int64, np.int64)
        asked, (f_counts, f_bits, hot_sums) = Asked(hashes, tokens, *known.value), scores.value
        c, bits = np.zeros(len(hashes), np.int64), np.zeros((KINDS, len(hashes)))
        frequent = np.flatnonzero(asked.frequent >= 0)
        c[frequent], bits[:, frequent] = f_counts[asked.frequent[frequent]], f_bits[asked.frequent[frequent]].T
        counts, of_first, followers = (np.zeros(n, np.int64) for n in (len(asked.first), len(asked.starts), len(asked.starts)))
        for what, p, data in zip(*(answers.column(name).to_pylist() for name in ("what", "part", "data")), strict=True):
            if what == _WORDS:
                at = asked.rare[slice(*asked.word_bounds[p : p + 2])]
                c[at], *found = unpacked(data, np.int64, *[np.float32] * KINDS)
                bits[:, at] = found
            else:
                starts = slice(*asked.start_bounds[p : p + 2])
                counts[slice(*asked.bounds[p : p + 2])], of_first[starts], followers[starts] = unpacked(data, np.int64, np.int64, np.int64)
        hot = asked.hot[asked.first[asked.starts]]
        of_first[hot >= 0], followers[hot >= 0] = hot_sums[:, hot[hot >= 0]]
        of_first, followers = np.repeat(of_first, asked.sizes), np.repeat(followers, asked.sizes)
        begin = np.cumsum(sizes) - sizes
        columns = {"key": own.column("keys").combine_chunks().flatten(), "n_tokens": sizes, "n_bytes": n_bytes, "n_known": np.add.reduceat((c > 0).astype(np.int64)[tokens], begin)}
        columns["base"] = np.add.reduceat(np.log10(c + 1)[tokens], begin) - sizes * base
        after = follow(counts, of_first, followers, discount)
        for kind, name in enumerate(_BITS):
            columns[name] = np.add.reduceat(after(bits[kind][asked.second])[asked.which], begin) * math.log10(2) if kind in kinds else np.zeros(len(sizes))
        return pa.Table.from_pydict(columns)

    fields = [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_bytes", "n_known")] + [T.StructField(c, T.DoubleType()) for c in ("base", *_BITS)]
    return batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(add, T.StructType([T.StructField("key", key_type), *fields]))
