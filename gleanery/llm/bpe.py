"""Byte-level BPE, encoded and decoded by DuckDB queries inside each Spark task.

A task opens one small in-memory DuckDB with the merge table.  Distinct words of
a batch become token-position rows; a recursive query joins neighbouring rows to
the merge table and contracts, in every word, the leftmost pair of least rank,
until no pair merges.  Decoding joins (position, token) rows to the token bytes
and aggregates them in order.

Pairs of the same least rank that don't overlap are contracted in one step, from
the left.  That equals one at a time as long as no merge can create a pair of
lower rank, which holds if every token, encoded alone, gives itself by merges of
rising rank; ``rising_merges`` says so, and a test holds it against the file.

A Python worker remembers words that it has encoded and runs of tokens that it has
decoded, in caches of bounded size that are emptied when full.  Nothing is
shuffled; a task holds one slice of a batch and the caches.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import tempfile
from collections.abc import Iterable, Iterator

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gleanery.llm.words import Parts, slices, whole_spaces, worker_state

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Words encoded by one recursive query, entries after which a worker's cache is
#: emptied, and characters of text taken at once.
WORDS_PER_QUERY, CACHED, SLICE = 60_000, 800_000, 8_000_000

#: What is one match of a pattern by itself: for the usual one, ASCII letters behind at most a blank; for others nothing is sure.
_WORDS = {public_tokenizers.PATTERN: re.compile(" ?[A-Za-z]+")}

#: Rows of ``state``: the token ``t`` that covers bytes [head, tail) of the batch,
#: in word ``w``, before token ``n``; ``r``: rank of the two; ``best``: least rank in the word.
_ENCODE = """
WITH RECURSIVE first AS MATERIALIZED (
  SELECT p.w, p.head, p.tail, p.t, p.follows AS n, m.t AS r FROM positions p LEFT JOIN merges m ON m.l = p.t AND m.r = p.follows
), state AS (
  SELECT f.*, b.best FROM first f JOIN (SELECT w, min(r) AS best FROM first GROUP BY w) b ON b.w = f.w
  UNION ALL
  (WITH pairs AS MATERIALIZED (SELECT w, head, tail, best FROM state WHERE r = best),
  runs AS (
    SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY w ORDER BY head) AS run
    FROM (SELECT *, head IS DISTINCT FROM lag(tail) OVER (PARTITION BY w ORDER BY head) AS fresh FROM pairs)
  ),
  chosen AS MATERIALIZED (
    SELECT h.w, h.head, h.tail AS middle, n.tail, n.n, h.best
    FROM (SELECT *, row_number() OVER (PARTITION BY w, run ORDER BY head) AS nth FROM runs) h
    JOIN state n ON n.head = h.tail WHERE h.nth % 2 = 1
  ),
  hits AS MATERIALIZED (SELECT c.w, c.head, c.middle, c.tail, c.best, CASE WHEN x.head IS NULL THEN c.n ELSE x.best END AS n FROM chosen c LEFT JOIN chosen x ON x.head = c.tail AND x.w = c.w),
  stepped AS MATERIALIZED (
    SELECT c.w, c.head, c.tail, c.t, c.n, m.t AS r FROM (
    SELECT s.w, s.head, coalesce(h.tail, s.tail) AS tail, coalesce(h.best, s.t) AS t, CASE WHEN h.head IS NOT NULL THEN h.n ELSE coalesce(g.best, s.n) END AS n
    FROM state s LEFT JOIN hits h ON h.head = s.head LEFT JOIN hits g ON g.head = s.tail AND g.w = s.w ANTI JOIN hits o ON o.middle = s.head
    WHERE s.best IS NOT NULL) c LEFT JOIN merges m ON m.l = c.t AND m.r = c.n
  )
  SELECT s.*, b.best FROM stepped s JOIN (SELECT w, min(r) AS best FROM stepped GROUP BY w) b ON b.w = s.w)
)
SELECT w, t FROM state WHERE best IS NULL ORDER BY head"""

_DECODE = """
SELECT i.run, unhex(string_agg(v.hex, '' ORDER BY i.pos)) AS bytes
FROM (SELECT run, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM given) i
JOIN tokens v ON v.id = i.id GROUP BY i.run"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def rising_merges(ranks: dict[bytes, int]) -> bool:
    """Whether each token, encoded alone, gives itself by merges of rising rank."""
    for token in ranks:
        parts, last = [token[i : i + 1] for i in range(len(token))], -1
        while len(parts) > 1:
            rank, at = min((ranks.get(parts[i] + parts[i + 1], len(ranks)), i) for i in range(len(parts) - 1))
            if not last <= rank < len(ranks):
                return False
            last, parts[at : at + 2] = rank, [parts[at] + parts[at + 1]]
    return True


@functools.cache
def _tables(path: str) -> tuple[pa.Table, pa.Table, np.ndarray, np.ndarray]:
    ranks = read_ranks(path)
    splits = [(ranks[a], ranks[b], r) for t, r in ranks.items() for i in range(1, len(t)) if (a := t[:i]) in ranks and (b := t[i:]) in ranks]
    merges = pa.table({c: pa.array(v, pa.int32()) for c, v in zip("lrt", zip(*splits, strict=True), strict=True)})
    tokens = pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]})
    starts = np.zeros(max(ranks.values()) + 1, bool)
    starts[[r for t, r in ranks.items() if not (t[:1].isalnum() or t[:1] > b"\x7f")]] = True
    return merges, tokens, np.array([ranks[bytes([b])] for b in range(256)], np.int32), starts


class Codec:
    """A worker's DuckDB with the tables of one vocabulary, and the words it has met."""

    def __init__(self, path: str = RANKS, pattern: str = public_tokenizers.PATTERN, cached: int = CACHED):
        merges, tokens, self._byte, starts = _tables(path)
        self._db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": tempfile.mkdtemp()})
        self._db.execute("SET enable_progress_bar = false")
        self._db.register("given_merges", merges)
        self._db.register("given_tokens", tokens)
        self._db.execute("CREATE TABLE merges AS FROM given_merges; CREATE TABLE tokens AS FROM given_tokens")
        self._pattern, self._word = whole_spaces(pattern), _WORDS.get(pattern, re.compile("(?!)"))
        self._starts, self._most = starts, cached
        self._decimal = [f" {i}" for i in range(len(starts))]
        self.encode = Parts(self.encode_parts, self._pattern, cached).encode
        self._trips = Parts(self._trip_parts, self._pattern, cached).of_texts
        self._words: dict[str, bytes] = {}
        self._runs: dict[bytes, bytes] = {}

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """The ids of each part, a part being whole matches of the pattern, as little-endian 32-bit integers."""
        if len(self._words) > self._most:
            self._words.clear()
        words = [[p] if self._word.fullmatch(p) else self._pattern.findall(p) for p in parts]
        unknown = list({w for of_part in words for w in of_part}.difference(self._words))
        self._words.update(zip(unknown, self.encode_words(unknown), strict=True))
        known = self._words
        return [known[w[0]] if len(w) == 1 else b"".join([known[x] for x in w]) for w in words]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, a word being one match of the pattern."""
        out = []
        for start in range(0, len(words), WORDS_PER_QUERY):
            raw = [w.encode() for w in words[start : start + WORDS_PER_QUERY]]
            size = np.array([len(b) for b in raw], np.int64)
            token = self._byte[np.frombuffer(b"".join(raw), np.uint8)]
            head = np.arange(len(token), dtype=np.int32)
            last = np.zeros(len(token), bool)
            last[(np.cumsum(size) - 1)[size > 0]] = True
            word = np.repeat(np.arange(len(raw), dtype=np.int32), size)
            follows = pa.array(np.append(token[1:], 0).astype(np.int32), mask=last)
            self._db.register("given", pa.table({"w": word, "head": head, "tail": head + 1, "t": token, "follows": follows}))
            self._db.execute("CREATE OR REPLACE TEMP TABLE positions AS FROM given")
            ids = self._db.sql(_ENCODE).to_arrow_table()
            packed, till = ids["t"].to_numpy().astype("<i4").tobytes(), 4 * np.cumsum(np.bincount(ids["w"].to_numpy(), minlength=len(raw)))
            out += [packed[a:b] for a, b in zip([0, *till.tolist()], till.tolist(), strict=False)]
        return out

    def decode(self, sequences: list[bytes]) -> list[bytes]:
        """The bytes of each sequence of ids, given as ``encode`` gives them.

        Sequences are cut before tokens that begin a word; equal runs are decoded once.
        """
        if len(self._runs) > self._most:
            self._runs.clear()
        runs = []
        for packed in sequences:
            cuts = np.flatnonzero(self._starts[np.frombuffer(packed, "<i4")])
            cuts = (4 * cuts[cuts > 0]).tolist()
            runs.append([packed[a:b] for a, b in zip([0, *cuts], [*cuts, len(packed)], strict=True)])
        new = list(set().union(*runs).difference(self._runs))
        self._runs.update(zip(new, self.decode_runs(new), strict=True))
        return [b"".join(map(self._runs.__getitem__, of_text)) for of_text in runs]

    def decode_runs(self, runs: list[bytes]) -> list[bytes]:
        """The bytes of each run of ids, all runs in one query."""
        found = [b""] * len(runs)
        if any(runs):
            ids = pa.ListArray.from_arrays(np.cumsum([0, *map(len, runs)], dtype=np.int32) // 4, np.frombuffer(b"".join(runs), "<i4"))
            self._db.register("given", pa.table({"run": np.arange(len(runs), dtype=np.int32), "ids": ids}))
            decoded = self._db.sql(_DECODE).to_arrow_table()
            for run, value in zip(decoded["run"].to_pylist(), decoded["bytes"].to_pylist(), strict=True):
                found[run] = value
        return found

    def round_trip(self, texts: list[str]) -> tuple[list[bytes], list[str], list[bytes]]:
        """The ids of each text, packed and as decimals behind a blank each, and the bytes that these ids decode to.

        What the texts' parts give is put together, each distinct part encoded, and its ids decoded, once.
        """
        found = self._trips(texts)
        return tuple([empty.join([p[i] for p in of_text]) for of_text in found] for i, empty in enumerate((b"", "", b"")))

    def _trip_parts(self, parts: list[str]) -> list[tuple[bytes, str, bytes]]:
        coded = self.encode_parts(parts)
        spelled = ["".join([self._decimal[i] for i in ids]) for ids in (np.frombuffer(c, "<i4").tolist() for c in coded)]
        return list(zip(coded, spelled, self.decode_runs(coded), strict=True))


def codec(path: str = RANKS) -> Codec:
    """This worker's codec of the vocabulary at *path*; it outlives a task."""
    held = worker_state()
    if ("bpe", path) not in held:
        held["bpe", path] = Codec(path)
    return held["bpe", path]


def _batches(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        texts = batch.column(text).to_pylist()
        texts = [t or "" for t in texts]
        for part in slices([len(t) for t in texts], SLICE):
            yield batch.slice(part.start, part.stop - part.start), texts[part]


def encode(docs: DataFrame, text: str = "text", into: str = "ids", ranks: str = RANKS) -> DataFrame:
    """*docs* with the token ids of *text* as an array of integers in *into*.

    NULL and empty texts give no ids.  Other columns pass through unread; a column
    named as *into* is replaced.  Repeated rows stay.  *ranks* is the vocabulary's
    path, the same on every executor.
    """
    rows = docs.drop(into)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks)
        for batch, texts in _batches(batches, text):
            packed = own.encode(texts)
            offsets = np.cumsum([0, *map(len, packed)], dtype=np.int64) // 4
            ids = pa.ListArray.from_arrays(offsets.astype(np.int32), np.frombuffer(b"".join(packed), "<i4"))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, into])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(into, T.ArrayType(T.IntegerType(), False))]))


def decode(rows: DataFrame, ids: str = "ids", into: str = "decoded", ranks: str = RANKS) -> DataFrame:
    """*rows* with the bytes of the token *ids* in *into*; NULL ids give NULL."""
    rows = rows.drop(into) if into != ids else rows

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks)
        for batch in batches:
            column = batch.column(ids)
            packed = [None if v is None else np.array(v, "<i4").tobytes() for v in column.to_pylist()]
            found = iter(own.decode([p for p in packed if p is not None]))
            decoded = pa.array([None if p is None else next(found) for p in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], names=[*batch.schema.names, into])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(into, T.BinaryType())]))


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """Per document, the count and SHA-256 of its ids, and the SHA-256 of what they decode to.

    Encoding, decoding and hashing share one pass, so that ids and bytes stay in the task.
    """
    kept = docs.select(key, text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks)
        for batch, texts in _batches(batches, text):
            packed, spelled, decoded = own.round_trip(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key),
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(s[1:].encode()).hexdigest() for s in spelled]),
                    pa.array([hashlib.sha256(b).hexdigest() for b in decoded]),
                ],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    fields = [kept.schema[key], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return kept.mapInArrow(run, T.StructType(fields))
