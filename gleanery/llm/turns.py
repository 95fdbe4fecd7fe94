"""Conversation structure repair: the cheapest edits that give every conversation alternating turns.

A conversation's turns, in order, are aligned with each feasible length of the grammar
``(s?(ua)+)?`` of role initials by a Wagner-Fischer table: a turn is kept (0), given another
role (2) or deleted (3), an empty turn is inserted (2), and a truncated turn that stays
costs 1.  Blank and repeated turns must go.  The targets of all lengths end alike, so one table
of suffix costs serves them all: a cell is the cost of making turns i.. into the last r letters.
Costs that no alignment escapes (turns that must go, truncated ones) are taken out first;
what is left of the incumbent cost bounds the table to an Ukkonen band, as every letter
off the diagonal costs at least 2.  The incumbent comes from a greedy repair and then from narrow
bands.  Alignments of all lengths that reach the least cost are traced back side by side,
letter by letter, and the audit that is least in ASCII stays.

Two passes: a narrow one (initials, faults, a digest per turn) finds the audits, and one that
streams the texts, behind their conversation's audit, applies them.  A task holds 16 bytes and an
audit letter per turn of one conversation, and of its table, where that is large, only every
so many rows; texts are never gathered.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.sources.scratch import written

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
SPACE = " \t\n\x0b\x0c\r"
_FAR = 1 << 29
#: Cells of a table that are held at once; a larger one is kept in part and worked out again while tracing.
CELLS = 4_000_000

_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class Table:
    """Suffix costs above the unavoidable ones, in a band of *reach* letters to either side.

    *letters* are role initials, *faults* one code per turn.  Row i at column r - (turns from i on
    that may stay) + reach holds the cost of making turns i.. into the last r letters of
    ``...uaua``; ``waiting`` holds the same where the one ``s`` before them is still to come.
    """

    def __init__(self, letters: str, faults: bytes, reach: int):
        self.letters, self.faults, self.reach, self.n = letters, faults, reach, len(letters)
        self.must = [f in (BLANK, DUPLICATE) for f in faults]
        self.stay = [0] * (self.n + 1)
        for i in range(self.n - 1, -1, -1):
            self.stay[i] = self.stay[i + 1] + (not self.must[i])
        self._at = np.arange(2 * reach + 1, dtype=np.int32)
        self._block = self.n + 1 if (self.n + 1) * len(self._at) <= CELLS else max(1, math.isqrt(self.n))
        last = 2 * (self._at - reach)
        rows = [(np.where(last < 0, _FAR, last).astype(np.int32), np.full(len(self._at), _FAR, np.int32))]
        self._marks = {self.n: rows[0]}
        self._held: dict[int, tuple[np.ndarray, np.ndarray]] = {self.n: rows[0]}
        row = rows[0]
        for i in range(self.n - 1, -1, -1):
            row = self._above(i, row)
            if i % self._block == 0:
                self._marks[i] = row
            if self._block > self.n:
                self._held[i] = row

    def drop(self, i: int) -> int:
        """Cost of deleting turn i above what it costs at least."""
        return 0 if self.must[i] else 3 - (self.faults[i] == TRUNCATED)

    def _above(self, i: int, below: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        done, waiting = below
        left = self._at - self.reach + self.stay[i]
        if self.must[i]:
            row, wait = done.copy(), waiting.copy()
        else:
            row, wait = np.full_like(done, _FAR), np.full_like(done, _FAR)
            row[:-1] = done[1:] + self.drop(i)
            wait[:-1] = waiting[1:] + self.drop(i)
            letter = self.letters[i]
            if letter == "s":
                np.minimum(wait[:-1], done[1:], out=wait[:-1])
            here = done + (2 if letter not in ("u", "a") else np.where((left % 2 == 0) == (letter == "u"), 0, 2).astype(np.int32))
            np.minimum(row, np.where(left >= 1, here, _FAR), out=row)
        row[left < 0] = _FAR
        wait[left < 0] = _FAR
        row = np.minimum.accumulate(row - 2 * self._at) + 2 * self._at  # insertions
        row[left < 0] = _FAR
        return np.minimum(row, _FAR), np.minimum(wait, _FAR)

    def _rows(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self._held:
            low = i - i % self._block
            high = min(self.n, low + self._block)
            self._held = {high: self._marks[high]}
            if high < self.n:
                self._held[high + 1] = self._above_next(high)
            for j in range(high - 1, low - 1, -1):
                self._held[j] = self._above(j, self._held[j + 1])
        return self._held[i]

    def _above_next(self, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Row high + 1, of the block after: worked out from that block's own mark."""
        top = min(self.n, high + self._block)
        row = self._marks[top]
        for j in range(top - 1, high, -1):
            row = self._above(j, row)
        return row

    def cost(self, i: int, r: int, waiting: bool = False) -> int:
        at = r - self.stay[i] + self.reach
        return int(self._rows(i)[waiting][at]) if 0 <= at < len(self._at) else _FAR

    def ends(self) -> list[tuple[bool, int, int]]:
        """Every feasible length within the band: whether ``s`` leads, letters after it, cost."""
        first = self.stay[0] - self.reach
        found = []
        for r in range(max(0, first + first % 2), self.stay[0] + self.reach + 1, 2):
            found.append((False, r, self.cost(0, r)))
            if r >= 2:
                found.append((True, r, self.cost(0, r, True)))
        return found

    def audit(self, least: int) -> str:
        """The least audit among the alignments of all lengths that cost *least*."""
        states = {(w, r) for w, r, c in self.ends() if c == least}
        out, i = [], 0
        while not (i == self.n and (False, 0) in states):
            moves: dict[str, set[tuple[bool, int]]] = {"D": set(), "I": set(), "K": set(), "R": set()}
            for wait, r in states:
                now = self.cost(i, r, wait)
                if not wait and r and now == 2 + self.cost(i, r - 1):
                    moves["I"].add((False, r - 1))
                if i == self.n:
                    continue
                if now == self.drop(i) + self.cost(i + 1, r, wait):
                    moves["D"].add((wait, r))
                if self.must[i]:
                    continue
                letter = self.letters[i]
                if wait:
                    if letter == "s" and now == self.cost(i + 1, r):
                        moves["K"].add((False, r))
                elif r:
                    fits = letter == ("u" if r % 2 == 0 else "a")
                    if now == self.cost(i + 1, r - 1) + (0 if fits else 2):
                        moves["K" if fits else "R"].add((False, r - 1))
            edit = next(e for e in "DIKR" if moves[e])
            states = moves[edit]
            out.append(edit)
            i += edit != "I"
        return "".join(out)


def _greedy(letters: str, faults: bytes) -> int:
    """What a repair from left to right costs above the unavoidable: an upper bound."""
    total, made = 0, 0
    for letter, fault in zip(letters, faults, strict=True):
        if fault in (BLANK, DUPLICATE):
            continue
        want = "ua"[made % 2]
        if letter == want or letter not in ("u", "a"):
            total += 0 if letter == want else 2
            made += 1
        else:  # the one that is missing is put before it
            total += 2
            made += 2
    return total + 2 * (made % 2)


def align(letters: str, faults: bytes) -> tuple[int, str]:
    """Least cost and audit of turns with these role initials and faults; no turns cost nothing."""
    sure = sum(3 if f in (BLANK, DUPLICATE) else f == TRUNCATED for f in faults)
    incumbent, guess = _greedy(letters, faults), 4
    while True:
        bound = min(guess, incumbent)
        table = Table(letters, faults, bound // 2 + 1)
        incumbent = min(incumbent, *(c for _, _, c in table.ends()))
        if incumbent <= bound:  # nothing outside the band costs as little
            return sure + incumbent, table.audit(incumbent)
        guess *= 4


def _narrow(turns: DataFrame) -> DataFrame:
    """What the alignment needs of each turn, with the sort keys."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    bare = F.rtrim("text", F.lit(SPACE))
    fault = F.when(bare == "", BLANK).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    return rows.select("conv_id", "turn", "role", "text", fault.cast("int").alias("fault"), digest.alias("digest"))


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[object, bool, pa.RecordBatch]]:
    """Slices of sorted *batches* within one value of *key*: the value, whether it is new, the rows."""
    last, begun = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_pylist()
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield keys[a], not begun or keys[a] != last, batch.slice(a, b - a)
            last, begun = keys[a], True


class _Seen:
    """The report of one conversation, turn by turn."""

    def __init__(self, key):
        self.key, self.letters, self.faults, self.digests = key, [], bytearray(), set()
        self.n_turns, self.first, self.last, self.illegal = 0, None, None, 0

    def add(self, rows: pa.RecordBatch) -> None:
        for turn, role, fault, digest in zip(*(rows.column(c).to_pylist() for c in ("turn", "role", "fault", "digest")), strict=True):
            if turn is not None:
                self.first = turn if self.first is None else self.first
                self.n_turns += turn != self.last
                self.last = turn
            letter = role[:1] or " "
            if self.letters and self.letters[-1] + letter not in ("su", "ua", "au"):
                self.illegal += 1
            self.letters.append(letter)
            self.faults.append(fault if fault == BLANK else DUPLICATE if digest in self.digests else fault)
            self.digests.add(digest)

    def row(self) -> tuple:
        cost, audit = align("".join(self.letters), bytes(self.faults))
        gaps = 0 if self.last is None else self.last - self.first + 1 - self.n_turns
        return (self.key, gaps, *(self.faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)), self.illegal, cost, audit)


def audits(turns: DataFrame) -> DataFrame:
    """One row per conversation of *turns* (conv_id, turn, role, text): faults, cost of the repair and its edits.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.  Turns count in the order of
    turn, NULL first, then role and content; a NULL role or text is one space, an empty role
    fits no letter, and a NULL conv_id is one conversation.  Other columns are not read.
    An empty table gives no rows.
    """
    rows = _narrow(turns).select("conv_id", "turn", F.substring("role", 1, 1).alias("role"), "fault", "digest", F.col("role").alias("whole"))
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("whole"), F.col("digest")]
    rows = rows.repartition("conv_id").sortWithinPartitions(*keys).drop("whole")
    schema = T.StructType([rows.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in _COUNTS), T.StructField("audit", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, seen, out = None, None, []
        for key, new, part in runs(batches, "conv_id"):
            arrow = arrow or pa.schema([part.schema.field("conv_id"), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string())])
            if new:
                if seen is not None:
                    out.append(seen.row())
                seen = _Seen(key)
            seen.add(part)
            if len(out) >= 1024:
                yield _batch(out, arrow)
                out = []
        if seen is not None:
            yield _batch([*out, seen.row()], arrow)

    return rows.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class _Edits:
    """A conversation's audit, applied while its turns go by."""

    def __init__(self, audit: str):
        self._audit, self._at, self.place = audit, 0, 0
        length = len(audit) - audit.count("D")
        self._lead, self._left = length % 2 == 1, length - length % 2

    def _make(self) -> str:
        self.place += 1
        self._left -= 1
        return "assistant" if self._left % 2 == 0 else "user"

    def inserted(self) -> Iterator[tuple[int, str, str, str]]:
        while self._audit[self._at : self._at + 1] == "I":
            self._at += 1
            role = self._make()
            yield self.place, "I", role, ""

    def turn(self, role: str, text: str) -> Iterator[tuple[int, str, str, str]]:
        yield from self.inserted()
        edit = self._audit[self._at]
        self._at += 1
        if edit == "D":
            return
        if edit == "K" and self._lead:
            self._lead = False
            self.place += 1
        else:
            made = self._make()
            role = made if edit == "R" else role
        yield self.place, edit, role, text


def apply(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired turns of *turns*, given their stored ``audits``: conv_id, place from 1, edit, role, text.

    Rows of one conversation follow each other within a partition, in order.
    """
    texts = _narrow(turns).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text")
    heads = found.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"),
    )
    order = _order()
    rows = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions(order[0], "kind", *order[1:]).drop("digest", "turn")
    schema = T.StructType([texts.schema["conv_id"], T.StructField("place", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("edit", "role", "text"))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, edits, last, out = None, None, None, []
        for key, new, part in runs(batches, "conv_id"):
            arrow = arrow or pa.schema([part.schema.field("conv_id"), ("place", pa.int64()), *((c, pa.string()) for c in ("edit", "role", "text"))])
            if new and edits is not None:
                out += [(last, *row) for row in edits.inserted()]
            last = key
            for kind, role, text in zip(*(part.column(c).to_pylist() for c in ("kind", "role", "text")), strict=True):
                if kind == 0:
                    edits = _Edits(text)
                else:
                    out += [(key, *row) for row in edits.turn(role, text)]
            if len(out) >= 1024:
                yield _batch(out, arrow)
                out = []
        if edits is not None:
            out += [(last, *row) for row in edits.inserted()]
        if out:
            yield _batch(out, arrow)

    return rows.mapInArrow(run, schema)


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored ``audits`` of *turns* and the repaired turns."""
    found = written(audits(turns), "audits", compact=True)
    return found, apply(turns, found)


def digests(repaired: DataFrame) -> DataFrame:
    """Per conversation of ``apply``'s rows: ``repaired_sha256`` over ``role:text``, joined by newlines, in one pass over its rows."""
    schema = T.StructType([repaired.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, key, digest, out = None, None, None, []
        for value, new, part in runs(batches, "conv_id"):
            arrow = arrow or pa.schema([part.schema.field("conv_id"), ("repaired_sha256", pa.string())])
            lines = "\n".join(f"{r}:{t}" for r, t in zip(part.column("role").to_pylist(), part.column("text").to_pylist(), strict=True))
            if new:
                if digest is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = value, hashlib.sha256(lines.encode())
            else:
                digest.update(b"\n" + lines.encode())
            if len(out) >= 1024:
                yield _batch(out, arrow)
                out = []
        if digest is not None:
            yield _batch([*out, (key, digest.hexdigest())], arrow)

    return repaired.mapInArrow(run, schema)
