"""Texts cut where no token crosses, so that each distinct word is encoded once."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex

#: A comma or full stop after a sign that one token may hold both; the first for ASCII texts.  What is rare is looked for first.
_SIGNS = re.compile(r"[,.](?<=[\0-\x08\x0e-\x1f!-/:-@\[-`{-\x7f].)"), re.compile(r"[,.](?<=[^\w\s].|[_\x1c-\x1f].)")
#: The same where texts are normalised first, which may end a letter with a mark: only Latin letters are sure.
_LATIN_SIGNS = re.compile(r"[,.](?<=[^0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f\s].|[\x1c-\x1f].)")
#: Marks of a part that stands before a comma or full stop, and of one without a blank before it.
_STOP, _BARE = "\0", "\1"


class Parts:
    """Token ids of texts from those of their parts, each distinct part encoded once.

    No token of a byte-level vocabulary has white space behind other characters, or
    a comma or full stop behind a letter or number, so a text may be cut before
    these; *pattern*'s matches are the parts where white space or signs meet.  A
    vocabulary without *pattern* drops white space and lowers letters: every blank
    ends a token, and ASCII capitals are lowered before parts are looked up.

    *encode* gives the ids of parts as bytes.  Parts are remembered; when there are
    more than half of *most*, those not met since the last such time are forgotten.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], pattern, most: int):
        self._encode, self._pattern, self._most = encode, pattern, most
        self._known: dict[str, bytes | None] = {}
        self._before: dict[str, bytes | None] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        return list(map(b"".join, self.of_texts(texts)))

    def of_texts(self, texts: list[str]) -> list[list]:
        """What *encode* gives for each part, for all parts of each text in order."""
        if len(self._known) > self._most // 2:
            self._before, self._known = self._known, {}
        keys = [self._cut(t) for t in texts]
        self._learn(keys)
        find = self._known.__getitem__
        out = [list(map(find, of_text)) for of_text in keys]
        again = [i for i, found in enumerate(out) if None in found]  # a part that no cut may end
        exact = [self._matches(texts[i]) for i in again]
        self._learn(exact)
        for i, of_text in zip(again, exact, strict=True):
            out[i] = list(map(find, of_text))
        return out

    def _cut(self, text: str) -> list[str]:
        if self._pattern is None and text.isascii():
            text = text.lower()
        signs = _SIGNS[0] if text.isascii() else _LATIN_SIGNS if self._pattern is None else _SIGNS[1]
        if signs.search(text) or _STOP in text or _BARE in text:
            return self._matches(text)
        if self._pattern is None:
            return text.replace("\n", " ").replace(",", " ,").replace(".", " .").split(" ")
        keys = text.replace("\n", " \n").replace(",", " \0,").replace(".", " \0.").split(" ")
        if keys[0]:
            keys[0] = _BARE + keys[0]
        else:
            del keys[0]
        return keys

    def _matches(self, text: str) -> list[str]:
        if self._pattern is None:
            return text.replace("\n", " ").split(" ")
        return [_BARE + m for m in self._pattern.findall(text)]

    def _learn(self, keys: list[list[str]]) -> None:
        new = set().union(*keys).difference(self._known)
        again = self._before.keys() & new
        self._known.update((k, self._before[k]) for k in again)
        new = list(new - again)
        if self._pattern is None:
            self._known.update(zip(new, self._encode(new), strict=True))
            return
        parts = [k[1:] if k[:1] in (_STOP, _BARE) else k if k[:1] == "\n" else " " + k for k in new]
        self._known.update(zip(new, self._encode(parts), strict=True))
        self._known.update(dict.fromkeys([k for k in new if not k or k[-1].isspace() and k[0] != _BARE]))


def whole_spaces(pattern: str):
    """*pattern* compiled, with white space as vocabularies' own libraries take it."""
    return regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def slices(sizes: list[int], most: int) -> Iterator[slice]:
    """Runs of rows of at most *most* bytes together, or of one row."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def worker_state() -> dict:
    """What lives as long as this Python worker: functions sent by value have new globals in each task."""
    return sys.modules.setdefault("gleanery_worker_state", types.ModuleType("gleanery_worker_state")).__dict__


def forget() -> None:
    """Drops the vocabularies and caches that other operators left in this worker, for a stage that needs none of them.

    What batches of earlier tasks left behind goes back to the system.
    """
    held = worker_state()
    for name in [n for n in held if isinstance(n, tuple)]:
        del held[name]
    give_back()


def give_back() -> None:
    """Memory that Arrow and the C library hold without need goes back to the system; Python's own does by itself."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()  # trims the C library's heap


def tidied(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """*run* that gives back what its task needed, as a worker outlives its task and may wait beside others."""

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole
