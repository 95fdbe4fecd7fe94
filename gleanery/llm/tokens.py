"""Token ids by the tokenizers library, each distinct part of the texts encoded once per worker."""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa

from gleanery.llm.words import Parts, slices, whole_spaces, worker_state

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: Entries after which a worker's cache is emptied; parts given to the library at
#: once; characters of text taken at once.
CACHED, AT_ONCE, SLICE = 400_000, 50_000, 1_000_000

#: A word of Latin letters: normalising only lowers it, letter by letter, and it is not split before its merges; words given to the library as one text.
_PLAIN, TOGETHER = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+"), 64
#: Latin letters, ASCII digits and signs behind one blank or line feed, and how tokens of a byte-level vocabulary begin with these.
_SPACED, _BLANKS = re.compile("[ \n][!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+"), ("\u0120", "\u010a")

#: Pattern of a byte-level vocabulary, None for one that drops white space.
PATTERNS = {os.path.basename(BYTE_BPE): whole_spaces(public_tokenizers.PATTERN), os.path.basename(WORD_BPE): None}


class Encoder:
    """A worker's tokenizer; ids come as little-endian unsigned 32-bit integers.

    Special tokens written out in a text are found as the library finds them: such a text is encoded whole.
    """

    def __init__(self, path: str, pattern, cached: int = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content.lower() for t in self._tokenizer.get_added_tokens_decoder().values()]
        self.size = self._tokenizer.get_vocab_size()
        self._ends = None
        if suffix := getattr(self._tokenizer.model, "end_of_word_suffix", None):  # each word's last token tells that it is the last
            vocabulary = self._tokenizer.get_vocab()
            self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self._ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
            self._plain = Tokenizer(self._tokenizer.model)
            self._plain.normalizer = normalizers.Lowercase()
            self._plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        else:  # white space begins a token, and no match of the pattern goes on from other characters to white space
            self._starts = np.zeros(max(self._tokenizer.get_vocab().values()) + 1, bool)
            self._starts[[i for token, i in self._tokenizer.get_vocab().items() if token.startswith(_BLANKS)]] = True
        self._by_parts = Parts(self.encode_spaced if self._ends is None else self.encode_words, pattern, cached).encode

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = {i for i, t in enumerate(texts) if any(s in t or s in t.lower() for s in self._special)} if self._special else ()
        if not whole:
            return self._by_parts(texts)
        out = self._by_parts(["" if i in whole else t for i, t in enumerate(texts)])
        for i in whole:
            out[i] = self.encode_parts([texts[i]])[0]
        return out

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        out = []
        for start in range(0, len(parts), AT_ONCE):
            ids = [e.ids for e in self._tokenizer.encode_batch_fast(parts[start : start + AT_ONCE], add_special_tokens=False)]
            packed = np.fromiter(itertools.chain.from_iterable(ids), "<u4").tobytes()
            ends = [4 * n for n in itertools.accumulate(map(len, ids))]
            out += [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return out

    def encode_words(self, parts: list[str]) -> list[bytes]:
        """As ``encode_parts``; plain words are given together, and their ids cut behind the tokens that end words."""
        plain = [p for p in parts if _PLAIN.fullmatch(p)]
        found = {}
        for start in range(0, len(plain), AT_ONCE):
            words = plain[start : start + AT_ONCE]
            texts = [" ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
            coded = self._plain.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.fromiter(itertools.chain.from_iterable(e.ids for e in coded), "<u4")
            packed, ends = ids.tobytes(), (4 * (np.flatnonzero(self._ends[ids]) + 1)).tolist()
            found.update(zip(words, (packed[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))
        other = [p for p in parts if p not in found]
        found.update(zip(other, self.encode_parts(other), strict=True))
        return [found[p] for p in parts]

    def encode_spaced(self, parts: list[str]) -> list[bytes]:
        """As ``encode_parts``, for a byte-level vocabulary; parts with white space only at their beginning are given together, and their ids cut before the tokens that begin with it."""
        is_spaced = list(map(_SPACED.fullmatch, parts))
        other = iter(self.encode_parts([p for p, spaced in zip(parts, is_spaced, strict=True) if not spaced]))
        spaced, out = list(itertools.compress(parts, is_spaced)), []
        for start in range(0, len(spaced), AT_ONCE):
            words = spaced[start : start + AT_ONCE]
            texts = ["".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
            coded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.fromiter(itertools.chain.from_iterable(e.ids for e in coded), "<u4")
            packed, cuts = ids.tobytes(), [*(4 * np.flatnonzero(self._starts[ids])).tolist(), 4 * len(ids)]
            out += [packed[a:b] for (a, b), _ in zip(itertools.pairwise(cuts), words, strict=True)]
        if len(out) == len(parts):
            return out
        found = iter(out)
        return [next(found if spaced else other) for spaced in is_spaced]


def encoder(path: str) -> Encoder:
    """This worker's encoder of the vocabulary at *path*, whose file name tells how texts may be cut."""
    held = worker_state()
    if ("tokenizer", path) not in held:
        held["tokenizer", path] = Encoder(path, PATTERNS[os.path.basename(path)])
    return held["tokenizer", path]


def encoded(batches: Iterable[pa.RecordBatch], text: str, path: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of *batches* with the ids of each row's text; NULL counts as empty."""
    own = encoder(path)
    for batch in batches:
        texts = [t or "" for t in batch.column(text).to_pylist()]
        for part in slices([len(t) for t in texts], SLICE):
            yield batch.slice(part.start, part.stop - part.start), own.encode(texts[part])
