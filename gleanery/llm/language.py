"""Language of texts: scripts narrow the candidates, Viterbi labels spans of words.

A word (a run of letters of one script) is scored under each language by the
logarithms of its letter 1- to 3-grams' shares, word ends included.  Only languages
that use the word's script (a share of their letters in it) are candidates.  Over the
words of a text, the sequence of languages with the best sum of scores is found, where
each change of language costs a penalty; that labels spans of mixed text.  The text's
language is the one whose spans hold most letters, its score their share of all letters.

Counts cover all training texts.  N-grams are hashed to a fixed number of buckets,
so the model has at most that many numbers per language, whatever the corpus.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm.words import forget, slices, tidied
from gleanery.sources.scratch import written

BUCKETS, PENALTY, SCRIPT_SHARE = 1 << 15, 6.0, 1e-3
#: Letters of a word that are scored by n-grams at a time, words remembered by a task,
#: characters of text taken at once, and cells of a Viterbi block.
CACHED, SLICE, BLOCK = 200_000, 1_000_000, 2_000_000
UNKNOWN = "und"
#: Standard deviations by which a text may fit its language worse than the taught texts of it do on average.
SPREAD = 24.0

#: First code points of script ranges, and their scripts; other letters are "other".
SCRIPTS = (
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x08A0, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"),
    (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1C80, "cyrillic"), (0x1C90, "georgian"), (0x1CC0, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"), (0x2E00, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"), (0x3200, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "armenian"), (0xFB1D, "hebrew"),
    (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "other"), (0xFF21, "latin"), (0xFF66, "kana"),
    (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"),
)
NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([s for s, _ in SCRIPTS], np.uint32)
_SCRIPT_OF = np.array([NAMES.index("other"), *(NAMES.index(n) for _, n in SCRIPTS)], np.int8)
_LETTERS = regex.compile(r"[\p{L}\p{M}]*\p{L}[\p{L}\p{M}]*")


def scripts(points: np.ndarray) -> np.ndarray:
    """The script number of each code point."""
    return _SCRIPT_OF[np.searchsorted(_STARTS, points, "right")]


def words_of(token: str) -> list[str]:
    """The lower-case words of *token*: runs of letters, cut where the script changes."""
    bare = token.lower().strip(string.punctuation)
    if bare.isalpha() and max(bare) < "\u0250":  # most: one word of Latin letters
        return [bare]
    out = []
    for run in _LETTERS.findall(token.lower()):
        points = np.frombuffer(run.encode("utf-32-le"), "<u4")
        kind = scripts(points)
        cuts = [0, *(np.flatnonzero(np.diff(kind)) + 1).tolist(), len(run)] if (kind != kind[0]).any() else [0, len(run)]
        out += [run[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    return out


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The word number and bucket of every 1- to 3-gram of *words*, each word between two ends."""
    text = np.frombuffer(" ".join(["", *words, ""]).encode("utf-32-le"), "<u4").astype(np.uint64)
    space = text == 32
    word = np.cumsum(space) - 1
    found_word, found_bucket = [], []
    for n in (1, 2, 3):
        code = np.zeros(len(text) - n + 1, np.uint64)
        for i in range(n):
            code = (code * np.uint64(0x9E3779B97F4A7C15) + text[i : len(text) - n + 1 + i] + np.uint64(n)) ^ (code >> np.uint64(29))
        code ^= code >> np.uint64(32)
        # Inside one word, ends included: only a first or last place may be an end.
        inside = np.ones(len(code), bool)
        for i in range(n):
            at_end = space[i : len(text) - n + 1 + i]
            inside &= ~at_end if (0 < i < n - 1 or n == 1) else True
        if n == 2:
            inside &= ~(space[:-1] & space[1:])
        owner = word[: len(code)]
        found_word.append(owner[inside])
        found_bucket.append((code[inside] % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(found_word), np.concatenate(found_bucket)


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> "Model":
    """A model of the languages of *docs*; rows without text or language teach nothing.

    Tasks count words, then n-grams and scripts of distinct words; what is shuffled
    and collected is at most one number per language and bucket or script.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).dropna()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def settle() -> None:
            for language, counted in words.items():
                parts = [(w, n) for token, n in counted.items() for w in words_of(token)]
                if not parts:
                    continue
                times = np.array([n for _, n in parts], np.int64)
                into = totals.setdefault(language, np.zeros(BUCKETS + len(NAMES), np.int64))
                owner, bucket = ngrams([w for w, _ in parts])
                into += np.bincount(bucket, times[owner], len(into)).astype(np.int64)
                letters = np.array([len(w) for w, _ in parts]) * times
                kind = scripts(np.array([ord(w[0]) for w, _ in parts], np.uint32))
                into += np.bincount(kind.astype(np.int64) + BUCKETS, letters, len(into)).astype(np.int64)
            words.clear()

        for batch in batches:
            for t, language in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words.setdefault(language, Counter()).update(t.split())
            if sum(map(len, words.values())) > CACHED:
                settle()
        settle()
        for language, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([language] * len(at), pa.string()), "k": at.astype(np.int32), "n": counts[at]})

    sums = rows.mapInArrow(tidied(run), "lang string, k int, n bigint").groupBy("lang", "k").agg(F.sum("n").alias("n"))
    table = sums.toArrow()
    languages = sorted(set(table["lang"].to_pylist()))
    counts = np.zeros((len(languages), BUCKETS + len(NAMES)))
    number = {x: i for i, x in enumerate(languages)}
    counts[[number[x] for x in table["lang"].to_pylist()], table["k"].to_numpy()] = table["n"].to_numpy()
    return Model(languages, counts)


class Model:
    """Scores of n-grams, and which languages use which scripts."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        grams, letters = counts[:, :BUCKETS], counts[:, BUCKETS:]
        self.languages = languages
        self.scores = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)).T.astype(np.float32)
        share = letters / np.maximum(letters.sum(axis=1, keepdims=True), 1)
        self.uses = (share >= SCRIPT_SHARE).T
        self.uses[~self.uses.any(axis=1)] = True  # a script that no language uses tells nothing

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Score of each word under each language, minus infinity outside its candidates."""
        owner, bucket = ngrams(words)
        out = np.stack([np.bincount(owner, self.scores[bucket, i], len(words)) for i in range(len(self.languages))], axis=1)
        kind = scripts(np.array([ord(w[0]) for w in words], np.uint32))
        return np.where(self.uses[kind], out, -np.inf).astype(np.float32)


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """The language of each word; *scores* holds the words of several texts in a row, *counts* the words of each.

    Texts are stepped through side by side.
    """
    starts = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    starts, counts = starts[order], counts[order]
    languages = scores.shape[1]
    longest = int(counts[0])
    live = np.searchsorted(-counts, -np.arange(longest), "left")  # texts longer than t
    best = scores[starts[: live[0]]].astype(np.float64)
    back = [None]
    for t in range(1, longest):
        now = best[: live[t]]
        top = now.argmax(axis=1)
        switched = now[np.arange(len(now)), top] - penalty
        stay = now >= switched[:, None]
        back.append(np.where(stay, np.arange(languages), top[:, None]).astype(np.int16))
        best[: live[t]] = np.maximum(now, switched[:, None]) + scores[starts[: live[t]] + t]
    out = np.empty(len(scores), np.int16)
    state = np.empty(len(counts), np.int64)
    for t in reversed(range(longest)):
        ended = live[t + 1] if t + 1 < longest else 0
        state[ended : live[t]] = best[ended : live[t]].argmax(axis=1)
        out[starts[: live[t]] + t] = state[: live[t]]
        if t:
            state[: live[t]] = back[t][np.arange(live[t]), state[: live[t]]]
    return out


def _blocks(counts: np.ndarray) -> Iterator[np.ndarray]:
    """Texts with words, in blocks of bounded size of texts of like length."""
    order = np.argsort(counts, kind="stable")
    order = order[counts[order] > 0]
    yield from (order[s] for s in slices(counts[order].tolist(), BLOCK))


def label(docs: DataFrame, model: Model, text: str = "text", penalty: float = PENALTY, spans: bool = False, fit: bool = False) -> DataFrame:
    """*docs* with lang_pred and score, and with *spans* the labelled spans of words.

    With *fit* also the mean score of the text's n-grams, each under its word's language.
    ``und``, 0 and no fit if the text is NULL, empty or has no letter, or if nothing was
    learnt.  Equal shares go to the language first in order.  Columns named as a
    result are replaced; repeated rows stay.
    """
    rows = docs.drop("lang_pred", "score", *(["spans"] if spans else []), *(["fit"] if fit else []))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    if fit:
        fields.append(T.StructField("fit", T.DoubleType()))
    if spans:
        fields.append(T.StructField("spans", T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("n_words", T.LongType())]))))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        own = sent.value
        known: dict[str, bytes] = {}  # token to its words' numbers
        number: dict[str, int] = {}
        scores, letters = np.empty((0, len(own.languages)), np.float32), np.empty(0, np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            for part in slices([len(t) for t in texts], SLICE):
                tokens = [t.split() for t in texts[part]]
                if len(number) > CACHED or len(known) > CACHED:
                    known, number, scores, letters = {}, {}, scores[:0], letters[:0]
                new = list(set().union(*tokens).difference(known))
                found = [words_of(t) for t in new]
                fresh = list({w for ws in found for w in ws}.difference(number))
                if fresh and own.languages:
                    number.update(zip(fresh, range(len(number), len(number) + len(fresh)), strict=True))
                    scores = np.concatenate([scores, own.word_scores(fresh)])
                    letters = np.append(letters, [len(w) for w in fresh])
                elif fresh:
                    found = [[] for _ in new]
                known.update((t, b"".join([number[w].to_bytes(4, "little") for w in ws])) for t, ws in zip(new, found, strict=True))
                packed = [b"".join(map(known.__getitem__, ts)) for ts in tokens]
                kept = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([*kept.columns, *_labelled(packed, scores, letters, own.languages, penalty, spans, fit)], names=[*batch.schema.names, *(f.name for f in fields)])

    return rows.mapInArrow(tidied(run), T.StructType([*rows.schema.fields, *fields]))


def _labelled(packed: list[bytes], scores: np.ndarray, letters: np.ndarray, languages: list[str], penalty: float, spans: bool, fit: bool) -> list[pa.Array]:
    counts = np.array([len(p) // 4 for p in packed], np.int64)
    pred, share, fits = [UNKNOWN] * len(packed), np.zeros(len(packed)), np.full(len(packed), np.nan)
    labelled: list[list] = [[] for _ in packed]
    for block in _blocks(counts):
        word = np.frombuffer(b"".join([packed[i] for i in block]), "<i4")
        chosen = viterbi(scores[word], counts[block], penalty)
        text = np.repeat(np.arange(len(block)), counts[block])
        held = np.bincount(text * len(languages) + chosen, letters[word], len(block) * len(languages)).reshape(len(block), -1)
        first = held.argmax(axis=1)
        share[block] = held.max(axis=1) / held.sum(axis=1)
        total = np.bincount(text, scores[word, chosen], len(block))
        fits[block] = total / np.bincount(text, 3 * letters[word] + 1, len(block))  # n-grams of a word and its ends
        for i, k in zip(block.tolist(), first.tolist(), strict=True):
            pred[i] = languages[k]
        if spans:
            cuts = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(chosen, prepend=-1) != 0))
            for at, n in zip(cuts.tolist(), np.diff(np.append(cuts, len(text))).tolist(), strict=True):
                labelled[block[text[at]]].append({"lang": languages[chosen[at]], "n_words": n})
    out = [pa.array(pred, pa.string()), pa.array(share)]
    if fit:
        out.append(pa.array(fits, pa.float64(), from_pandas=True))
    if spans:
        out.append(pa.array(labelled, pa.list_(pa.struct([("lang", pa.string()), ("n_words", pa.int64())]))))
    return out


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is kept from training: CRC-32 of the key as text, mod 3, is 1; a NULL key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows of *docs* with held_out, lang_pred and score, by a model of the rows that aren't held out."""
    marked = docs.withColumn("held_out", held_out(key))
    model = train(marked.filter(~F.col("held_out")), text, lang)
    return label(marked, model, text)


def keep(docs: DataFrame, share: float, spread: float = SPREAD, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows of *docs* that are in a learnt language, with the columns of :func:`identify` and ``fit``.

    One language holds *share* of the letters, and the text fits its words' languages: its fit is at
    most *spread* standard deviations below the mean of that language's taught texts.  Mean and deviation are of
    all rows that teach and are found to be in their own language; a language whose own texts vary less than
    all do, as of a few, takes the deviation over all.  So text in a script or language that nobody taught goes, and
    so does gibberish.  A language without such rows has no bound.  NULL, empty and letterless texts go; repeated rows stay.
    """
    marked = docs.withColumn("held_out", held_out(key))
    model = train(marked.filter(~F.col("held_out")), text, lang)
    found = written(label(marked, model, text, fit=True), "languages")
    taught = found.filter(~F.col("held_out") & (F.col("lang_pred") == F.col(lang).cast("string")) & F.col("fit").isNotNull())
    # One row per language, of numbers only: far less than the model, which goes to all executors too.
    stats = taught.groupBy("lang_pred").agg(F.avg("fit").alias("mean"), F.var_pop("fit").alias("var"), F.count(F.lit(1)).alias("n")).collect()
    pooled = sum(r["var"] * r["n"] for r in stats) / max(sum(r["n"] for r in stats), 1)
    bounds = [(r["lang_pred"], r["mean"] - spread * max(r["var"], pooled) ** 0.5) for r in stats]
    table = found.sparkSession.createDataFrame(bounds, "_lang string, _least double")
    fits = F.col("_least").isNull() | (F.col("fit") >= F.col("_least"))
    joined = found.join(F.broadcast(table), F.col("lang_pred") == F.col("_lang"), "left")
    return joined.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= share) & fits).drop("_lang", "_least")
