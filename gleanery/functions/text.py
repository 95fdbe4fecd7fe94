"""Text normalisation as Spark column expressions.

All character classes are code point ranges; the same ranges build Java
regular expressions here and any other engine's pattern elsewhere.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

Ranges = tuple[tuple[int, int], ...]

# White space as understood by ``str.strip`` and ``\s`` on text.
WHITESPACE: Ranges = (
    (0x0009, 0x000D),
    (0x001C, 0x0020),
    (0x0085, 0x0085),
    (0x00A0, 0x00A0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
)

# Emoji, dingbats, flags, variation selectors, general punctuation.
EMOJI: Ranges = (
    (0x1F600, 0x1F64F),
    (0x1F300, 0x1F5FF),
    (0x1F680, 0x1F6FF),
    (0x1F1E0, 0x1F1FF),
    (0x1F900, 0x1F9FF),
    (0x1FA00, 0x1FA6F),
    (0x1FA70, 0x1FAFF),
    (0x2600, 0x26FF),
    (0x2700, 0x27BF),
    (0x1F004, 0x1F004),
    (0x1F0CF, 0x1F0CF),
    (0x1F170, 0x1F251),
    (0xFE00, 0xFE0F),
    (0x2000, 0x206F),
)

# Han ideographs, basic block and extensions A to E.
CJK_IDEOGRAPHS: Ranges = (
    (0x4E00, 0x9FFF),
    (0x3400, 0x4DBF),
    (0x20000, 0x2A6DF),
    (0x2A700, 0x2B73F),
    (0x2B740, 0x2B81F),
    (0x2B820, 0x2CEAF),
)

#: Full-width forms and their ASCII counterparts, 95 code points each.
FULL_WIDTH = "".join(map(chr, range(0xFF01, 0xFF5F))) + "　"
HALF_WIDTH = "".join(map(chr, range(0x21, 0x7F))) + " "

_FULL_WIDTH_RANGES: Ranges = ((0x3000, 0x3000), (0xFF01, 0xFF5E))

#: Code points that compatibility composition leaves alone whatever stands next
#: to them, so that text made of these needs no normalisation: ASCII, Latin-1
#: letters, ideographic comma and stop, plain kana, unified ideographs, Hangul
#: syllables, and the pictograph blocks.
NFKC_STABLE: Ranges = (
    (0x0000, 0x007F),
    (0x00C0, 0x00FF),
    (0x2600, 0x27BF),
    (0x3001, 0x3002),
    (0x3041, 0x3096),
    (0x30A1, 0x30FA),
    (0x4E00, 0x9FFF),
    (0xAC00, 0xD7A3),
    (0x1F300, 0x1FAFF),
)


def merge_ranges(ranges: Iterable[tuple[int, int]]) -> Ranges:
    """The same code points as sorted, disjoint, non-adjacent ranges."""
    merged: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if merged and low <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return tuple(merged)


def other_than(ranges: Iterable[tuple[int, int]]) -> Ranges:
    """Every code point outside *ranges*."""
    gaps, start = [], 0
    for low, high in merge_ranges(ranges):
        if start < low:
            gaps.append((start, low - 1))
        start = high + 1
    if start <= 0x10FFFF:
        gaps.append((start, 0x10FFFF))
    return tuple(gaps)


def class_body(ranges: Iterable[tuple[int, int]]) -> str:
    r"""Inside of a regex character class, in ``\x{...}`` notation."""
    return "".join(
        rf"\x{{{low:X}}}" if low == high else rf"\x{{{low:X}}}-\x{{{high:X}}}"
        for low, high in merge_ranges(ranges)
    )


def _members(ranges: Ranges) -> str:
    return "".join(chr(c) for low, high in ranges for c in range(low, high + 1))


_WS = class_body(WHITESPACE)
_WS_CHARS = _members(WHITESPACE)
# The first operand rejects the bulk of all letters in one or two comparisons.
_WS_FIRST = rf"[[^!-~\x{{C0}}-\x{{24F}}\x{{4E00}}-\x{{10FFFF}}]&&[{_WS}]]"
# Leaves a lone ordinary space alone, so that plain prose has few matches.
_UNEVEN_SPACE = rf"{_WS_FIRST}(?:(?<! )[{_WS}]*|[{_WS}]+)"
_EMOJI_RUN = rf"[[^\x00-\x{{1FFF}}\x{{3000}}-\x{{FDFF}}]&&[{class_body(EMOJI)}]]+"
_FULL_WIDTH_ANY = f"[{class_body(_FULL_WIDTH_RANGES)}]"
_FOLDABLE = rf"^[{class_body(NFKC_STABLE + _FULL_WIDTH_RANGES)}]*+\z"


def strip_space(text: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.trim(text, F.lit(_WS_CHARS))


def fold_width(text: Column) -> Column:
    """Full-width forms to ASCII; text without any is passed through untouched."""
    return F.when(text.rlike(_FULL_WIDTH_ANY), F.translate(text, FULL_WIDTH, HALF_WIDTH)).otherwise(text)


def _nfkc(values: pa.Array) -> pa.Array:
    return pa.array(
        [None if v is None else unicodedata.normalize("NFKC", v) for v in values.to_pylist()],
        pa.string(),
    )


def compose_compat(text: Column) -> Column:
    """Unicode NFKC, which folds full-width forms too.

    Spark has no such function, so this is the one Python step on text.  Only
    rows that need it reach Python: text of stable characters stays as it is,
    and with full-width forms besides it takes :func:`fold_width`, which has the
    same effect there.  The others are handed over as NULL.  The function is
    declared non-deterministic so that a filter on its result does not make
    Spark evaluate it a second time below the projection.
    """
    composed = F.arrow_udf(_nfkc, "string").asNondeterministic()
    return F.coalesce(composed(F.when(~text.rlike(_FOLDABLE), text)), fold_width(text))


def strip_symbols(text: Column) -> Column:
    """Drop emoji, pictographs and general punctuation."""
    return F.regexp_replace(text, _EMOJI_RUN, "")


def squeeze_space(text: Column) -> Column:
    """White-space runs to one space, none at the ends."""
    return F.trim(F.regexp_replace(text, _UNEVEN_SPACE, " "))


def clean_text(text: Column, strip_emoji: bool = True) -> Column:
    """Width folding and NFKC in one, optional emoji removal, white-space squeeze."""
    text = compose_compat(text)
    return squeeze_space(strip_symbols(text) if strip_emoji else text)


def script_count(text: Column, script: Ranges = CJK_IDEOGRAPHS) -> Column:
    """Number of code points of *text* that belong to *script*."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{class_body(script)}]+", ""))


def has_script(text: Column, at_least: int, script: Ranges = CJK_IDEOGRAPHS) -> Column:
    """Whether *text* holds *at_least* code points of *script*.

    Reading stops at the last character needed.
    """
    if at_least <= 0:
        return text.isNotNull()
    rest = class_body(other_than(script))
    return text.rlike(rf"^(?:[{rest}]*+[{class_body(script)}]){{{at_least}}}")


def preview(text: Column, width: int = 80) -> Column:
    """First *width* code points, with an ellipsis where something was cut."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)
