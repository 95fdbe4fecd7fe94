"""Label canonicalisation and response parsing as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import strip_space
from gleanery.schemas import (
    PRIMARY_FALLBACK,
    PRIMARY_KEYS,
    PRIMARY_LABELS,
    PRIMARY_SPELLINGS,
    SECONDARY_FALLBACK,
    SECONDARY_KEYS,
    SECONDARY_LABELS,
    SECONDARY_SPELLINGS,
)


def label_form(value: Column) -> Column:
    """Upper case, no outer white space, inner spaces as underscores."""
    return F.replace(F.upper(strip_space(value)), F.lit(" "), F.lit("_"))


def canonical_label(
    value: Column,
    allow: Sequence[str],
    spellings: Mapping[str, Sequence[str]],
    fallback: str,
) -> Column:
    """The allowed label *value* means, or *fallback*.

    *spellings* lists further accepted forms per label; one literal map holds
    these and the labels themselves, so every row costs one lookup.
    """
    known = {label: label for label in allow}
    known.update({form: label for label, forms in spellings.items() for form in forms if label in allow})
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(F.try_element_at(table, label_form(value)), F.lit(fallback))


def canonical_primary(value: Column) -> Column:
    return canonical_label(value, PRIMARY_LABELS, PRIMARY_SPELLINGS, PRIMARY_FALLBACK)


def canonical_secondary(value: Column) -> Column:
    return canonical_label(value, SECONDARY_LABELS, SECONDARY_SPELLINGS, SECONDARY_FALLBACK)


def strip_fence(response: Column) -> Column:
    """Payload of a response that may come wrapped in a code fence.

    A leading fence takes its whole line with it, closing fence lines go too,
    and so does one semicolon at the very end.
    """
    text = strip_space(response)
    opened = F.regexp_replace(text, r"^```[^\n]*(?:\n|\z)", "")
    closed = F.regexp_replace(opened, r"(?:(?:^|\n)[^\S\n]*```[^\n]*)+\z", "")
    text = F.when(text.startswith("```"), strip_space(closed)).otherwise(text)
    return strip_space(F.regexp_replace(text, r";\z", ""))


def choose_payload(text: Column, parts: Column) -> Column:
    """First payload that is not blank: of the response text, else of its *parts*."""

    def filled(value: Column) -> Column:
        return F.nullif(strip_fence(value), F.lit(""))

    found = F.filter(F.transform(parts, filled), lambda p: p.isNotNull())
    return F.coalesce(filled(text), F.get(found, F.lit(0)))


def parse_labels(response: Column) -> Column:
    """``array<struct<primary, secondary>>`` of a response, NULL if it is no list.

    Every item keeps its position; an item without labels has NULL in both.
    """
    items = F.try_variant_get(F.try_parse_json(strip_fence(response)), "$", "array<variant>")

    def first_of(item: Column, keys: Sequence[str]) -> Column:
        return F.coalesce(*[F.try_variant_get(item, f"$.{key}", "string") for key in keys])

    return F.transform(
        items,
        lambda item: F.struct(
            first_of(item, PRIMARY_KEYS).alias("primary"),
            first_of(item, SECONDARY_KEYS).alias("secondary"),
        ),
    )


def is_label(value: Column, allow: Sequence[str]) -> Column:
    """Exact membership; NULL is not a label."""
    return F.coalesce(value.isin(*allow), F.lit(False))
