"""Column expressions over market words and their mentions in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from earshot.constants import COMMON_FINANCIAL_WORDS
from earshot.functions.text import strip_text


def word_variants(word: Column) -> Column:
    """'AI / AI model' -> ['ai', 'ai model']."""
    parts = F.transform(F.split(word, r"(?U)\s*/\s*"), lambda v: F.lower(strip_text(v)))
    return F.coalesce(F.filter(parts, lambda v: v != ""), F.array().cast("array<string>"))


def whole_word_pattern(literal: Column) -> Column:
    """The literal between word boundaries.

    Both are tested once the literal is found, the first by looking back over it: asked at every character of a text,
    a boundary costs far more than the literal.
    """
    quoted = F.concat(F.lit("\\Q"), F.replace(literal, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    return F.concat(F.lit("(?U)"), quoted, F.lit("\\b(?<=\\b"), quoted, F.lit(")"))


def says_word(lower_text: Column, lower_word: Column) -> Column:
    """Whole-word literal match; the substring test skips most regex work."""
    return F.contains(lower_text, lower_word) & F.regexp_like(lower_text, whole_word_pattern(lower_word))


def contains_word(text: Column, word: Column) -> Column:
    return F.contains(F.lower(text), F.lower(word))


def count_literal(lower_text: Column, literal: Column) -> Column:
    return F.when(
        F.contains(lower_text, literal), F.regexp_count(lower_text, whole_word_pattern(literal))
    ).otherwise(F.lit(0))


def count_variants(lower_text: Column, variants: Column) -> Column:
    """Sum over variants, so overlapping variants count twice."""
    return F.aggregate(variants, F.lit(0), lambda total, v: total + count_literal(lower_text, v))


def once(value: Column, use) -> Column:
    """Evaluate value one time and hand it to use() as a bound variable."""
    return F.element_at(F.transform(F.array(value), use), 1)


def count_mentions(text: Column, word: Column) -> Column:
    counted = once(F.lower(text), lambda t: count_variants(t, word_variants(word)))
    return F.coalesce(counted, F.lit(0))


def n_variants(word: Column) -> Column:
    return F.size(word_variants(word))


def is_phrase(word: Column) -> Column:
    return F.exists(word_variants(word), lambda v: F.contains(v, F.lit(" "))).cast("int")


def is_common_financial(word: Column) -> Column:
    common = F.array(*[F.lit(w) for w in COMMON_FINANCIAL_WORDS])
    return F.arrays_overlap(word_variants(word), common).cast("int")
