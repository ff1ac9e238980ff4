"""Market field expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from earshot.constants import SERIES_PREFIXES


def text_or_blank(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def money(value: Column, default: float | None = None) -> Column:
    """Price text to double; blank, missing or unreadable text gives the default."""
    parsed = F.nullif(value, F.lit("")).try_cast("double")
    return parsed if default is None else F.coalesce(parsed, F.lit(float(default)))


def company_label(series: Column) -> Column:
    return F.regexp_replace(series, "^(" + "|".join(SERIES_PREFIXES) + ")", "")


def series_display_label(series: Column) -> Column:
    """Text after the last MENTION; differs from company_label on purpose."""
    return F.substring_index(series, "MENTION", -1)


def outcome(result: Column, label: Column | None = None) -> Column:
    derived = F.coalesce(F.lower(result) == "yes", F.lit(False)).cast("int")
    return derived if label is None else F.coalesce(label.cast("int"), derived)


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def in_uncertain_band(prob: Column, low: float = 0.2, high: float = 0.8) -> Column:
    return F.coalesce(prob.between(low, high), F.lit(False))


def matches_series_query(title: Column, ticker: Column, query: str) -> Column:
    q = query.lower()
    return (
        F.contains(F.lower(text_or_blank(title)), F.lit(q))
        | F.contains(F.lower(text_or_blank(ticker)), F.lit(q))
    )


def is_mention_series(ticker: Column) -> Column:
    return F.contains(F.upper(text_or_blank(ticker)), F.lit("MENTION"))
