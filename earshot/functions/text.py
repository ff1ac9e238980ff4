"""Column expressions over transcript text."""

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from earshot.constants import (
    CODED_QUARTER, GOOD_NAME, HALF_WORDS, NAMED_HALF, NAMED_QUARTER, NOT_SPACE, QUARTER_WORDS, RELATED_FOOTER, SAFE_HARBOR_PHRASES, SPACE,
    TRANSCRIPT_NAME, URL,
)


@pandas_udf(StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda s: unicodedata.normalize("NFKC", s), na_action="ignore")


def nfkc(text: Column) -> Column:
    """Only rows with non-ASCII text are sent to Python; the others pass a null there."""
    return F.coalesce(_nfkc(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)


def strip_related_footer(text: Column) -> Column:
    return F.regexp_replace(text, RELATED_FOOTER, "")


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, " ")


def strip_safe_harbor(text: Column) -> Column:
    """Drop every terminated sentence that holds a boilerplate phrase.

    A sentence can only start at the text start or right after a terminator, so one look-ahead per
    sentence is enough and the scan stays linear on text without punctuation.
    """
    # Every phrase starts at a word boundary, so that is tested once per position.
    phrases = "|".join(p.removeprefix(r"\b") for p in SAFE_HARBOR_PHRASES)
    return F.regexp_replace(text, rf"(?iU)(?<![^.?!])(?=[^.?!]*?\b(?:{phrases}))[^.?!]*+[.?!]", " ")


def collapse_whitespace(text: Column) -> Column:
    """Single blanks already in place are left alone."""
    return F.trim(F.regexp_replace(text, rf"(?U){SPACE}{{2,}}|[\s\x1C-\x1F&&[^ ]]", " "))


def clean_transcript(text: Column) -> Column:
    stripped = strip_safe_harbor(strip_urls(strip_related_footer(nfkc(text))))
    return collapse_whitespace(F.lower(stripped))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"(?U){NOT_SPACE}+"))


def strip_text(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _lookup(key: Column, table: dict[str, int]) -> Column:
    expr = F.lit(None).cast("int")
    for name, number in reversed(table.items()):
        expr = F.when(key == name, F.lit(number)).otherwise(expr)
    return expr


def quarter_in_text(text: Column) -> Column:
    """First quarter named in the text: spelled out, then Q1-Q4, then first / second half."""
    named = F.lower(_found(text, NAMED_QUARTER))
    coded = _found(text, CODED_QUARTER).cast("int")
    half = F.lower(_found(text, NAMED_HALF))
    return F.coalesce(_lookup(named, QUARTER_WORDS), coded, _lookup(half, HALF_WORDS))


def header_date_text(content: Column) -> Column:
    return _found(content, r"(?mdU)^Date:\s*(\S+)")


def quarter_from_date_header(content: Column) -> Column:
    """Calls report on the previous calendar quarter."""
    stamp = F.trim(_found(content, r"(?mdU)^Date:\s*(.+)$"))
    when = F.coalesce(
        F.try_to_timestamp(stamp, F.lit("yyyy-M-d H:m:s")), F.try_to_timestamp(stamp, F.lit("yyyy-M-d"))
    )
    return (F.pmod(F.quarter(when) - 2, F.lit(4)) + 1).cast("int")


def infer_quarter(content: Column) -> Column:
    operator_line = _found(content, r"(?md)^Operator:(.+)$")
    return F.coalesce(
        quarter_in_text(operator_line), quarter_in_text(content), quarter_from_date_header(content)
    )


def patch_period_header(content: Column, quarter: Column) -> Column:
    r"""Only the first Period header changes: \A lets the pattern match once."""
    return F.regexp_replace(
        content,
        F.lit(r"(?mdU)\A(?<before>[\s\S]*?)^(?<head>Period:\s*Q)\S*(?<year>\s+\d{4})"),
        F.concat(F.lit("${before}${head}"), quarter.cast("string"), F.lit("${year}")),
    )


def is_good_name(name: Column) -> Column:
    return name.rlike(GOOD_NAME)


def name_ticker(name: Column) -> Column:
    return _found(name, TRANSCRIPT_NAME, 1)


def name_year(name: Column) -> Column:
    return _found(name, TRANSCRIPT_NAME, 2)


def stem_year(stem: Column) -> Column:
    """Year of '2024Q2' or 'KO_2024_Q2'; 0 when the stem has neither form."""
    return F.coalesce(
        _found(stem, r"\A(\d{4})Q\d\z"), _found(stem, r"\A[A-Za-z]+_(\d{4})_Q\d\z"), F.lit("0")
    ).cast("int")


def stem_quarter(stem: Column) -> Column:
    return F.coalesce(
        _found(stem, r"\A\d{4}Q(\d)\z"), _found(stem, r"\A[A-Za-z]+_\d{4}_Q(\d)\z"), F.lit("0")
    ).cast("int")


def pair_text(word: Column, context: Column) -> Column:
    return F.concat(word, F.lit(" [SEP] "), context)


def head_tokens(context: Column, n: int) -> Column:
    """First n whitespace tokens of the context, joined by single spaces."""
    return F.array_join(F.slice(F.regexp_extract_all(context, F.lit(f"(?U){NOT_SPACE}+"), F.lit(0)), 1, n), " ")
