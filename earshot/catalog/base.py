"""Shared pieces of the registered queries."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A character that is no part of a word, for SQL engines whose \b knows ASCII only.
NON_WORD = r"[^\p{L}\p{M}\p{N}_]"


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Plain comparable columns: rounded doubles, 64-bit integers, dates as text."""
    out = []
    for name, kind in df.dtypes:
        col = F.col(f"`{name}`")
        if kind in ("double", "float"):
            col = F.round(col.cast("double"), digits) + F.lit(0.0)
        elif kind in ("int", "smallint", "tinyint", "boolean"):
            col = col.cast("bigint")
        elif kind == "date":
            col = col.cast("string")
        out.append(col.alias(name))
    return df.select(*out)


def sql(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def says(word: str, text: str = "content") -> str:
    return f"regexp_matches(lower({text}), '(^|{NON_WORD})' || regexp_escape(lower({word})) || '($|{NON_WORD})')"


def count_of(literal: str, text: str = "content") -> str:
    """Whole-word occurrences; every non-word character is doubled so neighbours do not share one."""
    def doubled(value: str) -> str:
        return f"regexp_replace({value}, '({NON_WORD})', '\\1\\1', 'g')"

    pattern = f"'(?:^|{NON_WORD})' || regexp_escape({doubled(literal)}) || '(?:$|{NON_WORD})'"
    return f"len(regexp_extract_all({doubled(f'lower({text})')}, {pattern}))"


VARIANT_COUNT_SQL = (
    "list_sum([{one} FOR v IN string_split_regex(trim(lower({word})), '\\s*/\\s*')])"
)


def variant_count(word: str, text: str = "content") -> str:
    return VARIANT_COUNT_SQL.format(one=count_of("v", text), word=word)


def _plain_count(literal: str) -> str:
    """count_of for a fixed literal of letters, blanks and slashes: the pattern is a constant."""
    doubled = re.sub(r"(\W)", r"\1\1", literal)
    text = f"regexp_replace(lower(content), '({NON_WORD})', '\\1\\1', 'g')"
    return f"len(regexp_extract_all({text}, '(?:^|{NON_WORD}){doubled}(?:$|{NON_WORD})'))"


def word_hits(words: tuple[str, ...]) -> str:
    """CTE wh(ticker, doc_id, call_date, period_num, s.w, s.hit, s.cnt): every call against every fixed word."""
    items = ", ".join(
        f"{{'word': '{w}', 'w': '{w.lower()}', 'hit': CASE WHEN regexp_matches(lower(content), '(^|{NON_WORD}){w.lower()}($|{NON_WORD})') THEN 1 ELSE 0 END, "
        f"'cnt': CAST({' + '.join(_plain_count(v.strip()) for v in w.lower().split('/'))} AS BIGINT)}}"
        for w in words
    )
    return f", wh AS MATERIALIZED (SELECT ticker, doc_id, call_date, period_num, base_date, unnest([{items}]) AS s FROM t)"
