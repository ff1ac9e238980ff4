"""Calendar and fiscal period expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from earshot.constants import MONTH_CODES


def to_date_or_null(text: Column) -> Column:
    return F.to_date(F.try_to_timestamp(text))


def prediction_date(close_date: Column, settlement_date: Column) -> Column:
    """Close date, or settlement date where the close date is missing or blank."""
    return to_date_or_null(F.coalesce(F.nullif(close_date, F.lit("")), settlement_date))


def calendar_quarter(month: Column) -> Column:
    return (F.floor((month - 1) / 3) + 1).cast("int")


def period_num(year: Column, quarter: Column) -> Column:
    return year * 4 + quarter


def period_fallback_date(period: Column) -> Column:
    """First day after the end of the quarter."""
    return F.make_date(
        F.floor(period / 4).cast("int"), (F.pmod(period, F.lit(4)) * 3 + 1).cast("int"), F.lit(1)
    )


_EVENT_SUFFIX = r"-(\d{2})([A-Z]{3})(\d{2})$"


def _event_part(event_ticker: Column, group: int) -> Column:
    return F.nullif(F.regexp_extract(event_ticker, _EVENT_SUFFIX, group), F.lit(""))


def event_month(event_ticker: Column) -> Column:
    """Month number of the ticker suffix; an unknown month code reads as January."""
    code = _event_part(event_ticker, 2)
    months = F.array(*[F.lit(m) for m in MONTH_CODES])
    return F.when(code.isNotNull(), F.greatest(F.array_position(months, code), F.lit(1))).cast("int")


def event_year(event_ticker: Column) -> Column:
    return (F.lit(2000) + _event_part(event_ticker, 1).cast("int")).cast("int")


def event_date(event_ticker: Column) -> Column:
    text = F.concat_ws(
        "-", event_year(event_ticker).cast("string"), event_month(event_ticker).cast("string"),
        _event_part(event_ticker, 3),
    )
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyy-M-d")))


def target_year(event_ticker: Column, default: int = 2026) -> Column:
    return F.coalesce(event_year(event_ticker), F.lit(default))


def target_quarter(event_ticker: Column, default: int = 2) -> Column:
    return F.coalesce(calendar_quarter(event_month(event_ticker)), F.lit(default))


def news_window_end(year: Column, quarter: Column) -> Column:
    """The call is taken to be on the 15th of the first month after the quarter."""
    return F.make_date(year + F.when(quarter == 4, 1).otherwise(0), F.pmod(quarter * 3, F.lit(12)) + 1, F.lit(15))


def news_window_start(year: Column, quarter: Column, days: int = 30) -> Column:
    return F.date_sub(news_window_end(year, quarter), days)
