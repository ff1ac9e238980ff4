"""Landed market JSON: flat market records, event indexes and live events with nested markets."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.constants import SERIES_STOCKS_FILE, SETTLED_STATUSES, STOCK_SECTORS_FILE
from earshot.functions import market, periods, trading
from earshot.operators.ranking import keep_first
from earshot.schemas import RAW_EVENT, RAW_MARKET


def read_market_files(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array per event file; the series is the file stem before its first '-'."""
    name = F.col("_metadata.file_name")
    raw = spark.read.schema(RAW_MARKET).option("multiLine", True).option("pathGlobFilter", "*.json").json(path)
    return raw.select("*", name.alias("file_name")).where(~F.startswith("file_name", F.lit("events_"))).select(
        *raw.columns, F.split("file_name", r"-|\.json$")[0].alias("series_ticker")
    )


def read_market_lines(spark: SparkSession, path: str) -> DataFrame:
    """One market per line, splittable; the series is the event ticker before its first '-'."""
    raw = spark.read.schema(RAW_MARKET).json(path)
    return raw.withColumn("series_ticker", F.split("event_ticker", "-")[0])


def read_event_index(spark: SparkSession, path: str) -> DataFrame:
    """Events of the events_{series}.json files; events without any ticker are dropped."""
    raw = (
        spark.read.schema(RAW_EVENT).option("multiLine", True).option("pathGlobFilter", "events_*.json").json(path)
        .select("*", F.col("_metadata.file_name").alias("file_name"))
    )
    return event_index(raw.withColumn("series_ticker", F.regexp_extract("file_name", r"^events_(.*)\.json$", 1)))


def event_index(raw: DataFrame) -> DataFrame:
    ticker = F.coalesce(F.nullif("event_ticker", F.lit("")), F.nullif("ticker", F.lit("")))
    return raw.select("series_ticker", ticker.alias("event_ticker")).where("event_ticker IS NOT NULL")


def flatten_markets(raw: DataFrame, settled_only: bool = False) -> DataFrame:
    """The sixteen-column market record."""
    if settled_only:
        raw = raw.where(F.coalesce(F.col("status").isin(*SETTLED_STATUSES), F.lit(False)))
    text, money = market.text_or_blank, market.money
    result = F.lower(text(F.col("result")))
    return raw.select(
        "series_ticker", text(F.col("event_ticker")).alias("event_ticker"), text(F.col("ticker")).alias("market_ticker"),
        market.company_label(F.col("series_ticker")).alias("company_label"),
        text(F.col("custom_strike.Word")).alias("word"), result.alias("result"), market.outcome(result).alias("label"),
        money(F.col("previous_price_dollars")).alias("implied_prob"),
        F.substring(text(F.col("close_time")), 1, 10).alias("close_date"),
        F.substring(text(F.col("settlement_ts")), 1, 10).alias("settlement_date"),
        text(F.col("status")).alias("status"), money(F.col("yes_bid_dollars"), 0.0).alias("yes_bid"),
        money(F.col("no_bid_dollars"), 0.0).alias("no_bid"), money(F.col("volume_fp"), 0.0).alias("volume"),
        money(F.col("open_interest_fp"), 0.0).alias("open_interest"), text(F.col("rules_primary")).alias("rules_primary"),
    )


def _fixed_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small table of fixed values, read on the driver: executors need not see the file."""
    with open(path, newline="", encoding="utf-8") as lines:
        _, *rows = csv.reader(lines)
    return spark.createDataFrame([tuple(row) for row in rows], schema)


def series_to_stock(spark: SparkSession, path: str = SERIES_STOCKS_FILE) -> DataFrame:
    """(series_ticker, stock_ticker) of the tracked series; a small fixed dimension."""
    return _fixed_table(spark, path, "series_ticker STRING, stock_ticker STRING")


def stock_sectors(spark: SparkSession, path: str = STOCK_SECTORS_FILE) -> DataFrame:
    return _fixed_table(spark, path, "stock_ticker STRING, sector STRING")


def with_sector(df: DataFrame, sectors: DataFrame, key: str = "stock_ticker") -> DataFrame:
    """df + sector, 'Unknown' where the stock is not listed. The dimension is fixed and small."""
    return df.join(F.broadcast(sectors), key, "left").withColumn("sector", F.coalesce("sector", F.lit("Unknown")))


def _ask(value: Column) -> Column:
    """A missing or blank ask counts as 1; the text '0.0000' stays 0."""
    return market.money(value, 1.0)


def live_quotes(events: DataFrame, stocks: DataFrame, default_year: int = 2026, default_quarter: int = 2) -> DataFrame:
    """Open markets of tracked series as one quote record each, the first one seen per ticker."""
    m = F.col("market")
    nested = (
        events.join(F.broadcast(stocks), "series_ticker")
        .select("series_ticker", "stock_ticker", F.coalesce("event_ticker", F.lit("")).alias("event_ticker"),
                F.posexplode("markets").alias("position", "market"))
        .where((m["status"] == "active") & (F.coalesce(m["ticker"], F.lit("")) != ""))
        .withColumn("market_ticker", m["ticker"])
        .withColumn("word", F.coalesce(F.nullif(m["yes_sub_title"], F.lit("")), F.nullif(m["custom_strike"]["Word"], F.lit(""))))
    )
    first = keep_first(nested, ["market_ticker"], ["series_ticker", "event_ticker", "position"])
    quotes = first.where("word IS NOT NULL").select(
        "market_ticker", "stock_ticker", "event_ticker", "word",
        market.money(m["yes_bid_dollars"], 0.0).alias("yes_bid"), _ask(m["yes_ask_dollars"]).alias("yes_ask"),
        market.money(m["no_bid_dollars"], 0.0).alias("no_bid"), _ask(m["no_ask_dollars"]).alias("no_ask"),
        market.money(m["volume_fp"], 0.0).alias("volume"),
        market.money(m["previous_yes_bid_dollars"], 0.0).alias("prev_bid"),
        market.money(m["previous_yes_ask_dollars"], 0.0).alias("prev_ask"),
        periods.event_date(F.col("event_ticker")).alias("call_date"),
        periods.target_year(F.col("event_ticker"), default_year).alias("target_year"),
        periods.target_quarter(F.col("event_ticker"), default_quarter).alias("target_quarter"),
    )
    return with_live_mids(quotes).drop("prev_bid", "prev_ask")


def with_live_mids(quotes: DataFrame) -> DataFrame:
    sides = (F.col("prev_bid"), F.col("prev_ask"), F.col("yes_bid"), F.col("yes_ask"))
    return (
        quotes.withColumn("live_open_mid", trading.open_mid(*sides))
        .withColumn("live_current_mid", trading.mid(F.col("yes_bid"), F.col("yes_ask")))
        .withColumn("live_momentum", trading.momentum(*sides))
        .withColumn("has_prior_session", trading.has_prior_session(F.col("prev_bid"), F.col("prev_ask")))
    )
