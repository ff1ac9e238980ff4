"""Descriptive aggregates over markets and transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions import market
from earshot.functions.text import word_count
from earshot.operators.ranking import keep_first


def coverage_report(series: DataFrame, events: DataFrame, markets: DataFrame) -> DataFrame:
    """Events, markets and call date range per series; a series without markets stays with zeros."""
    n_events = events.groupBy("series_ticker").agg(F.count(F.lit(1)).alias("n_events"))
    close = F.nullif(F.substring("close_date", 1, 10), F.lit(""))
    per_series = markets.groupBy("series_ticker").agg(
        F.count(F.lit(1)).alias("n_markets"), F.min(close).alias("earliest_call"), F.max(close).alias("latest_call")
    )
    return (
        series.join(n_events, "series_ticker", "left").join(per_series, "series_ticker", "left")
        .select(*series.columns, F.coalesce("n_events", F.lit(0)).alias("n_events"),
                F.coalesce("n_markets", F.lit(0)).alias("n_markets"), "earliest_call", "latest_call")
        .orderBy(F.col("n_markets").desc(), "series_ticker")
    )


def coverage_totals(coverage: DataFrame) -> DataFrame:
    return coverage.agg(
        F.count_if(F.col("n_markets") > 0).alias("n_with_data"), F.count(F.lit(1)).alias("n_series"),
        F.coalesce(F.sum(F.when(F.col("n_markets") > 0, F.col("n_markets"))), F.lit(0)).alias("total_markets"),
    )


def mention_series(series: DataFrame, query: str) -> DataFrame:
    return series.where(
        market.matches_series_query(F.col("title"), F.col("series_ticker"), query)
        & market.is_mention_series(F.col("series_ticker"))
    )


def series_sizes(markets: DataFrame) -> DataFrame:
    return markets.where(F.col("series_ticker").isNotNull()).groupBy("series_ticker").agg(F.count(F.lit(1)).alias("n"))


def size_range(markets: DataFrame) -> DataFrame:
    return series_sizes(markets).agg(
        F.min("n").alias("min_n"), F.max("n").alias("max_n"), F.avg("n").alias("mean_n")
    )


def word_company_counts(markets: DataFrame) -> DataFrame:
    """Companies, markets and yes rate per word."""
    return markets.where(F.col("word").isNotNull()).groupBy("word").agg(
        F.countDistinct("series_ticker").alias("n_companies"), F.count(F.lit(1)).alias("n_markets"),
        F.avg("label").alias("yes_rate"),
    )


def word_company_counts_approx(markets: DataFrame, rsd: float = 0.02) -> DataFrame:
    return markets.where(F.col("word").isNotNull()).groupBy("word").agg(
        F.approx_count_distinct("series_ticker", rsd).alias("n_companies")
    )


def top_words(markets: DataFrame, n: int) -> DataFrame:
    return word_company_counts(markets).orderBy(F.col("n_companies").desc(), "word").limit(n)


def company_yes_rates(markets: DataFrame) -> DataFrame:
    return (
        markets.where(F.col("series_ticker").isNotNull()).groupBy("series_ticker")
        .agg(F.avg("label").alias("yes_rate"), F.count("label").alias("n")).orderBy("yes_rate", "series_ticker")
    )


def result_counts(markets: DataFrame) -> DataFrame:
    return markets.where(F.col("result").isNotNull()).groupBy("result").agg(F.count(F.lit(1)).alias("n"))


def first_market_per_series(markets: DataFrame, order: list[str]) -> DataFrame:
    return keep_first(markets, ["series_ticker"], order)


def price_extremeness(markets: DataFrame) -> DataFrame:
    p = F.col("implied_prob")
    return markets.where(p.isNotNull()).agg(
        F.avg(((p < 0.05) | (p >= 0.95)).cast("int")).alias("extreme"),
        F.avg(p.between(0.20, 0.80).cast("int")).alias("uncertain"),
    )


def dataset_summary(markets: DataFrame) -> DataFrame:
    return markets.agg(
        F.count(F.lit(1)).alias("n_markets"), F.countDistinct("series_ticker").alias("n_companies"),
        F.countDistinct("word").alias("n_words"), F.min("call_date").alias("first_date"),
        F.max("call_date").alias("last_date"), F.avg("label").alias("yes_rate"),
        F.sum("label").alias("n_yes"), F.count_if(F.col("label") == 0).alias("n_no"),
    )


def word_count_describe(docs: DataFrame) -> DataFrame:
    """Word-count summary per ticker with interpolated quartiles.

    Lengths are counted per distinct value first, so the percentile state holds distinct lengths only.
    """
    lengths = (
        docs.where(F.col("ticker").isNotNull()).select("ticker", word_count(F.col("content")).alias("words"))
        .groupBy("ticker", "words").agg(F.count(F.lit(1)).alias("freq"))
    )
    total = F.sum("freq")
    mean = F.sum(F.col("words") * F.col("freq")) / total
    squares = F.sum(F.col("words").cast("double") * F.col("words") * F.col("freq"))
    return lengths.groupBy("ticker").agg(
        total.alias("n"), mean.alias("mean_words"),
        F.when(total > 1, F.sqrt((squares - total * mean * mean) / (total - 1))).alias("std_words"),
        F.min("words").alias("min_words"),
        *[F.percentile("words", q, F.col("freq")).alias(f"p{int(q * 100)}_words") for q in (0.25, 0.5, 0.75)],
        F.max("words").alias("max_words"),
    )


def daily_price_summary(quotes: DataFrame) -> DataFrame:
    """Opening mid, spread of mids and volume per market and day."""
    return quotes.groupBy("market_ticker", F.to_date("ts").alias("day")).agg(
        F.min_by("mid", F.struct("ts", "event_id")).alias("daily_open_mid"), F.stddev_samp("mid").alias("daily_std"),
        F.sum("volume").alias("daily_total_vol"),
    )


def reason_histogram(recommendations: DataFrame) -> DataFrame:
    return recommendations.groupBy("recommendation", "confidence").agg(F.count(F.lit(1)).alias("n"))


def feature_sanity(features: DataFrame, scored: DataFrame) -> DataFrame:
    """Share of rows whose sector rate differs from their own rate, and mean prediction against outcome."""
    sector = features.agg(
        F.avg((F.col("sector_peer_base_rate") != F.col("base_rate")).cast("int")).alias("sector_differs")
    )
    return scored.agg(
        F.avg("tx_prob").alias("mean_pred"), F.avg("market_yes").alias("mean_actual"),
        F.count("daily_open_mid").alias("n_with_open_mid"), F.count(F.lit(1)).alias("n"),
    ).withColumn("sector_differs", sector.scalar())
