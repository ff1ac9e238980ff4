"""Streaming queries over the event table; each run ends when the input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from earshot.catalog.base import sql, tidy
from earshot.catalog.trading import LIVE_CTE
from earshot.plans import fixtures as X
from earshot.streaming import quotes as S


def _quote_stream(spark, sf):
    schema = X.table(spark, sf, "events").schema
    return X.quotes(spark, sf, S.file_stream(spark, sf, schema, "events.parquet"))


def stream_recommendations(spark, sf):
    """Streamed quotes against a static probability table per market and word."""
    static = X.quotes(spark, sf).groupBy("market_ticker", "word").agg(
        (F.min("event_id") * 37 % 101 / 100.0).alias("tx_prob"))
    scored = S.scored_stream(_quote_stream(spark, sf), static)
    out = S.drain(scored.select("event_id", "recommendation", "confidence", "kelly"), "recommendations")
    return tidy(out)


def _stream_cte() -> str:
    """The live rules with the probability of the market and word."""
    tx = "CAST((min(event_id) OVER (PARTITION BY market_ticker, word) * 37) % 101 AS DOUBLE) / 100"
    return LIVE_CTE.replace("CAST((event_id * 37) % 101 AS DOUBLE) / 100", tx)


def stream_distinct_quotes(spark, sf):
    """Every quote arrives twice; one of each is kept."""
    q = _quote_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    out = S.drain(S.drop_repeats(q, ("market_ticker", "ts")).select("market_ticker", "ts", "mid"), "distinct-quotes")
    return tidy(out.groupBy("market_ticker").agg(F.count(F.lit(1)).alias("n"), F.sum("mid").alias("mid_sum")))


def stream_daily_candles(spark, sf):
    """Every day of every market, the last and still open one included."""
    candles = S.daily_candles(_quote_stream(spark, sf))
    out = S.drain(candles, "candles", "update", S.CANDLE_KEYS)
    return tidy(out.select("market_ticker", F.to_date("day_start").alias("day"), "open_mid", "close_mid", "low_mid", "high_mid", "volume", "n_quotes"))


QUERIES = {
    "stream_recommendations": (stream_recommendations, sql(X.QUOTES_SQL + _stream_cte(), """
SELECT event_id, recommendation, confidence, round(kelly, 6) + 0.0::DOUBLE AS kelly FROM rec""")),
    "stream_distinct_quotes": (stream_distinct_quotes, sql(X.QUOTES_SQL, """
, d AS (SELECT DISTINCT market_ticker, ts, mid FROM q)
SELECT market_ticker, count(*) AS n, round(sum(mid), 6) AS mid_sum FROM d GROUP BY market_ticker""")),
    "stream_daily_candles": (stream_daily_candles, sql(X.QUOTES_SQL, """
SELECT market_ticker, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, round(arg_min(mid, (ts, event_id)), 6) AS open_mid, round(arg_max(mid, (ts, event_id)), 6) AS close_mid,
       round(min(mid), 6) AS low_mid, round(max(mid), 6) AS high_mid, round(sum(volume), 6) AS volume, count(*) AS n_quotes
FROM q GROUP BY market_ticker, CAST(ts AS DATE)""")),
}
