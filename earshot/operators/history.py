"""Leak-free history: what was known strictly before each cutoff date.

Transcripts are reduced to one row per (ticker, word, date) before anything is ordered, so no window
group is larger than the number of calendar dates, however many transcripts a ticker has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions import market, periods
from earshot.operators.mentions import mention_hits, substring, whole_word


def running_before(daily: DataFrame, cutoffs: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Sum each daily measure over the dates strictly before each cutoff.

    daily: (keys..., call_date, measures...), one row per key and date. cutoffs: (keys..., cutoff).
    """
    zero = [F.lit(0).cast("long").alias(m) for m in measures]
    points = cutoffs.select(*keys, "cutoff").where(F.col("cutoff").isNotNull()).distinct()
    both = daily.select(
        *keys, F.col("call_date").alias("at"), F.lit(1).alias("is_doc"), *[F.col(m).cast("long").alias(m) for m in measures]
    ).unionByName(points.select(*keys, F.col("cutoff").alias("at"), F.lit(0).alias("is_doc"), *zero))
    # A cutoff sorts before the documents of its own date: the strict comparison.
    w = Window.partitionBy(*keys).orderBy("at", "is_doc").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        both.select(*keys, "at", "is_doc", *[F.sum(m).over(w).alias(m) for m in measures])
        .where("is_doc = 0").select(*keys, F.col("at").alias("cutoff"), *measures)
    )


def prior_doc_stats(docs: DataFrame, cutoffs: DataFrame, measures: dict[str, object] | None = None) -> DataFrame:
    """(ticker, cutoff, n_prior, measures...) over all dated transcripts of the ticker before the cutoff."""
    measures = measures or {}
    daily = (
        docs.where(F.col("call_date").isNotNull() & F.col("ticker").isNotNull())
        .groupBy("ticker", "call_date")
        .agg(F.count(F.lit(1)).alias("n_prior"), *[F.sum(expr).alias(name) for name, expr in measures.items()])
    )
    return running_before(daily, cutoffs.select("ticker", "cutoff"), ["ticker"], ["n_prior", *measures])


def mention_rates(docs: DataFrame, targets: DataFrame, measure=whole_word) -> DataFrame:
    """(ticker, word, cutoff, hist_rate) for distinct targets; null where nothing precedes the cutoff."""
    targets = targets.select("ticker", "word", "cutoff").where(F.col("cutoff").isNotNull()).distinct()
    dated = docs.where(F.col("call_date").isNotNull())
    daily_hits = (
        mention_hits(dated, targets, measure, keep=("call_date",))
        .groupBy("ticker", "word", "call_date").agg(F.count(F.lit(1)).alias("n_hits"))
    )
    hits = running_before(daily_hits, targets, ["ticker", "word"], ["n_hits"])
    totals = prior_doc_stats(docs, targets)
    return hits.join(totals, ["ticker", "cutoff"]).select(
        "ticker", "word", "cutoff", "n_prior", "n_hits",
        F.try_divide(F.col("n_hits"), F.col("n_prior")).alias("hist_rate"),
    )


def build_labels(docs: DataFrame, markets: DataFrame) -> DataFrame:
    """The label table: outcome, price and history rate per market."""
    rows = markets.where(F.col("word").isNotNull()).select(
        F.col("company_label").alias("ticker"), "word", F.lower("word").alias("word_key"),
        market.outcome(F.col("result"), F.col("label")).alias("mentioned"),
        market.null_if_nan(F.col("implied_prob")).alias("implied_prob"),
        periods.prediction_date(F.col("close_date"), F.col("settlement_date")).alias("cutoff"),
        market.text_or_blank(F.col("market_ticker")).alias("market_ticker"),
    )
    rates = mention_rates(docs, rows.select("ticker", F.col("word_key").alias("word"), "cutoff"))
    return (
        rows.join(rates.withColumnRenamed("word", "word_key"), ["ticker", "word_key", "cutoff"], "left")
        .select(
            "ticker", F.coalesce(F.year("cutoff"), F.lit(0)).alias("year"),
            F.coalesce(periods.calendar_quarter(F.month("cutoff")), F.lit(0)).alias("quarter"),
            F.col("cutoff").alias("call_date"), "word", "mentioned", "implied_prob", "hist_rate",
            F.lit(0).alias("in_recent_news"), "market_ticker",
        )
    )


def seen_before(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """rows + word_seen_before: 1 / 0, or null when the row has no date or nothing precedes it.

    The first date a word was said, and the first call of a ticker, decide it; no range join is needed.
    """
    dated = docs.where(F.col("call_date").isNotNull())
    keyed = rows.withColumn("word_key", F.lower("word"))
    first_said = (
        mention_hits(dated, keyed.select("ticker", F.col("word_key").alias("word")), substring,
                     keep=("call_date",))
        .groupBy("ticker", F.col("word").alias("word_key")).agg(F.min("call_date").alias("first_said"))
    )
    first_call = dated.groupBy("ticker").agg(F.min("call_date").alias("first_call"))
    return (
        keyed.join(first_call, "ticker", "left").join(first_said, ["ticker", "word_key"], "left")
        .withColumn(
            "word_seen_before",
            F.when(F.col("first_call") < F.col("cutoff"),
                   F.coalesce(F.col("first_said") < F.col("cutoff"), F.lit(False)).cast("int")),
        )
        .drop("word_key", "first_call", "first_said")
    )


def in_recent_news(news: DataFrame, rows: DataFrame, days: int = 30) -> DataFrame:
    """rows + in_recent_news: 1 when an article in [cutoff - days, cutoff] mentions the word.

    The latest mention on or before the cutoff decides; it is carried forward over daily rows.
    """
    dated = news.where(F.col("call_date").isNotNull())
    keyed = rows.withColumn("word_key", F.lower("word"))
    targets = (
        keyed.where(F.col("cutoff").isNotNull()).select("ticker", F.col("word_key").alias("word"), "cutoff").distinct()
    )
    daily = mention_hits(dated, targets, whole_word, keep=("call_date",)).select(
        "ticker", "word", F.col("call_date").alias("at")
    ).distinct()
    both = daily.withColumn("is_target", F.lit(0)).unionByName(
        targets.select("ticker", "word", F.col("cutoff").alias("at"), F.lit(1).alias("is_target"))
    )
    w = Window.partitionBy("ticker", "word").orderBy("at", "is_target").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    latest = (
        both.withColumn("latest", F.max(F.when(F.col("is_target") == 0, F.col("at"))).over(w))
        .where("is_target = 1")
        .select("ticker", F.col("word").alias("word_key"), F.col("at").alias("cutoff"),
                (F.col("latest") >= F.date_sub("at", days)).alias("recent"))
    )
    return (
        keyed.join(latest, ["ticker", "word_key", "cutoff"], "left")
        .withColumn("in_recent_news", F.coalesce(F.col("recent"), F.lit(False)).cast("int"))
        .drop("word_key", "recent")
    )
