"""Trailing-window word features over the last calls before a target period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.constants import HISTORY_WINDOW
from earshot.functions import periods
from earshot.functions import words as W
from earshot.operators.mentions import mention_hits, variant_count
from earshot.session import materialize


def with_sort_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn(
        "sort_key", F.coalesce(F.col("call_date"), periods.period_fallback_date(F.col("period_num")))
    )


def window_docs(docs: DataFrame, targets: DataFrame, size: int = HISTORY_WINDOW) -> DataFrame:
    """(ticker, target_period, rank, doc_id): the last calls of an earlier period, rank 1 newest.

    Calls are chosen per ticker and period, not per word. The newest `size` calls of each period
    are enough, which bounds the join with the target periods by the calendar.
    """
    newest_first = [F.col("sort_key").desc(), F.col("period_num").desc(), F.col("doc_id").desc()]
    calls = with_sort_key(docs).select("ticker", "period_num", "sort_key", "doc_id")
    per_period = (
        calls.withColumn("r", F.row_number().over(Window.partitionBy("ticker", "period_num").orderBy(*newest_first)))
        .where(F.col("r") <= size).drop("r")
    )
    points = targets.select("ticker", "target_period").distinct()
    return (
        points.join(per_period, "ticker").where(F.col("period_num") < F.col("target_period"))
        .withColumn("rank", F.row_number().over(Window.partitionBy("ticker", "target_period").orderBy(*newest_first)))
        .where(F.col("rank") <= size)
        .select("ticker", "target_period", "rank", "doc_id")
    )


def window_counts(docs: DataFrame, targets: DataFrame, size: int = HISTORY_WINDOW, hits: DataFrame | None = None) -> DataFrame:
    """(ticker, word, target_period, rank, cnt) with a zero for calls that never say the word.

    Words are counted where texts are read; windows meet the narrow counts (ticker, word, doc_id, hits), which a caller
    that holds them may hand in.
    """
    targets = targets.select("ticker", "word", "target_period").distinct()
    calls = window_docs(docs, targets, size)
    if hits is None:
        hits = mention_hits(docs, targets, variant_count)
    return (
        targets.join(calls, ["ticker", "target_period"])
        .join(hits.select("ticker", "word", "doc_id", "hits"), ["ticker", "word", "doc_id"], "left")
        .select("ticker", "word", "target_period", "rank", F.coalesce("hits", F.lit(0)).alias("cnt"))
    )


def _upto(k: int, value: str, agg) -> Column:
    return agg(F.when(F.col("rank") <= k, F.col(value)))


def trailing_features(counts: DataFrame) -> DataFrame:
    """One row per (ticker, word, target_period) from ranked counts, in a single aggregation."""
    said = counts.withColumn("said", (F.col("cnt") > 0).cast("int"))
    n = F.count(F.lit(1))
    r2 = F.when(n >= 2, _upto(2, "cnt", F.avg)).otherwise(0.0)
    o2 = F.when(n >= 4, F.avg(F.when(F.col("rank").between(3, 4), F.col("cnt")))).otherwise(0.0)
    return (
        said.groupBy("ticker", "word", "target_period")
        .agg(
            n.cast("int").alias("n_past"), F.avg("said").alias("base_rate"), F.avg("cnt").alias("mean_count"),
            F.max("cnt").alias("max_count"), F.sum("cnt").cast("int").alias("total_mentions"),
            *[_upto(k, "said", F.avg).alias(f"rate_last_{k}q") for k in (1, 2, 4)],
            *[_upto(k, "cnt", F.sum).cast("int").alias(f"count_last_{k}q") for k in (1, 2, 4)],
            *[F.when(n >= k, _upto(k, "said", F.max)).otherwise(0).alias(f"said_last_{k}q") for k in (1, 2, 4)],
            r2.alias("recent_mean"), o2.alias("older_mean"),
            _upto(4, "cnt", F.sum).cast("int").alias("mgmt_count_4q"),
        )
        .withColumn("trend_delta", F.col("recent_mean") - F.col("older_mean"))
        .withColumn("trend_ratio", F.col("recent_mean") / (F.col("older_mean") + 0.01))
        .withColumn("is_trending_up", (F.col("recent_mean") > F.col("older_mean")).cast("int"))
        .drop("recent_mean", "older_mean")
    )


def word_shape(df: DataFrame) -> DataFrame:
    word = F.col("word")
    return (
        df.withColumn("word_n_variants", W.n_variants(word)).withColumn("word_is_phrase", W.is_phrase(word))
        .withColumn("word_char_len", F.length(word))
        .withColumn("word_is_common_financial", W.is_common_financial(word))
    )


def word_features(docs: DataFrame, targets: DataFrame, size: int = HISTORY_WINDOW, hits: DataFrame | None = None) -> DataFrame:
    return word_shape(trailing_features(window_counts(docs, targets, size, hits)))


def sector_period_means(features: DataFrame) -> DataFrame:
    keys = ["sector", "word", "period_num"]
    return (
        features.dropna(subset=keys).groupBy(*keys).agg(F.avg("base_rate").alias("sector_peer_base_rate"))
    )


def with_sector_peers(features: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Mean base rate of the same sector and word exactly one period earlier, else the row's own rate.

    Features that are their own history are written first, so that they are worked out once.
    """
    if history is None:
        features = materialize(features, "word-features")
    prior = sector_period_means(features if history is None else history).withColumn("period_num", F.col("period_num") + 1)
    return features.join(prior, ["sector", "word", "period_num"], "left").withColumn(
        "sector_peer_base_rate", F.coalesce("sector_peer_base_rate", "base_rate")
    )
