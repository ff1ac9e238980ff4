"""From quotes with probabilities to ranked recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.constants import EDGE_THRESHOLD
from earshot.functions import trading
from earshot.operators import models, trailing
from earshot.sources.markets import with_sector


def score_quotes(quotes: DataFrame, threshold: float = EDGE_THRESHOLD, **limits: float) -> DataFrame:
    """Edges, stakes, momentum flag and the verdict; row by row, so batch and stream share it."""
    c = F.col
    edged = (
        quotes.withColumn("edge_yes", trading.edge_yes(c("final_prob"), c("yes_ask")))
        .withColumn("edge_no", trading.edge_no(c("final_prob"), c("no_ask")))
        .withColumn("kelly_yes", trading.kelly_yes_live(c("edge_yes"), c("yes_ask")))
        .withColumn("kelly_no", trading.kelly_no(c("edge_no"), c("no_ask")))
        .withColumn("momentum_flag", trading.momentum_flag(c("has_prior_session"), c("live_momentum")))
    )
    verdict = trading.recommend(
        c("tx_prob"), c("volume"), c("has_prior_session"), c("edge_yes"), c("edge_no"), c("momentum_flag"),
        c("final_prob"), c("live_open_mid"), c("kelly_yes"), c("kelly_no"), threshold=threshold, **limits,
    )
    return edged.withColumn("verdict", verdict).select(*edged.columns, "verdict.*")


def with_consensus(scored: DataFrame, threshold: float = EDGE_THRESHOLD) -> DataFrame:
    """Share of a company's markets above the threshold, per side.

    Aggregated first and joined back, so a company with most of the markets is not gathered in one task.
    """
    shares = scored.groupBy("stock_ticker").agg(
        F.avg((F.col("edge_yes") > threshold).cast("int")).alias("consensus_yes"),
        F.avg((F.col("edge_no") > threshold).cast("int")).alias("consensus_no"),
        F.count(F.lit(1)).alias("n_markets"),
    )
    return scored.join(shares, "stock_ticker", "left")


def rank_recommendations(scored: DataFrame, side: str) -> DataFrame:
    edge = "edge_yes" if side == "BUY_YES" else "edge_no"
    return scored.where(F.col("recommendation") == side).orderBy(F.col(edge).desc(), "market_ticker")


def live_features(quotes: DataFrame, docs: DataFrame, history: DataFrame, sectors: DataFrame) -> DataFrame:
    """quotes + word features; markets without any earlier call drop out.

    history holds past (sector, word, period_num, base_rate) rows for the peer rate.
    """
    target = F.col("target_year") * 4 + F.col("target_quarter")
    keyed = quotes.withColumn("ticker", F.col("stock_ticker")).withColumn("target_period", target)
    features = trailing.word_features(docs, keyed)
    rows = with_sector(keyed.join(features, ["ticker", "word", "target_period"]), sectors)
    return trailing.with_sector_peers(rows.withColumn("period_num", F.col("target_period")), history)


def recommend_live(quotes: DataFrame, docs: DataFrame, history: DataFrame, sectors: DataFrame, stage1, stage2) -> DataFrame:
    """The whole live path. Stage 2 always takes the live open mid as a real price."""
    rows = live_features(quotes, docs, history, sectors)
    rows = models.positive_probability(stage1, rows, "tx_prob").drop("features")
    rows = rows.withColumn("open_mid_filled", F.col("live_open_mid")).withColumn("has_candle", F.lit(1))
    rows = models.positive_probability(stage2, rows, "final_prob").drop("stage2_features")
    return with_consensus(score_quotes(rows))
