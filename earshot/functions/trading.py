"""Prices, edges, stakes and the recommendation rules as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from earshot.constants import EDGE_THRESHOLD, KELLY_FRACTION, MAX_KELLY, MIN_TRANSCRIPT_PROB, MIN_VOLUME


def clip(value: Column, low: float, high: float) -> Column:
    """Null stays null; greatest / least alone would skip it."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high))))


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / 2


def has_prior_session(prev_bid: Column, prev_ask: Column) -> Column:
    return ((prev_bid > 0) | (prev_ask > 0)).cast("int")


def open_mid(prev_bid: Column, prev_ask: Column, bid: Column, ask: Column) -> Column:
    return F.when(has_prior_session(prev_bid, prev_ask) == 1, mid(prev_bid, prev_ask)).otherwise(mid(bid, ask))


def momentum(prev_bid: Column, prev_ask: Column, bid: Column, ask: Column) -> Column:
    return F.when(
        has_prior_session(prev_bid, prev_ask) == 1, mid(bid, ask) - mid(prev_bid, prev_ask)
    ).otherwise(F.lit(0.0))


def edge_yes(prob: Column, price: Column) -> Column:
    return prob - price


def edge_no(prob: Column, no_price: Column) -> Column:
    return (1 - prob) - no_price


def kelly_yes(edge: Column, price: Column, fraction: float = KELLY_FRACTION, cap: float = MAX_KELLY) -> Column:
    """Backtests clip the complement, the live path clips the price; the two agree for prices in [0.01, 0.99]."""
    return clip(edge / clip(1 - price, 0.01, 0.99) * fraction, 0.0, cap)


def kelly_yes_live(edge: Column, ask: Column, fraction: float = KELLY_FRACTION, cap: float = MAX_KELLY) -> Column:
    return clip(edge / (1 - clip(ask, 0.01, 0.99)) * fraction, 0.0, cap)


def kelly_no(edge: Column, price: Column, fraction: float = KELLY_FRACTION, cap: float = MAX_KELLY) -> Column:
    """Price is the open mid in a backtest and the NO ask live."""
    return clip(edge / clip(price, 0.01, 0.99) * fraction, 0.0, cap)


def pnl_yes(stake: Column, price: Column, won: Column) -> Column:
    return F.when(won, stake * (1 - price)).otherwise(-stake * price)


def pnl_no(stake: Column, price: Column, won: Column) -> Column:
    return F.when(won, stake * price).otherwise(-stake * (1 - price))


def momentum_flag(prior: Column, move: Column) -> Column:
    return (
        F.when((prior != 1) | prior.isNull(), "NONE")
        .when(F.abs(move) > 0.20, "SPIKE")
        .when(move > 0.10, "TRENDING_YES")
        .when(move < -0.10, "TRENDING_NO")
        .otherwise("NONE")
    )


def agrees_yes(prob: Column, price: Column) -> Column:
    return (prob > 0.5) & (price > 0.5)


def agrees_no(prob: Column, price: Column) -> Column:
    return (prob < 0.5) & (price < 0.5)


def _verdict(action: str, reason: Column | str, stake: Column | float) -> Column:
    return F.struct(
        F.lit(action).alias("recommendation"),
        (F.lit(reason) if isinstance(reason, str) else reason).alias("confidence"),
        (F.lit(stake) if isinstance(stake, float) else stake).cast("double").alias("kelly"),
    )


def _confidence(edge: Column) -> Column:
    return F.when(edge > 0.15, "HIGH").when(edge > 0.10, "MEDIUM").otherwise("LOW")


def recommend(tx_prob: Column, volume: Column, prior: Column, yes_edge: Column, no_edge: Column,
              flag: Column, prob: Column, price: Column, yes_stake: Column, no_stake: Column,
              threshold: float = EDGE_THRESHOLD, min_prob: float = MIN_TRANSCRIPT_PROB,
              min_volume: float = MIN_VOLUME) -> Column:
    """One struct (recommendation, confidence, kelly) per row; the first rule that applies wins."""
    buy_yes = (yes_edge >= no_edge) & (yes_edge > threshold)
    buy_no = no_edge > threshold
    return (
        F.when(tx_prob < min_prob, _verdict("PASS", "NO_HISTORY", 0.0))
        .when((volume < min_volume) & (prior == 0), _verdict("PASS", "ILLIQUID", 0.0))
        .when(buy_yes & ((prob <= 0.5) | (price <= 0.5)), _verdict("PASS", "DISAGREE_WITH_CROWD", 0.0))
        .when(buy_yes & (flag == "TRENDING_NO"), _verdict("PASS", "MOMENTUM_CONFLICT", 0.0))
        .when(buy_yes, _verdict("BUY_YES", _confidence(yes_edge), yes_stake))
        .when(buy_no & ((prob >= 0.5) | (price >= 0.5)), _verdict("PASS", "DISAGREE_WITH_CROWD", 0.0))
        .when(buy_no & (flag == "TRENDING_YES"), _verdict("PASS", "MOMENTUM_CONFLICT", 0.0))
        .when(buy_no, _verdict("BUY_NO", _confidence(no_edge), no_stake))
        .otherwise(_verdict("PASS", "LOW_EDGE", 0.0))
    )


def predicted(prob: Column) -> Column:
    return (prob >= 0.5).cast("int")


def prediction_confidence(prob: Column) -> Column:
    return F.when(prob >= 0.5, prob).otherwise(1 - prob)


def display_round(value: Column, digits: int = 3) -> Column:
    return F.bround(value.try_cast("double"), digits)
