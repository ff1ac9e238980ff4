"""Threshold sweeps: rows collapse to how many grid points they exceed, the grid is expanded after that."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.constants import EDGE_THRESHOLD, EDGE_THRESHOLDS, MIN_PRICED_ROWS
from earshot.functions import trading
from earshot.operators.metrics import metrics_from_counts

HISTORY_GRID = tuple(round(i * 0.05, 2) for i in range(20))


def _exceeded(value: Column, grid: tuple[float, ...]) -> Column:
    """Number of ascending grid points strictly below the value."""
    return reduce(add, [F.coalesce(value > t, F.lit(False)).cast("int") for t in grid])


def _grid(df: DataFrame, grid: tuple[float, ...]) -> DataFrame:
    """(level, threshold): a row counts at a threshold when it exceeds at least `level` grid points."""
    rows = [(i + 1, t) for i, t in enumerate(grid)]
    return df.sparkSession.createDataFrame(rows, "level INT, threshold DOUBLE")


def history_threshold_sweep(df: DataFrame, rate: str = "hist_rate", y: str = "mentioned",
                            grid: tuple[float, ...] = HISTORY_GRID) -> DataFrame:
    """Metrics per threshold for 'mentioned if rate > threshold', a missing rate counting as 0."""
    collapsed = (
        df.select(_exceeded(F.coalesce(F.col(rate), F.lit(0.0)), grid).alias("k"), F.col(y).alias("y"))
        .groupBy("k").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    )
    levels = F.broadcast(_grid(df, grid))
    expanded = collapsed.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(len(grid)))))
    yes = F.col("k") >= F.col("level")
    counts = expanded.groupBy("level").agg(
        F.sum(F.when(~yes, F.col("neg")).otherwise(0)).alias("tn"), F.sum(F.when(yes, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~yes, F.col("pos")).otherwise(0)).alias("fn"), F.sum(F.when(yes, F.col("pos")).otherwise(0)).alias("tp"),
    )
    return metrics_from_counts(counts.join(levels, "level")).drop("level")


def best_history_threshold(df: DataFrame, rate: str = "hist_rate", y: str = "mentioned") -> DataFrame:
    """Threshold with the best macro F1; the lowest wins a tie."""
    return (
        history_threshold_sweep(df, rate, y).orderBy(F.col("f1_macro").desc(), "threshold").limit(1)
        .select("threshold", "f1_macro")
    )


def signals(df: DataFrame, prob: str = "final_prob", price: str = "daily_open_mid", y: str = "market_yes") -> DataFrame:
    """Bet candidates on priced rows where model and crowd point the same way: side, edge, stake, pnl, won."""
    p, m = F.col(price), F.col(prob)
    edge = F.when(trading.agrees_yes(m, p), m - p).when(trading.agrees_no(m, p), (1 - m) - (1 - p))
    priced = (
        df.where(p.isNotNull())
        .withColumn("side", F.when(trading.agrees_yes(m, p), "YES").when(trading.agrees_no(m, p), "NO"))
        .withColumn("edge", edge).where(F.col("side").isNotNull())
    )
    yes = F.col("side") == "YES"
    won = F.when(yes, F.col(y) == 1).otherwise(F.col(y) == 0)
    stake = F.when(yes, trading.kelly_yes(F.col("edge"), p)).otherwise(trading.kelly_no(F.col("edge"), p))
    return (
        priced.withColumn("won", won).withColumn("stake", stake)
        .withColumn("pnl", F.when(yes, trading.pnl_yes(F.col("stake"), p, F.col("won")))
                    .otherwise(trading.pnl_no(F.col("stake"), p, F.col("won"))))
    )


def edge_threshold_sweep(df: DataFrame, grid: tuple[float, ...] = EDGE_THRESHOLDS, **cols: str) -> DataFrame:
    """Bets, win rate and profit per side and threshold."""
    collapsed = (
        signals(df, **cols).withColumn("k", _exceeded(F.col("edge"), grid)).where("k > 0").groupBy("k")
        .agg(*[
            agg.alias(f"{name}_{side}")
            for side, tag in (("yes", "YES"), ("no", "NO"))
            for name, agg in (
                ("n", F.count_if(F.col("side") == tag)),
                ("w", F.count_if((F.col("side") == tag) & F.col("won"))),
                ("pnl", F.coalesce(F.sum(F.when(F.col("side") == tag, F.col("pnl"))), F.lit(0.0))),
            )
        ])
    )
    expanded = collapsed.withColumn("level", F.explode(F.sequence(F.lit(1), F.col("k"))))
    measures = [c for c in collapsed.columns if c != "k"]
    summed = expanded.groupBy("level").agg(*[F.sum(c).alias(c) for c in measures])
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in measures}
    return (
        _grid(df, grid).join(summed, "level", "left").withColumns(zero)
        .select(
            "threshold", "n_yes", "n_no", F.try_divide("w_yes", "n_yes").alias("win_yes"),
            F.try_divide("w_no", "n_no").alias("win_no"), "pnl_yes", "pnl_no",
            (F.col("pnl_yes") + F.col("pnl_no")).alias("total_pnl"),
        )
    )


def best_edge_threshold(df: DataFrame, min_rows: int = MIN_PRICED_ROWS, default: float = EDGE_THRESHOLD,
                        price: str = "daily_open_mid", **cols: str) -> DataFrame:
    """Most profitable threshold on the given rows; the default when too few are priced."""
    n_priced = df.agg(F.count(price)).scalar()
    return (
        edge_threshold_sweep(df, price=price, **cols).orderBy(F.col("total_pnl").desc(), "threshold").limit(1)
        .select(F.when(n_priced < min_rows, F.lit(default)).otherwise(F.col("threshold")).alias("threshold"))
    )


def backtest_summary(df: DataFrame, threshold: float = EDGE_THRESHOLD, **cols: str) -> DataFrame:
    """Per side, both sides always present."""
    bets = signals(df, **cols).where(F.col("edge") > threshold)
    summary = bets.groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("won").cast("double")).alias("win_rate"),
        F.avg("edge").alias("mean_edge"), F.avg("stake").alias("mean_kelly"),
        F.sum("pnl").alias("total_pnl"), F.avg("pnl").alias("mean_pnl"),
    )
    sides = df.sparkSession.createDataFrame([("YES",), ("NO",)], "side STRING")
    return sides.join(F.broadcast(summary), "side", "left").withColumn("n", F.coalesce("n", F.lit(0)))
