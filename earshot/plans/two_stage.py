"""Word-history features, boosted trees on text history, calibration against the price, and the backtest."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.constants import TRAIN_BEFORE_YEAR, TRANSCRIPT_FEATURES
from earshot.operators import metrics, models, splits, sweeps, trailing
from earshot.operators.mentions import mention_hits, variant_count
from earshot.session import materialize
from earshot.sources.markets import with_sector


def word_history(docs: DataFrame, vocab: DataFrame, sectors: DataFrame | None = None) -> DataFrame:
    """One row per (ticker, word, period) with earlier calls: trailing features and whether the word was said."""
    words = vocab.select("ticker", "word").distinct()
    calls = docs.select("ticker", "period_num").where(F.col("period_num").isNotNull()).distinct()
    targets = calls.join(words, "ticker").withColumnRenamed("period_num", "target_period")
    hits = materialize(mention_hits(docs, words, variant_count, keep=("period_num",)), "word-hits")
    said = (
        hits.select("ticker", "word", F.col("period_num").alias("target_period"), F.lit(1).alias("word_said")).distinct()
    )
    rows = (
        trailing.word_features(docs, targets, hits=hits).join(said, ["ticker", "word", "target_period"], "left")
        .withColumn("word_said", F.coalesce("word_said", F.lit(0))).withColumnRenamed("target_period", "period_num")
        .withColumn("year", F.expr("(period_num - 1) div 4").cast("int"))
    )
    rows = rows.withColumn("stock_ticker", F.col("ticker"))
    rows = with_sector(rows, sectors) if sectors is not None else rows.withColumn("sector", F.lit("Unknown"))
    return trailing.with_sector_peers(rows.drop("stock_ticker"))


def stage1_rows(history: DataFrame, train_before: int = TRAIN_BEFORE_YEAR) -> DataFrame:
    """The rows that stage 1 may learn from: years, taken from the period, before the first held-out one."""
    return history.where(F.col("year") < train_before)


def fit_stage1(train: DataFrame, max_iter: int = 500):
    """Boosted trees on the training rows, newer ones weighing more, missing features at their train median."""
    cols = list(TRANSCRIPT_FEATURES)
    filled = models.impute_median(train, models.recency_weight(train), cols)
    return models.train_boosting(filled, cols, max_iter=max_iter)


def score_markets(history: DataFrame, markets: DataFrame, daily: DataFrame, stage1, train: DataFrame) -> DataFrame:
    """Markets with features, candle price and the stage 1 probability; missing features at the medians of train.

    markets: (market_ticker, ticker, word, period_num, market_result). daily has one row per market.
    """
    rows = markets.join(history.drop("word_said"), ["ticker", "word", "period_num"])
    rows = rows.join(daily.select("market_ticker", "daily_open_mid", "daily_std", "daily_total_vol"), "market_ticker", "left")
    rows = rows.withColumn("market_yes", F.coalesce(F.col("market_result") == "yes", F.lit(False)).cast("int"))
    rows = models.impute_median(train, rows, list(TRANSCRIPT_FEATURES))
    return models.with_candle(models.positive_probability(stage1, rows, "tx_prob").drop("features"))


def save_stage(model: PipelineModel, train: DataFrame, path: str) -> None:
    """The fitted model and the medians of its training rows, for a scoring job of its own."""
    model.write().overwrite().save(f"{path}/model")
    models.medians(train, list(TRANSCRIPT_FEATURES)).write.mode("overwrite").parquet(f"{path}/medians")


def load_stage(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    """(model, medians); the one row of medians stands for the training rows when features are filled."""
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/medians")


def calibrate(scored: DataFrame, **options):
    """(validation and test rows with final_prob, stage 2 model, chosen C); fitted on validation periods."""
    rows = materialize(splits.temporal_split(scored, train_before=0), "stage1-scored")
    stage2, c = models.train_platt(rows.where("split = 'val'"), **options)
    final = models.positive_probability(stage2, rows.where("split IN ('val', 'test')"), "final_prob")
    return final.drop("stage2_features"), stage2, c


def evaluate(final: DataFrame, threshold: float) -> DataFrame:
    """Test Brier and skill of both stages, AUC, and the betting summary per side."""
    test = final.where("split = 'test'")
    stages = metrics.brier_skill(test, "tx_prob", "market_yes").withColumn("stage", F.lit("text")).unionByName(
        metrics.brier_skill(test, "final_prob", "market_yes").withColumn("stage", F.lit("two_stage")))
    auc = metrics.roc_auc(test, "final_prob", "market_yes").select("auc").scalar()
    bets = sweeps.backtest_summary(test, threshold)
    total = bets.agg(F.sum("n").alias("n_bets"), F.coalesce(F.sum("total_pnl"), F.lit(0.0)).alias("total_pnl"))
    return stages.withColumns({
        "auc": F.when(F.col("stage") == "two_stage", auc), "n_bets": total.select("n_bets").scalar(),
        "total_pnl": total.select("total_pnl").scalar(), "threshold": F.lit(threshold),
    })
