"""Baseline classifiers as column expressions over the label table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.market import in_uncertain_band
from earshot.operators import metrics, sweeps


def majority_class(train: DataFrame, y: str = "mentioned") -> DataFrame:
    """Most frequent label; the smaller label wins a tie."""
    return (
        train.groupBy(F.col(y).alias("majority_class")).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "majority_class").limit(1)
    )


def consensus(prob: Column) -> Column:
    return F.coalesce(prob > 0.5, F.lit(False)).cast("int")


def history_frequency(rate: Column, threshold: Column) -> Column:
    return (F.coalesce(rate, F.lit(0.0)) > threshold).cast("int")


def baseline_predictions(train: DataFrame, dev: DataFrame, rows: DataFrame) -> DataFrame:
    """rows once per baseline: model, pred. The history threshold is tuned on all of dev."""
    majority = majority_class(train).select("majority_class").scalar()
    threshold = sweeps.best_history_threshold(dev).select("threshold").scalar()
    options = F.array(*[
        F.struct(F.lit(name).alias("model"), pred.cast("int").alias("pred"))
        for name, pred in (
            ("majority", majority),
            ("consensus", consensus(F.col("implied_prob"))),
            ("buy_all_yes", F.lit(1)),
            ("hist_freq", history_frequency(F.col("hist_rate"), threshold)),
        )
    ])
    return rows.withColumn("option", F.explode(options)).select(*rows.columns, "option.model", "option.pred")


def evaluate(predictions: DataFrame, uncertain_only: bool = False, by: tuple[str, ...] = ("model",)) -> DataFrame:
    """Classification metrics and returns per model; tuning is never restricted, only evaluation."""
    rows = predictions.where(in_uncertain_band(F.col("implied_prob"))) if uncertain_only else predictions
    return metrics.classification_metrics(rows, by=by).join(metrics.roi_backtest(rows, by=by), list(by))


def run_baselines(labels: DataFrame, uncertain_only: bool = False) -> DataFrame:
    """labels carry a split column; metrics for dev and test per baseline."""
    def part(name: str) -> DataFrame:
        return labels.where(F.col("split") == name)

    rows = labels.where(F.col("split").isin("dev", "test"))
    return evaluate(baseline_predictions(part("train"), part("dev"), rows), uncertain_only, ("model", "split"))
