"""Classification, probability and return metrics as plain aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.constants import FLAT_FEE
from earshot.operators.ranking import keep_last


def _ratio(top: Column, bottom: Column) -> Column:
    """Zero where the bottom is zero."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def confusion_counts(df: DataFrame, y: str = "mentioned", yhat: str = "pred", by: tuple[str, ...] = ()) -> DataFrame:
    t, p = F.col(y), F.col(yhat)
    return df.groupBy(*by).agg(
        F.count_if((t == 0) & (p == 0)).alias("tn"), F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"), F.count_if((t == 1) & (p == 1)).alias("tp"),
    )


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    """Adds n, accuracy, F1s and per-class precision / recall; all null when n = 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    f1_pos = _ratio(2 * tp, 2 * tp + fp + fn)
    f1_neg = _ratio(2 * tn, 2 * tn + fp + fn)
    values = {
        "accuracy": _ratio(tn + tp, n),
        "f1_macro": (f1_pos + f1_neg) / 2,
        "f1_weighted": _ratio(f1_pos * (tp + fn) + f1_neg * (tn + fp), n),
        "precision_pos": _ratio(tp, tp + fp), "recall_pos": _ratio(tp, tp + fn), "f1_pos": f1_pos,
        "precision_neg": _ratio(tn, tn + fn), "recall_neg": _ratio(tn, tn + fp), "f1_neg": f1_neg,
    }
    return counts.withColumn("n", n).withColumns({k: F.when(n > 0, v) for k, v in values.items()})


def classification_metrics(df: DataFrame, y: str = "mentioned", yhat: str = "pred",
                           by: tuple[str, ...] = ()) -> DataFrame:
    return metrics_from_counts(confusion_counts(df, y, yhat, by))


def roi_backtest(df: DataFrame, yhat: str = "pred", y: str = "mentioned", prob: str = "implied_prob",
                 fee: float = FLAT_FEE, by: tuple[str, ...] = ()) -> DataFrame:
    """One contract per row on the predicted side; the fee is a constant per trade, not a share of the stake."""
    priced = F.col(prob).isNotNull()
    won = F.col(yhat) == F.col(y)
    stake = F.when(priced, F.when(F.col(yhat) == 1, F.col(prob)).otherwise(1.0 - F.col(prob)))
    n = F.count_if(priced)
    total = F.coalesce(F.sum(won.cast("double") - stake - fee), F.lit(0.0))
    correct = F.count_if(priced & won)
    return df.groupBy(*by).agg(
        n.alias("n_trades"), correct.alias("n_correct"), F.try_divide(correct, n).alias("accuracy_trades"),
        total.alias("total_pnl"), F.try_divide(total, n).alias("roi_per_trade"), F.avg(stake).alias("avg_stake"),
        F.count_if(~priced).alias("n_skipped_nan_prob"),
    )


def brier(df: DataFrame, prob: str, y: str, random_score: float = 0.25) -> DataFrame:
    priced = df.where(F.col(prob).isNotNull())
    score = F.avg(F.pow(F.col(prob) - F.col(y), F.lit(2)))
    return priced.agg(
        F.count(F.lit(1)).alias("n"), score.alias("brier"), ((random_score - score) / random_score).alias("improvement")
    )


def brier_skill(df: DataFrame, prob: str, y: str) -> DataFrame:
    """Against always answering the base rate r, whose score is r * (1 - r)."""
    rate = F.avg(F.col(y).cast("double"))
    score = F.avg(F.pow(F.col(prob) - F.col(y), F.lit(2)))
    base = rate * (1 - rate)
    return df.where(F.col(prob).isNotNull()).agg(
        score.alias("brier"), base.alias("baseline_brier"), (1 - F.try_divide(score, base)).alias("skill"),
        F.avg(prob).alias("mean_prob"), rate.alias("actual_rate"),
    )


def roc_auc(df: DataFrame, score: str, y: str) -> DataFrame:
    """Rank-based AUC of a score in [0, 1], ties averaged.

    Rows collapse to distinct scores, and the running count of negatives is built from two levels of
    equal-width buckets, so no task orders more than one fine bucket of distinct scores.
    """
    width = 4096
    s = F.col("score")
    per_score = (
        df.where(F.col(score).isNotNull() & F.col(y).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.sum((F.col(y) == 1).cast("long")).alias("pos"), F.sum((F.col(y) == 0).cast("long")).alias("neg"))
        .withColumn("coarse", F.least(F.floor(s * width), F.lit(width - 1)))
        .withColumn("fine", F.floor(s * width * width))
    )

    def before(group: list[Column | str], order: str) -> Column:
        w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("neg").over(w), F.lit(0))

    fine = per_score.groupBy("coarse", "fine").agg(F.sum("neg").alias("neg"))
    coarse = fine.groupBy("coarse").agg(F.sum("neg").alias("neg"))
    coarse = coarse.select("coarse", before([F.lit(1)], "coarse").alias("before_coarse"))
    fine = fine.select("coarse", "fine", before(["coarse"], "fine").alias("before_fine"))
    ranked = (
        per_score.withColumn("before_score", before(["coarse", "fine"], "score"))
        .join(fine, ["coarse", "fine"]).join(F.broadcast(coarse), "coarse")
    )
    below = F.col("before_coarse") + F.col("before_fine") + F.col("before_score")
    pairs = F.sum(F.col("pos") * (below + F.col("neg") / 2))
    return ranked.agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
        F.try_divide(pairs, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"),
    )


def seen_summary(df: DataFrame) -> DataFrame:
    """Seen / unseen summary, error rate by label and recall on positives from one grouping-sets pass."""
    correct = (F.col("pred") == F.col("mentioned")).cast("int")
    return (
        df.withColumn("correct", correct).withColumn("label_value", F.col("mentioned"))
        .groupingSets([["word_seen_before"], ["word_seen_before", "mentioned"]], "word_seen_before", "mentioned")
        .agg(
            F.grouping("mentioned").cast("int").alias("all_labels"), F.count(F.lit(1)).alias("n"),
            F.avg("label_value").alias("base_rate_mentioned"), F.avg("prob_pos").alias("mean_prob_pos"),
            F.avg("correct").alias("accuracy"), (1 - F.avg("correct")).alias("err_rate"), F.avg("pred").alias("mean_pred"),
        )
    )


def ticker_errors(df: DataFrame) -> DataFrame:
    correct = (F.col("pred") == F.col("mentioned")).cast("int")
    return df.where(F.col("ticker").isNotNull()).groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"), F.avg(correct).alias("accuracy"), F.sum(1 - correct).alias("n_errors"),
        F.avg("prob_pos").alias("mean_prob_pos"), F.avg("mentioned").alias("base_rate_mentioned"),
    ).orderBy(F.col("n_errors").desc(), "ticker")


def worst_errors(df: DataFrame, n: int = 20) -> DataFrame:
    """The most confident wrong predictions."""
    confidence = F.when(F.col("pred") == 1, F.col("prob_pos")).otherwise(1 - F.col("prob_pos"))
    return (
        df.where(F.col("pred") != F.col("mentioned")).withColumn("confidence", confidence)
        .orderBy(F.col("confidence").desc(), "market_ticker").limit(n)
    )


def compare_models(left: DataFrame, right: DataFrame, key: str = "market_ticker") -> DataFrame:
    """Agreement of two prediction tables (key, pred) and who is right, by label."""
    joined = left.select(key, "mentioned", "implied_prob", F.col("pred").alias("left_pred")).join(
        right.select(key, F.col("pred").alias("right_pred")), key
    )
    left_ok = F.col("left_pred") == F.col("mentioned")
    right_ok = F.col("right_pred") == F.col("mentioned")
    return joined.groupBy("mentioned").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(left_ok & right_ok).alias("both_right"),
        F.count_if(left_ok & ~right_ok).alias("only_left_right"), F.count_if(~left_ok & right_ok).alias("only_right_right"),
        F.count_if(~left_ok & ~right_ok).alias("both_wrong"),
        F.count_if((F.col("left_pred") == 1) == (F.col("implied_prob") > 0.5)).alias("left_agrees_with_market"),
    )


def latest_results(log: DataFrame, order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """Last record per (model, split)."""
    return keep_last(log, ["model", "split"], list(order))


def comparison_table(log: DataFrame, metric: str, splits: list[str], order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """One row per model, one column per split."""
    return latest_results(log, order).groupBy("model").pivot("split", splits).agg(F.first(metric))
