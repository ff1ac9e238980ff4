"""Equal-width calibration bins and histograms over observed ranges."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _range(df: DataFrame, value: str, pad_low: Column, pad_high: Column) -> tuple[Column, Column]:
    """Scalar subqueries for the range, padded when all values are equal."""
    stats = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    same = F.col("lo") == F.col("hi")
    low = stats.select(F.when(same, F.col("lo") - pad_low).otherwise(F.col("lo"))).scalar()
    high = stats.select(F.when(same, F.col("hi") + pad_high).otherwise(F.col("hi"))).scalar()
    return low, high


def calibration_table(df: DataFrame, prob: str = "implied_prob", y: str = "label", bins: int = 10) -> DataFrame:
    """Right-closed equal-width bins over [min, max]; empty bins are absent."""
    priced = df.where(F.col(prob).isNotNull()).select(F.col(prob).alias("p"), F.col(y).alias("y"))
    pad = F.when(F.col("lo") != 0, F.abs(F.col("lo")) * 0.001).otherwise(0.001)
    low, high = _range(priced, "p", pad, pad)
    ranged = priced.withColumn("lo", low).withColumn("step", (high - F.col("lo")) / bins)
    index = reduce(add, [(F.col("p") > F.col("lo") + F.lit(float(i)) * F.col("step")).cast("int") for i in range(1, bins)])
    return (
        ranged.withColumn("prob_bin", index).groupBy("prob_bin")
        .agg(F.avg("p").alias("mean_prob"), F.avg("y").alias("actual_rate"), F.count("y").alias("n"))
    )


def histogram(df: DataFrame, value: str = "implied_prob", bins: int = 30) -> DataFrame:
    """Left-closed equal-width bins, the last one closed; empty bins count zero."""
    present = df.where(F.col(value).isNotNull()).select(F.col(value).alias("v"))
    low, high = _range(present, "v", F.lit(0.5), F.lit(0.5))
    ranged = present.withColumn("lo", low).withColumn("step", (high - F.col("lo")) / bins)
    index = reduce(add, [(F.col("v") >= F.col("lo") + F.lit(float(i)) * F.col("step")).cast("int") for i in range(1, bins)])
    counts = ranged.withColumn("bin", index).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(F.broadcast(counts), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))
