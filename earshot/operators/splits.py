"""Splits that keep a company on one side, temporal splits and stratified folds."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.constants import SPLIT_SEED, TEST_PERIODS, TRAIN_BEFORE_YEAR, VAL_PERIODS
from earshot.operators.ranking import shuffled_position
from earshot.session import broadcast_if_small, fits_broadcast


def _cut(position, total, train_frac: float, dev_frac: float):
    n_train = F.floor(total * F.lit(train_frac))
    return (
        F.when(position < n_train, "train")
        .when(position < n_train + F.floor(total * F.lit(dev_frac)), "dev").otherwise("test")
    )


def company_splits(companies: DataFrame, train_frac: float = 0.70, dev_frac: float = 0.15,
                   seed: int = SPLIT_SEED) -> DataFrame:
    """(ticker, split): floor sizes for train and dev, the remainder is test. Ordered by seeded hash."""
    tickers = companies.select("ticker").where(F.col("ticker").isNotNull()).distinct()
    placed = shuffled_position(tickers, seed, "ticker")
    return placed.select("ticker", _cut(F.col("position"), F.col("total"), train_frac, dev_frac).alias("split"))


def seeded_company_splits(companies: DataFrame, train_frac: float = 0.70, dev_frac: float = 0.15,
                          seed: int = SPLIT_SEED) -> DataFrame:
    """The same split by a Mersenne-Twister shuffle of the sorted tickers, for a company list of proven size."""
    tickers = companies.select("ticker").where(F.col("ticker").isNotNull()).distinct()
    if not fits_broadcast(tickers, ("ticker",)):
        raise ValueError("too many companies for a driver-side shuffle; use company_splits")
    names = sorted(row.ticker for row in tickers.collect())
    random.Random(seed).shuffle(names)
    n_train = int(len(names) * train_frac)
    n_dev = int(len(names) * dev_frac)
    rows = [(t, "train" if i < n_train else "dev" if i < n_train + n_dev else "test") for i, t in enumerate(names)]
    return companies.sparkSession.createDataFrame(rows, "ticker STRING, split STRING")


def cross_company_split(rows: DataFrame, splits: DataFrame | None = None, **options) -> DataFrame:
    """rows + split."""
    splits = company_splits(rows, **options) if splits is None else splits
    return rows.join(broadcast_if_small(splits, ("ticker",)), "ticker")


def split_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("ticker").alias("n_companies")
    )


def leaking_companies(rows: DataFrame) -> DataFrame:
    """Companies seen in more than one split; empty when the split is sound."""
    return rows.groupBy("ticker").agg(F.countDistinct("split").alias("n_splits")).where("n_splits > 1")


def stratified_folds(rows: DataFrame, label: str, key: str, n_folds: int = 5, seed: int = SPLIT_SEED) -> DataFrame:
    """rows + fold in [0, n_folds), balanced within each label."""
    placed = shuffled_position(rows, seed, key, (label,))
    return placed.withColumn("fold", (F.col("position") % n_folds).cast("int")).drop("position", "total")


def temporal_split(rows: DataFrame, train_before: int = TRAIN_BEFORE_YEAR, val_periods=VAL_PERIODS,
                   test_periods=TEST_PERIODS) -> DataFrame:
    """rows + split by year and period; rows in none of them get null."""
    return rows.withColumn(
        "split",
        F.when(F.col("year") < train_before, "train")
        .when(F.col("period_num").isin(*val_periods), "val")
        .when(F.col("period_num").isin(*test_periods), "test"),
    )
