"""Exact positions, keep-first and keep-last without sorting a whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_position(df: DataFrame, order: list[str], bucket: Column, keys: tuple[str, ...] = ()) -> DataFrame:
    """df + position (0-based) and total, counted within keys in the given order.

    bucket must never decrease along the order. Bucket sizes are counted first; rows are then only
    sorted inside their own bucket.
    """
    rows = df.withColumn("_bucket", bucket)
    group = [F.col(k) for k in keys] or [F.lit(1)]
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("total", F.sum("_n").over(Window.partitionBy(*group))).drop("_n")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (
        rows.join(offsets, [*keys, "_bucket"])
        .withColumn("position", F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_bucket", "_before")
    )


def seeded_hash(seed: int, *cols: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def shuffled_position(df: DataFrame, seed: int, key: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Position of each row in a seeded random order; hash prefixes make even buckets."""
    hashed = df.withColumn("_hash", seeded_hash(seed, key))
    return ordered_position(hashed, ["_hash", key], F.substring("_hash", 1, 3), keys).drop("_hash")


def _extreme(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return packed.select(*keys, "_row.*").select(*df.columns)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key; an aggregate with map-side combine, so hot keys do not pile up."""
    return _extreme(df, keys, order, F.max_by)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _extreme(df, keys, order, F.min_by)


def top_n(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)


def smoke_subset(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """n seeded rows for a smoke run."""
    return df.orderBy(seeded_hash(seed, key), key).limit(n)
