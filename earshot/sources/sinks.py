"""Writers. Every one leaves a directory that Spark reads back in parallel."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.operators.metrics import latest_results
from earshot.schemas import EXPERIMENT, FLAT_MARKET
from earshot.sources.tables import read_csv


def format_flat_markets(flat: DataFrame) -> DataFrame:
    """Prices with four decimals, sizes with two, a missing price as blank."""
    def fixed(name: str, digits: int):
        return F.format_string(f"%.{digits}f", F.col(name))

    return flat.withColumns({
        "implied_prob": F.when(F.col("implied_prob").isNotNull(), fixed("implied_prob", 4)),
        "yes_bid": fixed("yes_bid", 4), "no_bid": fixed("no_bid", 4),
        "volume": fixed("volume", 2), "open_interest": fixed("open_interest", 2),
    })


def write_flat_markets(flat: DataFrame, path: str, fmt: str = "csv") -> None:
    ordered = flat.orderBy("series_ticker", "event_ticker", "market_ticker")
    if fmt == "csv":
        format_flat_markets(ordered).write.csv(path, header=True, quote='"', escape='"', emptyValue="")
    else:
        ordered.write.format(fmt).save(path)


def read_flat_markets(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, FLAT_MARKET)


def write_splits(labels: DataFrame, path: str) -> None:
    labels.write.partitionBy("split").parquet(path)


def write_transcripts(cleaned: DataFrame, path: str) -> None:
    """Kept transcripts only, one folder per ticker; the call date is a column, so there is no sidecar.

    Rows are rebalanced by ticker, which keeps the number of files low and splits a hot ticker over several tasks.
    """
    cleaned.where("skip_reason IS NULL").drop("skip_reason").hint("rebalance", "ticker").write.partitionBy("ticker").parquet(path)


def experiment_records(metrics: DataFrame, config: list[str], stamp: Column, notes: str = "") -> DataFrame:
    """One log record per metrics row: the config columns, every known metric present, missing ones null."""
    spec = metrics.sparkSession.createDataFrame([], EXPERIMENT).schema

    def pack(name: str, allowed: list[str] | None) -> Column:
        fields = spec[name].dataType.fields
        matrix = F.array(F.array("tn", "fp"), F.array("fn", "tp")) if "tn" in metrics.columns else F.lit(None)
        have = {c: F.col(c) for c in metrics.columns} | {"confusion_matrix": matrix}
        return F.struct(*[
            (have[f.name] if f.name in have and (allowed is None or f.name in allowed) else F.lit(None))
            .cast(f.dataType).alias(f.name) for f in fields
        ]).alias(name)

    return metrics.select(stamp.cast("string").alias("timestamp"), pack("config", config), pack("metrics", None), F.lit(notes).alias("notes"))


def append_experiments(records: DataFrame, path: str) -> None:
    records.write.mode("append").json(path)


def append_experiment(spark: SparkSession, path: str, config: dict, metrics: dict, notes: str = "",
                      timestamp: str | None = None) -> None:
    """One record from plain dictionaries; unset fields are left out of the JSON."""
    stamp = timestamp or datetime.now(timezone.utc).isoformat()
    append_experiments(spark.createDataFrame([(stamp, config, metrics, notes)], EXPERIMENT).coalesce(1), path)


def write_results_table(log: DataFrame, path: str) -> None:
    """Latest record per (model, split), best F1 first inside each split folder."""
    results_table(log).write.partitionBy("split").parquet(path)


def results_table(log: DataFrame) -> DataFrame:
    flat = log.select(
        "timestamp", F.coalesce("config.model", F.lit("?")).alias("model"),
        F.coalesce("config.split", F.lit("?")).alias("split"),
        *[F.col(f"metrics.{c}") for c in (
            "n", "accuracy", "f1_macro", "f1_pos", "precision_pos", "recall_pos", "roi_per_trade", "total_pnl")],
    )
    return latest_results(flat).drop("timestamp").orderBy("split", F.col("f1_macro").desc())


def write_predictions(scored: DataFrame, path: str, fmt: str = "parquet") -> None:
    scored.write.format(fmt).option("header", True).save(path)


def write_probabilities(scored: DataFrame, path: str) -> None:
    """(market_ticker, prob_pos): keyed, so readers never rely on row order."""
    scored.select("market_ticker", "prob_pos").write.parquet(path)
