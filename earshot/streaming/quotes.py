"""Quote streams: duplicate suppression, daily candles and scored recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from earshot.plans.recommender import score_quotes
from earshot.session import scratch_path
from earshot.sources.markets import with_live_mids


def file_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet",
                files_per_trigger: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    )


def run_in_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything available; each batch overwrites a folder of its own, batch_id=N.

    A batch that was written but not yet committed to the checkpoint comes again under its id after a restart and
    takes the place of its first writing, so no row is there twice and none is lost. Any output mode goes.
    """
    spark = stream.sparkSession
    # So that a stream without input leaves a table too.
    _write_batch(spark.createDataFrame([], stream.schema), -1, path)
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(lambda batch, batch_id: _write_batch(batch, batch_id, path))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: StructType, keys: tuple[str, ...] = ()) -> DataFrame:
    """What run_in_batches has written. With keys, of rows with equal keys the one of the newest batch (update mode)."""
    # A new object: StructType.add works in place.
    rows = spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())])).parquet(path)
    if not keys:
        return rows.drop("batch_id")
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*schema.names), "batch_id").alias("row"))
    return newest.select("row.*")


def drain(stream: DataFrame, name: str, mode: str = "append", keys: tuple[str, ...] = ()) -> DataFrame:
    """Run the stream over what is available and read its result back."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    run_in_batches(stream, path, scratch_path(spark, f"{name}-checkpoint"), mode)
    return read_batches(spark, path, stream.schema, keys)


def drop_repeats(quotes: DataFrame, keys: tuple[str, ...] = ("market_ticker", "ts"), delay: str = "1 hour",
                 time: str = "ts") -> DataFrame:
    """One quote per key; state is kept only as long as the watermark allows repeats."""
    return quotes.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


CANDLE_KEYS = ("market_ticker", "day_start")


def daily_candles(quotes: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Open, close, range and volume per market and event-time day; later rows than the watermark are dropped.

    In append mode a day comes out once the watermark has passed it, so the last day of ended input never does. In
    update mode each batch gives the days it changed: read by CANDLE_KEYS, every day is there, open ones as they stand.
    """
    order = F.struct("ts", "event_id")
    return (
        quotes.withWatermark("ts", delay).groupBy("market_ticker", F.window("ts", "1 day").alias("w"))
        .agg(
            F.min_by("mid", order).alias("open_mid"), F.max_by("mid", order).alias("close_mid"),
            F.min("mid").alias("low_mid"), F.max("mid").alias("high_mid"), F.sum("volume").alias("volume"),
            F.count(F.lit(1)).alias("n_quotes"),
        )
        .select("market_ticker", F.col("w.start").alias("day_start"), F.col("w.end").alias("day_end"), "open_mid",
                "close_mid", "low_mid", "high_mid", "volume", "n_quotes")
    )


def scored_stream(quotes: DataFrame, probabilities: DataFrame) -> DataFrame:
    """Quotes joined with the static (market_ticker, word, tx_prob) table, then the batch rules."""
    live = with_live_mids(quotes).join(probabilities, ["market_ticker", "word"])
    return score_quotes(live.withColumn("final_prob", (F.col("tx_prob") + F.col("live_open_mid")) / 2))
