"""Raw transcripts to a cleaned table, and markets plus transcripts to labelled splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from earshot.constants import MIN_TRANSCRIPT_WORDS
from earshot.operators import history, splits, transcripts
from earshot.session import materialize
from earshot.sources import sinks
from earshot.sources.transcripts import read_raw_transcripts


def preprocess(spark: SparkSession, expanded_root: str, cache_root: str, out: str,
               min_words: int = MIN_TRANSCRIPT_WORDS) -> DataFrame:
    """Read both roots, clean once, write the transcript table; returns the statistics per ticker."""
    raw = read_raw_transcripts(spark, expanded_root, cache_root)
    cleaned = materialize(transcripts.clean_documents(raw, min_words), "cleaned")
    sinks.write_transcripts(cleaned, out)
    return transcripts.preprocess_stats(cleaned)


def build_dataset(flat_markets: DataFrame, docs: DataFrame, out: str | None = None,
                  split_table: DataFrame | None = None) -> DataFrame:
    """Labels with their split; written as one folder per split when `out` is given."""
    labels = splits.cross_company_split(history.build_labels(docs, flat_markets), split_table)
    if out is None:
        return labels
    sinks.write_splits(labels, out)
    return labels.sparkSession.read.parquet(out)
