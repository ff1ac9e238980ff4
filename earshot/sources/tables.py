"""CSV and JSONL tables with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.schemas import EXPERIMENT


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """Quoted text may hold commas, quotes and newlines; blanks and NaN read as null.

    With multi_line a file is one task; a large file whose text holds no newlines is better read without, in splits.
    """
    df = (
        spark.read.schema(schema)
        .csv(path, header=True, multiLine=multi_line, quote='"', escape='"', nullValue="", nanValue="NaN")
    )
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles})


def read_experiments(spark: SparkSession, path: str, schema: str = EXPERIMENT) -> DataFrame:
    """One JSON record per line; blank and broken lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def find_experiments(log: DataFrame, model: str, feature_set: str, split: str) -> DataFrame:
    """Records of one nested configuration that carry a confusion matrix."""
    return log.where(
        (F.col("config.model") == model) & (F.col("config.feature_set") == feature_set)
        & (F.col("config.split") == split) & F.col("metrics.confusion_matrix").isNotNull()
    )
