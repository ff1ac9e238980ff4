"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest dimension (rows, text characters) that is broadcast rather than shuffled.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_CHARS = 8_000_000


def build_session(app: str = "earshot", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fallback_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; where none is set, a temporary one, in local mode only."""
    global _fallback_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all hosts of {master} share")
    if _fallback_root is None:
        _fallback_root = tempfile.mkdtemp(prefix="earshot-")
    return _fallback_root


def session_folder(spark: SparkSession) -> str:
    """Everything that this application writes for itself, so that one removal clears it."""
    return f"{shared_root(spark)}/earshot-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove the session's folder; tables and checkpoints read from it are gone then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(session_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's part of the shared folder."""
    return f"{session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoints"))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so that lost executors cost no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def fits_broadcast(df: DataFrame, text_cols: tuple[str, ...] = (), max_rows: int = BROADCAST_MAX_ROWS,
                   max_chars: int = BROADCAST_MAX_CHARS) -> bool:
    """True when the table is proven to hold at most max_rows rows and max_chars characters."""
    chars = sum((F.coalesce(F.length(c), F.lit(0)).cast("long") for c in text_cols), F.lit(0).cast("long"))
    rows, total = (
        df.select(chars.alias("chars")).limit(max_rows + 1)
        .agg(F.count(F.lit(1)), F.coalesce(F.sum("chars"), F.lit(0))).first()
    )
    return rows <= max_rows and total <= max_chars


def broadcast_if_small(df: DataFrame, text_cols: tuple[str, ...] = (), **limits: int) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, text_cols, **limits) else df


# Below this size a table is read by few tasks, and shuffling it costs little.
SPREAD_MAX_BYTES = 512 * 1024 * 1024


def spread_if_small(df: DataFrame, key: str) -> DataFrame:
    """Spread a small table over all cores before costly per-row text work; large tables keep their splits."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size > SPREAD_MAX_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)
