"""Choosing, counting and repairing transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.constants import MIN_TRANSCRIPT_WORDS
from earshot.functions import text as T
from earshot.functions.periods import period_num


def prefer_roots(roots: list[DataFrame], keys: tuple[str, ...] = ("ticker", "year", "quarter"),
                 name: str = "filename", dedupe: bool = True) -> DataFrame:
    """Union of roots; on a key collision the earlier root wins, then the smaller file name.

    Losers are found on the narrow key columns: only rows of keys that occur twice are listed, and taken out of the
    rows with text. Rows without a complete key collide with nothing.
    """
    tagged = [root.withColumn("priority", F.lit(i)) for i, root in enumerate(roots)]
    rows = tagged[0]
    for other in tagged[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    if not dedupe:
        return rows
    place = F.struct("priority", name)
    twice = rows.groupBy(*keys).agg(F.min(place).alias("win"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    losers = rows.select(*keys, "priority", name).join(twice, list(keys)).where(place != F.col("win")).drop("win")
    return rows.join(losers, [*keys, "priority", name], "left_anti")


def discover_tickers(*roots: DataFrame) -> DataFrame:
    """Distinct tickers over folder names, the suffix of expanded folders removed."""
    names = [r.select(F.regexp_replace("ticker", "_transcripts$", "").alias("ticker")) for r in roots]
    out = names[0]
    for other in names[1:]:
        out = out.union(other)
    return out.distinct()


def clean_documents(raw: DataFrame, min_words: int = MIN_TRANSCRIPT_WORDS) -> DataFrame:
    """raw + cleaned content, n_words and the reason a document is skipped (null when it is kept).

    Documents without a doc_id get '{ticker}_{year}Q{quarter}', the key that is unique after root precedence.
    """
    if "doc_id" not in raw.columns:
        raw = raw.withColumn("doc_id", F.concat(F.concat_ws("_", "ticker", "year"), F.lit("Q"), F.col("quarter").cast("string")))
    return (
        raw.withColumn("period_num", period_num(F.col("year"), F.col("quarter"))).withColumn("content", T.clean_transcript(F.col("content")))
        .withColumn("n_words", T.word_count(F.col("content")))
        .withColumn(
            "skip_reason",
            F.when((F.col("year") == 0) | (F.col("quarter") == 0), "unparseable_name")
            .when(F.col("n_words") < min_words, "too_short"),
        )
    )


def preprocess_stats(cleaned: DataFrame) -> DataFrame:
    kept = F.col("skip_reason").isNull()
    return cleaned.groupBy("ticker").agg(
        F.count_if(kept).alias("n_written"),
        F.count_if(kept & (F.coalesce(F.col("call_date").cast("string"), F.lit("")) == "")).alias("n_missing_date"),
        F.count_if(F.col("skip_reason") == "unparseable_name").alias("n_unparseable"),
        F.count_if(F.col("skip_reason") == "too_short").alias("n_too_short"),
    )


def repair_plan(files: DataFrame, folder: str = "folder", name: str = "file_name", text: str = "value") -> DataFrame:
    """New name, patched text and action for each badly named transcript.

    Actions: fix, bad_name, no_quarter, target_exists. A target taken by a good file, or by the first
    badly named file that maps to it, is not overwritten.
    """
    good = files.where(T.is_good_name(F.col(name))).select(folder, F.col(name).alias("new_name")).distinct()
    broken = (
        files.where(~T.is_good_name(F.col(name)))
        .withColumn("inferred", T.infer_quarter(F.col(text)))
        .withColumn(
            "new_name",
            F.concat(T.name_ticker(F.col(name)), F.lit("_"), T.name_year(F.col(name)), F.lit("_Q"),
                     F.col("inferred").cast("string"), F.lit(".txt")),
        )
    )
    # The file list is narrow; only it is grouped and joined to find collisions.
    first = broken.where(F.col("new_name").isNotNull()).groupBy(folder, "new_name").agg(F.min(name).alias("first_name"))
    free = first.join(good, [folder, "new_name"], "left_anti")
    action = (
        F.when(T.name_ticker(F.col(name)).isNull(), "bad_name").when(F.col("inferred").isNull(), "no_quarter")
        .when(F.col("first_name") == F.col(name), "fix").otherwise("target_exists")
    )
    return (
        broken.join(free, [folder, "new_name"], "left").withColumn("action", action)
        .withColumn("patched", F.when(F.col("action") == "fix", T.patch_period_header(F.col(text), F.col("inferred"))))
        .drop("first_name")
    )


def stale_predictions(rows: DataFrame, probs: DataFrame, key: str = "market_ticker") -> DataFrame:
    """Keys found on one side only; empty when the predictions fit the rows."""
    r = rows.select(key).withColumn("in_rows", F.lit(1))
    p = probs.select(key).withColumn("in_probs", F.lit(1))
    return r.join(p, key, "full_outer").where("in_rows IS NULL OR in_probs IS NULL")


def attach_predictions(rows: DataFrame, probs: DataFrame, key: str = "market_ticker") -> DataFrame:
    """rows + prob_pos + pred by key; fails when the two sides do not match one to one."""
    joined = rows.join(probs.select(key, "prob_pos"), key, "left")
    checked = F.coalesce(
        F.col("prob_pos"), F.raise_error(F.concat(F.lit("no prediction for "), F.col(key))).cast("double")
    )
    return joined.withColumn("prob_pos", checked).withColumn("pred", (F.col("prob_pos") >= 0.5).cast("int"))
