"""Line dedup over overlapping windows of three lines, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import WORD, settled, text_or_empty

WINDOW = 3


def _pair_hash(*parts: Column) -> Column:
    """128 bits of two hashes."""
    return F.struct(F.xxhash64(*parts).alias("x"), F.xxhash64(F.lit("second"), *parts).alias("y"))


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, row_key and hashed lines that hold a word, with their places among all lines of the text."""
    numbered = F.transform(F.split(text_or_empty(), "\n"), lambda line, i: F.struct(
        i.alias("i"), line.rlike(WORD).alias("full"), _pair_hash(F.btrim(line, F.lit(" \t\r\x0b\x0c"))).alias("h")))
    return docs.select("doc_id", "row_key", F.filter(numbered, lambda line: line["full"]).alias("lines"))


def line_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, row_key, the hash of every window of consecutive lines, and the places of its lines in the text."""
    lines = F.col("lines")
    spots = F.sequence(F.lit(0), F.size(lines) - window)
    windows = F.transform(spots, lambda k: F.struct(
        _pair_hash(*(F.get(lines, k + j)["h"] for j in range(window))).alias("h"),
        F.array(*(F.get(lines, k + j)["i"] for j in range(window))).alias("at")))
    held = _lines(docs).where(F.size("lines") >= window)
    return held.select("doc_id", "row_key", F.explode(windows).alias("w")).select(
        "doc_id", "row_key", F.col("w.h.x").alias("x"), F.col("w.h.y").alias("y"), F.col("w.at").alias("at"))


def line_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text without repeated passages, n_lines and n_removed, one row per document.

    Every run of three consecutive lines that hold a word is a window (blank lines are passed over, white space at
    both ends of a line does not count). Of the windows that are equal anywhere in the corpus the first by
    (doc_id, content of the row, place) stays; the lines that any later one covers are removed, overlapping ones once.
    A null doc_id comes last. Of rows that are the same in doc_id and text, all later windows repeat the first one's
    only within each row, since the rows cannot be told apart. Texts of fewer than three lines with a word stay as
    they are; null text becomes empty. Other columns of docs are not read. An empty table gives no row.
    """
    keyed = docs.select("doc_id", F.col("text"), F.xxhash64("text").alias("row_key"))
    windows = line_windows(keyed, window)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key", F.col("at")[0].alias("at"))
    # Repeated windows: a first place and a number for each, summed up where they are read before any shuffle.
    firsts = windows.groupBy("x", "y").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = windows.join(firsts.select("x", "y", "first"), ["x", "y"]).where(place != F.col("first"))
    covered = later.groupBy("doc_id", "row_key").agg(F.array_distinct(F.flatten(F.collect_set("at"))).alias("gone"))
    covered = covered.select(F.col("doc_id").alias("id"), F.col("row_key").alias("key"), "gone")
    # One plan at every size: a table of lines to remove grows with the corpus.
    joined = keyed.join(covered.hint("merge"), (F.col("doc_id").eqNullSafe(F.col("id"))) & (F.col("row_key") == F.col("key")), "left")
    joined = settled(joined, _lines=F.split(text_or_empty(), "\n"), _gone=F.coalesce("gone", F.expr("array()").cast("array<int>")))
    lines, gone = F.col("_lines"), F.col("_gone")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i))
    return joined.select("doc_id", F.when(F.size(gone) == 0, text_or_empty()).otherwise(F.array_join(left, "\n")).alias("text"),
                         F.size(lines).cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_removed"))
