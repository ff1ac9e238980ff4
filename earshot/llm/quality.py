"""Quality rules: counts of a text and a log-likelihood ratio of hashed n-grams, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import WORD, settled, text_or_empty, words_of

# Buckets of the hashed n-grams, and the least mean log ratio per n-gram of a document that stays.
BUCKETS = 8192
LEAST_RATIO = -0.06
# A bucket seen no more often than this tells little: its ratio is drawn towards none.
PRIOR = 30.0
# Rows of the trusted target that the ratio is fitted on, by the smallest hash of their id. The raw side counts all.
TRUSTED_ROWS = 20_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"


def _grams(docs: DataFrame, text: Column) -> DataFrame:
    """docs with _hashes (of every word) and _pairs (of every word with its right neighbour, the last one alone)."""
    step = settled(docs, _words=words_of(text))
    step = settled(step, _hashes=F.transform("_words", lambda w: F.xxhash64(w)))
    return settled(step, _pairs=F.transform("_hashes", lambda h, i: F.xxhash64(h, F.get("_hashes", i + 1))))


def ratio_weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, trusted_rows: int = TRUSTED_ROWS) -> list[float]:
    """log(target / raw) of every bucket, of multinomials over all words and word pairs, smoothed by PRIOR counts.

    docs are all documents, trusted the doc_ids of the target. Raw counts cover all rows and whole texts; the target is
    a sample of at most trusted_rows ids. What reaches the driver is one row per bucket. Without any target document
    every weight is near 0 alike, and no document is told from another.
    """
    sample = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_rows)
    sample = sample.withColumn("target", F.lit(1))
    marked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left")
    grams = _grams(marked, text_or_empty()).select("target", F.explode(F.concat("_hashes", "_pairs")).alias("gram"))
    counts = grams.groupBy(F.pmod("gram", F.lit(buckets)).cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("raw"), F.count("target").alias("target"))
    raw, target = [0.0] * buckets, [0.0] * buckets
    for row in counts.collect():  # at most one row per bucket
        raw[row["bucket"]] += row["raw"]
        target[row["bucket"]] += row["target"]
    share = sum(target) / max(sum(raw), 1.0)
    return [math.log((t + PRIOR) / (r * share + PRIOR)) for r, t in zip(raw, target)]


def quality_rules(docs: DataFrame, weights: list[float], least_ratio: float = LEAST_RATIO, min_words: int = MIN_WORDS,
                  max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """Every row of docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio and kept.

    Words are runs without blank and U+0009-U+000D. n_repeat_words counts the words that lie in a three-word window
    found twice or more in the text (windows are told apart by 64-bit hashes). ratio is the mean weight of the text's
    words and word pairs; a text without words has ratio 0. kept is false for base_failed, else ratio >= least_ratio,
    for every document alike. Null text counts as empty. Names that docs already has are replaced.
    """
    buckets = len(weights)
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded to one constant
    keep = [c for c in docs.columns if c not in ADDED]
    text = text_or_empty()
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    step = _grams(settled(
        docs.select(*keep), n_dup_lines=(F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        n_symbols=F.regexp_count(text, F.lit(SYMBOLS)).cast("long")), text)
    n_words = F.size("_words")
    windows = F.transform("_hashes", lambda h, i: F.xxhash64(h, F.get("_hashes", i + 1), F.get("_hashes", i + 2)))
    windows = F.slice(windows, F.lit(1), F.greatest(n_words - 2, F.lit(0)))
    sums = F.aggregate(F.concat("_hashes", "_pairs"), F.lit(0.0),
                       lambda a, h: a + F.get(table, F.pmod(h, F.lit(buckets)).cast("int")))
    step = settled(step, _windows=windows, n_words=n_words.cast("long"),
                   word_chars=F.length(F.array_join("_words", "")).cast("long"),
                   ratio=F.when(n_words > 0, sums / (2 * n_words)).otherwise(0.0)).drop("_words", "_hashes", "_pairs")
    hashes = F.col("_windows")
    # Only texts with a window found twice are sorted by window.
    ranked = F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    step = settled(step, _ranked=ranked).drop("_windows")
    order = F.col("_ranked")
    twice = F.filter(F.transform(order, lambda w, k: F.when(
        (F.get(order, k - 1)["h"] == w["h"]) | (F.get(order, k + 1)["h"] == w["h"]), w["i"])), lambda i: i.isNotNull())
    step = settled(step, _starts=F.sort_array(twice)).drop("_ranked")
    starts = F.col("_starts")
    covered = F.aggregate(F.transform(starts, lambda s, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - s, F.lit(3)))),
                          F.lit(0), lambda a, n: a + n)
    step = settled(step, n_repeat_words=F.coalesce(covered, F.lit(0)).cast("long")).drop("_starts")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return step.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), "ratio", (~failed & (F.col("ratio") >= least_ratio)).alias("kept"))


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "kept",
         "_words", "_hashes", "_pairs", "_windows", "_ranked", "_starts")
