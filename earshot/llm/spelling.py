"""Spelling variants: words one edit apart, found by two chunks against positional grams, under their common forms."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.session import materialize

LETTERS = r"A-Za-zÀ-ÿ"
# The planted slips of the corpus words: of one run in so many a letter is left out.
SLIP_EVERY = 97


def corpus_words(docs: DataFrame, least_length: int = 5, least_count: int = 3, slip_every: int = SLIP_EVERY) -> DataFrame:
    """word and n, its occurrences over all documents, for words of at least so many code points and occurrences.

    Words are the maximal runs of Latin letters of every whole text, A-Z lower-cased. Where slip_every divides the crc32
    of `<doc_id>:<run>` (null doc_id: empty), the code point at crc32 modulo the run's length is left out. Null and empty
    texts hold no words; a repeated row counts again. Counts are summed before they are shuffled, so a word that makes up
    a third of all occurrences is one row per task. Other columns of docs are not read; an empty table gives no row.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.split(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), f"[^{LETTERS}]+")).alias("run"),
    ).where(F.length("run") >= least_length)
    marked = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("mark"))
    at = (F.col("mark") % F.length("run")).cast("int")
    slip = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = marked.select(F.when(F.col("mark") % slip_every == 0, slip).otherwise(F.col("run")).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.length("word") >= least_length) & (F.col("n") >= least_count))


def _piece(start: Column, size: Column) -> Column:
    """A gram of a word with its place, the first character being 0."""
    return F.struct(F.substring("word", start + 1, size).alias("gram"), start.alias("at"))


def chunks(words: DataFrame) -> DataFrame:
    """word, n, half (0 or 1), gram, at: the two disjoint halves of every word."""
    size, half = F.length("word"), F.floor(F.length("word") / 2).cast("int")
    both = words.select("word", "n", F.posexplode(F.array(_piece(F.lit(0), half), _piece(half, size - half))).alias("half", "g"))
    return both.select("word", "n", "half", "g.gram", "g.at")


def grams(words: DataFrame) -> DataFrame:
    """word, n, gram, at: the grams of every word that can be a half of a word one shorter or as long.

    One edit leaves a half where it was, or shifts it by the difference of the lengths. So the grams of use are those as
    long as a half, at the place of that half or, for a word one longer, one further on.
    """
    size = F.length("word")
    found = []
    for shorter in (0, 1):
        length = size - shorter
        half = F.floor(length / 2).cast("int")
        found += [_piece(F.lit(0), half), _piece(half + shorter, length - half)]
    return words.select("word", "n", F.explode(F.array_distinct(F.array(*found))).alias("g")).select("word", "n", "g.gram", "g.at")


def near_pairs(words: DataFrame) -> DataFrame:
    """short, long, n_short, n_long: every two words one inserted, deleted or replaced code point apart, once.

    The shorter word (of equal ones, the earlier) gives its two halves, the longer its grams; they meet in a gram at most
    one place apart and are verified by the distance inside the join, which thus hands on nothing but pairs. A pair that
    meets in both halves is kept for the first one only. Grams held by many words are split by the skew handling of the
    join. words holds distinct, non-null words.
    """
    short = chunks(words).select("gram", F.col("half").alias("of"), F.col("word").alias("short"), F.col("n").alias("n_short"), F.col("at").alias("from"))
    long = grams(words).select("gram", F.col("word").alias("long"), F.col("n").alias("n_long"), F.col("at").alias("to"))
    more = F.length("long") - F.length("short")
    half = F.floor(F.length("short") / 2).cast("int")
    ordered = ((more == 1) | ((more == 0) & (F.col("short") < F.col("long"))))
    # The first half stays at 0; the second counts where the first differs.
    placed = F.when(F.col("of") == 0, F.col("to") == 0).otherwise(
        (F.col("to") - F.col("from") == more)
        & (F.substring("short", F.lit(1), half) != F.substring("long", F.lit(1), half)))
    met = short.hint("merge").join(long, "gram").where(
        (F.abs(F.col("from") - F.col("to")) <= 1) & ordered & placed & (F.levenshtein("short", "long", 1) == 1))
    return met.select("short", "long", "n_short", "n_long")


def spelling_variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n, one row per word.

    words: word and n; null words are left out, the counts of a repeated word are summed, a null count is 0. n_near counts the words exactly one edit away. form is the
    near word of largest n (ties: the smallest in code-point order) if that n is at least twice the word's own, else null.
    root is the end of the chain of forms; counts double along it, so doubling the links log2(log2(largest n)) times
    reaches every end. Other columns are not read; an empty table gives no row.
    """
    words = materialize(words.where("word IS NOT NULL").groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), "words")
    pairs = near_pairs(words)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("short").alias("word"), F.col("long").alias("near"), F.col("n_long").alias("near_n")),
        F.struct(F.col("long").alias("word"), F.col("short").alias("near"), F.col("n_short").alias("near_n")))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    formed = words.join(best, "word", "left")
    fits = -F.col("best.less") >= 2 * F.col("n")
    formed = materialize(formed.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")), "forms")

    largest = words.agg(F.max("n")).first()[0] or 1
    links = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(math.log2(largest) + 1)) if largest > 1 else 0):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = materialize(links.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return formed.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
