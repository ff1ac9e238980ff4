"""Whole words are found by the literal first; what counts as a word stays as it was."""

from pyspark.sql import functions as F

from earshot.functions import words as W

TEXTS = ["it", "mit it, it's bit it", "q&a q& a&", "a\\Eb \\E a\\E", "über alles über-alles ü", "x😀y 😀 😀😀", "é ét et", "a_b a-b a1 1a", "", " ", "\n\nnew\nline\n", "a b a b a"]
LITERALS = ["it", "&", "q&a", "a\\Eb", "\\E", "über", "ü", "alles ü", "😀", "😀y", "x😀", "é", "e", "a", "1", "-", "_", "", " ", "\n", "new\nline", "a b a", "b a"]


def boundary_first(literal):
    return F.concat(F.lit("(?U)\\b\\Q"), F.replace(literal, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E\\b"))


def test_same_places_as_with_the_boundary_first(spark):
    pairs = spark.createDataFrame([(t, w) for t in TEXTS for w in LITERALS], "t STRING, w STRING")
    new, old = W.whole_word_pattern(F.col("w")), boundary_first(F.col("w"))
    both = pairs.select("t", "w", *[x.alias(n) for n, x in (
        ("count", F.regexp_count("t", new)), ("old_count", F.regexp_count("t", old)),
        ("cut", F.regexp_replace("t", new, F.lit("<>"))), ("old_cut", F.regexp_replace("t", old, F.lit("<>"))))])
    assert both.where("old_count > 1").count() > 10
    assert both.where("count <> old_count OR cut <> old_cut").collect() == []


def test_literal_is_looked_for_before_any_boundary(spark):
    pattern = spark.range(1).select(W.whole_word_pattern(F.lit("it"))).first()[0]
    assert pattern.startswith("(?U)\\Qit\\E")
