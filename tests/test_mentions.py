"""Words counted in each text and words looked up by tokens give the same hits."""

import pytest
from pyspark.sql import functions as F

from earshot.operators import mentions
from earshot.operators.mentions import mention_hits, substring, variant_count, whole_word

TEXTS = ["a b a b a", "%a%a% a%", "say q&a, R&D; r&d", " x  y   z ", "", None, "...", "über-alles über", "1.5% of 2.5%", "a, b. a, b.", "x&y&&z", "the-the the", "\tnew\nline"]
WORDS = ["a b a", "a", "%a%", "&", "q&a", "R&D", " ", "", ".", "x  y", "5% of", "% of", "a, b", "y ", "r", "alles", "er-al", "1.5%", "he-th", "th", "t", "a / a", "b / a b", ".5", "\n", None, "...", "y   z "]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i if i % 5 else None, t, text) for i, text in enumerate(TEXTS + TEXTS[:4]) for t in ("MANY", "FEW", None)]
    docs = spark.createDataFrame(rows, "doc_id LONG, ticker STRING, content STRING")
    vocab = spark.createDataFrame([("MANY", w) for w in WORDS] + [("FEW", "a"), ("FEW", "q&a"), ("FEW", "A / the"), ("NONE", "a"), (None, "a")], "ticker STRING, word STRING")
    return docs.cache(), vocab.cache()


def hit_rows(df):
    return sorted((r.ticker, r.word, r.doc_id or 0, r.hits) for r in df.collect())


@pytest.mark.parametrize("few", [0, 3, 64])
@pytest.mark.parametrize("measure", [whole_word, variant_count, substring])
def test_any_number_of_words_gives_the_same_hits(monkeypatch, odd, measure, few):
    monkeypatch.setattr(mentions, "FEW_WORDS", few)
    docs, vocab = odd
    pairs = docs.join(vocab.distinct(), "ticker").where("word IS NOT NULL AND content IS NOT NULL")
    want = pairs.select("ticker", "word", "doc_id", measure(F.lower("content"), F.col("word")).cast("long").alias("hits")).where("hits > 0")
    assert hit_rows(mention_hits(docs, vocab, measure)) == hit_rows(want)


def test_words_beyond_a_broadcast_are_looked_up(monkeypatch, odd):
    docs, vocab = odd
    few = hit_rows(mention_hits(docs, vocab))
    monkeypatch.setattr(mentions, "fits_broadcast", lambda *args, **kwargs: False)
    assert hit_rows(mention_hits(docs, vocab)) == few


@pytest.mark.parametrize("measure", [whole_word, variant_count, substring])
def test_few_words_make_no_rows_of_tokens(spark, measure):
    """Texts of few words are not cut into tokens, however long they are: only hits are generated."""
    docs = spark.createDataFrame([(i, "T", "some words and more words " * 50) for i in range(4)], "doc_id LONG, ticker STRING, content STRING")
    hits = mention_hits(docs, spark.createDataFrame([("T", "more"), ("T", "absent")], "ticker STRING, word STRING"), measure)
    assert "_gaps" not in hits._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.doc_id, r.word) for r in hits.collect()) == [(i, "more") for i in range(4)]
