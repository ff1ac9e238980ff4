"""Operators on small frames: strict dates, ties, bins, skew-safe routes, brute force."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from earshot.operators import binning, context, history, metrics, models, ranking, splits, sweeps, tfidf, trailing
from earshot.operators import transcripts as TR
from earshot.operators.mentions import mention_hits, substring, variant_count, whole_word

D = dt.date


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    bank = "ai model tariff growth c++ über x-ray we said the of A_B don't".split()
    rows = []
    for i in range(60):
        text = " ".join(rng.choice(bank) for _ in range(rng.randrange(0, 12)))
        date = None if i % 13 == 0 else D(2024, 1, 1) + dt.timedelta(days=rng.randrange(8))
        rows.append((i, "HOT" if i % 3 else "B", text, date, 2024, 1 + i % 4))
    words = ["AI", "AI / AI model", "x-ray", "über", "c++", "the", "missing", "of A_B", "c", "ai model"]
    targets = [(t, w, D(2024, 1, 1) + dt.timedelta(days=k)) for t in ("HOT", "B", "NONE") for w in words for k in (0, 3, 8)]
    docs = spark.createDataFrame(rows, "doc_id LONG, ticker STRING, content STRING, call_date DATE, year INT, quarter INT")
    return rows, targets, docs.cache(), spark.createDataFrame(targets, "ticker STRING, word STRING, cutoff DATE").cache()


def says(word, text):
    return bool(re.search(r"\b" + re.escape(word) + r"\b", text, re.I))


def test_history_rate_equals_brute_force(corpus):
    rows, targets, docs, tdf = corpus
    got = {(r.ticker, r.word, r.cutoff): r.hist_rate for r in history.mention_rates(docs, tdf).collect()}
    for t, w, c in targets:
        prior = [r for r in rows if r[1] == t and r[3] is not None and r[3] < c]
        want = sum(says(w, r[2]) for r in prior) / len(prior) if prior else None
        assert got[(t, w, c)] == (None if want is None else pytest.approx(want)), (t, w, c)


def matched(docs, vocab, measure):
    """Every text against every word of its ticker by regular expressions."""
    pairs = docs.join(vocab.select("ticker", "word").distinct(), "ticker").where("word IS NOT NULL AND content IS NOT NULL")
    return pairs.select("ticker", "word", "doc_id", measure(F.lower("content"), F.col("word")).cast("long").alias("hits")).where("hits > 0")


def hit_rows(df):
    return sorted((r.ticker, r.word, r.doc_id or 0, r.hits) for r in df.collect())


@pytest.mark.parametrize("measure", [whole_word, variant_count, substring])
def test_token_lookup_equals_regular_expressions(spark, corpus, measure):
    _, _, docs, tdf = corpus
    assert hit_rows(mention_hits(docs, tdf, measure)) == hit_rows(matched(docs, tdf, measure))
    texts = ["a b a b a", "%a%a% a%", "say q&a, R&D; r&d", " x  y   z ", "", None, "...", "über-alles über", "1.5% of 2.5%", "a, b. a, b.", "x&y&&z", "the-the the", "\tnew\nline"]
    words = ["a b a", "a", "%a%", "&", "q&a", "R&D", " ", "", ".", "x  y", "5% of", "% of", "a, b", "y ", "r", "alles", "er-al", "1.5%", "he-th", "th", "t", "a / a", "b / a b", ".5", "\n", None, "...", "y   z "]
    odd = spark.createDataFrame([(i if i % 5 else None, "T", t, "x") for i, t in enumerate(texts + texts[:4])], "doc_id LONG, ticker STRING, content STRING, token STRING")
    vocab = spark.createDataFrame([("T", w) for w in words] + [("U", "a"), (None, "a")], "ticker STRING, word STRING")
    assert hit_rows(mention_hits(odd, vocab, measure)) == hit_rows(matched(odd, vocab, measure))


def test_large_vocabulary_needs_no_other_plan(spark):
    """300,000 words, most of them of one ticker, take the same joins on (ticker, token) as a few, and no job beforehand."""
    vocab = spark.range(300_000).select(F.when(F.col("id") % 20 > 0, "HOT").otherwise("B").alias("ticker"), F.concat(F.lit("word "), "id").alias("word"))
    docs = spark.createDataFrame([(i, "HOT" if i % 3 else "B", f"a word {i} and word {i * 7}, word") for i in range(200)], "doc_id LONG, ticker STRING, content STRING")
    got = {(r.doc_id, r.word) for r in mention_hits(docs, vocab).collect()}
    want = {(i, f"word {n}") for i in range(200) for n in (i, i * 7) if (n % 20 > 0) == (i % 3 > 0)}
    assert got == want
    assert {(r.doc_id, r.word) for r in mention_hits(docs, vocab.where("word = ''")).collect()} == set()


def test_future_document_changes_nothing(spark, corpus):
    _, _, docs, tdf = corpus
    later = spark.createDataFrame([(999, "HOT", "ai tariff", D(2024, 1, 9), 2024, 1)], docs.schema)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(history.mention_rates(docs, tdf)) == key(history.mention_rates(docs.unionByName(later), tdf))


def test_labels_edge_rows(spark):
    docs = spark.createDataFrame(
        [(1, "A", "ai", D(2024, 1, 5), 2024, 1), (2, "A", "none", D(2024, 1, 1), 2023, 4)],
        "doc_id LONG, ticker STRING, content STRING, call_date DATE, year INT, quarter INT")
    nan = float("nan")
    m = spark.createDataFrame([
        ("A", "AI", None, "YES", nan, "2024-01-05", "", "on-cutoff"), ("A", "ai", 0, "yes", 0.5, "", "2024-01-06", "given-label"),
        ("A", "ai", None, "no", None, "junk", None, "no-date"), ("BRK-B", "ai", None, "no", 0.2, "2024-02-01", "", "no-docs"),
    ], "company_label STRING, word STRING, label INT, result STRING, implied_prob DOUBLE, close_date STRING, settlement_date STRING, market_ticker STRING")
    got = {r.market_ticker: r for r in history.build_labels(docs, m).collect()}
    assert got["on-cutoff"].hist_rate == 0.0 and got["on-cutoff"].implied_prob is None and got["on-cutoff"].mentioned == 1
    assert got["given-label"].hist_rate == 0.5 and got["given-label"].mentioned == 0
    assert (got["no-date"].year, got["no-date"].quarter, got["no-date"].hist_rate, got["no-date"].call_date) == (0, 0, None, None)
    assert got["no-docs"].hist_rate is None and len(got) == 4


def test_seen_news_and_context_brute_force(spark, corpus):
    rows, targets, docs, tdf = corpus
    seen = {(r.ticker, r.word, r.cutoff): r.word_seen_before for r in history.seen_before(docs, tdf).collect()}
    news = {(r.ticker, r.word, r.cutoff): r.in_recent_news for r in history.in_recent_news(docs, tdf, 2).collect()}
    ctx = {(r.ticker, r.cutoff): r.context for r in context.recent_context(docs, tdf, 3).collect()}
    for t, w, c in targets:
        dated = [r for r in rows if r[1] == t and r[3] is not None]
        prior = [r for r in dated if r[3] < c]
        assert seen[(t, w, c)] == (int(any(w.lower() in r[2].lower() for r in prior)) if prior else None)
        assert news[(t, w, c)] == int(any(says(w, r[2]) for r in dated if c - dt.timedelta(days=2) <= r[3] <= c))
        newest = sorted(prior, key=lambda r: (-r[3].toordinal(), r[4], r[5], r[0]))[:3]
        assert ctx[(t, c)] == " ".join(r[2] for r in newest)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 13])
def test_trailing_features_short_histories(spark, n):
    counts = [(i * 7) % 5 for i in range(n)]  # oldest first
    docs = spark.createDataFrame(
        [(i, "T", "ai " * c, D(2020, 1, 1) + dt.timedelta(days=90 * i), 8000 + i) for i, c in enumerate(counts)],
        "doc_id LONG, ticker STRING, content STRING, call_date DATE, period_num INT")
    target = spark.createDataFrame([("T", "AI", 8000 + n)], "ticker STRING, word STRING, target_period INT")
    row = trailing.word_features(docs, target).first()
    pc = counts[-12:]
    ps = [int(c > 0) for c in pc]
    mean = lambda v: sum(v) / len(v)
    k = len(pc)
    r2 = mean(pc[-2:]) if k >= 2 else 0.0
    o2 = mean(pc[-4:-2]) if k >= 4 else 0.0
    assert (row.n_past, row.max_count, row.total_mentions) == (k, max(pc), sum(pc))
    assert row.base_rate == pytest.approx(mean(ps)) and row.mean_count == pytest.approx(mean(pc))
    for w in (1, 2, 4):
        assert row[f"rate_last_{w}q"] == pytest.approx(mean(ps[-w:])) and row[f"count_last_{w}q"] == sum(pc[-w:])
        assert row[f"said_last_{w}q"] == (int(any(ps[-w:])) if k >= w else 0)
    assert row.trend_delta == pytest.approx(r2 - o2) and row.trend_ratio == pytest.approx(r2 / (o2 + 0.01))
    assert row.is_trending_up == int(r2 > o2) and row.mgmt_count_4q == row.count_last_4q


def test_sector_peers_need_the_exact_previous_period(spark):
    f = spark.createDataFrame([("S", "w", 1, 0.2), ("S", "w", 1, 0.4), ("S", "w", 2, 0.9), ("S", "w", 4, 0.7), (None, "w", 2, 0.1)],
                              "sector STRING, word STRING, period_num INT, base_rate DOUBLE")
    got = {(r.sector, r.period_num, r.base_rate): r.sector_peer_base_rate for r in trailing.with_sector_peers(f).collect()}
    assert got[("S", 2, 0.9)] == pytest.approx(0.3) and got[("S", 4, 0.7)] == 0.7 and got[(None, 2, 0.1)] == 0.1


# Confusion matrices with their published quality on 175 rows.
@pytest.mark.parametrize("tn, fp, fn, tp, f1", [(66, 6, 4, 99, 0.9408), (71, 1, 8, 95, 0.9476), (40, 32, 44, 59, 0.5605), (33, 39, 37, 66, 0.5497)])
def test_metrics_from_logged_counts(spark, tn, fp, fn, tp, f1):
    row = metrics.metrics_from_counts(spark.createDataFrame([(tn, fp, fn, tp)], "tn LONG, fp LONG, fn LONG, tp LONG")).first()
    assert row.n == 175 and round(row.f1_macro, 4) == f1 and row.accuracy == pytest.approx((tn + tp) / 175)


def test_metrics_empty_and_one_class(spark):
    empty = metrics.classification_metrics(spark.createDataFrame([], "mentioned INT, pred INT")).first()
    assert (empty.n, empty.tn, empty.accuracy, empty.f1_macro) == (0, 0, None, None)
    one = metrics.classification_metrics(spark.createDataFrame([(1, 1), (0, 1)], "mentioned INT, pred INT")).first()
    assert (one.precision_neg, one.recall_neg, one.f1_neg, one.recall_pos) == (0.0, 0.0, 0.0, 1.0)
    roi = metrics.roi_backtest(spark.createDataFrame([(1, 1, None)], "mentioned INT, pred INT, implied_prob DOUBLE")).first()
    assert (roi.n_trades, roi.n_skipped_nan_prob, roi.roi_per_trade, roi.total_pnl) == (0, 1, None, 0.0)


def test_roi_fee_is_flat(spark):
    df = spark.createDataFrame([(1, 1, 0.6), (0, 1, 0.6), (0, 0, 0.3)], "mentioned INT, pred INT, implied_prob DOUBLE")
    roi = metrics.roi_backtest(df).first()
    assert roi.total_pnl == pytest.approx((1 - 0.6 - 0.03) + (-0.6 - 0.03) + (1 - 0.7 - 0.03)) and roi.n_correct == 2


def test_auc_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice([0.1, 0.10000001, 0.5, 0.99, 1.0, 0.0, rng.random()]), rng.randrange(2)) for _ in range(300)]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    got = metrics.roc_auc(spark.createDataFrame(rows, "s DOUBLE, y INT"), "s", "y").first()
    assert got.auc == pytest.approx(want)
    assert metrics.roc_auc(spark.createDataFrame([(0.5, 1)], "s DOUBLE, y INT"), "s", "y").first().auc is None


def test_calibration_and_histogram_edges(spark):
    import numpy as np
    import pandas as pd

    p = [i / 100 for i in range(1, 100)] + [0.5, 0.01, 0.99]
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(p)] + [(None, 1)], "implied_prob DOUBLE, label INT")
    want = pd.Series(pd.cut(pd.Series(p), bins=10, labels=False)).value_counts().to_dict()
    got = {r.prob_bin: r.n for r in binning.calibration_table(df).collect()}
    assert got == want and sum(got.values()) == len(p)
    hist = [r.n for r in binning.histogram(df).orderBy("bin").collect()]
    assert hist == list(np.histogram(p, bins=30)[0])
    same = spark.createDataFrame([(0.4, 1), (0.4, 0)], "implied_prob DOUBLE, label INT")
    assert [r.n for r in binning.calibration_table(same).collect()] == [2]
    assert sum(r.n for r in binning.histogram(same).collect()) == 2


def test_history_threshold_first_best_wins(spark):
    df = spark.createDataFrame([(None, 0), (0.3, 1), (0.9, 1), (0.1, 0)], "hist_rate DOUBLE, mentioned INT")
    best = sweeps.best_history_threshold(df).first()
    assert (best.threshold, best.f1_macro) == (0.1, 1.0)


def test_edge_threshold_default_when_few_rows(spark):
    df = spark.createDataFrame([(0.9, 0.6, 1)], "final_prob DOUBLE, daily_open_mid DOUBLE, market_yes INT")
    assert sweeps.best_edge_threshold(df).first().threshold == 0.05
    summary = {r.side: r.n for r in sweeps.backtest_summary(df).collect()}
    assert summary == {"YES": 1, "NO": 0}


def test_ordered_position_is_a_global_rank(spark):
    df = spark.range(1000).withColumn("h", F.md5(F.col("id").cast("string")))
    out = ranking.ordered_position(df, ["h"], F.substring("h", 1, 2)).orderBy("h").collect()
    assert [r.position for r in out] == list(range(1000)) and {r.total for r in out} == {1000}


def test_splits(spark):
    rows = spark.createDataFrame([(f"T{i % 93}", i) for i in range(1090)], "ticker STRING, id INT")
    out = splits.cross_company_split(rows)
    sizes = {r.split: r.n_companies for r in splits.split_sizes(out).collect()}
    assert sizes == {"train": 65, "dev": 13, "test": 15} and splits.leaking_companies(out).count() == 0 and out.count() == 1090
    seeded = {r.ticker: r.split for r in splits.seeded_company_splits(rows).collect()}
    names = sorted({f"T{i}" for i in range(93)})
    random.Random(42).shuffle(names)
    assert all(seeded[t] == ("train" if i < 65 else "dev" if i < 78 else "test") for i, t in enumerate(names))


def test_folds_are_balanced(spark):
    rows = spark.createDataFrame([(f"m{i}", int(i % 3 == 0)) for i in range(100)], "k STRING, y INT")
    counts = splits.stratified_folds(rows, "y", "k").groupBy("y", "fold").count().collect()
    assert len(counts) == 10 and max(r["count"] for r in counts if r.y == 1) - min(r["count"] for r in counts if r.y == 1) <= 1


def brute_tfidf(rows, contexts, min_df, max_df, limit):
    import math
    from collections import Counter

    docs = sorted((r for r in rows if r[3] is not None), key=lambda r: (r[4], r[5], r[3], r[0]))
    texts = [[w for r in docs if r[1] == t and c is not None and r[3] < c for w in re.findall(r"\b\w\w+\b", r[2].lower())] for t, c in contexts]
    tfs = [Counter(x + [" ".join(p) for p in zip(x, x[1:])]) for x in texts]
    df, total = Counter(t for tf in tfs for t in tf), Counter()
    for tf in tfs:
        total.update(tf)
    n = len(contexts)
    vocab = sorted((t for t in df if df[t] >= min_df and df[t] <= max_df * n), key=lambda t: (-total[t], t))[:limit]
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in vocab}
    out = {}
    for key, tf in zip(contexts, tfs):
        w = {t: (1 + math.log(tf[t])) * idf[t] for t in vocab if tf[t]}
        norm = math.sqrt(sum(v * v for v in w.values()))
        out[key] = {t: v / norm for t, v in w.items()}
    return idf, out


def test_tfidf_equals_brute_force(spark, corpus):
    rows, _, docs, _ = corpus
    contexts = [(t, D(2024, 1, 1) + dt.timedelta(days=k)) for t in ("HOT", "B") for k in (0, 2, 3, 5, 8, 8)] + [("HOT", None)]
    idf, want = brute_tfidf(rows, contexts, 3, 0.7, 40)
    cdf = spark.createDataFrame(contexts, "ticker STRING, cutoff DATE")
    daily = tfidf.daily_term_counts(docs)
    vocab = tfidf.fit_vocabulary(daily, cdf, 40, 3, 0.7).cache()
    assert {r.term: pytest.approx(r.idf) for r in vocab.collect()} == idf
    got = {}
    for r in tfidf.context_vectors(daily, cdf, vocab).collect():
        got.setdefault((r.ticker, r.cutoff), {})[r.term] = r.weight
    assert set(got) == {k for k, v in want.items() if v}
    for key, weights in got.items():
        assert weights == pytest.approx(want[key])


@pytest.mark.parametrize("max_features, min_df, max_df, buckets", [
    (40, 3, 0.7, 1 << 20), (40, 3, 0.7, 7), (3, 1, 1.0, 1 << 20), (3, 9, 0.6, 64), (5, 100, 1.0, 16), (10_000, 1, 1.0, 3)])
def test_sketched_vocabulary_equals_brute_force(spark, corpus, max_features, min_df, max_df, buckets):
    """Also where few buckets collide, the limits leave out the heaviest terms, or nothing is left."""
    rows, _, docs, _ = corpus
    contexts = [(t, D(2024, 1, 1) + dt.timedelta(days=k)) for t in ("HOT", "B", "NONE") for k in (0, 2, 3, 5, 5)] + [("HOT", None)]
    idf, _ = brute_tfidf(rows, contexts, min_df, max_df, max_features)
    cdf = spark.createDataFrame(contexts, "ticker STRING, cutoff DATE")
    got = tfidf.corpus_vocabulary(docs, cdf, max_features, min_df, max_df, buckets)
    assert {r.term: r.idf for r in got.collect()} == {t: pytest.approx(v) for t, v in idf.items()}
    whole = tfidf.fit_vocabulary(tfidf.daily_term_counts(docs), cdf, max_features, min_df, max_df)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))


def test_counts_of_a_vocabulary_are_those_of_all_terms(spark, corpus):
    _, _, docs, _ = corpus
    words = spark.createDataFrame([("ai",), ("ai model",), ("absent",)], "term STRING")
    some = tfidf.daily_term_counts(docs, words).collect()
    whole = tfidf.daily_term_counts(docs).where("term IN ('ai', 'ai model')").collect()
    assert some and sorted(map(tuple, some)) == sorted(map(tuple, whole))


def test_vocabulary_of_no_documents_and_of_no_rows(spark, corpus):
    _, _, docs, _ = corpus
    cdf = spark.createDataFrame([("HOT", D(2024, 1, 5))], "ticker STRING, cutoff DATE")
    assert tfidf.corpus_vocabulary(docs.limit(0), cdf, min_df=1, max_df=1.0).count() == 0
    assert tfidf.corpus_vocabulary(docs, cdf.limit(0), min_df=1, max_df=1.0).count() == 0
    twice = tfidf.corpus_vocabulary(docs.unionByName(docs), cdf, min_df=1, max_df=1.0)
    whole = tfidf.fit_vocabulary(tfidf.daily_term_counts(docs.unionByName(docs)), cdf, min_df=1, max_df=1.0)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, whole.collect()))


@pytest.mark.parametrize("seed", range(4))
def test_context_order_equals_brute_force(spark, seed):
    """Periods that do not follow the dates, shared periods and dates, and missing ones."""
    rng = random.Random(seed)
    rows = [(i, rng.choice(["HOT", "HOT", "B", None]), rng.choice([None, D(2024, 1, 1), *[D(2024, 1, 1) + dt.timedelta(days=k) for k in range(9)]]),
             rng.choice([2022, 2023, 2024, None]), rng.choice([1, 2, 3, 4, None])) for i in range(70)]
    contexts = [(t, D(2024, 1, 1) + dt.timedelta(days=k)) for t in ("HOT", "B", "NONE") for k in range(11)] + [("HOT", None)]
    docs = spark.createDataFrame(rows, "doc_id LONG, ticker STRING, call_date DATE, year INT, quarter INT")
    got = {(r.ticker, r.cutoff): tuple(r)[2:] for r in context.context_order(docs, spark.createDataFrame(contexts, "ticker STRING, cutoff DATE")).collect()}
    for t, c in contexts:
        mine = [r for r in rows if r[1] == t and r[2] and c and r[2] < c]
        ids = [r[0] for r in sorted(mine, key=lambda r: (r[3] or 0, r[4] or 0, r[2], r[0]))]
        codes = [(a * 31 + b) % 1000003 for a, b in zip(ids, ids[1:])]
        assert got[t, c] == (ids[0] if ids else None, ids[-1] if ids else None, len(codes), sum(codes))


def test_neighbours_are_linear_in_the_cells():
    rng = random.Random(3)
    days = [rng.randrange(500) for _ in range(4000)]
    assert len(list(context._neighbours(days))) < 2 * len(days)
    assert list(context._neighbours([])) == [] and list(context._neighbours([7])) == []


def test_bigram_that_leaves_a_context_and_comes_back(spark):
    """'a1 b1' spans two calls until one of an older period is held between them, and is said again later."""
    docs = spark.createDataFrame([
        (1, "T", "x1 a1", D(2024, 1, 1), 2020, 1), (2, "T", "b1 y1", D(2024, 1, 2), 2020, 3),
        (3, "T", "mid", D(2024, 1, 5), 2020, 2), (4, "T", "a1 b1", D(2024, 1, 8), 2020, 4)],
        "doc_id LONG, ticker STRING, content STRING, call_date DATE, year INT, quarter INT")
    cuts = spark.createDataFrame([("T", D(2024, 1, d)) for d in (1, 2, 3, 4, 6, 7, 9)], "ticker STRING, cutoff DATE")
    daily = tfidf.daily_term_counts(docs)
    for vocabulary in (tfidf.fit_vocabulary(daily, cuts, 99, 1, 1.0), tfidf.corpus_vocabulary(docs, cuts, 99, 1, 1.0)):
        rows = {r.term: (r.df, r.corpus_tf) for r in vocabulary.collect()}
        assert rows["a1 b1"] == (3, 3) and rows["mid"] == (3, 3) and rows["a1 mid"] == (3, 3) and rows["a1"] == (6, 7)
        got = {r.cutoff.day for r in tfidf.context_vectors(daily, cuts, vocabulary).where("term = 'a1 b1'").collect()}
        assert got == {3, 4, 9}


def test_repair_plan_collisions(spark):
    files = [("d", "A_2005_Q?.txt", "Operator: first quarter\nPeriod: Q? 2005\n"), ("d", "A_2005_Q.txt", "Q1 x"), ("d", "A_2006_Q1.txt", "ok"),
             ("d", "A_2006_Q?.txt", "Q1 y"), ("d", "bad.txt", "Q1 z"), ("d", "A_2007_Q?.txt", "nothing"), ("e", "A_2006_Q?.txt", "Q1 y")]
    df = spark.createDataFrame(files, "folder STRING, file_name STRING, value STRING")
    got = {(r.folder, r.file_name): r.action for r in TR.repair_plan(df).collect()}
    assert got == {("d", "A_2005_Q?.txt"): "target_exists", ("d", "A_2005_Q.txt"): "fix", ("d", "A_2006_Q?.txt"): "target_exists",
                   ("d", "bad.txt"): "bad_name", ("d", "A_2007_Q?.txt"): "no_quarter", ("e", "A_2006_Q?.txt"): "fix"}


def test_missing_prediction_fails(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "market_ticker STRING")
    probs = spark.createDataFrame([("a", 0.5)], "market_ticker STRING, prob_pos DOUBLE")
    assert [r.market_ticker for r in TR.stale_predictions(rows, probs).collect()] == ["b"]
    with pytest.raises(Exception, match="no prediction for b"):
        TR.attach_predictions(rows, probs).collect()


def test_imputation_and_weights(spark):
    df = spark.createDataFrame([(float("nan"), None, 1), (0.5, 2.0, 0), (0.7, 4.0, 0)], "a DOUBLE, b DOUBLE, mentioned INT")
    got = [tuple(r) for r in models.impute_zero(df, ["a", "b"]).select("a", "b", "was_imputed").collect()]
    assert got == [(0.0, 0.0, 1), (0.5, 2.0, 0), (0.7, 4.0, 0)]
    weights = [r.weight for r in models.balanced_weight(df).collect()]
    assert weights == pytest.approx([1.5, 0.75, 0.75])
    med = {r.name: r.median for r in models.exact_medians(df.where("b is not null"), ["a", "b"]).collect()}
    assert med == {"a": pytest.approx(0.6), "b": 3.0}


def test_platt_solves_the_penalised_objective(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.random((300, 3))
    y = (rng.random(300) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1])))).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)], "tx_prob DOUBLE, open_mid_filled DOUBLE, has_candle DOUBLE, y INT")
    model = models.fit_platt(df, "y", 0.5).stages[-1]
    w = np.zeros(4)
    xb = np.c_[x, np.ones(300)]
    ridge = np.diag([1, 1, 1, 0])
    for _ in range(50):  # Newton on 1/2 |w|^2 + C * log loss
        p = 1 / (1 + np.exp(-xb @ w))
        w -= np.linalg.solve(ridge + 0.5 * xb.T @ (xb * (p * (1 - p))[:, None]), ridge @ w + 0.5 * xb.T @ (p - y))
    assert np.allclose(list(model.coefficients) + [model.intercept], w, atol=1e-4)
