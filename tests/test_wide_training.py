"""Text features and training tables of wide rows."""

import datetime as dt

import pytest
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql.types import StructType

from earshot.operators import models, tfidf

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def vocabulary(spark):
    # Positions in two slices.
    return spark.createDataFrame([("aa", 0, 1.5), ("bb", 1, 2.0), ("cc", tfidf.SLICE, 1.0)], "term STRING, pos INT, idf DOUBLE")


@pytest.fixture(scope="module")
def daily(spark):
    counts = [("T", 0, "aa", 2), ("T", 0, "bb", 1), ("T", 2, "aa", 1), ("T", 2, "bb", -1), ("T", 3, "cc", 4), ("U", 1, "cc", 1), ("V", None, "aa", 1), ("T", 1, "other", 3)]
    return spark.createDataFrame([(t, None if d is None else DAY + dt.timedelta(d), w, n) for t, d, w, n in counts], "ticker STRING, call_date DATE, term STRING, cnt LONG")


@pytest.fixture(scope="module")
def rows(spark):
    cutoffs = [("T", d) for d in (0, 1, 2, 3, 4, 4)] + [("U", 1), ("U", 2), ("V", 9), ("W", 9), ("T", None), (None, 2)]
    return spark.createDataFrame([(f"M{i}", t, None if d is None else DAY + dt.timedelta(d), 0.5) for i, (t, d) in enumerate(cutoffs)],
                                 "market_ticker STRING, ticker STRING, cutoff DATE, implied_prob DOUBLE")


def _weights(daily, rows, vocabulary):
    found = tfidf.context_vectors(daily, rows, vocabulary).join(vocabulary.select("term", "pos"), "term").collect()
    return {(r.ticker, r.cutoff, r.pos): r.weight for r in found}


def test_arrays_hold_the_weights_of_every_context(daily, rows, vocabulary):
    arrays = tfidf.context_arrays(daily, rows, vocabulary).collect()
    got = {(r.ticker, r.cutoff, i): w for r in arrays for i, w in zip(r.indices, r["values"], strict=True)}
    assert got == pytest.approx(_weights(daily, rows, vocabulary)) and len(got) == 8
    assert all(r.indices == sorted(r.indices) for r in arrays)
    assert len(arrays) == rows.select("ticker", "cutoff").distinct().count()


def test_every_row_gets_one_vector_and_no_weight_passes_through_python(daily, rows, vocabulary):
    size = tfidf.SLICE + 1
    made = models.with_text_features(rows, tfidf.context_arrays(daily, rows, vocabulary), size, ["implied_prob"])
    want = _weights(daily, rows, vocabulary)
    got = made.collect()
    assert len(got) == rows.count()
    for r in got:
        assert r.features.size == size + 1 and r.features[size] == 0.5
        assert {i: r.features[i] for i in range(size) if r.features[i]} == pytest.approx({p: w for (t, c, p), w in want.items() if (t, c) == (r.ticker, r.cutoff)})
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()


def test_few_wide_rows_are_spread_over_tasks(spark):
    schema = StructType().add("key", "integer").add("features", VectorUDT())
    wide = spark.createDataFrame([(i, SparseVector(models.ELEMENTS_PER_TASK // 10, {i: 1.0})) for i in range(40)], schema)
    data, n = models._training_table(wide)
    assert n == 40 and data.rdd.getNumPartitions() == 4
    data.unpersist()
    narrow, _ = models._training_table(wide.select("key"))
    assert narrow.rdd.getNumPartitions() == 1
    narrow.unpersist()


def test_first_best_depth_wins(spark):
    rows = spark.createDataFrame([(i % 2, float(i % 2)) for i in range(40)], "mentioned INT, x DOUBLE")
    data = models.assemble(rows, ["x"])
    model, depth = models.train_tree(data, data, depths=(2, 4, None))
    assert depth == 2 and model.depth == 1
