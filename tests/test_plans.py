"""The driver contract and the trained plans on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
from earshot.catalog import ALL as CATALOG  # noqa: E402

CHECKED = sorted(name for name, (_, text) in CATALOG.items() if text is not None)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "hist_rate" in df.columns


def test_constants_tables(spark):
    from earshot.sources import markets

    series, sectors = markets.series_to_stock(spark), markets.stock_sectors(spark)
    assert series.count() == series.select("series_ticker").distinct().count() > 100
    assert sectors.count() == sectors.select("stock_ticker").distinct().count() > 100


def test_held_out_periods_are_not_learned_from(spark, sf_dir):
    parts = {r.part: (r.first_period, r.last_period) for r in entry.queries()["two_stage_periods"](spark, "/root/testdata/sf0.01").collect()}
    assert parts["train"][1] < min(first for part, (first, _) in parts.items() if part != "train")


def test_shared_folder(spark, monkeypatch):
    from earshot import session

    class Cluster:
        conf = spark.conf

        class sparkContext:
            master = "local-cluster[3,2,1024]"

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError, match="checkpoint"):
            session.shared_root(Cluster)
    path = session.scratch_path(spark, "probe")
    assert path.startswith(session.session_folder(spark))
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3


def test_every_query_builds_a_plan_name():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_against_sql(spark, sf_dir, name):
    assert check.compare(entry.queries()[name](spark, sf_dir), check.connect(sf_dir), entry.oracle_sql()[name]) == ""


def test_baselines_per_split(spark, sf_dir):
    from earshot.catalog.history import label_inputs
    from earshot.operators import history, splits
    from earshot.plans import fixtures as X
    from earshot.plans.baselines import run_baselines

    labels = splits.cross_company_split(history.build_labels(X.transcripts(spark, sf_dir), label_inputs(spark, sf_dir)))
    rows = run_baselines(labels).collect()
    assert {(r.model, r.split) for r in rows} == {(m, s) for m in ("majority", "consensus", "buy_all_yes", "hist_freq") for s in ("dev", "test")}
    assert all(r.n == r.n_trades + r.n_skipped_nan_prob for r in rows)


def test_text_features_are_fitted_on_train_only(spark, sf_dir):
    from earshot.catalog.history import label_inputs
    from earshot.operators import history, splits
    from earshot.plans import classical
    from earshot.plans import fixtures as X

    labels = splits.cross_company_split(history.build_labels(X.transcripts(spark, sf_dir), label_inputs(spark, sf_dir)))
    feats, vocab = classical.text_features(labels, X.transcripts(spark, sf_dir), max_features=30)
    only_train, vocab_train = classical.text_features(labels.where("split = 'train'"), X.transcripts(spark, sf_dir), max_features=30)
    assert sorted(map(str, vocab.collect())) == sorted(map(str, vocab_train.collect()))
    assert feats.count() == labels.count() and feats.first().features.size == vocab.count() + 3
    scored = classical.run_classical(feats, c_values=(1.0,), depths=(3,), n_folds=2).collect()
    assert {(r.model, r.split) for r in scored} == {(m, s) for m in ("logreg", "tree") for s in ("dev", "test")}


def test_saved_stage_scores_alike(spark, sf_dir, tmp_path):
    from earshot.catalog import modeling
    from earshot.operators import models
    from earshot.plans import two_stage

    past = modeling.materialize(modeling._moved_history(spark, sf_dir), "history")
    train = two_stage.stage1_rows(past)
    model = two_stage.fit_stage1(train, max_iter=2)
    two_stage.save_stage(model, train, str(tmp_path))
    loaded, medians = two_stage.load_stage(spark, str(tmp_path))
    cols = list(two_stage.TRANSCRIPT_FEATURES)

    def scores(by, fitted):
        rows = models.impute_median(fitted, past, cols)
        return sorted((r.ticker, r.word, r.period_num, r.p) for r in models.positive_probability(by, rows, "p").collect())

    assert scores(model, train) == scores(loaded, medians)


@pytest.mark.parametrize("name", ["boosting_importances", "two_stage_backtest"])
def test_registered_queries_boost_as_many_rounds_as_the_rule(spark, sf_dir, monkeypatch, name):
    from earshot.operators import models

    class Asked(Exception):
        pass

    def asked(**options):
        raise Asked(options["maxIter"])

    monkeypatch.setattr(models, "GBTClassifier", asked)
    with pytest.raises(Asked, match="^500$"):
        entry.queries()[name](spark, sf_dir)
