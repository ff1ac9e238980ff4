"""Metric, split, sweep and results-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from earshot.catalog.base import sql, tidy
from earshot.catalog.history import HITS_CTE, SEEN_CTE, label_inputs
from earshot.functions import trading
from earshot.operators import history, metrics, ranking, splits, sweeps, transcripts
from earshot.plans import fixtures as X
from earshot.session import materialize


def confusion_matrix(spark, sf):
    return tidy(metrics.confusion_counts(X.scores(spark, sf)))


CONFUSION_CTE = """,
c AS (SELECT CAST(count(*) FILTER (mentioned = 0 AND pred = 0) AS DOUBLE) AS tn, CAST(count(*) FILTER (mentioned = 0 AND pred = 1) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (mentioned = 1 AND pred = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (mentioned = 1 AND pred = 1) AS DOUBLE) AS tp
             {group} FROM {source}),
k AS (SELECT *, tn + fp + fn + tp AS n, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision_pos,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall_pos, CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END AS precision_neg,
             CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS recall_neg,
             CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1_pos,
             CASE WHEN 2 * tn + fp + fn > 0 THEN 2 * tn / (2 * tn + fp + fn) ELSE 0 END AS f1_neg FROM c)"""

METRIC_COLS = """CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp, CAST(n AS BIGINT) AS n,
       round((tn + tp) / n, 6) AS accuracy, round((f1_pos + f1_neg) / 2, 6) AS f1_macro,
       round((f1_pos * (tp + fn) + f1_neg * (tn + fp)) / n, 6) AS f1_weighted, round(precision_pos, 6) AS precision_pos,
       round(recall_pos, 6) AS recall_pos, round(f1_pos, 6) AS f1_pos, round(precision_neg, 6) AS precision_neg,
       round(recall_neg, 6) AS recall_neg, round(f1_neg, 6) AS f1_neg"""


def classification_metrics(spark, sf):
    return tidy(metrics.classification_metrics(X.scores(spark, sf)))


def roi_backtest(spark, sf):
    return tidy(metrics.roi_backtest(X.scores(spark, sf)))


ROI_COLS = """count(*) FILTER (implied_prob IS NOT NULL) AS n_trades, count(*) FILTER (implied_prob IS NOT NULL AND pred = mentioned) AS n_correct,
       round(avg(CASE WHEN pred = mentioned THEN 1.0 ELSE 0.0 END) FILTER (implied_prob IS NOT NULL), 6) AS accuracy_trades,
       round(sum(pnl), 6) + 0.0 AS total_pnl, round(avg(pnl), 6) + 0.0 AS roi_per_trade, round(avg(stake), 6) AS avg_stake,
       count(*) FILTER (implied_prob IS NULL) AS n_skipped_nan_prob"""

ROI_CTE = """,
st AS (SELECT *, CASE WHEN pred = 1 THEN implied_prob ELSE 1.0::DOUBLE - implied_prob END AS stake FROM {source}),
z AS (SELECT *, CASE WHEN pred = mentioned THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END - stake - 0.03::DOUBLE AS pnl FROM st)"""


def _baseline_rows(spark, sf):
    """History rate rows and the predictions of all four baselines."""
    from earshot.plans.baselines import baseline_predictions

    labels = materialize(history.build_labels(X.transcripts(spark, sf), label_inputs(spark, sf)), "labels")
    return baseline_predictions(labels, labels, labels)


def baseline_metrics(spark, sf):
    return tidy(metrics.classification_metrics(_baseline_rows(spark, sf), by=("model",)))


def baseline_roi(spark, sf):
    return tidy(metrics.roi_backtest(_baseline_rows(spark, sf), by=("model",)))


BASELINE_CTE = HITS_CTE + """,
lab AS (SELECT m.*, hist_rate FROM m LEFT JOIN rates r ON r.ticker = m.ticker AND r.w = lower(m.word) AND r.cutoff = m.cutoff),
grid AS (SELECT round(i * 0.05, 2)::DOUBLE AS th FROM range(20) x(i)),
sweep AS (SELECT th, CAST(count(*) FILTER (mentioned = 0 AND NOT y) AS DOUBLE) AS tn, CAST(count(*) FILTER (mentioned = 0 AND y) AS DOUBLE) AS fp,
                 CAST(count(*) FILTER (mentioned = 1 AND NOT y) AS DOUBLE) AS fn, CAST(count(*) FILTER (mentioned = 1 AND y) AS DOUBLE) AS tp
          FROM (SELECT th, mentioned, coalesce(hist_rate, 0) > th AS y FROM lab, grid) GROUP BY th),
f1 AS (SELECT *, (CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END
                  + CASE WHEN 2 * tn + fp + fn > 0 THEN 2 * tn / (2 * tn + fp + fn) ELSE 0 END) / 2 AS f1_macro FROM sweep),
best AS (SELECT th FROM f1 ORDER BY f1_macro DESC, th LIMIT 1),
major AS (SELECT mentioned FROM lab GROUP BY mentioned ORDER BY count(*) DESC, mentioned LIMIT 1),
bp AS (SELECT lab.*, 'majority' AS model, (SELECT mentioned FROM major) AS pred FROM lab
       UNION ALL SELECT lab.*, 'consensus', CASE WHEN implied_prob > 0.5 THEN 1 ELSE 0 END FROM lab
       UNION ALL SELECT lab.*, 'buy_all_yes', 1 FROM lab
       UNION ALL SELECT lab.*, 'hist_freq', CASE WHEN coalesce(hist_rate, 0) > (SELECT th FROM best) THEN 1 ELSE 0 END FROM lab)"""


def _protocol(spark, sf, uncertain_only):
    """Baselines by the book: fitted on train, tuned on dev, scored on dev and test companies."""
    from earshot.plans.baselines import run_baselines

    labels = history.build_labels(X.transcripts(spark, sf), label_inputs(spark, sf))
    rows = run_baselines(materialize(splits.cross_company_split(labels), "labels"), uncertain_only)
    return tidy(rows.select("model", "split", "n", "tn", "fp", "fn", "tp", "f1_macro", "n_trades", "n_correct", "total_pnl"))


def baseline_protocol(spark, sf):
    return _protocol(spark, sf, False)


def baseline_protocol_uncertain(spark, sf):
    """Tuning is never restricted; only rows priced in the uncertain band are scored."""
    return _protocol(spark, sf, True)


def _protocol_sql(only):
    parts = BASELINE_CTE.removeprefix(HITS_CTE)
    parts = parts.replace("lab AS (SELECT m.*, hist_rate FROM m LEFT JOIN", "lab AS (SELECT m.*, hist_rate, split FROM m JOIN split ON split.ticker = m.ticker LEFT JOIN")
    parts = parts.replace("> th AS y FROM lab, grid)", "> th AS y FROM lab, grid WHERE split = 'dev')")
    parts = parts.replace("SELECT mentioned FROM lab GROUP BY", "SELECT mentioned FROM lab WHERE split = 'train' GROUP BY")
    scored = f"(SELECT * FROM bp WHERE split IN ('dev', 'test') AND {only}) q"
    return sql(X.MARKETS_SQL + HITS_CTE + SPLIT_CTE + parts + ROI_CTE.format(source=scored), """,
k AS (SELECT model, split, count(*) AS n, count(*) FILTER (mentioned = 0 AND pred = 0) AS tn, count(*) FILTER (mentioned = 0 AND pred = 1) AS fp,
             count(*) FILTER (mentioned = 1 AND pred = 0) AS fn, count(*) FILTER (mentioned = 1 AND pred = 1) AS tp,
             count(*) FILTER (implied_prob IS NOT NULL) AS n_trades, count(*) FILTER (implied_prob IS NOT NULL AND pred = mentioned) AS n_correct,
             round(coalesce(sum(pnl), 0), 6) + 0.0 AS total_pnl FROM z GROUP BY model, split)
SELECT model, split, n, tn, fp, fn, tp, n_trades, n_correct, total_pnl,
       round((CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END
              + CASE WHEN 2 * tn + fp + fn > 0 THEN 2.0 * tn / (2 * tn + fp + fn) ELSE 0 END) / 2, 6) AS f1_macro FROM k""")


def history_threshold_sweep(spark, sf):
    labels = history.build_labels(X.transcripts(spark, sf), label_inputs(spark, sf))
    return tidy(sweeps.history_threshold_sweep(labels).select("threshold", "tn", "fp", "fn", "tp", "f1_macro"))


def best_history_threshold(spark, sf):
    labels = history.build_labels(X.transcripts(spark, sf), label_inputs(spark, sf))
    return tidy(sweeps.best_history_threshold(labels))


def majority_class(spark, sf):
    from earshot.plans.baselines import majority_class as majority

    return tidy(majority(X.markets(spark, sf)))


def brier_skill(spark, sf):
    return tidy(metrics.brier_skill(X.scores(spark, sf), "prob_pos", "mentioned"))


def roc_auc(spark, sf):
    return tidy(metrics.roc_auc(X.scores(spark, sf), "prob_pos", "mentioned"))


def _seen(spark, sf):
    rows = X.scores(spark, sf).select("market_ticker", "ticker", "word", "cutoff", "mentioned", "prob_pos", "pred")
    return history.seen_before(X.transcripts(spark, sf), rows)


def seen_word_errors(spark, sf):
    return tidy(metrics.seen_summary(_seen(spark, sf)).drop("mean_pred"))


SEEN_ERRORS_SQL = sql(X.SCORES_SQL + SEEN_CTE, """
, e AS (SELECT word_seen_before AS w, mentioned AS y, prob_pos, CASE WHEN pred = mentioned THEN 1 ELSE 0 END AS ok
        FROM s LEFT JOIN seen ON seen.market_ticker = s.market_ticker),
g AS (SELECT w, NULL AS y, 1 AS all_labels, count(*) AS n, avg(y) AS base, avg(prob_pos) AS mp, avg(ok) AS acc FROM e GROUP BY w
      UNION ALL SELECT w, y, 0, count(*), avg(y), avg(prob_pos), avg(ok) FROM e GROUP BY w, y)
SELECT CAST(w AS BIGINT) AS word_seen_before, CAST(y AS BIGINT) AS mentioned, all_labels, n, round(base, 6) AS base_rate_mentioned,
       round(mp, 6) AS mean_prob_pos, round(acc, 6) AS accuracy, round(1 - acc, 6) AS err_rate FROM g""")


def recall_by_seen(spark, sf):
    """Recall on positives, seen and unseen words apart."""
    pos = _seen(spark, sf).where("mentioned = 1")
    return tidy(pos.groupBy("word_seen_before").agg(
        F.count(F.lit(1)).alias("n"), F.avg("pred").alias("recall"), F.avg("prob_pos").alias("mean_prob_pos")))


RECALL_SQL = sql(X.SCORES_SQL + SEEN_CTE, """
SELECT CAST(word_seen_before AS BIGINT) AS word_seen_before, count(*) AS n, round(avg(pred), 6) AS recall, round(avg(prob_pos), 6) AS mean_prob_pos
FROM s LEFT JOIN seen ON seen.market_ticker = s.market_ticker WHERE mentioned = 1 GROUP BY 1""")


def ticker_errors(spark, sf):
    return tidy(metrics.ticker_errors(X.scores(spark, sf)))


def worst_errors(spark, sf):
    top = metrics.worst_errors(X.scores(spark, sf), 20)
    return tidy(top.select("market_ticker", "ticker", "word", "mentioned", "pred", "prob_pos", "implied_prob", "confidence"))


def prediction_confidence(spark, sf):
    p = F.col("prob_pos")
    return tidy(X.scores(spark, sf).select(
        "market_ticker", trading.predicted(p).alias("pred"), trading.prediction_confidence(p).alias("confidence")))


def attach_predictions(spark, sf):
    s = X.scores(spark, sf)
    rows = s.select("market_ticker", "mentioned")
    return tidy(transcripts.attach_predictions(rows, s.select("market_ticker", "prob_pos")))


def stale_predictions(spark, sf):
    """Predictions of active markets are missing on purpose."""
    s = X.scores(spark, sf)
    return tidy(transcripts.stale_predictions(s, s.where("status <> 'active'").select("market_ticker", "prob_pos")))


def compare_models(spark, sf):
    s = X.scores(spark, sf)
    right = s.select("market_ticker", F.coalesce(F.col("implied_prob") > 0.5, F.lit(False)).cast("int").alias("pred"))
    return tidy(metrics.compare_models(s, right))


COMPARE_SQL = sql(X.SCORES_SQL, """
, j AS (SELECT mentioned, implied_prob, pred AS l, CASE WHEN implied_prob > 0.5 THEN 1 ELSE 0 END AS r FROM s)
SELECT CAST(mentioned AS BIGINT) AS mentioned, count(*) AS n, count(*) FILTER (l = mentioned AND r = mentioned) AS both_right,
       count(*) FILTER (l = mentioned AND r <> mentioned) AS only_left_right, count(*) FILTER (l <> mentioned AND r = mentioned) AS only_right_right,
       count(*) FILTER (l <> mentioned AND r <> mentioned) AS both_wrong,
       count(*) FILTER ((l = 1) = (implied_prob > 0.5)) AS left_agrees_with_market
FROM j GROUP BY mentioned""")

LOG_ORDER = ["timestamp", "run_id", "run_line"]


def latest_results(spark, sf):
    out = ranking.keep_last(X.experiments(spark, sf), ["model", "split"], LOG_ORDER)
    return tidy(out.withColumn("timestamp", F.to_date("timestamp")))


def results_by_split(spark, sf):
    """Latest results, best first inside each split."""
    out = metrics.latest_results(X.experiments(spark, sf), LOG_ORDER)
    return tidy(out.select("model", "split", "f1_macro", "n").orderBy("split", F.col("f1_macro").desc()))


LATEST_CTE = """,
l AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY model, split ORDER BY "timestamp" DESC, run_id DESC, run_line DESC) = 1)"""


def model_comparison(spark, sf):
    return tidy(metrics.comparison_table(X.experiments(spark, sf), "f1_macro", ["F", "O"], LOG_ORDER))


def company_splits(spark, sf):
    return tidy(splits.company_splits(X.markets(spark, sf)))


SPLIT_CTE = """,
tick AS (SELECT ticker, row_number() OVER (ORDER BY md5('42:' || ticker), ticker) - 1 AS pos, count(*) OVER () AS total
         FROM (SELECT DISTINCT ticker FROM m)),
split AS (SELECT ticker, CASE WHEN pos < floor(total * 0.7::DOUBLE) THEN 'train'
                              WHEN pos < floor(total * 0.7::DOUBLE) + floor(total * 0.15::DOUBLE) THEN 'dev' ELSE 'test' END AS split FROM tick)"""


def cross_company_split(spark, sf):
    return tidy(splits.cross_company_split(X.markets(spark, sf).select("market_ticker", "ticker")))


def split_sizes(spark, sf):
    return tidy(splits.split_sizes(splits.cross_company_split(X.markets(spark, sf))))


def split_leaks(spark, sf):
    """No company may be in two splits: always empty."""
    return tidy(splits.leaking_companies(splits.cross_company_split(X.markets(spark, sf))))


def seeded_company_splits(spark, sf):
    return tidy(splits.seeded_company_splits(X.markets(spark, sf)))


def stratified_folds(spark, sf):
    rows = X.markets(spark, sf).select("market_ticker", "mentioned")
    return tidy(splits.stratified_folds(rows, "mentioned", "market_ticker"))


def temporal_split(spark, sf):
    rows = X.transcripts(spark, sf).select("doc_id", "year", "period_num")
    return tidy(splits.temporal_split(rows).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids")))


def smoke_subset(spark, sf):
    rows = X.markets(spark, sf).select("market_ticker", "ticker")
    return tidy(ranking.smoke_subset(rows, 32, 0, "market_ticker"))


def recency_weights(spark, sf):
    from earshot.operators.models import recency_weight

    t = X.transcripts(spark, sf)
    return tidy(recency_weight(t.select("doc_id", "year")))


def numeric_features(spark, sf):
    """Zero-imputed model inputs and how many rows needed it."""
    from earshot.operators.models import impute_zero

    labels = history.build_labels(X.transcripts(spark, sf), label_inputs(spark, sf))
    return tidy(impute_zero(labels, ["implied_prob", "hist_rate", "in_recent_news"]).select(
        "market_ticker", "implied_prob", "hist_rate", "in_recent_news", "was_imputed"))


QUERIES = {
    "confusion_matrix": (confusion_matrix, sql(X.SCORES_SQL + CONFUSION_CTE.format(group="", source="s"), """
SELECT CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp FROM c""")),
    "classification_metrics": (classification_metrics, sql(
        X.SCORES_SQL + CONFUSION_CTE.format(group="", source="s"), f"SELECT {METRIC_COLS} FROM k")),
    "roi_backtest": (roi_backtest, sql(X.SCORES_SQL + ROI_CTE.format(source="s"), f"SELECT {ROI_COLS} FROM z")),
    "baseline_metrics": (baseline_metrics, sql(
        X.MARKETS_SQL + BASELINE_CTE + CONFUSION_CTE.format(group=", model", source="bp GROUP BY model"), f"SELECT model, {METRIC_COLS} FROM k")),
    "baseline_roi": (baseline_roi, sql(
        X.MARKETS_SQL + BASELINE_CTE + ROI_CTE.format(source="bp"), f"SELECT model, {ROI_COLS} FROM z GROUP BY model")),
    "baseline_protocol": (baseline_protocol, _protocol_sql("TRUE")),
    "baseline_protocol_uncertain": (baseline_protocol_uncertain, _protocol_sql("implied_prob BETWEEN 0.2 AND 0.8")),
    "history_threshold_sweep": (history_threshold_sweep, sql(X.MARKETS_SQL + BASELINE_CTE, """
SELECT round(th, 6) AS threshold, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp,
       round(f1_macro, 6) AS f1_macro FROM f1""")),
    "best_history_threshold": (best_history_threshold, sql(X.MARKETS_SQL + BASELINE_CTE, """
SELECT round(th, 6) AS threshold, round(f1_macro, 6) AS f1_macro FROM f1 ORDER BY f1.f1_macro DESC, th LIMIT 1""")),
    "majority_class": (majority_class, sql(X.MARKETS_SQL, """
SELECT CAST(mentioned AS BIGINT) AS majority_class, count(*) AS n FROM m GROUP BY mentioned ORDER BY n DESC, mentioned LIMIT 1""")),
    "brier_skill": (brier_skill, sql(X.SCORES_SQL, """
, a AS (SELECT avg(pow(prob_pos - mentioned, 2)) AS b, avg(mentioned) AS r, avg(prob_pos) AS mp FROM s)
SELECT round(b, 6) AS brier, round(r * (1 - r), 6) AS baseline_brier, round(1 - b / (r * (1 - r)), 6) AS skill,
       round(mp, 6) AS mean_prob, round(r, 6) AS actual_rate FROM a""")),
    "roc_auc": (roc_auc, sql(X.SCORES_SQL, """
, pos AS (SELECT prob_pos AS p FROM s WHERE mentioned = 1), neg AS (SELECT prob_pos AS p FROM s WHERE mentioned = 0)
SELECT (SELECT count(*) FROM pos) AS n_pos, (SELECT count(*) FROM neg) AS n_neg,
       round(avg(CASE WHEN pos.p > neg.p THEN 1.0 WHEN pos.p = neg.p THEN 0.5 ELSE 0.0 END), 6) AS auc FROM pos, neg""")),
    "seen_word_errors": (seen_word_errors, SEEN_ERRORS_SQL),
    "recall_by_seen": (recall_by_seen, RECALL_SQL),
    "ticker_errors": (ticker_errors, sql(X.SCORES_SQL, """
SELECT ticker, count(*) AS n, round(avg(CASE WHEN pred = mentioned THEN 1 ELSE 0 END), 6) AS accuracy,
       count(*) FILTER (pred <> mentioned) AS n_errors, round(avg(prob_pos), 6) AS mean_prob_pos,
       round(avg(mentioned), 6) AS base_rate_mentioned FROM s GROUP BY ticker""")),
    "worst_errors": (worst_errors, sql(X.SCORES_SQL, """
SELECT market_ticker, ticker, word, CAST(mentioned AS BIGINT) AS mentioned, CAST(pred AS BIGINT) AS pred, prob_pos, implied_prob,
       round(CASE WHEN pred = 1 THEN prob_pos ELSE 1 - prob_pos END, 6) AS confidence FROM s WHERE pred <> mentioned
ORDER BY CASE WHEN pred = 1 THEN prob_pos ELSE 1 - prob_pos END DESC, market_ticker LIMIT 20""")),
    "prediction_confidence": (prediction_confidence, sql(X.SCORES_SQL, """
SELECT market_ticker, CAST(pred AS BIGINT) AS pred, round(CASE WHEN pred = 1 THEN prob_pos ELSE 1 - prob_pos END, 6) AS confidence FROM s""")),
    "attach_predictions": (attach_predictions, sql(X.SCORES_SQL, """
SELECT market_ticker, CAST(mentioned AS BIGINT) AS mentioned, prob_pos, CAST(pred AS BIGINT) AS pred FROM s""")),
    "stale_predictions": (stale_predictions, sql(X.SCORES_SQL, """
SELECT market_ticker, 1 AS in_rows, CAST(NULL AS BIGINT) AS in_probs FROM s WHERE status = 'active'""")),
    "compare_models": (compare_models, COMPARE_SQL),
    "latest_results": (latest_results, sql(X.EXPERIMENTS_SQL + LATEST_CTE, """
SELECT model, split, CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS "timestamp", run_id, CAST(run_line AS BIGINT) AS run_line,
       round(f1_macro, 6) AS f1_macro, round(roi_per_trade, 6) AS roi_per_trade, n FROM l""")),
    "results_by_split": (results_by_split, sql(X.EXPERIMENTS_SQL + LATEST_CTE, "SELECT model, split, round(f1_macro, 6) AS f1_macro, n FROM l")),
    "model_comparison": (model_comparison, sql(X.EXPERIMENTS_SQL + LATEST_CTE, """
SELECT model, round(max(f1_macro) FILTER (split = 'F'), 6) AS "F", round(max(f1_macro) FILTER (split = 'O'), 6) AS "O" FROM l GROUP BY model""")),
    "company_splits": (company_splits, sql(X.MARKETS_SQL + SPLIT_CTE, "SELECT ticker, split FROM split")),
    "cross_company_split": (cross_company_split, sql(X.MARKETS_SQL + SPLIT_CTE, """
SELECT market_ticker, m.ticker, split FROM m JOIN split ON split.ticker = m.ticker""")),
    "split_sizes": (split_sizes, sql(X.MARKETS_SQL + SPLIT_CTE, """
SELECT split, count(*) AS n_rows, count(DISTINCT m.ticker) AS n_companies FROM m JOIN split ON split.ticker = m.ticker GROUP BY split""")),
    "split_leaks": (split_leaks, sql(X.MARKETS_SQL + SPLIT_CTE, """
SELECT m.ticker, count(DISTINCT split) AS n_splits FROM m JOIN split ON split.ticker = m.ticker GROUP BY m.ticker HAVING count(DISTINCT split) > 1""")),
    # The twenty companies of the test tables in the order of the seeded shuffle.
    "seeded_company_splits": (seeded_company_splits, """
SELECT ticker, split FROM (VALUES
    ('SRC9', 'train'),
    ('SRC13', 'train'),
    ('SRC4', 'train'),
    ('SRC12', 'train'),
    ('SRC17', 'train'),
    ('SRC3', 'train'),
    ('SRC5', 'train'),
    ('SRC8', 'train'),
    ('SRC14', 'train'),
    ('SRC2', 'train'),
    ('SRC7', 'train'),
    ('SRC18', 'train'),
    ('SRC1', 'train'),
    ('SRC19', 'train'),
    ('SRC10', 'dev'),
    ('SRC6', 'dev'),
    ('SRC15', 'dev'),
    ('SRC16', 'test'),
    ('SRC0', 'test'),
    ('SRC11', 'test')) v(ticker, split)"""),
    "stratified_folds": (stratified_folds, sql(X.MARKETS_SQL, """
SELECT market_ticker, CAST(mentioned AS BIGINT) AS mentioned,
       (row_number() OVER (PARTITION BY mentioned ORDER BY md5('42:' || market_ticker), market_ticker) - 1) % 5 AS fold FROM m""")),
    "temporal_split": (temporal_split, sql(X.TRANSCRIPTS_SQL, """
SELECT CASE WHEN year < 2024 THEN 'train' WHEN period_num IN (8101, 8102, 8103) THEN 'val'
            WHEN period_num IN (8104, 8105, 8106, 8107, 8108) THEN 'test' END AS split, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids
FROM t GROUP BY 1""")),
    "smoke_subset": (smoke_subset, sql(X.MARKETS_SQL, """
SELECT market_ticker, ticker FROM m ORDER BY md5('0:' || market_ticker), market_ticker LIMIT 32""")),
    "recency_weights": (recency_weights, sql(X.TRANSCRIPTS_SQL, """
SELECT doc_id, CAST(year AS BIGINT) AS year, round(pow(0.75::DOUBLE, (SELECT max(year) FROM t) - year), 6) AS weight FROM t""")),
    "numeric_features": (numeric_features, sql(X.MARKETS_SQL + BASELINE_CTE, """
SELECT market_ticker, coalesce(round(implied_prob, 6), 0) AS implied_prob, coalesce(round(hist_rate, 6), 0) AS hist_rate,
       0.0::DOUBLE AS in_recent_news, CAST(CASE WHEN implied_prob IS NULL OR hist_rate IS NULL THEN 1 ELSE 0 END AS BIGINT) AS was_imputed FROM lab""")),
}
