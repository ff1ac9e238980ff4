"""Price, edge, stake, sweep and recommendation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from earshot.catalog.base import sql, tidy
from earshot.functions import trading
from earshot.operators import market_facts, models, sweeps
from earshot.plans import fixtures as X
from earshot.plans.recommender import rank_recommendations, score_quotes, with_consensus
from earshot.sources.markets import with_live_mids


def candle_fill(spark, sf):
    return tidy(models.with_candle(X.priced_scores(spark, sf)).select("market_ticker", "open_mid_filled", "has_candle"))


def live_mids(spark, sf):
    q = with_live_mids(X.quotes(spark, sf))
    return tidy(q.select("event_id", "live_open_mid", "live_current_mid", "live_momentum", "has_prior_session"))


LIVE_CTE = """,
lv AS (SELECT *, CASE WHEN prev_bid > 0 OR prev_ask > 0 THEN 1 ELSE 0 END AS hp,
              CASE WHEN prev_bid > 0 OR prev_ask > 0 THEN (prev_bid + prev_ask) / 2 ELSE (yes_bid + yes_ask) / 2 END AS om,
              (yes_bid + yes_ask) / 2 AS cm,
              CASE WHEN prev_bid > 0 OR prev_ask > 0 THEN (yes_bid + yes_ask) / 2 - (prev_bid + prev_ask) / 2 ELSE 0.0::DOUBLE END AS mo,
              CAST((event_id * 37) % 101 AS DOUBLE) / 100 AS tx,
              (CAST((event_id * 37) % 101 AS DOUBLE) / 100 + CASE WHEN prev_bid > 0 OR prev_ask > 0 THEN (prev_bid + prev_ask) / 2 ELSE (yes_bid + yes_ask) / 2 END) / 2 AS kp
       FROM q),
ed AS (SELECT *, kp - yes_ask AS ey, (1 - kp) - no_ask AS en FROM lv),
kl AS (SELECT *, least(greatest(ey / (1 - least(greatest(yes_ask, 0.01::DOUBLE), 0.99::DOUBLE)) * 0.25::DOUBLE, 0.0::DOUBLE), 0.1::DOUBLE) AS ky,
              least(greatest(en / least(greatest(no_ask, 0.01::DOUBLE), 0.99::DOUBLE) * 0.25::DOUBLE, 0.0::DOUBLE), 0.1::DOUBLE) AS kn,
              CASE WHEN hp <> 1 THEN 'NONE' WHEN abs(mo) > 0.2::DOUBLE THEN 'SPIKE' WHEN mo > 0.1::DOUBLE THEN 'TRENDING_YES'
                   WHEN mo < -0.1::DOUBLE THEN 'TRENDING_NO' ELSE 'NONE' END AS mf FROM ed),
rc AS (SELECT *, CASE
         WHEN tx < 0.05::DOUBLE THEN 'PASS/NO_HISTORY' WHEN volume < 10 AND hp = 0 THEN 'PASS/ILLIQUID'
         WHEN ey >= en AND ey > 0.05::DOUBLE THEN CASE WHEN kp <= 0.5 OR om <= 0.5 THEN 'PASS/DISAGREE_WITH_CROWD' WHEN mf = 'TRENDING_NO' THEN 'PASS/MOMENTUM_CONFLICT'
              ELSE 'BUY_YES/' || CASE WHEN ey > 0.15::DOUBLE THEN 'HIGH' WHEN ey > 0.1::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END END
         WHEN en > 0.05::DOUBLE THEN CASE WHEN kp >= 0.5 OR om >= 0.5 THEN 'PASS/DISAGREE_WITH_CROWD' WHEN mf = 'TRENDING_YES' THEN 'PASS/MOMENTUM_CONFLICT'
              ELSE 'BUY_NO/' || CASE WHEN en > 0.15::DOUBLE THEN 'HIGH' WHEN en > 0.1::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END END
         ELSE 'PASS/LOW_EDGE' END AS verdict FROM kl),
rec AS (SELECT *, split_part(verdict, '/', 1) AS recommendation, split_part(verdict, '/', 2) AS confidence,
               CASE WHEN verdict LIKE 'BUY_YES%' THEN ky WHEN verdict LIKE 'BUY_NO%' THEN kn ELSE 0.0::DOUBLE END AS kelly FROM rc)"""


def scored_quotes(spark, sf):
    """Quotes with a text probability; the final probability averages it with the open mid."""
    q = with_live_mids(X.quotes(spark, sf)).withColumn("tx_prob", ((F.col("event_id") * 37) % 101) / 100.0)
    return q.withColumn("final_prob", (F.col("tx_prob") + F.col("live_open_mid")) / 2)


def live_edges(spark, sf):
    out = score_quotes(scored_quotes(spark, sf))
    return tidy(out.select("event_id", "edge_yes", "edge_no", "kelly_yes", "kelly_no", "momentum_flag"))


def recommendations(spark, sf):
    out = score_quotes(scored_quotes(spark, sf))
    return tidy(out.select("event_id", "market_ticker", "recommendation", "confidence", "kelly"))


def company_consensus(spark, sf):
    out = with_consensus(score_quotes(scored_quotes(spark, sf)))
    return tidy(out.select("event_id", "stock_ticker", "consensus_yes", "consensus_no", "n_markets"))


def ranked_buys(spark, sf):
    out = rank_recommendations(score_quotes(scored_quotes(spark, sf)), "BUY_YES")
    return tidy(out.select("event_id", "edge_yes", "kelly"))


def ranked_buy_no(spark, sf):
    out = rank_recommendations(score_quotes(scored_quotes(spark, sf)), "BUY_NO")
    return tidy(out.select("event_id", "edge_no", "kelly"))


def reason_histogram(spark, sf):
    return tidy(market_facts.reason_histogram(score_quotes(scored_quotes(spark, sf))))


def display_rounding(spark, sf):
    q = X.quotes(spark, sf)
    return tidy(q.select("event_id", trading.display_round(F.col("volume"), 1).alias("volume")))


def backtest_edges(spark, sf):
    """Edge, stake and profit of both sides on every priced market."""
    p, m, y = F.col("daily_open_mid"), F.col("final_prob"), F.col("market_yes")
    rows = X.priced_scores(spark, sf).where(p.isNotNull())
    ey, en = trading.edge_yes(m, p), trading.edge_no(m, 1 - p)
    ky, kn = trading.kelly_yes(ey, p), trading.kelly_no(en, p)
    return tidy(rows.select(
        "market_ticker", ey.alias("edge_yes"), en.alias("edge_no"), ky.alias("kelly_yes"), kn.alias("kelly_no"),
        trading.pnl_yes(ky, p, y == 1).alias("pnl_yes"), trading.pnl_no(kn, p, y == 0).alias("pnl_no"),
    ))


BT_CTE = """,
b0 AS (SELECT market_ticker, market_yes AS y, daily_open_mid AS p, final_prob AS m, final_prob - daily_open_mid AS ey,
              (1 - final_prob) - (1 - daily_open_mid) AS en FROM p WHERE daily_open_mid IS NOT NULL),
b1 AS (SELECT *, least(greatest(ey / least(greatest(1 - p, 0.01::DOUBLE), 0.99::DOUBLE) * 0.25::DOUBLE, 0.0::DOUBLE), 0.1::DOUBLE) AS ky,
              least(greatest(en / least(greatest(p, 0.01::DOUBLE), 0.99::DOUBLE) * 0.25::DOUBLE, 0.0::DOUBLE), 0.1::DOUBLE) AS kn FROM b0),
b2 AS (SELECT *, CASE WHEN y = 1 THEN ky * (1 - p) ELSE -ky * p END AS py, CASE WHEN y = 0 THEN kn * p ELSE -kn * (1 - p) END AS pn FROM b1),
yes_bets AS (SELECT *, ey AS e, ky AS k, py AS pnl, CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END AS won FROM b2 WHERE m > 0.5 AND p > 0.5),
no_bets AS (SELECT *, en AS e, kn AS k, pn AS pnl, CASE WHEN y = 0 THEN 1.0 ELSE 0.0 END AS won FROM b2 WHERE m < 0.5 AND p < 0.5)"""

SWEEP_CTE = BT_CTE + """,
th AS (SELECT unnest([0.03, 0.05, 0.08, 0.10, 0.12, 0.15])::DOUBLE AS threshold),
sw AS (SELECT threshold, (SELECT count(*) FROM yes_bets WHERE e > threshold) AS n_yes, (SELECT count(*) FROM no_bets WHERE e > threshold) AS n_no,
              (SELECT avg(won) FROM yes_bets WHERE e > threshold) AS win_yes, (SELECT avg(won) FROM no_bets WHERE e > threshold) AS win_no,
              (SELECT coalesce(sum(pnl), 0) FROM yes_bets WHERE e > threshold) AS pnl_yes, (SELECT coalesce(sum(pnl), 0) FROM no_bets WHERE e > threshold) AS pnl_no
       FROM th)"""


def edge_threshold_sweep(spark, sf):
    return tidy(sweeps.edge_threshold_sweep(X.priced_scores(spark, sf)))


def best_edge_threshold(spark, sf):
    return tidy(sweeps.best_edge_threshold(X.priced_scores(spark, sf)))


def backtest_summary(spark, sf):
    return tidy(sweeps.backtest_summary(X.priced_scores(spark, sf)))


SUMMARY_SQL = sql(X.PRICED_SQL + BT_CTE, """
, bets AS (SELECT 'YES' AS side, * FROM yes_bets WHERE e > 0.05::DOUBLE UNION ALL SELECT 'NO', * FROM no_bets WHERE e > 0.05::DOUBLE)
SELECT s.side, count(b.e) AS n, round(avg(won), 6) AS win_rate, round(avg(e), 6) AS mean_edge, round(avg(k), 6) AS mean_kelly,
       round(sum(pnl), 6) AS total_pnl, round(avg(pnl), 6) AS mean_pnl
FROM (SELECT unnest(['YES', 'NO']) AS side) s LEFT JOIN bets b ON b.side = s.side GROUP BY s.side""")


def sanity_checks(spark, sf):
    from earshot.catalog.history import sector_features
    from earshot.operators.trailing import with_sector_peers

    return tidy(market_facts.feature_sanity(with_sector_peers(sector_features(spark, sf)), X.priced_scores(spark, sf)))


def _sanity_sql() -> str:
    from earshot.catalog.history import SECTOR_CTE

    return sql(X.PRICED_SQL + SECTOR_CTE, """
, pr AS (SELECT base_rate, coalesce(s.sector_peer_base_rate, base_rate) AS peer FROM feats f
         LEFT JOIN means s ON s.sector = f.sector AND s.word = f.word AND s.period_num = f.period_num - 1)
SELECT round(avg(tx_prob), 6) AS mean_pred, round(avg(market_yes), 6) AS mean_actual, count(daily_open_mid) AS n_with_open_mid, count(*) AS n,
       (SELECT round(avg(CASE WHEN peer <> base_rate THEN 1 ELSE 0 END), 6) FROM pr) AS sector_differs FROM p""")


def median_features(spark, sf):
    """Exact medians of bounded-domain columns."""
    rows = X.priced_scores(spark, sf)
    return tidy(models.exact_medians(rows, ["daily_open_mid", "implied_prob", "prob_pos"]))


QUERIES = {
    "candle_fill": (candle_fill, sql(X.PRICED_SQL, """
SELECT market_ticker, round(coalesce(daily_open_mid, tx_prob), 6) AS open_mid_filled,
       CASE WHEN daily_open_mid IS NOT NULL THEN 1 ELSE 0 END AS has_candle FROM p""")),
    "live_mids": (live_mids, sql(X.QUOTES_SQL + LIVE_CTE, """
SELECT event_id, round(om, 6) AS live_open_mid, round(cm, 6) AS live_current_mid, round(mo, 6) + 0.0::DOUBLE AS live_momentum,
       hp AS has_prior_session FROM lv""")),
    "live_edges": (live_edges, sql(X.QUOTES_SQL + LIVE_CTE, """
SELECT event_id, round(ey, 6) + 0.0::DOUBLE AS edge_yes, round(en, 6) + 0.0::DOUBLE AS edge_no, round(ky, 6) + 0.0::DOUBLE AS kelly_yes,
       round(kn, 6) + 0.0::DOUBLE AS kelly_no, mf AS momentum_flag FROM kl""")),
    "recommendations": (recommendations, sql(X.QUOTES_SQL + LIVE_CTE, """
SELECT event_id, market_ticker, recommendation, confidence, round(kelly, 6) + 0.0::DOUBLE AS kelly FROM rec""")),
    "company_consensus": (company_consensus, sql(X.QUOTES_SQL + LIVE_CTE, """
SELECT event_id, stock_ticker, round(avg(CASE WHEN ey > 0.05::DOUBLE THEN 1 ELSE 0 END) OVER w, 6) AS consensus_yes,
       round(avg(CASE WHEN en > 0.05::DOUBLE THEN 1 ELSE 0 END) OVER w, 6) AS consensus_no, count(*) OVER w AS n_markets
FROM kl WINDOW w AS (PARTITION BY stock_ticker)""")),
    "ranked_buys": (ranked_buys, sql(X.QUOTES_SQL + LIVE_CTE, """
SELECT event_id, round(ey, 6) AS edge_yes, round(kelly, 6) AS kelly FROM rec WHERE recommendation = 'BUY_YES'""")),
    "ranked_buy_no": (ranked_buy_no, sql(X.QUOTES_SQL + LIVE_CTE, """
SELECT event_id, round(en, 6) AS edge_no, round(kelly, 6) AS kelly FROM rec WHERE recommendation = 'BUY_NO'""")),
    "reason_histogram": (reason_histogram, sql(X.QUOTES_SQL + LIVE_CTE, """
SELECT recommendation, confidence, count(*) AS n FROM rec GROUP BY recommendation, confidence""")),
    "display_rounding": (display_rounding, sql(X.QUOTES_SQL, """
SELECT event_id, CAST(round_even(volume, 1) AS DOUBLE) AS volume FROM q""")),
    "backtest_edges": (backtest_edges, sql(X.PRICED_SQL + BT_CTE, """
SELECT market_ticker, round(ey, 6) + 0.0::DOUBLE AS edge_yes, round(en, 6) + 0.0::DOUBLE AS edge_no, round(ky, 6) + 0.0::DOUBLE AS kelly_yes,
       round(kn, 6) + 0.0::DOUBLE AS kelly_no, round(py, 6) + 0.0::DOUBLE AS pnl_yes, round(pn, 6) + 0.0::DOUBLE AS pnl_no FROM b2""")),
    "edge_threshold_sweep": (edge_threshold_sweep, sql(X.PRICED_SQL + SWEEP_CTE, """
SELECT threshold, n_yes, n_no, round(win_yes, 6) AS win_yes, round(win_no, 6) AS win_no, round(pnl_yes, 6) + 0.0::DOUBLE AS pnl_yes,
       round(pnl_no, 6) + 0.0::DOUBLE AS pnl_no, round(pnl_yes + pnl_no, 6) + 0.0::DOUBLE AS total_pnl FROM sw""")),
    "best_edge_threshold": (best_edge_threshold, sql(X.PRICED_SQL + SWEEP_CTE, """
SELECT CASE WHEN (SELECT count(daily_open_mid) FROM p) < 20 THEN 0.05::DOUBLE ELSE threshold END AS threshold
FROM sw ORDER BY pnl_yes + pnl_no DESC, threshold LIMIT 1""")),
    "backtest_summary": (backtest_summary, SUMMARY_SQL),
    "sanity_checks": (sanity_checks, _sanity_sql()),
    "median_features": (median_features, sql(X.PRICED_SQL, """
, u AS (SELECT 'daily_open_mid' AS name, daily_open_mid AS v FROM p UNION ALL SELECT 'implied_prob', implied_prob FROM p
        UNION ALL SELECT 'prob_pos', prob_pos FROM p)
SELECT name, round(quantile_cont(v, 0.5), 6) AS median FROM u WHERE v IS NOT NULL GROUP BY name""")),
}
