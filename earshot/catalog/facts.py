"""Descriptive market, transcript and price queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from earshot.catalog.base import sql, tidy
from earshot.functions import market, periods
from earshot.functions import text as T
from earshot.operators import binning, market_facts, metrics, ranking
from earshot.plans import fixtures as X


def labelled(spark, sf):
    return (
        X.markets(spark, sf).withColumn("label", market.outcome(F.col("result"))).withColumn("call_date", F.col("cutoff"))
    )


LABELLED_SQL = X.MARKETS_SQL + ", ml AS (SELECT *, CASE WHEN lower(result) = 'yes' THEN 1 ELSE 0 END AS label FROM m)"


def _series(spark, sf):
    """Series come from the suppliers: some have no market."""
    s = X.table(spark, sf, "supplier")
    n = F.col("s_suppkey") % 40
    family = F.when(n % 5 == 0, "KXMENTIONEARN").otherwise("KXEARNINGSMENTION")
    return s.groupBy(F.concat(family, F.lit("SRC"), n.cast("string")).alias("series_ticker")).agg(
        F.max("s_name").alias("title")
    )


SERIES_CTE = """,
series AS (SELECT CASE WHEN s_suppkey % 40 % 5 = 0 THEN 'KXMENTIONEARN' ELSE 'KXEARNINGSMENTION' END || 'SRC' || (s_suppkey % 40) AS series_ticker,
                  max(s_name) AS title FROM supplier GROUP BY 1),
cov AS (SELECT s.series_ticker, s.title, coalesce(n_events, 0) AS n_events, coalesce(n_markets, 0) AS n_markets,
               earliest_call, latest_call
        FROM series s
        LEFT JOIN (SELECT series_ticker, count(DISTINCT event_ticker) AS n_events FROM m GROUP BY 1) e USING (series_ticker)
        LEFT JOIN (SELECT series_ticker, count(*) AS n_markets, min(nullif(close_date, '')) AS earliest_call,
                          max(nullif(close_date, '')) AS latest_call FROM m GROUP BY 1) k USING (series_ticker))"""


def _coverage(spark, sf):
    m = X.markets(spark, sf)
    events = m.select("series_ticker", "event_ticker").distinct()
    return market_facts.coverage_report(_series(spark, sf), events, m)


def coverage_report(spark, sf):
    return tidy(_coverage(spark, sf))


def coverage_totals(spark, sf):
    return tidy(market_facts.coverage_totals(_coverage(spark, sf)))


def series_keyword_search(spark, sf):
    return tidy(market_facts.mention_series(_series(spark, sf), "Earn"))


def series_group_sizes(spark, sf):
    return tidy(market_facts.size_range(labelled(spark, sf)))


def word_company_counts(spark, sf):
    return tidy(market_facts.word_company_counts(labelled(spark, sf)))


def word_company_counts_approx(spark, sf):
    return tidy(market_facts.word_company_counts_approx(labelled(spark, sf)))


def approx_counts_within_error(spark, sf):
    """Per word: 1 where the approximate number of companies is within three standard errors of the exact one."""
    exact = market_facts.word_company_counts(labelled(spark, sf)).select("word", F.col("n_companies").alias("exact"))
    close = F.abs(F.col("n_companies") - F.col("exact")) <= 3 * 0.02 * F.col("exact")
    rough = market_facts.word_company_counts_approx(labelled(spark, sf))
    return tidy(exact.join(rough, "word", "left").select("word", F.coalesce(close, F.lit(False)).cast("int").alias("within")))


def top_words(spark, sf):
    return tidy(market_facts.top_words(labelled(spark, sf), 5))


def company_yes_rates(spark, sf):
    return tidy(market_facts.company_yes_rates(labelled(spark, sf)))


def result_counts(spark, sf):
    return tidy(market_facts.result_counts(labelled(spark, sf)))


def calibration_table(spark, sf):
    return tidy(binning.calibration_table(labelled(spark, sf)))


CALIBRATION_SQL = sql(LABELLED_SQL, """
, r AS (SELECT implied_prob AS p, label, min(implied_prob) OVER () AS lo, (max(implied_prob) OVER () - min(implied_prob) OVER ()) / 10 AS step
        FROM ml WHERE implied_prob IS NOT NULL),
b AS (SELECT *, list_sum([CASE WHEN p > lo + CAST(i AS DOUBLE) * step THEN 1 ELSE 0 END FOR i IN range(1, 10)]) AS prob_bin FROM r)
SELECT CAST(prob_bin AS BIGINT) AS prob_bin, round(avg(p), 6) AS mean_prob, round(avg(label), 6) AS actual_rate, count(*) AS n
FROM b GROUP BY prob_bin""")


def price_histogram(spark, sf):
    return tidy(binning.histogram(labelled(spark, sf)))


HISTOGRAM_SQL = sql(LABELLED_SQL, """
, r AS (SELECT implied_prob AS p, min(implied_prob) OVER () AS lo, (max(implied_prob) OVER () - min(implied_prob) OVER ()) / 30 AS step
        FROM ml WHERE implied_prob IS NOT NULL),
b AS (SELECT list_sum([CASE WHEN p >= lo + CAST(i AS DOUBLE) * step THEN 1 ELSE 0 END FOR i IN range(1, 30)]) AS bin FROM r)
SELECT s.bin, count(b.bin) AS n FROM (SELECT unnest(range(30)) AS bin) s LEFT JOIN b ON b.bin = s.bin GROUP BY s.bin""")


def brier_score(spark, sf):
    return tidy(metrics.brier(labelled(spark, sf), "implied_prob", "label"))


def price_extremeness(spark, sf):
    return tidy(market_facts.price_extremeness(labelled(spark, sf)))


def dataset_summary(spark, sf):
    return tidy(market_facts.dataset_summary(labelled(spark, sf)))


def first_market_per_series(spark, sf):
    cols = ["series_ticker", "close_date", "doc_id", "market_ticker"]
    return tidy(market_facts.first_market_per_series(labelled(spark, sf).select(*cols), ["doc_id"]))


def first_quote_per_market(spark, sf):
    q = X.quotes(spark, sf).select("market_ticker", "ts", "event_id", "mid").withColumn("ts", F.col("ts").cast("string"))
    return tidy(ranking.keep_first(q, ["market_ticker"], ["event_id"]).drop("ts"))


def word_count_describe(spark, sf):
    return tidy(market_facts.word_count_describe(X.transcripts(spark, sf)))


DESCRIBE_SQL = sql(X.TRANSCRIPTS_SQL, r"""
, w AS (SELECT ticker, len(regexp_extract_all(content, '\S+')) AS n FROM t)
SELECT ticker, count(*) AS n, round(avg(n), 6) AS mean_words, round(stddev_samp(n), 6) AS std_words, min(n) AS min_words,
       round(quantile_cont(n, 0.25), 6) AS p25_words, round(quantile_cont(n, 0.5), 6) AS p50_words,
       round(quantile_cont(n, 0.75), 6) AS p75_words, max(n) AS max_words
FROM w GROUP BY ticker""")


def daily_price_summary(spark, sf):
    return tidy(market_facts.daily_price_summary(X.quotes(spark, sf)))


DAILY_SQL = sql(X.QUOTES_SQL, """
SELECT market_ticker, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, round(arg_min(mid, (ts, event_id)), 6) AS daily_open_mid,
       round(stddev_samp(mid), 6) AS daily_std, round(sum(volume), 6) AS daily_total_vol
FROM q GROUP BY market_ticker, CAST(ts AS DATE)""")


def market_outcomes(spark, sf):
    """Labels from the result text and from a given label that wins over it."""
    m = X.markets(spark, sf)
    given = F.when(F.col("doc_id") % 11 == 0, F.lit(1))
    return tidy(m.select("market_ticker", market.outcome(F.col("result")).alias("label"),
                         market.outcome(F.col("result"), given).alias("given_label")))


def prediction_dates(spark, sf):
    m = X.markets(spark, sf)
    return tidy(m.select(
        "market_ticker", F.col("cutoff").alias("pred_date"), F.coalesce(F.year("cutoff"), F.lit(0)).alias("year"),
        F.coalesce(periods.calendar_quarter(F.month("cutoff")), F.lit(0)).alias("quarter"),
    ))


def period_keys(spark, sf):
    t = X.transcripts(spark, sf)
    p = F.col("period_num")
    return tidy(t.select(
        "doc_id", periods.calendar_quarter(F.month("base_date")).alias("calendar_quarter"),
        periods.period_num(F.col("year"), F.col("quarter")).alias("period_num"),
        F.coalesce("call_date", periods.period_fallback_date(p)).alias("sort_key"),
        periods.news_window_start(F.col("year"), F.col("quarter")).alias("news_from"),
        periods.news_window_end(F.col("year"), F.col("quarter")).alias("news_to"),
    ))


PERIOD_SQL = sql(X.TRANSCRIPTS_SQL, """
, n AS (SELECT *, make_date(year + CASE WHEN quarter = 4 THEN 1 ELSE 0 END, (quarter * 3) % 12 + 1, 15) AS news_to FROM t)
SELECT doc_id, quarter(base_date) AS calendar_quarter, CAST(year * 4 + quarter AS BIGINT) AS period_num,
       CAST(coalesce(call_date, make_date(period_num // 4, (period_num % 4) * 3 + 1, 1)) AS VARCHAR) AS sort_key,
       CAST(CAST(news_to - 30 AS DATE) AS VARCHAR) AS news_from, CAST(news_to AS VARCHAR) AS news_to FROM n""")


def event_ticker_dates(spark, sf):
    """Well-formed, dateless, impossible and unknown-month tickers."""
    d = F.col("doc_id")
    e = (
        F.when(d % 7 == 1, F.concat(F.col("series_ticker"), F.lit("-SPECIAL")))
        .when(d % 7 == 2, F.concat(F.col("series_ticker"), F.lit("-26FEB30")))
        .when(d % 7 == 3, F.concat(F.col("series_ticker"), F.lit("-26XYZ11"))).otherwise(F.col("event_ticker"))
    )
    m = X.markets(spark, sf).withColumn("event_ticker", e)
    return tidy(m.select(
        "market_ticker", periods.event_date(F.col("event_ticker")).alias("call_date"),
        periods.target_year(F.col("event_ticker")).alias("target_year"),
        periods.target_quarter(F.col("event_ticker")).alias("target_quarter"),
    ))


EVENT_DATE_SQL = sql(X.MARKETS_SQL, r"""
, e AS (SELECT market_ticker, CASE doc_id % 7 WHEN 1 THEN series_ticker || '-SPECIAL' WHEN 2 THEN series_ticker || '-26FEB30'
                              WHEN 3 THEN series_ticker || '-26XYZ11' ELSE event_ticker END AS et FROM m),
x AS (SELECT market_ticker, regexp_extract(et, '-(\d{2})([A-Z]{3})(\d{2})$', 1) AS yy,
             greatest(1, coalesce(list_position(['JAN','FEB','MAR','APR','MAY','JUN','JUL','AUG','SEP','OCT','NOV','DEC'],
                                                regexp_extract(et, '-(\d{2})([A-Z]{3})(\d{2})$', 2)), 0)) AS mm,
             regexp_extract(et, '-(\d{2})([A-Z]{3})(\d{2})$', 3) AS dd FROM e)
SELECT market_ticker, CASE WHEN yy <> '' THEN CAST(TRY_CAST('20' || yy || '-' || lpad(CAST(mm AS VARCHAR), 2, '0') || '-' || dd AS DATE) AS VARCHAR) END AS call_date,
       CAST(CASE WHEN yy <> '' THEN 2000 + CAST(yy AS INT) ELSE 2026 END AS BIGINT) AS target_year,
       CAST(CASE WHEN yy <> '' THEN (mm - 1) // 3 + 1 ELSE 2 END AS BIGINT) AS target_quarter FROM x""")


def series_labels(spark, sf):
    s = F.col("series_ticker")
    return tidy(X.markets(spark, sf).groupBy("series_ticker").agg(F.count(F.lit(1)).alias("n")).select(
        s, market.company_label(s).alias("company_label"), market.series_display_label(s).alias("display_label"), "n"))


def document_filters(spark, sf):
    """How many calls and markets pass each row filter."""
    n_words = T.word_count(F.col("content"))
    docs = X.transcripts(spark, sf).agg(
        F.count_if(n_words >= 1000).alias("n_long_enough"), F.count_if(F.col("year") < 2024).alias("n_train_years"),
        F.count_if(F.col("period_num").isin(8101, 8102, 8103)).alias("n_val_periods"))
    p = F.col("implied_prob")
    return tidy(X.markets(spark, sf).agg(
        F.count_if(F.col("status").isin("finalized", "settled")).alias("n_settled"),
        F.count_if(F.col("status") == "active").alias("n_active"), F.count_if(p.isNotNull()).alias("n_priced"),
        F.count_if(market.in_uncertain_band(p)).alias("n_uncertain"),
        F.count_if((F.col("ticker") != "") & (F.col("word") != "")).alias("n_named"),
    ).withColumns({c: docs.select(c).scalar() for c in docs.columns}))


FILTERS_SQL = sql(X.MARKETS_SQL, r"""
SELECT count(*) FILTER (status IN ('finalized', 'settled')) AS n_settled, count(*) FILTER (status = 'active') AS n_active,
       count(implied_prob) AS n_priced, count(*) FILTER (implied_prob BETWEEN 0.2 AND 0.8) AS n_uncertain, count(*) AS n_named,
       (SELECT count(*) FROM t WHERE len(regexp_extract_all(content, '\S+')) >= 1000) AS n_long_enough,
       (SELECT count(*) FROM t WHERE year < 2024) AS n_train_years,
       (SELECT count(*) FROM t WHERE period_num IN (8101, 8102, 8103)) AS n_val_periods
FROM m""")

QUERIES = {
    "coverage_report": (coverage_report, sql(X.MARKETS_SQL + SERIES_CTE, "SELECT * FROM cov")),
    "coverage_totals": (coverage_totals, sql(X.MARKETS_SQL + SERIES_CTE, """
SELECT count(*) FILTER (n_markets > 0) AS n_with_data, count(*) AS n_series, CAST(sum(n_markets) AS BIGINT) AS total_markets FROM cov""")),
    "series_keyword_search": (series_keyword_search, sql(X.MARKETS_SQL + SERIES_CTE, """
SELECT * FROM series WHERE (contains(lower(title), 'earn') OR contains(lower(series_ticker), 'earn')) AND contains(upper(series_ticker), 'MENTION')""")),
    "series_group_sizes": (series_group_sizes, sql(X.MARKETS_SQL, """
SELECT min(n) AS min_n, max(n) AS max_n, round(avg(n), 6) AS mean_n FROM (SELECT count(*) AS n FROM m GROUP BY series_ticker)""")),
    "word_company_counts": (word_company_counts, sql(LABELLED_SQL, """
SELECT word, count(DISTINCT series_ticker) AS n_companies, count(*) AS n_markets, round(avg(label), 6) AS yes_rate FROM ml GROUP BY word""")),
    "word_company_counts_approx": (word_company_counts_approx, None),
    "approx_counts_within_error": (approx_counts_within_error, sql(LABELLED_SQL, "SELECT word, 1 AS within FROM ml GROUP BY word")),
    "top_words": (top_words, sql(LABELLED_SQL, """
SELECT word, count(DISTINCT series_ticker) AS n_companies, count(*) AS n_markets, round(avg(label), 6) AS yes_rate
FROM ml GROUP BY word ORDER BY n_companies DESC, word LIMIT 5""")),
    "company_yes_rates": (company_yes_rates, sql(LABELLED_SQL, """
SELECT series_ticker, round(avg(label), 6) AS yes_rate, count(*) AS n FROM ml GROUP BY series_ticker""")),
    "result_counts": (result_counts, sql(X.MARKETS_SQL, "SELECT result, count(*) AS n FROM m GROUP BY result")),
    "calibration_table": (calibration_table, CALIBRATION_SQL),
    "price_histogram": (price_histogram, HISTOGRAM_SQL),
    "brier_score": (brier_score, sql(LABELLED_SQL, """
SELECT count(*) AS n, round(avg(pow(implied_prob - label, 2)), 6) AS brier,
       round((0.25 - avg(pow(implied_prob - label, 2))) / 0.25, 6) AS improvement FROM ml WHERE implied_prob IS NOT NULL""")),
    "price_extremeness": (price_extremeness, sql(X.MARKETS_SQL, """
SELECT round(avg(CASE WHEN implied_prob < 0.05 OR implied_prob >= 0.95 THEN 1 ELSE 0 END), 6) AS extreme,
       round(avg(CASE WHEN implied_prob BETWEEN 0.2 AND 0.8 THEN 1 ELSE 0 END), 6) AS uncertain FROM m WHERE implied_prob IS NOT NULL""")),
    "dataset_summary": (dataset_summary, sql(LABELLED_SQL, """
SELECT count(*) AS n_markets, count(DISTINCT series_ticker) AS n_companies, count(DISTINCT word) AS n_words,
       CAST(min(cutoff) AS VARCHAR) AS first_date, CAST(max(cutoff) AS VARCHAR) AS last_date, round(avg(label), 6) AS yes_rate,
       CAST(sum(label) AS BIGINT) AS n_yes, count(*) FILTER (label = 0) AS n_no FROM ml""")),
    "first_market_per_series": (first_market_per_series, sql(X.MARKETS_SQL, """
SELECT series_ticker, close_date, doc_id, market_ticker FROM m QUALIFY row_number() OVER (PARTITION BY series_ticker ORDER BY doc_id) = 1""")),
    "first_quote_per_market": (first_quote_per_market, sql(X.QUOTES_SQL, """
SELECT market_ticker, event_id, round(mid, 6) AS mid FROM q QUALIFY row_number() OVER (PARTITION BY market_ticker ORDER BY event_id) = 1""")),
    "word_count_describe": (word_count_describe, DESCRIBE_SQL),
    "daily_price_summary": (daily_price_summary, DAILY_SQL),
    "market_outcomes": (market_outcomes, sql(X.MARKETS_SQL, """
SELECT market_ticker, CASE WHEN lower(result) = 'yes' THEN 1 ELSE 0 END AS label,
       CASE WHEN doc_id % 11 = 0 OR lower(result) = 'yes' THEN 1 ELSE 0 END AS given_label FROM m""")),
    "prediction_dates": (prediction_dates, sql(X.MARKETS_SQL, """
SELECT market_ticker, CAST(cutoff AS VARCHAR) AS pred_date, coalesce(year(cutoff), 0) AS year, coalesce(quarter(cutoff), 0) AS quarter FROM m""")),
    "period_keys": (period_keys, PERIOD_SQL),
    "event_ticker_dates": (event_ticker_dates, EVENT_DATE_SQL),
    "series_labels": (series_labels, sql(X.MARKETS_SQL, """
SELECT series_ticker, regexp_replace(series_ticker, '^(KXEARNINGSMENTION|KXMENTIONEARN)', '') AS company_label,
       list_last(string_split(series_ticker, 'MENTION')) AS display_label, count(*) AS n FROM m GROUP BY series_ticker""")),
    "document_filters": (document_filters, FILTERS_SQL),
}
