"""Scan and sink queries: tables are written to the shared folder by Spark and read back."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from earshot.catalog.base import sql, tidy
from earshot.catalog.history import HITS_CTE, label_inputs
from earshot.functions import market, periods
from earshot.operators import history, metrics, models, splits, transcripts
from earshot.plans import fixtures as X
from earshot.session import materialize, scratch_path
from earshot.sources import markets, sinks, tables
from earshot.sources import transcripts as sources


def raw_markets(spark, sf):
    """Market objects as they land: nested word, prices as text, blanks and gaps."""
    d, p = F.col("doc_id"), F.col("implied_prob")
    text = F.format_string
    return X.markets(spark, sf).select(
        F.col("market_ticker").alias("ticker"), "event_ticker",
        F.when(d % 41 != 0, F.struct(F.col("word").alias("Word"))).alias("custom_strike"),
        F.upper("result").alias("result"),
        F.coalesce(text("%.4f", p), F.when(d % 2 == 0, "")).alias("previous_price_dollars"),
        F.when(F.col("close_date") != "", F.concat(F.col("close_date"), F.lit("T14:00:00Z"))).alias("close_time"),
        F.when(F.col("settlement_date") != "", F.concat(F.col("settlement_date"), F.lit("T09:30:00Z"))).alias("settlement_ts"),
        "status", F.when(d % 5 != 0, text("%.4f", (d % 90) / 100.0)).alias("yes_bid_dollars"),
        F.lit("").alias("no_bid_dollars"), text("%.2f", (d % 1000) / 4.0).alias("volume_fp"),
        F.lit(None).cast("string").alias("open_interest_fp"),
        F.concat(F.lit('If "'), F.col("word"), F.lit('" is said, then, Yes.\nElse No.')).alias("rules_primary"),
    )


FLAT_CTE = """,
fm AS (SELECT doc_id, series_ticker, event_ticker, market_ticker, ticker AS company_label, CASE WHEN doc_id % 41 <> 0 THEN word ELSE '' END AS word,
              lower(result) AS result, CASE WHEN lower(result) = 'yes' THEN 1 ELSE 0 END AS label, implied_prob, close_date,
              settlement_date, status, CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id % 90 AS DOUBLE) / 100 ELSE 0.0::DOUBLE END AS yes_bid,
              0.0::DOUBLE AS no_bid, round(CAST(doc_id % 1000 AS DOUBLE) / 4, 2) AS volume, 0.0::DOUBLE AS open_interest,
              'If "' || word || '" is said, then, Yes.' || chr(10) || 'Else No.' AS rules_primary FROM m)"""
FLAT_COLS = """series_ticker, event_ticker, market_ticker, company_label, word, result, label, round(implied_prob, 6) AS implied_prob, {dates},
       status, round(yes_bid, 6) AS yes_bid, no_bid, volume, open_interest, rules_primary"""
PLAIN = FLAT_COLS.format(dates="close_date, settlement_date")
BLANK_AS_NULL = FLAT_COLS.format(dates="nullif(close_date, '') AS close_date, nullif(settlement_date, '') AS settlement_date").replace(
    "company_label, word,", "company_label, nullif(word, '') AS word,")


def _flat(spark, sf, settled_only=False):
    return markets.flatten_markets(
        raw_markets(spark, sf).withColumn("series_ticker", F.split("event_ticker", "-")[0]), settled_only)


def market_json_scan(spark, sf):
    path = scratch_path(spark, "raw-markets")
    raw_markets(spark, sf).write.json(path)
    return tidy(markets.flatten_markets(markets.read_market_lines(spark, path)))


def settled_markets(spark, sf):
    return tidy(_flat(spark, sf, settled_only=True))


def flat_market_csv(spark, sf):
    path = scratch_path(spark, "markets-csv")
    sinks.write_flat_markets(_flat(spark, sf), path)
    return tidy(sinks.read_flat_markets(spark, path))


def flat_market_parquet(spark, sf):
    path = scratch_path(spark, "markets-parquet")
    sinks.write_flat_markets(_flat(spark, sf), path, "parquet")
    return tidy(spark.read.parquet(path))


def event_index(spark, sf):
    """Every third event has only a plain ticker, every seventh none at all."""
    d = F.col("doc_id")
    events = X.markets(spark, sf).select(
        "series_ticker", F.when(d % 3 != 0, F.col("event_ticker")).otherwise("").alias("event_ticker"),
        F.when(d % 7 != 0, F.concat(F.lit("T-"), F.col("event_ticker"))).alias("ticker"))
    return tidy(markets.event_index(events))


def _nested_events(spark, sf):
    d = F.col("doc_id")

    def nested(ticker, status, title, word, bid, ask):
        return F.struct(
            ticker.alias("ticker"), status.alias("status"), title.alias("yes_sub_title"), F.struct(word.alias("Word")).alias("custom_strike"),
            bid.alias("yes_bid_dollars"), ask.alias("yes_ask_dollars"), F.lit(None).cast("string").alias("no_bid_dollars"),
            F.format_string("%.2f", (d % 50) / 50.0).alias("no_ask_dollars"), F.format_string("%.1f", (d % 300) / 2.0).alias("volume_fp"),
            F.when(d % 2 == 0, F.format_string("%.2f", (d % 40) / 50.0)).alias("previous_yes_bid_dollars"),
            F.when(d % 2 == 0, F.format_string("%.2f", (d % 40) / 50.0 + 0.05)).alias("previous_yes_ask_dollars"))

    bid = F.format_string("%.2f", (d % 80) / 100.0)
    ask = F.when(d % 6 == 0, "0.0000").when(d % 6 == 1, "").otherwise(F.format_string("%.2f", (d % 80) / 100.0 + 0.04))
    shared = F.concat(F.lit("LM-"), F.expr("doc_id div 20").cast("string"), F.lit("-"), F.col("ticker"))
    own = F.concat(F.lit("OWN-"), d.cast("string"))
    title = F.when(d % 4 != 0, F.col("word"))
    return X.markets(spark, sf).select(
        "series_ticker", "event_ticker",
        F.array(nested(own, F.lit("active"), title, F.lit("fallback"), bid, ask),
                nested(own, F.lit("active"), title, F.lit("second"), ask, bid),
                nested(shared, F.lit("closed"), title, F.lit("x"), bid, ask),
                nested(F.lit(""), F.lit("active"), title, F.lit("x"), bid, ask)).alias("markets"))


def _stocks(spark, sf):
    """Two thirds of the series are tracked."""
    m = X.markets(spark, sf).select("series_ticker", "ticker").distinct()
    return m.where(F.substring("ticker", 4, 10).cast("int") % 3 != 0).select("series_ticker", F.col("ticker").alias("stock_ticker"))


def live_market_scan(spark, sf):
    path = scratch_path(spark, "live-events")
    _nested_events(spark, sf).write.json(path)
    events = spark.read.schema(markets.RAW_EVENT).json(path)
    return tidy(markets.live_quotes(events, _stocks(spark, sf)))


LIVE_SCAN_SQL = sql(X.MARKETS_SQL, """
, v AS (SELECT 'OWN-' || doc_id AS market_ticker, ticker AS stock_ticker, event_ticker, doc_id, base_date,
               CASE WHEN doc_id % 4 <> 0 THEN word ELSE 'fallback' END AS word, CAST(doc_id % 80 AS DOUBLE) / 100 AS yes_bid,
               CASE WHEN doc_id % 6 = 0 THEN 0.0::DOUBLE WHEN doc_id % 6 = 1 THEN 1.0::DOUBLE ELSE round(CAST(doc_id % 80 AS DOUBLE) / 100 + 0.04::DOUBLE, 2) END AS yes_ask,
               round(CAST(doc_id % 50 AS DOUBLE) / 50, 2) AS no_ask, CAST(doc_id % 300 AS DOUBLE) / 2 AS volume,
               CASE WHEN doc_id % 2 = 0 THEN round(CAST(doc_id % 40 AS DOUBLE) / 50, 2) ELSE 0.0::DOUBLE END AS pb,
               CASE WHEN doc_id % 2 = 0 THEN round(CAST(doc_id % 40 AS DOUBLE) / 50 + 0.05::DOUBLE, 2) ELSE 0.0::DOUBLE END AS pa
        FROM m WHERE CAST(substr(ticker, 4) AS INT) % 3 <> 0)
SELECT market_ticker, stock_ticker, event_ticker, word, round(yes_bid, 6) AS yes_bid, yes_ask, 0.0::DOUBLE AS no_bid, no_ask, volume,
       CAST(base_date AS VARCHAR) AS call_date, year(base_date) AS target_year, quarter(base_date) AS target_quarter,
       round(CASE WHEN pb > 0 OR pa > 0 THEN (pb + pa) / 2 ELSE (yes_bid + yes_ask) / 2 END, 6) AS live_open_mid,
       round((yes_bid + yes_ask) / 2, 6) AS live_current_mid,
       round(CASE WHEN pb > 0 OR pa > 0 THEN (yes_bid + yes_ask) / 2 - (pb + pa) / 2 ELSE 0 END, 6) + 0.0::DOUBLE AS live_momentum,
       CASE WHEN pb > 0 OR pa > 0 THEN 1 ELSE 0 END AS has_prior_session FROM v""")


def json_transcripts(spark, sf):
    """Array, object, empty and null-content documents."""
    d = F.col("doc_id")
    obj = F.to_json(F.struct(F.when(d % 5 != 0, F.col("content")).alias("content"), F.col("base_date").cast("string").alias("date")),
                    {"ignoreNullFields": "false"})
    files = X.transcripts(spark, sf).select(
        "doc_id", "ticker", F.concat(F.col("year").cast("string"), F.lit("Q"), F.col("quarter").cast("string"), F.lit(".json")).alias("file_name"),
        F.when(d % 7 == 0, "[]").when(d % 2 == 0, obj).otherwise(F.concat(F.lit("["), obj, F.lit(', {"content": "second"}]'))).alias("value"))
    parsed = sources.parse_json_transcripts(sources.with_stem(files))
    return tidy(parsed.select("doc_id", "year", "quarter", "call_date", F.length("content").alias("n_chars"), F.md5("content").alias("digest")))


JSON_SQL = sql(X.TRANSCRIPTS_SQL, """
, j AS (SELECT *, CASE WHEN doc_id % 7 = 0 OR doc_id % 5 = 0 THEN '' ELSE content END AS c FROM t)
SELECT doc_id, CAST(year AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter, CASE WHEN doc_id % 7 <> 0 THEN CAST(base_date AS VARCHAR) END AS call_date,
       length(c) AS n_chars, md5(c) AS digest FROM j""")


def cached_transcripts(spark, sf):
    """Both roots together, key duplicates kept."""
    t = X.transcripts(spark, sf).withColumn("filename", F.format_string("f%09d.txt", "doc_id"))
    odd, even = t.where("quarter IN (1, 3)"), t.where("quarter IN (2, 4)")
    rows = transcripts.prefer_roots([odd, even], dedupe=False)
    return tidy(rows.groupBy("ticker", "priority").agg(F.count(F.lit(1)).alias("n")))


def transcript_table(spark, sf):
    """Cleaned transcripts written per ticker and read back."""
    raw = sources.parse_text_transcripts(sources.with_stem(X.raw_files(spark, sf).drop("year", "quarter")))
    path = scratch_path(spark, "transcripts")
    sinks.write_transcripts(transcripts.clean_documents(raw, min_words=50), path)
    return tidy(spark.read.parquet(path).groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("n_words")))


def _transcript_sql() -> str:
    from earshot.catalog.textual import _clean_sql

    body = r"trim(regexp_replace(regexp_replace(value, '(?m)^(Symbol|Period|Date):.*\n', '', 'g'), '=+\n', '', 'g'), E' \n\t\r')"
    return sql(X.RAW_FILES_SQL, rf"""
, st AS (SELECT ticker, len(regexp_extract_all({_clean_sql(body)}, '\S+')) AS n FROM f WHERE regexp_matches(file_name, '^[A-Za-z]+_\d{{4}}_Q\d\.txt$'))
SELECT ticker, count(*) AS n, CAST(sum(n) AS BIGINT) AS n_words FROM st WHERE n >= 50 GROUP BY ticker""")


def _split_labels(spark, sf):
    labels = history.build_labels(X.transcripts(spark, sf), label_inputs(spark, sf))
    return splits.cross_company_split(labels)


def label_splits_table(spark, sf):
    """The whole label build written as one folder per split and read back."""
    path = scratch_path(spark, "labels")
    sinks.write_splits(_split_labels(spark, sf), path)
    return tidy(spark.read.parquet(path).select("market_ticker", "ticker", "split", "hist_rate"))


def _label_split_sql() -> str:
    from earshot.catalog.evaluation import SPLIT_CTE

    return sql(X.MARKETS_SQL + HITS_CTE + SPLIT_CTE, """
SELECT market_ticker, m.ticker, split, round(hist_rate, 6) AS hist_rate FROM m JOIN split ON split.ticker = m.ticker
LEFT JOIN rates r ON r.ticker = m.ticker AND r.w = lower(m.word) AND r.cutoff = m.cutoff""")


def _log(spark, sf):
    """A JSONL experiment log with one record per model, split and day."""
    x = X.experiments(spark, sf).withColumn("feature_set", F.when(F.col("run_line") % 2 == 0, "all").otherwise("no_implied_prob"))
    daily = x.groupBy("model", "split", "feature_set", "timestamp").agg(
        F.max("f1_macro").alias("f1_macro"), F.max("roi_per_trade").alias("roi_per_trade"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("run_line") == 1).alias("tn"), F.count_if(F.col("run_line") == 2).alias("fp"),
        F.count_if(F.col("run_line") == 3).alias("fn"), F.count_if(F.col("run_line") > 3).alias("tp"))
    path = scratch_path(spark, "experiments")
    records = sinks.experiment_records(daily, ["model", "split", "feature_set"], F.date_format("timestamp", "yyyy-MM-dd"))
    sinks.append_experiments(records.where("config.feature_set = 'all'"), path)
    sinks.append_experiments(records.where("config.feature_set <> 'all'"), path)
    return tables.read_experiments(spark, path)


LOG_CTE = """,
lg AS (SELECT model, split, CASE WHEN run_line % 2 = 0 THEN 'all' ELSE 'no_implied_prob' END AS feature_set, "timestamp", max(f1_macro) AS f1_macro,
              max(roi_per_trade) AS roi, count(*) AS n, count(*) FILTER (run_line = 1) AS tn, count(*) FILTER (run_line > 3) AS tp FROM x GROUP BY ALL)"""


def experiment_log(spark, sf):
    """Appended in two writes, read back, one nested configuration selected."""
    found = tables.find_experiments(_log(spark, sf), "A", "no_implied_prob", "F")
    cm = F.col("metrics.confusion_matrix")
    return tidy(found.select("timestamp", "metrics.n", "metrics.f1_macro", cm[0][0].alias("tn"), cm[1][1].alias("tp")))


def results_table(spark, sf):
    """Latest record per (model, split) written as one folder per split and read back."""
    path = scratch_path(spark, "results")
    sinks.write_results_table(_log(spark, sf).where("config.feature_set = 'all'"), path)
    return tidy(spark.read.parquet(path).select("model", "split", "n", "f1_macro", "roi_per_trade"))


def scored_table(spark, sf):
    """Recommendation rows and keyed probabilities written and joined back."""
    s = X.scores(spark, sf)
    rows_path, prob_path = scratch_path(spark, "predictions"), scratch_path(spark, "probabilities")
    sinks.write_predictions(s.select("market_ticker", "mentioned", "pred"), rows_path, "csv")
    sinks.write_probabilities(s, prob_path)
    rows = tables.read_csv(spark, rows_path, "market_ticker STRING, mentioned INT, pred INT")
    return tidy(transcripts.attach_predictions(rows.drop("pred"), spark.read.parquet(prob_path)))


def sector_lookup(spark, sf):
    customers = X.table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("stock_ticker"))
    nation, region = X.table(spark, sf, "nation"), X.table(spark, sf, "region")
    sectors = nation.join(region, nation.n_regionkey == region.r_regionkey).where("r_regionkey <> 3").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("stock_ticker"), F.col("r_name").alias("sector"))
    return tidy(markets.with_sector(customers, sectors).groupBy("sector").agg(F.count(F.lit(1)).alias("n")))


TRACKED = (("KXEARNINGSMENTIONAAPL", "AAPL"), ("KXMENTIONEARNGIS", "GIS"), ("KXBRKMENTION", "BRK-B"), ("KXEARNINGSMENTIONTSMC", "TSM"), ("KXOTHER", None))


def tracked_series(spark, sf):
    """Stocks of the series that markets name; every fifth series is none of the fixed list."""
    known = markets.series_to_stock(spark)
    series = F.array(*[F.lit(name) for name, _ in TRACKED])
    m = X.table(spark, sf, "documents").select(F.element_at(series, (F.col("doc_id") % len(TRACKED) + 1).cast("int")).alias("series_ticker"))
    return tidy(m.join(F.broadcast(known), "series_ticker", "left").groupBy("series_ticker", "stock_ticker").agg(F.count(F.lit(1)).alias("n")))


def feature_assembly(spark, sf):
    """Model vectors with and without the market price."""
    labels = models.impute_zero(X.scores(spark, sf).withColumn("in_recent_news", F.lit(0)), ["implied_prob", "prob_pos", "in_recent_news"])
    full = models.assemble(labels, ["implied_prob", "prob_pos", "in_recent_news"])
    both = models.assemble(full, ["prob_pos", "in_recent_news"], "ablated")
    a, b = vector_to_array("features"), vector_to_array("ablated")
    return tidy(both.select("market_ticker", a[0].alias("x0"), a[1].alias("x1"), a[2].alias("x2"), b[0].alias("y0"), b[1].alias("y1")))


def materialized_markets(spark, sf):
    """A table cut from its lineage through the shared folder."""
    return tidy(materialize(_flat(spark, sf), "flat").groupBy("status").agg(F.count(F.lit(1)).alias("n")))


def prediction_calendar(spark, sf):
    """Earliest and latest prediction date per company label."""
    flat = _flat(spark, sf)
    when = periods.prediction_date(F.col("close_date"), F.col("settlement_date"))
    return tidy(flat.groupBy("company_label").agg(
        F.min(when).alias("first_date"), F.max(when).alias("last_date"), F.count_if(market.in_uncertain_band(F.col("implied_prob"))).alias("n_uncertain")))


def baseline_log(spark, sf):
    """Metrics of the scored markets appended as one record and read back."""
    s = X.scores(spark, sf).withColumns({"model": F.lit("scored"), "split": F.lit("test")})
    m = metrics.classification_metrics(s, by=("model", "split")).join(metrics.roi_backtest(s, by=("model", "split")), ["model", "split"])
    path = scratch_path(spark, "log")
    sinks.append_experiments(sinks.experiment_records(m, ["model", "split"], F.lit("2026-01-01")), path)
    return tidy(sinks.results_table(tables.read_experiments(spark, path)).select("model", "split", "n", "accuracy", "total_pnl"))


QUERIES = {
    "market_json_scan": (market_json_scan, sql(X.MARKETS_SQL + FLAT_CTE, f"SELECT {PLAIN} FROM fm")),
    "settled_markets": (settled_markets, sql(X.MARKETS_SQL + FLAT_CTE, f"SELECT {PLAIN} FROM fm WHERE status IN ('finalized', 'settled')")),
    "flat_market_csv": (flat_market_csv, sql(X.MARKETS_SQL + FLAT_CTE, f"SELECT {BLANK_AS_NULL} FROM fm")),
    "flat_market_parquet": (flat_market_parquet, sql(X.MARKETS_SQL + FLAT_CTE, f"SELECT {PLAIN} FROM fm")),
    "event_index": (event_index, sql(X.MARKETS_SQL, """
SELECT series_ticker, CASE WHEN doc_id % 3 <> 0 THEN event_ticker ELSE 'T-' || event_ticker END AS event_ticker
FROM m WHERE doc_id % 3 <> 0 OR doc_id % 7 <> 0""")),
    "live_market_scan": (live_market_scan, LIVE_SCAN_SQL),
    "json_transcripts": (json_transcripts, JSON_SQL),
    "cached_transcripts": (cached_transcripts, sql(X.TRANSCRIPTS_SQL, """
SELECT ticker, CASE WHEN quarter IN (1, 3) THEN 0 ELSE 1 END AS priority, count(*) AS n FROM t GROUP BY ALL""")),
    "transcript_table": (transcript_table, _transcript_sql()),
    "label_splits_table": (label_splits_table, _label_split_sql()),
    "experiment_log": (experiment_log, sql(X.EXPERIMENTS_SQL + LOG_CTE, """
SELECT strftime("timestamp", '%Y-%m-%d') AS "timestamp", n, round(f1_macro, 6) AS f1_macro, tn, tp FROM lg
WHERE model = 'A' AND feature_set = 'no_implied_prob' AND split = 'F'""")),
    "results_table": (results_table, sql(X.EXPERIMENTS_SQL + LOG_CTE, """
SELECT model, split, n, round(f1_macro, 6) AS f1_macro, round(roi, 6) AS roi_per_trade FROM lg WHERE feature_set = 'all'
QUALIFY row_number() OVER (PARTITION BY model, split ORDER BY "timestamp" DESC) = 1""")),
    "scored_table": (scored_table, sql(X.SCORES_SQL, """
SELECT market_ticker, CAST(mentioned AS BIGINT) AS mentioned, prob_pos, CAST(pred AS BIGINT) AS pred FROM s""")),
    "sector_lookup": (sector_lookup, sql("x AS (SELECT 1)", """
SELECT coalesce(r_name, 'Unknown') AS sector, count(*) AS n FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey AND r_regionkey <> 3 GROUP BY 1""")),
    "tracked_series": (tracked_series, """
SELECT CASE doc_id % 5 WHEN 0 THEN 'KXEARNINGSMENTIONAAPL' WHEN 1 THEN 'KXMENTIONEARNGIS' WHEN 2 THEN 'KXBRKMENTION' WHEN 3 THEN 'KXEARNINGSMENTIONTSMC' ELSE 'KXOTHER' END AS series_ticker,
       CASE doc_id % 5 WHEN 0 THEN 'AAPL' WHEN 1 THEN 'GIS' WHEN 2 THEN 'BRK-B' WHEN 3 THEN 'TSM' END AS stock_ticker, count(*) AS n
FROM documents GROUP BY ALL"""),
    "feature_assembly": (feature_assembly, sql(X.SCORES_SQL, """
SELECT market_ticker, coalesce(implied_prob, 0.0::DOUBLE) AS x0, prob_pos AS x1, 0.0::DOUBLE AS x2, prob_pos AS y0, 0.0::DOUBLE AS y1 FROM s""")),
    "materialized_markets": (materialized_markets, sql(X.MARKETS_SQL, "SELECT status, count(*) AS n FROM m GROUP BY status")),
    "prediction_calendar": (prediction_calendar, sql(X.MARKETS_SQL, """
SELECT ticker AS company_label, CAST(min(cutoff) AS VARCHAR) AS first_date, CAST(max(cutoff) AS VARCHAR) AS last_date,
       count(*) FILTER (implied_prob BETWEEN 0.2 AND 0.8) AS n_uncertain FROM m GROUP BY ticker""")),
    "baseline_log": (baseline_log, sql(X.SCORES_SQL, """
SELECT 'scored' AS model, 'test' AS split, count(*) AS n, round(avg(CASE WHEN pred = mentioned THEN 1 ELSE 0 END), 6) AS accuracy,
       round(sum(CASE WHEN pred = mentioned THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END - CASE WHEN pred = 1 THEN implied_prob ELSE 1.0::DOUBLE - implied_prob END - 0.03::DOUBLE), 6) AS total_pnl FROM s""")),
}
