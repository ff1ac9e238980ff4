"""Explicit schemas (DDL text) of the landed files and the domain tables."""


RAW_MARKET = (
    "ticker STRING, event_ticker STRING, custom_strike STRUCT<Word: STRING>, result STRING, "
    "previous_price_dollars STRING, close_time STRING, settlement_ts STRING, status STRING, "
    "yes_bid_dollars STRING, no_bid_dollars STRING, volume_fp STRING, open_interest_fp STRING, "
    "rules_primary STRING"
)

RAW_EVENT = (
    "event_ticker STRING, ticker STRING, series_ticker STRING, markets ARRAY<STRUCT<"
    "ticker: STRING, status: STRING, yes_sub_title: STRING, custom_strike: STRUCT<Word: STRING>, "
    "yes_bid_dollars: STRING, yes_ask_dollars: STRING, no_bid_dollars: STRING, no_ask_dollars: STRING, "
    "volume_fp: STRING, previous_yes_bid_dollars: STRING, previous_yes_ask_dollars: STRING>>"
)

FLAT_MARKET = (
    "series_ticker STRING, event_ticker STRING, market_ticker STRING, company_label STRING, "
    "word STRING, result STRING, label INT, implied_prob DOUBLE, close_date STRING, "
    "settlement_date STRING, status STRING, yes_bid DOUBLE, no_bid DOUBLE, volume DOUBLE, "
    "open_interest DOUBLE, rules_primary STRING"
)

RAW_TRANSCRIPT_JSON = "ARRAY<STRUCT<content: STRING, date: STRING>>"

TRANSCRIPTS = (
    "ticker STRING, year INT, quarter INT, content STRING, call_date DATE, source STRING, filename STRING"
)

RAW_ARTICLES = "ARRAY<STRUCT<publishedDate: STRING, title: STRING, text: STRING>>"

LABELS = (
    "ticker STRING, year INT, quarter INT, call_date DATE, word STRING, mentioned INT, "
    "implied_prob DOUBLE, hist_rate DOUBLE, in_recent_news INT, market_ticker STRING"
)

DAILY_SUMMARY = (
    "market_ticker STRING, daily_open_mid DOUBLE, daily_std DOUBLE, daily_total_vol DOUBLE"
)

EXPERIMENT = (
    "timestamp STRING, "
    "config STRUCT<model: STRING, phase: STRING, split: STRING, feature_set: STRING, C: DOUBLE, "
    "max_depth: INT, threshold: DOUBLE, majority_class: INT>, "
    "metrics STRUCT<n: INT, accuracy: DOUBLE, f1_macro: DOUBLE, f1_weighted: DOUBLE, "
    "precision_pos: DOUBLE, recall_pos: DOUBLE, f1_pos: DOUBLE, precision_neg: DOUBLE, "
    "recall_neg: DOUBLE, f1_neg: DOUBLE, confusion_matrix: ARRAY<ARRAY<INT>>, n_trades: INT, "
    "n_correct: INT, accuracy_trades: DOUBLE, total_pnl: DOUBLE, roi_per_trade: DOUBLE, "
    "avg_stake: DOUBLE, n_skipped_nan_prob: INT>, notes STRING"
)

COVERAGE = (
    "series_ticker STRING, title STRING, n_events INT, n_markets INT, earliest_call DATE, latest_call DATE"
)
