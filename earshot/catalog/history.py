"""History, context and trailing-window queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from earshot.catalog.base import says, sql, tidy, variant_count, word_hits
from earshot.functions import text as T
from earshot.operators import context, history, trailing
from earshot.plans import fixtures as X
from earshot.sources import news


def label_inputs(spark, sf):
    return X.markets(spark, sf).withColumns({"company_label": F.col("ticker"), "label": F.lit(None).cast("int")})


def hist_rate_asof(spark, sf):
    return tidy(history.build_labels(X.transcripts(spark, sf), label_inputs(spark, sf)))


HITS_CTE = word_hits(X.WORDS) + """,
pairs AS (SELECT DISTINCT ticker, lower(word) AS w FROM m),
hits AS MATERIALIZED (SELECT wh.ticker, s.w, call_date, s.hit FROM wh JOIN pairs p ON p.ticker = wh.ticker AND p.w = s.w WHERE call_date IS NOT NULL),
rates AS (SELECT k.ticker, k.w, k.cutoff, avg(CAST(hit AS DOUBLE)) AS hist_rate
          FROM (SELECT DISTINCT ticker, lower(word) AS w, cutoff FROM m WHERE cutoff IS NOT NULL) k
          JOIN hits h ON h.ticker = k.ticker AND h.w = k.w AND h.call_date < k.cutoff GROUP BY ALL)"""

HIST_RATE_SQL = sql(X.MARKETS_SQL + HITS_CTE, """
SELECT m.ticker, coalesce(year(m.cutoff), 0) AS year, coalesce(quarter(m.cutoff), 0) AS quarter,
       CAST(m.cutoff AS VARCHAR) AS call_date, word, CAST(mentioned AS BIGINT) AS mentioned,
       round(implied_prob, 6) AS implied_prob, round(hist_rate, 6) AS hist_rate,
       0 AS in_recent_news, market_ticker
FROM m LEFT JOIN rates r ON r.ticker = m.ticker AND r.w = lower(m.word) AND r.cutoff = m.cutoff""")


def mention_rate(spark, sf):
    """Rate of each market word over all dated calls of its ticker."""
    docs = X.transcripts(spark, sf)
    end = X.markets(spark, sf).select("ticker", F.lower("word").alias("word"), F.lit("2100-01-01").cast("date").alias("cutoff"))
    return tidy(history.mention_rates(docs, end).drop("cutoff"))


MENTION_RATE_SQL = sql(X.MARKETS_SQL + HITS_CTE, """
SELECT ticker, w AS word, count(*) AS n_prior, CAST(sum(hit) AS BIGINT) AS n_hits,
       round(avg(CAST(hit AS DOUBLE)), 6) AS hist_rate
FROM hits GROUP BY ticker, w""")


def all_prior_context(spark, sf):
    rows = X.markets(spark, sf).select("market_ticker", "ticker", "cutoff")
    return tidy(context.all_prior_context_size(X.transcripts(spark, sf), rows).drop("cutoff"))


ALL_PRIOR_SQL = sql(X.MARKETS_SQL, r"""
SELECT market_ticker, m.ticker, count(t.doc_id) AS n_context_docs,
       CAST(coalesce(sum(len(regexp_extract_all(t.content, '\S+'))), 0) AS BIGINT) AS n_context_words,
       CAST(coalesce(sum(length(t.content)) + count(t.doc_id) - 1, 0) AS BIGINT) AS n_context_chars
FROM m LEFT JOIN t ON t.ticker = m.ticker AND t.call_date < m.cutoff
GROUP BY market_ticker, m.ticker""")


def context_order(spark, sf):
    """How the transcripts of every context follow one another where periods do not follow the dates."""
    rows = X.markets(spark, sf).select("market_ticker", "ticker", "cutoff")
    return tidy(context.context_order(X.late_transcripts(spark, sf), rows).drop("cutoff"))


CONTEXT_ORDER_SQL = sql(X.MARKETS_SQL + X.LATE_SQL, """
, c AS (SELECT DISTINCT ticker, cutoff FROM m),
o AS (SELECT c.ticker, c.cutoff, doc_id, row_number() OVER w AS place, lag(doc_id) OVER w AS prev
      FROM c JOIN lt ON lt.ticker = c.ticker AND lt.call_date < c.cutoff
      WINDOW w AS (PARTITION BY c.ticker, c.cutoff ORDER BY year, quarter, call_date, doc_id)),
s AS (SELECT ticker, cutoff, arg_min(doc_id, place) AS first_doc, arg_max(doc_id, place) AS last_doc, count(prev) AS n_seams,
             CAST(coalesce(sum((prev * 31 + doc_id) % 1000003), 0) AS BIGINT) AS seam_sum FROM o GROUP BY ALL)
SELECT market_ticker, m.ticker, first_doc, last_doc, coalesce(n_seams, 0) AS n_seams, coalesce(seam_sum, 0) AS seam_sum
FROM m LEFT JOIN s ON s.ticker = m.ticker AND s.cutoff = m.cutoff""")


def _recent(spark, sf):
    rows = X.markets(spark, sf).select("market_ticker", "ticker", "cutoff", "word")
    return context.recent_context(X.transcripts(spark, sf), rows, 2)


def recent_context(spark, sf):
    c = F.col("context")
    return tidy(_recent(spark, sf).select("market_ticker", F.length(c).alias("n_chars"), F.md5(c).alias("digest")))


RECENT_CTE = """,
ranked AS (SELECT market_ticker, word, t.content,
                  row_number() OVER (PARTITION BY market_ticker ORDER BY t.call_date DESC, t.year, t.quarter, t.doc_id) AS r
           FROM m JOIN t ON t.ticker = m.ticker AND t.call_date < m.cutoff),
ctx AS (SELECT m.market_ticker, m.word, coalesce(string_agg(content, ' ' ORDER BY r), '') AS context
        FROM m LEFT JOIN (SELECT * FROM ranked WHERE r <= 2) x ON x.market_ticker = m.market_ticker
        GROUP BY m.market_ticker, m.word)"""

RECENT_SQL = sql(X.MARKETS_SQL + RECENT_CTE, """
SELECT market_ticker, length(context) AS n_chars, md5(context) AS digest FROM ctx""")


def pair_inputs(spark, sf):
    """Word and context as one model input."""
    pair = T.pair_text(F.col("word"), F.col("context"))
    return tidy(_recent(spark, sf).select("market_ticker", F.length(pair).alias("n_chars"), F.md5(pair).alias("digest")))


PAIR_SQL = sql(X.MARKETS_SQL + RECENT_CTE, """
SELECT market_ticker, length(word || ' [SEP] ' || context) AS n_chars, md5(word || ' [SEP] ' || context) AS digest
FROM ctx""")


def truncated_pair_inputs(spark, sf):
    pair = T.pair_text(F.col("word"), T.head_tokens(F.col("context"), 512))
    return tidy(_recent(spark, sf).select("market_ticker", F.length(pair).alias("n_chars"), F.md5(pair).alias("digest")))


TRUNCATED_SQL = sql(X.MARKETS_SQL + RECENT_CTE, r"""
, cut AS (SELECT market_ticker,
                 word || ' [SEP] ' || array_to_string(list_slice(regexp_extract_all(context, '\S+'), 1, 512), ' ') AS pair
          FROM ctx)
SELECT market_ticker, length(pair) AS n_chars, md5(pair) AS digest FROM cut""")


def seen_before(spark, sf):
    rows = X.markets(spark, sf).select("market_ticker", "ticker", "word", "cutoff")
    return tidy(history.seen_before(X.transcripts(spark, sf), rows).drop("cutoff"))


SEEN_CTE = """,
seen AS (SELECT m.market_ticker, max(CASE WHEN contains(lower(t.content), lower(m.word)) THEN 1 ELSE 0 END) AS word_seen_before
         FROM m JOIN t ON t.ticker = m.ticker AND t.call_date < m.cutoff GROUP BY m.market_ticker)"""

SEEN_SQL = sql(X.MARKETS_SQL + SEEN_CTE, """
SELECT m.market_ticker, ticker, word, CAST(word_seen_before AS BIGINT) AS word_seen_before
FROM m LEFT JOIN seen ON seen.market_ticker = m.market_ticker""")


def recent_news_flag(spark, sf):
    """Calls of the same ticker stand in for news articles."""
    rows = X.markets(spark, sf).select("market_ticker", "ticker", "word", "cutoff")
    return tidy(history.in_recent_news(X.transcripts(spark, sf), rows).drop("cutoff"))


def news_article_flag(spark, sf):
    """The same flag from landed article files: one array per call, some articles with a title only."""
    d = F.col("doc_id")
    article = F.struct(F.concat(F.col("call_date").cast("string"), F.lit(" 08:30:00")).alias("publishedDate"),
                       F.when(d % 2 == 0, F.col("content")).otherwise("News").alias("title"),
                       F.when(d % 2 == 1, F.col("content")).alias("text"))
    files = X.transcripts(spark, sf).select(
        F.col("ticker").alias("folder"), F.concat("year", F.lit("Q"), "quarter").alias("stem"), F.to_json(F.array(article)).alias("value"))
    rows = X.markets(spark, sf).select("market_ticker", "ticker", "word", "cutoff")
    return tidy(history.in_recent_news(news.parse_news(files), rows).drop("cutoff"))


NEWS_SQL = sql(X.MARKETS_SQL, f"""
SELECT m.market_ticker, m.ticker, m.word,
       CAST(coalesce(max(CASE WHEN {says('m.word', 't.content')} THEN 1 ELSE 0 END), 0) AS BIGINT) AS in_recent_news
FROM m LEFT JOIN t ON t.ticker = m.ticker AND t.call_date BETWEEN m.cutoff - 30 AND m.cutoff
GROUP BY m.market_ticker, m.ticker, m.word""")


def targets(spark, sf):
    return X.markets(spark, sf).select(
        "market_ticker", "ticker", "word", (F.year("base_date") * 4 + F.quarter("base_date")).alias("target_period")
    )


def trailing_word_features(spark, sf):
    return tidy(trailing.word_features(X.transcripts(spark, sf), targets(spark, sf)))


WINDOW_CTE = f""",
tgt AS (SELECT DISTINCT ticker, word, year(base_date) * 4 + quarter(base_date) AS target_period FROM m),
calls AS (SELECT *, coalesce(call_date, make_date(period_num // 4, (period_num % 4) * 3 + 1, 1)) AS sort_key FROM t),
win AS (SELECT * FROM (
          SELECT g.ticker, g.target_period, c.doc_id, c.content,
                 row_number() OVER (PARTITION BY g.ticker, g.target_period
                                    ORDER BY c.sort_key DESC, c.period_num DESC, c.doc_id DESC) AS r
          FROM (SELECT DISTINCT ticker, target_period FROM tgt) g
          JOIN calls c ON c.ticker = g.ticker AND c.period_num < g.target_period) WHERE r <= 12),
need AS (SELECT DISTINCT win.ticker, tgt.word, win.doc_id, win.content
         FROM win JOIN tgt ON tgt.ticker = win.ticker AND tgt.target_period = win.target_period),
doc_cnt AS MATERIALIZED (SELECT ticker, word, doc_id, CAST({variant_count('word')} AS BIGINT) AS cnt FROM need),
cnts AS (SELECT tgt.ticker, tgt.word, tgt.target_period, r, cnt, CASE WHEN cnt > 0 THEN 1 ELSE 0 END AS said
         FROM tgt JOIN win ON win.ticker = tgt.ticker AND win.target_period = tgt.target_period
         JOIN doc_cnt d ON d.ticker = tgt.ticker AND d.word = tgt.word AND d.doc_id = win.doc_id),
agg AS (SELECT ticker, word, target_period, count(*) AS n_past, avg(CAST(said AS DOUBLE)) AS base_rate,
               avg(CAST(cnt AS DOUBLE)) AS mean_count, max(cnt) AS max_count, CAST(sum(cnt) AS BIGINT) AS total_mentions,
               avg(CAST(said AS DOUBLE)) FILTER (r <= 1) AS rate_last_1q, avg(CAST(said AS DOUBLE)) FILTER (r <= 2) AS rate_last_2q,
               avg(CAST(said AS DOUBLE)) FILTER (r <= 4) AS rate_last_4q,
               CAST(sum(cnt) FILTER (r <= 1) AS BIGINT) AS count_last_1q, CAST(sum(cnt) FILTER (r <= 2) AS BIGINT) AS count_last_2q,
               CAST(sum(cnt) FILTER (r <= 4) AS BIGINT) AS count_last_4q,
               max(said) FILTER (r <= 1) AS s1, max(said) FILTER (r <= 2) AS s2, max(said) FILTER (r <= 4) AS s4,
               CASE WHEN count(*) >= 2 THEN avg(CAST(cnt AS DOUBLE)) FILTER (r <= 2) ELSE 0 END AS r2,
               CASE WHEN count(*) >= 4 THEN avg(CAST(cnt AS DOUBLE)) FILTER (r BETWEEN 3 AND 4) ELSE 0 END AS o2
        FROM cnts GROUP BY ticker, word, target_period)"""

TRAILING_SQL = sql(X.MARKETS_SQL + WINDOW_CTE, r"""
SELECT ticker, word, CAST(target_period AS BIGINT) AS target_period, n_past, round(base_rate, 6) AS base_rate,
       round(mean_count, 6) AS mean_count, max_count, total_mentions, round(rate_last_1q, 6) AS rate_last_1q,
       round(rate_last_2q, 6) AS rate_last_2q, round(rate_last_4q, 6) AS rate_last_4q, count_last_1q, count_last_2q,
       count_last_4q, CAST(s1 AS BIGINT) AS said_last_1q, CAST(CASE WHEN n_past >= 2 THEN s2 ELSE 0 END AS BIGINT) AS said_last_2q,
       CAST(CASE WHEN n_past >= 4 THEN s4 ELSE 0 END AS BIGINT) AS said_last_4q, round(r2 - o2, 6) + 0.0::DOUBLE AS trend_delta,
       round(r2 / (o2 + 0.01::DOUBLE), 6) AS trend_ratio, CAST(CASE WHEN r2 > o2 THEN 1 ELSE 0 END AS BIGINT) AS is_trending_up,
       count_last_4q AS mgmt_count_4q, len(string_split_regex(word, '\s*/\s*')) AS word_n_variants,
       CAST(CASE WHEN regexp_matches(array_to_string(string_split_regex(word, '\s*/\s*'), '/'), ' ') THEN 1 ELSE 0 END AS BIGINT) AS word_is_phrase,
       length(word) AS word_char_len, 0 AS word_is_common_financial
FROM agg""")


def window_last_calls(spark, sf):
    """The last twelve earlier calls of each target."""
    return tidy(trailing.window_docs(X.transcripts(spark, sf), targets(spark, sf)))


WINDOW_SQL = sql(X.MARKETS_SQL + WINDOW_CTE, """
SELECT ticker, CAST(target_period AS BIGINT) AS target_period, r AS rank, doc_id FROM win""")


def sector_features(spark, sf):
    """Trailing rates per (ticker, word, period) with the company's sector from the dimension tables."""
    feats = trailing.trailing_features(trailing.window_counts(X.transcripts(spark, sf), targets(spark, sf)))
    nations = X.table(spark, sf, "nation").select(
        F.concat(F.lit("SRC"), F.col("n_nationkey").cast("string")).alias("ticker"),
        F.col("n_regionkey").cast("string").alias("sector"),
    )
    return (
        feats.select("ticker", "word", F.col("target_period").alias("period_num"), "base_rate")
        .join(F.broadcast(nations), "ticker", "left").withColumn("sector", F.coalesce("sector", F.lit("Unknown")))
    )


SECTOR_CTE = WINDOW_CTE + """,
feats AS (SELECT agg.ticker, word, target_period AS period_num, base_rate,
                 coalesce(CAST(n_regionkey AS VARCHAR), 'Unknown') AS sector
          FROM agg LEFT JOIN nation ON 'SRC' || n_nationkey = agg.ticker),
means AS (SELECT sector, word, period_num, avg(base_rate) AS sector_peer_base_rate FROM feats GROUP BY ALL)"""


def sector_peer_rate(spark, sf):
    return tidy(trailing.with_sector_peers(sector_features(spark, sf)))


SECTOR_PEER_SQL = sql(X.MARKETS_SQL + SECTOR_CTE, """
SELECT f.ticker, f.word, CAST(f.period_num AS BIGINT) AS period_num, round(base_rate, 6) AS base_rate, f.sector,
       round(coalesce(s.sector_peer_base_rate, base_rate), 6) AS sector_peer_base_rate
FROM feats f LEFT JOIN means s ON s.sector = f.sector AND s.word = f.word AND s.period_num = f.period_num - 1""")


def sector_word_period_mean(spark, sf):
    return tidy(trailing.sector_period_means(sector_features(spark, sf)))


SECTOR_MEAN_SQL = sql(X.MARKETS_SQL + SECTOR_CTE, """
SELECT sector, word, CAST(period_num AS BIGINT) AS period_num, round(sector_peer_base_rate, 6) AS sector_peer_base_rate FROM means""")


def market_word_features(spark, sf):
    """Features joined to the markets; markets without history drop out."""
    feats = trailing.word_features(X.transcripts(spark, sf), targets(spark, sf))
    joined = targets(spark, sf).join(feats, ["ticker", "word", "target_period"])
    return tidy(joined.select("market_ticker", "n_past", "base_rate", "count_last_4q"))


MARKET_FEATURES_SQL = sql(X.MARKETS_SQL + WINDOW_CTE, """
SELECT market_ticker, n_past, round(base_rate, 6) AS base_rate, count_last_4q
FROM m JOIN agg ON agg.ticker = m.ticker AND agg.word = m.word
     AND agg.target_period = year(m.base_date) * 4 + quarter(m.base_date)""")


QUERIES = {
    "hist_rate_asof": (hist_rate_asof, HIST_RATE_SQL),
    "mention_rate": (mention_rate, MENTION_RATE_SQL),
    "all_prior_context": (all_prior_context, ALL_PRIOR_SQL),
    "context_order": (context_order, CONTEXT_ORDER_SQL),
    "recent_context": (recent_context, RECENT_SQL),
    "pair_inputs": (pair_inputs, PAIR_SQL),
    "truncated_pair_inputs": (truncated_pair_inputs, TRUNCATED_SQL),
    "seen_before_flag": (seen_before, SEEN_SQL),
    "recent_news_flag": (recent_news_flag, NEWS_SQL),
    "news_article_flag": (news_article_flag, NEWS_SQL),
    "window_last_calls": (window_last_calls, WINDOW_SQL),
    "trailing_word_features": (trailing_word_features, TRAILING_SQL),
    "sector_peer_rate": (sector_peer_rate, SECTOR_PEER_SQL),
    "sector_word_period_mean": (sector_word_period_mean, SECTOR_MEAN_SQL),
    "market_word_features": (market_word_features, MARKET_FEATURES_SQL),
}
