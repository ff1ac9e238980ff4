"""Domain tables derived from the given star-schema tables, in Spark and as the same rules in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions import periods, trading
from earshot.session import spread_if_small

WORDS = ("the", "of the", "and / or", "To", "la", "it", "that / this", "for / for the")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One call per document; every 29th call has no date, several calls share a date.

    The test tables are single files of one row group, which one task reads: their rows are spread here.
    """
    return spread_if_small(_calls(spark, sf_dir), "doc_id")


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = F.date_add(F.lit("2022-06-01").cast("date"), (F.lit(2) * ((F.col("doc_id") * 33) % 740)).cast("int"))
    return (
        docs.select(
            "doc_id", F.upper("source").alias("ticker"), F.col("text").alias("content"), "lang",
            base.alias("base_date"),
        )
        .withColumn("call_date", F.when(F.col("doc_id") % 29 != 0, F.col("base_date")))
        .withColumn("period_num", periods.period_num(F.year("base_date"), F.quarter("base_date")) - 1)
        .withColumn("year", F.expr("(period_num - 1) div 4").cast("int"))
        .withColumn("quarter", ((F.col("period_num") - 1) % 4 + 1).cast("int"))
    )


def late_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth call is about a period a year back, so that periods do not follow the dates."""
    return transcripts(spark, sf_dir).withColumn("year", F.when(F.col("doc_id") % 5 == 0, F.col("year") - 1).otherwise(F.col("year")))


LATE_SQL = """
, lt AS (SELECT * REPLACE (CASE WHEN doc_id % 5 = 0 THEN year - 1 ELSE year END AS year) FROM t)"""

TRANSCRIPTS_SQL = """
t0 AS (
  SELECT doc_id, upper(source) AS ticker, text AS content, lang,
         DATE '2022-06-01' + CAST(2 * ((doc_id * 33) % 740) AS INTEGER) AS base_date
  FROM documents),
t AS (
  SELECT *, CASE WHEN doc_id % 29 <> 0 THEN base_date END AS call_date,
         year(base_date) * 4 + quarter(base_date) - 1 AS period_num,
         (year(base_date) * 4 + quarter(base_date) - 2) // 4 AS year,
         (year(base_date) * 4 + quarter(base_date) - 2) % 4 + 1 AS quarter
  FROM t0)"""


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One settled market per labelled document."""
    labels = table(spark, sf_dir, "labels")
    calls = _calls(spark, sf_dir).select("doc_id", "ticker", "base_date")
    d = F.col("doc_id")
    family = F.when(F.substring("ticker", 4, 10).cast("int") % 5 == 0, "KXMENTIONEARN").otherwise("KXEARNINGSMENTION")
    mentioned = F.col("quality") * (1 - F.col("toxic"))
    return (
        labels.join(calls, "doc_id")
        .withColumn("series_ticker", F.concat(family, F.col("ticker")))
        .withColumn("event_ticker", F.concat_ws("-", "series_ticker", F.upper(F.date_format("base_date", "yyMMMdd"))))
        .withColumn("market_ticker", F.concat(F.lit("MKT-"), d.cast("string")))
        .withColumn("word", F.element_at(F.array(*[F.lit(w) for w in WORDS]), (F.expr("(doc_id div 20) % 8") + 1).cast("int")))
        .withColumn("mentioned", mentioned.cast("int"))
        .withColumn("result", F.when(mentioned == 0, "no").when(d % 3 == 0, "Yes").otherwise("yes"))
        .withColumn("implied_prob", F.when(d % 17 != 0, ((d * 37) % 99 + 1) / 100.0))
        .withColumn("close_date", F.when(d % 31 == 0, "").otherwise(F.col("base_date").cast("string")))
        .withColumn("settlement_date", F.when(d % 97 == 0, "").otherwise(F.date_add("base_date", 1).cast("string")))
        .withColumn("status", F.when(d % 5 == 4, "active").when(d % 5 == 3, "settled").otherwise("finalized"))
        .withColumn("cutoff", periods.prediction_date(F.col("close_date"), F.col("settlement_date")))
        .drop("quality", "toxic")
    )


_WORD_LIST = "[" + ", ".join(f"'{w}'" for w in WORDS) + "]"

MARKETS_SQL = TRANSCRIPTS_SQL + f""",
m0 AS (
  SELECT l.doc_id, ticker, base_date,
         CASE WHEN CAST(substr(ticker, 4) AS INT) % 5 = 0 THEN 'KXMENTIONEARN' ELSE 'KXEARNINGSMENTION' END
           || ticker AS series_ticker,
         'MKT-' || l.doc_id AS market_ticker,
         ({_WORD_LIST})[CAST((l.doc_id // 20) % 8 + 1 AS INT)] AS word,
         quality * (1 - toxic) AS mentioned,
         CASE WHEN quality * (1 - toxic) = 0 THEN 'no' WHEN l.doc_id % 3 = 0 THEN 'Yes' ELSE 'yes' END AS result,
         CASE WHEN l.doc_id % 17 <> 0 THEN CAST((l.doc_id * 37) % 99 + 1 AS DOUBLE) / 100 END AS implied_prob,
         CASE WHEN l.doc_id % 31 = 0 THEN '' ELSE CAST(base_date AS VARCHAR) END AS close_date,
         CASE WHEN l.doc_id % 97 = 0 THEN '' ELSE CAST(base_date + 1 AS VARCHAR) END AS settlement_date,
         CASE l.doc_id % 5 WHEN 4 THEN 'active' WHEN 3 THEN 'settled' ELSE 'finalized' END AS status
  FROM labels l JOIN t ON t.doc_id = l.doc_id),
m AS (
  SELECT *, series_ticker || '-' || upper(strftime(base_date, '%y%b%d')) AS event_ticker,
         TRY_CAST(coalesce(nullif(close_date, ''), settlement_date) AS DATE) AS cutoff
  FROM m0)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markets with a model probability and its 0/1 prediction."""
    d = F.col("doc_id")
    return (
        markets(spark, sf_dir)
        .withColumn("prob_pos", ((d * 53) % 101) / 100.0)
        .withColumn("pred", trading.predicted(F.col("prob_pos")))
    )


SCORES_SQL = MARKETS_SQL + """,
s0 AS (SELECT *, CAST((doc_id * 53) % 101 AS DOUBLE) / 100 AS prob_pos FROM m),
s AS (SELECT *, CASE WHEN prob_pos >= 0.5 THEN 1 ELSE 0 END AS pred FROM s0)"""


def priced_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with a candle open mid; every sixth market has no candle."""
    d = F.col("doc_id")
    return (
        scores(spark, sf_dir)
        .withColumn("daily_open_mid", F.when(d % 6 != 0, ((d * 29) % 97 + 2) / 100.0))
        .withColumn("tx_prob", F.col("prob_pos"))
        .withColumn("final_prob", (F.col("prob_pos") + ((d * 61) % 101) / 100.0) / 2)
        .withColumn("market_yes", F.col("mentioned"))
    )


PRICED_SQL = SCORES_SQL + """,
p AS (SELECT *, CASE WHEN doc_id % 6 <> 0 THEN CAST((doc_id * 29) % 97 + 2 AS DOUBLE) / 100 END AS daily_open_mid,
             prob_pos AS tx_prob, (prob_pos + CAST((doc_id * 61) % 101 AS DOUBLE) / 100) / 2 AS final_prob,
             mentioned AS market_yes
      FROM s)"""


def quotes(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Bid / ask ticks per market and word."""
    raw = table(spark, sf_dir, "events") if events is None else events
    k = F.get_json_object("props", "$.k").cast("int")
    value = F.least(F.lit(0.99), F.greatest(F.lit(0.01), F.col("value") / 100))
    return (
        raw.select(
            "event_id", F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("market_ticker"),
            F.concat(F.lit("STK"), (F.col("user_id") % 20).cast("string")).alias("stock_ticker"),
            F.col("event_type").alias("word"), value.alias("mid"), F.col("value").alias("volume"), k.alias("k"),
        )
        .withColumn("yes_bid", F.greatest(F.col("mid") - 0.02, F.lit(0.0)))
        .withColumn("yes_ask", F.least(F.col("mid") + 0.02, F.lit(1.0)))
        .withColumn("no_bid", 1 - F.col("yes_ask"))
        .withColumn("no_ask", 1 - F.col("yes_bid"))
        .withColumn("prev_bid", F.when(F.col("k") < 40, 0.0).otherwise(F.col("k") / 100.0 - 0.03))
        .withColumn("prev_ask", F.when(F.col("k") < 40, 0.0).otherwise(F.col("k") / 100.0))
    )


QUOTES_SQL = """
q0 AS (
  SELECT event_id, ts, 'U' || user_id AS market_ticker, 'STK' || (user_id % 20) AS stock_ticker,
         event_type AS word, least(0.99::DOUBLE, greatest(0.01::DOUBLE, value / 100)) AS mid, value AS volume,
         CAST(json_extract(props, '$.k') AS INT) AS k
  FROM events),
q AS (
  SELECT *, greatest(mid - 0.02::DOUBLE, 0.0::DOUBLE) AS yes_bid, least(mid + 0.02::DOUBLE, 1.0::DOUBLE) AS yes_ask,
         1 - least(mid + 0.02::DOUBLE, 1.0::DOUBLE) AS no_bid, 1 - greatest(mid - 0.02::DOUBLE, 0.0::DOUBLE) AS no_ask,
         CASE WHEN k < 40 THEN 0.0::DOUBLE ELSE CAST(k AS DOUBLE) / 100 - 0.03::DOUBLE END AS prev_bid,
         CASE WHEN k < 40 THEN 0.0::DOUBLE ELSE CAST(k AS DOUBLE) / 100 END AS prev_ask
  FROM q0)"""


def experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric log: one record per line item."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("split"),
        F.col("l_shipdate").alias("timestamp"), F.col("l_orderkey").alias("run_id"),
        F.col("l_linenumber").alias("run_line"), F.col("l_discount").alias("f1_macro"),
        F.col("l_tax").alias("roi_per_trade"), F.col("l_quantity").alias("n"),
    )


EXPERIMENTS_SQL = """
x AS (
  SELECT l_returnflag AS model, l_linestatus AS split, l_shipdate AS "timestamp", l_orderkey AS run_id,
         l_linenumber AS run_line, l_discount AS f1_macro, l_tax AS roi_per_trade, l_quantity AS n
  FROM lineitem)"""

BOILERPLATE = (
    "This call contains forward-looking statements about plans. ",
    "Actual results may, for many reasons, differ materially from ours! ",
    "See the risk factors in our filings. ",
    "Non-GAAP measures are reconciled to GAAP in the release. ",
    "The Private Securities Litigation Reform Act applies? ",
    "Visit https://example.com/ir?x=1 or www.example.org now. ",
    "We signed a forward looking agreement. ",
)
OPENERS = (
    "Welcome to the Third Quarter results.", "Welcome to the Q2, 2024 results.", "Welcome to our Second-Half review.",
    "Good morning.", "Welcome to the 4th-quarter call.",
)


def _pick(values: tuple[str, ...]):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("doc_id") % len(values) + 1).cast("int"))


def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole transcript files (file_name, value) with header, operator line, boilerplate and footer."""
    d = F.col("doc_id")
    t = transcripts(spark, sf_dir)
    good = F.concat_ws(
        "_", F.lit("SRC"), F.col("year").cast("string"), F.concat(F.lit("Q"), F.col("quarter").cast("string"))
    )
    return t.select(
        "doc_id", "ticker", "year", "quarter",
        F.concat(
            F.when(d % 4 == 0, F.concat_ws("_", F.lit("SRC"), F.col("year").cast("string"), F.lit("Q?")))
            .when(d % 9 == 1, "notes-2024").otherwise(good),
            F.lit(".txt"),
        ).alias("file_name"),
        F.concat(
            F.lit("Symbol: "), F.col("ticker"), F.lit("\nPeriod: Q"),
            F.when(d % 4 == 0, "?").otherwise(F.col("quarter").cast("string")),
            F.lit(" "), F.col("year").cast("string"),
            F.when(d % 29 == 0, "").otherwise(F.concat(F.lit("\nDate: "), F.col("base_date").cast("string"))),
            F.lit("\n========================================\n\nOperator: "), _pick(OPENERS),
            F.lit("\nJane Doe: "), _pick(BOILERPLATE), F.lit("\n"), F.col("content"),
            F.when(d % 3 == 0, "\n  Related: more calls\nfooter line").otherwise(""),
        ).alias("value"),
    )


def _case(values: tuple[str, ...]) -> str:
    items = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{items}])[CAST(doc_id % {len(values)} + 1 AS INT)]"


RAW_FILES_SQL = TRANSCRIPTS_SQL + f""",
f AS (
  SELECT doc_id, ticker, year, quarter,
         CASE WHEN doc_id % 4 = 0 THEN 'SRC_' || year || '_Q?' WHEN doc_id % 9 = 1 THEN 'notes-2024'
              ELSE 'SRC_' || year || '_Q' || quarter END || '.txt' AS file_name,
         'Symbol: ' || ticker || chr(10) || 'Period: Q' || CASE WHEN doc_id % 4 = 0 THEN '?' ELSE CAST(quarter AS VARCHAR) END
           || ' ' || year || CASE WHEN doc_id % 29 = 0 THEN '' ELSE chr(10) || 'Date: ' || base_date END
           || chr(10) || '========================================' || chr(10) || chr(10) || 'Operator: ' || {_case(OPENERS)}
           || chr(10) || 'Jane Doe: ' || {_case(BOILERPLATE)} || chr(10) || content
           || CASE WHEN doc_id % 3 = 0 THEN chr(10) || '  Related: more calls' || chr(10) || 'footer line' ELSE '' END AS value
  FROM t)"""
