"""Cleaning, word, parsing and repair queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from earshot.catalog.base import NON_WORD, count_of, says, sql, tidy, variant_count
from earshot.constants import SAFE_HARBOR_PHRASES
from earshot.functions import text as T
from earshot.functions import words as W
from earshot.operators import tfidf, transcripts
from earshot.plans import fixtures as X
from earshot.session import materialize
from earshot.sources import transcripts as sources


def digest(df, col: str):
    """Long text as its length and hash."""
    return df.withColumn("n_chars", F.length(col)).withColumn("digest", F.md5(col)).drop(col)


def clean_transcripts(spark, sf):
    raw = X.raw_files(spark, sf).select("doc_id", T.clean_transcript(F.col("value")).alias("cleaned"))
    return tidy(digest(raw, "cleaned"))


SPACE = r"[\s\x0B]+"


def _strip_sentences(column: str) -> str:
    for phrase in SAFE_HARBOR_PHRASES:
        column = f"regexp_replace({column}, '[^.?!]*{phrase}[^.?!]*[.?!]', ' ', 'gi')"
    return column


def _clean_sql(column: str) -> str:
    footer = rf"regexp_replace(nfc_normalize({column}), '\n\s*Related\s*:.*\z', '', 'is')"
    urls = rf"regexp_replace({footer}, '(?:https?://|www\.)\S+', ' ', 'gi')"
    return rf"trim(regexp_replace(lower({_strip_sentences(urls)}), '\s+', ' ', 'g'))"


CLEAN_SQL = sql(X.RAW_FILES_SQL, f"""
SELECT doc_id, length(c) AS n_chars, md5(c) AS digest FROM (SELECT doc_id, {_clean_sql('value')} AS c FROM f)""")


def safe_harbor_removal(spark, sf):
    out = T.collapse_whitespace(T.strip_safe_harbor(F.col("value")))
    return tidy(digest(X.raw_files(spark, sf).select("doc_id", out.alias("text")), "text"))


SAFE_SQL = sql(X.RAW_FILES_SQL, rf"""
SELECT doc_id, length(c) AS n_chars, md5(c) AS digest
FROM (SELECT doc_id, trim(regexp_replace({_strip_sentences('value')}, '\s+', ' ', 'g')) AS c FROM f)""")


def word_counts(spark, sf):
    return tidy(X.transcripts(spark, sf).select("doc_id", T.word_count(F.col("content")).alias("n_words")))


def file_name_keys(spark, sf):
    """Year and quarter from both file name forms; other names give 0."""
    f = sources.with_stem(X.raw_files(spark, sf))
    cached = F.concat(F.col("year").cast("string"), F.lit("Q"), F.col("quarter").cast("string"))
    stem = F.when(F.col("doc_id") % 3 == 0, cached).when(F.col("doc_id") % 7 == 0, F.concat(F.lit("BRK-B_"), cached)).otherwise(F.col("stem"))
    return tidy(f.select("doc_id", T.stem_year(stem).alias("year"), T.stem_quarter(stem).alias("quarter")))


FILE_KEYS_SQL = sql(X.RAW_FILES_SQL, r"""
, st AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN year || 'Q' || quarter WHEN doc_id % 7 = 0 THEN 'BRK-B_' || year || 'Q' || quarter
                        ELSE regexp_replace(file_name, '\.[^.]*$', '') END AS stem FROM f)
SELECT doc_id, CAST(coalesce(nullif(regexp_extract(stem, '^(\d{4})Q(\d)$', 1), ''), nullif(regexp_extract(stem, '^[A-Za-z]+_(\d{4})_Q(\d)$', 1), ''), '0') AS BIGINT) AS year,
       CAST(coalesce(nullif(regexp_extract(stem, '^(\d{4})Q(\d)$', 2), ''), nullif(regexp_extract(stem, '^[A-Za-z]+_(\d{4})_Q(\d)$', 2), ''), '0') AS BIGINT) AS quarter FROM st""")


def word_variants(spark, sf):
    w = F.col("word")
    words = X.markets(spark, sf).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return tidy(words.select("word", "n", F.array_join(W.word_variants(w), "|").alias("variants")))


def word_shape(spark, sf):
    """Shape features of part names and market words."""
    w = F.col("word")
    parts = X.table(spark, sf, "part").select(F.concat(F.col("p_name"), F.lit(" / Market")).alias("word"))
    rows = parts.union(X.markets(spark, sf).select("word")).distinct()
    return tidy(rows.select("word", W.n_variants(w).alias("n_variants"), W.is_phrase(w).alias("is_phrase"),
                            F.length(w).alias("char_len"), W.is_common_financial(w).alias("is_common")))


SHAPE_SQL = sql(X.MARKETS_SQL, r"""
, w AS (SELECT p_name || ' / Market' AS word FROM part UNION SELECT word FROM m),
v AS (SELECT word, [trim(x) FOR x IN string_split_regex(lower(word), '\s*/\s*')] AS vs FROM w)
SELECT word, len(vs) AS n_variants, CASE WHEN len([1 FOR x IN vs IF contains(x, ' ')]) > 0 THEN 1 ELSE 0 END AS is_phrase, length(word) AS char_len,
       CASE WHEN len(list_intersect(vs, ['revenue','growth','quarter','year','billion','million','margin','profit','cost','market','customer','business'])) > 0 THEN 1 ELSE 0 END AS is_common
FROM v""")


def _own_text(spark, sf):
    m = X.markets(spark, sf).select("doc_id", "market_ticker", "word")
    return m.join(X.transcripts(spark, sf).select("doc_id", "content"), "doc_id")


def mention_counts(spark, sf):
    """Mentions of every market's word in its own call."""
    return tidy(_own_text(spark, sf).select("market_ticker", W.count_mentions(F.col("content"), F.col("word")).alias("n_mentions")))


def mention_flags(spark, sf):
    """Whole-word literal match next to the plain substring match."""
    low = F.lower("content")
    return tidy(_own_text(spark, sf).select(
        "market_ticker", W.says_word(low, F.lower("word")).alias("whole_word"),
        W.contains_word(F.col("content"), F.col("word")).alias("substring")))


OWN_SQL = X.MARKETS_SQL + ", o AS (SELECT market_ticker, word, content FROM m JOIN t ON t.doc_id = m.doc_id)"


def quarter_inference(spark, sf):
    return tidy(X.raw_files(spark, sf).select("doc_id", T.infer_quarter(F.col("value")).alias("quarter")))


def _quarter_sql(text: str) -> str:
    """Spelled quarter, then Q1-Q4 with the next character consumed, then half."""
    named = f"lower(regexp_extract({text}, '(?i)(?:^|{NON_WORD})(first|second|third|fourth|1st|2nd|3rd|4th)[\\s-]quarter(?:$|{NON_WORD})', 1))"
    coded = f"regexp_extract({text}, '(?:^|{NON_WORD})Q([1-4])[\\s,.\\-;\\d]', 1)"
    half = f"lower(regexp_extract({text}, '(?i)(?:^|{NON_WORD})(first|second)[\\s-]half(?:$|{NON_WORD})', 1))"
    return (
        f"coalesce(CASE WHEN {named} IN ('first', '1st') THEN 1 WHEN {named} IN ('second', '2nd') THEN 2 "
        f"WHEN {named} IN ('third', '3rd') THEN 3 WHEN {named} IN ('fourth', '4th') THEN 4 END, "
        f"TRY_CAST({coded} AS INT), CASE {half} WHEN 'first' THEN 2 WHEN 'second' THEN 4 END)"
    )


QUARTER_CTE = f""",
hd AS (SELECT *, regexp_extract(value, '(?m)^Operator:(.+)$', 1) AS op, TRY_CAST(trim(regexp_extract(value, '(?m)^Date:\\s*(.+)$', 1)) AS DATE) AS hdate FROM f),
qi AS (SELECT *, coalesce({_quarter_sql('op')}, {_quarter_sql('value')}, (quarter(hdate) + 2) % 4 + 1) AS inferred FROM hd)"""


def good_file_names(spark, sf):
    n = F.col("file_name")
    return tidy(X.raw_files(spark, sf).select(
        "doc_id", T.is_good_name(n).alias("is_good"), T.name_ticker(n).alias("name_ticker"), T.name_year(n).alias("name_year")))


def _files(spark, sf):
    """Two hundred tickers share folders, so names collide."""
    return X.raw_files(spark, sf).withColumn("folder", F.col("ticker")).withColumn(
        "file_name", F.when(F.col("doc_id") % 12 == 0, F.regexp_replace("file_name", r"Q\?", F.concat(F.lit("Qx"), F.col("doc_id").cast("string"))))
        .otherwise(F.col("file_name")))


FILES_CTE = QUARTER_CTE + r""",
fl AS (SELECT *, ticker AS folder, CASE WHEN doc_id % 12 = 0 THEN regexp_replace(file_name, 'Q\?', 'Qx' || doc_id) ELSE file_name END AS fname FROM qi),
br AS (SELECT *, CASE WHEN regexp_matches(fname, '^([A-Z]+)_(\d{4})_Q.*\.txt$') AND inferred IS NOT NULL
                      THEN regexp_extract(fname, '^([A-Z]+)_(\d{4})_Q.*\.txt$', 1) || '_' || regexp_extract(fname, '^([A-Z]+)_(\d{4})_Q.*\.txt$', 2) || '_Q' || inferred || '.txt' END AS new_name
       FROM fl WHERE NOT regexp_matches(fname, '^[A-Z]+_\d{4}_Q[1-4]\.txt$')),
ac AS (SELECT *, CASE WHEN NOT regexp_matches(fname, '^([A-Z]+)_(\d{4})_Q.*\.txt$') THEN 'bad_name' WHEN inferred IS NULL THEN 'no_quarter'
                      WHEN EXISTS (SELECT 1 FROM fl g WHERE g.folder = br.folder AND g.fname = br.new_name) THEN 'target_exists'
                      WHEN fname = min(fname) OVER (PARTITION BY folder, new_name) THEN 'fix' ELSE 'target_exists' END AS action FROM br)"""


def repair_plan(spark, sf):
    """Proposed names, collisions and patched headers of badly named files."""
    plan = transcripts.repair_plan(_files(spark, sf))
    return tidy(plan.select("doc_id", "folder", "file_name", "inferred", "new_name", "action", F.md5("patched").alias("digest")))


REPAIR_SQL = sql(X.RAW_FILES_SQL + FILES_CTE, r"""
SELECT doc_id, folder, fname AS file_name, CAST(inferred AS BIGINT) AS inferred, new_name, action,
       CASE WHEN action = 'fix' THEN md5(regexp_replace(value, '(?m)^(Period:\s*Q)\S*(\s+\d{4})', '\1' || inferred || '\2')) END AS digest FROM ac""")


def period_header_patch(spark, sf):
    out = T.patch_period_header(F.col("value"), F.lit(3))
    return tidy(digest(X.raw_files(spark, sf).select("doc_id", out.alias("text")), "text"))


def header_transcripts(spark, sf):
    """Header fields and body of whole transcript files."""
    parsed = sources.parse_text_transcripts(sources.with_stem(X.raw_files(spark, sf).drop("year", "quarter")))
    return tidy(digest(parsed.select("doc_id", "year", "quarter", "date_text", "call_date", "content"), "content"))


HEADER_SQL = sql(X.RAW_FILES_SQL, r"""
, st AS (SELECT doc_id, value, regexp_replace(file_name, '\.[^.]*$', '') AS stem, nullif(regexp_extract(value, '(?m)^Date:\s*(\S+)', 1), '') AS d,
                trim(regexp_replace(regexp_replace(value, '(?m)^(Symbol|Period|Date):.*\n', '', 'g'), '=+\n', '', 'g'), E' \n\t\r') AS body FROM f)
SELECT doc_id, CAST(coalesce(nullif(regexp_extract(stem, '^[A-Za-z]+_(\d{4})_Q(\d)$', 1), ''), '0') AS BIGINT) AS year,
       CAST(coalesce(nullif(regexp_extract(stem, '^[A-Za-z]+_(\d{4})_Q(\d)$', 2), ''), '0') AS BIGINT) AS quarter, d AS date_text,
       CAST(TRY_CAST(d AS DATE) AS VARCHAR) AS call_date, length(body) AS n_chars, md5(body) AS digest FROM st""")


def speaker_transcripts(spark, sf):
    files = sources.with_stem(X.raw_files(spark, sf)).drop("year", "quarter", "ticker")
    parsed = sources.parse_speaker_transcripts(files)
    return tidy(digest(parsed.select("doc_id", "ticker", "year", "quarter", "call_date", "period_num", "content"), "content"))


SPEAKER_SQL = sql(X.RAW_FILES_SQL, r"""
, h AS (SELECT doc_id, value, regexp_extract(value, 'Symbol:\s*(\S+)', 1) AS tk, regexp_extract(value, '(?i)Period:\s*Q(\d)\s*(\d{4})', 1) AS q,
               regexp_extract(value, '(?i)Period:\s*Q(\d)\s*(\d{4})', 2) AS y, nullif(regexp_extract(value, 'Date:\s*(\d{4}-\d{2}-\d{2})', 1), '') AS d,
               [trim(x, E' \t\r\f') FOR x IN string_split(value, chr(10))] AS ls FROM f),
b AS (SELECT *, [x FOR x IN list_slice(ls, coalesce(list_position([regexp_full_match(x, '={4,}') FOR x IN ls], true), 0) + 1, len(ls)) IF x <> ''] AS body FROM h WHERE q <> ''),
sp AS (SELECT *, array_to_string([x FOR x IN [CASE WHEN regexp_matches(x, '^([A-Z][A-Za-z\s.\-]+):\s*(.*)')
                                                   THEN trim(regexp_extract(x, '^([A-Z][A-Za-z\s.\-]+):\s*(.*)', 2)) ELSE x END FOR x IN body] IF x <> ''], ' ') AS spoken FROM b),
c AS (SELECT *, CASE WHEN length(spoken) < 500 THEN array_to_string(body, ' ') ELSE spoken END AS content FROM sp)
SELECT doc_id, tk AS ticker, CAST(y AS BIGINT) AS year, CAST(q AS BIGINT) AS quarter, CAST(TRY_CAST(d AS DATE) AS VARCHAR) AS call_date,
       CAST(y AS BIGINT) * 4 + CAST(q AS BIGINT) AS period_num, length(content) AS n_chars, md5(content) AS digest
FROM c WHERE d IS NULL OR TRY_CAST(d AS DATE) IS NOT NULL""")


def _roots(spark, sf):
    """Labelled calls form the first root, all others the second; both hold several files per key."""
    t = X.transcripts(spark, sf).withColumn("filename", F.format_string("f%09d.txt", "doc_id"))
    labels = X.table(spark, sf, "labels").select("doc_id")
    return t.join(labels, "doc_id", "left_semi"), t.join(labels, "doc_id", "left_anti")


def root_precedence(spark, sf):
    chosen = transcripts.prefer_roots(list(_roots(spark, sf)))
    return tidy(chosen.select("doc_id", "ticker", "year", "quarter", "priority"))


PRECEDENCE_SQL = sql(X.TRANSCRIPTS_SQL, """
, r AS (SELECT t.*, CASE WHEN l.doc_id IS NULL THEN 1 ELSE 0 END AS priority FROM t LEFT JOIN labels l ON l.doc_id = t.doc_id)
SELECT doc_id, ticker, CAST(year AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter, priority FROM r
QUALIFY row_number() OVER (PARTITION BY ticker, year, quarter ORDER BY priority, doc_id) = 1""")


def ticker_discovery(spark, sf):
    a, b = _roots(spark, sf)
    return tidy(transcripts.discover_tickers(a.select(F.concat("ticker", F.lit("_transcripts")).alias("ticker")), b))


def sidecar_dates(spark, sf):
    """Call dates looked up by (ticker, year, quarter)."""
    t = X.transcripts(spark, sf)
    side = t.groupBy("ticker", "year", "quarter").agg(F.max("call_date").alias("call_date"))
    docs = t.select("doc_id", "ticker", "year", (F.col("quarter") % 4 + 1).cast("int").alias("quarter"))
    return tidy(sources.attach_call_dates(docs, side))


SIDECAR_SQL = sql(X.TRANSCRIPTS_SQL, """
, side AS (SELECT ticker, year, quarter, max(call_date) AS call_date FROM t GROUP BY ALL),
d AS (SELECT doc_id, ticker, year, quarter % 4 + 1 AS quarter FROM t)
SELECT doc_id, d.ticker, CAST(d.year AS BIGINT) AS year, CAST(d.quarter AS BIGINT) AS quarter, CAST(side.call_date AS VARCHAR) AS call_date
FROM d LEFT JOIN side ON side.ticker = d.ticker AND side.year = d.year AND side.quarter = d.quarter""")


def company_transcripts(spark, sf):
    """Cleaned calls of one company in period order."""
    t = sources.load_transcripts(X.transcripts(spark, sf), "SRC7")
    return tidy(digest(t.select("doc_id", "year", "quarter", "call_date", "content"), "content"))


def _cleaned(spark, sf):
    raw = sources.parse_text_transcripts(sources.with_stem(X.raw_files(spark, sf).drop("year", "quarter")))
    return transcripts.clean_documents(raw, min_words=50)


def preprocess_stats(spark, sf):
    return tidy(transcripts.preprocess_stats(_cleaned(spark, sf)))


def _preprocess_sql() -> str:
    body = r"trim(regexp_replace(regexp_replace(value, '(?m)^(Symbol|Period|Date):.*\n', '', 'g'), '=+\n', '', 'g'), E' \n\t\r')"
    return sql(X.RAW_FILES_SQL, rf"""
, st AS (SELECT ticker, CASE WHEN regexp_matches(file_name, '^[A-Za-z]+_\d{{4}}_Q\d\.txt$') THEN 1 ELSE 0 END AS named,
                TRY_CAST(regexp_extract(value, '(?m)^Date:\s*(\S+)', 1) AS DATE) AS d, len(regexp_extract_all({_clean_sql(body)}, '\S+')) AS n FROM f)
SELECT ticker, count(*) FILTER (named = 1 AND n >= 50) AS n_written, count(*) FILTER (named = 1 AND n >= 50 AND d IS NULL) AS n_missing_date,
       count(*) FILTER (named = 0) AS n_unparseable, count(*) FILTER (named = 1 AND n < 50) AS n_too_short FROM st GROUP BY ticker""")


def _train_rows(spark, sf):
    return X.markets(spark, sf).select("market_ticker", "ticker", "cutoff")


def tfidf_vocabulary(spark, sf):
    return tidy(tfidf.corpus_vocabulary(X.transcripts(spark, sf), _train_rows(spark, sf)))


TOKENS = r"regexp_extract_all(lower(content), '[\p{L}\p{M}\p{N}_]{2,}')"

TERM_CTE = f""",
tok AS MATERIALIZED (SELECT ticker, call_date, doc_id, {TOKENS} AS tk FROM t WHERE call_date IS NOT NULL),
ends AS (SELECT ticker, call_date, tk[1] AS head, lag(tk[-1]) OVER (PARTITION BY ticker ORDER BY call_date, doc_id) AS prev FROM tok WHERE len(tk) > 0),
terms AS (SELECT ticker, call_date, unnest(tk) AS term FROM tok
          UNION ALL SELECT ticker, call_date, unnest([tk[i] || ' ' || tk[i + 1] FOR i IN range(1, len(tk))]) FROM tok WHERE len(tk) > 1
          UNION ALL SELECT ticker, call_date, prev || ' ' || head FROM ends WHERE prev IS NOT NULL),
daily AS MATERIALIZED (SELECT ticker, call_date, term, count(*) AS cnt FROM terms GROUP BY ALL),
ctx AS (SELECT ticker, cutoff, count(*) AS mult FROM m WHERE cutoff IS NOT NULL GROUP BY ALL),
ct AS MATERIALIZED (SELECT c.ticker, c.cutoff, mult, term, sum(cnt) AS tf FROM ctx c JOIN daily d ON d.ticker = c.ticker AND d.call_date < c.cutoff GROUP BY ALL),
voc AS MATERIALIZED (SELECT term, CAST(sum(mult) AS BIGINT) AS df, CAST(sum(tf * mult) AS BIGINT) AS corpus_tf,
                            ln((1 + (SELECT count(*) FROM m)) / (1 + sum(mult))) + 1 AS idf
        FROM ct GROUP BY term HAVING sum(mult) >= 3 AND sum(mult) <= 0.95::DOUBLE * (SELECT count(*) FROM m)
        ORDER BY sum(tf * mult) DESC, term LIMIT 10000)"""

VOCABULARY_SQL = sql(X.MARKETS_SQL + TERM_CTE, "SELECT term, df, corpus_tf, round(idf, 6) AS idf FROM voc")


def tfidf_period_order(spark, sf):
    """The vocabulary of contexts in (year, quarter) order where periods do not follow the dates."""
    return tidy(tfidf.corpus_vocabulary(X.late_transcripts(spark, sf), _train_rows(spark, sf)))


# Terms inside calls are counted per date, those across two calls per context.
PERIOD_ORDER_SQL = sql(X.MARKETS_SQL + X.LATE_SQL, f"""
, tok AS MATERIALIZED (SELECT ticker, year, quarter, call_date, doc_id, {TOKENS} AS tk FROM lt WHERE call_date IS NOT NULL),
terms AS (SELECT ticker, call_date, unnest(tk) AS term FROM tok
          UNION ALL SELECT ticker, call_date, unnest([tk[i] || ' ' || tk[i + 1] FOR i IN range(1, len(tk))]) FROM tok WHERE len(tk) > 1),
daily AS MATERIALIZED (SELECT ticker, call_date, term, count(*) AS cnt FROM terms GROUP BY ALL),
ctx AS (SELECT ticker, cutoff, count(*) AS mult FROM m WHERE cutoff IS NOT NULL GROUP BY ALL),
ends AS (SELECT ticker, year, quarter, call_date, doc_id, tk[1] AS head, tk[-1] AS tail FROM tok WHERE len(tk) > 0),
seams AS (SELECT c.ticker, c.cutoff, mult, head, lag(tail) OVER (PARTITION BY c.ticker, c.cutoff ORDER BY year, quarter, call_date, doc_id) AS prev
          FROM ctx c JOIN ends e ON e.ticker = c.ticker AND e.call_date < c.cutoff),
parts AS (SELECT c.ticker, c.cutoff, mult, term, cnt FROM ctx c JOIN daily d ON d.ticker = c.ticker AND d.call_date < c.cutoff
          UNION ALL SELECT ticker, cutoff, mult, prev || ' ' || head, 1 FROM seams WHERE prev IS NOT NULL),
ct AS MATERIALIZED (SELECT ticker, cutoff, mult, term, sum(cnt) AS tf FROM parts GROUP BY ALL)
SELECT term, CAST(sum(mult) AS BIGINT) AS df, CAST(sum(tf * mult) AS BIGINT) AS corpus_tf,
       round(ln((1 + (SELECT count(*) FROM m)) / (1 + sum(mult))) + 1, 6) AS idf
FROM ct GROUP BY term HAVING sum(mult) >= 3 AND sum(mult) <= 0.95::DOUBLE * (SELECT count(*) FROM m)
ORDER BY sum(tf * mult) DESC, term LIMIT 10000""")


def tfidf_contexts(spark, sf):
    """Size, weight sum and largest weight of every market's context vector."""
    docs = X.transcripts(spark, sf)
    rows = _train_rows(spark, sf)
    ends = materialize(tfidf.ends(docs), "ends")
    vocabulary = tfidf.corpus_vocabulary(docs, rows, outer=ends)
    daily = materialize(tfidf.daily_term_counts(docs, vocabulary, ends), "daily-terms")
    vectors = tfidf.context_vectors(daily, rows, vocabulary)
    per_context = vectors.groupBy("ticker", "cutoff").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("weight").alias("weight_sum"), F.max("weight").alias("max_weight"))
    return tidy(rows.join(per_context, ["ticker", "cutoff"], "left").drop("cutoff"), 5)


CONTEXT_SQL = sql(X.MARKETS_SQL + TERM_CTE, """
, raw AS (SELECT ticker, cutoff, (1 + ln(tf)) * idf AS w FROM ct JOIN voc ON voc.term = ct.term),
nrm AS (SELECT ticker, cutoff, count(*) AS n_terms, sum(w) / sqrt(sum(w * w)) AS weight_sum, max(w) / sqrt(sum(w * w)) AS max_weight FROM raw GROUP BY ALL)
SELECT market_ticker, m.ticker, n_terms, round(weight_sum, 5) AS weight_sum, round(max_weight, 5) AS max_weight
FROM m LEFT JOIN nrm ON nrm.ticker = m.ticker AND nrm.cutoff = m.cutoff""")

QUERIES = {
    "clean_transcripts": (clean_transcripts, CLEAN_SQL),
    "safe_harbor_removal": (safe_harbor_removal, SAFE_SQL),
    "word_counts": (word_counts, sql(X.TRANSCRIPTS_SQL, r"SELECT doc_id, len(regexp_extract_all(content, '\S+')) AS n_words FROM t")),
    "file_name_keys": (file_name_keys, FILE_KEYS_SQL),
    "word_variants": (word_variants, sql(X.MARKETS_SQL, r"""
SELECT word, count(*) AS n, array_to_string(string_split_regex(lower(word), '\s*/\s*'), '|') AS variants FROM m GROUP BY word""")),
    "word_shape": (word_shape, SHAPE_SQL),
    "mention_counts": (mention_counts, sql(OWN_SQL, f"SELECT market_ticker, CAST({variant_count('word')} AS BIGINT) AS n_mentions FROM o")),
    "mention_flags": (mention_flags, sql(OWN_SQL, f"""
SELECT market_ticker, CASE WHEN {says('word')} THEN 1 ELSE 0 END AS whole_word,
       CASE WHEN contains(lower(content), lower(word)) THEN 1 ELSE 0 END AS substring FROM o""")),
    "quarter_inference": (quarter_inference, sql(X.RAW_FILES_SQL + QUARTER_CTE, "SELECT doc_id, CAST(inferred AS BIGINT) AS quarter FROM qi")),
    "good_file_names": (good_file_names, sql(X.RAW_FILES_SQL, r"""
SELECT doc_id, CASE WHEN regexp_matches(file_name, '^[A-Z]+_\d{4}_Q[1-4]\.txt$') THEN 1 ELSE 0 END AS is_good,
       nullif(regexp_extract(file_name, '^([A-Z]+)_(\d{4})_Q.*\.txt$', 1), '') AS name_ticker,
       nullif(regexp_extract(file_name, '^([A-Z]+)_(\d{4})_Q.*\.txt$', 2), '') AS name_year FROM f""")),
    "repair_plan": (repair_plan, REPAIR_SQL),
    "period_header_patch": (period_header_patch, sql(X.RAW_FILES_SQL, r"""
SELECT doc_id, length(c) AS n_chars, md5(c) AS digest
FROM (SELECT doc_id, regexp_replace(value, '(?m)^(Period:\s*Q)\S*(\s+\d{4})', '\g<1>3\2') AS c FROM f)""".replace(r"\g<1>", r"\1"))),
    "header_transcripts": (header_transcripts, HEADER_SQL),
    "speaker_transcripts": (speaker_transcripts, SPEAKER_SQL),
    "root_precedence": (root_precedence, PRECEDENCE_SQL),
    "ticker_discovery": (ticker_discovery, sql(X.TRANSCRIPTS_SQL, "SELECT DISTINCT ticker FROM t")),
    "sidecar_dates": (sidecar_dates, SIDECAR_SQL),
    "company_transcripts": (company_transcripts, sql(X.TRANSCRIPTS_SQL, """
SELECT doc_id, CAST(year AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter, CAST(call_date AS VARCHAR) AS call_date,
       length(content) AS n_chars, md5(content) AS digest FROM t WHERE ticker = 'SRC7'""")),
    "preprocess_stats": (preprocess_stats, _preprocess_sql()),
    "tfidf_vocabulary": (tfidf_vocabulary, VOCABULARY_SQL),
    "tfidf_contexts": (tfidf_contexts, CONTEXT_SQL),
    "tfidf_period_order": (tfidf_period_order, PERIOD_ORDER_SQL),
}
