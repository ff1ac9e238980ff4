"""Registered queries of the corpus operators, over whole tables, and the SQL that checks them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from earshot.llm import (
    exact_dedup, html_main, language_id, line_dedup, merkle, minhash, packing, prefix_bpe, quality, quotes, spelling, token_files,
    url_filters,
)
from earshot.llm.common import table
from earshot.session import scratch_path

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_multi_50k.tiktoken"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN
    encoded = prefix_bpe.encode_documents(table(spark, sf_dir, "documents"), path, pattern)
    return prefix_bpe.encoding_digests(encoded, path, pattern)


def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op4_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("row_key")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify_languages(docs.select("doc_id", "text"), language_id.labelled_sample(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, trusted = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where("quality = 1")
    rated = quality.quality_rules(docs.select("doc_id", "text"), quality.ratio_weights(docs, trusted))
    return rated.drop("text")


def op8_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_main.extract_main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE))
    return token_files.with_ids_crc(token_files.read_token_files(spark, path))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.corpus_words(table(spark, sf_dir, "documents")))


# Rules (host, path, verdict) that the pages are judged by.
URL_RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filters.rule_table(spark, URL_RULES)
    return url_filters.filter_urls(table(spark, sf_dir, "pages"), rules).drop("url")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_manifest(merkle.leaves_of(table(spark, sf_dir, "documents")))


EXACT_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents),
     r AS (SELECT doc_id, sha256(plain) AS text_sha256, count(*) OVER (PARTITION BY plain) AS group_size,
                  first_value(doc_id) OVER (PARTITION BY plain ORDER BY points DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""

# A passage's first place is told by (doc_id, place): each document is one row of the table.
LINES_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
     f AS (SELECT doc_id, i, trim(line, E' \t\r\x0b\x0c') AS line FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
     w AS (SELECT doc_id, i, lead(i) OVER o AS i2, lead(i, 2) OVER o AS i3,
                  line || chr(10) || lead(line) OVER o || chr(10) || lead(line, 2) OVER o AS content FROM f WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
     n AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, i) AS k FROM w WHERE content IS NOT NULL),
     g AS (SELECT doc_id, i FROM n WHERE k > 1 UNION SELECT doc_id, i2 FROM n WHERE k > 1 UNION SELECT doc_id, i3 FROM n WHERE k > 1)
SELECT l.doc_id, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS text,
       count(*) AS n_lines, count(g.i) AS n_removed
FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id
"""

# The messages of the table hold no quote marks; the SQL says what that makes of them and fails if one appears.
CHAT_SQL = r"""
SELECT conv_id, turn, role, trim(text, E' \t\n') AS text, 0 AS n_quotes, 0 AS max_level, CAST(NULL AS BIGINT) AS reply_to, turn AS place,
       '<|' || role || E'|>\n' || trim(text, E' \t\n') || E'\n<|end|>' AS chat
FROM conversations WHERE NOT regexp_matches(coalesce(text, ''), '(^|\n)[ \t]*>')
"""

# crc32 from its definition: a table of 256 remainders, then one step per byte.
CRC_TABLE = """
tab AS (SELECT list(list_reduce([v] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                                lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY v) AS t
        FROM (SELECT unnest(range(256)) AS v))
"""


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of the UTF-8 of a text expression, given tab; hex digits two by two are the bytes."""
    digits = f"hex(encode({text}))"
    return (f"xor(4294967295, list_reduce([4294967295] || [('0x' || {digits}[2 * i + 1 : 2 * i + 2])::BIGINT FOR i IN range(length({digits}) // 2)], "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))")


SPELLING_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
     r AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
           FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)),
     d AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= 5 GROUP BY ALL),
     h AS (SELECT run, n, {crc32_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM d, tab),
     o AS (SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, (h % length(run))::BIGINT) || substring(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM h),
     w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM o WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
     -- Two words of one length are near when leaving out one place makes them equal; else when it makes one the other.
     g AS MATERIALIZED (SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM w)),
     p AS MATERIALIZED (
           SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM g a JOIN g b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
           UNION SELECT g.word, g.n, w.word, w.n FROM g JOIN w ON g.rest = w.word
           UNION SELECT w.word, w.n, g.word, g.n FROM g JOIN w ON g.rest = w.word),
     b AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS best, max(near_n) AS best_n FROM p GROUP BY word),
     f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form, CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
                        FROM w LEFT JOIN b USING (word)),
     c(word, stop) AS (SELECT word, word FROM f UNION ALL SELECT c.word, f.form FROM c JOIN f ON c.stop = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.stop AS root, f.n, f.n_near, f.form_n
FROM c JOIN f USING (word) JOIN f e ON c.stop = e.word WHERE e.form IS NULL
"""

URL_SQL = r"""
WITH r(rule_host, rule_path, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
     s AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
     u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM s),
     m AS (SELECT page_id, host, path, rule_host || rule_path AS rule, v FROM u LEFT JOIN r
           ON (host = rule_host OR suffix(host, '.' || rule_host)) AND prefix(path, rule_path))
SELECT page_id, any_value(host) AS host, any_value(path) AS path, first(rule ORDER BY length(rule) DESC) AS rule,
       coalesce(first(v ORDER BY length(rule) DESC), 'allow') AS verdict
FROM m GROUP BY page_id
"""


def _leaf_sql(n_chars: str) -> str:
    one = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"
    return "sha256(" + " || ".join(one.format(f) for f in ("doc_id", "source", "lang", n_chars, "text")) + ")"


MERKLE_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
     l AS MATERIALIZED (
        SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf, CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} ELSE {_leaf_sql("n_chars")} END AS changed,
               dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos FROM documents, tab),
     -- Each level as one list per tree; the next holds the digests of its runs of two.
     v(tree, level, d) AS (
        SELECT tree, 0, list(leaf ORDER BY pos) FROM l GROUP BY tree UNION ALL
        SELECT tree, level + 1, [sha256(d[2 * i + 1] || coalesce(d[2 * i + 2], '')) FOR i IN range((len(d) + 1) // 2)] FROM v WHERE len(d) > 1),
     s AS MATERIALIZED (SELECT tree, d[1] AS subroot FROM v WHERE len(d) = 1),
     t(level, d) AS (
        SELECT 0, list(subroot ORDER BY tree) FROM s UNION ALL
        SELECT level + 1, [sha256(d[2 * i + 1] || coalesce(d[2 * i + 2], '')) FOR i IN range((len(d) + 1) // 2)] FROM t WHERE len(d) > 1),
     q AS (SELECT tree, level, d FROM v WHERE len(d) > 1),
     e AS (SELECT max(level) AS height, tree FROM v GROUP BY tree),
     -- Steps of a leaf: below its subroot in its tree, above it in the upper one.
     x AS (SELECT doc_id, l.tree, q.level AS step, xor(l.pos >> q.level, 1) AS other, (l.pos >> q.level) & 1 AS odd, q.d FROM l JOIN q ON l.tree = q.tree
           UNION ALL SELECT doc_id, l.tree, height + t.level, xor(l.tree >> t.level, 1), (l.tree >> t.level) & 1, t.d FROM l JOIN e USING (tree) JOIN t ON len(t.d) > 1),
     y AS (SELECT doc_id, list({{'odd': odd, 'h': coalesce(d[other + 1], '')}} ORDER BY step) AS path FROM x GROUP BY doc_id),
     z(doc_id, k, h) AS (
        SELECT doc_id, 0, changed FROM l UNION ALL
        SELECT z.doc_id, k + 1, CASE WHEN path[k + 1].odd = 1 THEN sha256(path[k + 1].h || h) ELSE sha256(h || path[k + 1].h) END
        FROM z JOIN y ON z.doc_id = y.doc_id WHERE k < len(path))
SELECT l.doc_id, l.leaf, s.subroot, (SELECT d[1] FROM t WHERE len(d) = 1) AS root,
       sha256(coalesce(list_aggregate([p.h FOR p IN path], 'string_agg', ''), '')) AS proof_sha256, z.h AS folded_root,
       z.h = (SELECT d[1] FROM t WHERE len(d) = 1) AS verified
FROM l JOIN s USING (tree) LEFT JOIN y ON l.doc_id = y.doc_id JOIN z ON z.doc_id = l.doc_id AND z.k = coalesce(len(path), 0)
"""

QUERIES = {
    "op1_line_dedup": (op1_line_dedup, LINES_SQL),
    "op2_byte_bpe": (op2_byte_bpe, None),
    "op3_minhash_neardup": (op3_minhash_neardup, None),
    "op4_chat_quotes": (op4_chat_quotes, CHAT_SQL),
    "op5_exact_dedup": (op5_exact_dedup, EXACT_SQL),
    "op6_language_id": (op6_language_id, None),
    "op7_quality_rules": (op7_quality_rules, None),
    "op8_html_main": (op8_html_main, None),
    "op9_token_files": (op9_token_files, None),
    "op10_packing": (op10_packing, None),
    "op11_spelling_variants": (op11_spelling_variants, SPELLING_SQL),
    "op12_url_filters": (op12_url_filters, URL_SQL),
    "op13_merkle_manifest": (op13_merkle_manifest, MERKLE_SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
