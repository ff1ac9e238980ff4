"""URL rules: host suffixes and path prefixes, joined on short hashes and confirmed on full digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.session import fits_broadcast

# Rules up to this number go to every task; more are joined by shuffled keys, each dealt over SALTS copies.
MOST_BROADCAST = 50_000
SALTS = 32
# Longest rule: so many labels of a host, so many code points of a path.
MOST_LABELS, LONGEST_PATH = 127, 2048
RULE_COLUMNS = "host string, path string, verdict string"
# What the method answers where no rule fits.
DEFAULT = "allow"


def url_host(url: Column) -> Column:
    """What follows the first `://`, up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or url."""
    host = F.regexp_extract(_after_scheme(url), r"\A[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; empty without `://` or url."""
    return F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, verdict) of a short list as a table."""
    return spark.createDataFrame(rules, RULE_COLUMNS)


def _hashed(expression: Column) -> list[Column]:
    """The short hash that rows are joined by, and the full digest that confirms."""
    digest = F.sha2(expression, 256)
    return [F.substring(digest, 1, 8).alias("short_hash"), digest.alias("digest")]


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, url, host, path, rule and verdict, one row per page.

    A rule (host, path, verdict) fits a url of its host or a subdomain whose path starts with the rule's path. Of the
    rules that fit, the longest (code points of host and path) decides, then the longest host, then block before allow,
    then the smallest rule; without one rule is null and the verdict is default. Hosts are compared in lower case of
    A-Z, ports and user names are part of them.

    A url is expanded into the host suffixes and path prefixes of those sizes that rules have, so a very long url gives no
    more expressions than a short one. Expressions meet rules by eight hexadecimal digits of their SHA-256; the whole digest
    confirms. Rules of proven small number are broadcast; else both sides are shuffled by that hash and a part number drawn
    per page, so a host with a third of all pages is dealt over many tasks. All expressions of a page start in one
    task, where they fold to one row before the last shuffle.

    Null urls and urls without `://` have empty host and path; null page_ids and repeated rows are judged row by row;
    rules with a null, more labels than MOST_LABELS or a longer path than LONGEST_PATH raise an error. Rules given twice
    count once. Other columns of pages are not read; an empty table gives no row.
    """
    low = F.translate(F.col("host"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    listed = rules.select(low.alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")).distinct()
    labels = F.size(F.split("rule_host", r"\."))
    bad, label_counts, path_lengths = listed.agg(
        F.count_if(F.col("rule_host").isNull() | F.col("rule_path").isNull() | F.col("rule_verdict").isNull()
                   | (labels > MOST_LABELS) | (F.length("rule_path") > LONGEST_PATH)),
        F.collect_set(F.when(labels <= MOST_LABELS, labels)),
        F.collect_set(F.when(F.length("rule_path") <= LONGEST_PATH, F.length("rule_path")))).first()
    if bad:
        raise ValueError(f"{bad} rules have a null, over {MOST_LABELS} labels or a path over {LONGEST_PATH} code points")

    read = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "url",
                        url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    n_labels = F.size(F.split("host", r"\."))
    suffixes = F.array_compact(F.array(*(F.when(n_labels >= k, F.substring_index("host", ".", -k)) for k in sorted(label_counts))))
    prefixes = F.array_compact(F.array(*(F.when(F.length("path") >= k, F.substring("path", 1, k)) for k in sorted(path_lengths))))
    if not label_counts:
        return read.select("page_id", "url", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    # No host or path of a url holds a question mark, so the two parts of an expression are told apart.
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, F.lit("?"), p))))
    asked = read.select("*", F.explode_outer(expressions).alias("expression")).select(
        "row", "page_id", "url", "host", "path", *_hashed(F.col("expression")))

    known = listed.select(
        *_hashed(F.concat("rule_host", F.lit("?"), "rule_path")),
        F.struct((F.length("rule_host") + F.length("rule_path")).alias("length"), F.length("rule_host").alias("host_length"),
                 (F.col("rule_verdict") == "block").alias("blocks"), F.concat("rule_host", "rule_path").alias("rule"),
                 F.col("rule_verdict").alias("verdict")).alias("hit")).withColumnRenamed("digest", "rule_digest")
    if fits_broadcast(known, max_rows=MOST_BROADCAST):
        met = asked.join(F.broadcast(known), "short_hash", "left")
    else:
        part = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")
        dealt = known.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = asked.withColumn("part", part).join(dealt.hint("shuffle_hash"), ["short_hash", "part"], "left")
    hit = F.when(F.col("digest") == F.col("rule_digest"), F.col("hit"))
    judged = met.groupBy("row").agg(
        *(F.first(c).alias(c) for c in ("page_id", "url", "host", "path")), F.max(hit).alias("hit"))
    return judged.select("page_id", "url", "host", "path", F.col("hit.rule").alias("rule"),
                         F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
