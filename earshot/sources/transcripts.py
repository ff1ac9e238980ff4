"""Landed transcripts: whole text files with a header, and JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions import text as T
from earshot.functions.periods import period_num, to_date_or_null
from earshot.operators.trailing import with_sort_key
from earshot.operators.transcripts import prefer_roots
from earshot.schemas import RAW_TRANSCRIPT_JSON
from earshot.session import broadcast_if_small

_EXPANDED_SUFFIX = "_transcripts"


def read_whole_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(file_path, folder, file_name, stem, value): one row per file in any folder below path."""
    files = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
        .text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file_path"))
    )
    parts = F.split("file_path", "/")
    return with_stem(
        files.withColumn("file_name", F.url_decode(F.element_at(parts, -1)))
        .withColumn("folder", F.url_decode(F.element_at(parts, -2)))
    )


def with_stem(files: DataFrame) -> DataFrame:
    return files.withColumn("stem", F.regexp_replace("file_name", r"\.[^.]*\z", ""))


def parse_text_transcripts(files: DataFrame) -> DataFrame:
    """Header lines and rules removed from anywhere in the file; the date comes from the Date header."""
    body = F.regexp_replace("value", r"(?md)^(Symbol|Period|Date):.*\n", "")
    return files.withColumns({
        "year": T.stem_year(F.col("stem")), "quarter": T.stem_quarter(F.col("stem")),
        "date_text": T.header_date_text(F.col("value")),
        "content": T.strip_text(F.regexp_replace(body, r"=+\n", "")),
        "source": F.lit("local_txt"), "filename": F.col("file_name"),
    }).withColumn("call_date", to_date_or_null(F.col("date_text"))).drop("value", "stem", "file_name")


def parse_json_transcripts(files: DataFrame, source: str = "json") -> DataFrame:
    """The first element of an array document, or the object itself; a null content is ''."""
    entry = F.get(F.from_json("value", RAW_TRANSCRIPT_JSON), F.lit(0))
    return (
        files.withColumn("entry", entry)
        .withColumns({
            "year": T.stem_year(F.col("stem")), "quarter": T.stem_quarter(F.col("stem")),
            "date_text": F.col("entry.date"), "content": F.coalesce("entry.content", F.lit("")),
            "source": F.lit(source), "filename": F.col("file_name"),
        })
        .withColumn("call_date", to_date_or_null(F.col("date_text"))).drop("value", "stem", "file_name", "entry")
    )


def _ticker_of(root: str) -> Column:
    """Folder name below the root; a file in the root itself carries its ticker in its name."""
    in_root = F.element_at(F.split("file_path", "/"), -2) == root.rstrip("/").rsplit("/", 1)[-1]
    return F.when(in_root, F.split("file_name", "_")[0]).otherwise(
        F.regexp_replace("folder", _EXPANDED_SUFFIX + "$", "")
    )


def read_expanded_root(spark: SparkSession, root: str) -> DataFrame:
    """{root}/{ticker}_transcripts/*.txt"""
    files = read_whole_files(spark, root, "*.txt").where(F.endswith("folder", F.lit(_EXPANDED_SUFFIX)))
    return parse_text_transcripts(files.withColumn("ticker", _ticker_of(root)))


def read_cache_root(spark: SparkSession, root: str, root_level: bool = False) -> DataFrame:
    """{root}/{ticker}/*.json and *.txt; with root_level also {root}/{ticker}_*.txt."""
    in_folder = F.element_at(F.split("file_path", "/"), -2) != root.rstrip("/").rsplit("/", 1)[-1]
    text_files = read_whole_files(spark, root, "*.txt").withColumn("ticker", _ticker_of(root))
    json_files = read_whole_files(spark, root, "*.json").withColumn("ticker", _ticker_of(root))
    if not root_level:
        text_files = text_files.where(in_folder)
    return parse_json_transcripts(json_files.where(in_folder)).unionByName(parse_text_transcripts(text_files))


def read_all_cached(spark: SparkSession, root: str) -> DataFrame:
    """Every cached transcript, key duplicates kept."""
    return read_cache_root(spark, root, root_level=True)


def read_raw_transcripts(spark: SparkSession, expanded_root: str, cache_root: str) -> DataFrame:
    """Both roots; the expanded one wins on a (ticker, year, quarter) collision."""
    return prefer_roots([read_expanded_root(spark, expanded_root), read_cache_root(spark, cache_root)])


def parse_speaker_transcripts(files: DataFrame) -> DataFrame:
    """Speaker prefixes stripped from every line after the header rule.

    Text under 500 characters falls back to the plain lines. Files without year or quarter, and files
    with an impossible date, are dropped.
    """
    value = F.col("value")
    speaker = r"(?d)^([A-Z][A-Za-z\s\.\-]+):\s*(.*)"
    lines = F.transform(F.split(value, "\n"), T.strip_text)
    rule_at = F.array_position(F.transform(lines, lambda s: F.regexp_like(s, F.lit(r"\A={4,}\z"))), True)
    spoken = F.filter(
        F.transform("body", lambda s: F.when(
            F.regexp_like(s, F.lit(speaker)), T.strip_text(F.regexp_extract(s, speaker, 2))
        ).otherwise(s)),
        lambda s: s != "",
    )
    period = r"(?iU)Period:\s*Q(\d)\s*(\d{4})"

    def header(pattern: str, group: int = 1) -> Column:
        return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))

    date_text = header(r"Date:\s*(\d{4}-\d{2}-\d{2})")
    return (
        files.withColumn("lines", lines).withColumn("rule_at", rule_at)
        .withColumn("body", F.filter(
            F.slice("lines", (F.col("rule_at") + 1).cast("int"), F.greatest(F.size("lines"), F.lit(1))), lambda s: s != ""
        ))
        .withColumn("spoken", F.array_join(spoken, " "))
        .select(
            F.coalesce(header(r"(?U)Symbol:\s*(\S+)"), F.split("stem", "_")[0]).alias("ticker"),
            header(period, 2).cast("int").alias("year"), header(period, 1).cast("int").alias("quarter"),
            date_text.alias("date_text"), to_date_or_null(date_text).alias("call_date"),
            F.when(F.length("spoken") < 500, F.array_join("body", " ")).otherwise(F.col("spoken")).alias("content"),
            *[c for c in files.columns if c not in ("value", "ticker", "year", "quarter")],
        )
        .where("year IS NOT NULL AND quarter IS NOT NULL AND (date_text IS NULL OR call_date IS NOT NULL)")
        .withColumn("period_num", period_num(F.col("year"), F.col("quarter")))
    )


def read_speaker_corpus(spark: SparkSession, root: str) -> DataFrame:
    return with_sort_key(parse_speaker_transcripts(read_whole_files(spark, root, "*.txt")))


def attach_call_dates(docs: DataFrame, sidecar: DataFrame) -> DataFrame:
    """docs + call_date from the (ticker, year, quarter) sidecar; unmatched keys stay null."""
    keys = ["ticker", "year", "quarter"]
    side = sidecar.groupBy(*keys).agg(F.max("call_date").alias("call_date"))
    return docs.drop("call_date").join(broadcast_if_small(side, ("ticker",)), keys, "left")


def load_transcripts(table: DataFrame, ticker: str) -> DataFrame:
    """Cleaned transcripts of one ticker in (year, quarter) order; the filter prunes partitions."""
    return table.where(F.col("ticker") == ticker).orderBy("year", "quarter")
