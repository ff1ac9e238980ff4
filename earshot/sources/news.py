"""Landed news: one JSON array of articles per company and quarter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions import text as T
from earshot.functions.periods import to_date_or_null
from earshot.schemas import RAW_ARTICLES
from earshot.sources.transcripts import read_whole_files


def read_news(spark: SparkSession, root: str) -> DataFrame:
    """{root}/{ticker}/{year}Q{quarter}.json"""
    return parse_news(read_whole_files(spark, root, "*.json"))


def parse_news(files: DataFrame) -> DataFrame:
    """One row per article: doc_id (ticker, stem and place), ticker, year, quarter of the file, date of the article, title, and content to search.

    files carry folder, stem and value. A file that is no array of articles, or an empty one, gives no row; an article
    without a date keeps a null one.
    """
    articles = files.select(
        F.col("folder").alias("ticker"), T.stem_year(F.col("stem")).alias("year"), T.stem_quarter(F.col("stem")).alias("quarter"),
        "stem", F.posexplode(F.from_json("value", RAW_ARTICLES)).alias("place", "article"))
    title, body = (F.coalesce(f"article.{name}", F.lit("")) for name in ("title", "text"))
    return articles.where("article IS NOT NULL").select(
        F.concat_ws("_", "ticker", "stem", "place").alias("doc_id"), "ticker", "year", "quarter", to_date_or_null(F.col("article.publishedDate")).alias("call_date"),
        title.alias("title"), F.concat(title, F.lit("\n"), body).alias("content"))
