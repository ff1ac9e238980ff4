"""The corpus pipeline: languages, quality, copies, near copies, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.llm import exact_dedup, language_id, minhash, packing, quality
from earshot.llm.common import SPACE_BYTES, table
from earshot.session import materialize


def _carried(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the other columns as one, out of the way of the names that an operator adds."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", (F.struct(*rest) if rest else F.lit(0)).alias("_rest"))


def _restored(carried: DataFrame, docs: DataFrame) -> DataFrame:
    return carried.select(*(c if c in ("doc_id", "text") else F.col(f"_rest.`{c}`") for c in docs.columns))


def drop_unknown_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; texts that are null or without letters go."""
    found = language_id.identify_languages(_carried(docs), language_id.labelled_sample(docs))
    return _restored(found.where(F.col("lang_pred") != language_id.UNKNOWN), docs)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counts and the likelihood ratio; the trusted target are labelled documents of quality 1."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    rated = quality.quality_rules(_carried(docs), quality.ratio_weights(docs, trusted))
    return _restored(rated.where("kept"), docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, also where rows share a doc_id or have none.

    Rows are found again by doc_id and the hash of the text without white space. Of rows that share both, the longest
    stays, as in the operator; rows that differ in neither these nor in length are told apart by nothing it looks at.
    """
    seen = exact_dedup.exact_duplicates(docs).groupBy("doc_id", "text_sha256").agg(
        F.max("kept").alias("_any"), F.count(F.lit(1)).alias("_rows")).where("_rows > 1 OR NOT _any")
    seen = seen.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_of"), "_any", "_rows")
    text = F.coalesce("text", F.lit(""))
    plain = text
    for space in SPACE_BYTES.decode():
        plain = F.replace(plain, F.lit(space), F.lit(""))
    rows = _carried(docs).withColumn("_same", F.sha2(plain.cast("binary"), 256))
    left = rows.join(seen.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_same") == F.col("_of")), "left")
    left = left.where(F.coalesce("_any", F.lit(True)))
    turn = F.row_number().over(W.partitionBy("doc_id", "_same").orderBy(F.length(text).desc()))
    return _restored(left.withColumn("_turn", turn).where("_turn = 1"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates by shingles of five words."""
    gone = minhash.near_duplicates(docs, size=5).where("NOT kept").select("doc_id")
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences, with their ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", drop_unknown_languages),
    ("quality_rules", drop_low_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]

# Stages 1, 2, 4 and 5 have no SQL form: they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written out and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
