"""Token ids in Parquet list columns, with row groups and pages sized for selective reads."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.llm.chunk_cache import chunk_encoder
from earshot.llm.common import arrow_texts

END_ID = 2
FILE_COLUMNS = "doc_id long, shard int, shard_start long, n_tokens long, tokens array<int>"
# Writer settings of the token files: dictionary pages (delta pages with dictionary="false"), row groups small enough to
# skip, pages of few documents so that the page index can leave out the rest.
PARQUET = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "512",
    "parquet.dictionary.page.size": str(1 << 20),
}


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, dictionary: bool = True) -> None:
    """Encode documents and write them in ascending doc_id order, one ascending range of ids per file.

    A row holds doc_id, the file's place in the order (shard), the ids before the document in that file, its number of
    ids with the end id, and the ids. Null or empty text gives the end id alone. Null doc_ids come first; rows with the
    same doc_id stay next to each other, ordered by a hash of their text. Other columns of docs are not read.
    """
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, before = chunk_encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], encoder.width).tobytes()
        for batch in batches:
            ids = [encoder.encode(text) + end for text in arrow_texts(batch)]
            counts = np.array([len(raw) for raw in ids], np.int64) // encoder.width.itemsize
            ends = np.cumsum(counts)
            values = np.frombuffer(b"".join(ids), encoder.width).astype(np.int32)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(ids), shard, np.int32)), pa.array(before + ends - counts),
                 pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                names=["doc_id", "shard", "shard_start", "n_tokens", "tokens"])
            before += int(ends[-1]) if len(ends) else 0

    settings = {**PARQUET, "parquet.enable.dictionary": str(dictionary).lower()}
    ordered.mapInArrow(encode, FILE_COLUMNS).write.options(**settings).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files with start, the ids of all documents before; the ids themselves are read only when selected.

    Starts come from one row per file: its first start is the sum of the files before it.
    """
    rows = spark.read.schema(FILE_COLUMNS).parquet(path)
    shards = rows.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    firsts = shards.select("shard", F.coalesce(before, F.lit(0)).alias("first"))
    return rows.join(firsts, "shard").select(
        "doc_id", (F.col("first") + F.col("shard_start")).alias("start"), "n_tokens", "tokens", "shard")


def with_ids_crc(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            raw = memoryview(np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), "<u4")).cast("B")
            cuts = (np.asarray(lists.offsets) - lists.offsets[0].as_py()) * 4
            sums = [zlib.crc32(raw[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "tokens").mapInArrow(
        digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
