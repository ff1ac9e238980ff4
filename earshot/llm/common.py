"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the word rules: blank and U+0009-U+000D, nothing else.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text column: one white-space character for all, then a plain split."""
    for space in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are worked out once per row: a filter further up cannot copy their expressions into itself."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def arrow_texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of an Arrow batch, null as empty."""
    return ["" if value is None else value for value in batch.column(column).to_pylist()]


def arrow_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 of the texts of an Arrow batch, null as empty."""
    return [value or b"" for value in batch.column(column).cast(pa.binary()).to_pylist()]


def in_batches(rows: Iterable[tuple], schema: pa.Schema, weight: Callable[[tuple], int] = lambda row: 64,
               max_weight: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of a bounded weight in bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= max_weight:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
