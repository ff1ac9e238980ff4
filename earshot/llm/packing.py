"""Cost-balanced packing of documents into training sequences."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.chunk_cache import chunk_encoder
from earshot.llm.common import arrow_texts

CAPACITY = 4096
END_ID = 2
# Documents of about so many characters are packed together; a task holds one such group.
GROUP_CHARS = 8_000_000
PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
])


def plan_sequences(lengths: list[int], capacity: int = CAPACITY, linear: float = 1.0,
                   quadratic: float = 1.0 / 2048) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that fill sequences of the given capacity.

    Whole capacities are cut from long documents first. The rest is assigned in descending length to the sequence of
    lowest cost that has room, where a piece costs linear * n + quadratic * n * n (attention inside a document). Only
    where none has room is a document cut over the sequences of lowest cost. Sequences hold capacity tokens; what is
    left of the group goes to sequences of the powers of two that sum to it, which need no padding.
    """
    whole, rest = divmod(sum(lengths), capacity)
    sizes = [capacity] * whole + [1 << b for b in range(capacity.bit_length() - 1, -1, -1) if rest >> b & 1]
    room = np.array(sizes, np.int64)
    cost = np.zeros(len(sizes))
    fill = np.zeros(len(sizes), np.int64)
    out: list[tuple[int, int, int, int, int]] = []

    def put(doc: int, start: int, n: int, at: int) -> None:
        out.append((doc, start, n, at, int(fill[at])))
        room[at] -= n
        fill[at] += n
        cost[at] += linear * n + quadratic * n * n

    rests, full = [], 0
    for doc, n in enumerate(lengths):
        start = 0
        while n - start >= capacity:
            put(doc, start, capacity, full)
            full, start = full + 1, start + capacity
        if start < n:
            rests.append((start - n, doc, start))
    for left, doc, start in sorted(rests):
        left = -left
        while left:
            fits = np.flatnonzero(room >= left)
            if not len(fits):
                fits = np.flatnonzero(room)
            at = int(fits[np.argmin(cost[fits])])
            n = min(left, int(room[at]))
            put(doc, start, n, at)
            start, left = start + n, left - n
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         group_chars: int = GROUP_CHARS) -> DataFrame:
    """Pieces of documents with their ids (little-endian unsigned 32-bit), sequence and place in it.

    Documents are dealt by a hash of id and text into groups of about group_chars characters, as many as the corpus
    needs; each group is packed in one task, so its padding and its memory do not depend on the size of the corpus. Null or empty
    text is the end id alone; repeated rows are packed as often as they occur; null doc_ids stay null. Other columns
    of docs are not read. An empty table gives no piece.
    """
    chars = docs.agg(F.coalesce(F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long") + 1), F.lit(0))).first()[0]
    groups = max(1, math.ceil(chars / group_chars))
    group = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int").alias("pack_group")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(tokenizer)
        end = np.array([end_id], encoder.width).tobytes()
        for batch in batches:
            ids = [encoder.encode(text) + end for text in arrow_texts(batch)]
            for k in range(0, len(ids), 2000):
                part = batch.slice(k, 2000)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(ids[k:k + 2000], pa.binary())],
                    names=["doc_id", "pack_group", "ids"])

    def fill(table: pa.Table) -> pa.Table:
        width = chunk_encoder(tokenizer).width
        raws = table.column("ids").to_pylist()
        keys = table.column("doc_id").to_pylist()
        order = sorted(range(len(raws)), key=lambda i: (keys[i] is None, keys[i] or 0, raws[i]))
        number = table.column("pack_group")[0].as_py()
        lengths = [len(raws[i]) // width.itemsize for i in order]
        doc, start, length, sequence, offset = zip(*plan_sequences(lengths, capacity))
        pieces = [
            np.frombuffer(raws[order[d]], width, n, s * width.itemsize).astype("<u4").tobytes()
            for d, s, n in zip(doc, start, length)
        ]
        columns = [
            [keys[order[d]] for d in doc], start, length, [lengths[d] for d in doc],
            [(number << 32) + s for s in sequence], offset, pieces,
        ]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES)

    tokens = docs.select("doc_id", group, "text").mapInArrow(encode, "doc_id long, pack_group int, ids binary")
    return tokens.groupBy("pack_group").applyInArrow(
        fill, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
