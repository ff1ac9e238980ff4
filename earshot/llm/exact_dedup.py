"""Exact duplicates by compressed radix tries."""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import SPACE_BYTES, in_batches, text_or_empty
from earshot.session import materialize

# Bytes of text that a task's trie holds before it hands rows on (local pass) or spills a subtree (owner pass).
TRIE_BYTES = 24 << 20


class _Node:
    __slots__ = ("label", "children", "value", "spilled")

    def __init__(self, label: bytes, value=None):
        self.label, self.children, self.value, self.spilled = label, {}, value, None


class PatriciaTrie:
    """Byte strings in a compressed radix trie whose terminal nodes hold merged values.

    merge(old, new) combines the values of equal strings. Beyond max_bytes of labels the heaviest subtree goes to a
    temporary file that has no name; later strings of that subtree are appended there, and items() reads it back into a
    trie of its own. A single string is never split, however long.
    """

    def __init__(self, merge: Callable, max_bytes: int = TRIE_BYTES):
        self.merge, self.max_bytes = merge, max_bytes
        self.root, self.held = _Node(b""), 0

    def insert(self, key: bytes, value):
        """Adds a value; returns the merged one, or None where the string lies in a spilled subtree."""
        node, at = self.root, 0
        while True:
            if node.spilled is not None:
                pickle.dump((key, value), node.spilled, protocol=5)
                return None
            if at == len(key):
                node.value = value if node.value is None else self.merge(node.value, value)
                return node.value
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = _Node(key[at:], value)
                self.held += len(key) - at
                if self.held > self.max_bytes:
                    self._spill()
                return value
            label = child.label
            if not key.startswith(label, at):
                common = _common(label, key, at)
                upper = _Node(label[:common])
                child.label = label[common:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = child = upper
                label = upper.label
            at += len(label)
            node = child

    def _spill(self) -> None:
        """Write the heaviest subtree out, below the last node that all strings share."""
        top, prefix = self.root, b""
        while top.value is None and len(top.children) == 1:
            (child,) = top.children.values()
            if child.spilled is not None or not child.children:
                return  # one string, or all of it written already
            top, prefix = child, prefix + child.label
        weights = {first: _weight(child) for first, child in top.children.items() if child.spilled is None}
        if not weights:
            return
        heaviest = top.children[max(weights, key=weights.get)]
        out = tempfile.TemporaryFile()
        for key, value in self._items(heaviest, prefix):
            pickle.dump((key, value), out, protocol=5)
        self.held -= max(weights.values())
        heaviest.children, heaviest.value, heaviest.spilled = {}, None, out

    def items(self) -> Iterator[tuple[bytes, object]]:
        return self._items(self.root, b"")

    def _items(self, node: _Node, prefix: bytes) -> Iterator[tuple[bytes, object]]:
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            prefix += node.label
            if node.spilled is not None:
                part = PatriciaTrie(self.merge, self.max_bytes)
                node.spilled.seek(0)
                while True:
                    try:
                        part.insert(*pickle.load(node.spilled))
                    except EOFError:
                        break
                node.spilled.close()
                yield from part.items()
                continue
            if node.value is not None:
                yield prefix, node.value
            stack.extend((child, prefix) for child in node.children.values())


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common start of label and key[at:]; they differ somewhere."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if key.startswith(label[:middle], at):
            low = middle
        else:
            high = middle - 1
    return low


def _weight(node: _Node) -> int:
    total, stack = 0, [node]
    while stack:
        node = stack.pop()
        total += len(node.label)
        stack.extend(node.children.values())
    return total


def _order(owner: tuple) -> tuple:
    """Most code points first, then the smallest doc_id (null last), then the row read first."""
    points, doc_id, row = owner
    return -points, doc_id is None, doc_id or 0, row


def _merge(old: tuple, new: tuple) -> tuple:
    """Values are (rows, best row, row numbers of the local copies)."""
    old[2].extend(new[2])  # in place: a text that many partitions hold is not copied at every merge
    return old[0] + new[0], min(old[1], new[1], key=_order), old[2]


def exact_duplicates(docs: DataFrame, max_trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and row_key, a number of the row.

    Texts are equal when their bytes are equal without white space. Each input partition first merges its own copies
    in a trie, so that a group of any size sends one text per partition; texts then meet by length and hash, and a
    trie per partition of these settles the owner byte by byte. The row with most code points, then the smallest
    doc_id, then the row read first stays: one row of each group, also among repeated rows. Null text is empty text;
    empty texts form one group. A null doc_id comes after all others. Other columns of docs are not read.
    """
    text = text_or_empty()
    read = docs.select("doc_id", text.cast("binary").alias("text"), F.length(text).cast("long").alias("points"))
    marked = materialize(read.mapInArrow(_local_pass(max_trie_bytes), _LOCAL), "copies")
    texts = marked.where("text IS NOT NULL").select("text", "text_sha256", "n_bytes", "copies", "points", "best_id", "best_row", "copy_row")
    owners = texts.repartition("n_bytes", "text_sha256").mapInArrow(
        _owner_pass(max_trie_bytes), "copy_row long, keep_id long, keep_row long, group_size long")
    rows = marked.where("row_key IS NOT NULL").select("doc_id", "row_key", "copy_row", "text_sha256")
    return rows.join(owners, "copy_row").select(
        "doc_id", "keep_id", "group_size", (F.col("row_key") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("text_sha256")).alias("text_sha256"), "row_key")


_LOCAL = ("doc_id long, row_key long, copy_row long, text_sha256 binary, n_bytes long, text binary, copies long, "
          "points long, best_id long, best_row long")


def _local_pass(max_bytes: int):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("row_key", pa.int64()), ("copy_row", pa.int64()), ("text_sha256", pa.binary()),
        ("n_bytes", pa.int64()), ("text", pa.binary()), ("copies", pa.int64()), ("points", pa.int64()),
        ("best_id", pa.int64()), ("best_row", pa.int64()),
    ])

    def handed_on(trie: PatriciaTrie) -> Iterator[tuple]:
        for text, (copies, (points, best_id, best_row), (row,)) in trie.items():
            yield None, None, row, hashlib.sha256(text).digest(), len(text), text, copies, points, best_id, best_row

    def merge(old: tuple, new: tuple) -> tuple:
        return old[0] + 1, min(old[1], new[1], key=_order), old[2]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        row_key = TaskContext.get().partitionId() << 36
        trie = PatriciaTrie(merge, 2 * max_bytes)
        for batch in batches:
            for doc_id, raw, points in zip(*(c.to_pylist() for c in batch.columns)):
                key = raw.translate(None, SPACE_BYTES)
                value = trie.insert(key, (1, (points, doc_id, row_key), (row_key,)))
                yield doc_id, row_key, value[2][0], hashlib.sha256(key).digest(), None, None, None, None, None, None
                row_key += 1
                if trie.held > max_bytes:  # never spills: the rest of the partition begins anew
                    yield from handed_on(trie)
                    trie = PatriciaTrie(merge, 2 * max_bytes)
        yield from handed_on(trie)

    return lambda batches: in_batches(rows(batches), schema, lambda row: 100 + len(row[5] or b""))


def _owner_pass(max_bytes: int):
    schema = pa.schema([(n, pa.int64()) for n in ("copy_row", "keep_id", "keep_row", "group_size")])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        trie = PatriciaTrie(_merge, max_bytes)
        for batch in batches:
            for text, _, _, copies, points, best_id, best_row, copy_row in zip(*(c.to_pylist() for c in batch.columns)):
                trie.insert(text, (copies, (points, best_id, best_row), [copy_row]))
        for _, (copies, (_, best_id, best_row), copy_rows) in trie.items():
            for copy_row in copy_rows:
                yield copy_row, best_id, best_row, copies

    return lambda batches: in_batches(rows(batches), schema)
