"""Near-duplicates by MinHash, banding, checked signatures, exact confirmation and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.chunk_cache import Remembered
from earshot.llm.common import arrow_bytes, in_batches
from earshot.session import materialize

# 40 bands of 6 minima: two sets of similarity 0.8 share no band once in 190,000 times.
BANDS, ROWS = 40, 6
# Signatures of sets of similarity 0.8 agree in 0.80 +- 0.026 of their minima; pairs below this share are no links.
LEAST_AGREEMENT = 0.68
# Members of a bucket compared with each other in one step.
BLOCK = 1000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


class Shingler:
    """Sets of 64-bit hashes of the distinct word shingles of a text, ascending.

    Words are separated by blank and U+0009-U+000D and lower-cased in A-Z only. A text of fewer words than the shingle
    is one shingle, a text without words none.
    """

    def __init__(self, size: int):
        self.size, self.hashes = size, Remembered(xxhash.xxh3_64_intdigest, 200_000)

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        codes = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        width = min(self.size, len(words))
        mixed = np.full(len(words) - width + 1, width, np.uint64)
        for k in range(width):
            mixed = (mixed ^ codes[k:len(codes) - width + 1 + k]) * _GOLDEN
            mixed ^= mixed >> np.uint64(31)
        mixed *= _SECOND
        mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


class Signer:
    """Minima of universal hash functions a * x + b over a set, and a key for each band of them."""

    def __init__(self, bands: int, rows: int, seed: int = 1):
        draw = np.random.default_rng(seed)
        count = bands * rows
        self.a = (draw.integers(0, 1 << 32, count, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
        self.b = draw.integers(0, 1 << 32, count, dtype=np.uint64).astype(np.uint32)[:, None]
        self.bands, self.rows = bands, rows

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        minima = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for k in range(0, len(x), 2048):
            np.minimum(minima, (self.a * x[k:k + 2048] + self.b).min(axis=1), out=minima)
        return minima

    def keys(self, minima: np.ndarray) -> list[int]:
        raw, width = minima.tobytes(), 4 * self.rows
        return [xxhash.xxh3_64_intdigest(raw[k * width:(k + 1) * width], seed=k) - (1 << 63) for k in range(self.bands)]


def signatures(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set_key (hash of the set), keys (one per band), marks (a byte of each minimum)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
                        ("keys", pa.list_(pa.int64())), ("marks", pa.binary())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(size), Signer(bands, rows)

        def out():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), arrow_bytes(batch)):
                    found = shingler(text)
                    if not len(found):
                        yield doc_id, 0, b"", None, None
                        continue
                    minima = signer(found)
                    marks = (minima & np.uint32(255)).astype(np.uint8).tobytes()
                    yield doc_id, len(found), xxhash.xxh3_128_digest(found.tobytes()), signer.keys(minima), marks

        return in_batches(out(), schema, lambda row: 900)

    return docs.select("doc_id", "text").mapInArrow(
        sign, "doc_id long, n_shingles long, set_key binary, keys array<long>, marks binary")


def _agree(pairs: DataFrame, marked: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes allow the similarity and whose signatures agree often enough."""
    left = marked.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("marks").alias("m_a"))
    right = marked.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("marks").alias("m_b"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m_a, m_b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (2, 3))
            good = pa.array(_share(np.count_nonzero(m_a == m_b, axis=1), m_a.shape[1]) >= LEAST_AGREEMENT)
            yield batch.select([0, 1]).filter(good)

    sized = pairs.join(left, "a").join(right, "b").where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    return sized.select("a", "b", "m_a", "m_b").mapInArrow(keep, "a long, b long").distinct()


def _share(equal: np.ndarray, of: int) -> np.ndarray:
    """Agreement of minima from that of their bytes, which agree by chance once in 256 times."""
    return (equal / of - 1 / 256) / (1 - 1 / 256)


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node, shingles (the full set) and counts (of shingles in 256 cells) of the wanted documents.

    Both sides are shuffled at every size, so that the cost grows with the input and not in steps.
    """
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary()), ("counts", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), arrow_bytes(batch)):
                    found = shingler(text)
                    yield doc_id, found.tobytes(), cell_counts(found)

        return in_batches(rows(), schema, lambda row: len(row[1]) + 300)

    return docs.select("doc_id", "text").join(wanted.hint("merge"), "doc_id", "left_semi").mapInArrow(
        cut, "node long, shingles binary, counts binary")


def cell_counts(shingles: np.ndarray) -> bytes:
    """Shingles in each of 256 cells of their hashes; all cells 255 where one holds more than 254."""
    counts = np.bincount((shingles & np.uint64(255)).astype(np.int64), minlength=256)
    return (counts if counts.max() < 255 else np.full(256, 255)).astype(np.uint8).tobytes()


def _most_common(counts: np.ndarray, own: np.ndarray, n: np.ndarray, own_n: int) -> np.ndarray:
    """The largest number of shingles that the sets can have in common, from their counts per cell."""
    most = np.minimum(counts, own).sum(axis=1, dtype=np.int64)
    return np.minimum(np.where(most == 255 * 256, np.minimum(n, own_n), most), np.minimum(n, own_n))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets satisfy 100 * intersection >= percent * union."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                good.append(100 * common >= percent * (len(both) - common))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("s_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "s_a", "s_b").mapInArrow(check, "a long, b long").distinct()


def _across(rows: DataFrame, percent: int, only_best: bool) -> DataFrame:
    """Pairs of different labels in one bucket whose signatures agree and whose counts allow the similarity.

    With only_best each member of a block meets only that member of another label whose signature agrees most.

    rows: key, node, label, n_shingles, marks, counts, and the number of blocks of the bucket. A bucket larger than a block is
    dealt out by pairs of blocks, so that no task holds all of it.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    block = F.pmod(F.xxhash64("node", "key"), F.col("blocks"))
    others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                         lambda x: F.struct(F.least(x, F.col("block")).alias("lo"), F.greatest(x, F.col("block")).alias("hi")))
    dealt = rows.withColumn("block", block).withColumn("cell", F.explode(others)).select(
        "key", "cell.lo", "cell.hi", "block", "node", "label", "n_shingles", "marks", "counts")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0  # pairs as arrays, handed on before they grow: no object for each pair

        def handed_on() -> Iterator[pa.RecordBatch]:
            if found:
                a, b = np.concatenate(found, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)
                found.clear()

        for cell, own, node, label, n, marks, counts in _runs(batches):
            if label.min() == label.max():
                continue
            # The most common label's own rows need no comparison with each other.
            names, held = np.unique(label, return_counts=True)
            for at in np.flatnonzero(label != names[np.argmax(held)]):
                near = (label != label[at]) & (100 * np.minimum(n, n[at]) >= percent * np.maximum(n, n[at]))
                if cell[1] != cell[2]:
                    near &= own != own[at]
                near = np.flatnonzero(near)
                share = _share(np.count_nonzero(marks[near] == marks[at], axis=1), marks.shape[1])
                near, share = near[share >= LEAST_AGREEMENT], share[share >= LEAST_AGREEMENT]
                most = _most_common(counts[near], counts[at], n[near], int(n[at]))
                likely = 100 * most >= percent * (n[near] + n[at] - most)
                good, share = near[likely], share[likely]
                if only_best:
                    good = good[np.argsort(-share, kind="stable")]
                    good = good[np.unique(label[good], return_index=True)[1]]
                if len(good):
                    found.append(np.stack([np.minimum(node[good], node[at]), np.maximum(node[good], node[at])]))
                    size += len(good)
                if size > 100_000:
                    yield from handed_on()
                    size = 0
        yield from handed_on()

    return dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(
        compare, "a long, b long").distinct()


def _runs(batches: Iterator[pa.RecordBatch]):
    """Rows of one (key, lo, hi) at a time from sorted batches: at most two blocks of a bucket."""
    held: list[tuple] = []
    cell = None

    def whole():
        own, node, label, n, marks, counts = zip(*held)
        return (cell, np.array(own), np.array(node, np.int64), np.array(label, np.int64), np.array(n, np.int64),
                np.frombuffer(b"".join(marks), np.uint8).reshape(len(held), -1),
                np.frombuffer(b"".join(counts), np.uint8).reshape(len(held), -1))

    for batch in batches:
        for key, lo, hi, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if (key, lo, hi) != cell:
                if held:
                    yield whole()
                held, cell = [], (key, lo, hi)
            held.append(tuple(row))
    if held:
        yield whole()


def connected_components(links: DataFrame) -> DataFrame:
    """node and component, the smallest node reachable over links (a, b), by alternating large-star and small-star.

    Large-star ties every larger neighbour of a node to the smallest one, small-star every smaller neighbour; both are
    minima per node joined back to the links, so a node with many neighbours is no group of its own. Each round is
    written out; the rounds end when the links stay the same. Nodes without links do not occur.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct())


def _relabelled(found: DataFrame, links: DataFrame) -> DataFrame:
    """node and component, after links (a, b) between the components of found have joined them."""
    def own(side: str, name: str) -> DataFrame:
        return found.select(F.col("node").alias(side), F.col("component").alias(name))

    joined = links.join(own("a", "c_a"), "a", "left").join(own("b", "c_b"), "b", "left").select(
        F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    roots = connected_components(joined).select(F.col("node").alias("component"), F.col("component").alias("root"))
    kept = found.join(roots, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    alone = roots.join(found.select(F.col("node").alias("component")), "component", "left_anti")
    return kept.union(alone.select(F.col("component").alias("node"), F.col("root").alias("component")))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per document.

    Documents are linked when 100 * intersection >= percent * union of their shingle sets. Equal sets are one node, so
    copies never pair up. A bucket (equal band) first links every member to one of them; then members of buckets that
    still hold several components are compared across components, likeliest pairs first and then all that are left, which
    finds every other link that could join two components. Candidates must agree in signature and are confirmed on full sets.

    component_id is the smallest doc_id reachable; kept marks that row. Texts without words (null, empty, white space)
    have size 0 and stand alone. A null doc_id is never linked and kept. Rows that repeat a doc_id count as one node
    and share its component. Other columns of docs are not read; an empty table gives no row.
    """
    signed = materialize(signatures(docs, size, bands, rows), "signatures")
    real = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    firsts = real.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"))
    nodes = materialize(real.join(firsts, ["set_key", "doc_id"], "left_semi").select(
        F.col("doc_id").alias("node"), "n_shingles", "keys", "marks"), "nodes")
    marked = nodes.select("node", "n_shingles", "marks")
    buckets = nodes.select("node", F.explode("keys").alias("key"))
    centres = buckets.groupBy("key").agg(
        F.min(F.struct(F.xxhash64("node").alias("draw"), "node"))["node"].alias("centre"),
        F.min("node").alias("lo"), F.max("node").alias("hi"), F.count(F.lit(1)).alias("members")).where("lo < hi")
    shared = materialize(buckets.join(centres.select("key", "centre", "members"), "key"), "buckets")

    sets = materialize(_sets(docs, shared.select(F.col("node").alias("doc_id")).distinct(), size), "sets")
    stars = shared.where("node <> centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    links = _confirm(materialize(_agree(stars, marked, percent), "pairs"), sets, percent)
    found = connected_components(links)

    # First the likeliest pair of every member and label, which joins nearly all that belongs together; then all pairs of
    # what is still apart. So a large group is not compared pair by pair, and no link is lost.
    for only_best in (True, False):
        labelled = shared.join(found, "node", "left").select(
            "key", "node", F.coalesce("component", "node").alias("label"), "members")
        mixed = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
        open_rows = labelled.join(mixed, "key", "left_semi").join(marked, "node").join(sets.select("node", "counts"), "node")
        open_rows = open_rows.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("long"))
        more = _confirm(materialize(_across(open_rows, percent, only_best), "pairs"), sets, percent)
        found = materialize(_relabelled(found, more), "found")

    sets = firsts.join(found.select(F.col("node").alias("doc_id"), F.col("component").alias("root")), "doc_id", "left").select(
        "set_key", F.coalesce("root", "doc_id").alias("root"))
    linked = signed.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set_key")).alias("set_key")).join(
        sets, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return linked.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
