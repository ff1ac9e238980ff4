"""Language identification by cross-parsing against suffix automata."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.llm.common import arrow_texts

UNKNOWN = "und"
# The labelled sample: so many documents of each language, so many characters of each from its middle.
SAMPLE_DOCS = 60
SAMPLE_CHARS = 400
# Characters parsed side by side. A parse begins anew at each segment, for every language alike.
SEGMENT = 512


def labelled_sample(docs: DataFrame, docs_per_language: int = SAMPLE_DOCS,
                    chars_per_doc: int = SAMPLE_CHARS) -> dict[str, str]:
    """Text by language, from labelled documents outside the held-out fifth, bounded by the two parameters.

    Documents of at least chars_per_doc characters come first, then the smallest hash of the id. Null labels and empty
    texts are left out. Nothing but text, lang and doc_id is read.
    """
    start = F.greatest(F.lit(1), ((F.length("text") - chars_per_doc) / 2).cast("int"))
    learned = docs.where(~held_out() & F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        "lang", (F.length("text") < chars_per_doc).alias("short"), F.xxhash64("doc_id").alias("draw"),
        F.col("text").substr(start, F.lit(chars_per_doc)).alias("part"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("short", "draw", "part"))
    rows = learned.withColumn("rank", rank).where(F.col("rank") <= docs_per_language).orderBy("lang", "rank").collect()
    sample: dict[str, list[str]] = {}
    for row in rows:
        sample.setdefault(row["lang"], []).append(row["part"])
    return {lang: "\n".join(parts) for lang, parts in sample.items()}


def held_out():
    """Documents whose labels are never learned: a fifth by the checksum of their id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


class SuffixAutomaton:
    """All substrings of a text: transitions by state, built one symbol at a time."""

    def __init__(self, symbols: list[int]):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in symbols:
            fresh = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and c not in self.next[at]:
                self.next[at][c] = fresh
                at = link[at]
            if at >= 0:
                target = self.next[at][c]
                if length[target] == length[at] + 1:
                    link[fresh] = target
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[target]))
                    length.append(length[at] + 1)
                    link.append(link[target])
                    while at >= 0 and self.next[at].get(c) == target:
                        self.next[at][c] = copy
                        at = link[at]
                    link[target] = link[fresh] = copy
            last = fresh


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


class CrossParser:
    """Greedy parses of texts into longest substrings of each language's sample.

    Texts are lower-cased; every run of other characters than letters is one blank. Letters that no sample holds are
    one symbol that every language misses.
    """

    def __init__(self, sample: dict[str, str]):
        self.languages = sorted(sample)
        seen = sorted({c for text in sample.values() for c in text.lower() if len(c) == 1 and _letters()[ord(c)]})
        self.width = len(seen) + 2  # blank, the letters, any other letter
        self.symbol = np.where(_letters(), self.width - 1, 0).astype(np.int32)
        for number, c in enumerate(seen, 1):
            self.symbol[ord(c)] = number
        for c in {x for c in seen for x in (c.upper(), c.title()) if len(x) == 1}:
            self.symbol[ord(c)] = self.symbol[ord(c.lower())] if len(c.lower()) == 1 else self.width - 1
        tables, base = [], 0
        self.starts = []
        for lang in self.languages:
            states = SuffixAutomaton(self._symbols([sample[lang]])[0].tolist()).next
            table = np.full((len(states), self.width), -1, np.int64)
            for state, row in enumerate(states):
                for c, to in row.items():
                    table[state, c] = to
            # A missing transition begins a phrase with the same symbol at the root. After a symbol that the sample
            # lacks, and at the start, any symbol begins a phrase: the last row.
            begin = np.where(table[0] >= 0, table[0], len(states))
            table = np.vstack([table, np.full((1, self.width), -1, np.int64)])
            begins = table < 0
            step = (np.where(begins, begin, table) + base) * self.width * 2 + begins
            tables.append(step.astype(np.int32))
            self.starts.append((base + len(states)) * self.width * 2)
            base += len(states) + 1
        self.step = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)

    def _symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all texts one after another, symbols per text, letters per text."""
        sizes = np.array([len(t) for t in texts], np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        symbols = self.symbol[points]
        owner = np.repeat(np.arange(len(texts)), sizes)
        blank = symbols == 0
        begins = np.zeros(len(points), bool)
        ends = np.cumsum(sizes)
        begins[(ends - sizes)[sizes > 0]] = True
        keep = ~blank
        keep[1:] |= blank[1:] & ~blank[:-1] & ~begins[1:]
        letters = np.bincount(owner[~blank], minlength=len(texts))
        return symbols[keep], np.bincount(owner[keep], minlength=len(texts)), letters

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases per text and language, and letters per text."""
        symbols, sizes, letters = self._symbols(texts)
        per_text = -(-sizes // SEGMENT)
        lanes = int(per_text.sum())
        owner = np.repeat(np.arange(len(texts)), per_text)
        place = np.arange(lanes) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        begin = np.repeat(np.cumsum(sizes) - sizes, per_text) + place * SEGMENT
        length = np.minimum(np.repeat(sizes, per_text) - place * SEGMENT, SEGMENT)
        order = np.argsort(-length, kind="stable")
        begin, length, owner = begin[order], length[order], owner[order]
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        group = 4096
        for k in range(0, lanes, group):
            b, n = begin[k:k + group], length[k:k + group]
            steps = int(n[0])
            grid = np.zeros((steps, len(b)), np.int32)
            for j in range(steps):
                live = int(np.searchsorted(-n, -j, side="left"))  # lanes longer than j
                grid[j, :live] = symbols[b[:live] + j]
            alive = [int(np.searchsorted(-n, -j, side="left")) for j in range(steps)]
            for number, start in enumerate(self.starts):
                state = np.full(len(b), start, np.int32)
                begun = np.zeros(len(b), np.int32)
                for j in range(steps):
                    live = alive[j]
                    index = state[:live] >> 1
                    index += grid[j, :live]
                    state[:live] = self.step[index]
                    begun[:live] += state[:live] & 1
                np.add.at(out[:, number], owner[k:k + group], begun)
        return out, letters

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language of fewest phrases (ties: first by name) and 1 - fewest / next, from 0 to 1."""
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        counts, letters = self.phrases(texts)
        best = np.argmin(counts, axis=1)
        ranked = np.sort(counts, axis=1)
        second = ranked[:, 1] if counts.shape[1] > 1 else ranked[:, 0]
        score = np.where(letters > 0, 1.0 - ranked[:, 0] / np.maximum(second, 1), 0.0)
        return [(self.languages[b] if n else UNKNOWN, float(s)) for b, n, s in zip(best, letters, score)]


@functools.lru_cache(maxsize=2)
def _parser(sample: tuple[tuple[str, str], ...]) -> CrossParser:
    return CrossParser(dict(sample))


def identify_languages(docs: DataFrame, sample: dict[str, str]) -> DataFrame:
    """doc_id, lang_pred and score of every whole text; every column of docs is passed on before them.

    The language whose sample parses the text into the fewest phrases wins: all languages parse the same symbols, so
    phrases need no further division by length. A null text, a text without letters, and an empty sample give `und`
    and score 0. Columns of docs named lang_pred or score are replaced.
    """
    from pyspark.sql import types as T

    docs, frozen = docs.drop("lang_pred", "score"), tuple(sorted(sample.items()))
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(frozen)
        for batch in batches:
            texts, found, at = arrow_texts(batch), [], 0
            while at < len(texts):  # about two million characters at a time, a longer text alone
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= 2_000_000):
                    size += len(texts[end])
                    end += 1
                found += parser.predict(texts[at:end])
                at = end
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(label, schema)
