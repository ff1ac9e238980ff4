"""Byte-level BPE by dynamic programming over prefixes."""

from __future__ import annotations

import base64
import functools
import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from earshot.llm.chunk_cache import Remembered
from earshot.llm.common import arrow_texts, in_batches

# White space as Unicode names it; Python's own class holds U+001C-U+001F besides.
UNICODE_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Ranks:
    """A rank table: bytes of a token by id, and which two tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.listed = [self.bytes_of.get(rank, b"") for rank in range(max(self.bytes_of) + 1)]
        self.longest = max(map(len, ranks))
        self._spines: dict[tuple[int, bool], list[int]] = {}
        self.pairs = Remembered(lambda pair: self.stand_together(pair >> 32, pair & 0xFFFFFFFF), 500_000)
        # A token's last merge; tokens that no merge makes stand only for a piece that equals them.
        self.halves: dict[int, tuple[int, int] | None] = {}
        for token, rank in sorted(ranks.items(), key=lambda item: len(item[0])):
            if len(token) == 1:
                self.halves[rank] = None
                continue
            parts = self._merge(token, rank)
            if len(parts) == 2:
                self.halves[rank] = (ranks[parts[0]], ranks[parts[1]])
        # Finds the tokens that end at each byte, longest first.
        self.made = ahocorasick.Automaton()
        for rank in self.halves:
            token = self.bytes_of[rank]
            self.made.add_word(token.decode("latin-1"), (rank, len(token)))
        self.made.make_automaton()

    def _merge(self, piece: bytes, below: int) -> list[bytes]:
        """The rank merges on a short piece, with merges of rank below a limit only."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min((self.ranks.get(a + b, below) for a, b in zip(parts, parts[1:])))
            if best >= below:
                break
            at = next(i for i in range(len(parts) - 1) if self.ranks.get(parts[i] + parts[i + 1]) == best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def spine(self, token: int, right: bool) -> list[int]:
        """Tokens that grow at one end of a token, from its outermost byte to itself."""
        found = self._spines.get((token, right))
        if found is None:
            halves = self.halves[token]
            found = [token] if halves is None else [*self.spine(halves[right], right), token]
            self._spines[token, right] = found
        return found

    def stand_together(self, left: int, right: int) -> bool:
        """Whether the merges on the bytes of both give exactly these two tokens.

        Merges run in rank order, so both ends grow along their spines; the two tokens part only if no pair of
        neighbours across the border has a rank that comes before either of them grows on.
        """
        ends, begins = self.spine(left, True), self.spine(right, False)
        i = j = 0
        never = 1 << 62
        while True:
            grow_left = ends[i + 1] if i + 1 < len(ends) else never
            grow_right = begins[j + 1] if j + 1 < len(begins) else never
            joined = self.ranks.get(self.bytes_of[ends[i]] + self.bytes_of[begins[j]], never)
            if joined < grow_left and joined <= grow_right and joined < never:
                return False
            if grow_left == never and grow_right == never:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1


class PrefixEncoding:
    """The encoding of a piece, with the last token of every prefix.

    last[i] is the one token that ends the encoding of the first i bytes. Reading it backwards from the end gives the
    ids of the piece; from any i, those of that prefix. append() continues the table; edit() keeps it before the edit
    and takes the old one again as soon as a stretch as long as the longest token agrees.
    """

    def __init__(self, table: Ranks, data: bytes = b""):
        self.table, self.data, self.last = table, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self._extend(len(self.data))

    def _extend(self, upto: int) -> None:
        last, pairs, known = self.last, self.table.pairs, len(self.last)
        start = max(0, known - self.table.longest)
        for at, (token, length) in self.table.made.iter(self.data[start:upto].decode("latin-1")):
            end = start + at + 1
            if end != known:
                if end < known:
                    continue
                break
            if end == length or pairs[last[end - length] << 32 | token]:
                last.append(token)
                known += 1
        if known <= upto:
            raise ValueError("the rank table lacks a byte")

    def edit(self, begin: int, end: int, new: bytes) -> int:
        """Replace bytes begin..end; returns how many prefixes were worked out anew."""
        old, shift, tail = self.last, len(new) - (end - begin), self.table.longest
        self.data = self.data[:begin] + new + self.data[end:]
        self.last = old[:begin + 1]
        agreed = 0
        for at in range(begin + 1, len(self.data) + 1):
            self._extend(at)
            agreed = agreed + 1 if at - shift > end and old[at - shift] == self.last[at] else 0
            if agreed >= tail:
                self.last += old[at - shift + 1:]
                return at - begin
        return len(self.data) - begin

    def ids(self, end: int | None = None) -> list[int]:
        at, out = len(self.data) if end is None else end, []
        while at:
            out.append(self.last[at])
            at -= len(self.table.bytes_of[self.last[at]])
        return out[::-1]


class TextEncoder:
    """Whole texts to ids: pattern matches are encoded one by one, those of blank-separated chunks are remembered."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.table = Ranks({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})
        self.matches = regex.compile(_explicit_space(pattern)).findall
        # Where white space runs over a blank, chunks do not stand alone.
        self.runs = regex.compile(f"[{UNICODE_SPACE}] (?:[{UNICODE_SPACE}]|$)|^ ").search
        self.pieces = Remembered(self._piece, 300_000)
        self.after_blank = Remembered(lambda chunk: self._by_matches(" " + chunk))

    def _piece(self, text: str) -> bytes:
        data = text.encode("utf-8", "surrogatepass")
        whole = self.table.ranks.get(data)
        return array("I", [whole] if whole is not None else PrefixEncoding(self.table, data).ids()).tobytes()

    def _by_matches(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.matches(text)))

    def _runs(self, text: str) -> bool:
        if not ("  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " "):
            if text.replace("\n", "").isprintable():  # no other white space
                return False
        return self.runs(text) is not None

    def encode(self, text: str) -> np.ndarray:
        if self._runs(text):
            return np.frombuffer(self._by_matches(text), "<u4")
        first, *rest = text.split(" ")
        return np.frombuffer(self._by_matches(first) + b"".join(map(self.after_blank.__getitem__, rest)), "<u4")

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.table.listed.__getitem__, ids))


def _explicit_space(pattern: str) -> str:
    """The pattern with the Unicode white space spelt out, inside and outside classes."""
    out, inside = [], False
    k = 0
    while k < len(pattern):
        two = pattern[k:k + 2]
        if two == r"\s":
            out.append(UNICODE_SPACE if inside else f"[{UNICODE_SPACE}]")
        elif two == r"\S":
            out.append(f"[^{UNICODE_SPACE}]")
        elif two[0] == "\\":
            out.append(two)
        else:
            inside = two[0] == "[" or inside and two[0] != "]"
            out.append(two[0])
            k -= 1
        k += 2
    return "".join(out)


@functools.lru_cache(maxsize=2)
def text_encoder(path: str, pattern: str) -> TextEncoder:
    """One encoder per worker."""
    return TextEncoder(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the ids of every whole text, without special tokens.

    Null or empty text gives no ids. Rows come out as often as they come in; other columns are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path, pattern)
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
        for batch in batches:
            rows = ((d, encoder.encode(t)) for d, t in zip(batch.column(0).to_pylist(), arrow_texts(batch)))
            yield from in_batches(rows, schema, lambda row: 4 * len(row[1]) + 8)

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, ids array<int>")


def encoding_digests(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Number of ids, digest of the ids, and digest of the bytes that the ids decode to."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path, pattern)
        text_of = [str(i) for i in range(max(encoder.table.bytes_of) + 1)].__getitem__
        for batch in batches:
            lists = batch.column(1)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            cuts = (np.asarray(lists.offsets) - lists.offsets[0].as_py()).tolist()
            sums = []
            for begin, end in zip(cuts, cuts[1:]):
                ids = values[begin:end].tolist()  # of one text at a time
                sums.append((end - begin, hashlib.sha256(",".join(map(text_of, ids)).encode()).hexdigest(),
                             hashlib.sha256(encoder.decode(ids)).hexdigest()))
            count, ids_sum, text_sum = zip(*sums) if sums else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(ids_sum, pa.string()), pa.array(text_sum, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
