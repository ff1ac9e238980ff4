"""Token ids of the pieces and chunks of texts, remembered per Python worker."""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Callable

import numpy as np


class Remembered(dict):
    """Values of a function by key, at most max_entries of them; a full table is emptied."""

    def __init__(self, make: Callable[[str], bytes], max_entries: int = 700_000):
        super().__init__()
        self.make, self.max_entries = make, max_entries

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.max_entries:
            self.clear()
        value = self[key] = self.make(key)
        return value


class ChunkEncoder:
    """Encodes as the tokenizers library does with add_special_tokens=False, remembering what texts are made of.

    The tokenizer must drop white space and never join characters across it; then the ids of a text are the ids of its
    blank-separated chunks one after another. Chunks of plain characters are cut by the file's own pattern. A text that
    holds the string of an added token goes through the library as a whole, which gives that token's id.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = tuple(token.content for token in self.tokenizer.get_added_tokens_decoder().values())
        self.width = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.width.itemsize == 2 else "I"
        self.tokenize = self.tokenizer.model.tokenize
        self.known = Remembered(self._chunk, 500_000)
        self.pieces = Remembered(self._piece, 200_000)
        self.split = self._splitter()

    def _splitter(self) -> Callable[[str], list[str]] | None:
        """The file's own split pattern, where its steps are lower case, split and bytes as characters."""
        steps = json.loads(self.tokenizer.to_str())
        kinds = [s["type"] for part in ("normalizer", "pre_tokenizer")
                 for s in (steps[part] or {}).get("normalizers", (steps[part] or {}).get("pretokenizers", []))]
        if kinds != ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"] or steps["post_processor"]:
            return None
        cut, level = steps["pre_tokenizer"]["pretokenizers"]
        if cut["behavior"] != "Removed" or not cut["invert"] or level["add_prefix_space"] or level["use_regex"]:
            return None
        # Only for characters on which composition, case and the byte step are plain: printable up to U+017F.
        listed = "!-~\xa1-įĲ-ſ"
        pattern = cut["pattern"]["Regex"]
        for name in "LN":  # the standard module knows no such classes: the few characters are listed
            members = "".join(c for c in map(chr, range(0x180)) if unicodedata.category(c)[0] == name)
            pattern = pattern.replace(f"\\p{{{name}}}", members)
        if "\\p" in pattern:
            return None
        self.plain = re.compile(f"[{listed}]+").fullmatch
        from tokenizers.pre_tokenizers import ByteLevel

        self.as_characters = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        return re.compile(pattern).findall

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = self.as_characters(piece)[0][0]
        return array(self.code, [t.id for t in self.tokenize(piece)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if self.split is not None and chunk.isascii() and chunk.isalpha():
            return self.pieces[chunk.lower()]
        if self.split is not None and self.plain(chunk):
            return b"".join(map(self.pieces.__getitem__, self.split(chunk.lower())))
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, self.width).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian integers of self.width."""
        if any(token in text or token in text.lower() for token in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width).tobytes()
        return b"".join(map(self.known.__getitem__, text.replace("\n", " ").split(" ")))


@functools.lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    """One encoder per worker and tokenizer file."""
    return ChunkEncoder(path)
