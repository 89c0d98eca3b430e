"""Token ids of texts from the public vocabularies, cached by chunk.

Both encoders cut a text where no token can cross (white space, or a single space between two other
characters), and remember the ids of each chunk as bytes. A worker keeps its cache from task to task;
the cache has a fixed number of entries, and a chunk outside it is encoded again.
"""

from __future__ import annotations

import base64
import functools
import json
import re
import unicodedata

import numpy as np
import public_tokenizers
import regex
import tiktoken
from tokenizers import Tokenizer

#: Entries that a worker's cache holds at most.
CACHE_ENTRIES = 400_000
#: White space for ``str.split`` or for the vocabulary's pattern, but not for both or not in ASCII.
UNUSUAL_SPACE = "\x1c\x1d\x1e\x1f\x85\xa0                　"
#: Marks a word's end; no UTF-8 text holds this byte.
WORD_END = b"\xff"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabulary files."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordEncoder(dict):
    """Chunk -> ids (little-endian uint32) of a lower-casing BPE vocabulary with word ends.

    Chunks of Latin letters, digits and signs are merged by rank; a word's end is a byte of its own
    that the first 256 ranks attach to the last one. All others go to ``tokenizers`` itself. Both
    give the ids that ``tokenizers`` gives for the whole text.
    """

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.entries = entries
        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, end = byte_alphabet(), model["end_of_word_suffix"]
        names = [c for c in letters] + [c + end for c in letters]
        names += ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]

        def raw(name: str) -> bytes:
            last = name.endswith(end)
            return bytes(letters[c] for c in name.removesuffix(end)) + WORD_END * last

        ranks = {raw(name): i for i, name in enumerate(names)} | {WORD_END: len(names)}
        self.merge = tiktoken.Encoding("words", pat_str=".+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.ids = [np.uint32(model["vocab"][name]).astype("<u4").tobytes() for name in names]
        self.plain = re.compile("[!-~À-įı-ɏ]+").fullmatch
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall

    def __missing__(self, chunk: str) -> bytes:
        if not self.plain(chunk) or "<|" in chunk:
            found = np.array(self.full.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()
        else:
            lower = chunk.lower()
            parts = [lower] if lower.isalpha() else self.pieces(lower)
            found = b"".join([self.ids[r] for p in parts for r in self.merge(p.encode() + WORD_END)])
        if len(self) < self.entries:
            self[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        if any(c in text for c in (UNUSUAL_SPACE[:4] if text.isascii() else UNUSUAL_SPACE)) or not unicodedata.is_normalized("NFC", text):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join([self[w] for w in text.split()])


class ByteEncoder(dict):
    """Chunk -> ids (little-endian uint32) of a byte-level BPE vocabulary; any text decodes back exactly."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.entries = entries
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.full = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.merge = self.full._core_bpe.encode_single_piece
        self.ids = [np.uint32(i).tobytes() for i in range(max(ranks.values()) + 1)]

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise KeyError(chunk)  # its white space belongs together with the space before or after it
        text = " " + chunk
        ranks = self.merge(text.encode()) if chunk.isalpha() else self.full.encode_ordinary(text)
        found = b"".join([self.ids[r] for r in ranks])
        if len(self) < self.entries:
            self[chunk] = found
        return found

    def whole(self, text: str) -> bytes:
        return np.array(self.full.encode_ordinary(text), dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if not rest or not first or first[-1].isspace():
            return self.whole(text)
        try:
            return self.whole(first) + b"".join([self[w] for w in rest])
        except KeyError:
            return self.whole(text)


@functools.cache
def encoder(path: str) -> WordEncoder | ByteEncoder:
    """The encoder of a vocabulary file, one for each worker."""
    return WordEncoder(path) if path.endswith(".json") else ByteEncoder(path)
