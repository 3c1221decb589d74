"""Token ids of whole texts, by the tokenizers library, with a word cache in each Python worker.

The lower-case vocabulary drops white space and never looks across it, so a text's ids are those of its
chunks between blanks, one after another. The byte-level one begins a piece at each run of white space, so
there a chunk is such a run and what follows it. Most chunks repeat, and a cached chunk costs a dictionary
lookup. The cache holds a bounded number of chunks; what it can't hold is encoded each time.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
import zlib
from array import array

CACHED_CHUNKS = 600_000
#: Punctuation that is stripped off a word; letters below are the same in all normal forms; scripts
#: below hold no letters that a normal form takes apart but those that `unicodedata` names.
PUNCTUATION, PLAIN_BELOW, KNOWN_BELOW = ".,;:!?*$%&#|", "\u0250", "\u0590"
#: White space of Unicode (fixed); Python's own class holds four more signs.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_U32 = "I"


def _letter(c: str) -> bool:
    """Whether c is a letter, and stays one in lower case and in composed form. Punctuation after it is a piece of its own."""
    return c < KNOWN_BELOW and c.lower().isalpha() and unicodedata.is_normalized("NFC", c)


class _Chunks(dict):
    """Chunk -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        self.encode, self.word = tokenizer.encode, tokenizer.model.tokenize
        self.spelt = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def __missing__(self, chunk: str) -> bytes:
        out = self._parts(chunk)
        if len(self) < CACHED_CHUNKS:
            self[chunk] = out
        return out

    def _parts(self, chunk: str) -> bytes:
        # Three kinds of chunk need no full pass. Punctuation after a letter is a piece of its own; ASCII
        # case is dropped ("<" may open a special token's string); and a word of lower-case Latin letters
        # is one piece that the vocabulary's normaliser leaves alone, so the model takes it as it is.
        if chunk.isalpha():
            if chunk.islower() and max(chunk) < PLAIN_BELOW:
                word = chunk if chunk.isascii() else self.spelt(chunk)[0][0]
                return array(_U32, [t.id for t in self.word(word)]).tobytes()
        elif (stem := chunk.rstrip(PUNCTUATION)) and _letter(stem[-1]):
            return self[stem] + self[chunk[len(stem) :]] if stem != chunk else self._whole(chunk)
        if chunk.isascii() and "<" not in chunk and (lower := chunk.lower()) != chunk:
            return self[lower]
        return self._whole(chunk)

    def _whole(self, chunk: str) -> bytes:
        return array(_U32, self.encode(chunk, add_special_tokens=False).ids).tobytes()


class _ByteChunks(_Chunks):
    """The same for the byte-level vocabulary; a chunk may begin with a run of white space."""

    def __init__(self, path: str):
        super().__init__(path)
        self.cut = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+").findall

    def _parts(self, chunk: str) -> bytes:
        word = chunk[1:] if chunk[0] == " " else chunk
        if word.isalpha() and max(word) < KNOWN_BELOW:
            # A run of letters is one piece, with the blank before it.
            spelt = chunk.replace(" ", "\u0120") if word.isascii() else self.spelt(chunk)[0][0]
            return array(_U32, [t.id for t in self.word(spelt)]).tobytes()
        if (stem := chunk.rstrip(PUNCTUATION)) and stem != chunk and _letter(stem[-1]):
            return self[stem] + self[chunk[len(stem) :]]
        if chunk[0] in "\n\r\t" and len(chunk) > 1 and chunk[1] not in "\n\r\t " and _letter(chunk[1]):
            return self[chunk[0]] + self[chunk[1:]]
        return self._whole(chunk)


_chunks, _byte_chunks = functools.cache(_Chunks), functools.cache(_ByteChunks)


def encoder(path: str):
    """text -> ids as bytes (unsigned 32-bit, little-endian)."""
    get = _chunks(path).__getitem__

    def ids(text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(get, text.replace("\n", " ").split(" ")))

    return ids


def byte_encoder(path: str):
    """text -> ids as bytes, for a byte-level vocabulary that puts no blank before a text."""
    chunks = _byte_chunks(path)
    get, cut = chunks.__getitem__, chunks.cut

    def ids(text: str | None) -> bytes:
        return b"".join(map(get, cut(text))) if text else b""

    return ids


def crc(ids: bytes) -> int:
    return zlib.crc32(ids)
