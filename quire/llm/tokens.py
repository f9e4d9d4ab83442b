"""Byte-level BPE ids of whole texts, by the tokenizers library.

Byte-level BPE splits a text before it encodes anything, and no split piece
reaches over a single blank, so a text's ids are the ids of its blank-separated
chunks, put together. A chunk is encoded by the library once and remembered as
bytes; a text whose white space does not allow the cut is encoded whole.
"""

from __future__ import annotations

import re
import string
import sys
from array import array

#: without these, white space stands alone and inside the text: every blank and line break is a cut
_LOOSE = re.compile(r"\s\s|\A\s|\s\Z")
#: runs of white space that a piece may span across a blank
_SPANS_BLANK = re.compile(r"\s (?:\s|\Z)")
#: a break between two characters that are not white space is a piece of its own
_LINE_EDGE = re.compile(r"\s\n|\n\s|\A\n|\n\Z")
#: punctuation that ends the piece of the letters before it (an apostrophe may begin a contraction)
_MARKS = "".join(c for c in string.punctuation if c != "'")
END_ID = 2
LONG = 64                     # characters of a chunk that is not remembered
if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are kept as little-endian 32-bit integers")


def default_vocabulary() -> str:
    """Path of the installed public vocabulary; every caller takes another as a parameter."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    take the code points from 256 on, in order."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in keep else next(rest)) for b in range(256)]


class _Chunks(dict):
    """Chunk -> little-endian uint32 ids, in two generations: when the newer one
    is full, it becomes the older one, so memory is bounded and words in use stay."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self.encode(chunk)
        if len(chunk) > LONG:                       # seldom met again, and of any size
            return ids
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[chunk] = ids
        return ids


class Encoder:
    """One per Python worker (:func:`encoder`). ``ids(text)`` gives the bytes of
    the text's ids as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: str, limit: int = 500_000):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(vocabulary)
        self.tok.encode_special_tokens = True       # their strings in a text are ordinary text
        self.tokenize = self.tok.model.tokenize     # the library's merges on one split piece
        self.letters = {b: ord(c) for b, c in enumerate(byte_letters())}
        self.blank = byte_letters()[32]
        self.bare = _Chunks(self._bare, limit // 4)     # chunks as they stand
        self.after = _Chunks(self._after_blank, limit)  # chunks with a blank before them
        self.line = self._raw("\n")

    def _raw(self, s: str) -> bytes:
        return array("I", self.tok.encode(s, add_special_tokens=False).ids).tobytes()

    def _bare(self, chunk: str) -> bytes:
        return self._chunk(chunk, "", "", self.bare)

    def _after_blank(self, chunk: str) -> bytes:
        return self._chunk(chunk, " ", self.blank, self.after)

    def _chunk(self, chunk: str, lead: str, mark: str, same: _Chunks) -> bytes:
        if chunk.isalpha():                         # letters, and a blank before them, are one split piece
            piece = mark + (chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(self.letters))
            return array("I", [t.id for t in self.tokenize(piece)]).tobytes()
        word = chunk.rstrip(_MARKS)
        if word and len(word) < len(chunk) and word[-1].isalpha():
            return same[word] + self.bare[chunk[len(word):]]
        return self._raw(lead + chunk)

    def forget(self) -> None:
        """Give the remembered chunks back: at the end of a task the worker goes on to others."""
        for chunks in (self.bare, self.after):
            chunks.clear()
            chunks.old = {}

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        whole = False
        if _LOOSE.search(text):
            if _SPANS_BLANK.search(text):
                return self._raw(text)
            whole = _LINE_EDGE.search(text) is not None
        out, after = [], self.after.__getitem__
        for line in [text] if whole else text.split("\n"):
            first, *rest = line.split(" ")
            out.append(self.line)
            if first:
                out.append(self.bare[first])
            out.extend(map(after, rest))
        return b"".join(out[1:])


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """The worker's encoder for a vocabulary file, built once and kept."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]
