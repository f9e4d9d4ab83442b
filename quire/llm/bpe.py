"""BPE encoding and decoding by guessing and proving.

A text is cut at white space, which no word of the tokenizer reaches over, and the
library's own normaliser and word splitter turn each different chunk into words.
For every new word of a stretch of documents, greedy longest match against the
vocabulary proposes tokens. Merging is right for a whole word exactly when it is
right for every two neighbours alone, so all different neighbour pairs of the
stretch are proved at once on arrays: both tokens' merges are undone, latest
first, and a pair fails where a merge across the border would have come before the
next merge on either side. Only the words that hold a failing pair are merged
exactly, by rank. The words a task has met are remembered up to a limit, and
forgotten when the task ends.

Expected of the vocabulary file: a BPE model without dropout, unknown token or byte
fallback, whose every merge comes after the merges that make its parts and makes a
token of its own; an alphabet that holds every byte; white space dropped.

Defined results: null text is empty and has no ids; a special token's string in a
text is that token; repeated rows and rows without an id are rows like others;
texts of any length are taken whole, in stretches; other columns of the table are
not read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ship_package, slices

#: white space as the tokenizers' ``\s`` has it; ``str.split`` also cuts at the four separators below
_WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
_END = "\0"                   # stands for the end-of-word suffix; no byte letter
_NEVER = np.iinfo(np.int64).max
if sys.byteorder != "little" or array("i").itemsize != 4:
    raise ImportError("ids are kept as little-endian 32-bit integers")
STRETCH = 1 << 20             # characters of a long text that are unpacked at a time


def word_vocabulary() -> str:
    """Path of the installed public vocabulary; every caller takes another as a parameter."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _chunks(text: str) -> list[str]:
    if _SEPARATORS.search(text):
        return [c for c in _WHITE.split(text) if c]
    return text.split()


def _stretches(text: str) -> Iterator[str]:
    """A long text in parts of about ``STRETCH`` characters, cut at white space."""
    at = 0
    while len(text) - at > STRETCH:
        gap = _WHITE.search(text, at + STRETCH)
        if gap is None:
            break
        yield text[at:gap.start()]
        at = gap.end()
    yield text[at:]


class MergeTable:
    """The merges of a BPE model as arrays: parts and rank of every token, and the
    rank of every pair."""

    def __init__(self, merges: list[tuple[int, int, int]], size: int):
        """``merges``: (left, right, made) token numbers in order of rank."""
        m = np.array(merges, dtype=np.int64).reshape(-1, 3)
        self.size = size
        self.rank = np.full(size, -1, dtype=np.int64)            # single symbols: -1
        self.left, self.right = np.arange(size), np.arange(size)
        if (self.rank[m[:, 2]] >= 0).any() or len(np.unique(m[:, 2])) < len(m):
            raise ValueError("two merges make one token")
        self.rank[m[:, 2]] = np.arange(len(m))
        self.left[m[:, 2]], self.right[m[:, 2]] = m[:, 0], m[:, 1]
        if (np.maximum(self.rank[m[:, 0]], self.rank[m[:, 1]]) >= np.arange(len(m))).any():
            raise ValueError("a merge comes before the merges that make its parts")
        key = m[:, 0] * size + m[:, 1]
        self._order = np.argsort(key)
        self._keys = key[self._order]
        self.ranks = {k: r for r, k in enumerate(key.tolist())}
        self.made = m[:, 2].tolist()
        #: tokens that merging their own symbols gives back; others are never proposed
        made = self.compatible(m[:, 0], m[:, 1], np.arange(len(m)))
        whole = [True] * size
        for (a, b, c), good in zip(m.tolist(), made.tolist()):
            whole[c] = good and whole[a] and whole[b]
        self.whole = whole

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.searchsorted(self._keys, key)
        at[at == len(self._keys)] = 0
        found = self._keys[at] == key if len(self._keys) else np.zeros(len(key), bool)
        return np.where(found, self._order[at] if len(self._keys) else 0, _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether merging the symbols of token ``a`` followed by those of ``b`` leaves
        both tokens as they are (at least before rank ``until``)."""
        good = np.ones(len(a), dtype=bool)
        at = np.arange(len(a))
        next_a = np.full(len(a), _NEVER) if until is None else until.copy()
        next_b = next_a.copy()
        while len(at):
            across = self.pair_rank(a, b)
            # of equal ranks the leftmost merge comes first
            bad = (across < next_a) & (across <= next_b)
            good[at[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            at, a, b, ra, rb, next_a, next_b = (x[go] for x in (at, a, b, ra, rb, next_a, next_b))
            undo_b = rb >= ra
            next_a, next_b = np.where(undo_b, next_a, ra), np.where(undo_b, rb, next_b)
            a, b = np.where(undo_b, a, self.right[a]), np.where(undo_b, self.left[b], b)
        return good

    def merge(self, symbols: list[int]) -> list[int]:
        """Exact merging: the lowest rank first, the leftmost of equals."""
        if len(symbols) > 64:
            return self._merge_long(symbols)
        size, rank, made = self.size, self.ranks.get, self.made
        tok = list(symbols)
        rs = [rank(a * size + b, _NEVER) for a, b in zip(tok, tok[1:])]
        while rs and (low := min(rs)) != _NEVER:
            i = rs.index(low)
            tok[i] = t = made[low]
            del tok[i + 1], rs[i]
            if i:
                rs[i - 1] = rank(tok[i - 1] * size + t, _NEVER)
            if i < len(rs):
                rs[i] = rank(t * size + tok[i + 1], _NEVER)
        return tok

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same order from a heap, for words of any length."""
        size, rank, made = self.size, self.ranks.get, self.made
        n = len(symbols)
        tok, nxt, prev = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))

        def pair(i, j):
            r = rank(tok[i] * size + tok[j])
            if r is not None:
                heapq.heappush(heap, (r, i, tok[i], tok[j]))

        heap: list = []
        for i in range(n - 1):
            pair(i, i + 1)
        while heap:
            low, i, a, b = heapq.heappop(heap)
            j = nxt[i] if tok[i] == a else n
            if j >= n or tok[j] != b:
                continue
            tok[i], tok[j], nxt[i] = made[low], None, nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
                pair(i, nxt[i])
            if prev[i] >= 0:
                pair(prev[i], i)
        return [t for t in tok if t is not None]


class WordBpe:
    """The encoder of one task. ``ids`` takes texts to ids as little-endian int32 bytes."""

    def __init__(self, vocabulary: str, limit: int = 600_000):
        from tokenizers import Tokenizer
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "continuing_subword_prefix")):
            raise ValueError("only plain BPE models are taken")
        self.suffix = model.get("end_of_word_suffix") or ""
        tok = Tokenizer.from_file(vocabulary)
        self.normalise = tok.normalizer.normalize_str if tok.normalizer else str
        self.split_words = tok.pre_tokenizer.pre_tokenize_str
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = {s: np.int32(i).tobytes() for s, i in special.items()}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        glued = self.suffix if self.suffix else None
        self.table = MergeTable([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], max(vocab.values()) + 1)

        def inner(t: str) -> str:
            return t[:-len(glued)] + _END if glued and t.endswith(glued) and len(t) > len(glued) else t

        self.token = {inner(t): i for t, i in vocab.items() if self.table.whole[i]}
        self.longest: dict[str, int] = {}            # by the first three letters
        for t in self.token:
            self.longest[t[:3]] = max(len(t), self.longest.get(t[:3], 2))
        self.limit = limit
        self.words: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.proposed = self.failed = 0

    def _propose(self, word: str) -> list[int]:
        """Greedy longest match; the end mark always goes with the letter before it."""
        out, at, n, get, longest = [], 0, len(word), self.token.get, self.longest.get
        loose = n - 1 if word.endswith(_END) else -1
        while at < n:
            to = min(n, at + longest(word[at:at + 3], 2))
            t = None if to == loose else get(word[at:to])
            while t is None:
                to -= 1
                t = None if to == loose else get(word[at:to])
            out.append(t)
            at = to
        return out

    def _symbols(self, word: str) -> list[int]:
        parts = list(word[:-2]) + [word[-2:]] if word.endswith(_END) else list(word)
        return [self.token[p] for p in parts]

    def _learn_words(self, words: list[str]) -> None:
        guesses = [self._propose(w) for w in words]
        length = np.fromiter(map(len, guesses), np.int64, len(guesses))
        flat = np.fromiter(chain.from_iterable(guesses), np.int64, int(length.sum()))
        of = np.repeat(np.arange(len(words)), length)
        inside = of[1:] == of[:-1]
        key = (flat[:-1] * self.table.size + flat[1:])[inside]
        pairs, which = np.unique(key, return_inverse=True)
        good = self.table.compatible(pairs // self.table.size, pairs % self.table.size)
        wrong = np.zeros(len(words), dtype=bool)
        wrong[of[1:][inside][~good[which]]] = True
        flat = flat.astype("<i4")
        at = np.concatenate([[0], np.cumsum(length)]) * 4
        raw = flat.tobytes()
        for i, (w, a, b) in enumerate(zip(words, at[:-1].tolist(), at[1:].tolist())):
            self.words[w] = raw[a:b] if not wrong[i] else array("i", self.table.merge(self._symbols(w))).tobytes()
        self.proposed += len(words)
        self.failed += int(wrong.sum())

    def learn(self, chunks: Iterable[str]) -> None:
        """Remember the ids of every chunk of ``chunks``."""
        now = set(chunks)
        new = [c for c in now if c not in self.known]
        if len(self.known) + len(new) > self.limit:
            self.known = {c: self.known[c] for c in now if c in self.known}
            self.words = {}
        # special tokens are cut out of the text before anything else is done with it
        if self._special and self._special.search(" ".join(new)):
            cuts = [[p for p in self._special.split(c) if p] for c in new]
            plain = [p for parts in cuts for p in parts if p not in self.special]
        else:
            cuts, plain = None, new
        norm = self.normalise(" ".join(plain))
        starts = np.flatnonzero(np.frombuffer(norm.encode("utf-32-le"), "<u4") == 32) if norm else np.zeros(0, int)
        pieces = self.split_words(norm) if norm else []
        owner = np.searchsorted(starts, [s for _, (s, _) in pieces])
        ends = np.searchsorted(owner, np.arange(len(plain)), "right").tolist()
        said = [w + _END for w, _ in pieces] if self.suffix else [w for w, _ in pieces]
        fresh = [w for w in set(said) if w not in self.words]
        if fresh:
            self._learn_words(fresh)
        got = list(map(self.words.__getitem__, said))
        spans = zip([0, *ends], ends)
        if cuts is None:
            for c, (a, b) in zip(new, spans):
                self.known[c] = got[a] if b - a == 1 else b"".join(got[a:b])
            return
        for c, parts in zip(new, cuts):
            ids = []
            for p in parts:
                if p in self.special:
                    ids.append(self.special[p])
                else:
                    a, b = next(spans)
                    ids += got[a:b]
            self.known[c] = b"".join(ids)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian int32 ids of every text. Nothing here makes reference cycles,
        so the collector, which would walk the word memory again and again, rests."""
        running = gc.isenabled()
        gc.disable()
        try:
            return self._ids(texts)
        finally:
            if running:
                gc.enable()

    def _ids(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        short = [(i, _chunks(t)) for i, t in enumerate(texts) if t and len(t) <= STRETCH]
        self.learn(chain.from_iterable(c for _, c in short))
        for i, c in short:
            out[i] = b"".join(map(self.known.__getitem__, c))
        for i, t in enumerate(texts):
            if t and len(t) > STRETCH:
                parts = []
                for stretch in _stretches(t):
                    c = _chunks(stretch)
                    self.learn(c)
                    parts.append(b"".join(map(self.known.__getitem__, c)))
                out[i] = b"".join(parts)
        return out


def _list_of(values: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(v) // 4 for v in values], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(values), "<i4")))


def _encode(batches, vocabulary: str, limit: int):
    enc = WordBpe(vocabulary, limit)
    for batch in slices(batches):
        yield pa.record_batch([batch.column("doc_id"), _list_of(enc.ids(batch.column("text").to_pylist()))], ["doc_id", "ids"])


def encode(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text",
           limit: int = 600_000) -> DataFrame:
    """(doc_id, ids): the token ids of every whole text. ``limit`` bounds the chunks a task remembers."""
    ship_package(docs.sparkSession)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(partial(_encode, vocabulary=vocabulary or word_vocabulary(), limit=limit), "doc_id long, ids array<int>")


def _decode(batches, vocabulary: str):
    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    if spec.get("decoder"):
        raise ValueError("only vocabularies without a decoder are taken: their tokens are joined by blanks")
    tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
    size = max(tokens) + 1
    names = np.array([tokens.get(i) for i in range(size)] + [None], dtype=object)      # the last: no such id
    for batch in slices(batches):
        lists = batch.column("ids")
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        flat = np.where((flat >= 0) & (flat < size), flat, size).astype(np.int64) if len(flat) else np.zeros(0, np.int64)
        said = names[flat]
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)).tolist()
        out, at = [], 0
        for end, there in zip(ends, lists.is_valid().to_pylist()):
            words = said[at:end].tolist()
            out.append(" ".join(words if None not in words else [w for w in words if w is not None]) if there else None)
            at = end
        yield pa.record_batch([batch.column("doc_id"), lists, pa.array(out, pa.string())], ["doc_id", "ids", "decoded"])


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, ids) with the text the ids stand for, special tokens
    included; ids that the vocabulary does not have are left out, no ids: no text."""
    ship_package(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(partial(_decode, vocabulary=vocabulary or word_vocabulary()),
                                                      "doc_id long, ids array<int>, decoded string")
