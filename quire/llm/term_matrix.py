"""A sparse document-term matrix of whole texts, in CSR shards.

Words are the longest runs without ASCII white space, as they stand. A task numbers
the words of a stretch of documents for itself and writes a shard: row ends, word
numbers and counts as arrays, and its own words, dealt into buckets by a hash of the
word. Only a shard's different words then travel, a bucket of them at a time and never
the words of every document: the task that has a bucket numbers its different words, and
number and bucket make one that is the same for a word in every shard. The numbers
travel back to their shard, whose columns are renumbered. A shard has a limited number of
words (a longer single text is a shard of its own), so no task holds more; a word that
stands in every text is one word a shard.

Arrays are little-endian and compressed with zstandard: ``indptr`` 64-bit row ends
from 0 on, ``terms`` 64-bit word numbers (32-bit before they are global), ``counts``
32-bit. Columns of a row are in no order.

Defined results: null text is empty and a row without entries; repeated rows and
rows without an id are rows like others; other columns of the table are not read,
whatever their names; an empty table gives no shards.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ship_package, shuffle_parts, slices, stage

WHITE = [bytes([b]) for b in (9, 10, 11, 12, 13, 32)]
_UPPER = bytes(range(65, 91))
_INSIDE = bytes(range(0x80, 0xC0))        # UTF-8 bytes that do not start a code point
STRETCH = 1 << 22                         # bytes of a long text that are cut into words at a time

DOC = "doc_id: bigint, part: string, chars: bigint, upper: bigint, symbol: boolean, digest: binary"
LOCAL = f"shard long, docs array<struct<{DOC}>>, indptr binary, terms binary, counts binary, words array<binary>"      # words of bucket 0, 1, ..., joined by line breaks
SHARD = f"shard long, docs array<struct<{DOC}>>, indptr binary, terms binary, counts binary"
_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("part", pa.string()), ("chars", pa.int64()), ("upper", pa.int64()),
                            ("symbol", pa.bool_()), ("digest", pa.binary())]))


def _squeeze(a: np.ndarray) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def unsqueeze(raw: bytes, dtype: str) -> np.ndarray:
    """An array of a shard."""
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype)


def words_of(raw: bytes):
    """Lists of the words of a text, a long one in stretches cut at white space."""
    at = 0
    while len(raw) - at > STRETCH:
        cut = min((p for p in (raw.find(w, at + STRETCH) for w in WHITE) if p >= 0), default=-1)
        if cut < 0:
            break
        yield raw[at:cut].split()
        at = cut
    yield raw[at:].split()


class _Numbers(dict):
    """Word -> its number, in order of first use."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _facts(raw: bytes, symbols: bytes) -> tuple[int, int, bool, bytes]:
    """Code points, A-Z letters, whether one of ``symbols`` is there, digest."""
    return (len(raw.translate(None, _INSIDE)), len(raw) - len(raw.translate(None, _UPPER)),
            len(raw.translate(None, symbols)) < len(raw), hashlib.sha256(raw).digest())


def _build(batches, max_words: int, symbols: bytes, buckets: int):
    task, seq = TaskContext.get().partitionId(), 0
    local, docs, rows, counts, size = _Numbers(), [], [], [], 0

    def shard():
        words = list(local)
        of = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
        order = np.argsort(of, kind="stable")
        number = np.empty(len(words), "<i4")
        number[order] = np.arange(len(words), dtype="<i4")            # a word's place among the buckets' words
        ends = np.searchsorted(of[order], np.arange(buckets), "right").tolist()
        dealt = [words[i] for i in order.tolist()]
        joined = [b"\n".join(dealt[a:b]) for a, b in zip([0, *ends], ends)]
        terms = number[np.concatenate(rows)]
        last = np.cumsum([0] + [len(r) for r in rows], dtype="<i8")
        return pa.record_batch([pa.array([(task << 32) + seq], pa.int64()), pa.array([docs], _DOCS), pa.array([_squeeze(last)], pa.binary()),
                                pa.array([_squeeze(terms)], pa.binary()), pa.array([_squeeze(np.concatenate(counts))], pa.binary()),
                                pa.array([joined], pa.list_(pa.binary()))], ["shard", "docs", "indptr", "terms", "counts", "words"])

    for batch in slices(batches, 64):
        for doc, part, raw in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), batch.column("text").to_pylist()):
            raw = raw or b""
            found = [np.fromiter(map(local.__getitem__, ws), np.int32, len(ws)) for ws in words_of(raw)]
            terms, many = np.unique(np.concatenate(found), return_counts=True)
            chars, upper, symbol, digest = _facts(raw, symbols)
            docs.append({"doc_id": doc, "part": part, "chars": chars, "upper": upper, "symbol": symbol, "digest": digest})
            rows.append(terms.astype("<i4"))
            counts.append(many.astype("<i4"))
            size += sum(map(len, found))
            if size >= max_words:
                yield shard()
                local, docs, rows, counts, size, seq = _Numbers(), [], [], [], 0, seq + 1
    if docs:
        yield shard()


def _number(batches, buckets: int, words: bool):
    """Rows sorted by bucket: numbers for its different words in order of appearance, for
    every shard in the order of its words - or, with ``words``, the words themselves once."""
    bucket, known = None, _Numbers()
    for batch in batches:
        out = []
        for shard, b, raw in zip(*[batch.column(c).to_pylist() for c in ("shard", "bucket", "words")]):
            if b != bucket:
                bucket, known = b, _Numbers()
            before, said = len(known), raw.split(b"\n")
            number = np.fromiter(map(known.__getitem__, said), np.int64, len(said))
            if words:
                out += [(n * buckets + b, w) for n, w in zip(number.tolist(), said) if n >= before]
            else:
                out.append((shard, b, _squeeze(number.astype("<i4"))))
        names = [("term", pa.int64()), ("word", pa.binary())] if words else [("shard", pa.int64()), ("bucket", pa.int32()), ("numbers", pa.binary())]
        yield pa.record_batch([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(names)], [n for n, _ in names])


def _renumber(batches, buckets: int):
    """Rows sorted by shard and bucket: its words' numbers, then the shard (behind the last bucket)."""
    held: list[np.ndarray] = []
    for batch in batches:
        for i, (bucket, raw) in enumerate(zip(batch.column("bucket").to_pylist(), batch.column("numbers").to_pylist())):
            if bucket < buckets:
                held.append(unsqueeze(raw, "<i4").astype("<i8") * buckets + bucket)
                continue
            row = batch.slice(i, 1)
            number = np.concatenate([np.zeros(0, "<i8"), *held])
            held = []
            terms = number[unsqueeze(row.column("terms")[0].as_py(), "<i4")]
            yield pa.record_batch([row.column("shard"), row.column("docs"), row.column("indptr"), pa.array([_squeeze(terms)], pa.binary()),
                                   row.column("counts")], ["shard", "docs", "indptr", "terms", "counts"])


def term_matrix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                symbols: str = "#$%&*|", max_words: int = 2_000_000) -> tuple[DataFrame, DataFrame]:
    """(shards, dictionary): the written CSR shards - with each row's id, part, code
    points, A-Z letters, whether it holds one of ``symbols``, and a digest of its text -
    and (term, word) of every word, worked out when it is read."""
    spark = docs.sparkSession
    ship_package(spark)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(part_col).cast("string").alias("part"),
                    F.col(text_col).cast("string").cast("binary").alias("text"))
    parts = shuffle_parts(spark)
    buckets = 4 * parts
    local = stage(d.mapInArrow(partial(_build, max_words=max_words, symbols=symbols.encode("ascii"), buckets=buckets), LOCAL), "local_shards")
    words = (local.select("shard", F.posexplode("words").alias("bucket", "words")).where(F.length("words") > 0)
             .repartition(parts, "bucket").sortWithinPartitions("bucket", "shard"))
    numbers = words.mapInArrow(partial(_number, buckets=buckets, words=False), "shard long, bucket int, numbers binary")
    shards = local.select("shard", F.lit(buckets).alias("bucket"), F.lit(None).cast("binary").alias("numbers"), "docs", "indptr", "terms", "counts")
    met = shards.unionByName(numbers, allowMissingColumns=True).repartition(parts, "shard").sortWithinPartitions("shard", "bucket")
    out = stage(met.mapInArrow(partial(_renumber, buckets=buckets), SHARD), "term_matrix")
    dictionary = words.mapInArrow(partial(_number, buckets=buckets, words=True), "term long, word binary")
    return out, dictionary.select("term", F.col("word").cast("string").alias("word"))


def _totals(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            docs = batch.column("docs").slice(i, 1).flatten()
            ends = unsqueeze(batch.column("indptr")[i].as_py(), "<i8")
            counts = unsqueeze(batch.column("counts")[i].as_py(), "<i4").astype(np.int64)
            upto = np.concatenate([[0], np.cumsum(counts)])
            cols = dict(zip([f.name for f in docs.type], docs.flatten()))
            cols["n_words"] = pa.array(upto[ends[1:]] - upto[ends[:-1]], pa.int64())
            cols["n_terms"] = pa.array(np.diff(ends), pa.int64())
            yield pa.record_batch(list(cols.values()), list(cols))


def row_totals(shards: DataFrame) -> DataFrame:
    """One row a document: its facts, the sum of its matrix row and the number of its entries."""
    return shards.select("docs", "indptr", "counts").mapInArrow(_totals, DOC.replace(":", "") + ", n_words long, n_terms long")
