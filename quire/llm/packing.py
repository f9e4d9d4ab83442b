"""Best-fit packing of documents into sequences.

The lengths of all pieces are whole numbers up to the capacity, so one count a
length describes the whole table. The plan is made on those counts: pieces above
a third of the capacity are matched at most two a sequence, the longest first,
each with the longest that still fits; shorter pieces, the longest first, go
into the smallest gap that takes them. It is a list of equal sequences with
their number, whose size the capacity bounds whatever the table holds. A piece's
rank among the pieces of its length (distributed prefix sums) then names its
place. Nothing of the table is gathered.

Defined results: null text is empty and has the end id alone; repeated rows are
pieces of their own, and so are those of rows without an id; of a table of documents
other columns are not read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import frees_memory, ship_package, slices, stage
from quire.llm.tokens import END_ID, default_vocabulary, encoder

PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long"


@frees_memory
def _cut(batches, vocabulary: str, capacity: int, with_ids: bool):
    enc, end = encoder(vocabulary), END_ID.to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()] + [pa.binary()] * with_ids
    for batch in slices(batches):
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids = enc.ids(text) + end
            n = len(ids) // 4
            at, piece, size = 0, 0, n % capacity or min(n, capacity)
            while at < n:
                part = ids[4 * at:4 * (at + size)]
                row = (doc, piece, at, size, zlib.crc32(part))
                rows.append(row + (part,) if with_ids else row)
                at, piece, size = at + size, piece + 1, capacity
        yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)
    enc.forget()


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = 1024, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, [ids]): whole documents, and longer
    ones in pieces of ``capacity`` ids of which the first may be shorter."""
    ship_package(docs.sparkSession)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(partial(_cut, vocabulary=vocabulary or default_vocabulary(), capacity=capacity, with_ids=with_ids),
                         PIECE + (", ids binary" if with_ids else ""))


def plan(counts: dict[int, int], capacity: int = 1024) -> list[tuple[list[tuple[int, int]], int]]:
    """``[(contents, sequences), ...]`` for ``{length: pieces}``; contents are
    (length, how many) in order of place."""
    left = {n: c for n, c in counts.items() if c > 0}
    gaps: dict[int, list] = defaultdict(list)     # gap -> [[contents, sequences], ...]

    def put(contents, sequences):
        if sequences:
            gaps[capacity - sum(n * m for n, m in contents)].append([contents, sequences])

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        for m in large:                            # longest partner that fits
            if not left[n]:
                break
            if n + m > capacity or not left[m]:
                continue
            k = left[n] // 2 if m == n else min(left[n], left[m])
            put([(n, 1), (m, 1)] if m != n else [(n, 2)], k)
            left[n] -= k
            left[m] -= k
        put([(n, 1)], left[n])
        left[n] = 0
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        todo = left[n]
        while todo:
            fits = min((g for g in gaps if g >= n and gaps[g]), default=None)
            if fits is None:                       # open new sequences
                each = capacity // n
                put([(n, each)], todo // each)
                put([(n, todo % each)] if todo % each else [], 1 if todo % each else 0)
                break
            contents, sequences = gaps[fits].pop()
            each = fits // n                       # a gap just used is the smallest one left: fill it up
            full = min(sequences, todo // each)
            put(contents + [(n, each)], full)
            todo -= full * each
            if full < sequences and todo:
                some = min(todo, each)
                put(contents + [(n, some)], 1)
                todo -= some
                full += 1
            put(contents, sequences - full)
    return [(c, k) for g in sorted(gaps) for c, k in gaps[g]]


def slots(made: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, per sequence, first sequence, offset) for every run of equal places."""
    used: dict[int, int] = defaultdict(int)
    out, first = [], 0
    for contents, sequences in made:
        at = 0
        for n, each in contents:
            out.append((n, used[n], used[n] + each * sequences, each, first, at))
            used[n] += each * sequences
            at += n * each
        first += sequences
    return out


def pack(cut: DataFrame, capacity: int = 1024, buckets: int = 256) -> DataFrame:
    """``cut`` (any frame with doc_id, piece, start, length; lengths 1 to ``capacity``)
    with ``sequence_id`` and ``offset``."""
    spark = cut.sparkSession
    cut = cut.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    per = stage(cut.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n")), "length_counts")
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    where = spark.createDataFrame(slots(plan(counts, capacity)) or [(0, 0, 0, 1, 0, 0)],
                                  "length int, _lo long, _hi long, _each long, _first long, _at long")
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("length", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_b").orderBy("doc_id", "piece", *[c for c in ("ids_crc32",) if c in cut.columns])
    ranked = (cut.withColumn("_r", F.row_number().over(inside)).join(F.broadcast(base), ["length", "_b"])
              .withColumn("_rank", F.col("_base") + F.col("_r") - 1))       # at most capacity * buckets rows
    q = F.col("_rank") - F.col("_lo")
    placed = ranked.join(F.broadcast(where), (ranked["length"] == where["length"]) & (F.col("_rank") >= F.col("_lo"))
                         & (F.col("_rank") < F.col("_hi"))).drop(where["length"])
    return placed.select(*[c for c in cut.columns if c != "_b"],
                         (F.col("_first") + F.expr("(_rank - _lo) div _each")).alias("sequence_id"),
                         (F.col("_at") + F.pmod(q, F.col("_each")) * F.col("length")).alias("offset"))


def pack_documents(docs: DataFrame, capacity: int = 1024, **options) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.
    The pieces are staged without their ids, so texts are encoded once."""
    cut = stage(pieces(docs, capacity=capacity, **options), "pieces")
    out = pack(cut, capacity)
    return out.withColumn("length", F.col("length").cast("long"))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_ids, ids): the ids of every sequence, from pieces packed with
    their ids (``pieces(..., with_ids=True)``); a group is at most one capacity."""
    g = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    return g.select("sequence_id", (F.length(joined) / 4).cast("int").alias("n_ids"), joined.alias("ids"))
