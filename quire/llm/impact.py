"""Exact top-k inner products from an impact-ordered index.

A vector is a document, a dimension a term, and the magnitude of a component its
impact, quantised to bands. A block of vectors holds, for every band, dimension
and sign, a posting segment of the vectors whose component is there. Queries are
answered score at a time: segments are processed by descending impact, adding
the band's middle to the vectors' sums for a block of queries at once.

What a vector has not been credited with yet is a vector of its own, whose norm
the index stores for every band; by Cauchy-Schwarz the true score is within
``|query| * |rest|`` of the sum. Processing stops when these bounds prove that few
vectors can be among the k best (or when the segments end), and every possible
member is scored exactly, in whole numbers. Stopping early never changes a result.

Every query block meets every vector block: vectors are dealt to parts of at most
``part_rows`` expected rows by a hash of their id; a part's index is built once and
the query blocks stream past it. A part's best k a query are merged by rank.

Defined results: vectors that are null, hold null or non-finite components, or have
no id take no part; shorter vectors are filled up with zeros; of rows with one id
the smallest vector stands for it; ties go to the smaller id; an empty table or
no query gives an empty result; other columns are not read. Vectors with a component
of 2**20 or more after scaling are kept beside the index and scored in whole numbers of
any length, and so are all vectors for a query of that kind: ranks are exact at any size.
A score that a long cannot hold is null; its rank is right.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import ship_package, shuffle_parts, stage

HIT = "query_id long, vec_id long, place string, score long"
LONG = 1 << 63
LARGE = float(1 << 20)        # components from here on are scored without the index


def place(score: int) -> str:
    """A score as text that sorts like the number."""
    digits = str(abs(score))
    said = f"{len(digits):04d}{digits}"
    return "1" + said if score >= 0 else "0" + said.translate(_TURNED)


_TURNED = str.maketrans("0123456789", "9876543210")


def _exact_scores(query: np.ndarray, rows: np.ndarray) -> list[int]:
    """Inner products in whole numbers of any length."""
    q = [int(x) for x in query.tolist()]
    return [sum(int(x) * y for x, y in zip(r, q)) for r in rows.tolist()]


class ImpactIndex:
    """Posting segments of one block of integer vectors."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, bands: int = 20):
        """``rows``: whole numbers as float64."""
        order = np.lexsort((*rows.T[::-1], ids))             # by id, then by components
        ids, rows = ids[order], rows[order]
        first = np.r_[True, ids[1:] != ids[:-1]] if len(ids) else np.zeros(0, bool)
        ids, rows = ids[first], rows[first]
        large = np.abs(rows).max(axis=1, initial=0) >= LARGE
        self.large_ids, self.large = ids[large], rows[large]
        self.ids, self.rows = ids[~large], rows[~large].astype(np.int64)
        size = np.abs(self.rows)
        top = int(size.max(initial=0))
        self.step = max(1, -(-(top + 1) // bands))
        band = size // self.step
        rest = self.rows.astype(np.float64)
        self.longest = float(np.sqrt((rest * rest).sum(axis=1)).max(initial=0))
        self.levels = []                                     # (segments, norms of what is left), descending impact
        for b in range(top // self.step, -1, -1):
            middle = b * self.step + self.step // 2
            segments = []
            for d in range(self.rows.shape[1]):
                here = (band[:, d] == b) & (size[:, d] > 0)
                for sign in (1, -1):
                    docs = np.flatnonzero(here & (self.rows[:, d] * sign > 0))
                    if len(docs):
                        segments.append((d, sign * middle, docs.astype(np.int32)))
                        rest[docs, d] -= sign * middle
            self.levels.append((segments, np.sqrt((rest * rest).sum(axis=1))))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, few: int = 8):
        """(query id, vector id, score) of vectors other than the query's own, every
        query's ``k`` best among them."""
        large = np.abs(queries).max(axis=1, initial=0) >= LARGE
        for qi, q, big in zip(query_ids.tolist(), queries, large.tolist()):
            sides = [(self.large_ids, self.large)] + ([(self.ids, self.rows)] if big else [])
            for ids, rows in sides:
                got = sorted((-s, i) for i, s in zip(ids.tolist(), _exact_scores(q, rows)) if i != qi) if len(ids) else []
                for s, i in got[:k]:
                    yield qi, i, -s
        yield from self._indexed(query_ids[~large], queries[~large].astype(np.int64), k, few)

    def _indexed(self, query_ids: np.ndarray, queries: np.ndarray, k: int, few: int):
        n = len(self.ids)
        if not n or not len(queries):
            return
        sums = np.zeros((n, len(queries)), dtype=np.int64)
        q = np.ascontiguousarray(queries.T)                  # one row a dimension
        norms = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        own = self.ids[:, None] == query_ids[None, :]
        keep = min(n, k + 1)                                 # one of the best may be the query itself
        possible = None
        for at, (segments, rest) in enumerate(self.levels):
            for d, impact, docs in segments:
                sums[docs] += impact * q[d]
            # a bound can only help once it is small beside the sums
            if at < len(self.levels) - 1 and rest.max(initial=0) * 2 > self.longest:
                continue
            slack = np.ceil(rest[:, None] * norms[None, :]).astype(np.int64) + 1
            floor = np.partition(sums - slack, n - keep, axis=0)[n - keep]   # at least ``keep`` vectors score this much
            possible = sums + slack >= floor
            if possible.sum() <= few * keep * len(queries):
                break
        for j in range(len(queries)):
            docs = np.flatnonzero(possible[:, j] & ~own[:, j])
            exact = self.rows[docs] @ queries[j]
            best = np.lexsort((self.ids[docs], -exact))[:k]
            for i in best.tolist():
                yield int(query_ids[j]), int(self.ids[docs[i]]), int(exact[i])


def _pack(batches, block: int):
    """Rows of one part as blocks: ids and components as bytes."""
    held: dict = {}

    def out(part, kind, rows):
        width = max(len(v) for _, v in rows)
        m = np.zeros((len(rows), width), dtype="<f8")
        for i, (_, v) in enumerate(rows):
            m[i, :len(v)] = v
        return (part, kind, len(rows), width, np.array([r[0] for r in rows], dtype="<i8").tobytes(), m.tobytes())

    for pdf in batches:
        made = []
        for part, kind, i, v in zip(pdf["part"], pdf["kind"], pdf["id"], pdf["v"]):
            rows = held.setdefault((part, kind), [])
            rows.append((i, v))
            if len(rows) >= block:
                made.append(out(part, kind, held.pop((part, kind))))
        yield pd.DataFrame(made, columns=["part", "kind", "n", "width", "ids", "rows"])
    yield pd.DataFrame([out(*key, rows) for key, rows in held.items()], columns=["part", "kind", "n", "width", "ids", "rows"])


BLOCK = "part int, kind int, n int, width int, ids binary, rows binary"


def _unpack(n, width, ids, rows, to: int = 0):
    m = np.frombuffer(rows, "<f8").reshape(n, width)
    return np.frombuffer(ids, "<i8"), np.pad(m, ((0, 0), (0, max(0, to - width))))


def _search(batches, k: int, bands: int):
    """Blocks sorted by part; a part's vector blocks (kind 0) come before its query blocks."""
    part, vectors, index = None, [], None
    for pdf in batches:
        for p, kind, n, width, ids, rows in zip(*[pdf[c] for c in ("part", "kind", "n", "width", "ids", "rows")]):
            if p != part:
                part, vectors, index = p, [], None
            if kind == 0:
                vectors.append((n, width, ids, rows))
                continue
            if not vectors:
                continue
            if index is None:
                wide = max(v[1] for v in vectors)
                got = [_unpack(*v, to=wide) for v in vectors]
                index = ImpactIndex(np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got]), bands)
            wide = index.rows.shape[1]
            qi, q = _unpack(n, width, ids, rows, to=wide)
            hits = [(a, b, place(s), s if -LONG <= s < LONG else None) for a, b, s in index.search(qi, q[:, :wide], k)]
            out = pd.DataFrame(hits, columns=["query_id", "vec_id", "place", "score"])
            yield out.astype({"score": "Int64"})


def integer_vectors(embeddings: DataFrame, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v): floor(scale * x) of every component as a double, which holds it exactly,
    of the vectors that take part."""
    v = F.col(vector_col)

    def whole(x):
        return F.when(F.abs(x) < 2.0 ** 62, F.floor(x).cast("double")).otherwise(x)

    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(F.lit(scale) * x.cast("double")) < float("inf")))
    return (embeddings.where(F.col(id_col).isNotNull() & v.isNotNull() & good)
            .select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: whole(F.lit(scale) * x.cast("double"))).alias("v")))


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding",
          part_rows: int = 8192, query_rows: int = 256, bands: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for every vector whose id is divisible by
    ``every``, its ``k`` highest inner products with the other vectors."""
    spark = embeddings.sparkSession
    ship_package(spark)
    vec = integer_vectors(embeddings, scale, id_col, vector_col)
    n = vec.count()
    parts = max(1, -(-n // part_rows))
    # of rows with one id the smallest vector is the query, as it is the candidate
    asks = vec.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    q_parts = max(1, -(-n // (every * query_rows)))
    own = vec.select(F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), F.lit(0).alias("kind"), "id", "v")
    ask = asks.select(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(q_parts)).cast("int").alias("part"), F.lit(1).alias("kind"), "id", "v")
    pack = partial(_pack, block=query_rows)
    wide = min(shuffle_parts(spark), parts)
    vectors = own.repartition(wide, "part").mapInPandas(pack, BLOCK)
    blocks = stage(ask.repartition(min(shuffle_parts(spark), q_parts), "part").mapInPandas(pack, BLOCK), "query_blocks")
    met = blocks.drop("part").select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "*")
    rows = vectors.unionByName(met).repartition(max(wide, 1), "part").sortWithinPartitions("part", "kind")
    hits = rows.mapInPandas(partial(_search, k=k, bands=bands), HIT)
    w = Window.partitionBy("query_id").orderBy(F.col("place").desc(), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
