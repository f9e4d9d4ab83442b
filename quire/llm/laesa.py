"""Vector code compression with LAESA pivots.

A vector of whole numbers is cut into equal consecutive parts, and every part is
replaced by the number of its nearest codebook entry. The codebooks start as the
parts of the smallest ids and move to the mean of what they hold, round by round.

Few pivots of every part position are fixed at the start (starting entries far
apart), and the distance of every part to them is worked out once and written
beside the vector. In each round the distances between pivots and entries give
``|d(part, pivot) - d(pivot, entry)|``, which no part can be nearer to the entry
than: entries are tried in the order of that bound, and a part stops as soon as the
bound exceeds the best distance found. Only entries that are tried cost an exact
evaluation in whole numbers; the bounds are rounded down, so pruning never changes
a result. A round is one pass over the written table whose tasks return sums and
counts for each entry; codebooks (a fixed number of entries) are all the driver holds.

Defined results: rows whose vector is null or holds a null or non-finite component
take no part. Shorter vectors are filled up with zeros to the longest one's length,
and that to a multiple of the parts. Repeated rows count each by itself; rows
without an id come last in the order of ids, of one id the smaller vector comes
first. With fewer rows than entries the codebooks have as many entries as rows.
Components of any size are exact, whole numbers of any length being used where 64
bits do not hold the distances (one that a double cannot hold once scaled counts as
not finite); an error that a long cannot hold is null, and so is that of its label. Null labels are one label. Other columns are not read, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ship_package, slices, stage
from quire.session import unstage

DIGIT = 60                    # bits of one digit of a sum that travels to the driver
LONG = 1 << 63


def _whole(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as float64; scaling by a power of two keeps every finite float exact."""
    return np.floor(scale * x)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    lists = [np.asarray(v, dtype=np.float64) for v in column.to_pylist()] if len(column) else []
    out = np.zeros((len(lists), width))
    for row, v in zip(out, lists):
        row[:len(v)] = v
    return out


def _exact(m: np.ndarray, others: int, parts: int) -> np.ndarray:
    """``m`` (whole numbers as float64 or Python integers) as int64 where all
    distances to numbers up to ``others`` fit, else as Python integers."""
    if m.dtype == object:
        return m
    top = max(float(np.abs(m).max(initial=0)), float(others))
    if m.size == 0 or (2 * top) ** 2 * m.shape[-1] * parts < 2 ** 62:
        return m.astype(np.int64)
    flat = np.empty(m.size, dtype=object)
    flat[:] = [int(x) for x in m.ravel().tolist()]
    return flat.reshape(m.shape)


def _pack(m: np.ndarray) -> list[bytes]:
    """Rows of whole numbers as bytes: two, four or eight a component."""
    top = np.abs(m).max(initial=0)
    kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<f8"
    return [r.tobytes() for r in m.astype(kind)]


def _unpack(rows: list[bytes], width: int) -> np.ndarray:
    kinds = {2 * width: "<i2", 4 * width: "<i4", 8 * width: "<f8"}
    return np.stack([np.frombuffer(r, kinds[len(r)]).astype(np.float64) for r in rows])


class Codebooks:
    """Entries of every part position, with the pivots that stay fixed."""

    def __init__(self, first: list[list[int]], parts: int, pivots: int):
        """``first``: the vectors whose parts are the starting entries."""
        step = len(first[0]) // parts
        self.parts, self.step = parts, step
        self.entries = [[tuple(v[j * step:(j + 1) * step]) for v in first] for j in range(parts)]
        self.pivots = [self._apart(e, pivots) for e in self.entries]

    @staticmethod
    def _apart(entries: list[tuple], want: int) -> list[tuple]:
        """Entries far from each other: each next one is the farthest from those chosen."""
        chosen = [entries[0]]
        gap = [_d2(e, chosen[0]) for e in entries]
        while len(chosen) < min(want, len(entries)):
            k = gap.index(max(gap))
            chosen.append(entries[k])
            gap = [min(g, _d2(e, entries[k])) for g, e in zip(gap, entries)]
        return chosen

    def move(self, sums: dict[tuple[int, int, int], int]) -> None:
        """Every used entry to the floor of its parts' mean. ``sums``: (part, entry,
        place) -> total, place -1 holding the number of parts."""
        for j, entries in enumerate(self.entries):
            for k in range(len(entries)):
                n = sums.get((j, k, -1), 0)
                if n:
                    entries[k] = tuple(sums.get((j, k, i), 0) // n for i in range(self.step))

    def digest(self) -> str:
        said = ",".join(str(x) for entries in self.entries for e in entries for x in e)
        return hashlib.sha256(said.encode()).hexdigest()


def _d2(a: tuple, b: tuple) -> int:
    return sum((x - y) ** 2 for x, y in zip(a, b))


def _root(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64))


class Nearest:
    """The exact nearest entry of every part of a block, pruned by pivot bounds."""

    def __init__(self, books: Codebooks):
        self.books = books
        self.top = max(abs(x) for entries in books.entries for e in entries for x in e)
        self.top = max([self.top] + [abs(x) for p in books.pivots for e in p for x in e])
        self.entries = [self._array(e) for e in books.entries]
        self.to_pivot = [np.array([[float(_d2(p, e)) ** 0.5 for e in entries] for p in pivots])
                         for entries, pivots in zip(books.entries, books.pivots)]
        self.tried = 0

    @staticmethod
    def _array(rows: list[tuple]) -> np.ndarray:
        out = np.empty((len(rows), len(rows[0])), dtype=object)
        out[:] = rows
        return out

    def of(self, v: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(codes, squared distances, evaluations a row) of ``v`` (rows, parts, places);
        ``near`` (rows, parts, pivots) holds the written distances to the pivots."""
        v = _exact(v, self.top, self.books.parts)
        n, parts = len(v), self.books.parts
        codes = np.zeros((n, parts), dtype=np.int64)
        far = np.zeros((n, parts), dtype=v.dtype)
        tried = np.zeros(n, dtype=np.int64)
        for j in range(parts):
            entries = self.entries[j] if v.dtype == object else self.entries[j].astype(np.int64)
            x = v[:, j, :]
            low = np.zeros((n, len(entries)))
            for p, to_entry in enumerate(self.to_pivot[j]):
                a, b = near[:, j, p, None].astype(np.float64), to_entry[None, :]
                with np.errstate(invalid="ignore", over="ignore"):
                    bound = np.abs(a - b) - (a + b) * 2.0 ** -20          # written as float32: rounded down
                np.maximum(low, np.where(np.isfinite(bound), bound, 0.0), out=low)
            order = np.argsort(low, axis=1, kind="stable")
            low = np.take_along_axis(low, order, axis=1)
            code = order[:, 0]
            best = ((x - entries[code]) ** 2).sum(axis=1)
            root = _root(best)
            tried += 1
            live = np.arange(n)
            for t in range(1, len(entries)):
                live = live[low[live, t] <= root[live]]
                if not len(live):
                    break
                k = order[live, t]
                d = ((x[live] - entries[k]) ** 2).sum(axis=1)
                tried[live] += 1
                better = np.asarray((d < best[live]) | ((d == best[live]) & (k < code[live])), dtype=bool)
                at = live[better]
                best[at], code[at] = d[better], k[better]
                root[at] = _root(best[at])
            codes[:, j], far[:, j] = code, best
        return codes, far, tried


MEASURED = "id long, label string, v binary, near binary"


def _measure(batches, books: Codebooks, width: int, scale: float):
    """Whole-number vectors and their distances to the pivots, once for all rounds."""
    top = max(abs(x) for p in books.pivots for e in p for x in e)
    pivots = [Nearest._array(p) for p in books.pivots]
    for batch in slices(batches, 2048):
        m = _whole(_matrix(batch.column("v"), width), scale)
        x = _exact(m.reshape(len(m), books.parts, books.step), top, books.parts)
        near = np.zeros((len(m), books.parts, max(map(len, pivots))), dtype="<f4")
        for j, ps in enumerate(pivots):
            for p in range(len(ps)):
                with np.errstate(over="ignore"):
                    near[:, j, p] = _root(((x[:, j, :] - (ps[p] if x.dtype == object else ps[p].astype(np.int64))) ** 2).sum(axis=1))
        yield pa.record_batch([batch.column("id"), batch.column("label"), pa.array(_pack(m), pa.binary()),
                               pa.array([r.tobytes() for r in near], pa.binary())], ["id", "label", "v", "near"])


def _blocks(batches, books: Codebooks, width: int):
    for batch in slices(batches, 2048):
        if batch.num_rows:
            v = _unpack(batch.column("v").to_pylist(), width).reshape(batch.num_rows, books.parts, books.step)
            near = np.stack([np.frombuffer(r, "<f4") for r in batch.column("near").to_pylist()]).reshape(len(v), books.parts, -1)
            yield batch, v, near


def _sum_up(batches, books: Codebooks, width: int):
    """(part, entry, place, digit, s): a task's totals for every used entry, in digits of 60 bits."""
    nearest, size = Nearest(books), len(books.entries[0])
    total = np.zeros((books.parts, size, books.step + 1), dtype=object)      # last place: the count
    for _, v, near in _blocks(batches, books, width):
        codes, _, _ = nearest.of(v, near)
        x = _exact(v, nearest.top, books.parts)
        for j in range(books.parts):
            here = np.zeros((size, books.step + 1), dtype=object if x.dtype == object else np.int64)
            np.add.at(here[:, :-1], codes[:, j], x[:, j, :])
            here[:, -1] = np.bincount(codes[:, j], minlength=size)
            total[j] += here
    rows = []
    for j, k in np.argwhere(total[:, :, -1].astype(bool)):
        for i in range(books.step + 1):
            s = int(total[j, k, i])
            sign, rest, digit = (-1 if s < 0 else 1), abs(s), 0
            while rest:
                rows.append((int(j), int(k), i if i < books.step else -1, digit, sign * (rest & ((1 << DIGIT) - 1))))
                rest, digit = rest >> DIGIT, digit + 1
    names = ["part", "entry", "place", "digit", "s"]
    types = [pa.int32()] * 4 + [pa.int64()]
    yield pa.record_batch([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names)


def _encode(batches, books: Codebooks, width: int):
    nearest = Nearest(books)
    for batch, v, near in _blocks(batches, books, width):
        codes, far, tried = nearest.of(v, near)
        said = codes.astype(np.uint8).tobytes().hex()
        n = 2 * books.parts
        error = [int(e) for e in far.sum(axis=1)]
        yield pa.record_batch([batch.column("id"), batch.column("label"), pa.array([said[i:i + n] for i in range(0, len(said), n)], pa.string()),
                               pa.array([e if e < LONG else None for e in error], pa.int64()), pa.array(tried, pa.int64())],
                              ["id", "label", "code", "error", "evaluations"])


def compress(embeddings: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0, pivots: int = 4,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """(vec_id, code, error, label_error, evaluations) of every vector that takes
    part, and the final codebooks (none without rows). ``scale`` is a power of two."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is two hex digits: 1 to 256 entries")
    spark = embeddings.sparkSession
    ship_package(spark)
    v = F.col(vector_col)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float("inf")))
    kept = (embeddings.where(v.isNotNull() & good)
            .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), v.cast("array<double>").alias("v")))
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        out = spark.createDataFrame([], "vec_id long, code string, error long, label_error long, evaluations long")
        return out, None
    width = max(1, -(-longest // parts)) * parts
    first = kept.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    start = [[int(x) for x in _whole(np.array(list(r["v"]) + [0.0] * (width - len(r["v"]))), scale)] for r in first]
    books = Codebooks(start, parts, pivots)
    measured = stage(kept.mapInArrow(partial(_measure, books=books, width=width, scale=scale), MEASURED), "measured")
    for _ in range(rounds):
        got = (measured.mapInArrow(partial(_sum_up, books=books, width=width), "part int, entry int, place int, digit int, s long")
               .groupBy("part", "entry", "place", "digit").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
        sums: dict = {}
        for r in got:
            at = (r["part"], r["entry"], r["place"])
            sums[at] = sums.get(at, 0) + (int(r["s"]) << (DIGIT * r["digit"]))
        books.move(sums)
    coded = stage(measured.mapInArrow(partial(_encode, books=books, width=width), "id long, label string, code string, error long, evaluations long"),
                  "coded")
    unstage(measured)
    total = F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(38,0)")))
    per = coded.groupBy("label").agg(total.alias("t")).select(
        F.col("label").alias("of"), F.when(F.col("t") < F.lit(str(LONG)).cast("decimal(38,0)"), F.col("t").cast("long")).alias("label_error"))
    out = coded.join(per, F.col("label").eqNullSafe(F.col("of")))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "evaluations"), books
