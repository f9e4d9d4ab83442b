"""Helpers shared by the operators: tables, binary files, range buckets,
running totals over a whole table, connected components, membership bitmaps."""

from __future__ import annotations

import ctypes
import functools
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.session import scratch_path, ship_package, stage, unstage

__all__ = ["BitMap", "bitmap_of", "components", "free_name", "frees_memory", "open_input", "open_output", "range_bucket", "range_splits", "rename",
           "running_totals", "scratch_path", "ship_package", "shuffle_parts", "slices", "stage", "table", "unstage"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- binary files on the shared store -------------------------------------------
def _file_system(path: str):
    """File system and inner path of a URI or plain path (``file:``, ``hdfs://``, ``s3://``, ...)."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def open_output(path: str):
    """A new binary file at ``path``; parent folders are made where the store has any."""
    f, p = _file_system(path)
    f.create_dir(p.rsplit("/", 1)[0], recursive=True)
    return f.open_output_stream(p, compression=None)


def open_input(path: str):
    f, p = _file_system(path)
    return f.open_input_file(p)


def rename(old: str, new: str) -> None:
    """Give a finished file its final name. Repeating it after a lost task is
    harmless: when ``old`` is gone, ``new`` must be there."""
    from pyarrow import fs
    f, a = _file_system(old)
    _, b = _file_system(new)
    if f.get_file_info(a).type == fs.FileType.NotFound:
        if f.get_file_info(b).type == fs.FileType.NotFound:
            raise FileNotFoundError(old)
        return
    f.move(a, b)


def temp_name(final: str) -> str:
    """A name no other attempt of the same task uses."""
    return f"{final}.{uuid.uuid4().hex[:12]}.tmp"


# --- ranges and running totals ----------------------------------------------------
def range_splits(df: DataFrame, col: str, parts: int, sample: int = 20_000) -> list:
    """At most ``parts - 1`` ascending cut points of ``col``, about evenly apart.

    The sample is chosen by a hash of the value, so the same table gives the
    same cuts on every run; about ``sample`` distinct values reach the driver.
    """
    step = max(1, df.count() // sample)
    got = (df.where(F.col(col).isNotNull()).select(F.col(col).alias("v"))
             .where(F.pmod(F.xxhash64("v"), F.lit(step)) == 0).distinct().collect())
    v = sorted(r[0] for r in got)
    return sorted({v[len(v) * i // parts] for i in range(1, parts)}) if v else []


def range_bucket(col: Column, splits: list) -> Column:
    """Number of cut points not above ``col`` (null: 0), as a balanced tree of comparisons."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(col >= F.lit(splits[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))
    return F.when(col.isNull(), F.lit(0)).otherwise(tree(0, len(splits))).cast("int")


def running_totals(df: DataFrame, order: list[Column], sums: dict[str, str], name: str = "totals") -> DataFrame:
    """``df`` with a global row number ``rn`` (from 1) in ``order`` and, for each
    ``new: column`` of ``sums``, the total up to and including the row.

    Rows are range-dealt and staged with their partition's number; only one row
    a partition is ever looked at in one place. ``order`` must be total up to
    rows that are the same.
    """
    spark = df.sparkSession
    parts = shuffle_parts(spark)
    dealt = stage(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), name)
    per = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_s_{k}") for k, c in sums.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
                      *[F.coalesce(F.sum(f"_s_{k}").over(before), F.lit(0)).alias(f"_s_{k}") for k in sums])
    w = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = dealt.select("*", F.row_number().over(Window.partitionBy("_part").orderBy(*order)).alias("_rn"),
                       *[F.sum(c).over(w).alias(f"_w_{k}") for k, c in sums.items()])
    return (out.join(F.broadcast(base), "_part")      # one row a partition
            .select(*[F.col(c) for c in df.columns], (F.col("_rn") + F.col("_n")).cast("long").alias("rn"),
                    *[(F.col(f"_w_{k}") + F.col(f"_s_{k}")).alias(k) for k in sums]))


# --- connected components ------------------------------------------------------------
def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable over undirected ``edges``, for
    every node of an edge that is not itself a root, and for the roots.

    Alternates large-star and small-star steps (joins and combinable minima, no
    neighbour lists) until nothing changes; every round is a written table, so
    lineage stays short and lost executors re-read it.
    """
    cur = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                .where(F.col("u") != F.col("v")).distinct(), "edges")

    def sign(df):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    last = sign(cur)
    for _ in range(rounds):
        if not last[0]:
            break
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        before, cur = cur, stage(small.select("e.u", "e.v").where("u != v").distinct(), "edges")
        now = sign(cur)
        unstage(before)                         # the last round is all that is read again
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components: not settled after {rounds} rounds")
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


# --- membership bitmap -----------------------------------------------------------------
class BitMap:
    """A fixed-size bitmap over hash values: never misses a member, may admit
    others. Its size does not depend on the number of members."""

    def __init__(self, words: np.ndarray, bits: int):
        self.bits, self.raw = bits, words.view(np.uint8)

    def admits(self, hashes: np.ndarray) -> np.ndarray:
        h = hashes & ((1 << self.bits) - 1)
        return (self.raw[h >> 3] >> (h & 7).astype(np.uint8)) & 1 == 1


def bitmap_of(df: DataFrame, hash_col: str, bits: int = 23) -> BitMap:
    """Bitmap of the low ``bits`` bits of a long column: at most ``2**bits / 64``
    words reach the driver, however many rows there are."""
    low = F.col(hash_col).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (df.select(F.shiftright(low, 6).alias("w"), low.bitwiseAND(F.lit(63)).cast("int").alias("b"))
            .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("x")).collect())
    words = np.zeros(1 << (bits - 6), dtype=np.int64)
    for w, x in rows:
        words[w] = x
    return BitMap(words, bits)


def free_name(taken, name: str) -> str:
    """``name``, or ``name`` with as many underscores as make it differ from the columns ``taken``."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def frees_memory(f):
    """For a task's generator: when it ends, what it held goes back to the machine - the
    worker goes on to tasks of other operators and would keep it."""
    @functools.wraps(f)
    def run(*args, **kwargs):
        try:
            yield from f(*args, **kwargs)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)        # glibc
            if trim is not None:
                trim(0)
    return run


def slices(batches: Iterator, rows: int = 256):
    """Short stretches of Arrow batches: the texts of one stretch are all that is
    unpacked in Python at a time, however long a batch is."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
