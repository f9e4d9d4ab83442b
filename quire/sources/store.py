"""Sinks and stores: versioned split publishing with a manifest commit marker,
loading, snapshots, size reports (S4-S10).

Layout of a prepared dataset::

    <root>/<fingerprint>/v<k>/data/split=train/...   parquet
    <root>/<fingerprint>/v<k>/data/split=eval/...
    <root>/<fingerprint>/v<k>/manifest.json           written last = commit

A version counts only once its manifest exists, so a crashed or concurrent
writer never exposes a half-written split; ``force`` writes a new version
instead of overwriting in place.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from functools import partial
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.session import ship_package

COPY_BLOCK = 8 << 20        # bytes a copying task holds
COPY_TASKS = 1000           # files are dealt to at most so many copying tasks

MANIFEST = "manifest.json"  # not "_"-prefixed: Spark skips such files on read


# --- Hadoop FileSystem access (works for local, HDFS, object stores) --------
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def listing(spark: SparkSession, folders: list[str], glob: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of every file below ``folders``. The engine
    lists many folders in tasks; contents are never read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(folders).select("path", "length", "modificationTime")


def _plain(path: str) -> str:
    """One spelling of a path: ``file:`` with one slash."""
    return re.sub(r"^file:/+", "file:/", path)


def files_digest(spark: SparkSession, files: list[str]) -> str:
    """Identity of a set of files: paths, lengths and times folded into one row by
    the listing of their folders (of the file, where a folder gives one alone). Files
    in these folders that are not in the set are joined away; where names in the listing
    differ from those given, everything listed counts."""
    by_folder: dict[str, list[str]] = {}
    for f in {unquote(f) for f in files}:
        by_folder.setdefault(f.rsplit("/", 1)[0], []).append(f)
    n = sum(map(len, by_folder.values()))
    seen = listing(spark, [fs[0] if len(fs) == 1 else folder for folder, fs in sorted(by_folder.items())])
    fold = [F.count(F.lit(1)), F.sum("length"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")),
            F.bit_xor(F.xxhash64(F.lit(1), "modificationTime", "length", "path"))]
    got = seen.agg(*fold).first()
    if got[0] > n:
        mine = spark.createDataFrame([(_plain(f),) for fs in by_folder.values() for f in fs], "path string")
        own = seen.join(mine, "path", "left_semi").agg(*fold).first()
        got = own if own[0] == n else got
    return hashlib.sha256(json.dumps([str(x) for x in got]).encode()).hexdigest()


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file (manifests, reports) through the Hadoop FS."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """Read one small file (manifest) through the Hadoop FS, without a job."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        data = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")


# --- versioned publish (S4-S6) ----------------------------------------------
def _versions(spark: SparkSession, base: str) -> list[int]:
    vs = [int(m.group(1)) for d in list_dirs(spark, base) if (m := re.fullmatch(r"v(\d+)", d))]
    return sorted(vs)


def latest_complete(spark: SparkSession, base: str) -> str | None:
    """Newest version (numeric order) whose manifest exists."""
    for v in reversed(_versions(spark, base)):
        if exists(spark, f"{base}/v{v}/{MANIFEST}"):
            return f"{base}/v{v}"
    return None


def cache_exists(spark: SparkSession, base: str) -> bool:
    """A complete version exists (train, eval and manifest)."""
    return latest_complete(spark, base) is not None


def publish_splits(splits: DataFrame, manifest_fn, base: str) -> tuple[str, dict]:
    """Write ``splits`` partitioned by ``split`` into a fresh version,
    compute the manifest from the written files, write the manifest last."""
    spark = splits.sparkSession
    vs = _versions(spark, base)
    vdir = f"{base}/v{(vs[-1] + 1) if vs else 1}"
    splits.write.mode("error").partitionBy("split").parquet(f"{vdir}/data")
    published = spark.read.schema(splits.schema).parquet(f"{vdir}/data")      # a split without rows has no files
    manifest = {**manifest_fn(published), "schema": json.loads(splits.schema.json())}
    write_text(spark, f"{vdir}/{MANIFEST}", json.dumps(manifest, indent=2))
    return vdir, manifest


def read_manifest(spark: SparkSession, vdir: str) -> dict:
    return json.loads(read_text(spark, f"{vdir}/{MANIFEST}"))


def load_split_data(spark: SparkSession, vdir: str) -> tuple[DataFrame, DataFrame]:
    """(train, eval) of a published version; partition pruning keeps
    each side's scan to its own directory."""
    schema = read_manifest(spark, vdir).get("schema")
    d = (spark.read.schema(StructType.fromJson(schema)) if schema else spark.read).parquet(f"{vdir}/data")
    return d.filter(F.col("split") == "train"), d.filter(F.col("split") == "eval")


# --- reports (S7) ----------------------------------------------------------
def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Result frames (metrics, sweep results) as a JSON/CSV file set; the engine
    sizes the files, so a large frame is not one task."""
    df.hint("rebalance").write.mode("overwrite").format(fmt).save(path)


# --- snapshots (S8, S9) ----------------------------------------------------
def _file_system(path: str):
    """The file system of a path for the use of a task, and the path in it."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)


def _copy(batches, target: str):
    """Files byte by byte: under a name of the attempt first (hidden from readers), its
    length checked, then renamed. A repeated task writes the same files again."""
    from pyarrow import fs
    for rows in batches:
        done = []
        for path, length, inner in zip(rows["path"], rows["length"], rows["inner"]):
            src, a = _file_system(path)
            dst, b = _file_system(f"{target}/{inner}")
            folder, name = b.rsplit("/", 1)
            part = f"{folder}/.{name}.{uuid.uuid4().hex[:12]}"
            dst.create_dir(folder, recursive=True)
            n = 0
            with src.open_input_stream(a, compression=None) as i, dst.open_output_stream(part, compression=None) as o:
                while block := i.read(COPY_BLOCK):
                    n += o.write(block)
            if n != length or dst.get_file_info(part).size != length:
                raise IOError(f"{path}: {n} of {length} bytes copied")
            if dst.get_file_info(b).type != fs.FileType.NotFound:
                dst.delete_file(b)
            dst.move(part, b)
            done.append((inner, n))
        yield pd.DataFrame(done, columns=["inner", "bytes"])


def copy_files(spark: SparkSession, source: str, target: str) -> int:
    """Every data file below ``source`` to the same place below ``target``, as it is,
    by tasks; the number of files. What was below ``target`` is removed first."""
    ship_package(spark)
    fs, p = _fs(spark, source)
    root = fs.makeQualified(p).toString()
    tfs, t = _fs(spark, target)
    tfs.delete(t, True)
    tfs.mkdirs(t)
    target = tfs.makeQualified(t).toString()
    files = listing(spark, [root]).select("path", "length", F.expr(f"substring(path, {len(root) + 2})").alias("inner"))
    n, total = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    if n:
        parts = max(1, min(n, COPY_TASKS))
        got = (files.repartition(parts).mapInPandas(partial(_copy, target=target), "inner string, bytes long")
               .agg(F.count(F.lit(1)), F.sum("bytes")).first())
        if tuple(got) != (n, total):
            raise IOError(f"{got[0]} files, {got[1]} bytes copied of {n} files, {total} bytes")
    return n


def _copy_published(spark: SparkSession, source: str, target: str) -> None:
    """The data files, then the manifest, which makes the copy count."""
    copy_files(spark, f"{source}/data", f"{target}/data")
    write_text(spark, f"{target}/{MANIFEST}", read_text(spark, f"{source}/{MANIFEST}"))


def snapshot(spark: SparkSession, vdir: str, dest_root: str, number: int) -> str | None:
    """Copy a published version, file by file, to ``dest_root/snapshot=<number>``.

    No-op without a manifest. A number that already holds a complete snapshot
    raises; what an interrupted copy left is removed. The manifest is
    copied last and is the commit.
    """
    if not exists(spark, f"{vdir}/{MANIFEST}"):
        return None
    target = f"{dest_root}/snapshot={int(number)}"
    if exists(spark, f"{target}/{MANIFEST}"):
        raise FileExistsError(f"{target} is a complete snapshot")
    _copy_published(spark, vdir, target)
    return target


def restore(spark: SparkSession, snapshot_dir: str, vdir: str) -> bool:
    """Bring a snapshot back, file by file; no-op when the target already has a
    manifest or the snapshot is missing/incomplete."""
    if exists(spark, f"{vdir}/{MANIFEST}") or not exists(spark, f"{snapshot_dir}/{MANIFEST}"):
        return False
    _copy_published(spark, snapshot_dir, vdir)
    return True


def latest_snapshot(spark: SparkSession, root: str) -> int | None:
    """The highest complete ``snapshot=<N>`` by numeric value (9 < 10)."""
    nums = [int(m.group(1)) for d in list_dirs(spark, root) if (m := re.fullmatch(r"snapshot=(\d+)", d))]
    for n in sorted(nums, reverse=True):
        if exists(spark, f"{root}/snapshot={n}/{MANIFEST}"):
            return n
    return None


def latest_snapshot_path(spark: SparkSession, root: str) -> str | None:
    """The folder of the newest complete snapshot (``None`` when none)."""
    n = latest_snapshot(spark, root)
    return None if n is None else f"{root}/snapshot={n}"


def load_snapshot(spark: SparkSession, root: str, number: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, eval) of snapshot ``number`` (default: the newest complete one)."""
    n = latest_snapshot(spark, root) if number is None else int(number)
    if n is None or not exists(spark, f"{root}/snapshot={n}/{MANIFEST}"):
        raise FileNotFoundError(f"no complete snapshot under {root}")
    return load_split_data(spark, f"{root}/snapshot={n}")


# --- size report (S10) -----------------------------------------------------
def size_report(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Recursive byte total of a folder: ``files, bytes, mb`` (MB = bytes /
    2**20 rounded to 2). The binaryFile scan reads only the ``length``
    column, never the file contents."""
    files = listing(spark, [path], glob)
    return files.agg(F.count(F.lit(1)).alias("files"),
                     F.sum("length").cast("long").alias("bytes")) \
                .withColumn("mb", F.round(F.col("bytes") / F.lit(1 << 20), 2))


def compression_ratio(a_bytes: float, b_bytes: float) -> float:
    """``round(a / b, 2)``."""
    return round(a_bytes / b_bytes, 2)
