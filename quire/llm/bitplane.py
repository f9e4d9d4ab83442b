"""Token ids in bit-plane shuffled files.

A shard holds the ids of its documents, in ascending document order, in blocks
of a fixed number of ids. A block is transposed into planes (one a byte or one a
bit of the 32-bit ids), every plane is compressed with zstandard on its own, and
planes of zeros take no room. Behind the blocks stand the document table (id,
first id, number of ids) and the chunk index (place and plane lengths of every
block), so any block or document can be read alone.

File: ``b"QBP1"``, blocks, document table (zstandard, three int64 columns in a
row, nulls of the id column as a fourth of bytes), chunk index (uint64 file
offset, uint32 ids, uint32 length per plane), footer (struct ``<QQQQIIIB3x``,
then ``b"QBPE"``).

Shards come from a range partitioning by document id. A task writes under a name
of its own attempt and reports it in a manifest, which Spark commits; files of
lost attempts are in no manifest. Defined results: null text is empty and has
the end id alone; documents with the same id stand next to each other, ordered by
a hash of their text; a null id comes first; other columns are not read, whatever
their names; an empty table gives no files.
"""

from __future__ import annotations

import struct
import zlib
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import open_input, open_output, frees_memory, scratch_path, ship_package, shuffle_parts, slices, temp_name
from quire.llm.tokens import END_ID, default_vocabulary, encoder

MAGIC, TAIL = b"QBP1", b"QBPE"
FOOTER = struct.Struct("<QQQQIIIB3x")
MANIFEST = "shard int, file string, n_docs long, n_ids long, n_bytes long"
_MANIFEST = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())])


def split_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """Planes of uint32 ids, lowest first; ``unit`` is ``byte`` or ``bit``."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if unit == "byte":
        return [p.tobytes() for p in ids.view(np.uint8).reshape(-1, 4).T]
    return [np.packbits((ids >> np.uint32(b)).astype(np.uint8) & 1).tobytes() for b in range(32)]


def join_planes(planes: list[bytes | None], n: int, unit: str) -> np.ndarray:
    """Inverse of :func:`split_planes`; ``None`` is a plane of zeros."""
    if unit == "byte":
        out = np.zeros((n, 4), dtype=np.uint8)
        for k, p in enumerate(planes):
            if p is not None:
                out[:, k] = np.frombuffer(p, np.uint8)
        return out.reshape(-1).view("<u4")
    out = np.zeros(n, dtype="<u4")
    for k, p in enumerate(planes):
        if p is not None:
            out |= np.unpackbits(np.frombuffer(p, np.uint8), count=n).astype("<u4") << np.uint32(k)
    return out


class ShardWriter:
    """Appends documents' ids; memory: one block and the document table."""

    def __init__(self, out, unit: str = "byte", block: int = 65_536, level: int = 3):
        self.out, self.unit, self.block = out, unit, block
        self.zip = zstandard.ZstdCompressor(level=level)
        self.pending, self.pending_bytes, self.at, self.n_ids = [], 0, len(MAGIC), 0
        self.index, self.docs = [], []
        out.write(MAGIC)

    def add(self, doc_id, ids: bytes) -> None:
        self.docs.append((doc_id, self.n_ids, len(ids) // 4))
        self.n_ids += len(ids) // 4
        self.pending.append(ids)
        self.pending_bytes += len(ids)
        if self.pending_bytes >= 4 * self.block:
            data, size = b"".join(self.pending), 4 * self.block
            full = len(data) // size * size
            for i in range(0, full, size):
                self._write(data[i:i + size])
            self.pending, self.pending_bytes = [data[full:]], len(data) - full

    def _write(self, data: bytes) -> None:
        planes = [self.zip.compress(p) if p.strip(b"\0") else b"" for p in split_planes(np.frombuffer(data, "<u4"), self.unit)]
        self.index.append((self.at, len(data) // 4, [len(p) for p in planes]))
        for p in planes:
            self.out.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.pending_bytes:
            self._write(b"".join(self.pending))
        cols = [np.array([d[k] or 0 for d in self.docs], dtype="<i8").tobytes() for k in range(3)]
        nulls = bytes(d[0] is None for d in self.docs)
        table = self.zip.compress(b"".join(cols) + nulls)
        index = b"".join(struct.pack(f"<QI{len(p)}I", at, n, *p) for at, n, p in self.index)
        self.out.write(table + index)
        self.out.write(FOOTER.pack(self.at, len(table), len(index), self.n_ids, len(self.docs), len(self.index), self.block,
                                   0 if self.unit == "byte" else 1) + TAIL)
        self.at += len(table) + len(index) + FOOTER.size + len(TAIL)
        self.out.close()


class ShardReader:
    """Document table, chunk index and blocks of one shard file."""

    def __init__(self, f):
        self.f = f
        size = f.size()
        f.seek(size - FOOTER.size - len(TAIL))
        raw = f.read(FOOTER.size + len(TAIL))
        if raw[-len(TAIL):] != TAIL:
            raise ValueError("not a finished shard file")
        at, n_table, n_index, self.n_ids, n_docs, n_chunks, self.block, bit = FOOTER.unpack(raw[:-len(TAIL)])
        self.unit = "bit" if bit else "byte"
        f.seek(at)
        self.unzip = zstandard.ZstdDecompressor()
        table = self.unzip.decompress(f.read(n_table))
        cols = np.frombuffer(table, "<i8", count=3 * n_docs).reshape(3, n_docs)
        null = np.frombuffer(table, np.uint8, offset=24 * n_docs)
        self.doc_ids = [None if z else int(x) for x, z in zip(cols[0], null)]
        self.starts, self.lengths = cols[1], cols[2]
        index = f.read(n_index)
        step = n_index // n_chunks if n_chunks else 0
        fmt = f"<QI{(step - 12) // 4}I"
        self.chunks = [(r[0], r[1], r[2:]) for r in (struct.unpack_from(fmt, index, i * step) for i in range(n_chunks))]

    def chunk(self, k: int) -> np.ndarray:
        at, n, sizes = self.chunks[k]
        self.f.seek(at)
        raw = self.f.read(sum(sizes))
        planes, i = [], 0
        for s in sizes:
            planes.append(self.unzip.decompress(raw[i:i + s]) if s else None)
            i += s
        return join_planes(planes, n, self.unit)

    def documents(self):
        """(id, first id, pieces of ids as bytes) in order; one block in memory."""
        k, data, base = -1, b"", 0
        for doc, start, n in zip(self.doc_ids, self.starts.tolist(), self.lengths.tolist()):
            pieces, at = [], start
            while at < start + n:
                if k < 0 or at >= base + len(data) // 4:
                    base += len(data) // 4
                    k += 1
                    data = self.chunk(k).tobytes()
                    continue
                stop = min(start + n, base + len(data) // 4)
                pieces.append(data[4 * (at - base):4 * (stop - base)])
                at = stop
            yield doc, start, n, pieces


@frees_memory
def _write_shard(batches, out: str, vocabulary: str, unit: str, block: int, level: int):
    enc, end = encoder(vocabulary), np.array([END_ID], dtype="<u4").tobytes()
    shard, w, name = TaskContext.get().partitionId(), None, None
    for batch in slices(batches):
        for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            if w is None:
                name = temp_name(f"{out}/shard-{shard:06d}.qbp")
                w = ShardWriter(open_output(name), unit, block, level)
            w.add(doc, enc.ids(text) + end)
    enc.forget()
    if w is not None:
        w.close()
        yield pa.RecordBatch.from_pylist([{"shard": shard, "file": name, "n_docs": len(w.docs), "n_ids": w.n_ids, "n_bytes": w.at}], _MANIFEST)


def write_ids(docs: DataFrame, out: str, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text",
              unit: str = "byte", block: int = 65_536, level: int = 3, parts: int | None = None) -> DataFrame:
    """Encode every text, append the end id and write shards under ``out``; the
    committed manifest (shard, file, n_docs, n_ids, n_bytes), one row a shard."""
    spark = docs.sparkSession
    ship_package(spark)
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    d = (d.repartitionByRange(parts or shuffle_parts(spark), "id").withColumn("tie", F.xxhash64("text"))
          .sortWithinPartitions("id", "tie", "text").select("id", "text"))
    rows = d.mapInArrow(partial(_write_shard, out=out, vocabulary=vocabulary or default_vocabulary(), unit=unit,
                                 block=block, level=level), MANIFEST)
    path = f"{out}/_manifest"
    rows.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def _read_shard(batches):
    for pdf in batches:
        for name, first in zip(pdf["file"], pdf["first"]):
            with open_input(name) as f:
                rows = []
                for doc, start, n, pieces in ShardReader(f).documents():
                    crc = 0
                    for p in pieces:
                        crc = zlib.crc32(p, crc)
                    rows.append((doc, first + start, n, crc))
                    if len(rows) >= 10_000:
                        yield _read_frame(rows)
                        rows = []
                yield _read_frame(rows)


def _read_frame(rows) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["id", "start", "n_tokens", "ids_crc32"])
    out["id"] = out["id"].astype("Int64")
    return out


def read_documents(spark: SparkSession, manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, decoded from the shards;
    ``start`` counts the ids of all documents before it. One row a shard of the
    manifest is summed in order on the driver."""
    ship_package(spark)
    files, first = [], 0
    for r in manifest.orderBy("shard").collect():
        files.append((r["file"], first))
        first += r["n_ids"]
    schema = "file string, first long"
    todo = spark.createDataFrame(files, schema).repartition(max(1, len(files)), "file")
    return todo.mapInPandas(_read_shard, "id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)


def roundtrip(docs: DataFrame, out: str | None = None, **options) -> DataFrame:
    """Write the ids of ``docs`` and read them back."""
    spark = docs.sparkSession
    out = out or scratch_path(spark, "token-ids")
    return read_documents(spark, write_ids(docs, out, **options), options.get("id_col", "doc_id"))
