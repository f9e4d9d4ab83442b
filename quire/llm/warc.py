"""WARC archives of pages: a deterministic sharded writer and its reader.

Records are range-sorted by page id into shards whose cuts come from a hash
sample, so the same pages always give the same files. A shard is written as a
run of files, each closed once its compressed size reaches ``roll_bytes``; every
record is a gzip member of its own. Headers and digests are made anew. Of the
pages with one payload, the largest page id is a ``response``, the others are
``revisit`` records that name it and carry the HTTP header only.

Commit: a task writes files under names of its own attempt and reports them; Spark
commits the reports as a manifest; a second job gives the named files their final
names (repeatable after a lost task) and writes the final manifest. Readers follow
that manifest, so files of lost attempts are never seen.

Defined results: null html is an empty payload; null url is an empty target;
pages that repeat (id and payload) are one response and revisits of it, each record with
an id of its own; other columns are not read, whatever their names; a null
page id sorts first and is written without an id; an empty table gives no files.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections import Counter
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import (open_input, open_output, range_bucket, range_splits, rename, scratch_path, ship_package,
                              shuffle_parts, stage, temp_name)

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:quire:pages")
FILES = "shard int, seq int, temp string, file string, n_records long, n_bytes long, sha256 string"
RECORD = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
          "payload binary")


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page_id, payload_digest: str, copy: int = 0) -> str:
    """The name of a record; the ``copy``-th repetition of a page has one of its own."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}:{payload_digest}' + (f':{copy}' if copy else ''))}>"


def _line(value) -> str:
    """A header value: control characters would end the line, so they are percent-escaped."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(value or ""))


def record(page_id, url, payload: bytes, date: str, refers_to=None, refers_digest: str = "", copy: int = 0) -> bytes:
    """One WARC/1.1 record; ``refers_to`` (with the digest) makes it a revisit."""
    digest = digest32(payload)
    revisit = bool(refers_digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_uri(page_id, digest, copy)}", f"WARC-Date: {date}", f"WARC-Target-URI: {_line(url)}",
            "Content-Type: application/http; msgtype=response", f"WARC-Block-Digest: sha1:{digest32(block)}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_uri(refers_to, refers_digest)}"]
        head += [f"Refers-To-Page-ID: {refers_to}"] if refers_to is not None else []
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes, level: int) -> bytes:
    out = io.BytesIO()
    with gzip.GzipFile(filename="", mode="wb", fileobj=out, compresslevel=level, mtime=0) as z:
        z.write(data)
    return out.getvalue()


def decide(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, sha1, n_bytes, target): ``target`` is the largest page id of the
    same payload, for pages that are not it; only payloads seen twice are joined."""
    html = F.coalesce(F.col("html"), F.lit(""))
    narrow = stage(pages.select("page_id", F.sha1(html.cast("binary")).alias("sha1"),
                                F.octet_length(html).cast("long").alias("n_bytes")), "page_digests")
    best = (narrow.where(F.col("n_bytes") >= min_bytes).groupBy("sha1")
            .agg(F.max("page_id").alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    return (narrow.join(best, "sha1", "left")
            .where(F.col("best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("best")))
            .select("page_id", "sha1", F.col("best").alias("target")).distinct())


def _write_shards(batches, out: str, date: str, roll_bytes: int, level: int, min_bytes: int):
    shard, seq, sink, size, n, sha, names, rows = None, 0, None, 0, 0, None, None, []
    targets, at, seen = {}, object(), Counter()

    def close():
        nonlocal sink
        if sink is not None:
            sink.close()
            rows.append((shard, seq, *names, n, size, sha.hexdigest()))
            sink = None

    for pdf in batches:
        for bucket, kind, page, sha1, target, url, html in zip(*[pdf[c] for c in ("bucket", "kind", "page", "sha1", "target", "url", "html")]):
            if bucket != shard:
                close()
                shard, seq, targets, at = bucket, 0, {}, object()
            if page != at:                       # decisions about a page stand before its records
                targets, at, seen = {}, page, Counter()
            if kind == 0:
                targets[sha1] = target
                continue
            payload = (html or "").encode()
            digest = digest32(payload)
            page_id = None if page is None else int(page)
            refers, refers_digest = None, ""
            if sha1 in targets:
                refers, refers_digest = int(targets[sha1]), digest
            elif digest in seen and len(payload) >= min_bytes:   # the same page again
                refers, refers_digest = page_id, digest
            data = _gzip(record(page_id, url, payload, date, refers, refers_digest, seen[digest]), level)
            seen[digest] += 1
            if sink is not None and size + len(data) > roll_bytes:
                close()
                seq += 1
            if sink is None:
                final = f"{out}/pages-{shard:05d}-{seq:05d}.warc.gz"
                names = (temp_name(final), final)
                sink, size, n, sha = open_output(names[0]), 0, 0, hashlib.sha256()
            sink.write(data)
            sha.update(data)
            size, n = size + len(data), n + 1
    close()
    yield pd.DataFrame(rows, columns=["shard", "seq", "temp", "file", "n_records", "n_bytes", "sha256"])


def _commit(batches):
    for pdf in batches:
        for a, b in zip(pdf["temp"], pdf["file"]):
            rename(a, b)
        yield pdf


def write_warc(pages: DataFrame, out: str, date: str = "2024-01-01T00:00:00Z", roll_bytes: int = 64 << 20, level: int = 6,
               min_bytes: int = 0, shards: int | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html; others ignored) under ``out``; the committed
    manifest (shard, seq, file, n_records, n_bytes, sha256)."""
    spark = pages.sparkSession
    ship_package(spark)
    shards = shards or shuffle_parts(spark)
    cut = range_splits(pages, "page_id", shards)
    moved = decide(pages, min_bytes)
    page = F.col("page_id").cast("string").alias("page")     # nulls stay nulls in pandas
    html = F.coalesce(F.col("html"), F.lit(""))
    full = pages.select(range_bucket(F.col("page_id"), cut).alias("bucket"), F.lit(1).alias("kind"), "page_id", page,
                        F.sha1(html.cast("binary")).alias("sha1"), F.lit(None).cast("string").alias("target"), "url", "html")
    notes = moved.select(range_bucket(F.col("page_id"), cut).alias("bucket"), F.lit(0).alias("kind"), "page_id", page, "sha1",
                         F.col("target").cast("string").alias("target"), F.lit(None).cast("string").alias("url"),
                         F.lit(None).cast("string").alias("html"))
    rows = (full.unionByName(notes).repartitionById(shards, "bucket")            # one task a bucket
            .sortWithinPartitions("bucket", "page_id", "kind", "sha1", "url").drop("page_id"))
    made = rows.mapInPandas(partial(_write_shards, out=out, date=date, roll_bytes=roll_bytes, level=level,
                                    min_bytes=min_bytes), FILES)
    made.write.mode("error").parquet(f"{out}/_attempts")
    made = spark.read.parquet(f"{out}/_attempts")
    named = made.repartition(max(1, min(shards, made.count())), "shard", "seq").mapInPandas(_commit, FILES)
    named.drop("temp").write.mode("error").parquet(f"{out}/_manifest")
    return spark.read.parquet(f"{out}/_manifest")


class _Members:
    """The gzip members of a file, one at a time; memory: one record."""

    def __init__(self, f, step: int = 1 << 20):
        self.f, self.step = f, step

    def __iter__(self):
        raw = b""
        while raw := raw or self.f.read(self.step):
            z, out = zlib.decompressobj(31), []
            while not z.eof:
                out.append(z.decompress(raw))
                raw = z.unused_data if z.eof else self.f.read(self.step)
                if not z.eof and not raw:
                    raise ValueError("the file ends inside a record")
            yield b"".join(out)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(WARC headers, HTTP header, payload); digests are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != "sha1:" + digest32(block):
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    if fields["WARC-Type"] == "response" and fields["WARC-Payload-Digest"] != "sha1:" + digest32(payload):
        raise ValueError(f"damaged payload {fields.get('WARC-Record-ID')}")
    return fields, http, payload


def _read_files(batches, payloads: bool):
    for pdf in batches:
        for name in pdf["file"]:
            rows = []
            with open_input(name) as f:
                for data in _Members(f):
                    h, http, payload = parse_record(data)
                    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    to = h.get("Refers-To-Page-ID")
                    rows.append((h.get("Page-ID"), h["WARC-Target-URI"], h["WARC-Type"], length, digest, to,
                                 payload if payloads and h["WARC-Type"] == "response" else None))
                    if len(rows) >= 256:
                        yield _frame(rows)
                        rows = []
            yield _frame(rows)


def _frame(rows) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"])
    for c in ("page_id", "refers_to"):
        out[c] = pd.array([None if x is None else int(x) for x in out[c]], dtype="Int64")
    return out


def read_warc(spark: SparkSession, manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of all files of a manifest, digests checked."""
    ship_package(spark)
    n = max(1, min(shuffle_parts(spark), manifest.count()))
    return manifest.select("file").repartition(n, "file").mapInPandas(partial(_read_files, payloads=payloads), RECORD)


def roundtrip(pages: DataFrame, out: str | None = None, **options) -> DataFrame:
    """Write ``pages`` and read the archives back, without payloads."""
    spark = pages.sparkSession
    return read_warc(spark, write_warc(pages, out or scratch_path(spark, "warc"), **options)).drop("payload")
