"""Incremental prepare with Structured Streaming.

New instruction files are rendered, hashed and de-duplicated against
everything seen before (streaming ``dropDuplicates`` keeps one row per hash
in the state store), then appended to a parquet sink. The checkpoint makes
the job resumable: a re-run over the same files adds nothing.

Differences from batch, by nature of a stream: which copy of a duplicate
survives inside one micro-batch is not input-ordered (the kept hash set
equals batch); the state grows with the number of distinct texts - use the
RocksDB state store provider on a cluster - and an exact-size holdout is not
possible on an unbounded stream (use a rank threshold, see
:func:`rank_fraction_split`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.render import drop_blank, render, with_content_hash
from quire.sources.readers import documents_as_instructions

DOCUMENT_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prepare_stream(spark: SparkSession, source_dir: str, sink_path: str, checkpoint: str,
                   schema: str = DOCUMENT_SCHEMA, glob: str | None = None,
                   to_instructions: Callable[[DataFrame], DataFrame] = documents_as_instructions,
                   template: str = "plain", max_files_per_trigger: int | None = None,
                   wait: bool = True, event_time_col: str | None = None, watermark: str | None = None):
    """Run the incremental prepare with ``trigger(availableNow=True)``:
    process every file present now, in bounded micro-batches, then stop.

    Without an event time, dedupe state keeps every hash seen (exact across
    all history). With ``event_time_col`` and ``watermark`` the state is
    bounded: ``dropDuplicatesWithinWatermark`` forgets hashes older than the
    watermark (copies further apart than that are no longer caught)."""
    r = spark.readStream.schema(schema).format("parquet")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    # a pattern that matches this path alone: it may be one file or a folder of parts
    path = source_dir.rstrip("/")
    src = r.load(path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]")
    keep = ("row_id", event_time_col) if event_time_col else ("row_id",)
    rows = with_content_hash(drop_blank(render(to_instructions(src), template, keep=keep)))
    if event_time_col and watermark:
        dedup = rows.withWatermark(event_time_col, watermark).dropDuplicatesWithinWatermark(["content_hash"])
    else:
        dedup = rows.dropDuplicates(["content_hash"])
    q = (dedup.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint)
              .trigger(availableNow=True)
              .start(sink_path))
    if wait:
        q.awaitTermination()
    return q


def rank_fraction_split(df: DataFrame, eval_fraction: float, key: str = "split_rank") -> DataFrame:
    """Streaming holdout: a row is ``eval`` when its seeded rank falls in the
    first ``eval_fraction`` of the hash space. Stable for every row, but the
    eval size is a fraction, not an exact count."""
    cut = format(min(int(eval_fraction * (1 << 32)), (1 << 32) - 1), "08x")
    return df.withColumn("split", F.when(F.substring(F.col(key), 1, 8) < F.lit(cut), "eval").otherwise("train"))
