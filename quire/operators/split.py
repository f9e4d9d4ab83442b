"""Exact, seeded, order-free splits.

The shuffle order is ``split_rank = sha256("{seed}:{content_hash}")``: a total
order that depends on content and seed only. The key at a position is found
without a global sort: hex-prefix buckets (at most 16**4 groups a wanted key,
map-side combined) carry their count, smallest and largest key. A position that
is the first or last of its bucket, or whose bucket holds one key, is found; the
buckets of all others are refined together by the next prefix. Each level is one
narrow aggregation over a single column for all positions at once.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.text import seeded_rank

PREFIX_WIDTH = 4          # hex characters per refinement level (65,536 buckets)


def split_sizes(n: int, holdout: int, size: int) -> tuple[int, int]:
    """D3/D4 sizes: ``eval_n = min(holdout, max(1, n // 5))`` taken first,
    then ``train_n = min(size, rest)``; both bounded by the rows present."""
    eval_n = min(max(holdout, 0), max(1, n // 5), n)
    train_n = min(max(size, 0), n - eval_n)
    return eval_n, train_n


def bucket_stats(df: DataFrame, key: str, prefixes: list[str], width: int = PREFIX_WIDTH) -> list[tuple[str, int, str, str]]:
    """(bucket, rows, smallest key, largest key) in order, for the next-level hex
    buckets below ``prefixes`` (all of one length): one aggregation, at most
    ``16**width`` rows a prefix."""
    plen = len(prefixes[0]) + width
    sub = df
    if prefixes[0]:
        below = F.lit(False)
        for p in prefixes:
            below = below | F.col(key).startswith(p)
        sub = df.filter(below)
    rows = sub.groupBy(F.substring(key, 1, plen).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
    return sorted((r["b"], r["n"], r["lo"], r["hi"]) for r in rows if r["b"] is not None)


def keys_at_positions(df: DataFrame, key: str, positions, width: int = PREFIX_WIDTH,
                      top: list[tuple[str, int, str, str]] | None = None) -> dict[int, str | None]:
    """The key at each 1-based position of the ascending order of ``key``.

    ``key`` is hex and may repeat; rows without a key have no position. Exact;
    the driver never holds more than ``16**width`` buckets a position. ``top``
    are the buckets of the whole table where they are known already.
    """
    wanted = sorted({int(p) for p in positions if p and p >= 1})
    result: dict[int, str | None] = {p: None for p in wanted}
    pending = [("", 0, wanted)] if wanted else []
    while pending:
        prefixes = [p for p, _, _ in pending]
        stats = top if prefixes == [""] and top is not None else bucket_stats(df, key, prefixes, width)
        deeper = []
        for prefix, before, poss in pending:
            for b, n, lo, hi in stats:
                if not b.startswith(prefix):
                    continue
                inside = [p for p in poss if before < p <= before + n]
                result.update({p: lo for p in inside if p == before + 1 or lo == hi})
                result.update({p: hi for p in inside if p == before + n})
                left = [p for p in inside if result[p] is None]
                if left:
                    deeper.append((b, before, left))
                before += n
        pending = deeper
    return result


def find_cut(df: DataFrame, holdout: int, size: int, key: str = "split_rank") -> dict:
    """D3 + D4: the number of keys, the sizes of both sides and the last key of each
    (``None`` for an empty side), from one pass over the keys and the refinement
    of the two positions."""
    top = bucket_stats(df, key, [""])
    n = sum(b[1] for b in top)
    eval_n, train_n = split_sizes(n, holdout, size)
    cuts = keys_at_positions(df, key, [eval_n, eval_n + train_n], top=top)
    return {"n": n, "eval_n": eval_n, "train_n": train_n, "cut_eval": cuts.get(eval_n) if eval_n else None,
            "cut_train": cuts.get(eval_n + train_n) if train_n else None}


def label_split(df: DataFrame, info: dict, key: str = "split_rank") -> DataFrame:
    """The rows up to the last key of :func:`find_cut`, labelled ``eval`` or ``train``:
    a plain range filter (pushed to the parquet scan) and a comparison."""
    cut1, cut2 = info["cut_eval"], info["cut_train"]
    last = cut2 if cut2 is not None else cut1
    if last is None:
        return df.filter(F.lit(False)).withColumn("split", F.lit(None).cast("string"))
    k = F.col(key)
    label = F.lit("train") if cut1 is None else F.when(k <= F.lit(cut1), F.lit("eval")).otherwise(F.lit("train"))
    return df.filter(k <= F.lit(last)).withColumn("split", label)


def cut_split(df: DataFrame, holdout: int, size: int, key: str = "split_rank") -> tuple[DataFrame, dict]:
    """D3 + D4: label rows ``eval`` (first ``eval_n`` keys) and ``train``
    (next ``train_n`` keys); the rest is dropped. Returns the labelled frame
    and the sizes and cut keys."""
    info = find_cut(df, holdout, size, key)
    return label_split(df, info, key), info


def order_columns(df: DataFrame, key: str = "split_rank", tie: str = "content_hash") -> list[str]:
    """The total order of a split: its rank, then the content hash where answers share a rank."""
    return [key] + [c for c in (tie,) if c in df.columns and c != key]


def take_first(df: DataFrame, n: int, order_col: str = "split_rank") -> DataFrame:
    """First ``min(len, n)`` rows in split order (TakeOrderedAndProject)."""
    return df.orderBy(*order_columns(df, order_col)).limit(int(n))


def with_positions(df: DataFrame, key: str = "split_rank", pos_col: str = "pos",
                   width: int = PREFIX_WIDTH, tie_width: int = 2) -> DataFrame:
    """Exact 0-based global position in split order without a global sort.

    Two levels of prefix sums: the rows of a cell (one key, one prefix of the
    tie column) are counted, cells are summed in order within their key-prefix
    bucket, and buckets - at most ``16**width`` rows - over the whole. A key
    held by many rows is spread over ``16**tie_width`` cells. Offsets are
    joined as data; nothing of them passes through the driver.
    """
    order = order_columns(df, key)
    cell = F.substring(order[1], 1, tie_width) if len(order) > 1 else F.lit("")
    d = df.withColumn("_cell", cell)
    cells = d.groupBy(key, "_cell").agg(F.count(F.lit(1)).alias("_n")).withColumn("_b", F.substring(key, 1, width))
    buckets = cells.groupBy("_b").agg(F.sum("_n").alias("_n"))
    buckets = buckets.select("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("_b").orderBy(key, "_cell").rowsBetween(Window.unboundedPreceding, -1)
    offs = (cells.withColumn("_off", F.coalesce(F.sum("_n").over(inner), F.lit(0))).join(buckets, "_b")
            .select(F.col(key).alias("_k"), F.col("_cell").alias("_c"), (F.col("_base") + F.col("_off")).alias("_off")))
    w = Window.partitionBy(key, "_cell").orderBy(*order)
    return (d.withColumn("_rn", F.row_number().over(w))
             .join(offs, (F.col(key) == F.col("_k")) & (F.col("_cell") == F.col("_c")))
             .withColumn(pos_col, (F.col("_off") + F.col("_rn") - 1).cast("long"))
             .drop("_cell", "_rn", "_k", "_c", "_off"))


def batch_plan(df: DataFrame, batch_size: int = 8, grad_accum: int = 4, epochs: int = 1,
               max_steps: int = -1, key: str = "split_rank") -> tuple[DataFrame, dict]:
    """Per-row position, micro-batch and optimiser step in split order.

    Effective batch = ``batch_size * grad_accum``; steps per epoch =
    ``ceil(n / effective)``; ``max_steps > 0`` overrides the epoch count.
    """
    eff = batch_size * grad_accum
    n = df.count()
    out = (with_positions(df, key).withColumn("micro_batch", F.floor(F.col("pos") / batch_size))
           .withColumn("step", F.floor(F.col("pos") / eff)))
    steps_per_epoch = math.ceil(n / eff) if n else 0
    total = max_steps if max_steps and max_steps > 0 else steps_per_epoch * epochs
    return out, {"rows": n, "effective_batch": eff, "steps_per_epoch": steps_per_epoch, "total_steps": total}


def training_steps(df: DataFrame, batch_size: int = 8, grad_accum: int = 4, epochs: int = 1, max_steps: int = -1,
                   key: str = "split_rank") -> DataFrame:
    """The rows of every optimiser step that is run: the batch plan repeated
    for each epoch (steps count on), up to ``total_steps``. Epochs come from a
    sequence column, so the plan is made once."""
    plan, info = batch_plan(df, batch_size, grad_accum, epochs, max_steps, key)
    per = max(info["steps_per_epoch"], 1)
    passes = -(-info["total_steps"] // per) if info["rows"] else 0
    runs = plan.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(passes - 1)))) if passes else \
        plan.withColumn("epoch", F.lit(0)).where(F.lit(False))
    out = runs.withColumn("step", (F.col("step") + F.col("epoch") * per).cast("long"))
    return out.where(F.col("step") < info["total_steps"])


def write_shards(plan: DataFrame, path: str, rows_per_shard: int, pos_col: str = "pos") -> None:
    """D8 export: ``shard = pos // rows_per_shard``, written with
    ``partitionBy("shard")``. The rows come dealt by the hash of their key, so they
    are dealt again by shard first: one task writes all of a shard, as one file.
    Files cost more than their few bytes, so the number of tasks is the session's."""
    parts = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (plan.withColumn("shard", F.floor(F.col(pos_col) / int(rows_per_shard)).cast("long")).repartition(parts, "shard")
         .write.mode("error").partitionBy("shard").parquet(path))
