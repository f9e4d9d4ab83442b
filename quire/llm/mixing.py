"""Mixing sources to target weights.

Every document gets a hash-random key. Within its source it stands in key
order; distributed prefix sums of word counts give its place, and the source's
budget is cut exactly there: whole epochs for all of its documents, then the
first ``rem`` words of the shuffled source, the document at the cut taken in
part. DataFrame functions only; a source of any size is spread over
``2 ** bucket_bits`` key ranges, whose totals are the only thing summed in order
per source.

Defined results: null text, empty text or text of white space only has size 0
and is taken 0 times; a null source is a source of its own, last in order;
repeated rows count as often as they appear and order among themselves
arbitrarily; an empty table gives an empty result; other columns pass through
untouched under the names asked for with ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import running_totals, stage

WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(per_source: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """(source_key, source, source_size) -> the same with ``target`` and ``limited``.

    Weights go round by code point order of the source, null last. All words
    are shared by weight; a target stops at ``max_epochs`` times its source and
    the excess goes to the others. The sources that stop are those whose limit
    a unit of weight is lowest, so one ordered pass of running totals finds them.
    """
    ranked = running_totals(per_source, [F.col("source").asc_nulls_last()], {}, "source_rank")
    k = F.array(*[F.lit(int(w)) for w in weights])
    # several sources never share a rank, so the second order is total
    w = ranked.select("source_key", "source", "source_size",
                      F.get(k, F.pmod(F.col("rn") - 1, F.lit(len(weights))).cast("int")).cast("long").alias("weight"),
                      (F.col("source_size") * max_epochs).alias("cap"), F.col("rn").alias("source_rank"))
    w = w.withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    t = stage(running_totals(w, [F.col("ratio"), F.col("source_rank")], {"cap_sum": "cap", "weight_sum": "weight"},
                             "source_order"), "source_order")
    total, all_w = t.agg(F.sum("source_size"), F.sum("weight")).first()
    total, all_w = total or 0, all_w or 0
    left = F.lit(total) - (F.col("cap_sum") - F.col("cap"))
    left_w = F.lit(all_w) - (F.col("weight_sum") - F.col("weight"))
    t = t.withColumn("limited", F.col("cap").cast("double") * left_w <= F.col("weight").cast("double") * left)
    cap, lim_w = t.where("limited").agg(F.sum("cap"), F.sum("weight")).first()
    cap, lim_w = cap or 0, lim_w or 0
    share = (total - cap) / (all_w - lim_w) if all_w > lim_w else 0.0
    return t.select("source_key", "source", "source_size", "limited",
                    F.when(F.col("limited"), F.col("cap").cast("double"))
                    .otherwise(F.lit(float(share)) * F.col("weight")).alias("target"))


def _placed(docs: DataFrame, weights, max_epochs, seed, id_col, text_col, source_col, keep, bucket_bits) -> DataFrame:
    """Internal names throughout, kept columns as ``_k_<name>``, so no column of ``docs`` can clash."""
    t, s = F.col(text_col), F.col(source_col)
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    rows = docs.select(F.col(id_col).alias("_id"), *[F.col(c).alias(f"_k_{c}") for c in keep], s.alias("source"),
                       F.coalesce(F.concat(F.lit("s"), s), F.lit("n")).alias("source_key"),
                       word_count(t).alias("size"), key.alias("key"), F.xxhash64(t).alias("tie"))
    rows = rows.withColumn("bucket", F.shiftright(F.conv(F.substring("key", 1, 4), 16, 10).cast("int"), 16 - bucket_bits))
    # one row for each source and key range
    stats = stage(rows.groupBy("source_key", "bucket").agg(F.first("source").alias("source"), F.sum("size").alias("size")),
                  "mix_stats")
    per = stats.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    goal = source_targets(per, weights, max_epochs)
    before = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = stats.select("source_key", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    budget = F.floor(F.col("target") + 0.5)
    plan = (base.join(goal.drop("source"), "source_key").withColumn("budget", budget)
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0)))
            .withColumn("rem", F.col("budget") - F.col("epochs") * F.col("source_size")))
    w = Window.partitionBy("source_key", "bucket").orderBy("key", "_id", "tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.join(plan, ["source_key", "bucket"])
              .withColumn("at", F.col("base") + F.sum("size").over(w) - F.col("size")))
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rem") - F.col("at")))
    return placed.withColumn("part", part).withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 17,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", bucket_bits: int = 10) -> DataFrame:
    """(id, size, source_size, target, epochs, part, taken) per document.

    ``epochs`` whole copies and then the first ``part`` words are taken;
    ``taken = epochs * size + part``. The taken words of a source add up to its
    rounded target exactly. The key is a digest of seed and id, so reruns agree.
    """
    m = _placed(docs, weights, max_epochs, seed, id_col, text_col, source_col, (), bucket_bits)
    return m.select(F.col("_id").alias(id_col), "size", "source_size", "target", "epochs", "part", "taken")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 17,
                    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    chars_col: str = "n_chars", bucket_bits: int = 10) -> DataFrame:
    """The mix itself: every document once an epoch, the last one cut after ``part`` words;
    the columns of ``docs``, with ``chars_col`` brought up to date."""
    m = _placed(docs, weights, max_epochs, seed, id_col, text_col, source_col, tuple(docs.columns), bucket_bits)
    # a copy of null stands for "whole"; the partial copy carries its number of words
    copies = F.concat(F.array_repeat(F.lit(None).cast("long"), F.col("epochs").cast("int")),
                      F.when(F.col("part") > 0, F.array(F.col("part"))).otherwise(F.array().cast("array<long>")))
    x = m.withColumn("words", F.explode(copies))
    text = F.col(f"_k_{text_col}")
    # a word with the white space around it; only the document at a source's cut is taken apart
    words = F.regexp_extract_all(text, F.lit("[\\x20\\x09-\\x0D]*+[^\\x20\\x09-\\x0D]++[\\x20\\x09-\\x0D]*+"), F.lit(0))
    cut = (F.when(F.col("words").isNull() | (F.col("words") >= F.col("size")), text)
           .otherwise(F.array_join(F.slice(words, F.lit(1), F.col("words").cast("int")), "")))
    out = {c: F.col(f"_k_{c}") for c in docs.columns} | {text_col: cut}
    if chars_col in out:
        out[chars_col] = F.coalesce(F.length(cut), F.lit(0)).cast("long")
    return x.select(*[v.alias(k) for k, v in out.items()])
