"""How five document filters interact, whatever order they are applied in.

Words come from a document-term matrix (:mod:`quire.llm.term_matrix`): the sum of a
row is the number of words, its entries are the different words, which decide filters
A and B. The other filters are facts of the text kept beside the row. A document then
is a set of failed filters, and 32 counts a part say everything: what a filter removes
at its place in any order is a sum over the sets that hold it and none of the filters
before it. So no order is ever run; the 120 orders are worked out from the counts.

Whether a text is a copy (filter E) is decided for groups of rows with one text digest,
part and labels: each group knows its rows, its smallest id and that id's rows, so the
copies of a text are never in one place, however many they are (a digest has at most
four groups a part).

Defined results: null text is empty, a null part is the empty string; repeated rows
count each, and are no copies of each other (their id is not smaller); rows without
an id never fail E, make no other row fail it, and have no labels; labels without an
id are ignored, and of several labels of one id any 1 counts; other columns of the
tables are not read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.term_matrix import row_totals, term_matrix

#: the filters, in the order of their bits; E is decided over the whole table
FILTERS = "ABCDE"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failed(rows: DataFrame, min_words: int = 200, min_distinct: int = 50, max_upper: int = 3) -> DataFrame:
    """(doc_id, part, digest, mask): the filters A to D that a document fails, as bits."""
    fails = [F.col("n_words") < min_words,
             100 * F.col("n_terms") < min_distinct * F.col("n_words"),
             100 * F.col("upper") > max_upper * F.col("chars"),
             F.col("symbol")]
    mask = sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))
    return rows.select("doc_id", F.coalesce("part", F.lit("")).alias("part"), "digest", mask.cast("int").alias("mask"))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Equal rows counted (``n``), with their id's labels."""
    per = docs.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    of = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
          .agg(F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
               F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic")))
    known = per.where("doc_id IS NOT NULL").join(of, "doc_id", "left").fillna(0, ["good", "toxic"])
    without = per.where("doc_id IS NULL").withColumn("good", F.lit(0)).withColumn("toxic", F.lit(0))
    return known.unionByName(without)


def set_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, n, good, toxic): for every part, documents, good and toxic ones by the
    set of filters they fail - arrays of 32 counts, the set's bits being the place."""
    g = _labelled(docs, labels).groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"),
        F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"))
    least = F.min("first").over(Window.partitionBy("digest"))
    g = g.withColumn("own", F.col("no_id") + F.when(F.col("first") == least, F.col("n_first")).otherwise(0))
    sums = []
    for m in range(32):
        n = F.col("own") if m < 16 else F.col("n") - F.col("own")
        here = F.when(F.col("mask") == m % 16, n).otherwise(0)
        sums += [F.sum(here).alias(f"n{m}"), F.sum(here * F.col("good")).alias(f"g{m}"), F.sum(here * F.col("toxic")).alias(f"t{m}")]
    per = g.groupBy("part").agg(*sums)
    return per.select("part", *[F.array(*[f"{k}{m}" for m in range(32)]).alias(name) for k, name in (("n", "n"), ("g", "good"), ("t", "toxic"))])


def _places() -> list[dict]:
    """Every order and step: the bits before the step and the step's own."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            out.append({"filter_order": "".join(order), "step": step, "before": before, "bit": bit})
            before |= bit
    return out


def interactions(counts: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, ...) of all 120 orders from the counts of :func:`set_counts`."""
    places = F.from_json(F.lit(json.dumps(_places())), "array<struct<filter_order: string, step: int, before: int, bit: int>>")
    at = counts.select("*", F.explode(places).alias("o")).select("part", "n", "good", "toxic", "o.*")

    def total(of: str, where: str, times: str = "1"):
        return F.expr(f"aggregate(sequence(0, 31), 0L, (s, m) -> s + IF({where}, {of}[m] * {times}, 0L))")

    here = "(m & before) = 0 AND (m & bit) <> 0"
    return at.select("part", "filter_order", "step",
                     total("n", "(m & (before | bit)) = 0").alias("kept"),
                     total("n", here).alias("removed"),
                     total("n", "(m & before) <> 0 AND (m & bit) <> 0").alias("redundant"),
                     total("n", "m = bit").alias("unique_fails"),
                     total("good", here).alias("good_lost"),
                     total("toxic", here).alias("toxic_lost"),
                     # of the orders of a set's members, each member comes first in the same share
                     total("n", "(m & bit) <> 0", "(120 div bit_count(m))").alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of the five filters over whole tables."""
    shards, _ = term_matrix(docs)
    return interactions(set_counts(failed(row_totals(shards)), labels))
