"""Scoring generated text: corpus BLEU, ROUGE-L, system comparison and
throughput (A4-A7)."""

from __future__ import annotations

from collections import Counter
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from quire.functions.bleu import MAX_ORDER, bleu_from_stats, spaced_13a
from quire.functions.text import _c
from quire.session import ship_package


def pair_predictions(preds: DataFrame, refs: DataFrame, check: bool = False) -> DataFrame:
    """Inner equi-join of predictions ``(example_id, system, prediction, ...)``
    with references ``(example_id, reference)``. With ``check`` the pair
    count must equal the prediction count (no silent truncation)."""
    pairs = preds.join(refs.select("example_id", "reference"), "example_id", "inner")
    if check:
        a, b = preds.count(), pairs.count()
        if a != b:
            raise ValueError(f"{a - b} predictions have no reference")
    return pairs


def systems_of(pairs: DataFrame) -> list[str]:
    """The distinct system names (a handful of rows)."""
    return sorted(r[0] for r in pairs.select("system").distinct().collect())


def per_example(pairs: DataFrame, systems: list[str]) -> DataFrame:
    """One row per example: the reference once and one prediction column per
    system (``p0, p1, ...``; null when that system has no prediction).

    The aggregation hash-partitions on ``example_id``, so each reference is
    tokenised once however many systems are compared.
    """
    # no partition count: the engine sizes this exchange
    return pairs.repartition("example_id").groupBy("example_id").agg(
        F.first("reference", ignorenulls=True).alias("reference"),
        *[_one_of(F.col("system") == s, F.col("prediction")).alias(f"p{i}") for i, s in enumerate(systems)])


def _one_of(which: Column, value: Column) -> Column:
    """The value of the one row of a group that ``which`` picks; two such rows
    are an error, not a choice."""
    return F.when(F.count_if(which) > 1, F.raise_error(F.lit("an example has repeated rows of one system or reference"))) \
            .otherwise(F.max(F.when(which, value)))


def per_example_from(preds: DataFrame, refs: DataFrame, systems: list[str], check: bool = False) -> DataFrame:
    """The :func:`per_example` frame built directly from predictions
    ``(example_id, system, prediction)`` and references ``(example_id,
    reference)``: one shuffle of their union on ``example_id`` instead of a
    join followed by a re-partition, so each reference crosses the network
    once and is never duplicated per system. Inner-join semantics: examples
    without a reference or without any prediction are dropped; with
    ``check`` a prediction without a reference raises."""
    u = (preds.select("example_id", "system", F.col("prediction").alias("t"))
         .unionByName(refs.select("example_id", F.lit(None).cast("string").alias("system"),
                                  F.col("reference").alias("t"))))
    g = u.repartition("example_id").groupBy("example_id").agg(
        _one_of(F.col("system").isNull(), F.col("t")).alias("reference"),
        F.max(F.col("system").isNull().cast("int")).alias("_has_ref"),
        *[_one_of(F.col("system") == s, F.col("t")).alias(f"p{i}") for i, s in enumerate(systems)],
        *[F.max((F.col("system") == s).cast("int")).alias(f"_has{i}") for i, s in enumerate(systems)])
    has_pred = F.greatest(*[F.coalesce(F.col(f"_has{i}"), F.lit(0)) for i in range(len(systems))]) \
        if len(systems) > 1 else F.coalesce(F.col("_has0"), F.lit(0))
    if check:
        orphans = g.filter((F.col("_has_ref") == 0) & (has_pred == 1)).count()
        if orphans:
            raise ValueError(f"{orphans} examples have predictions but no reference")
    return g.filter((F.col("_has_ref") == 1) & (has_pred == 1)).select("example_id", "reference",
                                                                        *[f"p{i}" for i in range(len(systems))])


# --- BLEU ---------------------------------------------------------------------
_STATS = "array<struct<n:int,sys:int,correct:bigint,total:bigint,ref_len:bigint>>"


def _grams(tokens: list[str], n: int) -> list[tuple]:
    return [tuple(tokens[k:k + n]) for k in range(len(tokens) - n + 1)]


def example_stats(ref: list[str], hyps: list[list[str] | None], max_order: int = MAX_ORDER) -> list[tuple]:
    """One example's ``(n, system, clipped matches, hypothesis n-grams, reference length)``:
    every order of which a hypothesis has n-grams, and order 0, which counts the systems that
    predicted. Only n-grams of some hypothesis are counted in the reference, and those of one
    order are looked for where those of the order before were found."""
    if all(h is None for h in hyps):
        return []
    out = [(0, i, 0, int(h is not None), len(ref) if h is not None else 0) for i, h in enumerate(hyps)]
    vocab = set().union(*[h for h in hyps if h])
    spots = [k for k, w in enumerate(ref) if w in vocab]
    for n in range(1, max_order + 1):
        said = [Counter(_grams(h or [], n)) for h in hyps]
        wanted = set().union(*said)
        if not wanted:
            break
        here = [(k, tuple(ref[k:k + n])) for k in spots]
        spots = [k for k, g in here if g in wanted]
        found = Counter(g for _, g in here if g in wanted)
        out += [(n, i, sum(min(c, found[g]) for g, c in grams.items()), grams.total(), 0) for i, grams in enumerate(said)]
    return out


def _stats_of(batches, max_order: int):
    """Rows (reference, hypotheses), their tokens set apart -> the statistics of each."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):        # what is unpacked at a time
            rows = zip(*[c.to_pylist() for c in batch.slice(at, 256).columns])
            texts = [[None if t is None else t.split() for t in row] for row in rows]
            found = [example_stats(r, hs, max_order) for r, *hs in texts]
            flat = [x for rows in found for x in rows]
            types = {"n": pa.int32(), "sys": pa.int32(), "correct": pa.int64(), "total": pa.int64(), "ref_len": pa.int64()}
            items = pa.StructArray.from_arrays([pa.array([x[k] for x in flat], t) for k, t in enumerate(types.values())], list(types))
            ends = np.cumsum([0] + [len(rows) for rows in found])
            yield pa.record_batch([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)], ["stats"])


def _gram_stats(pairs: DataFrame | None, max_order: int = MAX_ORDER, systems: list[str] | None = None,
                wide: DataFrame | None = None) -> DataFrame:
    """Per ``(system, n)``: clipped matches, hypothesis and reference n-gram
    totals; order ``n = 0`` counts the examples each system predicted.

    The texts are tokenised by Column expressions. Clipping needs one example
    only, so each row of :func:`per_example` gives its few counts itself
    (:func:`example_stats`): no n-gram becomes a row or a key, a task holds
    the n-grams of one example at a time, and the sums are one small
    aggregation.
    """
    systems = systems or systems_of(pairs)
    wide = wide if wide is not None else per_example(pairs, systems)
    ship_package(wide.sparkSession)
    toks = wide.select(spaced_13a("reference").alias("r"), *[
        F.when(F.col(f"p{i}").isNotNull(), spaced_13a(f"p{i}")).alias(f"h{i}") for i in range(len(systems))])
    rows = toks.mapInArrow(partial(_stats_of, max_order=max_order), f"stats {_STATS}").select(F.inline("stats"))
    sums = rows.groupBy("n", "sys").agg(*[F.sum(c).cast("long").alias(c) for c in ("correct", "total", "ref_len")])
    name = F.element_at(F.array(*[F.lit(s) for s in systems]), F.col("sys") + 1)
    return sums.select(name.alias("system"), "n", "correct", "total", "ref_len")


def bleu_stats(pairs: DataFrame, max_order: int = MAX_ORDER, systems: list[str] | None = None) -> DataFrame:
    """Per ``(system, n)`` with at least one hypothesis n-gram: clipped
    matches ``correct`` and hypothesis n-gram count ``total``."""
    st = _gram_stats(pairs, max_order, systems)
    return st.filter((F.col("n") > 0) & (F.col("total") > 0)).select("system", "n", "correct", "total")


def corpus_bleu(pairs: DataFrame | None, max_order: int = MAX_ORDER, decimals: int = 4,
                systems: list[str] | None = None, wide: DataFrame | None = None) -> DataFrame:
    """A4: corpus BLEU per system (not an average of sentence scores):
    ``system, bleu, sys_len, ref_len, n_examples``. Lengths are the unigram
    totals, so no second pass over the texts."""
    st = _gram_stats(pairs, max_order, systems, wide)

    def at(k, c):
        return F.coalesce(F.sum(F.when(F.col("n") == k, F.col(c))), F.lit(0)).cast("long")

    wide = st.groupBy("system").agg(
        *[at(k, "correct").alias(f"c{k}") for k in range(1, max_order + 1)],
        *[at(k, "total").alias(f"t{k}") for k in range(1, max_order + 1)],
        at(1, "total").alias("sys_len"), at(0, "ref_len").alias("ref_len"),
        at(0, "total").alias("n_examples"))
    c = [F.col(f"c{k}") for k in range(1, max_order + 1)]
    t = [F.col(f"t{k}") for k in range(1, max_order + 1)]
    score = bleu_from_stats(c, t, F.col("sys_len"), F.col("ref_len"))
    return wide.select("system", F.round(score, decimals).alias("bleu"), "sys_len", "ref_len", "n_examples")


# --- ROUGE-L ------------------------------------------------------------------
def rouge_text(col) -> Column:
    """Lower-case, runs of non ``[a-z0-9]`` -> one space."""
    return F.regexp_replace(F.lower(_c(col)), "[^a-z0-9]++", " ")


def rouge_tokens(col) -> Column:
    """The words of :func:`rouge_text`."""
    return F.filter(F.split(rouge_text(col), " "), lambda x: x != "")


def lcs_length(a, b) -> int:
    """Exact LCS length of two token sequences, bit-parallel (Allison-Dix /
    Hyyro): one big-int update per token of the shorter sequence, over the
    tokens of the longer one that occur in it."""
    if len(a) > len(b):
        a, b = b, a
    shared = set(a)
    spots: dict = {}
    n = 0
    for tok in b:
        if tok in shared:
            spots.setdefault(tok, []).append(n)
            n += 1
    if not n:
        return 0
    masks = {}
    for tok, at in spots.items():
        bits = np.zeros(n, bool)
        bits[at] = True
        masks[tok] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    full = (1 << n) - 1
    v = full
    for tok in a:
        m = masks.get(tok)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


_LCS_TYPE = T.StructType([T.StructField("lcs", T.IntegerType()), T.StructField("n_pred", T.IntegerType()),
                          T.StructField("n_ref", T.IntegerType())])


_LCS_ARRAY = T.ArrayType(_LCS_TYPE)


def _lcs_rows(ref: pd.Series, preds: pd.Series, stemmed: bool) -> pd.Series:
    """Texts of :func:`rouge_text`. Per example: the reference prepared once, then
    per system the LCS (null entry when the system has no prediction)."""
    from quire.functions.porter import STEMS

    def prep(text):
        toks = text.split()
        return [STEMS[x] for x in toks] if stemmed else toks

    out = []
    for r, ps in zip(ref, preds):
        rt = prep(r if r is not None else "")
        row = []
        for p in ps:
            if p is None:
                row.append(None)
                continue
            pt = prep(p)
            row.append({"lcs": lcs_length(pt, rt) if pt and rt else 0, "n_pred": len(pt), "n_ref": len(rt)})
        out.append(row)
    return pd.Series(out)


@pandas_udf(_LCS_ARRAY)
def _stem_lcs(ref: pd.Series, preds: pd.Series) -> pd.Series:
    return _lcs_rows(ref, preds, True)


@pandas_udf(_LCS_ARRAY)
def _plain_lcs(ref: pd.Series, preds: pd.Series) -> pd.Series:
    return _lcs_rows(ref, preds, False)


def rouge_l_rows(pairs: DataFrame | None, systems: list[str] | None = None,
                 wide: DataFrame | None = None, stemmed: bool = True) -> DataFrame:
    """Per pair: LCS, token counts and the ROUGE-L F-measure, of stemmed or plain tokens."""
    systems = systems or systems_of(pairs)
    wide = wide if wide is not None else per_example(pairs, systems)
    ship_package(wide.sparkSession)
    k = len(systems)
    preds = F.array(*[F.when(F.col(f"p{i}").isNotNull(), rouge_text(f"p{i}")) for i in range(k)])
    s = wide.select("example_id", F.posexplode((_stem_lcs if stemmed else _plain_lcs)(rouge_text("reference"), preds)).alias("i", "s"))
    s = s.filter(F.col("s").isNotNull()).withColumn(
        "system", F.element_at(F.array(*[F.lit(x) for x in systems]), F.col("i") + 1))
    p = F.col("s.lcs") / F.col("s.n_pred")
    r = F.col("s.lcs") / F.col("s.n_ref")
    f = F.when((F.col("s.n_pred") == 0) | (F.col("s.n_ref") == 0) | (F.col("s.lcs") == 0), F.lit(0.0)) \
         .otherwise(F.lit(2.0) * p * r / (p + r))
    return s.select("system", "example_id", F.col("s.lcs").alias("lcs"), F.col("s.n_pred").alias("n_pred"),
                    F.col("s.n_ref").alias("n_ref"), f.alias("rouge_l_f"))


def rouge_l(pairs: DataFrame | None, decimals: int = 4, systems: list[str] | None = None,
            wide: DataFrame | None = None, stemmed: bool = True) -> DataFrame:
    """A5: mean ROUGE-L F x 100 per system (no rows -> no system row)."""
    return rouge_l_rows(pairs, systems, wide, stemmed).groupBy("system").agg(
        F.round(F.coalesce(F.avg("rouge_l_f"), F.lit(0.0)) * 100.0, decimals).alias("rouge_l"))


# --- comparison and throughput -------------------------------------------------
def score_systems(pairs: DataFrame | None, with_rouge: bool = True, systems: list[str] | None = None,
                  wide: DataFrame | None = None, stemmed: bool = True) -> DataFrame:
    """BLEU (and ROUGE-L) per system, from pairs or a prebuilt per-example frame."""
    systems = systems or systems_of(pairs)
    b = corpus_bleu(pairs, systems=systems, wide=wide)
    if with_rouge:
        b = b.join(rouge_l(pairs, systems=systems, wide=wide, stemmed=stemmed), "system", "left")
    return b


def score_predictions(preds: DataFrame, refs: DataFrame, systems: list[str] | None = None,
                      with_rouge: bool = True, check: bool = False) -> DataFrame:
    """BLEU (and ROUGE-L) per system straight from predictions and
    references (see :func:`per_example_from`)."""
    systems = systems or systems_of(preds)
    wide = per_example_from(preds, refs, systems, check)
    return score_systems(None, with_rouge, systems, wide)


def compare_systems(scores: DataFrame, base: str = "base", tuned: str = "tuned",
                    metrics=("bleu", "rouge_l")) -> DataFrame:
    """One row with each system's (already rounded) scores and
    ``delta_<metric> = round(tuned - base, 4)``."""
    metrics = [m for m in metrics if m in scores.columns]
    agg = [F.max(F.when(F.col("system") == s, F.col(m))).alias(f"{p}_{m}")
           for s, p in ((base, "base"), (tuned, "tuned")) for m in metrics]
    out = scores.groupBy().agg(F.max("n_examples").alias("num_eval_samples"), *agg)
    return out.select("*", *[F.round(F.col(f"tuned_{m}") - F.col(f"base_{m}"), 4).alias(f"delta_{m}") for m in metrics])


def throughput(preds: DataFrame) -> DataFrame:
    """Per system total seconds (round 2), tokens, and tokens/second;
    a reply with ``seconds <= 0`` has rate 0."""
    rate = F.when(F.col("seconds") > 0, F.col("n_tokens") / F.col("seconds")).otherwise(F.lit(0.0))
    return preds.groupBy("system").agg(
        F.count(F.lit(1)).alias("replies"),
        F.sum("n_tokens").cast("long").alias("tokens"),
        F.round(F.sum("seconds"), 2).alias("seconds"),
        F.round(F.avg(rate), 4).alias("mean_tok_per_sec"),
        F.round(F.when(F.sum("seconds") > 0, F.sum("n_tokens") / F.sum("seconds")).otherwise(F.lit(0.0)), 4)
         .alias("tok_per_sec"))
