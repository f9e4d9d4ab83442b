"""Audits and profiles: schema check, disjointness, prompt leakage, dry-run
report and manifest counts (A1-A3, D5, D7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.templates import render_chat, split_prompt_reference
from quire.functions.text import content_hash, is_blank, text_preview
from quire.operators.render import with_messages
from quire.session import stage
from quire.sources.readers import first_in_order


def check_schema(df: DataFrame, required=("instruction", "output")) -> list[str]:
    """A1: sorted column list; raises before any job when a required column
    is missing (``output`` may be supplied as ``response``)."""
    cols = sorted(df.columns)
    for r in required:
        if r not in cols and not (r == "output" and "response" in cols):
            raise ValueError(f"missing {r!r}; got {cols}")
    return cols


def disjointness_audit(train: DataFrame, eval_: DataFrame, key: str = "content_hash",
                       fail: bool = True) -> DataFrame:
    """Distinct keys per side and the size of their intersection.

    One aggregation over the union of both key columns: per key, which sides
    hold it (partial aggregation dedupes map-side, no join, no broadcast),
    then three sums. Returns one row ``train_unique_hashes,
    eval_unique_hashes, intersection``; ``fail=True`` raises on overlap.
    """
    u = (train.select(F.col(key), F.lit(1).alias("t"), F.lit(0).alias("e"))
         .unionByName(eval_.select(F.col(key), F.lit(0).alias("t"), F.lit(1).alias("e"))))
    per_key = u.groupBy(key).agg(F.max("t").alias("t"), F.max("e").alias("e"))
    out = per_key.agg(F.sum("t").cast("long").alias("train_unique_hashes"),
                      F.sum("e").cast("long").alias("eval_unique_hashes"),
                      F.sum(F.col("t") * F.col("e")).cast("long").alias("intersection"))
    out = out.select(*[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in out.columns])
    if fail:
        row = out.first()
        if row["intersection"]:
            raise AssertionError(f"train/eval overlap detected: {row['intersection']} keys")
    return out


def prompt_leakage(train: DataFrame, eval_: DataFrame, text_col: str = "text",
                   id_col: str = "content_hash") -> DataFrame:
    """Eval rows whose *prompt* (P8) also occurs in train, possibly with
    another answer. The whole-text hash split allows this; the documented
    intent (disjoint by instruction) does not. Returns the leaking eval rows.

    A semi-join on the prompt hash; the engine broadcasts a side only where
    it measures that side as small."""
    def ph(df):
        return df.select(id_col, content_hash(split_prompt_reference(text_col)["prompt"]).alias("prompt_hash"))
    return ph(eval_).join(ph(train).select("prompt_hash").distinct(), "prompt_hash", "left_semi")


def manifest_counts(staged: DataFrame, splits: DataFrame, key: str = "content_hash",
                    copies_col: str = "n_copies") -> dict:
    """A3: ``raw`` (non-blank rows before dedupe), ``after_dedupe``, ``train``,
    ``eval_holdout`` and the disjointness triple, as a small dict."""
    pre = staged.agg(F.sum(copies_col).cast("long").alias("raw"),
                     F.count(F.lit(1)).alias("after_dedupe")).first()
    prof = splits.agg(F.count(F.when(F.col("split") == "train", 1)).alias("train"),
                      F.count(F.when(F.col("split") == "eval", 1)).alias("eval_holdout")).first()
    dis = disjointness_audit(splits.filter(F.col("split") == "train"),
                             splits.filter(F.col("split") == "eval"), key, fail=False).first()
    return {"counts": {"raw": int(pre["raw"] or 0), "after_dedupe": int(pre["after_dedupe"]),
                       "train": int(prof["train"]), "eval_holdout": int(prof["eval_holdout"])},
            "disjointness": {k: int(dis[k]) for k in ("train_unique_hashes", "eval_unique_hashes", "intersection")}}


def dry_run_report(raw: DataFrame, n: int, template: str = "plain", order_col: str = "row_id",
                   allow_blank: bool = False) -> DataFrame:
    """A2: schema/plumbing report over the first ``n`` rows (in ``order_col``).

    ``raw`` holds the source instruction rows (with ``order_col``); only the
    bounded sample is rendered with ``template`` and staged, so the top-n runs
    once. Dedupe and a ``max(1, n // 5)`` eval slice (first occurrences in
    input order) run on the staged sample; their overlap must be 0. A blank
    formatted row raises unless ``allow_blank``.
    """
    cols = check_schema(raw.drop(order_col) if order_col in raw.columns else raw)
    sample = stage(first_in_order(raw, n, order_col), "dry-run")
    rendered = with_messages(sample).withColumn("text", render_chat(F.col("messages"), template))
    s = (rendered.select(order_col, "text", *(["input"] if "input" in raw.columns else []))
               .withColumn("empty_input", is_blank("input") if "input" in raw.columns else F.lit(True))
               .withColumn("non_empty", ~is_blank("text"))
               .withColumn("content_hash", content_hash("text")))
    agg = s.agg(
        F.count(F.lit(1)).alias("rows_streamed"),
        F.count_if(F.col("empty_input")).alias("empty_input_rows_in_slice"),
        F.coalesce(F.min_by(F.col("non_empty"), F.when(F.col("empty_input"), F.col(order_col))),
                   F.lit(True)).alias("empty_input_handled"),
        F.coalesce(F.bool_and(F.col("non_empty")), F.lit(True)).alias("all_formatted_non_empty"),
        F.countDistinct("content_hash").alias("after_dedupe"),
        text_preview(F.min_by(F.col("text"), F.col(order_col)), 300).alias("sample_formatted_text"),
    ).first()
    if not agg["rows_streamed"]:
        raise RuntimeError("the source yielded 0 rows")
    if not agg["all_formatted_non_empty"] and not allow_blank:
        raise ValueError("a formatted row of the sample is blank")
    # first occurrence of each hash in input order; the first max(1, d // 5) are eval
    firsts = s.groupBy("content_hash").agg(F.min(order_col).alias("first_id"))
    eval_n = max(1, agg["after_dedupe"] // 5)
    ev = firsts.orderBy("first_id").limit(eval_n)
    tr = firsts.join(ev.select("content_hash"), "content_hash", "left_anti")
    overlap = disjointness_audit(tr, ev, fail=False).first()["intersection"]
    row = (agg["rows_streamed"], cols, "instruction" in cols, "input" in cols, "output" in cols,
           agg["empty_input_rows_in_slice"], agg["empty_input_handled"], agg["all_formatted_non_empty"],
           agg["after_dedupe"], int(overlap), agg["sample_formatted_text"])
    schema = ("rows_streamed long, columns array<string>, instruction_present boolean, "
              "input_present boolean, output_present boolean, empty_input_rows_in_slice long, "
              "empty_input_handled boolean, all_formatted_non_empty boolean, after_dedupe long, "
              "split_overlap long, sample_formatted_text string")
    out = raw.sparkSession.createDataFrame([row], schema)
    assert overlap == 0
    return out
