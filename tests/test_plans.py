"""End-to-end jobs (prepare -> evaluate, ablations), sources, skew and plan shape."""

import io
import json
import os
import contextlib

from pyspark.sql import functions as F

from quire.operators.dedupe import dedupe_keep_first
from quire.operators.generate import echo_prompt_tail, fixed_cost, reference_head
from quire.operators.scoring import _gram_stats, pair_predictions
from quire.plans.ablations import run_ablations
from quire.plans.evaluate import evaluate
from quire.plans.prepare import PrepConfig, build_splits, load_splits, prepare_dataset
from quire.sources.readers import read_instructions, synthetic_instructions, conversation_instructions

SMOKE = PrepConfig(seed=42, eval_holdout_size=40, subsample_size=200, smoke_test=True, dataset_id="synthetic")


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_evaluate_writes_metrics(spark, tmpdir_path):
    raw = synthetic_instructions(spark, 600, 42)
    prepare_dataset(spark, raw, f"{tmpdir_path}/prep", SMOKE)
    _, ev = load_splits(spark, f"{tmpdir_path}/prep", raw, SMOKE)
    out = f"{tmpdir_path}/metrics.json"
    m = evaluate(spark, ev, {"base": echo_prompt_tail, "tuned": reference_head}, max_eval_samples=4,
                 max_new_tokens=8, out_path=out, seconds_fn=fixed_cost)
    assert os.path.exists(out) and json.load(open(out)) == m
    assert m["num_eval_samples"] == 4
    for k in ("bleu", "rouge_l"):
        assert isinstance(m["base"][k], float) and isinstance(m["fine_tuned"][k], float)
        assert m["delta"][k] == round(m["fine_tuned"][k] - m["base"][k], 4)
    assert m["fine_tuned"]["rouge_l"] > m["base"]["rouge_l"]


def test_ablations_artefacts_and_resume(spark, tmpdir_path, monkeypatch):
    rows = [(i, ("good clear answer text " if i % 3 else "spam junk spam ") * 2, float(i % 3 > 0)) for i in range(90)]
    df = spark.createDataFrame(rows, "row_id long, text string, label double")
    d = df.withColumn("split_rank", F.sha2(F.col("row_id").cast("string"), 256))
    tr, ev = d.filter(F.col("row_id") % 5 != 0), d.filter(F.col("row_id") % 5 == 0)
    cfg = dict(ranks=[8, 16], learning_rates=[2e-4], schedulers=["cosine", "constant"], max_steps=3,
               subset_size=40, eval_subset_size=20)
    out = run_ablations(spark, tr, ev, f"{tmpdir_path}/abl", cfg)
    assert len(out["results"]) == 4 and "eval_loss" in out["best"]
    for f in ("ablation_results.json", "best_config.json", "comparison_table.md"):
        assert os.path.exists(f"{tmpdir_path}/abl/{f}")
    from quire.operators import sweep
    monkeypatch.setattr(sweep, "default_cell", lambda *a, **k: 1 / 0)
    again = run_ablations(spark, tr, ev, f"{tmpdir_path}/abl", cfg)
    assert again["best"] == out["best"]     # finished cells are not re-run
    import pytest
    with pytest.raises(ZeroDivisionError):  # other settings are another sweep
        run_ablations(spark, tr, ev, f"{tmpdir_path}/abl", {**cfg, "per_device_train_batch_size": 4})


def test_read_instructions_mapping_and_alias(spark, tmpdir_path):
    p = f"{tmpdir_path}/rows.jsonl"
    with open(p, "w") as fh:
        fh.write(json.dumps({"id": 1, "question": "Q1", "response": "R1"}) + "\n")
        fh.write(json.dumps({"id": 2, "question": "Q2", "context": "C", "response": ""}) + "\n")
    df = read_instructions(spark, p, "json", mapping={"instruction": "question", "input": "context"}, order_col="id")
    got = {r.row_id: (r.instruction, r.input, r.output, r.response) for r in df.collect()}
    assert got == {1: ("Q1", None, None, "R1"), 2: ("Q2", "C", None, "")}
    import pytest
    with pytest.raises(ValueError):
        read_instructions(spark, p, "json")          # no 'instruction' column


def test_conversation_pairs_edge_cases(spark, tmpdir_path):
    rows = [(1, 0, "system", "S"), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"), (1, 3, "user", "u2"),
            (2, 0, "user", "x"), (2, 1, "user", "y"), (2, 2, "assistant", "z"),
            (3, 0, "system", "S3"), (3, 1, "assistant", "lonely")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .write.parquet(f"{tmpdir_path}/conversations.parquet")
    got = {(r.conv_id, r.turn): (r.instruction, r.input, r.output)
           for r in conversation_instructions(spark, tmpdir_path).collect()}
    assert got == {(1, 1): ("u1", "S", "a1"), (2, 1): ("y", "", "z")}


def test_ids_of_very_long_conversations_stay_apart(spark, tmpdir_path):
    rows = [(0, 1_000_000, "user", "a"), (0, 1_000_001, "assistant", "b"), (1, 0, "user", "c"), (1, 1, "assistant", "d")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmpdir_path}/conversations.parquet")
    ids = [r.row_id for r in conversation_instructions(spark, tmpdir_path).collect()]
    assert sorted(ids) == ["0:1000000", "1:0"]


def test_hot_group_of_copies(spark):
    # one text holds a third of all rows; first in input order must win
    n = 3000
    rows = [(i, "HOT  text" if i % 3 == 0 else f"row {i}") for i in range(n)]
    df = spark.createDataFrame(rows, "row_id long, text string").repartition(8)
    df = df.withColumn("content_hash", F.sha2(F.lower(F.col("text")), 256))
    out = dedupe_keep_first(df, "content_hash", ("row_id",))
    hot = out.filter(F.col("text") == "HOT  text").collect()
    assert len(hot) == 1 and hot[0].row_id == 0 and hot[0].n_copies == n // 3
    assert out.count() == 1 + n - n // 3
    plan = _plan(out)
    # the explain tree prints top-down: final aggregate, exchange on the hash, then the map-side partial
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning(content_hash")


def test_hot_conversation_spreads(spark, tmpdir_path):
    # one conversation with a third of all turns
    rows = []
    for t in range(600):
        rows.append((0, t, "user" if t % 2 == 0 else "assistant", f"m{t}"))
    for c in range(1, 301):
        rows += [(c, 0, "user", f"q{c}"), (c, 1, "assistant", f"a{c}")]
    rows += [(c, 2, "user", "tail") for c in range(301, 601)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .write.parquet(f"{tmpdir_path}/conversations.parquet")
    pairs = conversation_instructions(spark, tmpdir_path)
    assert pairs.count() == 300 + 300
    plan = _plan(pairs)
    assert "hashpartitioning(conv_id" in plan and "anchor" in plan


def test_bleu_aggregation_needs_no_exchange_after_explode(spark):
    df = spark.createDataFrame([(1, "s", "a b c", "a b d")],
                               "example_id long, system string, prediction string, reference string")
    plan = _plan(_gram_stats(df))
    gen = plan.index("Generate inline")
    # above the explode (earlier in the top-down text) only the tiny per-order exchange remains;
    # below it, the pairs are hash-partitioned once on example_id
    assert plan[:gen].count("Exchange") == 1 and "Exchange hashpartitioning(n#" in plan[:gen]
    assert "Exchange hashpartitioning(example_id" in plan[gen:]


def test_split_has_no_global_sort_and_pushes_the_cut(spark):
    raw = synthetic_instructions(spark, 600, 42)
    splits, staged, _ = build_splits(raw, SMOKE)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        splits.explain("formatted")
    plan = buf.getvalue()
    assert "rangepartitioning" not in plan.lower()
    assert "LessThanOrEqual(split_rank" in plan
    keys = [line for line in plan.splitlines() if "ReadSchema" in line and "split_rank" in line]
    assert keys and not any("text" in line for line in keys)          # the staged table holds keys alone


def test_read_instructions_csv_with_response_alias(spark, tmpdir_path):
    p = f"{tmpdir_path}/rows.csv"
    with open(p, "w") as fh:
        fh.write("id,prompt,ctx,response\n1,Q1,,R1\n2,Q2,C2,R2\n")
    df = read_instructions(spark, p, "csv", mapping={"instruction": "prompt", "input": "ctx"}, order_col="id",
                           options={"header": "true"}, schema="id long, prompt string, ctx string, response string")
    from quire.operators.render import render
    texts = {r.row_id: r.text for r in render(df).collect()}
    assert texts == {1: "### Instruction:\nQ1\n\n### Response:\nR1",
                     2: "### Instruction:\nQ2\n\nC2\n\n### Response:\nR2"}
