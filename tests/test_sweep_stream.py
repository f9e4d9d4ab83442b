"""Sweep grid/selection/table, generation, history, streaming dedupe."""

import math

from pyspark.sql import functions as F

from quire.operators import sweep as W
from quire.operators.generate import batch_generate, echo_prompt_tail, fixed_cost, map_rows, reference_head
from quire.operators.history import assemble_history, to_message_array

SMOKE = dict(ranks=[8, 16], learning_rates=[2e-4], schedulers=["cosine", "constant"])


def test_grid_order_tags_alpha(spark):
    g = W.param_grid(spark, [8, 16, 32], [0.0001, 0.0002, 1e-05], ["cosine", "linear"]).orderBy("cell_no").collect()
    assert len(g) == 18
    assert [(r.rank, r.learning_rate, r.scheduler) for r in g[:3]] == [(8, 0.0001, "cosine"), (8, 0.0001, "linear"),
                                                                    (8, 0.0002, "cosine")]
    assert g[0].run_tag == "r8_lr0.0001_cosine" and g[4].run_tag == "r8_lr1e-05_cosine"
    assert all(r.lora_alpha == 2 * r.rank for r in g)


CALLS = []


def _fake_cell(train, eval_, p):
    CALLS.append(p["cell_no"])
    # deterministic: tie between rank 8 and 16 on 'constant'; NaN for rank 16 cosine
    return {("cosine", 8): 0.5, ("constant", 8): 0.25, ("constant", 16): 0.25, ("cosine", 16): float("nan")}[
        (p["scheduler"], p["rank"])]


def test_sweep_select_table_and_resume(spark, tmpdir_path):
    g = W.param_grid(spark, **SMOKE)
    d = spark.range(10).select(F.col("id").alias("row_id"))
    res = W.run_sweep(spark, g, d, d, _fake_cell, results_path=f"{tmpdir_path}/res")
    assert res.count() == 4
    best = W.select_best(res).first()
    assert (best.rank, best.scheduler, best.eval_loss) == (8, "constant", 0.25)
    tab = W.comparison_table(res).orderBy("position").collect()
    assert [t.selected for t in tab] == [True, False, False, False]
    assert tab[0].eval_loss_text == "0.2500" and tab[-1].eval_loss_text == "NaN"
    md = W.markdown_table(W.comparison_table(res))
    assert md.count("| **1** |") == 1 and md.splitlines()[2].startswith("| **1** | 8 |")
    CALLS.clear()
    again = W.run_sweep(spark, g, d, d, _fake_cell, results_path=f"{tmpdir_path}/res")
    assert CALLS == [] and again.count() == 4           # every cell already finished
    # another grid, other data or another function in the same folder is another sweep
    other = W.run_sweep(spark, W.param_grid(spark, [64], [2e-4], ["linear"]), d, d, lambda a, b, p: 1.0, results_path=f"{tmpdir_path}/res")
    assert [(r.rank, r.scheduler, r.eval_loss) for r in other.collect()] == [(64, "linear", 1.0)]
    W.run_sweep(spark, g, d, d.limit(9), _fake_cell, results_path=f"{tmpdir_path}/res")
    assert sorted(CALLS) == [0, 1, 2, 3]
    shared = W.run_sweep(spark, g, d, d, lambda a, b, p: CALLS.append("x") or 2.0, effective=("rank", "learning_rate"))
    assert CALLS.count("x") == 2 and {r.eval_loss for r in shared.collect()} == {2.0}
    top = W.select_best(res, mode="max").first()
    assert top.eval_loss == 0.5   # NaN never wins
    import pytest
    with pytest.raises(ValueError):
        W.select_best(res, mode="maximum")
    tab_max = W.comparison_table(res, mode="max").orderBy("position").collect()
    assert tab_max[0].selected and tab_max[0].eval_loss_text == "0.5000" and tab_max[-1].eval_loss_text == "NaN"


def test_default_cell_runs_on_spark(spark):
    rows = [(i, ("good clear text " if i % 2 else "spam spam junk ") * 3, float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, text string, label double")
    loss = W.default_cell(df, df, {"rank": 8, "learning_rate": 2e-4}, max_steps=5)
    assert math.isfinite(loss) and loss > 0


def test_generate_and_map_rows(spark):
    ex = spark.createDataFrame([(1, "a b c d e", "x y z"), (2, "", "")], "example_id long, prompt string, reference string")
    b = {r.example_id: r for r in batch_generate(ex, echo_prompt_tail, "base", 2, fixed_cost).collect()}
    t = {r.example_id: r for r in batch_generate(ex, reference_head, "tuned", 2, fixed_cost).collect()}
    assert (b[1].prediction, b[1].n_tokens, b[1].seconds) == ("d e", 2, 0.5)
    assert (b[2].prediction, b[2].n_tokens) == ("", 0)
    assert t[1].prediction == "x y"
    m = map_rows(ex, lambda r: {"id": r["example_id"], "n": len(r["prompt"])}, "id long, n long").collect()
    assert sorted((r.id, r.n) for r in m) == [(1, 9), (2, 0)]


def test_closures_of_one_function_are_two_systems(spark):
    def make(word):
        def factory():
            return lambda batch, k: [word for _ in batch["prompt"]]
        return factory

    ex = spark.createDataFrame([(str(i), "p " * 600, "r") for i in range(6)], "example_id string, prompt string, reference string").coalesce(1)
    from quire.plans.evaluate import generate_systems
    got = {(r.system, r.prediction) for r in generate_systems(ex, {"base": make("one"), "tuned": make("two")}, 4, fixed_cost).collect()}
    assert got == {("base", "one"), ("tuned", "two")}
    seen = batch_generate(ex, lambda: lambda b, k: [str(len(p.split())) for p in b["prompt"]], "s", 4, fixed_cost)
    assert {(r.example_id, r.prediction) for r in seen.collect()} == {(str(i), "512") for i in range(6)}


def test_repeated_predictions_are_an_error(spark):
    import pytest
    from quire.operators.scoring import score_predictions
    preds = spark.createDataFrame([("a", "s", "x"), ("a", "s", "y")], "example_id string, system string, prediction string")
    refs = spark.createDataFrame([("a", "x")], "example_id string, reference string")
    with pytest.raises(Exception, match="repeated rows"):
        score_predictions(preds, refs, ["s"]).collect()
    assert score_predictions(preds.limit(1), refs, ["s"]).count() == 1


def test_history_rows_and_array(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "more"),
                                   (2, 0, "user", "solo")], "conv_id long, turn long, role string, text string")
    h = assemble_history(turns, "SYS")
    arr = {r.conv_id: [(m.role, m.content) for m in r.messages] for r in to_message_array(h).collect()}
    assert arr[1] == [("system", "SYS"), ("user", "hi"), ("assistant", "hello"), ("user", "more")]
    assert arr[2] == [("system", "SYS"), ("user", "solo")]
    own = spark.createDataFrame([(3, 0, "system", "OWN"), (3, 1, "user", "q")], "conv_id long, turn long, role string, text string")
    arr = to_message_array(assemble_history(own, "SYS")).first().messages
    assert [(m.role, m.content) for m in arr] == [("system", "OWN"), ("user", "q")]
    many = spark.range(5000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("x").alias("text"))
    assert len(to_message_array(assemble_history(many)).first().messages) == 5001


def test_stream_equals_batch_and_rerun_adds_nothing(spark, tmpdir_path):
    from conftest import SF01
    from quire.queries import ORACLES  # noqa: F401
    from quire.streaming.incremental import prepare_stream
    from quire.operators.render import drop_blank, render, with_content_hash
    from quire.sources.readers import doc_instructions
    sink, ck = f"{tmpdir_path}/sink", f"{tmpdir_path}/ck"
    prepare_stream(spark, SF01, sink, ck, glob="documents.parquet", max_files_per_trigger=1)
    got = spark.read.parquet(sink)
    batch = with_content_hash(drop_blank(render(doc_instructions(spark, SF01))))
    assert {r.content_hash for r in got.select("content_hash").collect()} == \
        {r.content_hash for r in batch.select("content_hash").distinct().collect()}
    n = got.count()
    assert n == 927
    prepare_stream(spark, SF01, sink, ck, glob="documents.parquet")
    assert spark.read.parquet(sink).count() == n
    # the table by its own path, as one file and as a folder of parts
    spark.read.parquet(f"{SF01}/documents.parquet").repartition(3).write.parquet(f"{tmpdir_path}/documents.parquet")
    for k, path in enumerate((f"{SF01}/documents.parquet", f"{tmpdir_path}/documents.parquet")):
        prepare_stream(spark, path, f"{tmpdir_path}/s{k}", f"{tmpdir_path}/c{k}")
        assert spark.read.parquet(f"{tmpdir_path}/s{k}").count() == n


def test_concurrent_cells_equal_sequential(spark):
    g = W.param_grid(spark, **SMOKE)
    d = spark.range(10).select(F.col("id").alias("row_id"))
    a = W.run_sweep(spark, g, d, d, _fake_cell)
    b = W.run_sweep(spark, g, d, d, _fake_cell, max_concurrent_cells=4)
    key = lambda r: r.cell_no
    strip = lambda rows: [(r.cell_no, r.run_tag, r.eval_loss if r.eval_loss == r.eval_loss else "nan")
                          for r in sorted(rows, key=key)]
    assert strip(a.collect()) == strip(b.collect())


def test_register_template(spark):
    from quire.functions.templates import register_template
    from quire.operators.render import render
    register_template("tagged", lambda m: F.concat(F.lit("Q: "), m[0]["content"], F.lit(" A: "), m[1]["content"]))
    df = spark.createDataFrame([(1, "hi", "", "yo")], "row_id int, instruction string, input string, output string")
    assert render(df, "tagged").first().text == "Q: hi A: yo"


def test_stream_dedupe_within_watermark(spark, tmpdir_path):
    import datetime as dt
    from quire.streaming.incremental import prepare_stream
    src = f"{tmpdir_path}/src"
    t0 = dt.datetime(2026, 1, 1)
    rows = [(1, "Same text\nbody", t0), (2, "same   TEXT\nbody", t0 + dt.timedelta(minutes=1)),
            (3, "other\nthing", t0 + dt.timedelta(minutes=2))]
    spark.createDataFrame(rows, "doc_id long, text string, ts timestamp").write.parquet(src)

    def to_instr(df):
        nl = F.instr(F.col("text"), "\n")
        return df.select(F.col("doc_id").alias("row_id"), "ts",
                         F.substring("text", F.lit(1), nl - 1).alias("instruction"), F.lit("").alias("input"),
                         F.substring("text", nl + 1, F.lit(10 ** 6)).alias("output"))

    sink = f"{tmpdir_path}/sink"
    prepare_stream(spark, src, sink, f"{tmpdir_path}/ck", schema="doc_id long, text string, ts timestamp",
                   to_instructions=to_instr, event_time_col="ts", watermark="1 hour")
    got = spark.read.parquet(sink)
    assert got.count() == 2 and "ts" in got.columns
