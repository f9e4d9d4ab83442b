"""The ablation job: grid -> subsets -> cells -> winner -> artefacts
(``ablation_results.json``, ``best_config.json``, ``comparison_table.md``)."""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, SparkSession

from quire.operators import sweep as W
from quire.operators.split import take_first
from quire.sources.store import write_text

# --- fixed values: the settings a grid file may hold, with their usual values ---
DEFAULTS = {
    "ranks": [8, 16, 32], "learning_rates": [0.0001, 0.0002],
    "schedulers": ["cosine", "linear", "constant", "constant_with_warmup"],
    "max_steps": 300, "subset_size": 2000, "eval_subset_size": 200, "lora_alpha_multiplier": 2,
    "per_device_train_batch_size": 8, "gradient_accumulation_steps": 2, "max_seq_length": 1024,
    "selection_metric": "eval_loss", "selection_mode": "min",
}
# ----------------------------------------------------------------------------


def _clean(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def run_ablations(spark: SparkSession, train: DataFrame, eval_: DataFrame, results_dir: str,
                  cfg: dict | None = None, cell_fn=None) -> dict:
    """``train``/``eval_`` are split frames with ``split_rank``, ``text`` and a
    label column. Subsets are the first ``subset_size`` / ``eval_subset_size``
    rows in split order. Each finished cell is persisted under
    ``results_dir/cells`` so a re-run resumes."""
    c = {**DEFAULTS, **(cfg or {})}
    unknown = set(c) - set(DEFAULTS) - {"results_dir"}
    if unknown:
        raise ValueError(f"unknown ablation settings: {sorted(unknown)}")
    grid = W.param_grid(spark, c["ranks"], c["learning_rates"], c["schedulers"], c["lora_alpha_multiplier"])
    tr = take_first(train, c["subset_size"])
    ev = take_first(eval_, c["eval_subset_size"])
    plan = W.sweep_plan(grid, train.count(), eval_.count(), c["subset_size"], c["eval_subset_size"],
                        c["per_device_train_batch_size"], c["gradient_accumulation_steps"], c["max_steps"])
    steps = plan.first()["steps"]
    fn = cell_fn or (lambda a, b, p: W.default_cell(a, b, p, max_steps=steps, max_tokens=c["max_seq_length"]))
    note = json.dumps({k: c[k] for k in sorted(c)}, default=str)
    results = W.run_sweep(spark, grid, tr, ev, fn, results_path=f"{results_dir}/cells", note=note,
                          effective=None if cell_fn else ("rank", "learning_rate"))
    metric, mode = c["selection_metric"], c["selection_mode"]
    best_rows = W.select_best(results, metric, mode).collect()
    best = {k: _clean(v) for k, v in best_rows[0].asDict().items()} if best_rows else None
    table = W.comparison_table(results, metric, mode)
    rows = [{k: _clean(v) for k, v in r.asDict().items()} for r in results.orderBy("cell_no").collect()]
    write_text(spark, f"{results_dir}/ablation_results.json",
               json.dumps({"results": rows, "best": best, "grid_size": len(rows)}, indent=2))
    write_text(spark, f"{results_dir}/best_config.json", json.dumps(best, indent=2))
    write_text(spark, f"{results_dir}/comparison_table.md",
               "# Sweep results, best cell first\n\nOrder: " + metric + ".\n\n" + W.markdown_table(table, metric))
    return {"results": rows, "best": best, "results_dir": results_dir}
