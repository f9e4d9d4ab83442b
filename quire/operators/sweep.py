"""Experiment sweep: grid, cell runs, winner selection, ranked table
(E1-E4, P12, P13)."""

from __future__ import annotations

import functools
import hashlib
import json
import math
import time
import types
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.text import truncate_ws_tokens

RESULT_SCHEMA = ("cell_no int, rank int, learning_rate double, scheduler string, lora_alpha int, "
                 "run_tag string, eval_loss double, runtime_seconds double")


def param_grid(spark: SparkSession, ranks, learning_rates, schedulers, alpha_multiplier: int = 2) -> DataFrame:
    """E1 + P12 + P13: the ordered Cartesian product ranks x rates x
    schedulers (nested explodes, ``cell_no`` in product order), with
    ``lora_alpha = rank * multiplier`` and ``run_tag = r{rank}_lr{lr}_{sched}``
    (the rate printed as Python prints it: ``0.0001``, ``1e-05``)."""
    nr, ns = len(learning_rates), len(schedulers)
    rates = F.array(*[F.struct(F.lit(float(v)).alias("v"), F.lit(repr(float(v))).alias("t")) for v in learning_rates])
    g = (spark.range(1)
         .select(F.posexplode(F.array(*[F.lit(int(r)) for r in ranks])).alias("i", "rank"))
         .select("*", F.posexplode(rates).alias("j", "lr"))
         .select("*", F.posexplode(F.array(*[F.lit(s) for s in schedulers])).alias("k", "scheduler")))
    return g.select(
        ((F.col("i") * nr + F.col("j")) * ns + F.col("k")).cast("int").alias("cell_no"),
        F.col("rank").cast("int").alias("rank"),
        F.col("lr.v").alias("learning_rate"),
        F.col("scheduler"),
        (F.col("rank") * F.lit(int(alpha_multiplier))).cast("int").alias("lora_alpha"),
        F.concat(F.lit("r"), F.col("rank").cast("string"), F.lit("_lr"), F.col("lr.t"), F.lit("_"),
                 F.col("scheduler")).alias("run_tag"),
    )


def sweep_plan(grid: DataFrame, train_rows: int, eval_rows: int, subset_size: int, eval_subset_size: int,
               batch_size: int, grad_accum: int, max_steps: int) -> DataFrame:
    """Each cell's data budget: rows used, effective batch and steps
    (``max_steps`` when positive, else one epoch of the subset)."""
    tr = min(train_rows, subset_size)
    ev = min(eval_rows, eval_subset_size)
    eff = batch_size * grad_accum
    steps = max_steps if max_steps > 0 else math.ceil(tr / eff)
    return grid.select("*", F.lit(tr).cast("long").alias("train_rows"), F.lit(ev).cast("long").alias("eval_rows"),
                       F.lit(eff).alias("effective_batch"), F.lit(steps).alias("steps"))


def default_cell(train: DataFrame, eval_: DataFrame, params: dict, max_steps: int = 20, seed: int = 42,
                 label_col: str = "label", text_col: str = "text", n_features: int = 256,
                 max_tokens: int | None = None) -> float:
    """Default cell: a Spark ML text classifier whose fit runs on Spark.

    Hashed token counts -> a one-hidden-layer perceptron trained by
    gradient descent; ``rank`` is the hidden width, ``learning_rate`` the
    step size, ``max_steps`` the iterations. Returns the mean log-loss on
    ``eval_``. The scheduler is recorded but Spark's optimiser has no
    schedule, so cells that differ only in it tie (smaller rank, then grid
    order, wins); ``run_sweep(effective=...)`` fits them once. ``max_tokens``
    cuts the texts first.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.feature import HashingTF, RegexTokenizer
    from pyspark.ml.functions import vector_to_array

    if max_tokens is not None:
        train, eval_ = [d.withColumn(text_col, truncate_ws_tokens(text_col, max_tokens)["text"]) for d in (train, eval_)]
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern="[^a-z0-9]+", toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=n_features),
        MultilayerPerceptronClassifier(featuresCol="_tf", labelCol=label_col, layers=[n_features, int(params["rank"]), 2],
                                       solver="gd", stepSize=float(params["learning_rate"]) * 1000.0,
                                       maxIter=int(max_steps), seed=seed, probabilityCol="_p"),
    ])
    model = pipe.fit(train)
    pred = model.transform(eval_)
    p = F.element_at(vector_to_array("_p"), F.col(label_col).cast("int") + 1)
    loss = pred.agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15))))).first()[0]
    return float("nan") if loss is None else float(loss)


def cell_identity(fn, _seen: tuple = ()) -> list:
    """What a cell function does and holds, as plain lists: code, defaults, closure,
    bound arguments, and the functions of its own package that its code names; of any
    other object the digest of its pickled state."""
    def of(x):
        return cell_identity(x, (*_seen, id(fn)))

    if id(fn) in _seen:
        return ["again", getattr(fn, "__qualname__", "")]
    if fn is None or isinstance(fn, (bool, int, float, complex, str, bytes)):
        return [type(fn).__name__, repr(fn)]
    if isinstance(fn, (list, tuple)):
        return [type(fn).__name__, *map(of, fn)]
    if isinstance(fn, (set, frozenset)):
        return ["set", *sorted(map(of, fn), key=repr)]
    if isinstance(fn, dict):
        return ["dict", *sorted(([of(k), of(v)] for k, v in fn.items()), key=repr)]
    if isinstance(fn, functools.partial):
        return ["partial", of(fn.func), of(fn.args), of(fn.keywords)]
    if isinstance(fn, types.MethodType):
        return ["method", of(fn.__func__), of(fn.__self__)]
    if isinstance(fn, types.ModuleType):
        return ["module", fn.__name__]
    if isinstance(fn, types.CodeType):      # names and constants with it; a nested function's code is a constant
        return ["code", fn.co_code.hex(), list(fn.co_names), *map(of, fn.co_consts)]
    if isinstance(fn, types.FunctionType):
        own = fn.__module__.split(".")[0]
        named = [fn.__globals__.get(n) for n in fn.__code__.co_names]
        near = [g for g in named if isinstance(g, types.FunctionType) and g.__module__.split(".")[0] == own]
        cells = [c.cell_contents for c in fn.__closure__ or ()]
        return ["function", fn.__module__, fn.__qualname__, of(fn.__code__), of(fn.__defaults__), of(fn.__kwdefaults__), *map(of, cells), *map(of, near)]
    if isinstance(fn, type) or isinstance(fn, types.BuiltinFunctionType):
        return ["name", getattr(fn, "__module__", "") or "", fn.__qualname__]
    return ["object", hashlib.sha256(cloudpickle.dumps(fn)).hexdigest()]


def sweep_fingerprint(cells: list[dict], train: DataFrame, eval_: DataFrame, cell_fn, note: str = "") -> str:
    """Identity of a sweep: its cells, the rows of both subsets (counts and an
    order-free hash), what the cell function does and holds (:func:`cell_identity`)
    and ``note``."""
    def data(d):
        cols = sorted(d.columns)
        r = d.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*cols).cast("decimal(38,0)"))).first()
        return [cols, r[0], str(r[1])]
    return hashlib.sha256(json.dumps([cells, data(train), data(eval_), cell_identity(cell_fn), note], sort_keys=True).encode()).hexdigest()[:16]


def run_sweep(spark: SparkSession, grid: DataFrame, train: DataFrame, eval_: DataFrame,
              cell_fn: Callable[[DataFrame, DataFrame, dict], float] = default_cell,
              results_path: str | None = None, max_concurrent_cells: int = 1,
              effective: tuple[str, ...] | None = None, note: str = "") -> DataFrame:
    """Run every cell; the two subsets are persisted once for all cells.

    Cells are whole Spark jobs submitted from the driver (the grid is a small
    parameter table). ``max_concurrent_cells > 1`` submits several cells at
    once from a thread pool - on a large cluster one small fit does not fill
    it. ``effective`` names the settings that reach the fit: cells equal in
    them are fitted once. With ``results_path`` each finished cell is written
    at once under the sweep's fingerprint and a re-run of the same sweep skips
    it; another grid, other data or another cell function has a folder of its
    own. A failing cell fails the sweep but keeps the finished ones.
    """
    from concurrent.futures import ThreadPoolExecutor

    from quire.sources.store import exists

    cells = [r.asDict() for r in grid.orderBy("cell_no").collect()]
    train, eval_ = train.persist(), eval_.persist()
    names = [c.split(" ")[0] for c in RESULT_SCHEMA.split(", ")]
    try:
        base = f"{results_path}/{sweep_fingerprint(cells, train, eval_, cell_fn, note)}" if results_path else None
        groups: dict = {}
        for c in cells:
            groups.setdefault(tuple(c[k] for k in effective) if effective else c["cell_no"], []).append(c)

        def part(cell):
            return f"{base}/cell_no={cell['cell_no']}"

        def run_group(same):
            todo = [c for c in same if not (base and exists(spark, f"{part(c)}/_SUCCESS"))]
            if not todo:
                return []
            t0 = time.perf_counter()
            loss = cell_fn(train, eval_, same[0])
            took = round(time.perf_counter() - t0, 2)
            rows = [{**c, "eval_loss": None if loss is None else float(loss), "runtime_seconds": took} for c in todo]
            if base:
                for row in rows:
                    spark.createDataFrame([row], RESULT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(part(row))
            return rows

        if max_concurrent_cells > 1:
            with ThreadPoolExecutor(max_workers=max_concurrent_cells) as pool:
                rows = [r for g in pool.map(run_group, groups.values()) for r in g]
        else:
            rows = [r for g in groups.values() for r in run_group(g)]
    finally:
        train.unpersist()
        eval_.unpersist()
    if base:
        return spark.read.schema(RESULT_SCHEMA).parquet(*[part(c) for c in cells]).select(*names)
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def select_best(results: DataFrame, metric: str = "eval_loss", mode: str = "min") -> DataFrame:
    """The winning cell. ``min``: smallest metric; ``max``: largest.
    Ties go to the smaller rank, then grid order (for ``max`` too - the
    reference also reverses the tie-break there; we do not). NaN/null
    metrics never win."""
    if mode not in ("min", "max"):
        raise ValueError(f"selection mode must be 'min' or 'max', got {mode!r}")
    ok = results.filter(F.col(metric).isNotNull() & ~F.isnan(F.col(metric)))
    m = F.col(metric).asc() if mode == "min" else F.col(metric).desc()
    return ok.orderBy(m, F.col("rank").asc(), F.col("cell_no").asc()).limit(1)


def comparison_table(results: DataFrame, metric: str = "eval_loss", mode: str = "min") -> DataFrame:
    """Cells ranked by the chosen metric (NaN last), the metric at 4
    decimals, the winner flagged by ``cell_no``. The results frame is one
    row per cell, so the ranking window is small by construction."""
    best = select_best(results, metric, mode).select(F.col("cell_no").alias("_best"))
    m = F.col(metric).asc_nulls_last() if mode == "min" else F.col(metric).desc_nulls_last()
    nan_last = F.coalesce(F.isnan(F.col(metric)), F.lit(True)).asc()   # NaN/null after every number
    w = Window.orderBy(nan_last, m, F.col("rank").asc(), F.col("cell_no").asc())
    return (results.join(F.broadcast(best), F.col("cell_no") == F.col("_best"), "left")
                   .select(F.row_number().over(w).alias("position"), "cell_no", "rank", "learning_rate", "scheduler",
                           F.format_string("%.4f", F.col(metric)).alias(f"{metric}_text"),
                           "runtime_seconds", F.col("_best").isNotNull().alias("selected")))


def markdown_table(table: DataFrame, metric: str = "eval_loss") -> str:
    """The ranked table as markdown, one line a cell. Lines are built as a
    column; the winner's position is set in bold."""
    shown = {"position": F.col("position").cast("string"), "rank": F.col("rank").cast("string"),
             "learning rate": F.col("learning_rate").cast("string"), "schedule": F.col("scheduler"),
             metric: F.col(f"{metric}_text"), "seconds": F.col("runtime_seconds").cast("string")}
    shown["position"] = F.when(F.col("selected"), F.format_string("**%s**", shown["position"])).otherwise(shown["position"])
    cells = F.concat_ws(" | ", *[F.coalesce(v, F.lit("-")) for v in shown.values()])
    body = table.select("position", F.format_string("| %s |", cells).alias("line")).orderBy("position")
    head = [f"| {' | '.join(shown)} |", "|" + " --- |" * len(shown)]
    return "\n".join(head + [r["line"] for r in body.collect()]) + "\n"
