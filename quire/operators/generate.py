"""User functions over rows: ``map_rows`` (U1) and ``batch_generate``.

Both run user Python per partition through Arrow batches (``mapInPandas``);
a generator is built once per task, as a model would be loaded once.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import truncate_ws_tokens
from quire.session import ship_package

PRED_SCHEMA = "example_id string, system string, prediction string, n_tokens int, seconds double"

# one generator per Python worker: built on first use, replaced (not added to)
# when another call's arrives, so a worker never holds two models
_RESIDENT: dict = {"key": None, "gen": None}


def _resident_generator(key, make_generator):
    """The worker's generator. ``key`` names the call that asked for it - never
    the factory, since two closures of one function have one name."""
    if _RESIDENT["key"] != key:
        _RESIDENT["key"], _RESIDENT["gen"] = None, None    # release the previous model first
        _RESIDENT["gen"] = make_generator()
        _RESIDENT["key"] = key
    return _RESIDENT["gen"]


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema: str) -> DataFrame:
    """Apply ``fn(row_dict) -> dict`` to every row; the output has only
    ``schema``'s columns (input columns are dropped). Prefer Column
    expressions when they can say the same thing."""
    ship_package(df.sparkSession)
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def run(batches):
        for pdf in batches:
            out = [fn(r) for r in pdf.to_dict("records")]
            yield pd.DataFrame(out, columns=names)

    return df.mapInPandas(run, schema)


def batch_generate(df: DataFrame, make_generator: Callable[[], Callable[[pd.DataFrame, int], list]],
                   system: str, max_new_tokens: int = 64,
                   seconds_fn: Callable[[int, float], float] | None = None,
                   id_col: str = "example_id", max_prompt_tokens: int | None = 512) -> DataFrame:
    """One completion per prompt row, ``(example_id, system, prediction,
    n_tokens, seconds)``.

    ``make_generator()`` runs once per Python worker and call of this function
    (the generator of another call replaces it) and returns ``gen(batch,
    max_new_tokens) -> list[str]`` (``batch`` is a pandas frame of the
    columns listed in ``make_generator.columns``, default ``("prompt",)`` -
    only those cross into Python). ``n_tokens`` counts whitespace tokens of the prediction;
    ``seconds`` is the batch wall time shared by its rows unless
    ``seconds_fn(n_tokens, wall)`` says otherwise (e.g. a fixed cost model
    for reproducible tests). Write the result once (parquet) before scoring
    so scoring never generates again. Prompts are cut to ``max_prompt_tokens``
    whitespace tokens before they leave the JVM (``None``: whole). The id column
    keeps its type.
    """
    ship_package(df.sparkSession)
    key = (system, uuid.uuid4().hex)
    id_type = df.schema[id_col].dataType.simpleString()
    cols = [c for c in getattr(make_generator, "columns", ("prompt",)) if c != id_col]
    shown = {c: F.col(c) for c in cols}
    if "prompt" in shown and max_prompt_tokens is not None:
        shown["prompt"] = truncate_ws_tokens("prompt", max_prompt_tokens)["text"]
    # the id crosses as text, so a nullable number keeps its value
    df = df.select(F.col(id_col).cast("string").alias(id_col), *[v.alias(k) for k, v in shown.items()])

    def run(batches):
        gen = _resident_generator(key, make_generator)
        for pdf in batches:
            t0 = time.perf_counter()
            preds = list(gen(pdf, max_new_tokens))
            wall = time.perf_counter() - t0
            preds = [("" if p is None else str(p)).strip() for p in preds]
            ntok = [len(p.split()) for p in preds]
            share = wall / max(len(preds), 1)
            secs = [float(seconds_fn(n, share)) if seconds_fn else share for n in ntok]
            yield pd.DataFrame({"example_id": pdf[id_col], "system": system,
                                "prediction": preds, "n_tokens": pd.Series(ntok, dtype="int32"),
                                "seconds": secs})

    out = df.mapInPandas(run, PRED_SCHEMA)
    return out.withColumn("example_id", F.col("example_id").cast(id_type))


# --- deterministic stand-in generators (tests, benchmarks) -------------------
def echo_prompt_tail():
    """Stand-in 'base' model: the last words of the prompt."""
    def gen(batch: pd.DataFrame, k: int):
        return [" ".join(str(p).split()[-k:]) for p in batch["prompt"]]
    return gen


def reference_head():
    """Stand-in 'tuned' model: the first words of the reference."""
    def gen(batch: pd.DataFrame, k: int):
        return [" ".join(str(r).split()[:k]) for r in batch["reference"]]
    return gen


reference_head.columns = ("reference",)


def fixed_cost(n_tokens: int, wall: float) -> float:
    """Reproducible timing: a quarter second per generated token."""
    return 0.25 * n_tokens
