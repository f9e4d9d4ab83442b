"""The data-preparation job: render -> drop blank -> hash -> keep-first dedupe
-> seeded order -> exact eval/train cut -> audit -> publish with manifest."""

from __future__ import annotations

import dataclasses
import functools
import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quire.functions.templates import split_prompt_reference
from quire.functions.text import content_hash, seeded_rank
from quire.operators.audit import manifest_counts
from quire.operators.dedupe import first_rows, rows_of, with_pick
from quire.operators.render import drop_blank, render, with_content_hash
from quire.operators.split import find_cut, label_split
from quire.session import size_in_bytes, stage, staging, unstage
from quire.sources import store

KEY_ROW_BYTES = 400              # a row of keys (two hashes, order, counts) in a hash table, generously


@dataclass(frozen=True)
class PrepConfig:
    """Job settings. Unknown keys in :meth:`from_dict` raise."""
    seed: int = 42
    eval_holdout_size: int = 1000
    subsample_size: int = 50000
    template: str = "plain"
    split_key: str = "text"          # "text" (default) or "prompt" (D7 opt-in)
    dataset_id: str = ""
    domain: str = ""
    model_for_template: str = ""
    smoke_test: bool = False

    def __post_init__(self):
        if self.split_key not in ("text", "prompt"):
            raise ValueError(f"split_key must be 'text' or 'prompt', got {self.split_key!r}")
        if self.eval_holdout_size < 0 or self.subsample_size < 0:
            raise ValueError("eval_holdout_size and subsample_size must be >= 0")

    @classmethod
    def from_dict(cls, d: dict) -> "PrepConfig":
        names = {f.name for f in dataclasses.fields(cls)}
        unknown = sorted(set(d) - names)
        if unknown:
            raise ValueError(f"unknown settings: {unknown}")
        return cls(**d)

    def fingerprint(self, source: str = "", order_cols=("row_id",)) -> str:
        """Settings, source and session case mapping that change the split; a
        different one never hits the cache."""
        keys = ("seed", "eval_holdout_size", "subsample_size", "template", "split_key", "dataset_id")
        blob = json.dumps([{k: getattr(self, k) for k in keys}, source, list(order_cols)], sort_keys=True)
        return hashlib.sha256(blob.encode()).hexdigest()[:16]


def source_identity(instr: DataFrame, cfg: PrepConfig) -> str:
    """What the cache may rely on: the input files with sizes and times, or,
    for a frame that reads no files, the caller's ``dataset_id``."""
    spark = instr.sparkSession
    case = spark.conf.get("spark.sql.icu.caseMappings.enabled", "true")
    files = instr.inputFiles()
    if not files and not cfg.dataset_id:
        raise ValueError("a frame that reads no files needs a dataset_id to be cached under")
    seen = store.files_digest(spark, files) if files else ""
    return hashlib.sha256(json.dumps([seen, case]).encode()).hexdigest()


def _hashed(instr: DataFrame, cfg: PrepConfig, order_cols) -> DataFrame:
    """Rendered rows with their content hash, blank ones dropped."""
    return with_pick(with_content_hash(drop_blank(render(instr, cfg.template, keep=tuple(order_cols)))), ["text"])


def dedupe_stage(instr: DataFrame, cfg: PrepConfig, order_cols=("row_id",)) -> DataFrame:
    """The first row of every text by its keys alone: order columns, ``content_hash``,
    ``n_copies``, ``split_rank`` (and ``prompt_hash`` where it makes the rank), staged
    under the shared checkpoint folder. No text is moved or written.

    Each staged file is sorted by ``split_rank``: row-group statistics then let the
    ``split_rank <= cut`` filters skip everything past the cut."""
    order_cols = list(order_cols)
    rows = _hashed(instr, cfg, order_cols)
    if cfg.split_key == "prompt":
        rows = rows.withColumn("prompt_hash", content_hash(split_prompt_reference("text")["prompt"]))
    rows = rows.drop("text")
    first = first_rows(rows, "content_hash", order_cols)
    if cfg.split_key == "prompt":
        first = rows_of(rows, first, "content_hash", order_cols)
    ranked = first.withColumn("split_rank", seeded_rank(cfg.seed, "prompt_hash" if cfg.split_key == "prompt" else "content_hash"))
    return stage(ranked.sortWithinPartitions("split_rank"), "dedupe")


def cut(staged: DataFrame, cfg: PrepConfig) -> tuple[DataFrame, dict]:
    """Exact eval/train cut on the staged table; with prompts, which repeat, on the
    distinct prompts (staged once), so sizes are prompt counts."""
    keys = staged
    if cfg.split_key == "prompt":
        keys = stage(staged.select("split_rank").distinct(), "prompt-keys")
    info = find_cut(keys, cfg.eval_holdout_size, cfg.subsample_size)
    if keys is not staged:
        unstage(keys)
    return label_split(staged, info), info


def plan_splits(instr: DataFrame, cfg: PrepConfig, order_cols=("row_id",)) -> tuple[DataFrame, DataFrame, dict]:
    """(splits, staged, info) by keys alone: who is in which split, without texts."""
    staged = dedupe_stage(instr, cfg, order_cols)
    splits, info = cut(staged, cfg)
    return splits, staged, info


def with_text(instr: DataFrame, splits: DataFrame, cfg: PrepConfig, order_cols=("row_id",)) -> DataFrame:
    """The rows of :func:`plan_splits` with their texts: those rows of the source are
    rendered again. The keys of a split that the engine's broadcast limit holds are
    broadcast: rows with other orders are left before anything is rendered, and no text
    is shuffled. More keys are hashed partition by partition."""
    order_cols, n = list(order_cols), splits.count()
    small = n * KEY_ROW_BYTES <= size_in_bytes(instr.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))
    if small:
        keys = splits.select(*[F.col(c).alias(f"_k_{c}") for c in order_cols])
        wanted = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in order_cols]
        instr = instr.join(F.broadcast(keys), functools.reduce(lambda a, b: a & b, wanted), "left_semi")
    return rows_of(_hashed(instr, cfg, order_cols), splits, "content_hash", order_cols, small)


def build_splits(instr: DataFrame, cfg: PrepConfig, order_cols=("row_id",)) -> tuple[DataFrame, DataFrame, dict]:
    splits, staged, info = plan_splits(instr, cfg, order_cols)
    return with_text(instr, splits, cfg, order_cols), staged, info


def prepare_dataset(spark: SparkSession, instr: DataFrame, root: str, cfg: PrepConfig | None = None,
                    force: bool = False, order_cols=("row_id",)) -> dict:
    """Idempotent prepare: returns the manifest; a complete cached version
    with the same settings and source is a cache hit (``cache_hit=True``)."""
    cfg = cfg or PrepConfig()
    mark = cfg.fingerprint(source_identity(instr, cfg), order_cols)
    base = f"{root.rstrip('/')}/{mark}"
    if not force:
        v = store.latest_complete(spark, base)
        if v:
            m = store.read_manifest(spark, v)
            m["cache_hit"] = True
            return m
    with staging(spark):              # what was published reads nothing of it
        source = Observation("source")            # counted by the pass that finds the winners
        splits, staged, _ = plan_splits(instr.observe(source, F.count(F.lit(1)).alias("input_rows")), cfg, order_cols)
        # nothing kept: a frame known to be empty is not run at all and observes nothing
        input_rows = int(instr.count() if staged.isEmpty() else source.get["input_rows"])
        splits = with_text(instr, splits, cfg, order_cols)
        out_cols = [c for c in ("row_id", "text", "content_hash", "split_rank", "n_copies", "split") if c in splits.columns]

        def manifest_fn(published: DataFrame) -> dict:
            counts = manifest_counts(staged, published)
            if counts["disjointness"]["intersection"]:
                raise AssertionError(f"train/eval overlap: {counts['disjointness']['intersection']}")
            # --- fixed values: the manifest's field names
            return {"dataset_id": cfg.dataset_id, "domain": cfg.domain,
                    "model_for_template": cfg.model_for_template or cfg.template,
                    "smoke_test": cfg.smoke_test, "seed": cfg.seed,
                    "fingerprint": mark, "input_rows": input_rows,
                    **counts, "cache_hit": False}

        vdir, manifest = store.publish_splits(splits.select(*out_cols), manifest_fn, base)
    manifest["path"] = vdir
    return manifest


def load_splits(spark: SparkSession, root: str, instr: DataFrame, cfg: PrepConfig | None = None,
                order_cols=("row_id",)) -> tuple[DataFrame, DataFrame]:
    """(train, eval) of ``instr`` as prepared under ``root``; prepared first where absent."""
    cfg = cfg or PrepConfig()
    base = f"{root.rstrip('/')}/{cfg.fingerprint(source_identity(instr, cfg), order_cols)}"
    if not store.cache_exists(spark, base):
        prepare_dataset(spark, instr, root, cfg, order_cols=order_cols)
    return store.load_split_data(spark, store.latest_complete(spark, base))
