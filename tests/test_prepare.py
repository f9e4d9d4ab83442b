"""Data preparation: golden counts, idempotence, disjointness, exact cuts."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quire.operators.split import keys_at_positions, split_sizes, with_positions
from quire.plans.prepare import PrepConfig, build_splits, load_splits, prepare_dataset
from quire.sources import store
from quire.sources.readers import synthetic_instructions

SMOKE = PrepConfig(seed=42, eval_holdout_size=40, subsample_size=200, smoke_test=True, dataset_id="synthetic")


def test_synthetic_golden_counts_and_idempotence(spark, tmpdir_path):
    raw = synthetic_instructions(spark, 600, 42)
    m1 = prepare_dataset(spark, raw, tmpdir_path, SMOKE, force=True)
    assert m1["cache_hit"] is False
    assert m1["counts"] == {"raw": 600, "after_dedupe": 501, "train": 200, "eval_holdout": 40}
    assert m1["disjointness"] == {"train_unique_hashes": 200, "eval_unique_hashes": 40, "intersection": 0}
    m2 = prepare_dataset(spark, raw, tmpdir_path, SMOKE)
    assert m2["cache_hit"] is True and m2["counts"] == m1["counts"]
    tr, ev = load_splits(spark, tmpdir_path, raw, SMOKE)
    assert tr.count() == 200 and ev.count() == 40
    # a changed setting is a different fingerprint, never the old cache
    m3 = prepare_dataset(spark, raw, tmpdir_path, PrepConfig(seed=7, eval_holdout_size=40, subsample_size=200, dataset_id="synthetic"))
    assert m3["cache_hit"] is False
    # force writes a new version; the newest complete one is served
    m4 = prepare_dataset(spark, raw, tmpdir_path, SMOKE, force=True)
    assert m4["path"].endswith("/v2")
    # a frame that reads no files must say what it is; files say it themselves
    with pytest.raises(ValueError):
        prepare_dataset(spark, raw, tmpdir_path, PrepConfig())
    from quire.sources.readers import documents_as_instructions
    for k, n in enumerate((50, 30)):
        spark.range(n).selectExpr("id AS doc_id", f"concat('t{k} ', id) AS text").write.parquet(f"{tmpdir_path}/in{k}")
        m = prepare_dataset(spark, documents_as_instructions(spark.read.parquet(f"{tmpdir_path}/in{k}")), tmpdir_path, PrepConfig())
        assert m["cache_hit"] is False and m["counts"]["raw"] == n


def _split_ids(spark, df, seed, holdout, size):
    splits, _, info = build_splits(df, PrepConfig(seed=seed, eval_holdout_size=holdout, subsample_size=size))
    return {r.row_id: r.split for r in splits.select("row_id", "split").collect()}, info


def test_split_matches_brute_force_and_is_partition_independent(spark):
    raw = synthetic_instructions(spark, 600, 42)
    got, info = _split_ids(spark, raw, 42, 40, 200)
    # brute force in Python: keep-first by normalised hash, order by sha256(seed:hash)
    rows = sorted(raw.collect(), key=lambda r: r.row_id)
    first = {}
    for r in rows:
        text = f"### Instruction:\n{r.instruction.strip()}\n\n### Response:\n{r.output.strip()}"
        h = hashlib.sha256(" ".join(text.lower().split()).encode()).hexdigest()
        first.setdefault(h, r.row_id)
    order = sorted(first.items(), key=lambda kv: hashlib.sha256(f"42:{kv[0]}".encode()).hexdigest())
    expect = {rid: "eval" for _, rid in order[:40]} | {rid: "train" for _, rid in order[40:240]}
    assert got == expect
    again, _ = _split_ids(spark, raw.repartition(7), 42, 40, 200)
    assert again == got
    other, _ = _split_ids(spark, raw, 43, 40, 200)
    assert other != got


@pytest.mark.parametrize("n", [0, 1, 4, 5])
def test_tiny_inputs(spark, n):
    raw = synthetic_instructions(spark, n, 1).filter(F.col("instruction").contains("case") | (F.lit(n) < 6))
    got, info = _split_ids(spark, raw, 42, 1000, 50000)
    m = len(got)
    e, t = split_sizes(info["n"], 1000, 50000)
    assert sum(v == "eval" for v in got.values()) == e
    assert sum(v == "train" for v in got.values()) == t
    if info["n"] >= 1:
        assert e == 1
    assert m == info["n"]


def test_holdout_zero(spark):
    raw = synthetic_instructions(spark, 60, 1)
    got, _ = _split_ids(spark, raw, 42, 0, 10)
    assert "eval" not in got.values() and len(got) == 10


def test_keys_at_positions_refines_exactly(spark):
    rnd = random.Random(3)
    keys = sorted({hashlib.sha256(str(rnd.random()).encode()).hexdigest() for _ in range(3000)})
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    pos = [1, 17, 1500, 2999, 3000, 3001]
    got = keys_at_positions(df, "k", pos, width=1)
    assert got == {p: (keys[p - 1] if p <= len(keys) else None) for p in pos}
    p = {r.k: r.pos for r in with_positions(df, "k", width=2).collect()}
    assert all(p[k] == i for i, k in enumerate(keys))


def test_snapshots_numeric_order_and_restore(spark, tmpdir_path):
    raw = synthetic_instructions(spark, 120, 42)
    m = prepare_dataset(spark, raw, f"{tmpdir_path}/prep", SMOKE)
    vdir = m["path"]
    snaps = f"{tmpdir_path}/snaps"
    assert store.latest_snapshot(spark, snaps) is None
    store.snapshot(spark, vdir, snaps, 9)
    store.snapshot(spark, vdir, snaps, 10)
    assert store.latest_snapshot(spark, snaps) == 10
    with pytest.raises(FileExistsError):           # a number is never reused
        store.snapshot(spark, vdir, snaps, 10)
    assert store.latest_snapshot_path(spark, snaps).endswith("/snapshot=10")
    tr10, ev10 = store.load_snapshot(spark, snaps)
    assert tr10.count() + ev10.count() == spark.read.parquet(f"{vdir}/data").count()
    assert store.snapshot(spark, f"{tmpdir_path}/nothing", snaps, 11) is None   # no manifest: no-op
    target = f"{tmpdir_path}/restored"
    assert store.restore(spark, f"{snaps}/snapshot=10", target) is True
    assert store.restore(spark, f"{snaps}/snapshot=10", target) is False      # already present
    assert spark.read.parquet(f"{target}/data").count() == spark.read.parquet(f"{vdir}/data").count()


def test_size_report(spark, tmpdir_path):
    import os
    with open(f"{tmpdir_path}/a.bin", "wb") as fh:
        fh.write(b"x" * 1000)
    os.makedirs(f"{tmpdir_path}/sub")
    with open(f"{tmpdir_path}/sub/b.bin", "wb") as fh:
        fh.write(b"y" * (3 << 20))
    r = store.size_report(spark, tmpdir_path).first()
    assert (r.files, r.bytes, r.mb) == (2, 1000 + (3 << 20), round((1000 + (3 << 20)) / 2 ** 20, 2))
    assert store.compression_ratio(13.5, 4.07) == 3.32


def test_prompt_keyed_split_keeps_prompts_on_one_side(spark):
    # 40 prompts, each with 3 different answers
    rows = [(p * 10 + a, f"question {p}", "", f"answer {a} to {p}") for p in range(40) for a in range(3)]
    df = spark.createDataFrame(rows, "row_id long, instruction string, input string, output string")
    cfg = PrepConfig(seed=1, eval_holdout_size=5, subsample_size=1000, split_key="prompt")
    splits, _, info = build_splits(df, cfg)
    got = splits.select("row_id", "split").collect()
    sides = {}
    for r in got:
        sides.setdefault(r.row_id // 10, set()).add(r.split)
    assert all(len(s) == 1 for s in sides.values())
    assert info["n"] == 40 and info["eval_n"] == 5 and info["train_n"] == 35
    assert sum(1 for s in sides.values() if s == {"eval"}) == 5 and len(got) == 120


def test_batch_plan_and_shards(spark, tmpdir_path):
    from quire.operators.split import batch_plan, write_shards
    raw = synthetic_instructions(spark, 600, 42)
    splits, _, _ = build_splits(raw, SMOKE)
    train = splits.filter(F.col("split") == "train")
    plan, info = batch_plan(train, batch_size=8, grad_accum=4, epochs=1)
    assert info == {"rows": 200, "effective_batch": 32, "steps_per_epoch": 7, "total_steps": 7}
    rows = sorted(plan.collect(), key=lambda r: r.pos)
    assert [r.pos for r in rows] == list(range(200))
    assert [r.split_rank for r in rows] == sorted(r.split_rank for r in rows)
    assert rows[-1].micro_batch == 24 and rows[-1].step == 6
    assert batch_plan(train, 8, 4, max_steps=3)[1]["total_steps"] == 3
    write_shards(plan, f"{tmpdir_path}/shards", 64)
    got = spark.read.parquet(f"{tmpdir_path}/shards").groupBy("shard").count().orderBy("shard").collect()
    assert [(r.shard, r["count"]) for r in got] == [(0, 64), (1, 64), (2, 64), (3, 8)]


def test_positions_do_not_depend_on_partitioning(spark):
    """A prompt with many answers: ranks tie, the content hash orders them."""
    from quire.operators.split import take_first, training_steps
    rows = [(f"{p:064x}", hashlib.sha256(f"{p}/{a}".encode()).hexdigest()) for p in range(6) for a in range(400 if p == 3 else 5)]
    want = {h: i for i, (_, h) in enumerate(sorted(rows))}
    for parts in (1, 5):
        d = spark.createDataFrame(rows, "split_rank string, content_hash string").repartition(parts)
        assert {r.content_hash: r.pos for r in with_positions(d).collect()} == want
        assert [r.content_hash for r in take_first(d, 50).collect()] == [h for h, i in sorted(want.items(), key=lambda x: x[1])[:50]]
        pos = keys_at_positions(d, "split_rank", [1, 16, 300, len(rows)])
        assert pos == {k: sorted(rows)[k - 1][0] for k in (1, 16, 300, len(rows))}
    steps = training_steps(d, 8, 4, epochs=2).collect()
    assert len(steps) == 2 * len(rows) and max(r.step for r in steps) == 2 * -(-len(rows) // 32) - 1
    assert max(r.step for r in training_steps(d, 8, 4, max_steps=3).collect()) == 2


def test_incomplete_snapshot_is_ignored(spark, tmpdir_path):
    raw = synthetic_instructions(spark, 60, 42)
    m = prepare_dataset(spark, raw, f"{tmpdir_path}/prep", SMOKE)
    snaps = f"{tmpdir_path}/snaps"
    store.snapshot(spark, m["path"], snaps, 9)
    # a crashed snapshot: data present, manifest never written
    spark.read.parquet(f"{m['path']}/data").write.parquet(f"{snaps}/snapshot=12/data")
    assert store.latest_snapshot(spark, snaps) == 9
    # and an incomplete published version is never served
    spark.read.parquet(f"{m['path']}/data").write.parquet(m["path"].rsplit("/", 1)[0] + "/v7/data")
    assert store.latest_complete(spark, m["path"].rsplit("/", 1)[0]) == m["path"]


def test_config_validation():
    with pytest.raises(ValueError):
        PrepConfig(split_key="instruction")
    with pytest.raises(ValueError):
        PrepConfig.from_dict({"seed": 1, "unknown_key": 2})
    assert PrepConfig.from_dict({"seed": 7}).seed == 7
    assert PrepConfig(seed=1).fingerprint() != PrepConfig(seed=2).fingerprint()


def test_a_shard_is_one_file_however_the_rows_are_dealt(spark, tmpdir_path):
    from quire.operators.split import write_shards
    plan = spark.range(600).select(F.col("id").alias("row_id"), F.col("id").alias("pos")).repartition(7, F.xxhash64("id"))
    write_shards(plan, f"{tmpdir_path}/one_file", 64)
    shards = spark.read.parquet(f"{tmpdir_path}/one_file")
    assert shards.count() == 600 and shards.where("shard <> pos div 64").isEmpty()
    assert len(shards.inputFiles()) == 10
