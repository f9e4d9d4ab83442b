"""Cuts, winners and first rows found by keys alone: exactness, jobs, plans."""
import contextlib
import hashlib
import io
import random
import uuid

import pytest
from pyspark.sql import functions as F

from quire.operators.dedupe import dedupe_keep_first
from quire.operators.split import find_cut, keys_at_positions, label_split
from quire.plans import prepare as P
from quire.queries import SPARK_QUERIES
from quire.sources.readers import doc_instructions, first_in_order, synthetic_instructions

SF1 = "/root/testdata/sf0.1"
SF001 = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def jobs_of(spark, f):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        got = f()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return got, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def sha(x):
    return hashlib.sha256(str(x).encode()).hexdigest()


def test_a_cut_is_a_handful_of_jobs(spark, tmp_path):
    keys = spark.read.parquet(f"{SF1}/documents.parquet").select(F.sha2(F.col("doc_id").cast("string"), 256).alias("split_rank"))
    keys.repartition(4).write.parquet(str(tmp_path / "k"))
    df = spark.read.parquet(str(tmp_path / "k"))
    info, n = jobs_of(spark, lambda: find_cut(df, 100, 500))
    rows = sorted(r[0] for r in df.collect())
    assert (info["n"], info["eval_n"], info["train_n"]) == (len(rows), 100, 500)
    assert (info["cut_eval"], info["cut_train"]) == (rows[99], rows[599])
    assert n <= 3


@pytest.mark.parametrize("width", [1, 2, 4])
def test_positions_among_repeated_and_crowded_keys(spark, width):
    rng = random.Random(width)
    keys = [sha(1)] * 500 + [sha(2)] * 3 + [sha(rng.random()) for _ in range(700)]
    keys += [sha(9)[:63] + c for c in "0123456789abcdef"] + [sha(9)[:40] + sha(k)[:24] for k in range(50)]     # long common prefixes
    rng.shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)] * 5, "k string").repartition(4)
    keys.sort()
    pos = sorted(rng.sample(range(1, len(keys) + 1), 40)) + [1, len(keys), len(keys) + 1]
    got = keys_at_positions(df, "k", pos, width=width)
    assert got == {p: keys[p - 1] if p <= len(keys) else None for p in pos}


def test_all_keys_equal_end_at_once(spark):
    df = spark.createDataFrame([(sha(5),)] * 200, "k string")
    got, n = jobs_of(spark, lambda: keys_at_positions(df, "k", [1, 7, 150, 200]))
    assert set(got.values()) == {sha(5)} and n <= 2


def test_no_keys(spark):
    df = spark.createDataFrame([], "split_rank string, row_id long")
    info = find_cut(df, 10, 10)
    assert info["n"] == 0 and label_split(df, info).count() == 0


def test_winners_without_sorting_texts(spark, tmp_path):
    rows = [(i, ("HOT text " * 40) if i % 3 == 0 else f"row {i} " * 20) for i in range(600)]
    spark.createDataFrame(rows, "row_id long, text string").repartition(5).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).withColumn("content_hash", F.sha2("text", 256))
    out = dedupe_keep_first(df, "content_hash", ("row_id",))
    plan = plan_of(out)
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan and "Sort [" not in plan
    assert "ShuffledHashJoin" in plan and "HashAggregate" in plan
    got = {r.row_id: (r.text, r.n_copies) for r in out.collect()}
    assert got == {i: (t, 200 if i == 0 else 1) for i, t in rows if i % 3 or i == 0}
    narrow = plan_of(dedupe_keep_first(df.select("row_id", "content_hash")))
    assert "Join" not in narrow and "SortAggregate" not in narrow


def test_ties_nulls_and_repeated_rows(spark):
    rows = [(5, "b", "h1"), (5, "a", "h1"), (5, "a", "h1"), (7, "c", "h1"),          # ties of the order
            (1, "x", "h2"), (1, "x", "h2"), (1, "x", "h2"),                          # one row three times
            (None, "n1", "h3"), (3, "n2", "h3"), (None, "n1", "h4"), (2, None, "h5"), (2, None, "h5"), (9, "q", None), (8, "q", None)]
    df = spark.createDataFrame(rows, "row_id long, text string, content_hash string").repartition(3)
    got = {r.content_hash: (r.row_id, r.text, r.n_copies) for r in dedupe_keep_first(df).collect()}
    assert got["h1"][0] == 5 and got["h1"][1] in ("a", "b") and got["h1"][2] == 4
    assert got == {"h1": got["h1"], "h2": (1, "x", 3), "h3": (None, "n1", 2), "h4": (None, "n1", 1), "h5": (2, None, 2), None: (8, "q", 2)}
    again = {r.content_hash: (r.row_id, r.text, r.n_copies) for r in dedupe_keep_first(df.repartition(7)).collect()}
    assert again == got
    two = dedupe_keep_first(df.withColumn("k", F.lit("z")), "content_hash", ("k", "row_id")).collect()
    assert {r.content_hash: (r.row_id, r.text, r.n_copies) for r in two} == got
    words = dedupe_keep_first(df, "content_hash", ("text",)).collect()               # an order of strings
    assert {r.content_hash: (r.text, r.n_copies) for r in words} == {"h1": ("a", 4), "h2": ("x", 3), "h3": ("n1", 2), "h4": ("n1", 1),
                                                                      "h5": (None, 2), None: ("q", 2)}
    assert {r.content_hash: r.n_copies for r in dedupe_keep_first(df, "content_hash", ()).collect()} == {k: v[2] for k, v in got.items()}
    assert dedupe_keep_first(df.limit(0)).count() == 0


def test_texts_are_joined_to_the_split_alone(spark, monkeypatch):
    raw = synthetic_instructions(spark, 600, 42)
    cfg = P.PrepConfig(eval_holdout_size=40, subsample_size=200)
    splits, staged, _ = P.plan_splits(raw, cfg)
    assert "text" not in staged.columns and staged.count() == 501
    small = P.with_text(raw, splits, cfg)
    assert "BroadcastHashJoin" in plan_of(small)
    monkeypatch.setattr(P, "KEY_ROW_BYTES", 1 << 30)
    hashed = P.with_text(raw, splits, cfg)
    assert "ShuffledHashJoin" in plan_of(hashed) and "SortAggregate" not in plan_of(hashed)
    cols = ["row_id", "text", "content_hash", "n_copies", "split"]
    assert sorted(map(tuple, small.select(cols).collect())) == sorted(map(tuple, hashed.select(cols).collect()))
    assert small.count() == 240


def test_first_rows_read_texts_under_a_filter(spark):
    raw = doc_instructions(spark, SF1)
    got = first_in_order(raw, 50)
    plan = plan_of(got)
    assert "LessThanOrEqual(doc_id" in plan and "TakeOrderedAndProject" in plan
    assert [r.row_id for r in got.collect()] == sorted(r[0] for r in raw.select("row_id").collect())[:50]
    df = spark.createDataFrame([(None, "a"), (3, "b"), (None, "c"), (1, "d"), (1, "e")], "row_id long, t string")
    assert [r.row_id for r in first_in_order(df, 3).collect()] == [None, None, 1]
    assert [r.row_id for r in first_in_order(df, 1).collect()] == [None]
    assert first_in_order(df, 10).count() == 5 and first_in_order(df.limit(0), 10).count() == 0


def test_queries_of_keys_read_no_text_again(spark):
    for name in ("seeded_split", "take_first", "batch_plan"):
        assert "regexp" not in plan_of(SPARK_QUERIES[name](spark, SF001)), name
