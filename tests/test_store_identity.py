"""Source identity, manifest counts, file copies, staging scopes, sweep identity."""
import functools
import glob
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from quire.functions.porter import STEP2, STEP3, STEP4, stem
from quire.functions.porter_sql import stem_table
from quire.functions.text import truncate_ws_tokens
from quire.operators import sweep as W
from quire.plans.prepare import PrepConfig, prepare_dataset, source_identity
from quire.queries import SPARK_QUERIES
from quire.session import checkpoint_root, scratch_path, size_in_bytes, stage, staging, write_result
from quire.sources import store
from quire.sources.readers import documents_as_instructions, synthetic_instructions

SF001 = "/root/testdata/sf0.001"


def test_identity_of_many_files(spark, tmp_path):
    src = str(tmp_path / "in put")
    spark.range(400).selectExpr("id AS doc_id", "concat('t ', id) AS text").repartition(60).write.parquet(src)
    files = sorted(glob.glob(f"{src}/*.parquet"))
    assert len(files) > 40

    def seen(paths=(src,)):
        return source_identity(documents_as_instructions(spark.read.parquet(*paths)), PrepConfig())

    one = seen()
    assert one == seen()
    notes = tmp_path / "in put" / "notes.txt"
    notes.write_text("not a part of the table")
    assert seen(files[:30]) != one and seen(files) == one               # only the table's files count
    notes.unlink()
    os.utime(files[7], (1, 1))
    assert seen() != one
    assert seen() == seen() and seen(files[:7]) == seen(files[:7])


def test_input_rows_come_from_the_writing_pass(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.range(50).selectExpr("id AS doc_id", "if(id % 10 = 0, ' ', concat('t ', id % 20)) AS text").repartition(3).write.parquet(src)
    m = prepare_dataset(spark, documents_as_instructions(spark.read.parquet(src)), str(tmp_path / "p"), PrepConfig(template="plain"))
    assert m["input_rows"] == 50 and m["counts"]["raw"] == 50
    for key in ("text", "prompt"):
        cfg = PrepConfig(dataset_id="empty", split_key=key)
        none = prepare_dataset(spark, synthetic_instructions(spark, 0, 1), str(tmp_path / "e"), cfg)
        assert none["input_rows"] == 0 and none["counts"] == {"raw": 0, "after_dedupe": 0, "train": 0, "eval_holdout": 0}
        assert [d.count() for d in store.load_split_data(spark, none["path"])] == [0, 0]
        snap = store.snapshot(spark, none["path"], str(tmp_path / f"snaps-{key}"), 1)
        assert [d.count() for d in store.load_split_data(spark, snap)] == [0, 0]


def test_sizes_of_settings():
    assert [size_in_bytes(x) for x in ("10485760b", "256k", "10MB", "-1", "0", "1g")] == [10485760, 262144, 10 << 20, -1, 0, 1 << 30]


def sums(root):
    return {os.path.relpath(f, root): hashlib.sha256(open(f, "rb").read()).hexdigest()
            for f in glob.glob(f"{root}/data/**/*.parquet", recursive=True)}


def test_copies_are_the_same_bytes(spark, tmp_path):
    raw = synthetic_instructions(spark, 300, 42)
    v = prepare_dataset(spark, raw, str(tmp_path / "p"), PrepConfig(dataset_id="s", eval_holdout_size=10, subsample_size=100))["path"]
    snap = store.snapshot(spark, v, str(tmp_path / "snaps"), 3)
    assert sums(v) == sums(snap) and len(sums(v)) >= 2
    # what a killed copy left - half a file, a file of another set, no manifest - is gone after the next one
    os.remove(f"{snap}/{store.MANIFEST}")
    name = sorted(sums(v))[0]
    with open(f"{snap}/{name}", "wb") as f:
        f.write(b"half")
    with open(f"{snap}/data/split=train/other.parquet", "wb") as f:
        f.write(b"x")
    assert store.latest_snapshot(spark, str(tmp_path / "snaps")) is None
    assert store.snapshot(spark, v, str(tmp_path / "snaps"), 3) == snap and sums(v) == sums(snap)
    assert store.restore(spark, snap, str(tmp_path / "back")) and sums(f"{tmp_path}/back") == sums(v)
    assert not [f for _, _, fs in os.walk(snap) for f in fs if f.startswith(".part") and not f.endswith(".crc")]


def test_a_short_copy_fails(tmp_path):
    import pandas as pd
    (tmp_path / "a").write_bytes(b"12345")
    rows = pd.DataFrame([(str(tmp_path / "a"), 6, "x/a")], columns=["path", "length", "inner"])
    with pytest.raises(IOError):
        list(store._copy([rows], str(tmp_path / "to")))
    assert not os.path.exists(tmp_path / "to" / "x" / "a")
    rows["length"] = 5
    for _ in range(2):                       # a repeated task writes the same file again
        assert list(store._copy([rows], str(tmp_path / "to")))[0].values.tolist() == [["x/a", 5]]
    assert (tmp_path / "to" / "x" / "a").read_bytes() == b"12345"


def left(spark):
    root = f"{checkpoint_root(spark)}/quire".removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_scopes_remove_what_they_stage(spark, tmp_path):
    before = left(spark)
    with staging(spark):
        kept = scratch_path(spark, "kept")
        with staging(spark) as inner:
            a = stage(spark.range(5), "a")
            assert a.count() == 5 and len(left(spark)) == len(before) + 1
            spark.range(3).write.parquet(kept)
            handed = scratch_path(spark, "handed")
            spark.range(2).write.parquet(handed)
            inner.keep(handed)
        assert spark.read.parquet(handed).count() == 2 and spark.read.parquet(kept).count() == 3
    assert left(spark) == before
    with pytest.raises(ZeroDivisionError), staging(spark):
        stage(spark.range(5), "b")
        1 / 0
    assert left(spark) == before


@pytest.mark.parametrize("name", sorted(SPARK_QUERIES))
def test_no_query_leaves_staged_tables_behind(spark, tmp_path, name):
    before = left(spark)
    write_result(spark, lambda: SPARK_QUERIES[name](spark, SF001), str(tmp_path / name))
    assert left(spark) == before
    assert spark.read.parquet(str(tmp_path / name)).columns


def helper(p):
    return p["rank"] + 1.0


def cell(train, eval_, p, alpha=1):
    return helper(p) * alpha


def make(value):
    def inner(train, eval_, p):
        return value
    return inner


class Cell:
    def __init__(self, x):
        self.x = x

    def run(self, train, eval_, p):
        return self.x


def test_sweeps_of_other_settings_have_other_folders(spark, tmp_path, monkeypatch):
    marks = [W.cell_identity(f) for f in (functools.partial(cell, alpha=1), functools.partial(cell, alpha=2), cell, make(1), make(2), make([1]),
                                          Cell(1).run, Cell(2).run, lambda a, b, p: 1, lambda a, b, p: 2, make(make(1)), make(make(2)))]
    assert len({repr(m) for m in marks}) == len(marks)
    assert W.cell_identity(make(2)) == W.cell_identity(make(2)) and W.cell_identity(Cell(3).run) == W.cell_identity(Cell(3).run)
    same = W.cell_identity(cell)
    monkeypatch.setitem(cell.__globals__, "helper", lambda p: 5.0)      # a function the cell calls
    assert W.cell_identity(cell) != same
    df = spark.createDataFrame([(1, "a")], "row_id long, text string")
    grid = W.param_grid(spark, [8], [1e-4], ["cosine"])
    for make_cell in (lambda a: functools.partial(cell_of, alpha=a), make):
        got = [W.run_sweep(spark, grid, df, df, make_cell(a), results_path=str(tmp_path)).first().eval_loss for a in (1.0, 2.0, 1.0)]
        assert got == [1.0, 2.0, 1.0]
    assert len(os.listdir(tmp_path)) == 4


def cell_of(train, eval_, p, alpha=0.0):
    return alpha


def test_default_cell_learns_what_can_be_learnt(spark):
    rows = [(i, ("good clear answer " if i % 2 else "spam junk offer ") * 3, float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, text string, label double")
    few = W.default_cell(df, df, {"rank": 8, "learning_rate": 0.0002}, max_steps=1)
    many = W.default_cell(df, df, {"rank": 8, "learning_rate": 0.0002}, max_steps=60)
    assert many < 0.1 and many < few / 2


def test_truncation_equals_python(spark):
    ws = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　"
    rng = random.Random(1)
    texts = [None, "", " ", ws, "a", " a", "a ", "a b", " a  b\tc ", "x" * 5000, "wörd " * 3000]
    texts += ["".join(rng.choice(ws + "abc​😀é") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for n in (0, 1, 3, 2500):
        got = {r.i: (r.x.text, r.x.n_tokens, r.x.was_truncated) for r in df.select("i", truncate_ws_tokens("t", n).alias("x")).collect()}
        for i, t in enumerate(texts):
            t = t or ""
            words, cut, at = t.split(), t, 0
            if len(words) > n:
                for w in words[:n]:
                    at = t.index(w, at) + len(w)
                cut = t[:at]
            assert got[i] == (cut, len(words), len(words) > n), (n, t)


def test_stem_table_follows_the_rules(spark):
    rng = random.Random(1)
    ends = ["s", "es", "ies", "ied", "eed", "ed", "ing", "y", "sses", "ll", "e", "yy", ""] + [a for a, _ in STEP2 + STEP3] + STEP4
    words = {"skies", "dying", "news", "y", "yyyyyyyyying", "2nd", "agreed", "falling", "hoping", "hopping", "failing", "tied", "cries"}
    for _ in range(6000):
        w = "".join(rng.choice("aeioubcdlstyzwx1") for _ in range(rng.randint(0, 6))) + rng.choice(ends)
        words.add(w + rng.choice(ends) if rng.random() < 0.3 else w)
    words.discard("")
    df = spark.createDataFrame([(w,) for w in words] * 2 + [(None,)], "token string")
    assert {r.token: r.stem for r in stem_table(df).collect()} == {w: stem(w) for w in words}
