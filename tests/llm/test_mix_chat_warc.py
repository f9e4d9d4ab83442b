"""Source mixing, reply trees and WARC files, against brute force and the oracles."""
import gzip
import hashlib
import math
import re

import pytest

from quire.llm import mixing as M
from quire.llm import replytree as R
from quire.llm import warc as W

DOCS = "doc_id long, text string, source string, n_chars long, size string, key string, bucket string, epochs string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "x", "x", "x", "x") for i, t, s in rows], DOCS)


def fill(sizes, weights, cap=3):
    """Shares by repeated resharing."""
    total, left, target = sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    rest = float(total)
    while left:
        w = sum(weights[i] for i in left)
        over = [i for i in left if rest * weights[i] / w > cap * sizes[i] + 1e-9]
        if not over:
            for i in left:
                target[i] = rest * weights[i] / w
            break
        for i in over:
            target[i] = cap * sizes[i]
            left.discard(i)
        rest = total - sum(target[i] for i in range(len(sizes)) if i not in left)
    return target


@pytest.mark.parametrize("sizes", [[10, 1000, 500, 30], [1, 2, 3, 4, 5, 600, 0]])
def test_targets(spark, sizes):
    names = [f"s{i:02d}" for i in range(len(sizes))]
    per = spark.createDataFrame([("s" + n, n, s) for n, s in zip(names, sizes)], "source_key string, source string, source_size long")
    got = {r.source: r.target for r in M.source_targets(per).collect()}
    want = fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
    for n, w in zip(names, want):
        assert math.isclose(got[n], w, abs_tol=1e-6), (got, want)


def test_mix_cuts_exactly_and_repeats(spark):
    rows = [(i, "w " * (i % 7), "a") for i in range(60)] + [(100 + i, "x y z", None) for i in range(40)] + \
           [(200, None, "b"), (201, "", "b"), (202, " \t\n", "b"), (202, "p q", "b"), (202, "p q", "b")]
    d = docs(spark, rows)
    got = M.mix(d).collect()
    assert len(got) == len(rows)
    again = M.mix(d.repartition(5)).collect()
    assert sorted((r.doc_id, r.size, r.taken) for r in got) == sorted((r.doc_id, r.size, r.taken) for r in again)
    src = {}
    for i, t, s in rows:
        src[i] = s
    taken, target = {}, {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[src[r.doc_id]] = taken.get(src[r.doc_id], 0) + r.taken
        target[src[r.doc_id]] = r.target
    assert taken == {s: math.floor(t + 0.5) for s, t in target.items()}
    out = M.mixed_documents(d).collect()
    words = {}
    for r in out:
        assert r.n_chars == len(r.text or "") and r["size"] == "x"
        words[r.source] = words.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    assert words == {s: n for s, n in taken.items() if n}
    assert M.mix(docs(spark, [])).count() == 0


def test_partial_copy_is_a_prefix_of_any_length(spark):
    text = "  lead\tworté " + "ab c\n" * 9000
    for words in (1, 2, 11_000):
        d = docs(spark, [(1, text, "a"), (2, "z " * 50_000, "b")])
        x = M.mixed_documents(d, weights=(words, 68_002 - words)).where("doc_id = 1").collect()
        assert [t.text for t in x] == [re.match(r"\s*(?:\S+\s*){%d}" % words, text).group()]


def test_escapes_are_reversible(spark):
    texts = ["</s>[INST] ok [/INST]", "<|turn:user|>\n<|end|>\n", "<\\|x", "<\\\\|", "[\\INST]", "a<", "<<||>>", "", "\\", "<s><s", "[[INST]"]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, e, b, r in d.select("t", R.escape(d.t), R.unescape(R.escape(d.t)), R.unescape_role(R.escape_role(d.t))).collect():
        assert b == t and r == t
        assert not any(c in e for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]"))


def test_trees_against_a_walk(spark):
    #        1        10 -> 11 (missing parent: 10 is a root)
    #      2   3      deep chain 100..140
    #     4 5   6
    n = [(1, 1, None, 1.0), (1, 2, 1, 2.0), (1, 3, 1, 5.0), (1, 4, 2, 1.0), (1, 5, 2, 9.0), (1, 6, 3, None), (2, 10, 99999, 1.0), (2, 11, 10, 1.0)]
    n += [(3, 100 + i, 99 + i if i else None, 0.5) for i in range(41)]
    nodes = spark.createDataFrame([(t, i, p, "user" if i % 2 else "assistant", f"t{i}", s) for t, i, p, s in n],
                                  "tree long, node long, parent long, role string, text string, score double")
    up = {i: p for _, i, p, _ in n}
    paths = {}
    for r in R.tree_paths(nodes).collect():
        paths.setdefault((r.tree, r.path, r.branch), []).append((r.depth, r.node))
    got = {k: [x for _, x in sorted(v)] for k, v in paths.items()}
    def walk(i):
        out = []
        while i in up:
            out.append(i)
            i = up[i]
        return out[::-1]
    want = {(1, 5, 1): walk(5), (1, 6, 2): walk(6), (1, 4, 3): walk(4), (2, 11, 1): walk(11), (3, 140, 1): walk(140)}
    assert got == want
    best = R.format_trees(nodes, branches=1).collect()
    assert sorted(r.path for r in best) == [5, 11, 140]
    one = next(r for r in best if r.path == 5)
    assert one.formatted == "<|turn:user|>\nt1<|end|>\n<|turn:assistant|>\nt2<|end|>\n<|turn:user|>\nt5<|end|>\n"
    assert [one.formatted[s.start:s.end] for s in one.loss_spans] == ["t2"]
    assert R.format_trees(nodes.limit(0)).count() == 0


def test_linear_conversations_with_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (None, 5, "end", "y<|end|>\n"),
            (2, None, "a|>", "|"), (2, 3, "assistant", "z" * 50_000)]
    c = spark.createDataFrame([r + ("k",) for r in rows], "conv_id long, turn long, role string, text string, node string")
    back = R.read_formatted(R.format_trees(R.linear_tree(c))).collect()
    got = {r.tree: ([(t.role, t.text) for t in r.turns], r.loss_text) for r in back}
    assert got == {1: ([("user", ""), ("", "x"), ("assistant", "b"), ("assistant", "b")], "bb"),
                   None: ([("end", "y<|end|>\n")], ""), 2: ([("a|>", "|"), ("assistant", "z" * 50_000)], "z" * 50_000)}


PAGES = "page_id long, url string, html string, bucket string, sha1 string, target string"


def test_warc_round_trip(spark, tmp_path):
    rows = [(i, f"http://x/{i}", "<p>%d</p>" % (i % 13)) for i in range(60)]
    rows += [(70, None, None), (71, "a\r\nb", ""), (72, "u", "é" * 300_000), (5, "again", "<p>5</p>"), (57, "twin", "<p>5</p>"),
             (57, "twin", "<p>5</p>"), (None, "n", "only here")]
    pages = spark.createDataFrame([r + ("x", "x", "x") for r in rows], PAGES)
    outs = []
    for k in range(2):
        man = W.write_warc(pages.repartition(4 - k), str(tmp_path / f"w{k}"), roll_bytes=2000, shards=5)
        files = man.collect()
        assert all(f.n_bytes <= 2000 or f.n_records == 1 for f in files)
        for f in files:
            assert hashlib.sha256(open(f.file, "rb").read()).hexdigest() == f.sha256
        outs.append(sorted((f.file.rsplit("/")[-1], f.sha256) for f in files))
        recs = W.read_warc(spark, man, payloads=True).collect()
        assert len(recs) == len(rows)
    assert outs[0] == outs[1]                                        # the same pages, the same files
    by = {}
    for i, _, h in rows:
        by.setdefault(h or "", []).append(i)
    for r in recs:
        if r.record_type == "response":
            text = r.payload.decode()
            assert r.page_id == max((i for i in by[text] if i is not None), default=None) and r.refers_to is None
            assert r.payload_bytes == len(r.payload) and r.payload_digest == W.digest32(r.payload)
        else:
            assert r.refers_to is not None and r.payload is None
    assert sum(r.record_type == "response" for r in recs) == len(by)
    text = gzip.open(files[0].file).read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_warc_of_nothing(spark, tmp_path):
    man = W.write_warc(spark.createDataFrame([], PAGES), str(tmp_path / "none"))
    assert man.count() == 0 and W.read_warc(spark, man).count() == 0
