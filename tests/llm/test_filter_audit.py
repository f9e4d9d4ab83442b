"""Document-term matrix and filter audit, against running every order of the filters."""
import random
import re
from collections import Counter
from itertools import permutations

import duckdb

from quire.llm import filter_audit as A
from quire.llm import term_matrix as M
from quire.llm.queries import ORACLES, SPARK_QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, shard string, n string, mask string, digest string, docs string"
LABELS = "doc_id long, quality int, toxic int, n string, mask string"
WORD = re.compile("[^\x20\x09-\x0D]+")


def plain(rows, labels):
    """Every order is really run over the rows."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    docs = []
    for d, t, part in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": d is not None and first[t] < d}
        docs.append((part or "", {f for f in fails if fails[f]}, d in good, d in toxic))
    out, removed_by = [], Counter()
    for order in permutations("ABCDE"):
        for part in {x[0] for x in docs}:
            left, gone = [x for x in docs if x[0] == part], []
            for step, f in enumerate(order, 1):
                lost = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                out.append((part, "".join(order), step, len(left), len(lost), sum(f in x[1] for x in gone),
                            sum(x[1] == {f} for x in docs if x[0] == part), sum(x[2] for x in lost), sum(x[3] for x in lost)))
                gone += lost
                removed_by[part, f] += len(lost)
    return sorted(r + (removed_by[r[0], r[1][r[2] - 1]],) for r in out)


def some_rows():
    rng = random.Random(8)
    words = ["word%d" % i for i in range(150)] + ["Up", "AND", "a", "b", "#tag", "ééé", "x\x1cy"]
    texts = [" ".join(rng.choices(words, k=rng.choice([5, 190, 200, 210, 400]))) for _ in range(25)]
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(120)]
    rows += [(3, rows[3][1], "en"), (3, rows[3][1], rows[3][2]), (3, "another text", "fr"), (None, rows[3][1], "en"), (None, rows[3][1], "en"),
             (None, None, None), (500, None, "en"), (501, "", "fr"), (502, "x " * 30000, "en"), (503, "x " * 30000, "fr")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 130, 2)] + [(4, 1, 0), (4, 0, None), (None, 1, 1)]
    return rows, labels


def run(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA).repartition(3)
    lab = spark.createDataFrame([(*r, "a", "b") for r in labels], LABELS)
    return sorted(tuple(r) for r in A.audit(docs, lab).select("part", "filter_order", "step", *A.COUNTS).collect())


def test_equals_running_every_order(spark):
    rows, labels = some_rows()
    assert run(spark, rows, labels) == plain(rows, labels)
    assert run(spark, rows, []) == plain(rows, [])


def test_no_documents(spark):
    assert run(spark, [], [(1, 1, 1)]) == []
    one = run(spark, [(1, None, None)], [])
    assert one == plain([(1, None, None)], []) and len(one) == 600


def test_matrix_gives_the_words_back(spark, monkeypatch):
    monkeypatch.setattr(M, "STRETCH", 64)
    rows, _ = some_rows()
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA).repartition(2)
    shards, dictionary = M.term_matrix(docs, max_words=1500)
    name = {r.term: r.word for r in dictionary.collect()}
    assert len(name) == len(set(name.values())) == len({w for _, t, _ in rows for w in WORD.findall(t or "")})
    got, kept = [], shards.collect()
    assert len(kept) > 4
    for s in kept:
        ends, terms, counts = (M.unsqueeze(s[c], t) for c, t in (("indptr", "<i8"), ("terms", "<i8"), ("counts", "<i4")))
        for doc, a, b in zip(s.docs, ends[:-1], ends[1:]):
            got.append((doc.doc_id, doc.part, sorted((name[t], c) for t, c in zip(terms[a:b].tolist(), counts[a:b].tolist()))))
    want = [(d, p, sorted(Counter(WORD.findall(t or "")).items())) for d, t, p in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    totals = M.row_totals(shards).collect()
    assert sorted((r.n_words, r.n_terms, r.chars) for r in totals) == sorted((len(w := WORD.findall(t or "")), len(set(w)), len(t or "")) for _, t, _ in rows)


def test_long_texts_are_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(M, "STRETCH", 10)
    raw = b"aa bbbbbbbbbbbbbbbbbbbbbbbb\x0bcc\x1cd  ee\xc2\xa0f\t" + b"x" * 40
    assert [w for ws in M.words_of(raw) for w in ws] == [w.encode() for w in WORD.findall(raw.decode())]


def test_op13_query_equals_its_sql(spark):
    cols = ["part", "filter_order", "step", *A.COUNTS]
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(f"select {', '.join(cols)} from ({ORACLES['op13_filter_audit']})").fetchall()
    got = [tuple(r) for r in SPARK_QUERIES["op13_filter_audit"](spark, SF).select(*cols).collect()]
    assert sorted(got) == sorted(want) and len(got) >= 600
    rows = duckdb.sql(f"select doc_id, text, lang from '{SF}/documents.parquet'").fetchall()
    assert sorted(got) == plain(rows, duckdb.sql(f"select doc_id, quality, toxic from '{SF}/labels.parquet'").fetchall())
