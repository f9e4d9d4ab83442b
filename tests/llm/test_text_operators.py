"""Sanitisation, fingerprints, language ID, n-gram join and top-k search against brute force."""
import base64
import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from quire.llm import impact as I
from quire.llm import langid as L
from quire.llm import ngram_trie as T
from quire.llm import pii as P
from quire.llm import syncmers as S
from quire.llm.queries import SPARK_QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, sig string, tie string, bucket string, part string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "x", "x", "x", "x", "x") for i, t, lang in rows], DOCS)


def given():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()


# --- personal data --------------------------------------------------------------
def slow_spans(text):
    """The patterns as they are stated."""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        dbl = [sum(divmod(2 * x, 10)) for x in d[-2::-2]]
        if 13 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(dbl)) % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(4)
    bits = ["a", "@", ".", "b.c", "-", "+", "1", "25", "256", "4111111111111111", " ", "(", ")", "é", "٣", "_", "%", "@x.y", "1.2.3.4", "+1 (743) 555-3824", "\n"]
    for _ in range(20_000):
        s = "".join(rng.choice(bits) for _ in range(rng.randint(0, 16)))
        assert P.base_spans(s) == slow_spans(s), repr(s)
    assert P.base_spans("9" * 100_000 + "a" * 100_000 + "@") == []      # linear time


def test_op1_query_against_the_patterns(spark):
    want = {}
    for d, t in given():
        spans = slow_spans(t or "")
        named = ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        want[d] = (*[sum(k == j for k, _, _ in spans) for j in range(4)], hashlib.sha256(named.encode()).hexdigest(), named)
    rows = SPARK_QUERIES["op1_pii_sanitise"](spark, SF).collect()
    assert len(rows) == len(want)
    for r in rows:
        w = want[r.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == w[:5]
        assert r.spans == w[5] or r.spans.startswith(w[5] + ("," if w[5] else "") + "term:")


def test_terms_that_reveal_an_entity(spark):
    rng = random.Random(8)
    words = ["w" + "".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    fill = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, f"{fill(30)} Zebulon boss@corp.example.com {fill(30)}", "en") for i in range(6)]
    rows += [(10 + i, fill(60), "en") for i in range(100)]
    rows += [(200, "about zebulon alone", "en"), (201, None, "en"), (202, "", None), (203, "only 10.0.0.1 here", "en"), (203, "only 10.0.0.1 here", "en")]
    rows += [(300 + i, "copied quuxword me@copy.example.org quuxword", "en") for i in range(9)]      # copies prove nothing
    docs = frame(spark, rows)
    terms = {r.term: r for r in P.revealing_terms(docs).collect()}
    assert set(terms) == {"zebulon"} and terms["zebulon"].action in ("generalise", "remove")
    found = {r.doc_id: r for r in P.find(docs, P.revealing_terms(docs)).collect()}
    assert [(h.start, h.end) for h in found[200].hits] == [(6, 13)] and found[10].hits is None
    clean = sorted(((r.doc_id, r.text, r.n_chars, r.node) for r in P.sanitise(docs).collect()), key=str)
    text = {i: t for i, t, _, _ in clean}
    assert len(clean) == len(rows) and all(x == "x" for *_, x in clean)
    assert text[201] is None and text[203] == "only [IP] here" and text[11] == dict((r[0], r[1]) for r in rows)[11]
    assert text[300] == "copied quuxword [EMAIL] quuxword"
    assert "zebulon" not in text[0].lower() and "boss@" not in text[0] and "[EMAIL]" in text[0] and "zebulon" not in text[200]
    assert P.clean_text("abcdef", [(1, 3, "X"), (2, 4, "Y")]) == "aXef"
    none = frame(spark, [])
    assert P.sanitise(none).count() == 0 and P.find(none, P.revealing_terms(none)).count() == 0


def test_terms_in_signatures_and_beside_single_values(spark):
    rng = random.Random(5)
    words = ["w" + "".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    fill = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, f"{fill(40)} xx yy zz q1 q2 q3 Signaturo sign@corp.example.com aa bb cc dd ee ff gg hh", "en") for i in range(4)]       # one window
    rows += [(20 + i, f"{fill(40)} Onceonly +1 743 555 38{i:02} {fill(40)}", "en") for i in range(5)]                                # five values
    rows += [(40 + i, f"{fill(40)} Twicely 10.0.0.{i // 2} {fill(40)}", "en") for i in range(2)]                                      # two texts
    rows += [(60, f"{fill(40)} Copyname once@copy.example.org {fill(40)}", "en")] * 5
    rows += [(100 + i, fill(200), "en") for i in range(60)]
    docs = frame(spark, rows)
    terms = {r.term: r.disclosure for r in P.revealing_terms(docs).collect()}
    assert set(terms) == {"signaturo", "onceonly"} and terms["signaturo"] == terms["onceonly"] == pytest.approx(1)
    assert "twicely" in {r.term for r in P.revealing_terms(docs, min_contexts=2).collect()}
    text = {r.doc_id: r.text.lower() for r in P.sanitise(docs).collect()}
    assert not any("signaturo" in text[i] for i in range(4)) and not any("onceonly" in text[20 + i] for i in range(5))
    assert "twicely [ip]" in text[40] and "copyname [email]" in text[60]
    kinds = [(i, f"{fill(40)} Manynamed {v} {fill(40)}", "en") for i, v in enumerate(["k0@one.example.org", "k1@two.example.org", "k1@two.example.org"])]
    kinds = frame(spark, kinds + [(100 + i, fill(200), "en") for i in range(60)])
    assert {r.term for r in P.revealing_terms(kinds).collect()} == {"manynamed"}          # low support of values counts for the kind


# --- fingerprints ------------------------------------------------------------------
def slow_anchors(text, k=S.K, s=S.S):
    """Place by place, with the module's hash of the inner substrings."""
    c = [ord(x) for x in text]
    M = (1 << 64) - 1

    def mix(h):
        h ^= h >> 30
        h = h * 0xBF58476D1CE4E5B9 & M
        h ^= h >> 27
        h = h * 0x94D049BB133111EB & M
        return h ^ h >> 31
    def sub(i):
        h = c[i]
        for j in range(1, s):
            h = (h * 0x9E3779B97F4A7C15 + c[i + j]) & M
        return mix(h)
    out = []
    for i in range(len(c) - k + 1):
        inner = [sub(i + j) for j in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i)
    return out


def test_anchors_are_the_closed_syncmers():
    rng = random.Random(1)
    for n in (12, 13, 20, 200):
        t = "".join(rng.choice("abcdé😀 ") for _ in range(n))
        want = slow_anchors(t)
        got = S.anchors(t)[0].tolist()
        assert got == (want or [0])
    passage = "".join(rng.choice("abcdefgh ") for _ in range(300))
    a, b = S.sketch("X" * 50 + passage), S.sketch("other words " * 3 + passage)
    assert S.shift(a, b)[0] == len("other words " * 3) - 50 and S.shift(a, b)[1] > 20
    big = S.sketch("abc" * 50_000 + passage)
    assert len(big[0]) <= S.SIZE and (np.diff(big[0].astype(object)) > 0).all()


def test_sketch_keeps_the_smallest_hashes():
    rng = random.Random(3)
    for n in (5, 100, 5000):
        t = "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
        u = np.unique(S.anchors(t)[1])
        assert (S.sketch(t)[0] == u[:S.SIZE]).all()


def test_op5_query_against_a_walk(spark):
    rows = sorted(given(), key=lambda r: -r[0])
    got = {r.doc_id: r for r in SPARK_QUERIES["op5_syncmers"](spark, SF).collect()}
    assert len(got) == len(rows)
    far = 0
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        new = S.edited(t, nxt)
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert r.fingerprint == S.to_text(S.sketch(t)) and r.edited_fingerprint == S.to_text(S.sketch(new))
        assert r.near_edited == S.likeness(S.sketch(t)[0], S.sketch(new)[0]) and r.near_next == S.likeness(S.sketch(t)[0], S.sketch(nxt)[0])
        far += r.near_edited > r.near_next
    assert far >= 0.95 * len(rows)


def test_fingerprints_of_odd_rows(spark):
    rows = [(3, "abc", "en"), (2, None, "en"), (1, "", "en"), (None, "last", "en"), (3, "zz", "en"), (3, "abc", "en"), (9, "long words here " * 5000, "en")]
    got = S.compare_with_edits(frame(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in got) == sorted((i or -1, len(t or "")) for i, t, _ in rows)
    same = {r.fingerprint for r in got if r.doc_id == 3 and r.n_chars == 3}
    assert len(same) == 1
    assert [(r.near_edited, r.near_next, r.fingerprint) for r in got if r.doc_id == 2] == [(1.0, 1.0, "")]
    one = S.compare_with_edits(frame(spark, [(5, "lonely", "en")])).collect()
    assert one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"lonlon").hexdigest()
    assert S.compare_with_edits(frame(spark, [])).count() == 0


def test_long_texts_keep_all_anchors_and_match_by_place(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8)))
    fill = lambda n: " ".join(word() for _ in range(n))
    passage, heads = fill(50), [fill(12_000), fill(3_000)]
    texts = [f"{h} {passage} {fill(20_000 - n)}" for h, n in zip(heads, (12_000, 3_000))]
    for t in texts:
        assert len(S.sketch(t)[0]) == len(np.unique(S.anchors(t)[1])) > 10_000
    got = {r.doc_id: r for r in S.compare_with_edits(frame(spark, [(2, texts[0], "en"), (1, texts[1], "en")])).collect()}
    d, n = S.shift(S.sketch(texts[0]), S.sketch(texts[1]))
    assert got[2].shift_next == d == len(heads[1]) - len(heads[0]) and got[1].shift_next == -d and n > 40
    assert got[2].aligned_next == n / (len(got[2].fingerprint.split()) + len(got[1].fingerprint.split()) - n)
    assert got[2].shift_edited == 0 and got[2].aligned_edited > 0.3
    turned = S.compare_with_edits(frame(spark, [(2, fill(20) + " " + passage, "en"), (1, passage + " " + fill(20), "en")])).collect()
    assert all(0 < r.aligned_next <= r.near_next for r in turned)


def test_fingerprints_are_written_in_few_characters_and_read_back(spark):
    rng = random.Random(8)
    texts = ["", "x", "eleven char", "ab" * 4000, "aaaa bbbb " * 30 + "héllo 😀 wörld " * 3] + ["".join(rng.choice("abcdefghij klmé😀") for _ in range(n)) for n in (12, 13, 900, 30_000)]
    rows = {r.doc_id: r for r in S.compare_with_edits(frame(spark, [(i, t, "en") for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        for f, got in ((S.sketch(t), rows[i].fingerprint), (S.sketch(S.edited(t, texts[i - 1])), rows[i].edited_fingerprint)):
            by_place, last, words = sorted(zip(f[1].tolist(), f[0].tolist())), 0, []
            for at, h in by_place:
                words.append(base64.b85encode(h.to_bytes(8, "big")).decode() + str(at - last))
                last = at
            assert got == " ".join(words)                # one word an anchor, whatever the distances
            h, at = S.from_text(got)
            assert h.dtype == f[0].dtype and h.tolist() == f[0].tolist() and at.tolist() == f[1].tolist()
    long = rows[len(texts) - 1]
    n = len(S.sketch(texts[-1])[0])
    assert n > 5000 and len(long.fingerprint) < 12.5 * n       # 22 as hexadecimal hash and place: 12.8 times the table's Parquet
    edge = (np.array([0, 1, (1 << 32) - 1, 1 << 32, (1 << 64) - 1], np.uint64), np.array([7, 1_000_000, 0, 99, 100]))
    assert all((a == b).all() for a, b in zip(S.from_text(S.to_text(edge)), edge))


# --- language ------------------------------------------------------------------------
def test_op10_query_held_out_accuracy(spark):
    rows = SPARK_QUERIES["op10_compression_langid"](spark, "/root/testdata/sf0.01").collect()
    lang = dict(duckdb.sql("select doc_id, lang from '/root/testdata/sf0.01/documents.parquet'").fetchall())
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    test = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in test) >= 0.97 * len(test)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_language_of_odd_texts(spark):
    rng = random.Random(0)
    words = {"xx": ["lorem", "ipsum", "dolor", "amet"], "yy": ["zwölf", "boxer", "jagen", "quer"]}
    rows = [(i, " ".join(rng.choices(words[g], k=40)), g) for i in range(60) for g in [rng.choice(["xx", "yy"])]]
    docs = frame(spark, rows + [(100, None, "xx"), (101, "", None), (102, "123 !!", "yy"), (None, "lorem ipsum amet", None), (104, "boxer jagen " * 20_000, None)])
    model = L.fit(docs)
    assert sorted(model) == ["xx", "yy"]
    got = {r.doc_id: r.language for r in L.classify(docs, model).collect()}
    assert [got[i].lang for i in (100, 101, 102, None, 104)] == ["und", "und", "und", "xx", "yy"]
    assert got[100].rejected and got[102].score == 0.0
    assert L.keep_identified(docs).columns == docs.columns
    assert {r.doc_id for r in L.keep_identified(docs).collect()} == {r[0] for r in rows} | {None, 104}
    none = frame(spark, [])
    assert L.classify(none, L.fit(none)).count() == 0 and L.Classifier({}).predict("some text") == ("und", 0.0, 0.0)


# --- n-gram join -------------------------------------------------------------------------
def slow_components(rows, n=3, percent=90):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        k = min(n, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            x = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * x >= percent * (len(sets[i]) + len(sets[j]) - x):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i in range(len(rows)):
        least[find(i)].append(rows[i][0])
    return sorted((rows[i][0], len(sets[i]), min(least[find(i)])) for i in range(len(rows)))


def edited_texts(seed, bases, copies, length, edits):
    rng, rows = random.Random(seed), []
    for b in range(bases):
        base = [f"t{rng.randrange(500)}" for _ in range(length)]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize("block,n,percent", [(64, 3, 90), (7, 3, 90), (16, 5, 80)])
def test_join_against_all_pairs(spark, block, n, percent):
    rows = edited_texts(1, 5, 30, 100, 4) + [(1000 + i, t) for i, (_, t) in enumerate(edited_texts(2, 4, 8, 19, 1))]
    rows += [(2000, None), (2001, ""), (2002, "one"), (2003, "ONE"), (2004, "one two"), (2005, " one\ttwo\n"), (2006, "ÉA b c"), (2007, "éa b c")]
    rows += [(5, rows[5][1]), (3000, rows[5][1].upper()), (3001, "w " * 60_000), (3002, "w " * 60_001)]
    d = frame(spark, [(i, t, "en") for i, t in rows])
    got = sorted(tuple(r) for r in T.join_documents(d, n, percent, block=block, bridges=2).collect())
    assert got == slow_components(rows, n, percent)
    if block == 7:
        keep = {r.doc_id for r in T.keep_first(d, block=block).collect()}
        assert keep == {c for _, n, c in got if n} | {2000, 2001}


def test_trie_finds_the_links_of_all_pairs():
    for seed in range(6):
        sets = sorted({T.ngram_set(t).tobytes() for _, t in edited_texts(seed, 3, 25, 40 + 30 * seed, 5)})
        sets = [np.frombuffer(x, np.uint64) for x in sets]
        asked = None if seed % 2 else [i for i in range(len(sets)) if i % 3 == 0]
        got = list(T.trie_links(sets, asked=asked))
        root = list(range(len(sets)))
        def find(i):
            while root[i] != i:
                i = root[i]
            return i
        for i, j in got:
            x = len(np.intersect1d(sets[i], sets[j]))
            assert 100 * x >= 90 * (len(sets[i]) + len(sets[j]) - x) and find(i) != find(j)
            root[find(i)] = find(j)
        for i in range(len(sets)):
            for j in range(i):
                x = len(np.intersect1d(sets[i], sets[j]))
                met = asked is None or (i in asked) != (j in asked)
                if met and 100 * x >= 90 * (len(sets[i]) + len(sets[j]) - x):
                    assert find(i) == find(j)


@pytest.mark.parametrize("percent", [50, 80, 90, 99])
def test_linked_sets_announce_a_part_in_common(percent):
    rng = np.random.default_rng(5)
    met = 0
    for _ in range(4000):
        n = int(rng.integers(1, 400 if rng.random() < 0.5 else 30))
        h = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        gone, new = rng.integers(0, n * (100 - percent) // 80 + 2, 2)
        g = np.unique(np.r_[rng.permutation(h)[gone:], rng.integers(0, 2 ** 64, new, dtype=np.uint64)])
        x = len(np.intersect1d(h, g))
        if len(g) and 100 * x >= percent * (len(h) + len(g) - x) and x < max(len(h), len(g)):
            met += 1
            assert len(np.intersect1d(T.parts(h, percent), T.parts(g, percent)))
    assert met > 100


def test_rows_go_by_their_own_text(spark):
    rng = random.Random(9)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60))
    a, b, c = text(), text(), text()
    rows = [(1, a), (2, a), (2, b), (3, b + " tail"), (None, a), (None, c), (None, c), (4, None), (4, "")]
    d = spark.createDataFrame([(i, t, "x", "y", "z", "w") for i, t in rows], "doc_id long, text string, gone_id string, GONE_KEY string, _id string, key string")
    kept = sorted(((r.doc_id, r.text) for r in T.keep_first(d).collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (None, c), (None, c), (4, None), (4, "")], key=str)


def test_words_of_few_kinds_group_nobody(spark):
    """Texts that share many n-grams and do not link: what travels grows with the texts."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(30)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(100)), "en") for i in range(600)]
    _, links = T.link_classes(frame(spark, rows))
    assert links.count() == 0
    shared = [len(np.unique(T.parts(T.ngram_set(t)))) for _, t, _ in rows]
    every = np.concatenate([np.unique(T.parts(T.ngram_set(t))) for _, t, _ in rows])
    assert len(every) - len(np.unique(every)) < 0.02 * sum(shared)


def test_join_of_nothing(spark):
    assert T.join_documents(frame(spark, [])).count() == 0


# --- top k -----------------------------------------------------------------------------------
def test_top_k_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, 16)]) for i in range(300)]
    rows += [(400, [0.5, None]), (401, None), (402, [float("nan")]), (403, [float("inf")] * 16), (404, []), (None, [0.1] * 16), (450, rows[50][1]),
             (451, rows[50][1]), (500, [0.3, -0.2])]
    rows += [(7, rows[7][1])]
    e = spark.createDataFrame([r + (1, 2, "v") for r in rows], "vec_id long, embedding array<double>, label int, part int, rank string")
    got = sorted(tuple(r) for r in I.top_k(e, part_rows=64, query_rows=4).collect())
    vec = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vec[i] = np.pad(np.floor(256 * np.array(v)).astype(np.int64), (0, 16 - len(v)))
    want = []
    for q in sorted(i for i in vec if i % 50 == 0):
        best = sorted((-int(vec[q] @ v), i) for i, v in vec.items() if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)
    assert I.top_k(e.limit(0)).count() == 0


def test_early_stop_changes_nothing():
    rng = np.random.default_rng(9)
    rows = np.zeros((500, 64), np.int64)
    for r in rows:                                          # sparse: a few strong components
        r[rng.choice(64, 5, replace=False)] = rng.integers(-4000, 4000, 5)
    index = I.ImpactIndex(np.arange(500), rows)
    q = rows[:40] + rng.integers(-5, 5, (40, 64))
    got = list(index.search(np.arange(1000, 1040), q, 5))
    for j in range(40):
        best = sorted((-int(s), i) for i, s in enumerate(rows @ q[j]))[:5]
        assert [(i, s) for a, i, s in got if a == 1000 + j] == [(i, -s) for s, i in best]


def test_announced_parts_are_never_kept_beside_their_shuffle(spark, monkeypatch):
    """The parts are most of what the join holds: no staged table may hold them before the shared ones are known."""
    import pyarrow as pa
    staged = {}

    def noted(df, name, *rest):
        out = real(df, name, *rest)
        staged.setdefault(name, out.dtypes)
        return out

    real = T.stage
    monkeypatch.setattr(T, "stage", noted)
    words = [f"w{k}" for k in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words[:59], "other"])), (3, None), (4, "one two"), (5, "one two")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in T.join_documents(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}
    assert not any(t.startswith("array") for types in staged.values() for _, t in types)

    class Odd:
        def admits(self, h):
            return h % 2 == 1

    batch = pa.record_batch([pa.array([" ".join(words), None, " ".join(words), ""])], ["text"])
    every, odd = ([b.column("g").to_numpy() for b in T._announced([batch], 3, 90, w)] for w in (None, Odd()))
    want = T.parts(T.ngram_set(" ".join(words), 3))
    assert np.array_equal(np.concatenate(every), want) and np.array_equal(np.concatenate(odd), want[want % 2 == 1])


def test_words_are_hashed_many_at_a_time(monkeypatch):
    """Only a class's digest and very long words are hashed one by one; texts taken together
    have the sets each has alone."""
    import pyarrow as pa
    rng, calls = random.Random(6), []
    words = ["".join(rng.choice("abcé\x00字") for _ in range(k)) for k in (1, 2, 3, 7, 8, 9, 15, 16, 17, 24, 25, 40, 41)]
    words += ["x" * k for k in range(1, 80)] + ["x" * k + "y" for k in range(1, 80)] + ["\x00", "\x00\x00", "É", "é", " ", "a b"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "\n", "\t\x0b", " \x0c\r"]) for _ in range(rng.randrange(60))) for _ in range(200)]
    texts += [None, "", " \n ", "one", "ONE", " one\ttwo", "one two three", "b c", None, "字" * 500, "ß" * 40 + " a"]
    for n in (1, 3, 5):
        plain = []
        for t in texts:
            w = (t or "").encode().lower().split()
            plain.append({tuple(w[i:i + n]) for i in range(max(len(w) - n + 1, min(len(w), 1)))})
        for chars in (1, 300, 1 << 18):
            got = list(T.ngram_sets(texts, n, chars))
            assert [len(h) for h in got] == [len(p) for p in plain]
            assert all((h[1:] > h[:-1]).all() and np.array_equal(h, T.ngram_set(t, n)) for h, t in zip(got, texts))
            for i in range(len(texts)):
                for j in range(0, i, 7):
                    assert len(np.intersect1d(got[i], got[j])) == len(plain[i] & plain[j])
    real = T.hashlib.blake2b
    monkeypatch.setattr(T.hashlib, "blake2b", lambda *a, **k: calls.append(1) or real(*a, **k))
    batch = pa.record_batch([pa.array([f"{i}" for i in range(40)]), pa.array(range(40)), pa.array([" ".join(f"w{i}x{j}" for j in range(50)) for i in range(40)])],
                            ["doc_id", "key", "text"])
    assert sum(b.num_rows for b in T._sets([batch], 3)) == 40
    assert len(calls) == 40
