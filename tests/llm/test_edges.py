"""Sizes, ties, odd characters and clashing names that operators once dropped or refused."""
import gzip
import math
import random
import time
from collections import Counter

import numpy as np
import pytest

from quire.llm import impact as I
from quire.llm import langid as L
from quire.llm import ngram_trie as T
from quire.llm import pii as P
from quire.llm import warc as W
from quire.llm.common import free_name
from quire.llm.tokens import LONG, Encoder, default_vocabulary

SF = "/root/testdata/sf0.01"


# --- language ------------------------------------------------------------------------
def test_letters_are_letters():
    assert [L.has_letter(t) for t in ("²", "½ 3", "_ 12", "x", "1é", "中", "ª", "Ⅷ", "")] == [False, False, False, True, True, True, True, False, False]
    assert L.Classifier({"de": b"haus garten ", "en": b"house garden "}).predict("² ½ 3")[0] == "und"


def test_short_texts_are_told_apart_by_what_dictionaries_hold(spark):
    words = {"xx": ["lorem", "ipsum", "dolor", "garten"], "yy": ["zwoelf", "boxer", "jagen", "weather"]}
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(words[g], k=40)), g) for i in range(80) for g in [rng.choice(["xx", "yy"])]]
    odd = [(200, "garten", None), (201, "weather", None), (202, "qqqq", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    c = L.Classifier(L.fit(docs))
    assert [c.predict(t)[0] for _, t, _ in odd[:2]] == ["xx", "yy"] and c.predict("qqqq")[2] == 0.0
    kept = {r.doc_id for r in L.keep_identified(docs).collect()}
    assert {200, 201} <= kept and 202 not in kept


def test_no_labels_fail_loudly(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        L.keep_identified(docs)
    assert L.keep_identified(docs.limit(0)).count() == 0


def test_columns_of_any_name_pass_through(spark):
    rows = [(i, f"lorem ipsum number {i} mail me at a{i}@example.com", "xx", "a", "b", "c", "d") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, language string, Hit_Spans string, clean_text string, hit_id string")
    assert free_name(["A", "a_"], "a") == "a__"
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns and {tuple(r)[3:] for r in kept.collect()} <= {("a", "b", "c", "d")}
    clean = P.sanitise(docs)
    assert clean.columns == docs.columns
    for r in clean.collect():
        assert tuple(r)[3:] == ("a", "b", "c", "d") and "[EMAIL]" in r.text


# --- personal data -------------------------------------------------------------------
def plain_context(text, spans, start, end, window=8):
    free = [m for m in P.TERM.finditer(text) if not any(m.start() < b and a < m.end() for _, a, b in spans)]
    left = [m.group().lower() for m in free if m.end() <= start][-window:]
    return left + [m.group().lower() for m in free if m.start() >= end][:window]


def test_contexts_against_plain_loops():
    rng = random.Random(2)
    bits = ["Ann", "li", "x", "born", "a@b.cc", "10.0.0.1", "+49 170 1234567", "4111 1111 1111 1111", "word", "中文", "_", "a.b@c.d.ee", "12"]
    for _ in range(400):
        text = rng.choice(["", " "]).join(rng.choice(bits) + rng.choice([" ", ", ", "\n"]) for _ in range(rng.randint(1, 40)))
        spans = P.base_spans(text)
        free = P.free_terms(text, spans)
        for _, a, b in spans:
            assert P.context(free, a, b, 8) == plain_context(text, spans, a, b)


def test_contexts_reach_over_anything_and_stay_linear():
    far = "Ann 中文 é of " + "-" * 5000 + " a@b.cc " + "=" * 5000 + " Bob"
    spans = P.base_spans(far)
    assert P.context(P.free_terms(far, spans), *spans[0][1:], 8) == ["ann", "中文", "é", "bob"]
    text = " ".join(f"name{i} u{i}@example.com" for i in range(20_000))
    t = time.process_time()
    spans = P.base_spans(text)
    free = P.free_terms(text, spans)
    got = [P.context(free, a, b, 8) for _, a, b in spans]
    assert len(got) == 20_000 and all(len(c) >= 8 for c in got)
    assert time.process_time() - t < 5


def test_disclosure_values_against_plain_counts(spark):
    rng = random.Random(5)
    filler = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta"]
    texts = []
    for i in range(60):
        body = " ".join(rng.choices(filler, k=60))
        if i % 4 == 0:
            body += f" zorro writes to boss@corp.com {i} " + " ".join(rng.choices(filler, k=12))
        if i % 5 == 0:
            body += f" call quux at +49 170 {1000000 + i} " + " ".join(rng.choices(filler, k=12))
        texts.append(body)
    texts += texts[:3]                                               # copies prove nothing
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    window, least = 8, 3
    n_tc, seen, n_c = Counter(), {}, Counter()
    for t in texts:
        spans = P.base_spans(t)
        for k, a, b in spans:
            for c in (P.entity(k, t[a:b]), P.KINDS[k]):
                n_c[c] += 1
                for term in set(plain_context(t, spans, a, b)):
                    n_tc[c, term] += 1
                    seen.setdefault((c, term), set()).add(t)
    n_t = Counter(m.group().lower() for t in texts for m in P.TERM.finditer(t))
    n = sum(n_t.values()) / (2 * window)
    want = {}
    for (c, term), k in n_tc.items():
        if len(seen[c, term]) >= least and n_c[c] < n:
            d = math.log(n * k / (max(n_t[term], k) * n_c[c])) / math.log(n / n_c[c])
            want[term] = max(d, want.get(term, -math.inf))
    want = {t: d for t, d in want.items() if d >= 0.8}
    got = {r.term: r.disclosure for r in P.revealing_terms(docs).collect()}
    assert got.keys() == want.keys() and "zorro" in got
    assert all(abs(got[t] - want[t]) < 1e-9 for t in want)


# --- top k ---------------------------------------------------------------------------
def test_scores_of_any_size(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)]) for i in range(120)]
    rows += [(150, [5000.0, -3.0, 0.0, 0.1, 0.0, 0.0]), (151, [-5000.0, 4.0]), (200, [1e30, 2.0, -1e30, 0.0, 3.0, 1.0]), (201, [3e38] * 6), (250, [-3e38, 1.0])]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    whole = {i: [math.floor(256 * x) if abs(x) < 2 ** 53 else int(x) * 256 for x in v] + [0] * (6 - len(v)) for i, v in rows}
    got = {}
    for r in I.top_k(e, part_rows=40, query_rows=2).collect():
        got[r.query_id, r.rank] = (r.vec_id, r.score)
    for q in whole:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:5]
            assert [got[q, k][0] for k in range(1, 6)] == [i for _, i in best]
            assert [got[q, k][1] for k in range(1, 6)] == [-s if -2 ** 63 <= -s < 2 ** 63 else None for s, _ in best]


def test_places_sort_like_numbers():
    n = [0, 1, -1, 9, 10, -9, -10, 99, 10 ** 40, -10 ** 40, 2 ** 63, 123456, -123456]
    assert sorted(n) == sorted(n, key=I.place)


# --- archives ------------------------------------------------------------------------
def test_record_ids_are_unique(spark, tmp_path):
    rows = [(1, "u", "a"), (1, "u", "a"), (1, "u", "a"), (2, "u", "a"), (2, "u", "b"), (None, "u", "c"), (None, "u", "c")]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, bucket string, kind string")
    man = W.write_warc(pages, str(tmp_path / "w"))
    ids = []
    for r in man.collect():
        text = gzip.open(r.file.removeprefix("file:")).read().decode()
        ids += [line for line in text.split("\r\n") if line.startswith("WARC-Record-ID")]
    assert len(ids) == len(rows) == len(set(ids))
    back = Counter((r.page_id, r.record_type) for r in W.read_warc(spark, man).collect())
    assert back[2, "response"] == 2 and back[1, "revisit"] == 3


# --- word memory ---------------------------------------------------------------------
def test_word_memory_is_bounded_and_given_back():
    enc = Encoder(default_vocabulary(), limit=50)
    enc.ids(" ".join("w%d" % i for i in range(400)) + " " + "x" * (LONG + 1))
    assert len(enc.after) <= 50 and not any(len(c) > LONG for c in [*enc.after, *enc.after.old])
    enc.forget()
    assert not enc.after and not enc.after.old and not enc.bare


# --- n-gram join: sketches -----------------------------------------------------------
@pytest.mark.parametrize("percent", [80, 90])
def test_sketches_keep_all_that_link(percent):
    rng = np.random.default_rng(7)
    sets, comps = [], []
    for c in range(12):
        base = np.unique(rng.integers(0, 2 ** 64, int(rng.integers(3, 300)), dtype=np.uint64))
        for k in range(6):
            gone, new = rng.integers(0, max(2, len(base) // 12), 2)
            sets.append(np.unique(np.r_[rng.permutation(base)[gone:], rng.integers(0, 2 ** 64, new, dtype=np.uint64)]))
            comps.append(c * 10 + k)
    for asks in ([False] * len(sets), [i % 3 == 0 for i in range(len(sets))]):
        sketches = [T.unpack_sketch(T.pack_sketch(T.sketch(s, percent))) for s in sets]
        keep = T.near_enough([len(s) for s in sets], sketches, comps, asks, percent)
        met = 0
        for i in range(len(sets)):
            for j in range(i):
                x = len(np.intersect1d(sets[i], sets[j]))
                if 100 * x >= percent * (len(sets[i]) + len(sets[j]) - x) and (not any(asks) or asks[i] != asks[j]):
                    met += 1
                    assert keep[i] and keep[j]
        assert met > 10
    far = [np.unique(rng.integers(0, 2 ** 64, 200, dtype=np.uint64)) for _ in range(20)]
    assert not T.near_enough([len(s) for s in far], [T.sketch(s, percent) for s in far], list(range(20)), [False] * 20, percent).any()
