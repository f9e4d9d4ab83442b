"""The pipeline against a plain version of every stage."""
import hashlib
import math
import re
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline as C
from quire.llm import langid as L
from quire.llm import pii as P
from test_text_operators import slow_components, slow_spans
from test_tokens_files import SF, crc, ids_of, tok  # noqa: F401

COLS = "doc_id, text, lang, source, n_chars"
KEEP = re.compile(r"[^\x20\x09-\x0D]+")


def plain_mix(docs):
    """Rows of (doc_id, text) after mixing, one at a time."""
    size = {i: len(KEEP.findall(t or "")) for i, t, *_ in docs}
    by = defaultdict(list)
    for i, t, _, s, _ in docs:
        by[s].append((hashlib.md5(f"17:{i}".encode()).hexdigest(), i, t))
    names = sorted(by, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[i] for _, i, _ in by[s]) for s in names}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left = {}, set(names)
    while left:
        rest = sum(total.values()) - sum(target.values())
        unit = rest / sum(weight[s] for s in left)
        over = [s for s in left if unit * weight[s] >= 3 * total[s]]
        for s in over or left:
            target[s] = 3 * total[s] if over else unit * weight[s]
        left -= set(over or left)
    out = []
    for s in names:
        budget, at = math.floor(target[s] + 0.5), 0
        full, rest = divmod(budget, total[s]) if total[s] else (0, 0)
        for _, i, t in sorted(by[s]):
            part = max(0, min(size[i], rest - at))
            at += size[i]
            out += [(i, t)] * full
            if part:
                words = [m.end() for m in re.finditer(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", t)]
                out.append((i, t[:words[part - 1]]))
    return out


@pytest.fixture(scope="module")
def stages(spark):
    docs, got = spark.read.parquet(f"{SF}/documents.parquet"), {}
    from quire.llm.common import stage
    for name, f in C.STAGES:
        docs = stage(f(spark, docs, SF), "pipe")
        got[name] = docs
        if name != "best_fit":
            assert docs.columns == C.COLUMNS
    return got


def rows(df):
    return [tuple(r) for r in df.select(*COLS.split(", ")).collect()]


def test_language_stage_keeps_identified_documents(spark, stages):
    given = duckdb.sql(f"select {COLS} from '{SF}/documents.parquet'").fetchall()
    c = L.Classifier(L.fit(spark.read.parquet(f"{SF}/documents.parquet")))
    want = [r for r in given if (lambda p: p[0] != "und" and p[2] >= 0.002)(c.predict(r[1]))]
    assert Counter(rows(stages["language_id"])) == Counter(want)


def test_join_stage_keeps_the_first_of_a_group(stages):
    given = rows(stages["language_id"])
    keep = {c for _, n, c in slow_components([(r[0], r[1]) for r in given], 5, 80)}
    assert sorted(rows(stages["ngram_join"])) == sorted(r for r in given if r[0] in keep)


def test_pii_stage_replaces_what_was_found(stages):
    given = {r[0]: r for r in rows(stages["ngram_join"])}
    got = {r[0]: r for r in rows(stages["pii"])}
    assert set(got) == set(given)
    for i, (_, text, lang, source, _) in given.items():
        want = P.clean_text(text, [(a, b, P.LABELS[P.KINDS[k]]) for k, a, b in slow_spans(text)])
        assert got[i] == (i, want, lang, source, len(want))


def test_mix_stage_repeats_and_cuts(stages):
    want = plain_mix(rows(stages["pii"]))
    assert Counter((r[0], r[1]) for r in rows(stages["source_mix"])) == Counter(want)
    assert all(r[4] == len(r[1]) for r in rows(stages["source_mix"]))


def test_last_stage_places_every_token_once(spark, stages, tok):  # noqa: F811
    for packed in (stages["best_fit"], C.run(spark, SF)):
        got, want = Counter(), Counter()
        for r in packed.collect():
            got[(r.doc_id, r.start, r.length, r.ids_crc32)] += 1
        for i, t, *_ in rows(stages["source_mix"]):
            ids = ids_of(tok, t)
            at, size = 0, len(ids) % 1024 or min(len(ids), 1024)
            while at < len(ids):
                want[(i, at, size, crc(ids[at:at + size]))] += 1
                at, size = at + size, 1024
        assert got == want
        places = defaultdict(list)
        for r in packed.collect():
            places[r.sequence_id].append((r.offset, r.length))
        for p in places.values():
            at = 0
            for o, n in sorted(p):
                assert o == at
                at += n
            assert at <= 1024
