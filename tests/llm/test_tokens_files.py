"""Tokenised outputs: encoder, bit-plane files, packing, against brute force."""
import random
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from quire.llm import bitplane as B
from quire.llm import packing as P
from quire.llm.queries import SPARK_QUERIES
from quire.llm.tokens import Encoder, default_vocabulary

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, bucket string, length string"
ODD = [(3, None, "en", "a", 0, "x", "y", "z"), (1, "", None, None, 0, "x", "y", "z"),
       (2, "one two  three\n\n four ", "en", "a", 5, "x", "y", "z"), (2, "one two  three\n\n four ", "en", "a", 5, "x", "y", "z"),
       (None, "no id", "en", "b", 5, "x", "y", "z"), (7, "wordy sentence, more. " * 6000, "en", "b", 1, None, None, None)]


@pytest.fixture(scope="module")
def tok():
    t = Tokenizer.from_file(default_vocabulary())
    t.encode_special_tokens = True
    return t


def ids_of(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_encoder_equals_the_library(tok):
    rng = random.Random(5)
    bits = ["a", "Éai", " ", "  ", "\n", "\t", ".", ",", "'s", "1", " ", "<|endoftext|>", "²", "中", "\r\n", "!", "'", "\x1c", "😀", "thnd"]
    small = Encoder(default_vocabulary(), limit=64)      # forgets all the time
    for _ in range(3000):
        s = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(small.ids(s), "<u4").tolist() == tok.encode(s, add_special_tokens=False).ids, repr(s)
    assert len(small.after) <= 64 and len(small.after.old) <= 64


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_planes_round_trip(unit):
    ids = np.random.default_rng(1).integers(0, 2 ** 32, 1001, dtype=np.uint32)
    for a in (ids, ids & 255, ids[:0]):
        planes = [p if p.strip(b"\0") else None for p in B.split_planes(a, unit)]
        assert (B.join_planes(planes, len(a), unit) == a).all()


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_shards_hold_every_document(spark, tmp_path, tok, unit):
    docs = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    man = B.write_ids(docs, str(tmp_path / unit), unit=unit, block=1000, parts=2)
    got = sorted(((r.doc_id is not None, r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in B.read_documents(spark, man).collect()),
                 key=lambda r: r[2])
    want, at = [], 0
    for r in sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(tok, r[1])
        want.append((r[0] is not None, r[0], at, len(ids), crc(ids)))
        at += len(ids)
    assert got == want
    assert sum(r["n_ids"] for r in man.collect()) == at


def test_no_documents_no_files(spark, tmp_path):
    man = B.write_ids(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"))
    assert man.count() == 0 and B.read_documents(spark, man).count() == 0


def test_op2_query_against_brute_force(spark, tok):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()
    want, at = [], 0
    for d, t in rows:
        ids = ids_of(tok, t)
        want.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    got = SPARK_QUERIES["op2_bitplane_ids"](spark, SF).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want


def check_packing(rows, ids):
    """Every id once, nothing overlaps, sequences are gapless and at most 1024 long."""
    seqs, docs = {}, {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append(r)
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 1024
    for d, ps in docs.items():
        at = 0
        for k, r in enumerate(sorted(ps, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == 1024)
            assert r.ids_crc32 == crc(ids[d][at:at + r.length])
            at += r.length
        assert at == len(ids[d]) and (len(ps) == 1 or at > 1024)
    return len(seqs)


def best_fit(lengths, cap=1024):
    """Plain best-fit decreasing, one piece at a time."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, g in enumerate(gaps) if g >= n]
        if fits:
            gaps[min(fits, key=lambda i: gaps[i])] -= n
        else:
            gaps.append(cap - n)
    return len(gaps)


def test_op4_query_against_brute_force(spark, tok):
    ids = {d: ids_of(tok, t) for d, t in duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()}
    rows = SPARK_QUERIES["op4_best_fit"](spark, SF).collect()
    made = check_packing(rows, ids)
    assert {r.doc_id for r in rows} == set(ids)
    assert made <= best_fit([r.length for r in rows]) + 1


def test_plan_is_a_packing_and_matches_best_fit():
    rng = random.Random(2)
    for _ in range(200):
        cap = rng.choice([1024, 64, 10])
        counts = {}
        for _ in range(rng.randint(0, 300)):
            n = rng.randint(1, cap)
            counts[n] = counts.get(n, 0) + 1
        made = P.plan(counts, cap)
        got = {}
        for contents, k in made:
            assert k > 0 and sum(n * m for n, m in contents) <= cap
            assert sum(m for n, m in contents if 3 * n > cap) <= 2
            for n, m in contents:
                got[n] = got.get(n, 0) + m * k
        assert got == counts
        lengths = [n for n, c in counts.items() for _ in range(c)]
        assert sum(k for _, k in made) <= best_fit(lengths, cap) + 1


def test_odd_documents_pack(spark, tok):
    docs = spark.createDataFrame([r for r in ODD if r[0] is not None], SCHEMA)
    rows = P.pack_documents(docs).collect()
    assert sorted((r.doc_id, r.length) for r in rows if r.doc_id in (1, 3)) == [(1, 1), (3, 1)]
    assert len([r for r in rows if r.doc_id == 2]) == 2          # repeated rows are pieces of their own
    cut = P.pieces(docs, with_ids=True)
    seqs = P.sequences(P.pack(cut)).collect()
    assert sum(s.n_ids for s in seqs) == sum(len(ids_of(tok, r[1])) for r in ODD if r[0] is not None)
    assert P.pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0
