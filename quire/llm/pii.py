"""Information-theoretic sanitisation of personal data.

The protected entities are the personal data found by pattern: email addresses,
IP addresses, payment cards, phone numbers. Corpus co-occurrence then estimates
how strongly a term reveals one of them. A context is the ``window`` terms on
either side of a mention; with ``N`` contexts' worth of terms in the corpus, a
term ``t`` discloses the share ``PMI(t; c) / IC(c)`` of an entity ``c``, where
``PMI = log(N n(t,c) / (n(t) n(c)))`` and ``IC = log(N / n(c))``: 1 for a term that
occurs with ``c`` only. Terms are runs of letters and digits, of three or more, or
shorter where they hold a letter outside ASCII. ``c`` is a single value, and also each
kind as a whole (any email address, any phone number, ...), so a name beside values
that occur once each is found by their kind. Terms at ``generalise_at`` or above for a value or a
kind are generalised, at ``remove_at`` or above removed, wherever they occur.

A pair is estimated from ``min_contexts`` different texts on: copies of one text
prove nothing, the same signature in different texts does. A value's pair with
fewer texts has no estimate of its own, but its mentions count for the pair of its
kind; a kind's pair with fewer texts leaves the term as it is.

All counts cover the whole corpus. What a pass over the texts looks for is sent
as a bitmap of fixed size (false positives fall out in the exact join that
follows), never as a list.

Defined results: null text is empty (and stays null when sanitised); repeated
rows are treated alike; an empty table gives an empty result; other columns pass
through; overlapping spans are replaced together, by the label of the first.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import bitmap_of, free_name, frees_memory, ship_package, slices, stage

KINDS = ("email", "ip", "card", "phone")
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "generalise": "[TERM]", "remove": ""}
TERM = re.compile(r"[^\W_]{3,}|[^\W_a-zA-Z0-9][^\W_]?|[^\W_][^\W_a-zA-Z0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# possessive and anchored forms of the patterns: the same matches in linear time
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if k % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their ``@``: one pass however long the words are."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
        else:
            last = max(last, at)       # nothing before this sign can be part of a later address
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) in code points, by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((1, *m.span()))
        for m in _CARD.finditer(text):
            d = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(d) <= 19 and luhn(d):
                out.append((2, *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    out.append((3, *m.span()))
    return out


def entity(kind: int, raw: str) -> str:
    """One name for all spellings of an entity."""
    return KINDS[kind] + ":" + (raw.lower() if kind == 0 else raw if kind == 1 else _NOT_DIGIT.sub("", raw))


def free_terms(text: str, spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int], list[str]]:
    """Starts, ends and lower-cased forms of the terms outside all spans: one walk
    over the terms and the sorted spans, however many there are of either."""
    taken = sorted((a, b) for _, a, b in spans)
    starts, ends, terms, i, upto = [], [], [], 0, -1
    for m in TERM.finditer(text):
        a, b = m.span()
        while i < len(taken) and taken[i][0] < b:
            upto = max(upto, taken[i][1])
            i += 1
        # of the spans that start before the term's end, none reaches into it
        if upto <= a:
            starts.append(a)
            ends.append(b)
            terms.append(m.group().lower())
    return starts, ends, terms


def context(free: tuple[list[int], list[int], list[str]], start: int, end: int, window: int) -> list[str]:
    """The ``window`` free terms nearest to a mention on either side, however far away they stand."""
    starts, ends, terms = free
    i, j = bisect_right(ends, start), bisect_left(starts, end)
    return terms[max(0, i - window):i] + terms[j:j + window]


@frees_memory
def _contexts(batches, window: int):
    """(entity, term, whole, n): mentions of an entity or kind in a text with the term in their context; a null term counts all."""
    def out(rows):
        return pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))],
                               ["entity", "term", "whole", "n"])

    for batch in slices(batches):
        rows = []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text) if text else []
            if not spans:
                continue
            whole = int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)
            free = free_terms(text, spans)
            seen: Counter = Counter()
            for k, a, b in spans:
                terms = [None, *set(context(free, a, b, window))]
                seen.update((c, t) for c in (entity(k, text[a:b]), KINDS[k]) for t in terms)
            rows += [(c, t, whole, n) for (c, t), n in seen.items()]
            if len(rows) >= 50_000:
                yield out(rows)
                rows = []
        yield out(rows)


@frees_memory
def _count(batches, wanted):
    """(term, n) of the terms that the bitmap admits, summed over the task; a null term counts all."""
    def out(rows):
        return pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["term", "n"])

    total, every = Counter(), 0
    for batch in slices(batches):
        seen: Counter = Counter()
        for text in batch.column("text").to_pylist():
            if text:
                seen.update(TERM.findall(text))
        every += sum(seen.values())
        words = list(seen)
        hit = wanted.admits(np.fromiter((zlib.crc32(w.lower().encode()) for w in words), np.int64, len(words)))
        for w, ok in zip(words, hit.tolist()):
            if ok:
                total[w.lower()] += seen[w]
        if len(total) > 200_000:
            yield out(list(total.items()))
            total.clear()
    yield out([*total.items(), (None, every)])


def revealing_terms(docs: DataFrame, text_col: str = "text", window: int = 8, min_contexts: int = 3,
                    generalise_at: float = 0.8, remove_at: float = 0.95) -> DataFrame:
    """(term, disclosure, action): the corpus's terms that reveal a protected entity."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(text_col).alias("text"))
    seen = texts.mapInArrow(partial(_contexts, window=window), "entity string, term string, whole long, n long")
    # different texts are counted in two combinable steps, so a kind's terms are never in one task
    by_text = seen.groupBy("entity", "term", "whole").agg(F.sum("n").alias("n"))
    met = stage(by_text.groupBy("entity", "term").agg(F.sum("n").alias("n_tc"), F.count(F.lit(1)).alias("texts")), "pii_contexts")
    known = met.where("term is null").select("entity", F.col("n_tc").alias("n_c"))
    enough = met.where(F.col("term").isNotNull() & (F.col("texts") >= min_contexts)).select("entity", "term", "n_tc")
    of_kind = F.col("entity").isin(*KINDS)
    pairs = stage(enough.where(~of_kind).join(known.where(~of_kind), "entity")
                  .unionByName(enough.where(of_kind).join(F.broadcast(known.where(of_kind)), "entity")), "pii_pairs")   # one row a kind
    none = "term string, disclosure double, action string"
    if pairs.isEmpty():
        return spark.createDataFrame([], none)
    wanted = bitmap_of(pairs.select(F.crc32(F.col("term").cast("binary")).alias("h")), "h")
    counts = stage(texts.mapInArrow(partial(_count, wanted=wanted), "term string, n long")
                   .groupBy("term").agg(F.sum("n").alias("n_t")), "pii_counts")
    total = counts.where("term is null").first()["n_t"]
    n = F.lit(float(total) / (2 * window))
    tc = F.col("n_tc").cast("double")
    ic = F.log(n / F.col("n_c"))
    pmi = F.log(n * tc / (F.greatest(F.col("n_t"), F.col("n_tc")) * F.col("n_c")))
    out = (pairs.join(counts, "term").where(F.col("n_c") < n).groupBy("term").agg(F.max(pmi / ic).alias("disclosure"))
           .where(F.col("disclosure") >= generalise_at))
    return stage(out.withColumn("action", F.when(F.col("disclosure") >= remove_at, "remove").otherwise("generalise")), "pii_terms")


@frees_memory
def _find(batches, wanted):
    for batch in slices(batches):
        rows = []
        for doc, key, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "key", "text")]):
            text = text or ""
            spans = base_spans(text)
            terms = []
            if wanted is not None and text:
                words = list(set(TERM.findall(text)))
                hit = wanted.admits(np.fromiter((zlib.crc32(w.lower().encode()) for w in words), np.int64, len(words)))
                some = {w.lower() for w, ok in zip(words, hit) if ok}
                if some:
                    terms = [{"term": t, "start": a, "end": b} for a, b, t in zip(*free_terms(text, spans)) if t in some]
            named = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)
            n = Counter(k for k, _, _ in spans)
            rows.append((doc, key, n[0], n[1], n[2], n[3], hashlib.sha256(named.encode()).hexdigest(), named, terms))
        types = [pa.string(), *[pa.int64()] * 5, pa.string(), pa.string(),
                 pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))]
        yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                              ["doc_id", "key", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "cand"])


FOUND = ("doc_id string, key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
         "cand array<struct<term:string,start:int,end:int>>")


def _term_hits(cand: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, key, hits): the exact term spans of every document that has some."""
    one = cand.where(F.size("cand") > 0).select("doc_id", "key", F.explode("cand").alias("c")).select("doc_id", "key", "c.*")
    return (one.join(terms.select("term", "action"), "term").groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k"))
            .agg(F.sort_array(F.collect_set(F.struct("start", "end", "action"))).alias("hits")))


def _wanted(terms: DataFrame):
    return None if terms.isEmpty() else bitmap_of(terms.select(F.crc32(F.col("term").cast("binary")).alias("h")), "h")


def find(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, base, hits) of every row: the
    pattern spans as ``kind:start:end`` and the revealing terms as (start, end, action)."""
    ship_package(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    found = stage(narrow.mapInArrow(partial(_find, wanted=_wanted(terms)), FOUND), "pii_found")
    hits = _term_hits(found, terms)
    out = found.drop("cand").join(hits, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left").drop("d", "k", "key")
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType)).withColumnRenamed("doc_id", id_col)


def clean_text(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with (start, end, label) replaced; overlapping spans together, by the first one's label."""
    out, at, i = [], 0, 0
    spans = sorted(spans)
    while i < len(spans):
        a, b, label = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < b:
            b = max(b, spans[i][1])
            i += 1
        out += [text[at:a], label]
        at = b
    return "".join(out) + text[at:]


@frees_memory
def _clean(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Texts with their spans replaced, unpacked a stretch at a time."""
    for texts, hits in columns:
        done = []
        for at in range(0, len(texts), 256):
            out = []
            for text, h in zip(texts.slice(at, 256).to_pylist(), hits.slice(at, 256).to_pylist()):
                if text:
                    spans = [(a, b, LABELS[KINDS[k]]) for k, a, b in base_spans(text)]
                    spans += [(x["start"], x["end"], LABELS[x["action"]]) for x in (h or ())]
                    text = clean_text(text, spans) if spans else text
                out.append(text)
            done.append(pa.array(out, pa.string()))
        yield pa.concat_arrays(done) if done else pa.array([], pa.string())


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars", **options) -> DataFrame:
    """The columns and rows of ``docs`` with personal data replaced by labels and
    revealing terms generalised or removed; ``chars_col`` is brought up to date."""
    terms = revealing_terms(docs, text_col, **options)
    ship_package(docs.sparkSession)
    wanted = _wanted(terms)
    cols = docs.columns
    i, k, hits_col, clean_col = (free_name(cols, x) for x in ("hit_id", "hit_key", "hit_spans", "clean_text"))
    if wanted is None:
        joined = docs.withColumn(hits_col, F.lit(None).cast("array<struct<start:int,end:int,action:string>>"))
    else:
        narrow = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
        found = narrow.mapInArrow(partial(_find, wanted=wanted), FOUND).where(F.size("cand") > 0).select("doc_id", "key", "cand")
        hits = stage(_term_hits(found, terms), "pii_hits").select(F.col("d").alias(i), F.col("k").alias(k), F.col("hits").alias(hits_col))
        joined = docs.join(hits, docs[id_col].cast("string").eqNullSafe(F.col(i)) & (F.xxhash64(docs[text_col]) == F.col(k)), "left")
    joined = joined.withColumn(clean_col, F.arrow_udf(_clean, "string")(F.col(text_col), F.col(hits_col)))
    out = {c: F.col(c) for c in cols} | {text_col: F.col(clean_col)}
    if chars_col in cols:
        out[chars_col] = F.length(clean_col).cast("long")
    return joined.select(*[v.alias(c) for c, v in out.items()])
