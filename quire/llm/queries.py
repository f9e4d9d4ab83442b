"""The registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.llm.common import scratch_path, table

SPARK_QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(f):
    SPARK_QUERIES[f.__name__] = f
    return f


@query
def op1_pii_sanitise(spark, sf_dir):
    from quire.llm import pii
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.revealing_terms(docs))
    terms = F.array_join(F.transform("hits", lambda h: F.concat(F.lit("term:"), h["start"], F.lit(":"), h["end"])), ",")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
                        F.concat_ws(",", F.nullif("base", F.lit("")), F.nullif(terms, F.lit(""))).alias("spans"))


@query
def op2_bitplane_ids(spark, sf_dir):
    from quire.llm.bitplane import roundtrip
    return roundtrip(table(spark, sf_dir, "documents"))


@query
def op3_source_mix(spark, sf_dir):
    from quire.llm.mixing import mix
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op3_source_mix"] = r"""WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('17:' || CAST(doc_id AS VARCHAR)) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(r - 1) % 3 + 1] AS weight, 3 * source_size AS cap FROM s),
o AS (SELECT *, sum(cap) OVER b AS cap_sum, sum(weight) OVER b AS weight_sum FROM w
      WINDOW b AS (ORDER BY cap::DOUBLE / weight, r)),
t AS (SELECT sum(source_size) AS total, sum(weight) AS all_w FROM w),
l AS (SELECT o.*, cap::DOUBLE * (all_w - weight_sum + weight)::DOUBLE <= weight::DOUBLE * (total - cap_sum + cap)::DOUBLE AS limited FROM o, t),
e AS (SELECT (total - coalesce(sum(cap) FILTER (limited), 0))::DOUBLE
             / nullif(all_w - coalesce(sum(weight) FILTER (limited), 0), 0)::DOUBLE AS share
      FROM l, t GROUP BY total, all_w),
g AS (SELECT source, source_size, CASE WHEN limited THEN cap::DOUBLE ELSE coalesce(share, 0) * weight END AS target FROM l, e),
p AS (SELECT d.doc_id, d.size, g.source_size, g.target, CAST(floor(g.target + 0.5) AS BIGINT) AS budget,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS pos
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
q AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - pos)) AS BIGINT) AS taken FROM q"""


@query
def op4_best_fit(spark, sf_dir):
    from quire.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"))


@query
def op5_syncmers(spark, sf_dir):
    from quire.llm.syncmers import compare_with_edits
    return compare_with_edits(table(spark, sf_dir, "documents"))


@query
def op6_impact_topk(spark, sf_dir):
    from quire.llm.impact import top_k
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLES["op6_impact_topk"] = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(list_zip(q.v, x.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


@query
def op7_warc(spark, sf_dir):
    from quire.llm.warc import roundtrip
    return roundtrip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op7_warc"] = """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM p),
b AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS best FROM h)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substring(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> best THEN best END AS refers_to
FROM b"""


@query
def op8_ngram_trie(spark, sf_dir):
    from quire.llm.ngram_trie import join_documents
    return join_documents(table(spark, sf_dir, "documents"))


ORACLES["op8_ngram_trie"] = r"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1),
             lambda i: md5_number_lower(array_to_string(w[i:i + 2], ' ')))) AS s FROM w),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n >= 90 * (len(x.s) + len(y.s) - n)),
sym AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM s UNION SELECT reach.doc_id, sym.b FROM reach JOIN sym ON sym.a = reach.r)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id
FROM s JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)"""


@query
def op9_reply_trees(spark, sf_dir):
    from quire.llm.replytree import format_trees, linear_tree, read_formatted
    extra = spark.sql("SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(t AS BIGINT) AS turn, r AS role, '</s>[INST] ok [/INST]' AS text "
                      "FROM VALUES (0, 'user'), (1, 'assistant') AS v(t, r)")
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    path = scratch_path(spark, "chats")
    format_trees(linear_tree(conv)).write.parquet(path)
    back = read_formatted(spark.read.parquet(path))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


ORACLES["op9_reply_trees"] = r"""WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
g AS (SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
             sum(length('<|turn:|>' || chr(10) || '<|end|>' || chr(10)) + length(regexp_replace(role, '\|(\\*)>', '|\\\1>', 'g'))
                 + length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g'))) AS f
      FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(f AS BIGINT) AS formatted_chars FROM g"""


@query
def op10_compression_langid(spark, sf_dir):
    from quire.llm.langid import classify, fit, held_out
    docs = table(spark, sf_dir, "documents")
    got = classify(docs.select("doc_id", "text"), fit(docs))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"),
                      F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected"))


@query
def op12_bpe(spark, sf_dir):
    from quire.llm.bpe import decode, encode
    both = decode(encode(table(spark, sf_dir, "documents")))
    said = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(said, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op11_laesa_codes(spark, sf_dir):
    from quire.llm.laesa import compress
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.digest() if books else None).alias("codebooks_sha256"))


def _codes_sql() -> str:
    """Codebooks of 16 parts of 4 components, unrolled: start, two rounds, codes."""
    def assigned(book):
        return (f"SELECT vec_id, part, any_value(p.x) AS x, min(list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + entry) "
                f"AS m FROM p JOIN {book} b USING (part) GROUP BY vec_id, part")

    def moved(book, a):
        means = ", ".join(f"CAST(floor(CAST(sum(x[{i}]) AS DOUBLE) / count(*)) AS HUGEINT)" for i in range(1, 5))
        return (f"SELECT part, entry, coalesce(n.x, b.x) AS x FROM {book} b LEFT JOIN "
                f"(SELECT part, CAST(m % 64 AS BIGINT) AS entry, [{means}] AS x FROM {a} GROUP BY 1, 2) n USING (part, entry)")

    return f"""WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT vec_id, part, v[4 * part + 1:4 * part + 4] AS x FROM v, range(16) AS r(part)),
b0 AS (SELECT part, entry, x FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM p) WHERE entry < 64),
a0 AS MATERIALIZED ({assigned('b0')}), b1 AS MATERIALIZED ({moved('b0', 'a0')}),
a1 AS MATERIALIZED ({assigned('b1')}), b2 AS MATERIALIZED ({moved('b1', 'a1')}),
a2 AS MATERIALIZED ({assigned('b2')}),
c AS (SELECT vec_id, string_agg(printf('%02x', CAST(m % 64 AS BIGINT)), '' ORDER BY part) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM a2 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM b2) AS codebooks_sha256
FROM c JOIN v USING (vec_id)"""


ORACLES["op11_laesa_codes"] = _codes_sql()


@query
def op13_filter_audit(spark, sf_dir):
    from quire.llm.filter_audit import audit
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op13_filter_audit"] = r"""WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
             + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
      FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, CAST(mask AS INTEGER) AS mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY 1, 2),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, CAST(1 << (ascii(substring(filter_order, step, 1)) - 65) AS INTEGER) AS bit,
             CAST(coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substring(filter_order, i, 1)) - 65))), 0) AS INTEGER) AS before
      FROM o, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step))
SELECT c.part, filter_order, step,
       CAST(coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS BIGINT) AS kept,
       CAST(coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS BIGINT) AS removed,
       CAST(coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0) AS BIGINT) AS redundant,
       CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS BIGINT) AS good_lost,
       CAST(coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) FILTER (mask & bit <> 0), 0) AS BIGINT) AS shapley
FROM c, s GROUP BY c.part, filter_order, step"""
