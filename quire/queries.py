"""Registered queries (Spark) and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. Column names are aliased identically on both sides. Inputs derived
from the tables:

* ``doc_instr``  - ``documents``: first line = instruction, rest = output,
  input = "" (``row_id = doc_id``).
* ``conv_instr`` - ``conversations``: a user turn, the directly following
  assistant turn, the directly preceding system turn as input.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.bleu import TOK13A_REGEX
from quire.functions.porter_sql import stem_chain, stem_table
from quire.functions.templates import render_chat, split_prompt_reference
from quire.functions.text import (WS_CLASS, content_hash, normalize_text, seeded_rank, text_preview,
                                  truncate_ws_tokens)
from quire.operators import generate as G
from quire.operators import render as R
from quire.operators import scoring as S
from quire.operators import sweep as W
from quire.operators.audit import disjointness_audit, dry_run_report, prompt_leakage
from quire.operators.dedupe import dedupe_keep_first
from quire.operators.history import DEFAULT_SYSTEM, assemble_history
from quire.operators.split import batch_plan, cut_split, take_first
from quire.plans.evaluate import prompt_reference_frame
from quire.plans.prepare import PrepConfig, build_splits, plan_splits
from quire.sources.readers import (conversation_instructions, conversation_row_id, doc_instructions,
                                   documents_as_instructions, read_instructions, table)

SEED = 42
HOLDOUT = 100          # eval rows wanted (capped at n // 5)
SUBSAMPLE = 500        # train rows wanted
TAKE_N = 50            # D6 first-n evaluation slice
TRUNC_TOKENS = 64      # P10 token budget
PREVIEW_N = 200        # S3/A2 preview size
WHOLE = 1 << 40        # holdout and train size of queries where no cut is meant
GEN_TOKENS = 16        # stand-in generators: words per prediction

# Python-exact whitespace class, valid in DuckDB (RE2) regexes as well.
WS = WS_CLASS


def sql_strip(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def sql_norm(e: str) -> str:
    return f"regexp_replace({sql_strip(f'lower({e})')}, '{WS}+', ' ', 'g')"


def sql_hash(e: str) -> str:
    return f"sha256({sql_norm(e)})"


def sql_tokens(e: str) -> str:
    s = sql_strip(f"coalesce({e}, '')")
    return f"(CASE WHEN {s} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array({s}, '{WS}+') END)"


NL = "chr(10)"

# --- shared SQL inputs ------------------------------------------------------
SQL_DOC_INSTR = f"""doc_instr AS (
  SELECT doc_id AS row_id,
         CASE WHEN instr(text, {NL}) > 0 THEN substring(text, 1, instr(text, {NL}) - 1) ELSE text END AS instruction,
         '' AS input,
         CASE WHEN instr(text, {NL}) > 0 THEN substring(text, instr(text, {NL}) + 1) ELSE '' END AS output,
         CAST(NULL AS VARCHAR) AS response
  FROM documents)"""

SQL_CONV_INSTR = f"""conv_t AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
         lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS next_turn,
         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role,
         lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_turn,
         lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_text
  FROM conversations),
conv_instr AS (
  SELECT conv_id, turn, conv_id::VARCHAR || ':' || turn::VARCHAR AS row_id,
         text AS instruction,
         CASE WHEN prev_role = 'system' AND prev_turn = turn - 1 THEN prev_text ELSE '' END AS input,
         next_text AS output, CAST(NULL AS VARCHAR) AS response
  FROM conv_t
  WHERE role = 'user' AND next_role = 'assistant' AND next_turn = turn + 1)"""


def sql_clean(src: str) -> str:
    return f"""{src}_clean AS (
  SELECT *, {sql_strip("coalesce(instruction, '')")} AS c_instruction,
         {sql_strip("coalesce(input, '')")} AS c_input,
         {sql_strip("coalesce(CASE WHEN output IS NULL OR output = '' THEN response ELSE output END, '')")} AS c_output
  FROM {src}),
{src}_msg AS (
  SELECT *, CASE WHEN c_input = '' THEN c_instruction ELSE c_instruction || {NL} || {NL} || c_input END AS c_user
  FROM {src}_clean)"""


def sql_plain(user="c_user", asst="c_output") -> str:
    return f"'### Instruction:' || {NL} || {user} || {NL} || {NL} || '### Response:' || {NL} || {asst}"


def sql_rendered(src: str) -> str:
    """``{src}_text(row_id, text)`` rendered with the plain template, blank dropped."""
    return f"""{sql_clean(src)},
{src}_text AS (
  SELECT row_id, {sql_plain()} AS text FROM {src}_msg
  WHERE {sql_strip(sql_plain())} <> '')"""


def sql_split(src: str, holdout=HOLDOUT, size=SUBSAMPLE, seed=SEED) -> str:
    """``{src}_split(row_id, text, content_hash, split_rank, n_copies, split)``."""
    return f"""{sql_rendered(src)},
{src}_h AS (SELECT row_id, text, {sql_hash('text')} AS content_hash FROM {src}_text),
{src}_d AS (
  SELECT content_hash, arg_min(row_id, row_id) AS row_id, arg_min(text, row_id) AS text,
         count(*) AS n_copies
  FROM {src}_h GROUP BY content_hash),
{src}_r AS (
  SELECT *, sha256('{seed}:' || content_hash) AS split_rank FROM {src}_d),
{src}_p AS (
  SELECT *, row_number() OVER (ORDER BY split_rank) AS pos, count(*) OVER () AS n FROM {src}_r),
{src}_sz AS (
  SELECT n, least({holdout}, greatest(1, n // 5), n) AS eval_n FROM (SELECT count(*) AS n FROM {src}_r)),
{src}_split AS (
  SELECT p.row_id, p.text, p.content_hash, p.split_rank, p.n_copies,
         CASE WHEN p.pos <= s.eval_n THEN 'eval' ELSE 'train' END AS split
  FROM {src}_p p, {src}_sz s
  WHERE p.pos <= s.eval_n + least({size}, s.n - s.eval_n))"""


# --- Spark helpers ------------------------------------------------------------
def _doc_splits(spark, sf_dir, split_key="text", holdout=HOLDOUT, size=SUBSAMPLE):
    """The split of ``doc_instr`` by its keys (no texts)."""
    cfg = PrepConfig(seed=SEED, eval_holdout_size=holdout, subsample_size=size, split_key=split_key)
    return plan_splits(doc_instructions(spark, sf_dir), cfg)


# --- queries ------------------------------------------------------------------
def q_clean_render_plain(spark, sf_dir):
    """P1-P4 on doc_instr."""
    return R.render(doc_instructions(spark, sf_dir), "plain")


def q_conv_render_plain(spark, sf_dir):
    """P1-P4 on conv_instr (non-empty inputs exercise P2)."""
    return R.render(conversation_instructions(spark, sf_dir), "plain")


def q_render_inst(spark, sf_dir):
    """P5, ``inst`` template over the messages array."""
    return R.render(conversation_instructions(spark, sf_dir), "inst")


def q_render_role_header(spark, sf_dir):
    """P5, ``role_header`` template."""
    return R.render(conversation_instructions(spark, sf_dir), "role_header")


def q_to_messages(spark, sf_dir):
    """The message array, read back element-wise."""
    m = R.with_messages(conversation_instructions(spark, sf_dir))
    return m.select("row_id", F.size("messages").alias("n_messages"),
                    F.col("messages")[0]["role"].alias("role_0"), F.col("messages")[0]["content"].alias("content_0"),
                    F.col("messages")[1]["role"].alias("role_1"), F.col("messages")[1]["content"].alias("content_1"))


def q_content_hash(spark, sf_dir):
    """P7 over the raw documents."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", content_hash("text").alias("content_hash"),
                    F.length(normalize_text("text")).alias("norm_chars"))


def q_dedupe_first(spark, sf_dir):
    """Keep-first per normalised hash of the rendered doc_instr text."""
    t = R.with_content_hash(R.drop_blank(R.render(doc_instructions(spark, sf_dir), "plain")))
    return dedupe_keep_first(t.select("row_id", "content_hash"), "content_hash", ("row_id",))


def q_seeded_split(spark, sf_dir):
    """Exact seeded eval/train cut."""
    splits, _, _ = _doc_splits(spark, sf_dir)
    return splits.select("row_id", "content_hash", "split_rank", "split")


def q_take_first(spark, sf_dir):
    """First TAKE_N eval rows in split order."""
    splits, _, _ = _doc_splits(spark, sf_dir)
    return take_first(splits.filter(F.col("split") == "eval"), TAKE_N).select("row_id", "split_rank")


def q_disjointness(spark, sf_dir):
    """D5 on the split of the whole table (a fifth held out)."""
    splits, _, _ = _doc_splits(spark, sf_dir, holdout=WHOLE, size=WHOLE)
    return disjointness_audit(splits.filter(F.col("split") == "train"),
                              splits.filter(F.col("split") == "eval"), fail=True)


def q_manifest_counts(spark, sf_dir):
    """A3: counts over the staged and split tables."""
    splits, staged, _ = _doc_splits(spark, sf_dir)
    pre = staged.agg(F.sum("n_copies").cast("long").alias("raw"), F.count(F.lit(1)).alias("after_dedupe"))
    by = splits.groupBy().agg(F.count(F.when(F.col("split") == "train", 1)).alias("train"),
                              F.count(F.when(F.col("split") == "eval", 1)).alias("eval_holdout"))
    return pre.unionByName(by, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("raw", "after_dedupe", "train", "eval_holdout")])


def q_prompt_leakage(spark, sf_dir):
    """Eval rows of the whole conv split whose prompt is also in train."""
    cfg = PrepConfig(seed=SEED, eval_holdout_size=WHOLE, subsample_size=WHOLE)
    splits, _, _ = build_splits(conversation_instructions(spark, sf_dir), cfg)
    leaks = prompt_leakage(splits.filter(F.col("split") == "train"), splits.filter(F.col("split") == "eval"))
    return leaks.select("content_hash", "prompt_hash")


def q_empty_input(spark, sf_dir):
    """conv_instr rows with an empty input, by flag."""
    f = R.flag_empty_input(conversation_instructions(spark, sf_dir))
    return f.groupBy("empty_input").agg(F.count(F.lit(1)).alias("rows"))


def q_prompt_reference(spark, sf_dir):
    """P8 on rendered conv_instr texts (templates with and without markers)."""
    c = R.with_messages(conversation_instructions(spark, sf_dir))
    out = []
    for name in ("plain", "inst", "role_header"):
        t = render_chat(F.col("messages"), name)
        out.append(c.select("row_id", F.lit(name).alias("template"),
                            split_prompt_reference(t).alias("pr")))
    # raw turns (no markers in most): exercises the half-length fallback
    raw = table(spark, sf_dir, "conversations").select(
        conversation_row_id().alias("row_id"), F.lit("raw").alias("template"),
        split_prompt_reference("text").alias("pr"))
    u = out[0].unionByName(out[1]).unionByName(out[2]).unionByName(raw)
    return u.select("row_id", "template", F.col("pr.prompt").alias("prompt"), F.col("pr.reference").alias("reference"))


def q_truncate_tokens(spark, sf_dir):
    """P10 (whitespace tokens) on the rendered doc_instr text."""
    t = R.render(doc_instructions(spark, sf_dir), "plain")
    tr = truncate_ws_tokens("text", TRUNC_TOKENS)
    return t.select("row_id", tr["text"].alias("text"), tr["n_tokens"].alias("n_tokens"),
                    tr["was_truncated"].alias("was_truncated"))


def q_text_preview(spark, sf_dir):
    """300-character preview of every rendered text."""
    t = R.render(doc_instructions(spark, sf_dir), "plain")
    return t.select("row_id", text_preview("text", 300).alias("preview"))


def q_preview(spark, sf_dir):
    """S3: the first PREVIEW_N rows in input order (the limit is the feature)."""
    from quire.sources.readers import preview
    return preview(doc_instructions(spark, sf_dir), PREVIEW_N).select("row_id", "instruction")


def q_dry_run_report(spark, sf_dir):
    """A2 on the first PREVIEW_N doc_instr rows."""
    r = dry_run_report(doc_instructions(spark, sf_dir), PREVIEW_N)
    return r.withColumn("columns", F.array_join("columns", ","))


def q_conv_pairs(spark, sf_dir):
    """conv_instr itself: skew-safe pair assembly."""
    return conversation_instructions(spark, sf_dir).select("row_id", "instruction", "input", "output")


def q_batch_plan(spark, sf_dir):
    """Exact position, micro-batch and step of each train row of the whole table."""
    splits, _, _ = _doc_splits(spark, sf_dir, holdout=WHOLE, size=WHOLE)
    plan, _ = batch_plan(splits.filter(F.col("split") == "train"), 8, 4)
    return plan.select("row_id", "pos", "micro_batch", "step")


SPARK_QUERIES = {
    "clean_render_plain": q_clean_render_plain,
    "conv_render_plain": q_conv_render_plain,
    "render_inst": q_render_inst,
    "render_role_header": q_render_role_header,
    "to_messages": q_to_messages,
    "conv_pairs": q_conv_pairs,
    "content_hash": q_content_hash,
    "dedupe_first": q_dedupe_first,
    "seeded_split": q_seeded_split,
    "take_first": q_take_first,
    "disjointness": q_disjointness,
    "manifest_counts": q_manifest_counts,
    "prompt_leakage": q_prompt_leakage,
    "empty_input": q_empty_input,
    "prompt_reference": q_prompt_reference,
    "truncate_tokens": q_truncate_tokens,
    "text_preview": q_text_preview,
    "preview": q_preview,
    "dry_run_report": q_dry_run_report,
    "batch_plan": q_batch_plan,
}


# --- oracles ------------------------------------------------------------------
def _inst_sql() -> str:
    return (f"'<s>[INST] ' || c_user || ' [/INST]' || ' ' || c_output || '</s>'")


def _role_header_sql() -> str:
    return (f"'<|user|>' || {NL} || c_user || '</s>' || {NL} || '<|assistant|>' || {NL} || c_output || '</s>' || {NL}")


def _sql_prompt_ref(t: str) -> str:
    """P8 in SQL: markers in priority order, fallback len // 2."""
    markers = [("'### Response:' || chr(10)", 14), ("'[/INST]'", 7), ("'<|assistant|>'", 13), ("'assistant' || chr(10)", 10)]
    cut = f"CAST(floor(length({t}) / 2) AS BIGINT)"
    for m, ln in reversed(markers):
        cut = f"(CASE WHEN instr({t}, {m}) > 0 THEN instr({t}, {m}) + {ln} - 1 ELSE {cut} END)"
    return cut


ORACLES: dict[str, str] = {}

ORACLES["clean_render_plain"] = f"""WITH {SQL_DOC_INSTR}, {sql_clean('doc_instr')}
SELECT row_id, {sql_plain()} AS text FROM doc_instr_msg"""

ORACLES["conv_render_plain"] = f"""WITH {SQL_CONV_INSTR}, {sql_clean('conv_instr')}
SELECT row_id, {sql_plain()} AS text FROM conv_instr_msg"""

ORACLES["render_inst"] = f"""WITH {SQL_CONV_INSTR}, {sql_clean('conv_instr')}
SELECT row_id, {_inst_sql()} AS text FROM conv_instr_msg"""

ORACLES["render_role_header"] = f"""WITH {SQL_CONV_INSTR}, {sql_clean('conv_instr')}
SELECT row_id, {_role_header_sql()} AS text FROM conv_instr_msg"""

ORACLES["to_messages"] = f"""WITH {SQL_CONV_INSTR}, {sql_clean('conv_instr')}
SELECT row_id, CAST(2 AS INTEGER) AS n_messages, 'user' AS role_0, c_user AS content_0,
       'assistant' AS role_1, c_output AS content_1 FROM conv_instr_msg"""

ORACLES["conv_pairs"] = f"""WITH {SQL_CONV_INSTR}
SELECT row_id, instruction, input, output FROM conv_instr"""

ORACLES["content_hash"] = f"""SELECT doc_id, {sql_hash('text')} AS content_hash,
       CAST(length({sql_norm('text')}) AS INTEGER) AS norm_chars FROM documents"""

ORACLES["dedupe_first"] = f"""WITH {SQL_DOC_INSTR}, {sql_rendered('doc_instr')},
h AS (SELECT row_id, {sql_hash('text')} AS content_hash FROM doc_instr_text)
SELECT min(row_id) AS row_id, content_hash, count(*) AS n_copies FROM h GROUP BY content_hash"""

ORACLES["seeded_split"] = f"""WITH {SQL_DOC_INSTR}, {sql_split('doc_instr')}
SELECT row_id, content_hash, split_rank, split FROM doc_instr_split"""

ORACLES["take_first"] = f"""WITH {SQL_DOC_INSTR}, {sql_split('doc_instr')}
SELECT row_id, split_rank FROM doc_instr_split WHERE split = 'eval' ORDER BY split_rank LIMIT {TAKE_N}"""

ORACLES["disjointness"] = f"""WITH {SQL_DOC_INSTR}, {sql_split('doc_instr', WHOLE, WHOLE)},
t AS (SELECT DISTINCT content_hash FROM doc_instr_split WHERE split = 'train'),
e AS (SELECT DISTINCT content_hash FROM doc_instr_split WHERE split = 'eval')
SELECT (SELECT count(*) FROM t) AS train_unique_hashes,
       (SELECT count(*) FROM e) AS eval_unique_hashes,
       (SELECT count(*) FROM t JOIN e USING (content_hash)) AS intersection"""

ORACLES["manifest_counts"] = f"""WITH {SQL_DOC_INSTR}, {sql_split('doc_instr')}
SELECT (SELECT CAST(sum(n_copies) AS BIGINT) FROM doc_instr_d) AS raw,
       (SELECT count(*) FROM doc_instr_d) AS after_dedupe,
       (SELECT count(*) FROM doc_instr_split WHERE split = 'train') AS train,
       (SELECT count(*) FROM doc_instr_split WHERE split = 'eval') AS eval_holdout"""

ORACLES["prompt_leakage"] = f"""WITH {SQL_CONV_INSTR}, {sql_split('conv_instr', WHOLE, WHOLE)},
ph AS (SELECT content_hash, split,
              {sql_hash(f"substring(text, 1, {_sql_prompt_ref('text')})")} AS prompt_hash
       FROM conv_instr_split)
SELECT content_hash, prompt_hash FROM ph
WHERE split = 'eval' AND prompt_hash IN (SELECT prompt_hash FROM ph WHERE split = 'train')"""

ORACLES["empty_input"] = f"""WITH {SQL_CONV_INSTR}
SELECT {sql_strip("coalesce(input, '')")} = '' AS empty_input, count(*) AS rows
FROM conv_instr GROUP BY 1"""


def _pr_select(text_expr: str, template: str, src: str, id_expr: str = "row_id") -> str:
    cut = _sql_prompt_ref("t")
    return f"""SELECT {id_expr} AS row_id, '{template}' AS template, substring(t, 1, {cut}) AS prompt,
       {sql_strip(f"substring(t, {cut} + 1)")} AS reference
FROM (SELECT *, {text_expr} AS t FROM {src})"""


ORACLES["prompt_reference"] = f"""WITH {SQL_CONV_INSTR}, {sql_clean('conv_instr')}
{_pr_select(sql_plain(), 'plain', 'conv_instr_msg')}
UNION ALL {_pr_select(_inst_sql(), 'inst', 'conv_instr_msg')}
UNION ALL {_pr_select(_role_header_sql(), 'role_header', 'conv_instr_msg')}
UNION ALL {_pr_select('text', 'raw', 'conversations', "conv_id::VARCHAR || ':' || turn::VARCHAR")}"""

ORACLES["truncate_tokens"] = f"""WITH {SQL_DOC_INSTR}, {sql_clean('doc_instr')},
t AS (SELECT row_id, {sql_plain()} AS t, {sql_tokens(sql_plain())} AS toks FROM doc_instr_msg)
SELECT row_id, CASE WHEN len(toks) > {TRUNC_TOKENS}
         THEN array_to_string(regexp_extract_all(t, '{WS}*[^{WS[1:]}+')[1:{TRUNC_TOKENS}], '') ELSE t END AS text,
       CAST(len(toks) AS INTEGER) AS n_tokens, len(toks) > {TRUNC_TOKENS} AS was_truncated FROM t"""

ORACLES["text_preview"] = f"""WITH {SQL_DOC_INSTR}, {sql_clean('doc_instr')}
SELECT row_id, substring({sql_plain()}, 1, 300) AS preview FROM doc_instr_msg"""

ORACLES["preview"] = f"""WITH {SQL_DOC_INSTR}
SELECT row_id, instruction FROM doc_instr ORDER BY row_id LIMIT {PREVIEW_N}"""

ORACLES["dry_run_report"] = f"""WITH {SQL_DOC_INSTR}, s0 AS (SELECT * FROM doc_instr ORDER BY row_id LIMIT {PREVIEW_N}),
{sql_clean('s0')},
h AS (SELECT row_id, {sql_plain()} AS text, {sql_strip("coalesce(input, '')")} = '' AS empty_input FROM s0_msg),
h2 AS (SELECT *, {sql_strip('text')} <> '' AS non_empty, {sql_hash('text')} AS content_hash FROM h)
SELECT count(*) AS rows_streamed, 'input,instruction,output' AS columns,
       true AS instruction_present, true AS input_present, true AS output_present,
       count(*) FILTER (WHERE empty_input) AS empty_input_rows_in_slice,
       coalesce(arg_min(non_empty, row_id) FILTER (WHERE empty_input), true) AS empty_input_handled,
       coalesce(bool_and(non_empty), true) AS all_formatted_non_empty,
       count(DISTINCT content_hash) AS after_dedupe, CAST(0 AS BIGINT) AS split_overlap,
       substring(arg_min(text, row_id), 1, 300) AS sample_formatted_text
FROM h2"""

ORACLES["batch_plan"] = f"""WITH {SQL_DOC_INSTR}, {sql_split('doc_instr', WHOLE, WHOLE)},
t AS (SELECT row_id, row_number() OVER (ORDER BY split_rank) - 1 AS pos FROM doc_instr_split WHERE split = 'train')
SELECT row_id, pos, CAST(floor(pos / 8) AS BIGINT) AS micro_batch, CAST(floor(pos / 32) AS BIGINT) AS step FROM t"""


def q_split_counts(spark, sf_dir):
    """Flagship: rows and distinct hashes per split side."""
    splits, _, _ = _doc_splits(spark, sf_dir)
    return splits.groupBy("split").agg(F.count(F.lit(1)).alias("rows"),
                                       F.countDistinct("content_hash").alias("unique_hashes"))


SPARK_QUERIES["split_counts"] = q_split_counts
ORACLES["split_counts"] = f"""WITH {SQL_DOC_INSTR}, {sql_split('doc_instr')}
SELECT split, count(*) AS rows, count(DISTINCT content_hash) AS unique_hashes FROM doc_instr_split GROUP BY split"""


# --- evaluation: examples, stand-in generations, scores ------------------------


def eval_examples(spark, sf_dir):
    """(example_id, prompt, reference) of every conv_instr pair."""
    return prompt_reference_frame(R.render(conversation_instructions(spark, sf_dir), "plain"))


def stand_in_predictions(spark, sf_dir):
    """U2 with deterministic stand-ins: base echoes the prompt's last words,
    tuned emits the reference's first words; a fixed cost per token."""
    ex = eval_examples(spark, sf_dir)
    b = G.batch_generate(ex, G.echo_prompt_tail, "base", GEN_TOKENS, G.fixed_cost)
    t = G.batch_generate(ex, G.reference_head, "tuned", GEN_TOKENS, G.fixed_cost)
    return b.unionByName(t), ex


STAND_INS = {"base": G.echo_prompt_tail, "tuned": G.reference_head}


def _staged_predictions(spark, sf_dir):
    """Generated once per system and staged, as the evaluation job does."""
    from quire.plans.evaluate import generate_systems
    ex = eval_examples(spark, sf_dir)
    return generate_systems(ex, STAND_INS, GEN_TOKENS, G.fixed_cost), ex


def _pairs(spark, sf_dir):
    preds, ex = _staged_predictions(spark, sf_dir)
    return S.pair_predictions(preds, ex), preds


def q_generate(spark, sf_dir):
    """Generated predictions per system."""
    preds, _ = stand_in_predictions(spark, sf_dir)
    return preds


SYSTEMS = ["base", "tuned"]


def _wide(spark, sf_dir):
    """Per-example frame (reference once, one prediction column per system)
    from the staged predictions and the references: one shuffle."""
    preds, ex = _staged_predictions(spark, sf_dir)
    return S.per_example_from(preds, ex, SYSTEMS), preds


def q_bleu_counts(spark, sf_dir):
    """A4 statistics: clipped matches and totals per system and order."""
    pairs, _ = _pairs(spark, sf_dir)
    return S.bleu_stats(pairs)


def q_bleu_score(spark, sf_dir):
    """A4: corpus BLEU per system (predictions and references unioned per example)."""
    wide, _ = _wide(spark, sf_dir)
    return S.corpus_bleu(None, systems=SYSTEMS, wide=wide)


def q_compare_bleu(spark, sf_dir):
    """A6 on BLEU: base vs tuned and the delta of the rounded scores."""
    pairs, _ = _pairs(spark, sf_dir)
    return S.compare_systems(S.corpus_bleu(pairs), metrics=("bleu",))


def q_throughput(spark, sf_dir):
    """Tokens, seconds and rates per system."""
    _, preds = _pairs(spark, sf_dir)
    return S.throughput(preds)


def q_rouge_l(spark, sf_dir):
    """A5: mean ROUGE-L F x 100 per system (LCS in a pandas UDF)."""
    wide, _ = _wide(spark, sf_dir)
    return S.rouge_l(None, systems=SYSTEMS, wide=wide)


def q_compare_systems(spark, sf_dir):
    """Full comparison row (BLEU and ROUGE-L); the per-example frame is
    staged once and both metrics read it."""
    from quire.session import stage
    wide, _ = _wide(spark, sf_dir)
    return S.compare_systems(S.score_systems(None, systems=SYSTEMS, wide=stage(wide, "per_example")))


SPARK_QUERIES.update({
    "generate": q_generate,
    "bleu_counts": q_bleu_counts,
    "bleu_score": q_bleu_score,
    "compare_bleu": q_compare_bleu,
    "throughput": q_throughput,
    "rouge_l": q_rouge_l,
    "compare_systems": q_compare_systems,
})


def sql_tok13a(e: str) -> str:
    s = f"regexp_replace(coalesce({e}, ''), '{WS}+$', '')"
    for a, b in [("'<skipped>'", "''"), (f"'-' || {NL}", "''"), (NL, "' '"),
                 ("'&quot;'", "'\"'"), ("'&amp;'", "'&'"), ("'&lt;'", "'<'"), ("'&gt;'", "'>'")]:
        s = f"replace({s}, {a}, {b})"
    s = f"(' ' || {s} || ' ')"
    for pat, rep in TOK13A_REGEX:
        rep2 = rep.replace("$1", "\\1").replace("$2", "\\2")
        s = f"regexp_replace({s}, '{pat}', '{rep2}', 'g')"
    s = sql_norm_keepcase(s)
    return f"(CASE WHEN {s} = '' THEN []::VARCHAR[] ELSE string_split({s}, ' ') END)"


def sql_norm_keepcase(e: str) -> str:
    return f"regexp_replace({sql_strip(e)}, '{WS}+', ' ', 'g')"


SQL_EVAL = f"""{SQL_CONV_INSTR}, {sql_clean('conv_instr')},
ex0 AS (SELECT row_id AS example_id, {sql_plain()} AS t FROM conv_instr_msg),
ex AS (SELECT example_id, substring(t, 1, {_sql_prompt_ref('t')}) AS prompt,
              {sql_strip(f"substring(t, {_sql_prompt_ref('t')} + 1)")} AS reference FROM ex0),
ptok AS (SELECT example_id, {sql_tokens('prompt')}[1:512] AS pt, {sql_tokens('reference')} AS rt FROM ex),
preds0 AS (
  SELECT example_id, 'base' AS system,
         array_to_string(list_slice(pt, greatest(len(pt) - {GEN_TOKENS - 1}, 1), len(pt)), ' ') AS prediction FROM ptok
  UNION ALL
  SELECT example_id, 'tuned' AS system, array_to_string(list_slice(rt, 1, {GEN_TOKENS}), ' ') AS prediction FROM ptok),
preds AS (SELECT *, CAST(len({sql_tokens('prediction')}) AS INTEGER) AS n_tokens,
                 CAST(0.25 AS DOUBLE) * len({sql_tokens('prediction')}) AS seconds FROM preds0),
pairs AS (SELECT p.*, ex.reference FROM preds p JOIN ex USING (example_id)),
rtok AS (SELECT example_id, {sql_tok13a('reference')} AS r FROM ex WHERE example_id IN (SELECT example_id FROM preds)),
htok AS (SELECT system, example_id, {sql_tok13a('prediction')} AS h FROM pairs),
rg AS (SELECT example_id, n, g, count(*) AS r FROM (
         SELECT example_id, 1 AS n, unnest(list_transform(range(0, len(r) - 0), lambda i: r[i + 1])) AS g FROM rtok
         UNION ALL SELECT example_id, 2 AS n, unnest(list_transform(range(0, len(r) - 1), lambda i: r[i + 1] || ' ' || r[i + 2])) AS g FROM rtok
         UNION ALL SELECT example_id, 3 AS n, unnest(list_transform(range(0, len(r) - 2), lambda i: r[i + 1] || ' ' || r[i + 2] || ' ' || r[i + 3])) AS g FROM rtok
         UNION ALL SELECT example_id, 4 AS n, unnest(list_transform(range(0, len(r) - 3), lambda i: r[i + 1] || ' ' || r[i + 2] || ' ' || r[i + 3] || ' ' || r[i + 4])) AS g FROM rtok) GROUP BY ALL),
hg AS (SELECT system, example_id, n, g, count(*) AS h FROM (
         SELECT system, example_id, 1 AS n, unnest(list_transform(range(0, len(h) - 0), lambda i: h[i + 1])) AS g FROM htok
         UNION ALL SELECT system, example_id, 2 AS n, unnest(list_transform(range(0, len(h) - 1), lambda i: h[i + 1] || ' ' || h[i + 2])) AS g FROM htok
         UNION ALL SELECT system, example_id, 3 AS n, unnest(list_transform(range(0, len(h) - 2), lambda i: h[i + 1] || ' ' || h[i + 2] || ' ' || h[i + 3])) AS g FROM htok
         UNION ALL SELECT system, example_id, 4 AS n, unnest(list_transform(range(0, len(h) - 3), lambda i: h[i + 1] || ' ' || h[i + 2] || ' ' || h[i + 3] || ' ' || h[i + 4])) AS g FROM htok) GROUP BY ALL),
st AS (SELECT hg.system, CAST(hg.n AS INTEGER) AS n, CAST(sum(least(hg.h, coalesce(rg.r, 0))) AS BIGINT) AS correct,
              CAST(sum(hg.h) AS BIGINT) AS total
       FROM hg LEFT JOIN rg USING (example_id, n, g) GROUP BY ALL),
lens AS (SELECT system, CAST(sum(len(h)) AS BIGINT) AS sys_len, CAST(sum(len(r)) AS BIGINT) AS ref_len,
                count(*) AS n_examples FROM htok JOIN rtok USING (example_id) GROUP BY system),
wide AS (SELECT system,
  {", ".join(f"coalesce(sum(correct) FILTER (WHERE n = {k}), 0) AS c{k}" for k in range(1, 5))},
  {", ".join(f"coalesce(sum(total) FILTER (WHERE n = {k}), 0) AS t{k}" for k in range(1, 5))}
  FROM st GROUP BY system),
bl AS (
  SELECT lens.system, sys_len, ref_len, n_examples,
         coalesce(c1, 0) AS c1, coalesce(c2, 0) AS c2, coalesce(c3, 0) AS c3, coalesce(c4, 0) AS c4,
         coalesce(t1, 0) AS t1, coalesce(t2, 0) AS t2, coalesce(t3, 0) AS t3, coalesce(t4, 0) AS t4
  FROM lens LEFT JOIN wide USING (system)),
bleu AS (
  SELECT system, sys_len, ref_len, n_examples,
    round(CASE WHEN (c1 > 0 OR c2 > 0 OR c3 > 0 OR c4 > 0) AND t1 > 0 AND t2 > 0 AND t3 > 0 AND t4 > 0 THEN
      (CASE WHEN sys_len < ref_len THEN (CASE WHEN sys_len > 0 THEN exp(1.0 - ref_len / sys_len) ELSE 0.0 END) ELSE 1.0 END)
      * exp((ln(CASE WHEN c1 > 0 THEN 100.0 * c1 / t1 ELSE 100.0 / (pow(2.0, z1) * t1) END)
           + ln(CASE WHEN c2 > 0 THEN 100.0 * c2 / t2 ELSE 100.0 / (pow(2.0, z2) * t2) END)
           + ln(CASE WHEN c3 > 0 THEN 100.0 * c3 / t3 ELSE 100.0 / (pow(2.0, z3) * t3) END)
           + ln(CASE WHEN c4 > 0 THEN 100.0 * c4 / t4 ELSE 100.0 / (pow(2.0, z4) * t4) END)) / 4.0)
    ELSE 0.0 END, 4) AS bleu
  FROM (SELECT *, (c1 = 0)::INT AS z1, (c1 = 0)::INT + (c2 = 0)::INT AS z2,
               (c1 = 0)::INT + (c2 = 0)::INT + (c3 = 0)::INT AS z3,
               (c1 = 0)::INT + (c2 = 0)::INT + (c3 = 0)::INT + (c4 = 0)::INT AS z4 FROM bl))"""

ORACLES["generate"] = f"""WITH {SQL_EVAL}
SELECT example_id, system, prediction, n_tokens, seconds FROM preds"""

ORACLES["bleu_counts"] = f"""WITH {SQL_EVAL}
SELECT system, n, correct, total FROM st"""

ORACLES["bleu_score"] = f"""WITH {SQL_EVAL}
SELECT system, bleu, sys_len, ref_len, n_examples FROM bleu"""

ORACLES["compare_bleu"] = f"""WITH {SQL_EVAL}
SELECT max(n_examples) AS num_eval_samples,
       max(bleu) FILTER (WHERE system = 'base') AS base_bleu,
       max(bleu) FILTER (WHERE system = 'tuned') AS tuned_bleu,
       round(max(bleu) FILTER (WHERE system = 'tuned') - max(bleu) FILTER (WHERE system = 'base'), 4) AS delta_bleu
FROM bleu"""

ORACLES["throughput"] = f"""WITH {SQL_EVAL}
SELECT system, count(*) AS replies, CAST(sum(n_tokens) AS BIGINT) AS tokens, round(sum(seconds), 2) AS seconds,
       round(avg(CASE WHEN seconds > 0 THEN n_tokens / seconds ELSE 0.0 END), 4) AS mean_tok_per_sec,
       round(CASE WHEN sum(seconds) > 0 THEN sum(n_tokens) / sum(seconds) ELSE 0.0 END, 4) AS tok_per_sec
FROM preds GROUP BY system"""


# --- chat history, sweep, stream, stores ----------------------------------------

# --- fixed values: the usual grid, the smoke grid and the usual settings -----------
GRID = {"ranks": [8, 16, 32], "learning_rates": [0.0001, 0.0002],
        "schedulers": ["cosine", "linear", "constant", "constant_with_warmup"]}
SMOKE_GRID = {"ranks": [8, 16], "learning_rates": [0.0002], "schedulers": ["cosine", "constant"]}
SWEEP = {"subset_size": 2000, "eval_subset_size": 200, "batch_size": 8, "grad_accum": 2, "max_steps": 300,
         "holdout": 100, "train_size": 50000}
# ---------------------------------------------------------------------------------
FIT_ROWS, FIT_STEPS = 40, 3      # bounded sample and steps of the ML cells' fit


def q_chat_history(spark, sf_dir):
    """System message + turns in order, as message rows."""
    return assemble_history(table(spark, sf_dir, "conversations"), DEFAULT_SYSTEM)


def labelled_split(spark, sf_dir, holdout=SWEEP["holdout"], size=SWEEP["train_size"]):
    """documents joined with labels; keep-first dedupe; exact seeded cut."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text")
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"),
                                                F.col("quality").cast("double").alias("label"))
    j = R.with_content_hash(d.join(lab, "row_id"))
    ranked = dedupe_keep_first(j, "content_hash", ("row_id",)).withColumn("split_rank", seeded_rank(SEED, "content_hash"))
    from quire.session import stage
    splits, info = cut_split(stage(ranked.sortWithinPartitions("split_rank"), "labelled"), holdout, size)
    return splits, info


def q_sweep_plan(spark, sf_dir):
    """E1 + P12 + P13 with each cell's data budget from the labelled split."""
    _, info = labelled_split(spark, sf_dir)
    g = W.param_grid(spark, **GRID)
    return W.sweep_plan(g, info["train_n"], info["eval_n"], SWEEP["subset_size"], SWEEP["eval_subset_size"],
                        SWEEP["batch_size"], SWEEP["grad_accum"], SWEEP["max_steps"])


def q_sweep(spark, sf_dir):
    """The smoke grid, fitted on a bounded sample of FIT_ROWS train rows and
    evaluated on every held-out labelled row (a fifth of them)."""
    splits, _ = labelled_split(spark, sf_dir, WHOLE, WHOLE)
    fit = take_first(splits.filter(F.col("split") == "train"), FIT_ROWS)
    return W.run_sweep(spark, W.param_grid(spark, **SMOKE_GRID), fit, splits.filter(F.col("split") == "eval"),
                       lambda a, b, p: W.default_cell(a, b, p, max_steps=FIT_STEPS), effective=("rank", "learning_rate"))


def formula_cell(train, eval_, p):
    """A cell whose loss is a closed formula of the held-out rows: ranks and
    schedules tie, and one schedule has no loss."""
    if p["scheduler"] == "constant_with_warmup":
        return None
    base = eval_.agg(F.avg(F.abs(F.col("label") - F.pmod(F.length("text"), F.lit(10)) / 10.0))).first()[0]
    return round(base + 1000 * p["learning_rate"] + (0.5 if p["rank"] > 16 else 0.0), 6)


def _formula_results(spark, sf_dir):
    splits, _ = labelled_split(spark, sf_dir, WHOLE, WHOLE)
    return W.run_sweep(spark, W.param_grid(spark, **GRID), splits.filter(F.col("split") == "train"),
                       splits.filter(F.col("split") == "eval"), formula_cell)


def q_select_best(spark, sf_dir):
    """E3 over the whole grid, with ties and missing losses."""
    return W.select_best(_formula_results(spark, sf_dir)).select("cell_no", "rank", "eval_loss")


def q_comparison_table(spark, sf_dir):
    """E4 over the whole grid, with ties and missing losses."""
    return W.comparison_table(_formula_results(spark, sf_dir)).drop("runtime_seconds")


def q_stream_dedupe(spark, sf_dir):
    """Incremental dedupe of documents via Structured Streaming; the
    kept hash set read back from the sink."""
    from quire.session import scratch_path
    from quire.streaming.incremental import prepare_stream
    base = scratch_path(spark, "stream")
    prepare_stream(spark, f"{sf_dir.rstrip('/')}/documents.parquet", f"{base}/sink", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/sink").select("content_hash")


def q_size_report(spark, sf_dir):
    """Bytes of the text lines written for every document (binaryFile, length
    only): the lines' octets and line ends, whatever the number of files."""
    from quire.session import scratch_path
    from quire.sources.store import size_report
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "documents").select(F.coalesce(text_preview("text", 300), F.lit(""))).write.text(path)
    return size_report(spark, path, "*.txt").select("bytes", "mb")


def q_load_splits(spark, sf_dir):
    """Publish the doc_instr split with its manifest, then load both
    sides back (partition-pruned scans)."""
    from quire.plans.prepare import load_splits, prepare_dataset
    from quire.session import scratch_path
    root = scratch_path(spark, "prepared")
    cfg = PrepConfig(seed=SEED, eval_holdout_size=HOLDOUT, subsample_size=SUBSAMPLE)
    m = prepare_dataset(spark, doc_instructions(spark, sf_dir), root, cfg)
    assert m["disjointness"]["intersection"] == 0
    again = prepare_dataset(spark, doc_instructions(spark, sf_dir), root, cfg)
    assert again["cache_hit"] is True
    tr, ev = load_splits(spark, root, doc_instructions(spark, sf_dir), cfg)
    return tr.unionByName(ev).select("row_id", "content_hash", "split")


SPARK_QUERIES.update({
    "chat_history": q_chat_history,
    "sweep_plan": q_sweep_plan,
    "sweep": q_sweep,
    "select_best": q_select_best,
    "comparison_table": q_comparison_table,
    "stream_dedupe": q_stream_dedupe,
    "size_report": q_size_report,
    "load_splits": q_load_splits,
})

ORACLES["chat_history"] = f"""SELECT conv_id, CAST(0 AS BIGINT) AS pos, 'system' AS role, '{DEFAULT_SYSTEM}' AS content
FROM (SELECT conv_id, arg_min(role, turn) AS first_role FROM conversations GROUP BY conv_id)
WHERE first_role IS DISTINCT FROM 'system'
UNION ALL SELECT conv_id, turn + 1 AS pos, role, text AS content FROM conversations"""


def _grid_values() -> str:
    rows, k = [], 0
    for r in GRID["ranks"]:
        for lr in GRID["learning_rates"]:
            for s in GRID["schedulers"]:
                rows.append(f"({k}, {r}, {float(lr)!r}, '{s}', {r * 2}, 'r{r}_lr{float(lr)!r}_{s}')")
                k += 1
    return ", ".join(rows)


ORACLES["sweep_plan"] = f"""WITH lab AS (
  SELECT d.doc_id, {sql_hash('d.text')} AS content_hash FROM documents d JOIN labels l USING (doc_id)),
n AS (SELECT count(DISTINCT content_hash) AS n FROM lab),
sz AS (SELECT n, least({SWEEP['holdout']}, greatest(1, n // 5), n) AS eval_n FROM n),
sz2 AS (SELECT eval_n, least({SWEEP['train_size']}, n - eval_n) AS train_n FROM sz),
g(cell_no, rank, learning_rate, scheduler, lora_alpha, run_tag) AS (VALUES {_grid_values()})
SELECT CAST(cell_no AS INTEGER) AS cell_no, CAST(rank AS INTEGER) AS rank, CAST(learning_rate AS DOUBLE) AS learning_rate,
       scheduler, CAST(lora_alpha AS INTEGER) AS lora_alpha, run_tag,
       CAST(least(train_n, {SWEEP['subset_size']}) AS BIGINT) AS train_rows,
       CAST(least(eval_n, {SWEEP['eval_subset_size']}) AS BIGINT) AS eval_rows,
       {SWEEP['batch_size'] * SWEEP['grad_accum']} AS effective_batch, {SWEEP['max_steps']} AS steps
FROM g, sz2"""

ORACLES["stream_dedupe"] = f"""WITH {SQL_DOC_INSTR}, {sql_rendered('doc_instr')}
SELECT DISTINCT {sql_hash('text')} AS content_hash FROM doc_instr_text"""

ORACLES["size_report"] = """WITH s AS (SELECT CAST(sum(strlen(substring(coalesce(text, ''), 1, 300)) + 1) AS BIGINT) AS bytes FROM documents)
SELECT bytes, round(bytes / 1048576.0::DOUBLE, 2) AS mb FROM s"""

ORACLES["load_splits"] = f"""WITH {SQL_DOC_INSTR}, {sql_split('doc_instr')}
SELECT row_id, content_hash, split FROM doc_instr_split"""


def q_benchmark_disjointness(spark, sf_dir):
    """D5 against the fixed evaluation side: normalised-hash overlap between
    the corpus documents and the benchmark items (whole texts)."""
    docs = table(spark, sf_dir, "documents").select(content_hash("text").alias("content_hash"))
    bench = table(spark, sf_dir, "benchmark").select(content_hash("text").alias("content_hash"))
    return disjointness_audit(docs, bench, fail=False).select(
        F.col("train_unique_hashes").alias("corpus_unique_hashes"),
        F.col("eval_unique_hashes").alias("benchmark_unique_hashes"), "intersection")


SPARK_QUERIES["benchmark_disjointness"] = q_benchmark_disjointness
ORACLES["benchmark_disjointness"] = f"""WITH d AS (SELECT DISTINCT {sql_hash('text')} AS h FROM documents),
b AS (SELECT DISTINCT {sql_hash('text')} AS h FROM benchmark)
SELECT (SELECT count(*) FROM d) AS corpus_unique_hashes, (SELECT count(*) FROM b) AS benchmark_unique_hashes,
       (SELECT count(*) FROM d JOIN b USING (h)) AS intersection"""


# --- scoring over documents: whole document bodies as references -----------------
def doc_eval_examples(spark, sf_dir):
    """(example_id, prompt, reference) of every rendered doc_instr text: the
    reference is the whole document body (up to ~20k words)."""
    return prompt_reference_frame(R.render(doc_instructions(spark, sf_dir), "plain"))


def _doc_wide(spark, sf_dir):
    from quire.plans.evaluate import generate_systems
    ex = doc_eval_examples(spark, sf_dir)
    preds = generate_systems(ex, STAND_INS, GEN_TOKENS, G.fixed_cost)
    return S.per_example_from(preds, ex, SYSTEMS)


def q_doc_bleu_score(spark, sf_dir):
    """A4 with long references: corpus BLEU of the stand-ins against whole document bodies."""
    return S.corpus_bleu(None, systems=SYSTEMS, wide=_doc_wide(spark, sf_dir))


def q_doc_compare_systems(spark, sf_dir):
    """A5 + A6 with long references: BLEU and ROUGE-L (bit-parallel LCS) per system."""
    from quire.session import stage
    wide = stage(_doc_wide(spark, sf_dir), "doc_per_example")
    return S.compare_systems(S.score_systems(None, systems=SYSTEMS, wide=wide))


SPARK_QUERIES["doc_bleu_score"] = q_doc_bleu_score
SPARK_QUERIES["doc_compare_systems"] = q_doc_compare_systems

_SQL_DOC_EX = f"""{SQL_DOC_INSTR}, {sql_clean('doc_instr')},
ex0 AS (SELECT row_id AS example_id, {sql_plain()} AS t FROM doc_instr_msg),"""
ORACLES["doc_bleu_score"] = ("WITH " + SQL_EVAL.replace(
    f"""{SQL_CONV_INSTR}, {sql_clean('conv_instr')},
ex0 AS (SELECT row_id AS example_id, {sql_plain()} AS t FROM conv_instr_msg),""", _SQL_DOC_EX)
    + "\nSELECT system, bleu, sys_len, ref_len, n_examples FROM bleu")


def q_rouge_token_counts(spark, sf_dir):
    """A5 tokenisation: per (system, example) the ROUGE token counts of the
    prediction and the reference (stemming never changes a count; the LCS
    itself is checked by tests against a brute-force DP)."""
    wide, _ = _wide(spark, sf_dir)
    return S.rouge_l_rows(None, SYSTEMS, wide).select("system", "example_id", "n_pred", "n_ref")


SPARK_QUERIES["rouge_token_counts"] = q_rouge_token_counts


def _sql_rouge_count(e: str) -> str:
    return f"CAST(len(list_filter(string_split(regexp_replace(lower({e}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')) AS INTEGER)"


ORACLES["rouge_token_counts"] = f"""WITH {SQL_EVAL}
SELECT system, example_id, {_sql_rouge_count('prediction')} AS n_pred, {_sql_rouge_count('reference')} AS n_ref
FROM pairs"""


def q_prompt_keyed_split(spark, sf_dir):
    """D7 opt-in: the split keyed by the prompt hash - every answer of a
    prompt lands on one side; sizes count distinct prompts."""
    splits, _, _ = _doc_splits(spark, sf_dir, split_key="prompt")
    return splits.select("row_id", "prompt_hash", "split")


SPARK_QUERIES["prompt_keyed_split"] = q_prompt_keyed_split
ORACLES["prompt_keyed_split"] = f"""WITH {SQL_DOC_INSTR}, {sql_rendered('doc_instr')},
h AS (SELECT row_id, text, {sql_hash('text')} AS content_hash FROM doc_instr_text),
d AS (SELECT content_hash, arg_min(row_id, row_id) AS row_id, arg_min(text, row_id) AS text FROM h GROUP BY content_hash),
p AS (SELECT row_id, {sql_hash(f"substring(text, 1, {_sql_prompt_ref('text')})")} AS prompt_hash FROM d),
r AS (SELECT *, dense_rank() OVER (ORDER BY sha256('{SEED}:' || prompt_hash)) AS pos FROM p),
sz AS (SELECT n, least({HOLDOUT}, greatest(1, n // 5), n) AS eval_n FROM (SELECT count(DISTINCT prompt_hash) AS n FROM p))
SELECT row_id, prompt_hash, CASE WHEN pos <= eval_n THEN 'eval' ELSE 'train' END AS split
FROM r, sz WHERE pos <= eval_n + least({SUBSAMPLE}, n - eval_n)"""


# --- further entries: sources, user functions, stores, scores ---------------------------
_SQL_LABELLED = f"""lab0 AS (
  SELECT d.doc_id, d.text, CAST(l.quality AS DOUBLE) AS label, {sql_hash('d.text')} AS content_hash
  FROM documents d JOIN labels l USING (doc_id)),
lab1 AS (SELECT content_hash, min(doc_id) AS doc_id, arg_min(text, doc_id) AS text, arg_min(label, doc_id) AS label
         FROM lab0 GROUP BY content_hash),
lab2 AS (SELECT *, row_number() OVER (ORDER BY sha256('{SEED}:' || content_hash)) AS pos, count(*) OVER () AS n FROM lab1),
held AS (SELECT text, label FROM lab2 WHERE pos <= least(greatest(1, n // 5), n)),
base AS (SELECT avg(abs(label - (length(text) % 10) / 10.0::DOUBLE)) AS b FROM held),
g(cell_no, rank, learning_rate, scheduler, lora_alpha, run_tag) AS (VALUES {_grid_values()}),
cells AS (SELECT CAST(cell_no AS INTEGER) AS cell_no, CAST(rank AS INTEGER) AS rank, CAST(learning_rate AS DOUBLE) AS learning_rate, scheduler,
    CASE WHEN scheduler <> 'constant_with_warmup'
         THEN round(b + 1000 * CAST(learning_rate AS DOUBLE) + CASE WHEN rank > 16 THEN 0.5 ELSE 0.0 END, 6) END AS eval_loss
  FROM g, base),
ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY eval_loss NULLS LAST, rank, cell_no) AS INTEGER) AS position FROM cells)"""

ORACLES["select_best"] = f"""WITH {_SQL_LABELLED}
SELECT cell_no, rank, eval_loss FROM ranked WHERE position = 1 AND eval_loss IS NOT NULL"""

ORACLES["comparison_table"] = f"""WITH {_SQL_LABELLED}
SELECT position, cell_no, rank, learning_rate, scheduler, coalesce(printf('%.4f', eval_loss), 'null') AS eval_loss_text,
       position = 1 AND eval_loss IS NOT NULL AS selected FROM ranked"""


def q_read_instructions(spark, sf_dir):
    """Documents loaded by path with a column mapping."""
    return read_instructions(spark, f"{sf_dir.rstrip('/')}/documents.parquet",
                             mapping={"instruction": "source", "input": "lang", "response": "text"}, order_col="doc_id")


ORACLES["read_instructions"] = """SELECT doc_id AS row_id, source AS instruction, lang AS input,
       CAST(NULL AS VARCHAR) AS output, text AS response FROM documents"""


def _word_stats(row):
    words = row["text"].split(" ")
    return {"doc_id": row["doc_id"], "n_words": len(words), "longest": max(map(len, words))}


def q_map_rows(spark, sf_dir):
    """A user's Python function over every document."""
    return G.map_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), _word_stats,
                      "doc_id long, n_words long, longest long")


ORACLES["map_rows"] = """SELECT doc_id, CAST(len(string_split(text, ' ')) AS BIGINT) AS n_words,
       CAST(list_max(list_transform(string_split(text, ' '), lambda x: length(x))) AS BIGINT) AS longest FROM documents"""


def q_message_array(spark, sf_dir):
    """P9 as one array per conversation, read back as text."""
    from quire.operators.history import to_message_array
    m = to_message_array(assemble_history(table(spark, sf_dir, "conversations"), DEFAULT_SYSTEM))
    return m.select("conv_id", F.size("messages").cast("long").alias("n_messages"),
                    F.array_join(F.transform("messages", lambda x: F.concat(x["role"], F.lit("="), x["content"])), "|").alias("said"))


ORACLES["message_array"] = f"""WITH h AS ({ORACLES['chat_history']})
SELECT conv_id, count(*) AS n_messages, string_agg(role || '=' || content, '|' ORDER BY pos) AS said FROM h GROUP BY conv_id"""


def q_snapshot_roundtrip(spark, sf_dir):
    """Prepare the whole table, snapshot it twice, restore the newest one and read it."""
    from quire.plans.prepare import prepare_dataset
    from quire.session import scratch_path
    from quire.sources import store
    root = scratch_path(spark, "snapshots")
    cfg = PrepConfig(seed=SEED, eval_holdout_size=WHOLE, subsample_size=WHOLE)
    vdir = prepare_dataset(spark, doc_instructions(spark, sf_dir), f"{root}/prepared", cfg)["path"]
    for k in (9, 10):
        store.snapshot(spark, vdir, f"{root}/snaps", k)
    assert store.latest_snapshot(spark, f"{root}/snaps") == 10
    assert store.restore(spark, store.latest_snapshot_path(spark, f"{root}/snaps"), f"{root}/back")
    tr, ev = store.load_split_data(spark, f"{root}/back")
    return tr.unionByName(ev).select("row_id", "content_hash", "n_copies", "split")


ORACLES["snapshot_roundtrip"] = f"""WITH {SQL_DOC_INSTR}, {sql_split('doc_instr', WHOLE, WHOLE)}
SELECT row_id, content_hash, n_copies, split FROM doc_instr_split"""


def q_write_report(spark, sf_dir):
    """Document counts by source and language as a JSON report, read back."""
    from quire.session import scratch_path
    from quire.sources.store import write_report
    path = scratch_path(spark, "report")
    write_report(table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.schema("source string, lang string, n long").json(path)


ORACLES["write_report"] = "SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL"


def q_training_steps(spark, sf_dir):
    """Rows of every step of two epochs over the whole table, cut at a number of steps that ends inside the second."""
    splits, _, _ = _doc_splits(spark, sf_dir, holdout=WHOLE, size=WHOLE)
    train = splits.filter(F.col("split") == "train")
    from quire.operators.split import batch_plan as plan, training_steps
    per = plan(train, 8, 4)[1]["steps_per_epoch"]
    return training_steps(train, 8, 4, max_steps=per + per // 2).select("row_id", "epoch", "step")


ORACLES["training_steps"] = f"""WITH {SQL_DOC_INSTR}, {sql_split('doc_instr', WHOLE, WHOLE)},
t AS (SELECT row_id, row_number() OVER (ORDER BY split_rank) - 1 AS pos, count(*) OVER () AS n FROM doc_instr_split WHERE split = 'train'),
u AS (SELECT row_id, pos // 32 AS s, (n + 31) // 32 AS per FROM t),
v AS (SELECT row_id, CAST(e AS INTEGER) AS epoch, CAST(s + e * per AS BIGINT) AS step, per FROM u, (VALUES (0), (1)) AS x(e))
SELECT row_id, epoch, step FROM v WHERE step < per + per // 2"""


def q_copied_prompts(spark, sf_dir):
    """D7 where prompts do repeat: documents of every third id against the others, not deduplicated."""
    t = R.with_content_hash(R.render(documents_as_instructions(table(spark, sf_dir, "documents")), "plain"))
    side = F.col("row_id") % 3 == 0
    return prompt_leakage(t.where(~side), t.where(side), id_col="row_id")


ORACLES["copied_prompts"] = f"""WITH {SQL_DOC_INSTR}, {sql_rendered('doc_instr')},
p AS (SELECT row_id, {sql_hash(f"substring(text, 1, {_sql_prompt_ref('text')})")} AS prompt_hash FROM doc_instr_text)
SELECT row_id, prompt_hash FROM p WHERE row_id % 3 = 0 AND prompt_hash IN (SELECT prompt_hash FROM p WHERE row_id % 3 <> 0)"""


def _sentences(df, text_col="text"):
    """Normalised sentences of at least 20 characters, one row each."""
    one = df.select(F.explode(F.split(text_col, "[.\n]")).alias("s")).select(normalize_text("s").alias("s"))
    return one.where(F.length("s") >= 20).select(F.sha2("s", 256).alias("content_hash"))


def q_benchmark_sentences(spark, sf_dir):
    """D5 on sentences: those of the benchmark that the corpus repeats."""
    out = disjointness_audit(_sentences(table(spark, sf_dir, "documents")), _sentences(table(spark, sf_dir, "benchmark")), fail=False)
    return out.select(F.col("train_unique_hashes").alias("corpus_sentences"),
                      F.col("eval_unique_hashes").alias("benchmark_sentences"), "intersection")


def _sql_sentences(src: str) -> str:
    return (f"SELECT DISTINCT s FROM (SELECT {sql_norm('s')} AS s FROM "
            f"(SELECT unnest(string_split_regex(text, '[.\n]')) AS s FROM {src})) WHERE length(s) >= 20")


ORACLES["benchmark_sentences"] = f"""WITH d AS ({_sql_sentences('documents')}), b AS ({_sql_sentences('benchmark')})
SELECT (SELECT count(*) FROM d) AS corpus_sentences, (SELECT count(*) FROM b) AS benchmark_sentences,
       (SELECT count(*) FROM d JOIN b USING (s)) AS intersection"""


def q_rouge_lcs(spark, sf_dir):
    """A5 per pair, plain tokens: LCS, lengths and F."""
    wide, _ = _wide(spark, sf_dir)
    return S.rouge_l_rows(None, SYSTEMS, wide, stemmed=False).withColumn("rouge_l_f", F.round("rouge_l_f", 9))


def q_compare_rouge(spark, sf_dir):
    """A6 on BLEU and plain ROUGE-L."""
    from quire.session import stage
    wide, _ = _wide(spark, sf_dir)
    return S.compare_systems(S.score_systems(None, systems=SYSTEMS, wide=stage(wide, "per_example"), stemmed=False))


_RT = "list_filter(string_split(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"
_SQL_LCS = SQL_EVAL + f""",
tk AS (SELECT system, example_id, {_RT.format('prediction')} AS p, {_RT.format('reference')} AS r FROM pairs),
dp(system, example_id, i, row) AS (
  SELECT system, example_id, 0, list_transform(range(0, len(r) + 1), lambda x: 0) FROM tk
  UNION ALL
  SELECT dp.system, dp.example_id, i + 1,
         list_transform(range(0, len(r) + 1), lambda j: CASE WHEN j = 0 THEN 0 ELSE
           list_max(list_transform(range(1, j + 1), lambda k: CASE WHEN p[i + 1] = r[k] THEN row[k] + 1 ELSE row[k + 1] END)) END)
  FROM dp JOIN tk ON tk.system = dp.system AND tk.example_id = dp.example_id WHERE i < len(p)),
lc AS (SELECT system, example_id, max(row[len(row)]) AS lcs FROM dp GROUP BY ALL),
rl AS (SELECT system, example_id, CAST(lcs AS INTEGER) AS lcs, CAST(len(p) AS INTEGER) AS n_pred, CAST(len(r) AS INTEGER) AS n_ref,
              CASE WHEN lcs = 0 THEN 0.0 ELSE 2.0 * lcs::DOUBLE / (len(p) + len(r)) END AS f FROM lc JOIN tk USING (system, example_id))"""

ORACLES["rouge_lcs"] = f"""WITH RECURSIVE {_SQL_LCS}
SELECT system, example_id, lcs, n_pred, n_ref, round(f, 9) AS rouge_l_f FROM rl"""

ORACLES["compare_rouge"] = f"""WITH RECURSIVE {_SQL_LCS},
ro AS (SELECT system, round(avg(f) * 100.0, 4) AS rouge_l FROM rl GROUP BY system)
SELECT max(n_examples) AS num_eval_samples,
       max(bleu) FILTER (WHERE system = 'base') AS base_bleu, max(rouge_l) FILTER (WHERE system = 'base') AS base_rouge_l,
       max(bleu) FILTER (WHERE system = 'tuned') AS tuned_bleu, max(rouge_l) FILTER (WHERE system = 'tuned') AS tuned_rouge_l,
       round(max(bleu) FILTER (WHERE system = 'tuned') - max(bleu) FILTER (WHERE system = 'base'), 4) AS delta_bleu,
       round(max(rouge_l) FILTER (WHERE system = 'tuned') - max(rouge_l) FILTER (WHERE system = 'base'), 4) AS delta_rouge_l
FROM bleu JOIN ro USING (system)"""

SPARK_QUERIES.update({
    "read_instructions": q_read_instructions, "map_rows": q_map_rows, "message_array": q_message_array,
    "snapshot_roundtrip": q_snapshot_roundtrip, "write_report": q_write_report, "training_steps": q_training_steps,
    "copied_prompts": q_copied_prompts, "benchmark_sentences": q_benchmark_sentences, "rouge_lcs": q_rouge_lcs,
    "compare_rouge": q_compare_rouge,
})


# --- A5 with stems: the Porter rules as SQL over the distinct tokens, joined back --------
_LAST = 1 << 40          # past any position
_SQL_STEMMED = f"""pt AS MATERIALIZED (SELECT system, example_id, {_RT.format('prediction')} AS p FROM pairs),
rt AS MATERIALIZED (SELECT example_id, {_RT.format('reference')} AS r FROM ex WHERE example_id IN (SELECT example_id FROM preds)),
toks AS MATERIALIZED (SELECT DISTINCT token FROM (SELECT unnest(p) AS token FROM pt UNION ALL SELECT unnest(r) FROM rt) WHERE length(token) > 3),
{stem_chain('toks')},
stem_of AS MATERIALIZED (SELECT * FROM stems),
ps AS (SELECT system, example_id, list(coalesce(stem, token) ORDER BY i) AS p FROM
       (SELECT system, example_id, unnest(p) AS token, generate_subscripts(p, 1) AS i FROM pt) LEFT JOIN stem_of USING (token) GROUP BY ALL),
rs AS (SELECT example_id, list(coalesce(stem, token) ORDER BY i) AS r FROM
       (SELECT example_id, unnest(r) AS token, generate_subscripts(r, 1) AS i FROM rt) LEFT JOIN stem_of USING (token) GROUP BY ALL),
sk AS MATERIALIZED (SELECT pt.system, pt.example_id, coalesce(ps.p, []) AS p, coalesce(rs.r, []) AS r FROM pt
                    LEFT JOIN ps ON ps.system = pt.system AND ps.example_id = pt.example_id LEFT JOIN rs ON rs.example_id = pt.example_id),
-- ends[k + 1]: where the earliest common subsequence of k tokens ends
dp(system, example_id, i, ends) AS (
  SELECT system, example_id, 0, [CAST(0 AS BIGINT)] FROM sk
  UNION ALL
  SELECT system, example_id, i + 1,
         list_filter(list_transform(range(1, len(ends) + 2), lambda k: CASE WHEN k = 1 THEN 0 ELSE
           least(coalesce(ends[k], {_LAST}), coalesce(list_min(list_filter(here, lambda q: q > ends[k - 1])), {_LAST})) END), lambda x: x < {_LAST})
  FROM (SELECT dp.*, list_filter(range(1, len(sk.r) + 1), lambda q: sk.r[q] = sk.p[dp.i + 1]) AS here
        FROM dp JOIN sk ON dp.system = sk.system AND dp.example_id = sk.example_id WHERE dp.i < len(sk.p))),
lc AS (SELECT system, example_id, max(len(ends)) - 1 AS lcs FROM dp GROUP BY ALL),
rl AS (SELECT system, example_id, CASE WHEN lcs = 0 THEN 0.0 ELSE 2.0 * lcs::DOUBLE / (len(p) + len(r)) END AS f FROM lc JOIN sk USING (system, example_id)),
ro AS (SELECT system, round(avg(f) * 100.0, 4) AS rouge_l FROM rl GROUP BY system)"""

_SQL_COMPARED = ORACLES["compare_rouge"][ORACLES["compare_rouge"].index("SELECT max(n_examples)"):]
_SQL_DOC_EVAL = ORACLES["doc_bleu_score"].removeprefix("WITH ").rsplit("\nSELECT system, bleu", 1)[0]

ORACLES["rouge_l"] = f"WITH RECURSIVE {SQL_EVAL},\n{_SQL_STEMMED}\nSELECT system, rouge_l FROM ro"
ORACLES["compare_systems"] = f"WITH RECURSIVE {SQL_EVAL},\n{_SQL_STEMMED}\n{_SQL_COMPARED}"
ORACLES["doc_compare_systems"] = f"WITH RECURSIVE {_SQL_DOC_EVAL},\n{_SQL_STEMMED}\n{_SQL_COMPARED}"


def q_stem_table(spark, sf_dir):
    """A5's stems: every distinct ROUGE token of the documents with its Porter stem, by the chain of SQL rules."""
    t = table(spark, sf_dir, "documents").select(F.explode(S.rouge_tokens("text")).alias("token"))
    return stem_table(t)


SPARK_QUERIES["stem_table"] = q_stem_table
ORACLES["stem_table"] = f"""WITH toks AS (SELECT DISTINCT unnest({_RT.format('text')}) AS token FROM documents),
{stem_chain('toks')}
SELECT token, stem FROM stems"""


def q_shard_export(spark, sf_dir):
    """D8 export: the train rows of the whole table in shards of 128 consecutive positions, read back."""
    from quire.operators.split import write_shards
    from quire.session import scratch_path
    splits, _, _ = _doc_splits(spark, sf_dir, holdout=WHOLE, size=WHOLE)
    plan, _ = batch_plan(splits.filter(F.col("split") == "train"), 8, 4)
    path = scratch_path(spark, "shards")
    write_shards(plan.select("row_id", "pos"), path, 128)
    return spark.read.parquet(path).select("row_id", "pos", F.col("shard").cast("long").alias("shard"))


SPARK_QUERIES["shard_export"] = q_shard_export
ORACLES["shard_export"] = f"""WITH {SQL_DOC_INSTR}, {sql_split('doc_instr', WHOLE, WHOLE)},
t AS (SELECT row_id, row_number() OVER (ORDER BY split_rank) - 1 AS pos FROM doc_instr_split WHERE split = 'train')
SELECT row_id, pos, CAST(pos // 128 AS BIGINT) AS shard FROM t"""
