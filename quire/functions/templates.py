"""Chat templates and the prompt/reference split, as Column expressions.

A template turns ``messages: array<struct<role, content>>`` into one training
text. ``plain`` is the fallback used when a tokenizer has no chat template;
``inst`` and ``role_header`` are common chat shapes built around the markers
the prompt splitter recognises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import _c, py_strip

# --- fixed values -----------------------------------------------------------
PLAIN_INSTRUCTION_HEADER = "### Instruction:\n"
PLAIN_RESPONSE_HEADER = "\n\n### Response:\n"
# Prompt/reference markers, tried in this priority order; the first marker
# found anywhere in the text wins and the cut is after its first occurrence.
RESPONSE_MARKERS = ["### Response:\n", "[/INST]", "<|assistant|>", "assistant\n"]
# ----------------------------------------------------------------------------

MESSAGE_TYPE = "array<struct<role:string,content:string>>"


def to_messages(user, assistant) -> Column:
    """``[{role: user, content}, {role: assistant, content}]``."""
    return F.array(
        F.struct(F.lit("user").alias("role"), _c(user).alias("content")),
        F.struct(F.lit("assistant").alias("role"), _c(assistant).alias("content")),
    )


def _render_each(messages: Column, fn) -> Column:
    return F.array_join(F.transform(messages, fn), "")


def render_plain(messages) -> Column:
    """``### Instruction:\\n{user}\\n\\n### Response:\\n{assistant}``."""
    m = _c(messages)
    return F.concat(F.lit(PLAIN_INSTRUCTION_HEADER), m[0]["content"],
                    F.lit(PLAIN_RESPONSE_HEADER), m[1]["content"])


def render_inst(messages) -> Column:
    """``<s>[INST] user [/INST] assistant</s>`` per exchange."""
    def one(x):
        return F.when(x["role"] == "user", F.concat(F.lit("<s>[INST] "), x["content"], F.lit(" [/INST]"))) \
                .when(x["role"] == "assistant", F.concat(F.lit(" "), x["content"], F.lit("</s>"))) \
                .otherwise(F.concat(x["content"], F.lit("\n\n")))
    return _render_each(_c(messages), one)


def render_role_header(messages) -> Column:
    """``<|role|>\\ncontent</s>\\n`` per message."""
    def one(x):
        return F.concat(F.lit("<|"), x["role"], F.lit("|>\n"), x["content"], F.lit("</s>\n"))
    return _render_each(_c(messages), one)


TEMPLATES = {"plain": render_plain, "inst": render_inst, "role_header": render_role_header}


def register_template(name: str, fn) -> None:
    """Add a chat template: ``fn(messages Column) -> text Column`` (build it
    from Column functions, e.g. ``transform`` over the message array)."""
    TEMPLATES[name] = fn


def render_chat(messages, template: str = "plain") -> Column:
    """P5: apply a registered template (unknown name -> error)."""
    try:
        fn = TEMPLATES[template]
    except KeyError:
        raise ValueError(f"unknown template {template!r}; known: {sorted(TEMPLATES)}") from None
    return fn(messages)


def split_prompt_reference(text, strip_suffixes: tuple[str, ...] = ()) -> Column:
    """struct(prompt, reference).

    Cut right after the first occurrence of the first marker (in priority
    order) that occurs in the text; the reference is stripped, the prompt is
    not. Without any marker the text is cut at ``len // 2`` code points.
    ``strip_suffixes`` (e.g. ``("</s>",)``) removes a template's end token
    from the reference (off by default: the plain split keeps it).
    """
    t = _c(text)
    cut = F.floor(F.length(t) / 2).cast("int")  # fallback: len // 2
    for m in reversed(RESPONSE_MARKERS):
        pos = F.instr(t, m)
        cut = F.when(pos > 0, pos + F.lit(len(m)) - 1).otherwise(cut)
    prompt = F.substring(t, F.lit(1), cut)
    reference = py_strip(F.substring(t, cut + 1, F.lit(2147483647)))
    for suf in strip_suffixes:
        cut_ref = py_strip(F.substring(reference, F.lit(1), F.length(reference) - len(suf)))
        reference = F.when(reference.endswith(suf), cut_ref).otherwise(reference)
    return F.struct(prompt.alias("prompt"), reference.alias("reference"))
