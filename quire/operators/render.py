"""Instruction rows -> messages -> training text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.templates import render_chat, to_messages
from quire.functions.text import blank_to_empty, content_hash, is_blank


def _col_or_null(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def clean_fields(df: DataFrame) -> DataFrame:
    """null/missing/empty -> "" and Python-exact strip.

    ``output`` falls back to ``response`` when it is null or empty *before*
    stripping (a whitespace-only ``output`` does not fall back).
    """
    out = _col_or_null(df, "output")
    resp = _col_or_null(df, "response")
    chosen = F.when(out.isNull() | (out == ""), resp).otherwise(out)
    keep = [c for c in df.columns if c not in ("instruction", "input", "output", "response")]
    return df.select(
        *keep,
        blank_to_empty(_col_or_null(df, "instruction")).alias("instruction"),
        blank_to_empty(_col_or_null(df, "input")).alias("input"),
        blank_to_empty(chosen).alias("output"),
    )


def compose_user_turn(instruction="instruction", context="input"):
    """The instruction, plus a blank line and the input when it is non-empty."""
    i, c = F.col(instruction), F.col(context)
    return F.when(c == "", i).otherwise(F.concat(i, F.lit("\n\n"), c))


def with_messages(df: DataFrame) -> DataFrame:
    """P1 + P2 + P3: cleaned row -> ``messages`` array<struct<role,content>>."""
    c = clean_fields(df)
    return c.withColumn("messages", to_messages(compose_user_turn(), F.col("output")))


def render(df: DataFrame, template: str = "plain", keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Instruction rows -> ``(*keep, text)``; the input columns are dropped."""
    m = with_messages(df)
    return m.select(*[k for k in keep if k in m.columns], render_chat(F.col("messages"), template).alias("text"))


def drop_blank(df: DataFrame, col: str = "text") -> DataFrame:
    """drop rows whose text is blank after a Python-exact strip."""
    return df.filter(~is_blank(col))


def flag_empty_input(df: DataFrame, col: str = "input") -> DataFrame:
    """boolean ``empty_input`` (null, missing, empty or whitespace-only)."""
    return df.withColumn("empty_input", is_blank(_col_or_null(df, col)))


def with_content_hash(df: DataFrame, col: str = "text", out: str = "content_hash") -> DataFrame:
    """Normalised-text SHA-256, computed once and carried as a column."""
    return df.withColumn(out, content_hash(col))


