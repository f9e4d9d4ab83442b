"""Chat-history assembly from conversation turns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
DEFAULT_SYSTEM = "Educational demo only, not financial advice."
# ----------------------------------------------------------------------------


def assemble_history(turns: DataFrame, system_text: str = DEFAULT_SYSTEM, conv_col: str = "conv_id",
                     turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Message rows ``(conv_id, pos, role, content)`` in the order a chat
    model receives them: position 0 is the system message, then the turns in
    turn order (pos = turn + 1).

    Rows, not a per-conversation array: nothing is gathered per group, so a
    conversation with a third of all turns costs no more than its rows; the
    system rows come from one combined row per ``conv_id``.
    Use :func:`to_message_array` when an array per conversation is really
    needed. A conversation that starts with a system message of its own keeps
    it and gets no other.
    """
    msgs = turns.select(F.col(conv_col).alias("conv_id"), (F.col(turn_col) + 1).cast("long").alias("pos"),
                        F.col(role_col).alias("role"), F.col(text_col).alias("content"))
    first = (turns.groupBy(F.col(conv_col).alias("conv_id"))
             .agg(F.min_by(F.col(role_col), F.col(turn_col)).alias("first_role")))
    system = (first.where(~F.col("first_role").eqNullSafe(F.lit("system")))
                   .select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit("system").alias("role"),
                           F.lit(system_text).alias("content")))
    return system.unionByName(msgs)


def to_message_array(messages: DataFrame) -> DataFrame:
    """``(conv_id, messages array<struct<role, content>>)`` ordered by ``pos``.

    One row per conversation is what is asked for, so a conversation must fit
    one value (2 GB); there is no other limit on its messages.
    """
    g = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "role", "content"))).alias("m"))
    return g.select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"),
                                                                   x["content"].alias("content"))).alias("messages"))
