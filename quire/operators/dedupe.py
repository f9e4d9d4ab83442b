"""Keep-first de-duplication by content hash.

Only keys travel to find the winners: a hash aggregation of (key, input order) whose
state is fixed-width numbers, so nothing is sorted and no text is moved. The winners
are then joined back to the rows, on key and input order: the copies of a text, however
many, are dealt by their own order and most of them are gone before any aggregation
sees a payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PICK, SAME = "_pick", "_same"      # digest of the payload, rows that share the first place


def with_pick(df: DataFrame, payload: list[str]) -> DataFrame:
    """``df`` with the digest of its payload columns that breaks ties of the input order."""
    return df.withColumn(PICK, F.xxhash64(*payload) if payload else F.lit(0).cast("long"))


def first_rows(df: DataFrame, key: str, order_cols: list[str], copies_col: str = "n_copies") -> DataFrame:
    """Per ``key`` the smallest input order (nulls first), the rows that have it
    (``_same``), the smallest of their digests (``_pick``) and the group's size.

    Two hash aggregations: rows of one key and order are counted first, so that ties
    are known; the groups of a hot key are spread by their order and combined
    map-side before the second exchange. One order column of a fixed-width type
    (whole numbers, dates, times) keeps the state in place; other orders are
    compared as structs of the narrow columns.
    """
    o = F.col(order_cols[0]) if len(order_cols) == 1 else F.struct(*order_cols)
    level = df.select(F.col(key), o.alias("_o"), PICK).groupBy(key, "_o").agg(F.count(F.lit(1)).alias("_c"), F.min(PICK).alias(PICK))
    none = F.col("_o").isNull()

    def at_first(value: str) -> Column:
        return F.coalesce(F.max(F.when(none, F.col(value))), F.min_by(value, "_o"))

    g = level.groupBy(key).agg(F.min("_o").alias("_o"), F.max(none.cast("int")).alias("_n"), at_first("_c").alias(SAME),
                               at_first(PICK).alias(PICK), F.sum("_c").alias(copies_col))
    if len(order_cols) == 1:
        return g.withColumn("_o", F.when(F.col("_n") == 0, F.col("_o"))).withColumnRenamed("_o", order_cols[0]).drop("_n")
    return g.select(key, *[F.col("_o")[c].alias(c) for c in order_cols], SAME, PICK, copies_col)


def rows_of(df: DataFrame, first: DataFrame, key: str, order_cols: list[str], small: bool = False) -> DataFrame:
    """The rows of ``df`` (with ``_pick``) that ``first`` names, one each, with the
    other columns of ``first``. ``small`` says that ``first`` has a checked size and
    may be broadcast; otherwise its partitions are hashed, so the wide rows are
    shuffled once and never sorted."""
    mine = [c for c in df.columns if c not in (key, PICK, *order_cols)]
    theirs = [c for c in first.columns if c not in (key, PICK, SAME, *order_cols)]
    f = first.select(*[F.col(c).alias(f"_f_{c}") for c in first.columns])
    on = F.lit(True)
    for c in (key, *order_cols):
        on = on & F.col(c).eqNullSafe(F.col(f"_f_{c}"))
    met = df.join(F.broadcast(f) if small else f.hint("shuffle_hash"), on).where(F.col(PICK) == F.col(f"_f_{PICK}"))
    met = met.select(key, *order_cols, *mine, PICK, *[F.col(f"_f_{c}").alias(c) for c in (*theirs, SAME)])
    if not mine:
        return first
    # rows of one key, order and digest are the same row repeated
    tied = (met.where(F.col(SAME) > 1).groupBy(key, *order_cols, *theirs, PICK, SAME)
            .agg(F.array_min(F.collect_set(F.struct(*mine))).alias("_m"))
            .select(key, *order_cols, *[F.col("_m")[c].alias(c) for c in mine], PICK, *theirs, SAME))
    return met.where(F.col(SAME) == 1).unionByName(tied)


def dedupe_keep_first(df: DataFrame, key: str = "content_hash",
                      order_cols: tuple[str, ...] | list[str] = ("row_id",),
                      copies_col: str | None = "n_copies") -> DataFrame:
    """One row per ``key``; the first row in input order (smallest ``order_cols``,
    nulls first) wins, the digest of the other columns breaks ties. Without an input
    order the smallest digest wins.

    ``copies_col`` carries the group size (so the pre-dedupe count needs no second
    pass). A frame of key and order alone needs no join. Never ``dropDuplicates``
    in batch: it keeps an arbitrary row.
    """
    if not order_cols:
        payload = [c for c in df.columns if c != key]
        d = df.withColumn("_none", F.lit(0))
        return dedupe_keep_first(d, key, ["_none"], copies_col).select(*[c for c in df.columns], *([copies_col] if copies_col else []))
    order_cols = list(order_cols)
    payload = [c for c in df.columns if c != key and c not in order_cols]
    d = with_pick(df, payload)
    out = rows_of(d, first_rows(d, key, order_cols, copies_col or "_copies"), key, order_cols)
    return out.select(*df.columns, *([copies_col] if copies_col else []))
