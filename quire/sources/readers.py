"""Sources: instruction tables, derived instruction inputs, previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import stage

INSTRUCTION_COLUMNS = ("instruction", "input", "output", "response")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def conversation_row_id(conv_col: str = "conv_id", turn_col: str = "turn"):
    """``"<conv_id>:<turn>"``: one id a turn, however many turns a conversation has."""
    return F.concat_ws(":", F.col(conv_col).cast("string"), F.col(turn_col).cast("string"))


def read_instructions(spark: SparkSession, path: str, fmt: str = "parquet",
                      mapping: dict[str, str] | None = None,
                      order_col: str | None = None, schema=None,
                      options: dict | None = None) -> DataFrame:
    """Load instruction rows and map source columns to
    ``instruction / input / output / response`` by name.

    ``mapping`` maps our names to source column names; a missing optional
    column becomes a null string (``output`` may be supplied as ``response``).
    ``order_col`` names the input-order key (``row_id``); keep-first dedupe
    needs one.
    """
    r = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    mapping = dict(mapping or {})
    cols = []
    for name in INSTRUCTION_COLUMNS:
        src = mapping.get(name, name)
        cols.append((F.col(src).cast("string") if src in df.columns else F.lit(None).cast("string")).alias(name))
    missing = [n for n in ("instruction",) if mapping.get(n, n) not in df.columns]
    if missing:
        raise ValueError(f"required column(s) {missing} not in {sorted(df.columns)}")
    if mapping.get("output", "output") not in df.columns and mapping.get("response", "response") not in df.columns:
        raise ValueError(f"neither 'output' nor 'response' in {sorted(df.columns)}")
    extra = [F.col(order_col).alias("row_id")] if order_col else []
    return df.select(*extra, *cols)


def documents_as_instructions(docs: DataFrame) -> DataFrame:
    """The first line is the instruction, the rest of the text is the output, the
    input is empty; ``row_id = doc_id``. Batch and streaming frames alike."""
    nl = F.instr(F.col("text"), "\n")
    return docs.select(
        F.col("doc_id").alias("row_id"),
        F.when(nl > 0, F.substring(F.col("text"), F.lit(1), nl - 1)).otherwise(F.col("text")).alias("instruction"),
        F.lit("").alias("input"),
        F.when(nl > 0, F.substring(F.col("text"), nl + 1, F.lit(2147483647))).otherwise(F.lit("")).alias("output"),
    )


def doc_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as instruction rows."""
    return documents_as_instructions(table(spark, sf_dir, "documents").select("doc_id", "text"))


def conversation_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as instruction rows: a user turn, the directly
    following assistant turn as output, the directly preceding system turn
    (or "") as input; ``row_id`` names conversation and user turn.

    Every turn is sent to the anchor of the pair it may belong to (user:
    own turn, assistant: turn-1, system: turn+1) and one aggregation on
    ``(conv_id, anchor)`` assembles the pair. The key is near-unique, so one
    huge conversation spreads over all reducers (a window over ``conv_id``
    would put it in a single task); partial aggregation runs map-side.
    """
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    anchor = (F.when(F.col("role") == "assistant", F.col("turn") - 1)
               .when(F.col("role") == "system", F.col("turn") + 1)
               .otherwise(F.col("turn")))
    t = t.filter(F.col("role").isin("user", "assistant", "system")).withColumn("anchor", anchor)

    def pick(role):
        return F.max(F.when(F.col("role") == role, F.col("text")))

    g = (t.groupBy("conv_id", "anchor")
          .agg(pick("user").alias("instruction"), pick("system").alias("sys"),
               pick("assistant").alias("output"),
               F.max(F.when(F.col("role") == "user", F.lit(True))).alias("has_user"),
               F.max(F.when(F.col("role") == "assistant", F.lit(True))).alias("has_asst")))
    return g.filter(F.col("has_user") & F.col("has_asst")).select(
        F.col("conv_id"), F.col("anchor").alias("turn"),
        conversation_row_id("conv_id", "anchor").alias("row_id"),
        "instruction", F.coalesce(F.col("sys"), F.lit("")).alias("input"), "output",
    )


# our own smoke-test topics, one template over unit conversions
_UNITS = [("kilometre", "metres", 1000), ("hour", "seconds", 3600), ("tonne", "kilograms", 1000),
          ("dozen", "pieces", 12), ("fortnight", "days", 14), ("litre", "millilitres", 1000)]
SYNTHETIC_TOPICS = [(f"How many {many} make one {one}?", f"One {one} is {n} {many}.") for one, many, n in _UNITS]


def synthetic_instructions(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows over 6 topics; topic = i mod 6; rows with i mod 6 = 0 get
    no suffix (exact duplicates), the others get a unique ``" [case i]"``.
    ``row_id`` is a seeded shuffle of ``i`` (a hash order, not Python's RNG)."""
    k = len(SYNTHETIC_TOPICS)
    instr = F.array(*[F.lit(a) for a, _ in SYNTHETIC_TOPICS])
    outs = F.array(*[F.lit(b) for _, b in SYNTHETIC_TOPICS])
    i = F.col("id")
    topic = (i % k + 1).cast("int")
    suffix = F.when(i % k == 0, F.lit("")).otherwise(F.concat(F.lit(" [case "), i.cast("string"), F.lit("]")))
    return spark.range(n).select(
        F.xxhash64(F.lit(int(seed)), i).alias("row_id"),
        F.concat(F.element_at(instr, topic), suffix).alias("instruction"),
        F.lit("").alias("input"),
        F.element_at(outs, topic).alias("output"),
    )


def first_in_order(df: DataFrame, n: int, order_col: str = "row_id") -> DataFrame:
    """The first ``n`` rows by ``order_col`` (nulls first). The n-th smallest key is
    found from the order column alone; wide columns are then read under a filter on
    it, which file sources skip row groups by."""
    cut = df.select(order_col).orderBy(order_col).limit(n).agg(F.max(order_col)).first()[0]
    k = F.col(order_col)
    near = df.where(k.isNull()) if cut is None else df.where(k.isNull() | (k <= F.lit(cut)))
    return near.orderBy(order_col).limit(n)


def preview(df: DataFrame, n: int, order_col: str = "row_id") -> DataFrame:
    """S3: the first ``n`` rows in input order (a bounded top-n, the limit is
    the feature). Raises when the source yields no rows."""
    out = stage(first_in_order(df, n, order_col), "preview")
    if out.isEmpty():
        raise RuntimeError("the source yielded 0 rows")
    return out
