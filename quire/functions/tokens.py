"""P10 with a user tokenizer: truncate texts to a token budget.

The default budget counts whitespace tokens with Column expressions
(:func:`quire.functions.text.truncate_ws_tokens`). A model tokenizer is
per-row Python, so it runs in an Arrow-batched pandas UDF; the tokenizer
is built once per Python worker from ``make_tokenizer``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

TRUNC_TYPE = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_tokens", T.IntegerType()),
                           T.StructField("was_truncated", T.BooleanType())])

_RESIDENT: dict = {"key": None, "tokenizer": None}


def resident_tokenizer(key: str, make_tokenizer):
    """The worker's tokenizer: built once per worker and call, one at a time.
    Workers reach this module by import, so the table is theirs and not a copy
    that travels with each task."""
    if _RESIDENT["key"] != key:
        _RESIDENT["key"], _RESIDENT["tokenizer"] = key, make_tokenizer()
    return _RESIDENT["tokenizer"]


def truncate_with_tokenizer(col: Column, make_tokenizer: Callable[[], tuple[Callable, Callable]],
                            max_tokens: int) -> Column:
    """struct(text, n_tokens, was_truncated); ``make_tokenizer()`` returns
    ``(encode(str) -> list[int], decode(list[int]) -> str)``. No packing:
    each text is cut on its own."""

    from quire.session import ship_package
    ship_package()
    key = uuid.uuid4().hex      # names this call: factories of one function share a name

    @pandas_udf(TRUNC_TYPE)
    def trunc(s: pd.Series) -> pd.DataFrame:
        encode, decode = resident_tokenizer(key, make_tokenizer)
        texts, counts, cut = [], [], []
        for x in s:
            ids = encode("" if x is None else x)
            counts.append(len(ids))
            cut.append(len(ids) > max_tokens)
            texts.append(decode(ids[:max_tokens]) if len(ids) > max_tokens else ("" if x is None else x))
        return pd.DataFrame({"text": texts, "n_tokens": counts, "was_truncated": cut})

    return trunc(col)
