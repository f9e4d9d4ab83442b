"""BLEU tokenisation (mteval-13a) and the score as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import _c, fold_ws, py_rstrip, squeeze_spaces

# --- fixed values: mteval-13a tokeniser ----------------------------------
# language-independent replacements, applied in this order
TOK13A_REPLACE = [("<skipped>", ""), ("-\n", ""), ("\n", " "),
                  ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]
# regex substitutions, applied in this order (Java replacement syntax)
TOK13A_REGEX = [
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),   # punctuation and symbols
    (r"([^0-9])([\.,])", "$1 $2 "),                # period/comma unless preceded by a digit
    (r"([\.,])([^0-9])", " $1 $2"),                # period/comma unless followed by a digit
    (r"([0-9])(-)", "$1 $2 "),                     # dash preceded by a digit
]
MAX_ORDER = 4
# ----------------------------------------------------------------------------


def spaced_13a(col) -> Column:
    """The text with its 13a tokens set apart: they are what Python's ``split()`` gives."""
    s = py_rstrip(F.coalesce(_c(col), F.lit("")))
    for a, b in TOK13A_REPLACE:
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.concat(F.lit(" "), s, F.lit(" "))
    for pat, rep in TOK13A_REGEX:
        s = F.regexp_replace(s, pat, rep)
    return s


def tokenize_13a(col) -> Column:
    """13a-tokenised text: tokens separated by single spaces."""
    return squeeze_spaces(fold_ws(spaced_13a(col)))


def bleu_from_stats(c: list, t: list, sys_len, ref_len) -> Column:
    """Corpus BLEU from clipped matches ``c[n]``, hypothesis n-gram totals
    ``t[n]`` and corpus lengths, with exponential smoothing of zero orders.

    ``p_n = 100 c_n / t_n``; the k-th order with ``c_n = 0`` gets
    ``100 / (2^k t_n)``; any ``t_n = 0`` or no match at all gives 0;
    ``BP = exp(1 - ref/sys)`` when ``sys < ref`` (0 when ``sys = 0``).
    """
    logs = []
    zeros = F.lit(0)
    for n in range(len(c)):
        zeros = zeros + F.when(c[n] == 0, 1).otherwise(0)
        p = F.when(c[n] > 0, F.lit(100.0) * c[n] / t[n]).otherwise(F.lit(100.0) / (F.pow(F.lit(2.0), zeros) * t[n]))
        logs.append(F.log(p))
    mean_log = logs[0]
    for lg in logs[1:]:
        mean_log = mean_log + lg
    mean_log = mean_log / F.lit(float(len(c)))
    bp = (F.when(sys_len < ref_len, F.when(sys_len > 0, F.exp(F.lit(1.0) - ref_len / sys_len)).otherwise(F.lit(0.0)))
           .otherwise(F.lit(1.0)))
    any_match = c[0] > 0
    for x in c[1:]:
        any_match = any_match | (x > 0)
    all_totals = t[0] > 0
    for x in t[1:]:
        all_totals = all_totals & (x > 0)
    return F.when(any_match & all_totals, bp * F.exp(mean_log)).otherwise(F.lit(0.0))
