"""Column expressions with exact Python ``str`` semantics.

Python's ``str.split()`` / ``str.strip()`` treat 29 code points as whitespace;
Spark's ``trim`` removes only spaces and ``\\s`` misses most of them. The
character set and the regex class below are exact, so every function here
equals its Python counterpart on any Unicode input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# The 29 code points Python's str.split()/str.strip() treat as whitespace.
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
            "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
            "\u2028\u2029\u202f\u205f\u3000")
# The same set as a regex class (valid in Java regex and in RE2/DuckDB).
WS_CLASS = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WS_RUN = WS_CLASS + "+"
# ----------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """``s.strip()``."""
    return F.btrim(_c(col), F.lit(WS_CHARS))


def py_rstrip(col) -> Column:
    """``s.rstrip()``."""
    return F.rtrim(_c(col), F.lit(WS_CHARS))


def blank_to_empty(col) -> Column:
    """``(s or "").strip()``: null, missing and empty all become ``""``."""
    return py_strip(F.coalesce(_c(col), F.lit("")))


def ws_tokens(col) -> Column:
    """``s.split()`` as ``array<string>`` (empty array for blank text)."""
    s = F.trim(fold_ws(F.coalesce(_c(col), F.lit(""))))
    return F.array_remove(F.split(s, " +"), "")


def fold_ws(col) -> Column:
    """Every whitespace code point -> one ASCII space (``translate``: a
    per-character map, several times faster than a Unicode regex class)."""
    return F.translate(_c(col), WS_CHARS, " " * len(WS_CHARS))


def squeeze_spaces(col) -> Column:
    """Runs of ASCII spaces -> one space, then trim (only spaces remain)."""
    return F.trim(F.regexp_replace(_c(col), "  +", " "))


def normalize_text(col) -> Column:
    """``" ".join(s.lower().split())``."""
    return squeeze_spaces(fold_ws(F.lower(_c(col))))


def content_hash(col) -> Column:
    """SHA-256 hex of the UTF-8 bytes of the normalised text."""
    return F.sha2(normalize_text(col), 256)


def seeded_rank(seed: int, key_col="content_hash") -> Column:
    """Shuffle key: SHA-256 of ``"{seed}:{key}"`` (D2). A total order that
    depends on content and seed only, never on partitioning or input order."""
    return F.sha2(F.concat(F.lit(f"{int(seed)}:"), _c(key_col)), 256)


def is_blank(col) -> Column:
    return py_strip(F.coalesce(_c(col), F.lit(""))) == ""


def text_preview(col, n: int = 300) -> Column:
    """First ``n`` code points."""
    return F.substring(_c(col), 1, n)


def count_ws_tokens(col) -> Column:
    """``len(s.split())``: every token becomes one letter, white space goes, and the
    letters are counted - no array of tokens is made."""
    marks = F.regexp_replace(fold_ws(F.coalesce(_c(col), F.lit(""))), "[^ ]++", "x")
    return F.length(F.translate(marks, " ", ""))


def truncate_ws_tokens(col, max_tokens: int) -> Column:
    """Whitespace-token truncation (P10): struct(text, n_tokens, was_truncated).
    A text within the budget stays as it is; a longer one is cut right after
    its last token, white space before it untouched, by one anchored match that
    reads no further than the cut."""
    text = F.coalesce(_c(col), F.lit(""))
    n = count_ws_tokens(col)
    token = WS_CLASS + "*+[^" + WS_CLASS[1:] + "++"
    head = F.regexp_extract(text, f"\\A(?:{token}){{1,{max_tokens}}}+", 0) if max_tokens > 0 else F.lit("")
    return F.struct(
        F.when(n > max_tokens, head).otherwise(text).alias("text"),
        n.alias("n_tokens"),
        (n > max_tokens).alias("was_truncated"),
    )


def last_words(col, k: int) -> Column:
    """``" ".join(s.split()[-k:])``."""
    toks = ws_tokens(col)
    start = F.greatest(F.size(toks) - F.lit(k), F.lit(0)) + 1
    return F.array_join(F.slice(toks, start, F.lit(k)), " ")


def first_words(col, k: int) -> Column:
    """``" ".join(s.split()[:k])``."""
    return F.array_join(F.slice(ws_tokens(col), 1, k), " ")
