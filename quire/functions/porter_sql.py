"""The Porter stemmer as a chain of SELECTs over a table of distinct tokens.

Plain string functions only (``translate``, ``replace``, ``left``, ``right``,
``length``), so the same text runs as Spark SQL, in the JVM, and in other SQL engines.
Beside every word goes its shape, a string of ``v`` and ``c``: a stem's measure is the
number of ``vc`` in the shape's beginning. The rules are those of
:mod:`quire.functions.porter`, which is the reference for each of them.

Tokens are lower-case letters and digits. A ``y`` is a vowel after a consonant, so a run
of them is resolved from the left, two at a time; runs of up to ``2 * Y_PASSES`` are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quire.functions.porter import IRREGULAR, STEP2, STEP3, STEP4, VOWELS

Y_PASSES = 32
_LETTERS = "abcdefghijklmnopqrstuvwxz0123456789"          # all but y


def shape(w: str) -> str:
    """SQL of the shape of ``w``: ``v`` for vowels, ``c`` for others."""
    s = f"translate({w}, '{_LETTERS}', '{''.join('v' if c in VOWELS else 'c' for c in _LETTERS)}')"
    s = f"(CASE WHEN left({w}, 1) = 'y' THEN 'c' || substring({s}, 2) ELSE {s} END)"
    return s


def _resolved() -> str:
    """SQL that settles the y of column ``s``; only words with one pay for the passes."""
    out = "s"
    for _ in range(Y_PASSES):
        out = f"replace(replace({out}, 'cy', 'cv'), 'vy', 'vc')"
    two = "replace(replace(replace(replace(s, 'cy', 'cv'), 'vy', 'vc'), 'cy', 'cv'), 'vy', 'vc')"
    return f"CASE WHEN s NOT LIKE '%y%' THEN s WHEN {two} NOT LIKE '%y%' THEN {two} ELSE {out} END"


def _measure_over(n: int, cut: int, add: str = "") -> str:
    """SQL: the measure of the word without its last ``cut`` letters exceeds ``n``.
    ``add`` is the shape of letters put behind it."""
    part = f"left(s, length(s) - {cut})" + (f" || '{add}'" if add else "")
    return f"length(replace({part}, 'vc', '')) <= length({part}) - {2 * (n + 1)}"


def _ends(suffix: str) -> str:
    return f"right(w, {len(suffix)}) = '{suffix}'"


def _minus(n: int, put: str = "") -> str:
    return f"left(w, length(w) - {n})" + (f" || '{put}'" if put else "")


def _rules(rules, over: int, extra=None) -> str:
    """The first rule whose suffix fits decides, whether its condition holds or not."""
    arms = []
    for suffix, put in rules:
        cond = _measure_over(over, len(suffix))
        if extra and suffix in extra:
            cond = extra[suffix]
        arms.append(f"WHEN {_ends(suffix)} THEN CASE WHEN {cond} THEN {_minus(len(suffix), put)} ELSE w END")
    return "CASE " + " ".join(arms) + " ELSE w END"


def _cvc(w: str, s: str) -> str:
    return (f"((length({s}) >= 3 AND right({s}, 3) = 'cvc' AND right({w}, 1) NOT IN ('w', 'x', 'y')) OR {s} = 'vc')")


def stem_chain(source: str, name: str = "stems", token: str = "token") -> str:
    """Common table expressions that end in ``name(token, stem)`` over the distinct
    tokens of table ``source``."""
    out: list[str] = []
    last = f"{name}_0"
    known = ", ".join(f"'{k}'" for k in IRREGULAR)
    out.append(f"{last} AS (SELECT {token} AS token, {token} AS w FROM {source} WHERE length({token}) > 2 AND {token} NOT IN ({known}))")

    def shaped():
        nonlocal last
        out.append(f"{last}s AS (SELECT token, w, {_resolved()} AS s FROM (SELECT token, w, {shape('w')} AS s FROM {last}) AS x)")
        last += "s"

    def step(expr, label):
        nonlocal last
        shaped()
        out.append(f"{name}_{label} AS (SELECT token, {expr} AS w FROM {last})")
        last = f"{name}_{label}"

    # plurals
    step(f"CASE WHEN {_ends('ies')} AND length(w) = 4 THEN {_minus(1)} WHEN {_ends('sses')} THEN {_minus(2)} WHEN {_ends('ies')} THEN {_minus(2)} "
         f"WHEN {_ends('ss')} THEN w WHEN {_ends('s')} THEN {_minus(1)} ELSE w END", "1a")
    # -ied, -eed; then -ed and -ing: the stripped word is mended in the next step
    cut = (f"CASE WHEN {_ends('ied')} OR {_ends('eed')} THEN 0 WHEN {_ends('ed')} AND left(s, length(s) - 2) LIKE '%v%' THEN 2 "
           f"WHEN {_ends('ing')} AND left(s, length(s) - 3) LIKE '%v%' THEN 3 ELSE 0 END")
    shaped()
    out.append(f"{name}_1c AS (SELECT token, w, s, {cut} AS cut FROM {last})")
    whole = (f"CASE WHEN {_ends('ied')} THEN CASE WHEN length(w) = 4 THEN {_minus(1)} ELSE {_minus(2)} END "
             f"WHEN {_ends('eed')} AND {_measure_over(0, 3)} THEN {_minus(1)} ELSE w END")
    mended = ("CASE WHEN right(t, 2) IN ('at', 'bl', 'iz') THEN t || 'e' "
              "WHEN length(t) >= 2 AND right(t, 1) = right(left(t, length(t) - 1), 1) AND right(u, 1) = 'c' THEN "
              "CASE WHEN right(t, 1) IN ('l', 's', 'z') THEN t ELSE left(t, length(t) - 1) END "
              f"WHEN length(replace(u, 'vc', '')) = length(u) - 2 AND {_cvc('t', 'u')} THEN t || 'e' ELSE t END")
    out.append(f"{name}_1b AS (SELECT token, CASE WHEN cut = 0 THEN {whole} ELSE {mended} END AS w FROM "
               f"(SELECT token, w, s, cut, left(w, length(w) - cut) AS t, left(s, length(s) - cut) AS u FROM {name}_1c) AS x)")
    last = f"{name}_1b"
    step(f"CASE WHEN {_ends('y')} AND length(w) > 2 AND right(left(s, length(s) - 1), 1) = 'c' THEN {_minus(1, 'i')} ELSE w END", "1y")
    step(f"CASE WHEN {_ends('alli')} AND {_measure_over(0, 4)} THEN {_minus(2)} ELSE w END", "2a")
    step(_rules(STEP2, 0, {"logi": _measure_over(0, 4, "c")}), "2")
    step(_rules(STEP3, 0), "3")
    ion = f"({_measure_over(1, 3)} AND right({_minus(3)}, 1) IN ('s', 't'))"
    step(_rules([(x, "") for x in STEP4], 1, {"ion": ion}), "4")
    short = _cvc(_minus(1), "left(s, length(s) - 1)")
    step(f"CASE WHEN {_ends('e')} AND ({_measure_over(1, 1)} OR ({_measure_over(0, 1)} AND NOT {short})) THEN {_minus(1)} ELSE w END", "5e")
    step(f"CASE WHEN {_ends('ll')} AND {_measure_over(1, 1)} THEN {_minus(1)} ELSE w END", "5l")
    odd = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in IRREGULAR.items())
    out.append(f"{name} AS (SELECT token, w AS stem FROM {last} UNION ALL "
               f"SELECT {token}, CASE {token} {odd} ELSE {token} END FROM {source} WHERE length({token}) <= 2 OR {token} IN ({known}))")
    return ",\n".join(out)


def stem_table(tokens: DataFrame, token: str = "token") -> DataFrame:
    """(token, stem) of the distinct ``tokens``, worked out in the JVM."""
    spark = tokens.sparkSession
    d = tokens.select(tokens[token].alias("token")).where("token IS NOT NULL").distinct()
    return spark.sql(f"WITH {stem_chain('{d}')} SELECT token, stem FROM stems", d=d)
