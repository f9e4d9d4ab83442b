"""Porter stemmer (Porter 1980) with the common later revisions.

A per-token helper used inside the ROUGE-L pandas UDF (cached per worker).
Revisions over the 1980 paper: ``bli -> ble``, ``logi -> log``,
``fulli -> ful`` in step 2, ``alli`` handled before the
other step-2 rules, ``ies``/``ied`` on four-letter words keep ``ie``, a final
``y`` becomes ``i`` only after a consonant, words of one or two letters and a
short list of irregular forms are left as they are.
"""

from __future__ import annotations

from functools import lru_cache

# --- fixed values -----------------------------------------------------------
VOWELS = "aeiou"
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
         ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
         ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
         ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
         ("fulli", "ful"), ("logi", "log")]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
         ("ful", ""), ("ness", "")]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
         "ou", "ism", "ate", "iti", "ous", "ive", "ize"]
# ----------------------------------------------------------------------------


def _cons(w: str, i: int) -> bool:
    ch = w[i]
    if ch in VOWELS:
        return False
    if ch == "y":
        return i == 0 or not _cons(w, i - 1)
    return True


def _m(stem: str) -> int:
    """Number of VC sequences in ``[C](VC)^m[V]``."""
    m, prev_vowel = 0, False
    for i in range(len(stem)):
        c = _cons(stem, i)
        if c and prev_vowel:
            m += 1
        prev_vowel = not c
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    if len(w) >= 3:
        return (_cons(w, len(w) - 3) and not _cons(w, len(w) - 2) and _cons(w, len(w) - 1)
                and w[-1] not in "wxy")
    return len(w) == 2 and not _cons(w, 0) and _cons(w, 1)


def _step1a(w: str) -> str:
    if w.endswith("ies") and len(w) == 4:
        return w[:-3] + "ie"
    for suf, rep in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if w.endswith(suf):
            return w[: len(w) - len(suf)] + rep
    return w


def _step1b(w: str) -> str:
    if w.endswith("ied"):
        return w[:-3] + ("ie" if len(w) == 4 else "i")
    if w.endswith("eed"):
        stem = w[:-3]
        return stem + "ee" if _m(stem) > 0 else w
    for suf in ("ed", "ing"):
        if w.endswith(suf) and _has_vowel(w[: len(w) - len(suf)]):
            stem = w[: len(w) - len(suf)]
            break
    else:
        return w
    for suf, rep in (("at", "ate"), ("bl", "ble"), ("iz", "ize")):
        if stem.endswith(suf):
            return stem[: len(stem) - len(suf)] + rep
    if _double_cons(stem):
        return stem[:-1] if stem[-1] not in "lsz" else stem
    if _m(stem) == 1 and _cvc(stem):
        return stem + "e"
    return stem


def _step1c(w: str) -> str:
    if w.endswith("y") and len(w) > 2 and _cons(w, len(w) - 2):
        return w[:-1] + "i"
    return w


def _rules(w: str, rules, cond) -> str:
    for suf, rep in rules:
        if w.endswith(suf):
            stem = w[: len(w) - len(suf)]
            return stem + rep if cond(stem, suf) else w
    return w


def _step2(w: str) -> str:
    if w.endswith("alli") and _m(w[:-4]) > 0:
        return _step2(w[:-4] + "al")

    def cond(stem, suf):
        if suf == "logi":
            return _m(stem + "l") > 0
        return _m(stem) > 0
    return _rules(w, STEP2, cond)


def _step3(w: str) -> str:
    return _rules(w, STEP3, lambda stem, suf: _m(stem) > 0)


def _step4(w: str) -> str:
    def cond(stem, suf):
        if suf == "ion":
            return _m(stem) > 1 and stem[-1:] in ("s", "t")
        return _m(stem) > 1
    return _rules(w, [(s, "") for s in STEP4], cond)


def _step5(w: str) -> str:
    if w.endswith("e"):
        stem = w[:-1]
        if _m(stem) > 1 or (_m(stem) == 1 and not _cvc(stem)):
            w = stem
    if w.endswith("ll") and _m(w[:-1]) > 1:
        w = w[:-1]
    return w


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    w = word.lower()
    if w in IRREGULAR:
        return IRREGULAR[w]
    if len(w) <= 2:
        return w
    for step in (_step1a, _step1b, _step1c, _step2, _step3, _step4, _step5):
        w = step(w)
    return w


class _Stems(dict):
    """ROUGE token -> what is compared: its stem, or itself up to three letters; emptied when full."""

    def __missing__(self, token: str) -> str:
        if len(self) > 200_000:
            self.clear()
        s = self[token] = stem(token) if len(token) > 3 else token
        return s


STEMS = _Stems()
