"""BLEU and ROUGE-L against brute-force Python definitions; metamorphic checks."""

import math
import random
import re
from collections import Counter

import pytest

from quire.functions.porter import stem
from quire.operators.scoring import corpus_bleu, lcs_length, rouge_l, rouge_l_rows, throughput

# --- brute-force references written from the definitions -----------------------


def tok13a(line):
    line = line.rstrip()
    for a, b in [("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"),
                 ("&gt;", ">")]:
        line = line.replace(a, b)
    line = f" {line} "
    line = re.sub(r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 ", line)
    line = re.sub(r"([^0-9])([\.,])", r"\1 \2 ", line)
    line = re.sub(r"([\.,])([^0-9])", r" \1 \2", line)
    line = re.sub(r"([0-9])(-)", r"\1 \2 ", line)
    return line.split()


def brute_bleu(hyps, refs):
    correct, total, sys_len, ref_len = [0] * 4, [0] * 4, 0, 0
    for h, r in zip(hyps, refs):
        ht, rt = tok13a(h), tok13a(r)
        sys_len += len(ht)
        ref_len += len(rt)
        for n in range(1, 5):
            hc = Counter(tuple(ht[i:i + n]) for i in range(len(ht) - n + 1))
            rc = Counter(tuple(rt[i:i + n]) for i in range(len(rt) - n + 1))
            correct[n - 1] += sum(min(c, rc[g]) for g, c in hc.items())
            total[n - 1] += sum(hc.values())
    bp = 1.0 if sys_len >= ref_len else (math.exp(1 - ref_len / sys_len) if sys_len > 0 else 0.0)
    if not any(correct) or not all(total):
        return 0.0
    prec, k = [], 1.0
    for c, t in zip(correct, total):
        if c == 0:
            k *= 2
            prec.append(100.0 / (k * t))
        else:
            prec.append(100.0 * c / t)
    return round(bp * math.exp(sum(math.log(p) for p in prec) / 4), 4)


def rouge_tok(text):
    toks = re.split(r"\s+", re.sub(r"[^a-z0-9]+", " ", text.lower()))
    return [stem(t) if len(t) > 3 else t for t in toks if t]


def lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(prev[j] + 1 if x == y else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def brute_rouge(hyps, refs):
    fs = []
    for h, r in zip(hyps, refs):
        ht, rt = rouge_tok(h), rouge_tok(r)
        if not ht or not rt:
            fs.append(0.0)
            continue
        lcs = lcs_dp(rt, ht)
        p, rc = lcs / len(ht), lcs / len(rt)
        fs.append(0.0 if p + rc == 0 else 2 * p * rc / (p + rc))
    return round(100.0 * sum(fs) / len(fs), 4) if fs else 0.0


WORDS = ["the", "cat", "sat", "on", "mat", "running", "runs", "3.5", "1,000", "well-known", "9-5", "U.S.", "a.",
         "(x)", "&amp;", "café", "\U0001F600", "it's", "relational", "hopping", "x" * 5, "Cat", "MAT.",
         "a\\Eb", "q\\E", "\\Q", "x|y", "^$", "a*b", "(?", "\x01"]


def rand_text(rnd, k):
    return " ".join(rnd.choice(WORDS) for _ in range(k))


def pairs_frame(spark, hyps, refs, system="s"):
    rows = [(i, system, h, r) for i, (h, r) in enumerate(zip(hyps, refs))]
    return spark.createDataFrame(rows, "example_id long, system string, prediction string, reference string")


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_bleu_and_rouge_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    hyps = [rand_text(rnd, rnd.randint(0, 12)) for _ in range(60)]
    refs = [rand_text(rnd, rnd.randint(0, 30)) for _ in range(60)]
    hyps[0] = ""                       # empty prediction
    hyps[1] = "cat mat"                # shorter than 4 tokens
    hyps[2] = "zzz qqq"                # no matching unigram
    df = pairs_frame(spark, hyps, refs)
    assert corpus_bleu(df).first().bleu == brute_bleu(hyps, refs)
    assert rouge_l(df).first().rouge_l == brute_rouge(hyps, refs)


def test_identical_predictions_score_100(spark):
    refs = ["the cat sat on the mat today", "a quick brown fox jumps over it"]
    df = pairs_frame(spark, refs, refs)
    assert corpus_bleu(df).first().bleu == 100.0
    assert rouge_l(df).first().rouge_l == 100.0


def test_no_match_and_short_corpus_is_zero(spark):
    df = pairs_frame(spark, ["zzz"], ["the cat"])
    assert corpus_bleu(df).first().bleu == 0.0
    rows = rouge_l_rows(df).collect()
    assert rows[0].rouge_l_f == 0.0


def test_lcs_bit_parallel_equals_dp():
    rnd = random.Random(5)
    for _ in range(300):
        a = [rnd.choice("abcde") for _ in range(rnd.randint(0, 70))]
        b = [rnd.choice("abcdef") for _ in range(rnd.randint(0, 90))]
        assert lcs_length(a, b) == lcs_dp(a, b)


PORTER = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi",
    "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc",
    "digitizer": "digit", "conformabli": "conform", "radicalli": "radic", "differentli": "differ",
    "vileli": "vile", "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic",
    "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
    "callousness": "callous", "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl",
    "triplicate": "triplic", "formative": "form", "formalize": "formal", "electriciti": "electr",
    "electrical": "electr", "hopeful": "hope", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust",
    "defensible": "defens", "irritant": "irrit", "replacement": "replac", "adjustment": "adjust",
    "dependent": "depend", "adoption": "adopt", "homologou": "homolog", "communism": "commun",
    "activate": "activ", "angulariti": "angular", "homologous": "homolog", "effective": "effect",
    "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control",
    "roll": "roll", "generalizations": "gener", "dying": "die",
}


def test_porter_goldens():
    assert {w: stem(w) for w in PORTER} == PORTER


def test_throughput_zero_elapsed(spark):
    df = spark.createDataFrame([(1, "a", "x y", 2, 0.0), (2, "a", "x", 1, 0.5)],
                               "example_id long, system string, prediction string, n_tokens int, seconds double")
    r = throughput(df).first()
    assert (r.tokens, r.seconds, r.mean_tok_per_sec, r.tok_per_sec) == (3, 0.5, 1.0, 6.0)


def test_predictions_and_references_union_path(spark):
    from quire.operators.scoring import per_example_from, score_predictions
    rnd = random.Random(9)
    refs = [rand_text(rnd, rnd.randint(3, 20)) for _ in range(6)]
    ha = [rand_text(rnd, rnd.randint(1, 10)) for _ in range(5)]     # system a: examples 0..4
    hb = [rand_text(rnd, rnd.randint(1, 10)) for _ in range(3)]     # system b: examples 0..2
    preds = spark.createDataFrame([(i, "a", h) for i, h in enumerate(ha)] + [(i, "b", h) for i, h in enumerate(hb)],
                                  "example_id long, system string, prediction string")
    rdf = spark.createDataFrame(list(enumerate(refs)), "example_id long, reference string")   # example 5: no prediction
    got = {r.system: r for r in score_predictions(preds, rdf, ["a", "b"]).collect()}
    assert got["a"].bleu == brute_bleu(ha, refs[:5]) and got["a"].n_examples == 5
    assert got["b"].bleu == brute_bleu(hb, refs[:3]) and got["b"].n_examples == 3
    assert got["a"].rouge_l == brute_rouge(ha, refs[:5]) and got["b"].rouge_l == brute_rouge(hb, refs[:3])
    orphan = preds.unionByName(spark.createDataFrame([(9, "a", "x y")], "example_id long, system string, prediction string"))
    with pytest.raises(ValueError):
        per_example_from(orphan, rdf, ["a", "b"], check=True)


def test_clipping_needs_no_row_per_ngram(spark):
    """A task's memory must not grow with the n-grams of its examples: each row counts its own."""
    from quire.operators.scoring import _gram_stats, example_stats
    df = pairs_frame(spark, ["a b a", "", "c"], ["a b c a b", "a", "c c"])
    plan = _gram_stats(df)._jdf.queryExecution().executedPlan().toString()
    assert "keys=[example_id" not in plan[:plan.index("Generate inline")]
    got = {(r.n, r.system): (r.correct, r.total, r.ref_len) for r in _gram_stats(df).collect()}
    assert got == {(0, "s"): (0, 3, 8), (1, "s"): (4, 4, 0), (2, "s"): (1, 2, 0), (3, "s"): (0, 1, 0)}
    rnd = random.Random(4)
    for _ in range(200):
        ref, *hyps = ([rnd.choice("abcd") for _ in range(rnd.randint(0, 12))] for _ in range(3))
        for n, i, c, t, _ in example_stats(ref, hyps):
            if n:
                h, r = (["".join(x[k:k + n]) for k in range(len(x) - n + 1)] for x in (hyps[i], ref))
                assert (c, t) == (sum(min(h.count(g), r.count(g)) for g in set(h)), len(h))
    assert example_stats(["a"], [None]) == []


def test_rouge_rows_travel_as_text():
    """References go to the workers as one text each; tokens outside the prediction cost no comparison."""
    import pandas as pd

    from quire.operators.scoring import _lcs_rows
    got = _lcs_rows(pd.Series([" the cats were running ", None]), pd.Series([["cat runs", None], ["", "x"]]), True)
    assert got[0] == [{"lcs": 2, "n_pred": 2, "n_ref": 4}, None]
    assert [x["lcs"] for x in got[1]] == [0, 0] and got[1][1]["n_ref"] == 0

    class Token(str):
        asked = 0
        __hash__ = str.__hash__

        def __eq__(self, other):
            Token.asked += 1
            return str.__eq__(self, other)

    far = [Token(f"w{i}") for i in range(5000)]
    assert lcs_length(["a", "b", "c", "d"], [*far, "d", "a", "c"]) == 2 and Token.asked < 5000
