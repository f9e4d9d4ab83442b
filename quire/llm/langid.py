"""Language identification by compression.

Every language gets a zstandard raw-content dictionary cut from texts of that
language. A text is reduced to its different words, lower-cased, in order of first
use (repetition says nothing new, and hides a text's language in its matches with
itself), and encoded, in blocks, once with each dictionary; the language whose
encodings are smallest in total is chosen, and the choice is rejected when the
runner-up is about as small. One level serves texts of all lengths. Where a text is so
short that the smallest encodings are equally long (the format then stores the text as
it is), the runs of four bytes of its words, ends included, that stand in each of these
dictionaries decide; where none of them holds more, the text is rejected.

Fitting reads ids, texts and labels of the fitting rows only and takes a bounded
sample: about ``sample_docs`` texts a language, chosen by a hash of the id, of
each at most ``piece_chars`` characters, up to ``dict_bytes``. Prediction reads the
text alone, all of it.

Defined results: a text that is null or has no letter is ``und`` with score 0 and
rejected; what sizes and words leave equal goes to the language first in code point
order; repeated rows are treated alike; other columns pass through, whatever their
names; an empty table gives an empty result. Without any labelled text every
prediction is ``und``, and :func:`keep_identified`, which would keep nothing, fails.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import free_name, frees_memory, ship_package

_WORD = re.compile(r"[^\W\d_]")             # letters, and numbers that are no digits
UNKNOWN = "und"
#: ASCII bytes that are not letters end a word
_WORDS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: str) -> bool:
    """A character of one of the Unicode letter categories."""
    return any(m.group().isalpha() for m in _WORD.finditer(text))


def words(text: str) -> list[bytes]:
    return text.lower().encode().translate(_WORDS).split()


def held_out(doc_id: Column) -> Column:
    """Rows kept from fitting: crc32 of the id as text, modulo 5, is 0 (a null id is fitted on as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = 256,
        piece_chars: int = 2000, dict_bytes: int = 131_072) -> dict[str, bytes]:
    """{language: dictionary}; at most about ``sample_docs`` pieces a language reach the driver."""
    train = docs.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0) & ~held_out(F.col(id_col)))
    counts = {r[0]: r[1] for r in train.groupBy(lang_col).count().collect()}
    if not counts:
        return {}
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, sample_docs / n))]), F.col(lang_col))
    u = F.pmod(F.xxhash64(F.col(id_col), F.lit("langid")), F.lit(1 << 30))
    rows = (train.where(u < share * float(1 << 30))
            .select(F.col(lang_col).alias("lang"), u.alias("u"), F.substring(text_col, 1, piece_chars).alias("t")).collect())
    out: dict[str, bytes] = {}
    for lang, _, t in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if len(out.get(lang, b"")) < dict_bytes:
            out[lang] = out.get(lang, b"") + b" ".join(words(t)) + b" "
    return {k: v[:dict_bytes] for k, v in out.items()}


class Classifier:
    """Compressors of all languages; one a task."""

    def __init__(self, dictionaries: dict[str, bytes], block: int = 8192, level: int = 6):
        self.block, self.langs = block, sorted(dictionaries)
        self.zips = [self._zip(dictionaries[lang], level) for lang in self.langs]
        self.held = [b" " + dictionaries[lang] for lang in self.langs]

    @staticmethod
    def _zip(content: bytes, level: int) -> zstandard.ZstdCompressor:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        return zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)

    def sizes(self, different: list[bytes]) -> list[int]:
        data = b" ".join(different)
        blocks = [data[i:i + self.block] for i in range(0, len(data), self.block)]
        return [sum(len(z.compress(b)) for b in blocks) for z in self.zips]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin): the score is the share of 2 ** -size, the margin
        what the runner-up is larger by, relative; between equal smallest sizes both
        come from the runs of bytes that are known."""
        if not text or not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, 0.0
        different = list(dict.fromkeys(words(text)))
        sizes = self.sizes(different)
        best = min(sizes)
        equal = [i for i, n in enumerate(sizes) if n == best]
        if len(equal) > 1:
            said = b" " + b" ".join(different) + b" "
            runs = {said[i:i + 4] for i in range(max(1, len(said) - 3))}
            known = [sum(r in self.held[i] for r in runs) for i in equal]
            most = max(known)
            score = (most + 1) / (sum(known) + len(known))
            return self.langs[equal[known.index(most)]], score, (most - sorted(known)[-2]) / len(runs)
        score = 1.0 / sum(math.exp2(max(best - s, -1000)) for s in sizes)
        margin = (sorted(sizes)[1] - best) / best if len(sizes) > 1 else 1.0
        return self.langs[sizes.index(best)], score, margin


@frees_memory
def _predict(columns: Iterator[pa.Array], model: dict[str, bytes], block: int, level: int, min_margin: float) -> Iterator[pa.Array]:
    """The compressors live as long as the task; texts are unpacked a stretch at a time."""
    c = Classifier(model, block, level)
    for texts in columns:
        lang, score, rejected = [], [], []
        for at in range(0, len(texts), 256):
            for t in texts.slice(at, 256).to_pylist():
                got = c.predict(t)
                lang.append(got[0])
                score.append(got[1])
                rejected.append(got[0] == UNKNOWN or got[2] < min_margin)
        yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                                         names=["lang", "score", "rejected"])


def classify(docs: DataFrame, model: dict[str, bytes], text_col: str = "text", out_col: str = "language", block: int = 8192,
             level: int = 6, min_margin: float = 0.002) -> DataFrame:
    """``docs`` with ``out_col``: struct of ``lang``, ``score`` (0 to 1) and ``rejected``. Only the text goes to Python."""
    ship_package(docs.sparkSession)

    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _predict(columns, model, block, level, min_margin)

    # marked so that Spark evaluates it once, not once for each field that is used
    udf = F.arrow_udf(predict, "lang string, score double, rejected boolean").asNondeterministic()
    return docs.withColumn(out_col, udf(F.col(text_col)))


def keep_identified(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, fitted on the labelled rows of ``docs``."""
    cols = docs.columns
    model = fit(docs, text_col=text_col)
    if not model and not docs.isEmpty():
        raise ValueError("no labelled text to learn languages from")
    mine = free_name(cols, "language")
    out = classify(docs, model, text_col, mine, **options)
    return out.where(~F.col(mine)["rejected"]).select(*[F.col(c) for c in cols])
