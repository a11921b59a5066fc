"""Language identification by compression with per-language dictionaries.

Each learned language has a zstandard raw-content dictionary, made of fragments
of its documents.  A text's words, without immediate repeats, are encoded with every dictionary, in chunks so that the
dictionary matters throughout; the language of the smallest total is chosen.
A few words are too short for that: a block that would not shrink is stored as it is, in every language alike.  Equal totals
are therefore encoded anew, each part of the text after a filler that shrinks, so that a match with a dictionary shows.
The margin to the second smallest tells how sure that is, and narrow margins
are rejected.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import common

UNKNOWN = "und"
#: The sample that dictionaries are made of: documents of a language, characters of a document.
MAX_DOCS = 256
FRAGMENT = 384
CHUNK = 2048
LEVEL = -1
#: What precedes each part, and the level, where totals are equal.
FILLER, FINE_LEVEL = b"_" * 64, 3
#: Least relative margin of a choice that is not rejected.
MARGIN = 0.02
SHARPNESS = 60.0
_LETTERS = re.compile(r"[^\W\d_]+")


def normal(text: str) -> str:
    """Lower-case words of letters, each once where it is repeated at once."""
    return " ".join(w for w, _ in groupby(_LETTERS.findall(text.lower())))


def learn(docs: DataFrame, max_docs: int = MAX_DOCS, fragment: int = FRAGMENT) -> dict[str, bytes]:
    """Dictionaries of the languages that ``lang`` names.

    Of each language about ``max_docs`` different texts with the lowest hashes are
    taken, and ``fragment`` characters from the middle of each: what reaches the
    driver is bounded by languages x 2 max_docs x fragment, however many copies a text has.
    """
    texts = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", F.xxhash64("text").alias("h"), "text")
    counts = {r["lang"]: r["n"] for r in texts.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    place = F.pmod(F.xxhash64("h"), F.lit(1 << 62))
    wanted = F.lit(False)
    for lang, n in sorted(counts.items()):
        wanted = wanted | ((F.col("lang") == lang) & (place < (1 << 62) * min(n, 2 * max_docs) // n))
    rows = texts.filter(wanted).dropDuplicates(["lang", "h"])

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        parts = [normal(t) for t in b.column(2).to_pylist()]
        parts = [t[max(0, len(t) // 2 - fragment // 2) :][:fragment] for t in parts]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(parts, pa.string())], names=["lang", "h", "part"])

    rows = common.map_arrow(rows, cut, "lang string, h long, part string").collect() if counts else []
    held: dict[str, dict[str, int]] = {}
    for r in sorted(rows, key=lambda r: (r["h"], r["part"])):
        own = held.setdefault(r["lang"], {})
        if len(own) < max_docs and r["part"].strip():
            own[r["part"]] = 1
    return {lang: " ".join(reversed(own)).encode("utf-8", "replace") for lang, own in sorted(held.items()) if own}


@dataclass
class Classifier:
    """Compressors of a worker, made from the dictionaries when first used."""

    dictionaries: dict[str, bytes]
    level: int = LEVEL
    chunk: int = CHUNK

    def __getstate__(self):
        return self.dictionaries, self.level, self.chunk

    def __setstate__(self, state):
        self.dictionaries, self.level, self.chunk = state

    def _compressors(self, level: int):
        made = self.__dict__.setdefault("_made", {})
        if level not in made:
            import zstandard as z

            made[level] = []
            for data in self.dictionaries.values():
                d = z.ZstdCompressionDict(data, dict_type=z.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=level)
                made[level].append(z.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        return made[level]

    def sizes(self, text: str) -> np.ndarray:
        data = normal(text).encode("utf-8", "replace")
        chunks = [data[i : i + self.chunk] for i in range(0, len(data), self.chunk)]
        return np.array([sum(len(f(c)) for c in chunks) for f in self._compressors(self.level)])

    def fine_sizes(self, text: str) -> np.ndarray:
        """Totals of the text, its words and its halves, each after a filler that makes a block shrink anyhow."""
        t = normal(text)
        parts = {t, *t.split(), t[1:], t[:-1], t[: len(t) // 2 + 2], t[max(0, len(t) // 2 - 2) :]}
        data = [FILLER + f" {x} ".encode("utf-8", "replace") for x in parts]
        return np.array([sum(len(f(c)) for c in data) for f in self._compressors(FINE_LEVEL)])

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and relative margin; ``und`` if the text has no letter or nothing was learned."""
        if not text or not self.dictionaries or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(text)
        if (sizes == sizes.min()).sum() > 1:
            sizes = np.where(sizes == sizes.min(), self.fine_sizes(text), np.iinfo(np.int64).max >> 8)
        best = int(sizes.argmin())
        others = np.delete(sizes, best)
        second = int(others.min()) if len(others) else int(sizes[best]) * 2
        margin = (second - int(sizes[best])) / second
        likely = np.exp(-SHARPNESS * (sizes - sizes[best]) / max(1, int(sizes[best])))
        return list(self.dictionaries)[best], float(1 / likely.sum()), margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """All columns of ``docs`` with lang_pred, score, margin and rejected added.

    lang_pred is the best language also where ``rejected`` says that its margin is narrow;
    it is ``und`` with score 0, and rejected, if the text is null or has no letter.  Columns of these
    names are replaced; others stay, whatever their names.  Where even the parts of a text take
    the same room in several languages, the first in order is the best, with an equal share of the score and margin 0.  Only the
    text is read for a prediction.  Repeated rows stay; an empty table stays empty.
    """
    model = docs.sparkSession.sparkContext.broadcast(Classifier(dictionaries))  # a bounded fragment of each language
    keep = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "margin", "rejected")]
    base = docs.select(*map(common.col, keep))
    schema, at = base.schema, keep.index(common.named(keep, "text"))
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("margin", "double"), ("rejected", "boolean")):
        schema = common.with_field(schema, name, kind)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        got = [model.value.predict(t) for t in b.column(at).to_pylist()]
        lang, score, margins = zip(*got, strict=True)
        rejected = [m < margin for m in margins]
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margins, pa.float64()), pa.array(rejected, pa.bool_())], names=[*keep, "lang_pred", "score", "margin", "rejected"])

    return common.map_arrow(base, run, schema)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    held_out = F.coalesce(common.remainder("doc_id", 3) == 1, F.lit(False))
    dictionaries = learn(docs.select("doc_id", "text", "lang").filter(~held_out))
    return identify(docs.select("doc_id", "text"), dictionaries).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")
