"""Language identification (2) by compression with one raw-content dictionary per language.

Labelled texts of a language are its dictionary (zstandard raw content). Texts and dictionaries are lower-cased and everything
between letters becomes one space, as capitals, digits and punctuation tell no language apart. A text is cut into blocks of ``BLOCK`` bytes,
each block is compressed with each dictionary, and the language with the smallest total wins; the score is the
relative distance of the second smallest total. Cutting keeps the text itself from becoming the better
dictionary, so the margin does not fade with length. A prediction is rejected when the margin is below ``MARGIN``.

Fitting takes a bounded sample, ``SAMPLE_DOCS`` documents of a language in hash order and at most ``SAMPLE_CHARS`` characters
from the middle of each; the dictionaries (``languages x SAMPLE_DOCS x SAMPLE_CHARS`` at most) are broadcast.
Prediction reads every whole text, once, without a shuffle.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected; without any labelled
text everything is ``und``; ties go to the language that sorts first; with one language only the score is 0 and
nothing is rejected for its margin; null ids are predicted like others and never used for fitting; repeated rows are
predicted each; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.registry import table
from .frames import stored
from .registry import query

SAMPLE_DOCS = 96
SAMPLE_CHARS = 4096
BLOCK = 16 << 10
LEVEL = 3
#: Least relative distance between the best and the second language.
MARGIN = 0.005
FOLDS, HELD_OUT = 3, 1

_BETWEEN = re.compile(r"[\W\d_]+")


def held_out(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT


def dictionaries(docs: DataFrame) -> dict[str, bytes]:
    """Raw-content dictionary per language, from labelled documents outside the held-out fold."""
    usable = docs.where("lang is not null and doc_id is not null and text is not null").where(~held_out())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        usable.select("lang", "doc_id")
        .withColumn("_rank", F.row_number().over(order))  # limited per group before the shuffle
        .where(F.col("_rank") <= SAMPLE_DOCS)
    )
    chosen = stored(chosen.select(F.col("lang").alias("_lang"), F.col("doc_id").alias("_id")).distinct(), "lang-sample")
    texts = usable.join(F.broadcast(chosen), (usable["doc_id"] == chosen["_id"]) & (usable["lang"] == chosen["_lang"]))
    start = F.greatest(F.lit(1), ((F.length("text") - SAMPLE_CHARS) / 2).cast("int"))
    texts = texts.select("lang", "doc_id", F.substring("text", start, F.lit(SAMPLE_CHARS)).alias("part"))
    parts: dict[str, list[tuple[int, str]]] = {}
    for row in texts.collect():  # languages x SAMPLE_DOCS parts of bounded length
        parts.setdefault(row["lang"], []).append((row["doc_id"], row["part"]))
    return {lang: letters("\n".join(t for _, t in sorted(p))).encode() for lang, p in sorted(parts.items())}


def letters(text: str) -> str:
    return _BETWEEN.sub(" ", text.lower())


class Classifier:
    """Compressors for every language, made once per task."""

    def __init__(self, contents: dict[str, bytes], block: int = BLOCK, level: int = LEVEL):
        self.block, self.packers = block, []
        for lang, content in contents.items():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            packer = zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False)
            self.packers.append((lang, packer))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and margin; ``und`` and 0 without a letter."""
        if not text or not self.packers or not any(map(str.isalpha, text)):
            return "und", 0.0
        data = letters(text).encode()
        blocks = [data[k : k + self.block] for k in range(0, len(data), self.block)]
        totals = sorted((sum(len(p.compress(b)) for b in blocks), lang) for lang, p in self.packers)
        best = totals[0]
        second = totals[1] if len(totals) > 1 else best
        return best[1], (second[0] - best[0]) / second[0]


def identify(docs: DataFrame, contents: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred, score, rejected`` instead of any columns of these names."""
    sent = docs.sparkSession.sparkContext.broadcast(contents)
    added = ("lang_pred", "score", "rejected")
    names = [c for c in docs.columns if c.lower() not in added]
    at, several = [c.lower() for c in names].index("text"), len(contents) > 1
    # numbered names, so that dots or quotes in other columns' names do no harm
    rows = docs.drop(*added).toDF(*[f"c{k}" for k in range(len(names))])

    def scan(batches):
        own = Classifier(sent.value)
        for b in batches:
            got = [own.predict(t.as_py()) for t in b.column(at)]
            langs, scores = [g[0] for g in got], [g[1] for g in got]
            bad = [lang == "und" or (several and s < margin) for lang, s in got]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(bad, pa.bool_())],
                names=[*b.schema.names, *added],
            )

    kinds = [T.StructField(n, t) for n, t in zip(added, (T.StringType(), T.DoubleType(), T.BooleanType()), strict=True)]
    return rows.mapInArrow(scan, T.StructType([*rows.schema.fields, *kinds])).toDF(*names, *added)


@query("op2_language_id")
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    got = identify(docs.select("doc_id", "text"), dictionaries(docs))
    return got.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
