"""Phrase collocation mining (12): SON partitioning, then scores of the frequent phrases.

Texts are cut into pieces at punctuation and line ends, pieces into words; a phrase is a run of words within a piece. The
corpus is dealt over ``shards`` by document. A phrase with ``support`` occurrences in a language has, in some shard, at
least that share of them which the shard has of the language's words; so each shard is mined at its support lowered in proportion
(``local_supports``), and no frequent phrase is missed by all. What is frequent somewhere is counted again everywhere, exactly.

A shard does not fit into a task. Tasks turn texts into hashed phrases, pre-aggregate blocks of them and deal packed hashes and
counts by (shard, language, hash range); a group of such blocks is bounded by the number of ranges, which follows the
corpus. Hashes that reach the local support become bits of one filter of fixed size (``filters``), the union of all shards. Equal
hashes, and a filter that is full, only add candidates. The last pass counts the words of each phrase that passes, as text.

Scores are whole numbers, from products in 38 decimal digits.

Defined results: a null text has no words; a null language is ``und``; a null id is an id like others, and repeated rows count
each; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.registry import table
from . import filters
from .frames import stored
from .registry import query
from .shingles import BLOCK, Words, mix, utf8

SUPPORT = 10
LONGEST = 3
FIRST = 2000
#: A candidate goes where a longer one has this percentage of its occurrences.
COVERED = 50
#: Shards of the mining pass: with fewer than ``SUPPORT``, a local support is above one.
SHARDS = 4
#: Bytes of text for a hash range; hashes, and counted phrases, that a task holds before it hands them on.
RANGE_BYTES = 64 << 20
HELD = 1 << 22
HELD_PHRASES = 1 << 19

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

_U = np.uint64
_STEP = _U(0xD6E8FEB86659FD93)


class Runs:
    """The words of a column of texts: places, hashes, and how many words follow each within its piece."""

    def __init__(self):
        self.hasher = Words(PIECE_ENDS + BLANKS)
        self.ends = np.zeros(256, bool)
        self.ends[list(PIECE_ENDS)] = True
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32

    def read(self, column: pa.Array):
        """``data, starts, ends, hashes, text, piece``: the bytes in lower case, and per word its place, hash, text and piece."""
        data, bounds = utf8(column)
        data = self.fold[data]
        parts, at, pieces = [], 0, 0
        while at < len(data):
            to = self._cut(data, bounds, at)
            part = data[at:to]
            inner = bounds[(bounds >= at) & (bounds <= to)] - at
            word = ~self.hasher.sep[part]
            edge = np.zeros(len(part) + 1, bool)
            edge[inner] = True
            starts = np.flatnonzero(word & (np.concatenate(([True], ~word[:-1])) | edge[:-1]))
            ends = np.flatnonzero(word & (np.concatenate((~word[1:], [True])) | edge[1:])) + 1
            hashes, _ = self.hasher.hashes(part, np.array([0, *inner[(inner > 0) & (inner < len(part))], len(part)]))
            closed = np.cumsum(self.ends[part] | edge[:-1])
            parts.append((starts + at, ends + at, hashes, closed[starts] + pieces))
            pieces += int(closed[-1])
            at = to
        if not parts:
            none = np.zeros(0, np.int64)
            return data, none, none, none.astype(np.uint64), none, none
        starts, ends, hashes, piece = (np.concatenate(x) for x in zip(*parts, strict=True))
        return data, starts, ends, hashes, np.searchsorted(bounds, starts, "right") - 1, piece

    def _cut(self, data: np.ndarray, bounds: np.ndarray, at: int) -> int:
        """Where a block from ``at`` ends: at the end of a text or behind a separator, near ``BLOCK`` bytes."""
        if len(data) - at <= BLOCK:
            return len(data)
        k = int(np.searchsorted(bounds, at + BLOCK, "right")) - 1
        if bounds[k] > at:
            return int(bounds[k])
        inside = np.flatnonzero(self.hasher.sep[data[at : at + BLOCK]])
        if len(inside):
            return at + int(inside[-1]) + 1
        further = np.flatnonzero(self.hasher.sep[data[at + BLOCK : bounds[k + 1]]])
        return at + BLOCK + int(further[0]) + 1 if len(further) else int(bounds[k + 1])


def phrase_hashes(seeds: np.ndarray, hashes: np.ndarray, piece: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``size, first word, hash`` of the phrases of each size; ``seeds`` has a number per word that tells languages apart."""
    at = np.arange(len(hashes))
    got = mix(seeds ^ hashes)
    yield 1, at, got
    for size in range(2, longest + 1):
        room = at < len(hashes) - size + 1
        at, got = at[room], got[room]
        inside = piece[at] == piece[at + size - 1]
        at, got = at[inside], got[inside]
        got = mix(got * _STEP + hashes[at + size - 1])
        yield size, at, got


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _prepared(docs: DataFrame, shards: int) -> DataFrame:
    return docs.select(
        F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("shard")), F.lit(shards)).cast("int").alias("shard"),
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("text"),
    )


def word_counts(rows: DataFrame) -> DataFrame:
    """``shard, lang, n, bytes`` of ``rows(shard, lang, text)``."""
    separators = PIECE_ENDS + BLANKS

    def scan(batches):
        sep = np.zeros(256, bool)
        sep[list(separators)] = True
        for b in batches:
            data, bounds = utf8(b.column(2))
            total = np.zeros(len(bounds) - 1, np.int64)
            for k in range(0, len(data), BLOCK):  # a word is counted where it starts
                part = data[max(0, k - 1) : k + BLOCK]
                word = ~sep[part]
                first = np.concatenate(([k == 0 and bool(word[0])], word[1:] & ~word[:-1]))
                edges = bounds[(bounds >= k) & (bounds < min(len(data), k + BLOCK))] - max(0, k - 1)
                first[edges] |= word[edges]
                at = np.flatnonzero(first) + max(0, k - 1)
                total += np.bincount(np.searchsorted(bounds, at, "right") - 1, minlength=len(total))
            yield pa.record_batch(
                [b.column(0), b.column(1), pa.array(total), pa.array(np.diff(bounds))], names=["shard", "lang", "n", "bytes"]
            )

    found = rows.mapInArrow(scan, "shard int, lang string, n long, bytes long")
    return found.groupBy("shard", "lang").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))


def local_supports(counts: DataFrame, support: int) -> DataFrame:
    """``shard, lang, least``: the support of a shard, lowered in proportion to its words of the language and rounded up.

    If a phrase stayed below it in every shard, its occurrences would add up to less than ``support``.
    """
    totals = counts.groupBy("lang").agg(F.sum("n").alias("all"))
    share = F.ceil(F.lit(support).cast("decimal(18,0)") * F.col("n") / F.col("all")).cast("long")
    return counts.where("n > 0").join(totals, "lang").select("shard", "lang", F.greatest(F.lit(1), share).alias("least"))


def mined(rows: DataFrame, supports: DataFrame, ranges: int, longest: int) -> DataFrame:
    """``segment, at``: packed places in the filter, of all phrases that are frequent in some shard of ``rows(shard, lang, text)``."""
    names = ["shard", "lang", "range", "ones", "more", "n"]
    kinds = [pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def blocks(held):
        out = []
        for (shard, lang), parts in held.items():
            codes, n = np.unique(np.concatenate(parts), return_counts=True)
            for r, lo, hi in filters.dealt(codes, ranges):
                c, k = codes[lo:hi].astype(np.uint32), n[lo:hi]
                many = k > 1
                out.append((shard, lang, r, c[~many].tobytes(), c[many].tobytes(), k[many].astype(np.uint32).tobytes()))
        held.clear()
        return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    def scan(batches):
        runs, held, size = Runs(), {}, 0
        for b in batches:
            t = pa.Table.from_batches([b]).sort_by([("shard", "ascending"), ("lang", "ascending")])
            shard, lang = t.column(0).to_pylist(), t.column(1).to_pylist()
            for k, texts in _parts(t):
                _, _, _, hashes, _, piece = runs.read(texts)
                seeds = np.full(len(hashes), _seed(lang[k]), np.uint64)
                for _, _, got in phrase_hashes(seeds, hashes, piece, longest):
                    if len(got):
                        held.setdefault((shard[k], lang[k]), []).append(filters.codes_of(got, ranges))
                        size += len(got)
                if size > HELD:
                    yield blocks(held)
                    size = 0
        if held:
            yield blocks(held)

    def merge(t: pa.Table) -> pa.Table:
        ones, more, n = ([np.frombuffer(x.as_buffer(), np.uint32) for x in t.column(c)] for c in ("ones", "more", "n"))
        codes, counts = filters.counted([(c, np.ones(len(c), np.int64)) for c in ones] + [(c, k.astype(np.int64)) for c, k in zip(more, n, strict=True)])
        return filters.as_places(t.column("range")[0].as_py(), codes[counts >= t.column("least")[0].as_py()])

    dealt = rows.mapInArrow(scan, "shard int, lang string, range int, ones binary, more binary, n binary")
    return dealt.join(supports, ["shard", "lang"]).groupBy("shard", "lang", "range").applyInArrow(merge, "segment int, at binary")


class Tally:
    """Counts of phrases by hash, and the phrases themselves, of a bounded number of them."""

    def __init__(self):
        self.hashes, self.totals, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.langs: list[str] = []
        self.phrases: list[bytes] = []

    def add(self, hashes: np.ndarray, counts: np.ndarray, lang: str, phrase_of) -> None:
        """``hashes`` sorted and distinct; ``phrase_of(k)`` is the text of the k-th."""
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        self.totals[at[known]] += counts[known]
        new = np.flatnonzero(~known)
        self.hashes = np.insert(self.hashes, at[new], hashes[new])
        self.totals = np.insert(self.totals, at[new], counts[new])
        self.place = np.insert(self.place, at[new], np.arange(len(new)) + len(self.phrases))
        self.langs += [lang] * len(new)
        self.phrases += [phrase_of(k) for k in new.tolist()]

    def batch(self) -> pa.RecordBatch:
        totals = np.empty_like(self.totals)
        totals[self.place] = self.totals
        phrases = pa.array(self.phrases, pa.binary()).cast(pa.string())
        return pa.record_batch([pa.array(self.langs, pa.string()), phrases, pa.array(totals)], names=["lang", "phrase", "f"])


def _parts(t: pa.Table) -> Iterator[tuple[int, pa.Array]]:
    """Runs of rows with equal values in all columns but the last: the first row, and their texts in parts of about ``BLOCK`` bytes."""
    keys = list(zip(*(c.to_pylist() for c in t.columns[:-1]), strict=True))
    sizes = t.column(t.num_columns - 1).combine_chunks()
    lengths = np.diff(utf8(sizes)[1])
    lo = 0
    while lo < len(keys):
        hi, size = lo, 0
        while hi < len(keys) and keys[hi] == keys[lo] and (hi == lo or size + lengths[hi] <= BLOCK):
            size += lengths[hi]
            hi += 1
        yield lo, sizes.slice(lo, hi - lo)
        lo = hi


def counted(rows: DataFrame, bits: np.ndarray, ranges: int, longest: int, support: int) -> DataFrame:
    """``lang, phrase, f`` of all phrases that pass the filter and reach ``support``: exact counts, of texts."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def scan(batches):
        runs, bits, tally = Runs(), shared.value, Tally()
        for b in batches:
            t = pa.Table.from_batches([b.select(["lang", "text"])]).sort_by("lang")
            lang = t.column(0).to_pylist()
            for lo, texts in _parts(t):
                data, starts, ends, hashes, _, piece = runs.read(texts)
                text = data.tobytes()
                seeds = np.full(len(hashes), _seed(lang[lo]), np.uint64)
                for size, at, got in phrase_hashes(seeds, hashes, piece, longest):
                    hit = filters.in_filter(bits, filters.codes_of(got, ranges))
                    values, first, n = np.unique(got[hit], return_index=True, return_counts=True)
                    first = at[hit][first]

                    def phrase_of(k, first=first, size=size, text=text, starts=starts, ends=ends):
                        return b" ".join([text[starts[i] : ends[i]] for i in range(first[k], first[k] + size)])

                    tally.add(values, n, lang[lo], phrase_of)
                if len(tally.phrases) > HELD_PHRASES:
                    yield tally.batch()
                    tally = Tally()
        if tally.phrases:
            yield tally.batch()

    found = rows.mapInArrow(scan, "lang string, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= support)


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, f`` of all phrases of ``docs(doc_id, lang, text)`` up to ``longest`` words with ``support`` occurrences
    or more, and ``lang, n``: all words of each language."""
    rows = _prepared(docs, shards)
    counts = stored(word_counts(rows), "phrase-words")
    size = counts.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    ranges = filters.ranges_for(size, RANGE_BYTES)
    bits = filters.union_filter(mined(rows, local_supports(counts, support), ranges, longest))
    found = stored(counted(rows, bits, ranges, longest, support), "phrase-counts")
    return found, counts.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS, covered: int = COVERED
) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the phrases of two words or more that no longer one covers.

    A phrase is scored at its weakest cut: ``floor(1000000 * a * a / (l * r))`` with the counts of the whole and its two parts.
    """
    found, words = frequent_phrases(docs, support, longest, shards)
    parts = F.split("phrase", " ")
    candidates = found.withColumn("w", parts).where(F.size("w") > 1)
    cut = candidates.select("lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cut = cut.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("right"),
    )
    cut = cut.join(found.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cut = cut.join(found.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    big = "decimal(15,0)"
    million = F.lit(1000000).cast("decimal(7,0)")
    cut = cut.withColumn("_over", million * (F.col("a").cast(big) * F.col("a").cast(big)))
    cut = cut.withColumn("_under", F.col("l").cast(big) * F.col("r").cast(big)).withColumn("score", F.expr("_over div _under"))
    weakest = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    scored = weakest.select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    # every run of words of a candidate, with the largest count of a longer one that holds it
    longer = candidates.where(F.size("w") > 2).select("lang", "w", F.col("f"), F.explode(F.sequence(F.lit(2), F.size("w") - 1)).alias("m"))
    longer = longer.select("lang", "w", "f", "m", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("m") + 1)).alias("s"))
    longer = longer.select("lang", F.array_join(F.slice("w", F.col("s"), F.col("m")), " ").alias("phrase"), "f")
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    kept = scored.join(longer, ["lang", "phrase"], "left")
    kept = kept.where(F.col("longest").isNull() | (100 * F.col("longest") < covered * F.col("a"))).drop("longest")
    return kept.join(words, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def top_collocations(docs: DataFrame, first: int = FIRST, **options) -> DataFrame:
    """The ``first`` collocations of each language with ``rank`` from 1: by score, count, and the phrase's bytes."""
    found = stored(collocations(docs, **options), "phrase-scores")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, p.i AS piece, doc, w.w FROM (
    SELECT row_number() OVER () AS doc, lang,
           string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[.,;:!?\\x0A-\\x0D]') AS ps FROM documents) d,
    LATERAL (SELECT unnest(range(1, len(ps) + 1)) AS i) p,
    LATERAL (SELECT list_filter(string_split_regex(ps[p.i], '[\\x20\\x09]+'), lambda x: x <> '') AS w) w
), grams AS (
  SELECT lang, w[i] AS phrase FROM pieces, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i)
  UNION ALL
  SELECT lang, w[i] || ' ' || w[i + 1] FROM pieces, LATERAL (SELECT unnest(range(1, len(w))) AS i)
  UNION ALL
  SELECT lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM pieces, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i)
), f AS (SELECT lang, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
c AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE contains(phrase, ' ')),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM c, LATERAL (SELECT unnest(range(1, len(w))) AS k)
), scored AS (
  SELECT cuts.lang, cuts.phrase, a, x.f AS l, y.f AS r,
         (1000000::HUGEINT * a::HUGEINT * a::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score,
         row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY
           (1000000::HUGEINT * a::HUGEINT * a::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT), k) AS at
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lp JOIN f y ON y.lang = cuts.lang AND y.phrase = rp
), longer AS (
  SELECT lang, part, max(a) AS f FROM (
    SELECT lang, a, w[1] || ' ' || w[2] AS part FROM c WHERE len(w) = 3
    UNION ALL SELECT lang, a, w[2] || ' ' || w[3] FROM c WHERE len(w) = 3) GROUP BY ALL
), kept AS (
  SELECT s.* FROM scored s LEFT JOIN longer g ON g.lang = s.lang AND g.part = s.phrase
  WHERE s.at = 1 AND (g.f IS NULL OR 100 * g.f < 50 * s.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, CAST(n.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op12_phrase_collocations", ORACLE)
def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return top_collocations(table(spark, folder, "documents"))
