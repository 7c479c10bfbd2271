"""Quality rules (13): counts that fail a text at once, then a hashed n-gram likelihood ratio with a fixed threshold.

Words and pairs of neighbouring words are hashed into ``BUCKETS`` buckets. Two multinomials over the buckets are counted, one over all
documents and one over trusted ones, both smoothed by one. A document's score is the mean over its words and pairs of the
logarithm of trusted over raw probability, in whole millionths, so that sums are exact and every run decides alike. Each
document is kept or not by one threshold: the score that ``LOST`` of a thousand trusted documents outside the fit stay below.

Everything is expressions over one row: no document is exploded but for counting, and the judging scan has no shuffle. The ratios, ``BUCKETS``
whole numbers, the threshold and ``BITS`` bits are all that passes through the driver; their size does not depend on the corpus.

A trusted document has labels that all say quality 1 and toxic 0. Those whose ``crc32(doc_id) % 3`` is not 1 fit the target, the others
the threshold; all of them are used. Their ids are never sent whole to a task: they set the bits of one filter of fixed size, texts that pass it are
joined with the ids by a shuffle, and a full filter only moves more texts. Where none is trusted there is no model: the counts alone decide.

Defined results: a null text has no words and fails; a text without words has a null score; null ids are judged like others and
never trusted; repeated rows are judged each; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import table
from .frames import release, stored
from .registry import query

BUCKETS = 1 << 16
#: Trusted documents of a thousand that the threshold may lose.
LOST = 5
#: Bits of the filter that tells most texts of other documents before the shuffle.
BITS = 1 << 26
#: Millionths that one step of the threshold has.
STEP = 1000
LEAST_WORDS = 10
WINDOW = 5
#: Highest percentage of words in repeated windows.
REPEATED = 20
FOLDS, HELD_OUT = 3, 1
SYMBOLS = "#*$%&|<>"
BLANKS = "[\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Model:
    """Logarithms of the ratio per bucket, in millionths, and the least score that is kept; empty without trusted documents."""

    ratios: list[int]
    threshold: int | None


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def ngrams(codes: Column) -> Column:
    """Buckets of the words and of the pairs of neighbours, from the words' checksums."""
    rest = F.greatest(F.size(codes) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(codes, F.lit(1), rest), F.slice(codes, F.lit(2), rest), lambda a, b: (a * 1000003 + b) % BUCKETS)
    return F.concat(F.transform(codes, lambda c: c % BUCKETS), pairs)


def hashed(docs: DataFrame, *also: str) -> DataFrame:
    """``grams``, the buckets of every row of ``docs(text)``, with the columns ``also``."""
    codes = docs.select(F.transform(words(F.col("text")), lambda w: F.crc32(w.cast("binary"))).alias("codes"), *also)
    return codes.select(ngrams(F.col("codes")).alias("grams"), *also)


def place(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary"))


def trusted_ids(labels: DataFrame, most: int | None = None) -> DataFrame:
    """``doc_id, held`` of documents whose labels all say quality 1 and toxic 0; with ``most``, that many in the order of their checksums."""
    good = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    ids = labels.where("doc_id is not null").groupBy("doc_id").agg(F.bool_and(good).alias("good")).where("good")
    if most is not None:
        ids = ids.orderBy(place(F.col("doc_id")), "doc_id").limit(most)
    return ids.select("doc_id", (place(F.col("doc_id")) % FOLDS == HELD_OUT).alias("held"))


def sieved(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs(doc_id, text)`` whose place has its bit set by ``ids(doc_id)``: all rows with such an id, and a few others."""
    at = place(F.col("doc_id")) % BITS
    part, bit = F.bitmap_bucket_number(at).alias("part"), F.bitmap_bit_position(at).alias("bit")
    # by part first: a partial bitmap is as large as a whole one
    bits = ids.select(part, bit).repartition("part").groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    rows = docs.select("doc_id", "text", part, bit).join(F.broadcast(bits), "part")
    return rows.where(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1).select("doc_id", "text")


def fit(docs: DataFrame, trusted: DataFrame, lost: int = LOST) -> Model:
    """The model of ``docs(doc_id, text)`` with ``trusted(doc_id, held)`` as target."""
    docs = docs.select("doc_id", "text")
    trusted = stored(trusted, "quality-trusted")
    # never broadcast: the ids grow with the corpus
    targets = stored(hashed(sieved(docs, trusted).join(trusted.hint("merge"), "doc_id"), "held"), "quality-targets")

    def counts(grams: DataFrame, name: str) -> DataFrame:
        # outer, else the planner hashes every text once more to filter those without words
        return grams.select(F.explode_outer("grams").alias("bucket")).where("bucket is not null").groupBy("bucket").agg(F.count(F.lit(1)).alias(name))

    both = docs.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket"))
    both = both.join(counts(hashed(docs), "raw"), "bucket", "left").join(counts(targets.where("not held"), "good"), "bucket", "left").fillna(0)
    both = stored(both, "quality-counts")
    n_raw, n_good = both.agg(F.sum("raw"), F.sum("good")).first()
    if not n_good:
        release(targets)
        return Model([], None)
    ratio = F.log((F.col("good") + 1) / F.lit(float(n_good + BUCKETS))) - F.log((F.col("raw") + 1) / F.lit(float(n_raw + BUCKETS)))
    ratios = both.select("bucket", F.floor(ratio * 1000000 + 0.5).cast("int").alias("ratio"))
    model = Model([r["ratio"] for r in sorted(ratios.collect())], None)  # BUCKETS rows
    scores = targets.where("held").select(mean_ratio(F.col("grams"), model).alias("score"))
    steps = scores.groupBy(F.floor(F.col("score") / STEP).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    found = sorted((r["step"], r["n"]) for r in steps.collect() if r["step"] is not None)  # at most the span of the ratios over STEP
    release(targets)
    total, below = sum(n for _, n in found), 0
    for step, n in found:
        below += n
        if 1000 * below > lost * total:
            return Model(model.ratios, step * STEP)
    return model


def mean_ratio(grams: Column, model: Model) -> Column:
    if not model.ratios:
        return F.lit(None).cast("long")
    ratios = F.split(F.lit(",".join(map(str, model.ratios))), ",").cast("array<int>")  # folded to one constant by the planner
    total = F.aggregate(grams, F.lit(0).cast("long"), lambda s, g: s + F.get(ratios, g.cast("int")))
    return F.when(F.size(grams) > 0, F.floor(total.cast("double") / F.size(grams)))


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``score`` and ``kept`` of every row of ``docs(doc_id, text)``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    d = docs.select("doc_id", words(text).alias("w"), lines.alias("lines"), (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("sym"))
    n, last = F.size("w"), F.size("w") - WINDOW
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]))
    d = d.select(
        "doc_id", "w", "sym",
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("dup"),
        F.transform("w", lambda x: F.crc32(x.cast("binary"))).alias("codes"),
        F.when(n >= WINDOW, windows).alias("h"),
    )
    # sorted windows, where some are equal: most texts have none and skip this
    some = F.size(F.array_distinct("h")) < F.size("h")
    placed = F.array_sort(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.select("doc_id", "w", "sym", "dup", ngrams(F.col("codes")).alias("grams"), F.when(some, placed).alias("s"))

    def twin(e, other):
        """Whether the neighbour in the sorted windows has the same words."""
        same = F.slice("w", e["i"] + 1, F.lit(WINDOW)) == F.slice("w", other["i"] + 1, F.lit(WINDOW))
        return F.coalesce((e["h"] == other["h"]) & same, F.lit(False))

    twice = F.transform("s", lambda e, k: F.when(twin(e, F.get("s", k - 1)) | twin(e, F.get("s", k + 1)), e["i"]))
    d = d.withColumn("at", F.sort_array(F.filter(twice, lambda i: i.isNotNull())))
    step = lambda a, i: F.struct(
        (a["n"] + i + WINDOW - F.greatest(i, a["end"])).cast("long").alias("n"), (i + WINDOW).cast("long").alias("end")
    )
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    covered = F.coalesce(F.aggregate("at", start, step, lambda a: a["n"]), F.lit(0))
    d = d.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.col("sym").cast("long").alias("n_symbols"),
        F.col("dup").cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        mean_ratio(F.col("grams"), model).alias("score"),
    )
    d = d.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words")))
    enough = F.lit(True) if model.threshold is None else F.coalesce(F.col("score") >= model.threshold, F.lit(False))
    return d.withColumn("kept", ~F.col("base_failed") & enough)


ORACLE = """
WITH crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM range(256) r(i)
), docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), tokens AS (SELECT rid, i, w[i] AS word FROM docs, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i)),
vocabulary AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM tokens),
codes AS (
  SELECT word, xor(list_reduce(list_transform(range(1, len(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)),
                               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS code
  FROM vocabulary, crc
), coded AS (SELECT rid, i, code, lead(code) OVER (PARTITION BY rid ORDER BY i) AS next FROM tokens JOIN codes USING (word)),
grams AS (
  SELECT rid, code % 65536 AS bucket FROM coded
  UNION ALL SELECT rid, (code * 1000003 + next) % 65536 FROM coded WHERE next IS NOT NULL
), known AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
  HAVING bool_and(coalesce(quality = 1 AND toxic = 0, false))
), places AS (
  SELECT doc_id, xor(list_reduce(list_transform(range(1, len(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)),
                     lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS place
  FROM (SELECT doc_id, hex(encode(CAST(doc_id AS VARCHAR))) AS h FROM known), crc
), folds AS (SELECT doc_id, place % 3 = 1 AS held FROM places ORDER BY place, doc_id LIMIT 20000), raw AS (SELECT bucket, count(*) AS n FROM grams GROUP BY bucket),
good AS (SELECT bucket, count(*) AS n FROM grams JOIN docs USING (rid) JOIN folds USING (doc_id) WHERE NOT held GROUP BY bucket),
ratios AS (
  SELECT b.range AS bucket, CAST(floor((ln((coalesce(good.n, 0) + 1) / CAST((SELECT sum(n) FROM good) + 65536 AS DOUBLE))
         - ln((coalesce(raw.n, 0) + 1) / CAST((SELECT sum(n) FROM raw) + 65536 AS DOUBLE))) * 1000000 + 0.5) AS BIGINT) AS ratio
  FROM range(65536) b LEFT JOIN good ON good.bucket = b.range LEFT JOIN raw ON raw.bucket = b.range
), scores AS (
  SELECT rid, CAST(floor(CAST(sum(ratio) AS DOUBLE) / count(*)) AS BIGINT) AS score FROM grams JOIN ratios USING (bucket) GROUP BY rid
), steps AS (
  SELECT CAST(floor(score / 1000.0) AS BIGINT) AS step, count(*) AS n
  FROM scores JOIN docs USING (rid) JOIN folds USING (doc_id) WHERE held GROUP BY 1
), threshold AS (
  SELECT min(step) * 1000 AS least FROM (SELECT step, sum(n) OVER (ORDER BY step) AS below, sum(n) OVER () AS n FROM steps) WHERE 1000 * below > 5 * n
), windows AS (
  SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS x FROM docs, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i)
), twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, x) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(5) r(k) GROUP BY rid),
counts AS (
  SELECT rid, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
         len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
         - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS n_dup_lines
  FROM docs
), judged AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, score,
         n_words < 10 OR 100 * coalesce(covered.n, 0) > 20 * n_words AS base_failed
  FROM counts LEFT JOIN covered USING (rid) LEFT JOIN scores USING (rid)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, score, base_failed,
       NOT base_failed AND coalesce(score >= (SELECT least FROM threshold), (SELECT least FROM threshold) IS NULL) AS kept
FROM judged
"""


@query("op13_quality_rules", ORACLE)
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return judged(docs, fit(docs, trusted_ids(table(spark, folder, "labels"))))
