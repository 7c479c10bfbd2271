"""URL filters (3): fixed host and path rules, then a character language-model ratio.

Two variable-order Markov models over characters are fitted, one on the URLs that the rules allow and one on those they block.
A character's probability is interpolated over contexts of 0 to ``ORDER`` characters with Witten-Bell weights: a context that was
seen with many different successors trusts the shorter one more. The score of a URL is the difference of its
log-likelihoods (allowed minus blocked) per character, of host and path together; it is allowed if the score reaches a
threshold. The threshold is calibrated on labelled URLs that the models have not seen (one fold of ``FOLDS`` by hash):
it maximises the balanced accuracy there.

Characters are mapped to ``SYMBOLS`` symbols (letters by themselves, digits as one), so a model is a dense table of
``SYMBOLS ** (ORDER + 1)`` numbers whatever the input; counts of all URLs are taken per task, summed
by key, and only non-zero table entries reach the driver. The table of differences is broadcast (10 MB).

Defined results: a null URL, or one without ``://``, has empty host and path, no rule, score 0 and is judged by the threshold;
without labelled URLs of both verdicts the threshold is 0 and a class without URLs is uniform; a score equal to the threshold is
allowed; repeated rows and null ids are judged each; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import table
from .frames import stored
from .registry import query
from .shingles import utf8

ORDER = 3
FOLDS = 5
#: Score histogram for the calibration: bins between -SPAN and SPAN nats per character.
SPAN, BINS = 8.0, 4000

#: (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

_SIGNS = "./?#=&-_:%+~@,"
SYMBOLS = 2 + 26 + 1 + len(_SIGNS)  # start or end, any other, letters, digits, signs


def _symbol_table() -> np.ndarray:
    out = np.ones(256, np.int64)
    for k in range(26):
        out[ord("a") + k] = out[ord("A") + k] = 2 + k
    out[48:58] = 28
    for k, c in enumerate(_SIGNS):
        out[ord(c)] = 29 + k
    return out


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # later, longer ones come first in the chain
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def codes(column: pa.Array, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The table index of every character (context and character) of all texts, and the bounds of texts in it.

    Each text is read as ``order`` start signs, its characters and an end sign.
    """
    data, bounds = utf8(column)
    n = len(bounds) - 1
    pad = order + 1
    symbols = np.zeros(len(data) + n * pad + order, np.int64)
    place = np.arange(len(data)) + np.repeat(np.arange(1, n + 1) * pad - 1, np.diff(bounds))
    symbols[place] = _symbol_table()[data]
    # text k starts at bounds[k] + k * pad with `order` start signs; one end sign follows it
    code = np.zeros(len(data) + n * pad, np.int64)
    for j in range(order + 1):
        code = code * SYMBOLS + symbols[j : j + len(code)]
    # positions whose last symbol is a character or the end sign: drop the rest of the padding
    starts = bounds[:-1] + np.arange(n) * pad
    keep = np.ones(len(code), bool)
    for j in range(order):
        keep[starts + np.diff(bounds) + 1 + j] = False
    return code[keep], bounds + np.arange(n + 1)


def counted(labelled: DataFrame) -> pd.DataFrame:
    """class, code, n over ``labelled(url text, class)``: sums per task, then per key."""

    def scan(batches):
        size = SYMBOLS ** (ORDER + 1)
        total = [np.zeros(size, np.int64), np.zeros(size, np.int64)]
        for b in batches:
            code, bounds = codes(b.column(0))
            label = np.repeat(b.column(1).to_numpy(), np.diff(bounds))
            for k in (0, 1):
                total[k] += np.bincount(code[label == k], minlength=size)
        for k in (0, 1):
            at = np.flatnonzero(total[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, np.int32)), pa.array(at), pa.array(total[k][at])], names=["class", "code", "n"]
            )

    sums = labelled.mapInArrow(scan, "class int, code long, n long").groupBy("class", "code").agg(F.sum("n").alias("n"))
    return sums.toPandas()  # 2 * SYMBOLS ** (ORDER + 1) rows at most, far fewer in practice


def model(counts: np.ndarray) -> np.ndarray:
    """log P(character | context of ORDER characters) as a dense table, Witten-Bell interpolated."""
    prob = np.full(SYMBOLS, 1.0 / SYMBOLS)
    full = counts.reshape((SYMBOLS,) * (ORDER + 1)).astype(np.float64)
    for order in range(ORDER + 1):
        seen = full.sum(axis=tuple(range(ORDER - order))) if order < ORDER else full
        total = seen.sum(axis=-1, keepdims=True)
        kinds = (seen > 0).sum(axis=-1, keepdims=True)
        weight = np.where(total > 0, total / np.maximum(total + kinds, 1), 0.0)
        with np.errstate(invalid="ignore", divide="ignore"):
            own = np.where(total > 0, seen / np.maximum(total, 1), 0.0)
        prob = weight * own + (1 - weight) * prob
    return np.log(prob).reshape(-1).astype(np.float32)


def scored(urls: DataFrame, table_of_differences: np.ndarray) -> DataFrame:
    """``urls(page_id, text, ...)`` with ``score``: log-likelihood difference per character."""
    sent = urls.sparkSession.sparkContext.broadcast(table_of_differences)

    def scan(batches):
        for b in batches:
            code, bounds = codes(b.column(1))
            sums = np.add.reduceat(sent.value[code].astype(np.float64), bounds[:-1]) if len(code) else np.zeros(0)
            score = np.where(np.diff(bounds) > 1, sums / np.diff(bounds), 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], names=[*b.schema.names, "score"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in urls.schema) + ", score double"
    return urls.mapInArrow(scan, schema)


def threshold_of(histogram: list[tuple[int, int, int]]) -> float:
    """The bin edge with the best balanced accuracy; ``histogram`` holds (class, bin, count), class 1 is allowed."""
    bins = np.zeros((2, BINS))
    for k, b, n in histogram:
        bins[k, b] += n
    if not bins[0].sum() or not bins[1].sum():
        return 0.0
    below = np.concatenate((np.zeros((2, 1)), np.cumsum(bins, axis=1)), axis=1) / bins.sum(axis=1, keepdims=True)
    gain = below[0] - below[1]
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float((best[len(best) // 2]) * 2 * SPAN / BINS - SPAN)


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row of ``pages(page_id, url)``."""
    named = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    text = F.concat("host", "path")
    fold = F.pmod(F.xxhash64("host", "path"), F.lit(FOLDS)).cast("int")
    rows = named.select("page_id", text.alias("text"), "host", "path", name.alias("rule"), verdict.alias("ruled"), fold.alias("fold"))
    rows = stored(rows, "url-rows")
    label = (F.col("ruled") == "allow").cast("int").alias("label")
    known = rows.where("ruled is not null")
    counts = np.zeros((2, SYMBOLS ** (ORDER + 1)), np.int64)
    sums = counted(known.where("fold > 0").select("text", label))
    counts[sums["class"], sums["code"]] = sums["n"]
    difference = model(counts[1]) - model(counts[0])
    seen = scored(known.where("fold = 0").select("page_id", "text", label), difference)
    bin_of = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((F.col("score") + SPAN) * (BINS / (2 * SPAN))))).cast("int")
    threshold = threshold_of([tuple(r) for r in seen.groupBy("label", bin_of.alias("bin")).count().collect()])  # 2 * BINS rows
    out = scored(rows.select("page_id", "text", "host", "path", "rule", "ruled"), difference)
    by_model = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score")


@query("op3_url_filter")
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judged(table(spark, folder, "pages"))
