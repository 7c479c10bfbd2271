"""Benchmark decontamination (9): size-partitioned MinHash containment search, verified exactly.

Test items are short, documents can be long, so similarity of whole sets says nothing; what counts is the
containment |item & document| / |item| of word shingles. Items are partitioned by the size of their shingle sets.
The signature of an item is its k smallest shingle hashes, with k = n - ceil(c n) + 1 for the largest n of its
partition: a document that holds a share c of an item misses at most n - ceil(c n) of its shingles, hence it holds one
of the k minima at least. Looking up all shingles of a document among the minima therefore loses no match,
however long the document is. Every candidate is verified by counting the item's shingles in the document.

Documents stay where they are: no shuffle of texts and no shuffle of shingles. Items are sent to the tasks in blocks of
at most ``BLOCK_BYTES`` of hashes, one pass over the documents for each block, so a broadcast never outgrows that.

A word is a run of ASCII letters and digits or non-ASCII characters, A-Z lower-cased; an item of fewer words than
the width is matched as its whole sequence of words.

Defined results: null or wordless documents and items match nothing; a null id is returned as null; repeated documents are
judged each; repeated items (equal id and text) count once; empty tables give an empty result or leave all
documents; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import table
from .frames import stored
from .registry import query
from .shingles import ALNUM_WORDS, Words, mix

WIDTH = 5
CONTAINMENT = 0.8
#: Bytes of item hashes that one broadcast may hold.
BLOCK_BYTES = 64 << 20
#: Checksums of leaking texts (a number each) that one broadcast may hold.
LEAKS_SENT = 500_000


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes of all runs of ``width`` words; the width is part of the hash."""
    m = len(words) - width + 1
    if m <= 0:
        return words[:0]
    out = words[:m].copy()
    for j in range(1, width):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + words[j : m + j])
    return np.unique(mix(out ^ np.uint64(width)))


class Items:
    """A block of test items: hashed shingles by item, and the minima that stand for them."""

    def __init__(self, ids: list[int], sets: list[np.ndarray], widths: list[int], containment: float):
        self.ids, self.widths = np.array(ids, np.int64), sorted(set(widths))
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.need = np.ceil(containment * self.sizes - 1e-9).astype(np.int64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        every = np.concatenate(sets)
        order = np.argsort(every, kind="stable")
        self.hashes, self.owner = every[order], owner[order]
        # partitions by size: powers of two; all items of one get the k of the largest
        part = np.ceil(np.log2(np.maximum(self.sizes, 1))).astype(np.int64)
        largest = {p: int(self.sizes[part == p].max()) for p in np.unique(part)}
        k = [largest[p] - int(np.ceil(containment * largest[p] - 1e-9)) + 1 for p in part]
        self.minima = np.unique(np.concatenate([s[:n] for s, n in zip(sets, k, strict=True)]))

    def matches(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, shared shingles, item's shingles) for the items that a document with these words holds."""
        have = [g for w in self.widths if len(g := grams(words, w))]
        if not have:
            return
        have = have[0] if len(have) == 1 else np.unique(np.concatenate(have))
        at = np.searchsorted(self.minima, have)
        at[at == len(self.minima)] = 0
        if not (self.minima[at] == have).any():
            return
        inside = np.isin(self.hashes, have, assume_unique=False)
        shared = np.bincount(self.owner[inside], minlength=len(self.ids))
        for k in np.flatnonzero((shared >= self.need) & (shared > 0)):
            yield int(self.ids[k]), int(shared[k]), int(self.sizes[k])


def item_blocks(benchmark: DataFrame, width: int, containment: float, block_bytes: int) -> Iterator[Items]:
    """Hash items in order of id, cut into blocks; rows come to the driver one partition at a time."""
    words, seen = Words(ALNUM_WORDS), set()
    ids, sets, widths, held = [], [], [], 0
    for row in benchmark.select("item_id", "text").where("item_id is not null").toLocalIterator():
        w = next(words.texts(pa.array([row["text"]], pa.string())))
        if not len(w):
            continue
        own = min(width, len(w))
        s = grams(w, own)
        key = (row["item_id"], s.tobytes())
        if held and held + 24 * len(s) > block_bytes:
            yield Items(ids, sets, widths, containment)
            ids, sets, widths, held, seen = [], [], [], 0, set()
        if key not in seen:
            seen.add(key)
            ids.append(row["item_id"])
            sets.append(s)
            widths.append(own)
            held += 24 * len(s)
    if ids:
        yield Items(ids, sets, widths, containment)


def contained_items(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, containment: float = CONTAINMENT, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, item_id, n_shared, n_item, containment`` for every document and item at or above ``containment``."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, n_shared long, n_item long"
    found = None
    for block in item_blocks(benchmark, width, containment, block_bytes):
        sent = spark.sparkContext.broadcast(block)

        def scan(batches, sent=sent):
            words = Words(ALNUM_WORDS)
            for b in batches:
                ids, rows = b.column(0).to_pylist(), []
                for doc, w in zip(ids, words.texts(b.column(1)), strict=True):
                    rows += [(doc, *m) for m in sent.value.matches(w)]
                cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
                yield pa.record_batch(
                    [pa.array(c, pa.int64()) for c in cols], names=["doc_id", "item_id", "n_shared", "n_item"]
                )

        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.limit(0).select(*[F.lit(None).cast("long").alias(c) for c in ("doc_id", "item_id", "n_shared", "n_item")])
    return found.withColumn("containment", F.round(F.col("n_shared") / F.col("n_item"), 9))


ORACLE = f"""
WITH toks AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-/:-@\\[-`{{-\\x7f]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-/:-@\\[-`{{-\\x7f]+') FROM benchmark),
items AS (SELECT id, w, least(len(w), {WIDTH}) AS width FROM toks WHERE kind = 'b' AND len(w) > 0),
ig AS (SELECT DISTINCT id, width, unnest(list_transform(range(1, len(w) - width + 2), lambda i: array_to_string(w[i:i + width - 1], ' '))) AS g FROM items),
n AS (SELECT id, count(*) AS n_item FROM ig GROUP BY id),
widths AS (SELECT DISTINCT width FROM items),
dg AS (SELECT DISTINCT id, width, unnest(list_transform(range(1, len(w) - width + 2), lambda i: array_to_string(w[i:i + width - 1], ' '))) AS g
       FROM toks, widths WHERE kind = 'd' AND len(w) >= width)
SELECT dg.id AS doc_id, ig.id AS item_id, count(*) AS n_shared, any_value(n_item) AS n_item, round(count(*) / any_value(n_item), 9) AS containment
FROM dg JOIN ig USING (width, g) JOIN n ON n.id = ig.id
GROUP BY 1, 2 HAVING count(*) >= ceil({CONTAINMENT} * any_value(n_item) - 1e-9)
"""


@query("op9_decontaminate", ORACLE)
def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, containment: float = CONTAINMENT, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns.

    Rows are judged by their text: the scan gives the SHA-256 of the texts that hold an item, and their CRC-32. These are written and counted.
    Up to ``LEAKS_SENT`` checksums are broadcast, as numbers, since the driver builds what is broadcast: texts with another checksum
    are clean and stay where they are, the few others are joined by their digest. More are joined by digest at once, as Spark plans it. No ids
    are compared, so repeated and null ids do not matter.
    """
    spark, found = docs.sparkSession, None
    for block in item_blocks(benchmark, width, containment, block_bytes):
        sent = spark.sparkContext.broadcast(block)

        def scan(batches, sent=sent):
            words = Words(ALNUM_WORDS)
            for b in batches:
                texts = b.column(0).cast(pa.binary())
                held = [k for k, w in enumerate(words.texts(b.column(0))) if next(sent.value.matches(w), None) is not None]
                held = [texts[k].as_py() for k in held]
                yield pa.record_batch(
                    [pa.array([sha256(t).hexdigest() for t in held], pa.string()), pa.array([crc32(t) for t in held], pa.int64())],
                    names=["_leak", "_sum"],
                )

        part = docs.select("text").mapInArrow(scan, "_leak string, _sum long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs
    leaks = stored(found.distinct(), "leaking-texts")

    def without(rows):
        return rows.join(leaks, F.sha2(rows["text"], 256) == leaks["_leak"], "left_anti")

    if leaks.count() > LEAKS_SENT:
        return without(docs)
    sums = F.broadcast(leaks.select("_sum").distinct())
    equal = F.crc32(docs["text"].cast("binary")) == sums["_sum"]
    return docs.join(sums, equal, "left_anti").union(without(docs.join(sums, equal, "left_semi")))
