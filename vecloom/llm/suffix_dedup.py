"""Suffix-array dedup (5): passages repeated from an earlier document are removed, the first copy stays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id. That is decided by
longest-previous-factor values in suffix order: among the suffixes that share their first ``LENGTH`` bytes, one has an
earlier match exactly if a suffix next to it, before or after, belongs to a smaller document.

A suffix order of the corpus in one place cannot be had, so equal strings are first brought together:

1. Copies. Whole texts are grouped by SHA-256; a later copy is removed whole and takes no further part.
2. Anchors. Every window of ``LENGTH`` bytes is anchored at its minimal hashed ``GRAM``-byte string; equal windows have equal
   anchors. Anchor hashes (about one for sixteen bytes) are dealt over buckets as packed arrays; a bucket
   tells each document which of its anchors occur in another text as well.
3. Order. Around those anchors only, documents send contexts, the bytes of all windows of an anchor, to the
   anchor's bucket. A batch sends each distinct context once, for its smallest document: a later document of the batch
   has its earlier match already. The bucket sorts the windows of its distinct contexts in suffix order, equal ones by
   document, and marks windows whose predecessor in the run of equal ones is a smaller document's. (A 64-bit
   hash drops windows without any equal before the sort; order and equality are decided by the bytes.)
4. Removal. Marked intervals go back to their documents, where they are merged and cut out.

Buckets grow in number with the input (``BUCKET_BYTES`` of text each, at least one per shuffle partition). Passages that very many documents
share cost one row per batch, not per document. Long texts are handled in blocks that overlap by ``LENGTH`` - 1 bytes.
Nothing is sampled: every window of every text is judged.

Defined results: a null text is empty; texts shorter than ``LENGTH`` lose nothing; rows of one id do not remove each other's
passages; a row with a null id loses nothing and removes nothing; repeated rows each get the row's result; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import table
from .frames import group_totals, partitions, stored
from .registry import query
from .shingles import mix, utf8

LENGTH = 50
GRAM = 20
BUCKET_BYTES = 16 << 20
BLOCK = 1 << 20

_U = np.uint64
_BASE = 0xA0761D6478BD642F | 1


class Anchors:
    """Windows of ``LENGTH`` bytes and their anchors, by block."""

    def __init__(self):
        size = BLOCK + 2 * LENGTH
        self.power, self.inverse = (
            np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, b, np.uint64))), dtype=np.uint64)
            for b in (_BASE, pow(_BASE, -1, 1 << 64))
        )
        self.value = mix((np.arange(256, dtype=np.uint64) + _U(1)) * _U(_BASE))

    def grams(self, data: np.ndarray, width: int) -> np.ndarray:
        n = len(data)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.value[data] * self.power[:n], out=total[1:])
        return mix((total[width:] - total[: n - width + 1]) * self.inverse[: n - width + 1])

    def runs(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """Maximal runs of windows with one anchor: part, start in ``data``, windows, anchor hash."""
        n = len(data) - LENGTH + 1
        if n <= 0:
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
        low, span, width = self.grams(data, GRAM), 1, LENGTH - GRAM + 1
        while 2 * span <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        low = np.minimum(low[:n], low[width - span : width - span + n])
        part = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
        whole = np.arange(LENGTH, n + LENGTH) <= bounds[1:][part]
        same = np.zeros(n, bool)
        same[1:] = (low[1:] == low[:-1]) & (part[1:] == part[:-1]) & whole[:-1] & whole[1:]
        starts = np.flatnonzero(whole & ~same)
        ends = np.flatnonzero(whole & ~np.append(same[1:], False)) + 1
        return part[starts], starts, ends - starts, low[starts]

    def texts(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Blocks of a batch: document (place in the batch), start in ``data``, windows, anchor hash."""
        k, last = 0, len(bounds) - 1
        while k < last:
            if bounds[k + 1] - bounds[k] > BLOCK:
                for a in range(bounds[k], bounds[k + 1] - LENGTH + 1, BLOCK):
                    piece = data[a : min(a + BLOCK + LENGTH - 1, bounds[k + 1])]
                    _, start, n, h = self.runs(piece, np.array([0, len(piece)]))
                    yield np.full(len(start), k), start + a, n, h
                k += 1
                continue
            to = max(k + 1, int(np.searchsorted(bounds, bounds[k] + BLOCK, "right")) - 1)
            part, start, n, h = self.runs(data[bounds[k] : bounds[to]], bounds[k : to + 1] - bounds[k])
            yield part + k, start + bounds[k], n, h
            k = to


def binaries(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """A binary column of the slices of ``values`` between ``cuts``."""
    values = np.ascontiguousarray(values)
    offsets = (cuts * values.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def numbers(column: pa.ChunkedArray | pa.Array, kind) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), kind) for v in column]


def _by_key(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys, and the cuts between different keys in that order (with both ends)."""
    order = np.lexsort(keys[::-1])
    change = np.zeros(max(0, len(order) - 1), bool)
    for key in keys:
        k = key[order]
        change |= k[1:] != k[:-1]
    return order, np.concatenate(([0], np.flatnonzero(change) + 1, [len(order)])) if len(order) else np.zeros(1, np.int64)


def bucket_code(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each hash, and 32 further bits of it.

    A bucket holds about a million anchors whatever the input's size, so one in some thousands shares its 32 bits with another
    one; that only lets a few contexts more be compared.
    """
    return (hashes % _U(buckets)).astype(np.int64), ((hashes // _U(buckets)) & _U(0xFFFFFFFF)).astype(np.uint32)


def grouped_rows(ids: np.ndarray, kinds: np.ndarray, values: np.ndarray, groups: int) -> pa.Table:
    """One row for each group of documents: ``grp, ids, kinds, values``, packed; ``values`` has a row per entry."""
    grp = (mix(ids.astype(np.uint64) + _U(1)) % _U(groups)).astype(np.int32)
    order, cuts = _by_key(grp)
    first = order[cuts[:-1]] if len(order) else order
    width = values.shape[1] if values.ndim > 1 else 1
    flat = np.ascontiguousarray(values[order]).reshape(-1)
    return pa.table(
        [pa.array(grp[first]), binaries(ids[order], cuts), binaries(kinds[order], cuts), binaries(flat, cuts * width)],
        names=["grp", "ids", "kinds", "values"],
    )


def by_document(rows: DataFrame, name: str, width: int) -> DataFrame:
    """``doc_id, kind, <name>`` from grouped rows: all packed values of a document in one row."""

    def collect(t: pa.Table) -> pa.Table:
        ids, kinds, values = (np.concatenate(numbers(t[c], np.int64)) for c in ("ids", "kinds", "values"))
        order, cuts = _by_key(ids, kinds)
        first = order[cuts[:-1]] if len(order) else order
        flat = np.ascontiguousarray(values.reshape(-1, width)[order]).reshape(-1)
        return pa.table([pa.array(ids[first]), pa.array(kinds[first]), binaries(flat, cuts * width)], names=["doc_id", "kind", name])

    return rows.groupBy("grp").applyInArrow(collect, f"doc_id long, kind long, {name} binary")


GROUPED = "grp int, ids binary, kinds binary, values binary"


def anchor_rows(texts: DataFrame, buckets: int) -> DataFrame:
    """``texts(doc_id, kind, text)`` -> per batch and bucket: anchor hashes, their documents, ids and kinds of those."""

    def scan(batches):
        anchors = Anchors()
        for b in batches:
            ids, kinds = b.column(0).to_numpy(), b.column(1).to_numpy()
            data, bounds = utf8(b.column(2))
            found = [(d, h) for d, _, _, h in anchors.texts(data, bounds) if len(d)]
            if not found:
                continue
            doc, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
            bucket, hashes = bucket_code(hashes, buckets)
            order, _ = _by_key(bucket, hashes, doc)
            bucket, hashes, doc = bucket[order], hashes[order], doc[order]
            new = np.ones(len(order), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
            bucket, hashes, doc = bucket[new], hashes[new], doc[new]
            cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]))
            parts = [np.unique(doc[a:z], return_inverse=True) for a, z in zip(cuts, cuts[1:], strict=False)]
            sizes = np.cumsum([0, *(len(u) for u, _ in parts)])
            used = np.concatenate([u for u, _ in parts])
            place = np.uint16 if len(ids) <= 1 << 16 else np.uint32
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[cuts[:-1]].astype(np.int32)),
                    binaries(hashes, cuts),
                    binaries(np.concatenate([i for _, i in parts]).astype(place), cuts),
                    binaries(ids[used], sizes),
                    binaries(kinds[used], sizes),
                ],
                names=["bucket", "hashes", "at", "ids", "kinds"],
            )

    return texts.mapInArrow(scan, "bucket int, hashes binary, at binary, ids binary, kinds binary")


def shared_anchors(t: pa.Table, buckets: int) -> pa.Table:
    """One bucket: the anchors that several texts have, as ``bucket << 32 | code``, grouped for their documents."""
    at = [np.frombuffer(v.as_buffer(), np.uint16 if 2 * len(h) == len(v.as_buffer()) else np.uint32) for v, h in zip(t["at"], numbers(t["hashes"], np.uint32), strict=True)]
    hashes = np.concatenate(numbers(t["hashes"], np.uint32))
    ids = np.concatenate([v[a] for v, a in zip(numbers(t["ids"], np.int64), at, strict=True)])
    kinds = np.concatenate([v[a] for v, a in zip(numbers(t["kinds"], np.int64), at, strict=True)])
    order, cuts = _by_key(hashes)
    k = kinds[order]
    low, high = np.minimum.reduceat(k, cuts[:-1]), np.maximum.reduceat(k, cuts[:-1])
    keep = order[np.repeat(low != high, np.diff(cuts))]
    codes = hashes[keep].astype(np.int64) | (t["bucket"][0].as_py() << 32)
    return grouped_rows(ids[keep], kinds[keep], codes, buckets)


def context_rows(texts: DataFrame, buckets: int) -> DataFrame:
    """``texts(doc_id, kind, text, told)`` -> per batch and bucket the distinct contexts of shared anchors.

    Rows are ``bucket, lens, ids, kinds, starts, body``. Intervals of later documents that a batch settles by itself
    travel in the same columns, without a body.
    """

    def scan(batches):
        anchors = Anchors()
        for b in batches:
            ids, kinds = b.column(0).to_numpy(), b.column(1).to_numpy()
            data, bounds = utf8(b.column(2))
            raw = data.tobytes()
            told = [np.sort(v) for v in numbers(b.column(3), np.int64)]
            found = []
            for doc, start, n, h in anchors.texts(data, bounds):
                bucket, code = bucket_code(h, buckets)
                h = (bucket << 32) | code.astype(np.int64)
                edges = np.flatnonzero(np.diff(doc)) + 1
                for a, z in zip([0, *edges], [*edges, len(doc)], strict=True):
                    if a == z:
                        continue
                    own = told[doc[a]]
                    at = np.searchsorted(own, h[a:z])
                    at[at == len(own)] = 0
                    hit = np.flatnonzero(own[at] == h[a:z]) + a
                    if len(hit):
                        found.append((doc[hit], start[hit], n[hit] + LENGTH - 1, bucket[hit]))
            if not found:
                continue
            doc, start, size, bucket = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((ids[doc], bucket))
            doc, start, size, bucket = doc[order], start[order], size[order], bucket[order]
            owner, first = ids[doc].tolist(), {}
            new = np.array(
                [first.setdefault(raw[s : s + m], o) == o for s, m, o in zip(start.tolist(), size.tolist(), owner, strict=True)]
            )
            for group in (np.flatnonzero(new), np.flatnonzero(~new)):
                if not len(group):
                    continue
                settled = not new[group[0]]
                g = bucket[group]
                if settled:  # needs no comparison any more, so a frequent passage's rows need not meet in its bucket
                    g = (mix(ids[doc[group]].astype(np.uint64)) % _U(buckets)).astype(np.int64)
                    order = np.argsort(g, kind="stable")
                    group, g = group[order], g[order]
                cuts = np.concatenate(([0], np.flatnonzero(g[1:] != g[:-1]) + 1, [len(g)]))
                d, s, m = doc[group], start[group], size[group]
                if not settled:
                    body = [b"".join(raw[x : x + y] for x, y in zip(s[a:z], m[a:z], strict=True)) for a, z in zip(cuts, cuts[1:], strict=False)]
                else:
                    body = [b""] * (len(cuts) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(g[cuts[:-1]].astype(np.int32)),
                        binaries(m, cuts),
                        binaries(ids[d], cuts),
                        binaries(kinds[d], cuts),
                        binaries(s - bounds[d], cuts),
                        pa.array(body, pa.binary()),
                    ],
                    names=["bucket", "lens", "ids", "kinds", "starts", "body"],
                )

    return texts.mapInArrow(scan, "bucket int, lens binary, ids binary, kinds binary, starts binary, body binary")


def earlier_matches(body: np.ndarray, cuts: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows with a longest previous factor of ``LENGTH`` or more: (context, place in it).

    ``cuts`` bound the contexts in ``body``, ``docs`` are their smallest documents.
    """
    n = np.diff(cuts) - LENGTH + 1
    ctx = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(ctx)) - np.repeat(np.cumsum(n) - n, n)
    at = cuts[:-1][ctx] + place
    # windows without an equal one have no previous factor of that length: drop them by hash
    total = np.zeros(len(body) + 1, np.uint64)
    power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(body), _BASE, np.uint64))), dtype=np.uint64)
    np.cumsum((body.astype(np.uint64) + _U(1)) * power[:-1], out=total[1:])
    inverse = np.cumprod(
        np.concatenate((np.ones(1, np.uint64), np.full(len(body), pow(_BASE, -1, 1 << 64), np.uint64))), dtype=np.uint64
    )
    h = (total[at + LENGTH] - total[at]) * inverse[at]
    del total, power, inverse
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    some = np.zeros(len(order), bool)
    some[1:] |= same
    some[:-1] |= same
    some = order[some]
    if not len(some):
        return some, some
    ctx, place, at = ctx[some], place[some], at[some]
    # suffix order by the first LENGTH bytes, as big-endian words (the last one overlaps); equal ones by document
    view = np.ndarray(len(body) - 7, ">u8", body.tobytes(), strides=(1,))
    words = [view[at + o].astype(np.uint64) for o in [*range(0, LENGTH - 7, 8), LENGTH - 8]]
    owner = docs[ctx]
    suffix, runs = _by_key(*words)
    # within a run of equal ones the previous smaller document is the smallest of the run
    first = np.minimum.reduceat(owner[suffix], runs[:-1])
    lpf = suffix[owner[suffix] > np.repeat(first, np.diff(runs))]
    return ctx[lpf], place[lpf]


def bucket_intervals(t: pa.Table, buckets: int) -> pa.Table:
    """One bucket: marked intervals (start, end), grouped for their documents."""
    lens, ids, kinds, starts = (np.concatenate(numbers(t[c], np.int64)) for c in ("lens", "ids", "kinds", "starts"))
    sizes = [len(v) for v in numbers(t["lens"], np.int64)]
    bodies = [v.as_py() for v in t["body"]]
    settled = np.repeat([not x for x in bodies], sizes)
    out = [(ids[settled], kinds[settled], starts[settled], starts[settled] + lens[settled])]
    lens, ids, kinds, starts = (x[~settled] for x in (lens, ids, kinds, starts))
    if len(lens):
        raw = b"".join(bodies)
        del bodies
        ends = np.cumsum(lens)
        number: dict[bytes, int] = {}
        ctx = np.array([number.setdefault(raw[e - m : e], len(number)) for e, m in zip(ends.tolist(), lens.tolist(), strict=True)])
        low = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(low, ctx, ids)
        later = ids > low[ctx]
        out.append((ids[later], kinds[later], starts[later], starts[later] + lens[later]))
        cuts = np.cumsum([0, *map(len, number)])
        body = np.frombuffer(b"".join(number), np.uint8)
        del number, raw
        c, place = earlier_matches(body, cuts, low)
        order, _ = _by_key(c, place)
        c, place = c[order], place[order]
        if len(c):
            gap = (c[1:] != c[:-1]) | (place[1:] != place[:-1] + 1)
            a = np.concatenate(([0], np.flatnonzero(gap) + 1))
            z = np.concatenate((np.flatnonzero(gap), [len(c) - 1]))
            run_ctx, lo, hi = c[a], place[a], place[z] + LENGTH
            # the marks of a context hold wherever its smallest document has it
            holders = np.flatnonzero(~later)
            holders = holders[np.argsort(ctx[holders], kind="stable")]
            left, right = (np.searchsorted(ctx[holders], run_ctx, side) for side in ("left", "right"))
            times = right - left
            r = np.repeat(np.arange(len(times)), times)
            h = holders[np.arange(len(r)) - np.repeat(np.cumsum(times) - times, times) + left[r]]
            out.append((ids[h], kinds[h], starts[h] + lo[r], starts[h] + hi[r]))
    ids, kinds, lo, hi = (np.concatenate(x) for x in zip(*out, strict=True))
    return grouped_rows(ids, kinds, np.stack((lo, hi), axis=1).astype(np.int64), buckets)


def cut_out(texts: DataFrame) -> DataFrame:
    """``texts(doc_id, kind, text, spans)`` -> ``doc_id, kind, n_removed, n_spans, kept_sha256``, removed runs as ``removed``."""

    def scan(batches):
        for b in batches:
            removed, spans, digest, runs = [], [], [], []
            for text, given in zip(b.column(2), b.column(3), strict=True):
                data = text.as_py().encode()
                pairs = np.frombuffer(given.as_buffer(), np.int64).reshape(-1, 2)
                pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
                reach = np.maximum.accumulate(pairs[:, 1])
                new = np.flatnonzero(np.append(True, pairs[1:, 0] > reach[:-1]))
                lo, hi = pairs[new, 0], reach[np.append(new[1:] - 1, len(reach) - 1)]
                kept = hashlib.sha256()
                for a, z in zip([0, *hi.tolist()], [*lo.tolist(), len(data)], strict=True):
                    kept.update(data[a:z])
                removed.append(int((hi - lo).sum()))
                spans.append(len(lo))
                digest.append(kept.hexdigest())
                runs.append([{"start": int(a), "end": int(z)} for a, z in zip(lo, hi, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                names=["doc_id", "kind", "n_removed", "n_spans", "kept_sha256", "removed"],
            )

    schema = "doc_id long, kind long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start: long, end: long>>"
    return texts.mapInArrow(scan, schema)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed`` (byte ranges)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("kind"), text.alias("text"))
    sizes = named.select(
        "doc_id", "kind", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")
    )
    sizes = stored(sizes, "passage-sizes")
    firsts = group_totals(sizes, ["sha"], ["doc_id"], {"first": ("min", F.col("doc_id"))})
    copy = F.coalesce((F.col("doc_id") > F.col("first")) & (F.col("n_bytes") >= LENGTH), F.lit(False))
    sizes = stored(firsts.select("doc_id", "kind", "n_bytes", "sha", copy.alias("copy")), "passage-copies")
    total = sizes.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(partitions(spark), -(-total // BUCKET_BYTES))

    live = named.where((F.octet_length("text") >= LENGTH) & F.col("doc_id").isNotNull())
    shared = anchor_rows(live, buckets).groupBy("bucket").applyInArrow(lambda t: shared_anchors(t, buckets), GROUPED)
    told = stored(by_document(shared, "told", 1), "passage-anchors")
    copies = sizes.where("copy").select("doc_id", "kind").distinct()
    asked = live.join(told.join(copies, ["doc_id", "kind"], "left_anti"), ["doc_id", "kind"]).select("doc_id", "kind", "text", "told")
    marked = context_rows(asked, buckets).groupBy("bucket").applyInArrow(lambda t: bucket_intervals(t, buckets), GROUPED)
    spans = stored(by_document(marked, "spans", 2), "passage-spans")
    cut = cut_out(live.join(spans, ["doc_id", "kind"]).select("doc_id", "kind", "text", "spans"))
    cut = stored(cut, "passage-cut").dropDuplicates(["doc_id", "kind"])
    out = sizes.join(cut, ["doc_id", "kind"], "left")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    nothing = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(F.col("copy"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("copy"), F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(F.col("copy"), whole).otherwise(F.coalesce("removed", nothing)).alias("removed"),
    )


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents")).drop("removed")
