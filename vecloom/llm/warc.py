"""WARC archives (4) with a two-level capture index.

Writing: every page is a record of its own gzip member in a WARC file of a task; of records with equal payloads of ``REVISIT_BYTES``
or more, the one with the smallest id is a response, the others are revisits that name it and have no
payload of their own. Files go through ``pyarrow.fs`` to the shared folder under names that are new for every attempt of a task;
only files that a finished task has reported are known to the index, so a lost executor leaves
nothing but unused files.

Index: captures are sorted by key, the reversed host with the rest of the URL (``com,example,www)/path?query``) and
the page id, by a range partitioning. ``BLOCK_LINES`` lines make a compressed block; a partition's blocks
go to one block file. The block directory has one line per block (first key, file, offset, length); it is a table, and
its top level, the first key of each partition, has as many rows as there are index partitions and is the only
thing that is broadcast.

Lookup: each requested capture finds its partition by binary search in the top level, meets the
directory lines of that partition, and finds its block by binary search; each block that is needed is read
with one range read and searched by bisection. The capture line gives file, offset and length of the record, which is
read with one range read, unpacked and checked against its digest. A revisit is resolved through its
record's reference.

Defined results: a null payload is empty; a null URL has the empty key; equal URLs are told apart by page id; rows of equal page id
and URL are captures of their own, and all that share both are read by a request of that pair; rows with a null page id
cannot be named by a record and are left out; an empty table writes no
archive and gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import contextlib
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import table
from ..session import scratch
from .frames import group_totals, partitions, stored
from .registry import query

REVISIT_BYTES = 100
BLOCK_LINES = 1000
#: A WARC file is closed, and the next one begun, beyond this size.
FILE_BYTES = 256 << 20
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as URI or absolute path."""
    system, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
    return system, path.rstrip("/")


def record(page: int, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has an empty block."""
    block = b"" if refers_to is not None else payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines[2:2] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    size = int(headers["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("a WARC record of another length than its header says")
    return headers, rest[:size]


def page_of(urn: str) -> int:
    return int(urn.removeprefix("<urn:page:").removesuffix(">"))


def clean_url(url: Column) -> Column:
    """URLs are header values: line ends and other control characters are percent-free blanks there."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), "[\\x00-\\x1F\\x7F]", " ")


def capture_key(url: Column) -> Column:
    """``com,example,www)/path?query`` from a URL: host reversed by labels, scheme and fragment dropped."""
    rest = F.regexp_replace(clean_url(url), "^[^:/?#]*://", "")
    rest = F.regexp_replace(rest, "#.*$", "")
    host = F.lower(F.regexp_extract(rest, "^[^/?]*", 0))
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"), F.substring(rest, F.length(host) + 1, F.length(rest)))


def with_decisions(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, digest, refers_to`` from ``pages(page_id, url, html)``: which rows are revisits.

    The decision is made on digests; payloads are shuffled once, to meet it.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.where("page_id is not null").select(
        F.col("page_id").cast("long").alias("page_id"), clean_url(F.col("url")).alias("url"), payload.alias("payload")
    )
    small = rows.select("page_id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("n"))
    small = stored(small, "warc-digests")
    groups = group_totals(small.where(F.col("n") >= REVISIT_BYTES), ["digest"], ["page_id"], {"first": ("min", F.col("page_id"))})
    revisits = groups.where("page_id > first").select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "first")
    revisits = stored(revisits.distinct(), "warc-revisits")
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    on = (rows["page_id"] == revisits["_page"]) & (rows["digest"] == revisits["_digest"])
    return rows.join(revisits, on, "left").select("page_id", "url", "payload", "digest", F.col("first").alias("refers_to"))


def write_archives(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``rows(page_id, url, payload, digest, refers_to)``; the captures ``page_id, url, file, offset, length``."""

    def scan(batches):
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        out, at, name = None, 0, ""
        context = TaskContext.get()
        try:
            for b in batches:
                captures = []
                for page, url, payload, digest, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if out is None or at > file_bytes:
                        if out is not None:
                            out.close()
                        name = f"pages-{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
                        out, at = system.open_output_stream(f"{path}/{name}", compression=None), 0
                    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
                    data = packer.compress(record(page, url, payload, digest, first)) + packer.flush()
                    out.write(data)
                    captures.append((page, url, name, at, len(data)))
                    at += len(data)
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame(captures, columns=["page_id", "url", "file", "offset", "length"]), preserve_index=False
                )
        finally:
            if out is not None:
                out.close()

    schema = "page_id long, url string, file string, offset long, length long"
    return stored(rows.mapInArrow(scan, schema), "warc-captures")


def scan_archives(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """Captures of whole archives, read from front to back: what the writer reports, for archives from elsewhere.

    ``files(file)`` names them; a task holds one record at a time.
    """

    def scan(batches):
        system, path = open_folder(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                captures = []
                with system.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for offset, length, raw in members(stream):
                        headers, _ = parse(raw)
                        captures.append((page_of(headers["warc-record-id"]), headers["warc-target-uri"], name, offset, length))
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame(captures, columns=["page_id", "url", "file", "offset", "length"]), preserve_index=False
                )

    return files.select("file").mapInArrow(scan, "page_id long, url string, file string, offset long, length long")


def members(stream, step: int = 1 << 20) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each gzip member of a stream."""
    left, offset = b"", 0
    while True:
        left = left or stream.read(step)
        if not left:
            return
        unpack, parts, used = zlib.decompressobj(31), [], 0
        while not unpack.eof:
            if not left:
                left = stream.read(step)
                if not left:
                    raise ValueError("an archive ends within a record")
            parts.append(unpack.decompress(left))
            used += len(left) - len(unpack.unused_data)
            left = unpack.unused_data
        yield offset, used, b"".join(parts)
        offset += used


class CaptureIndex:
    """A sorted, blocked index of captures below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, directory: DataFrame):
        self.spark, self.folder, self.directory = spark, folder, directory
        top = directory.groupBy("part").agg(F.min("first").alias("first")).orderBy("first").collect()  # a row per index partition
        self.parts, self.firsts = [r["part"] for r in top], [r["first"] for r in top]

    @classmethod
    def build(cls, captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES):
        """Sort ``captures(page_id, url, file, offset, length)`` by key and write blocks and directory."""
        spark = captures.sparkSession
        lines = captures.select(
            F.concat(capture_key(F.col("url")), F.lit(" "), F.lpad(F.col("page_id").cast("string"), 20, "0")).alias("key"),
            F.concat_ws(" ", "file", F.col("offset"), F.col("length")).alias("place"),
        )
        lines = lines.repartitionByRange(partitions(spark), "key").sortWithinPartitions("key", "place")

        def scan(batches):
            system, path = open_folder(folder)
            system.create_dir(path, recursive=True)
            part = TaskContext.get().partitionId()
            name, at, out, held = f"blocks-{part:06d}-{uuid.uuid4().hex}.cdx.z", 0, None, []
            entries = []

            def flush():
                nonlocal at, out, held
                out = out or system.open_output_stream(f"{path}/{name}", compression=None)
                data = zlib.compress("\n".join(held).encode())
                out.write(data)
                entries.append((part, held[0].rpartition(" ")[0].rpartition(" ")[0].rpartition(" ")[0], name, at, len(data)))
                at, held = at + len(data), []

            for b in batches:
                for key, place in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    held.append(f"{key} {place}")
                    if len(held) == block_lines:
                        flush()
            if held:
                flush()
            if out is not None:
                out.close()
            yield pa.RecordBatch.from_pandas(
                pd.DataFrame(entries, columns=["part", "first", "block_file", "block_offset", "block_length"]).astype({"part": "int32"}),
                preserve_index=False,
            ) if entries else pa.RecordBatch.from_pydict(
                {"part": pa.array([], pa.int32()), "first": pa.array([], pa.string()), "block_file": pa.array([], pa.string()),
                 "block_offset": pa.array([], pa.int64()), "block_length": pa.array([], pa.int64())}
            )

        schema = "part int, first string, block_file string, block_offset long, block_length long"
        return cls(spark, folder, stored(lines.mapInArrow(scan, schema), "warc-directory"))

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """``page_id, file, offset, length`` of the captures of ``wanted(page_id, url)``."""
        firsts, parts, folder = self.firsts, self.parts, self.folder
        key = F.concat(capture_key(F.col("url")), F.lit(" "), F.lpad(F.col("page_id").cast("string"), 20, "0"))

        def place(batches):
            for b in batches:
                keys = b.column(1).to_pylist()
                at = [parts[max(0, bisect.bisect_right(firsts, k) - 1)] for k in keys]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], names=["page_id", "key", "part"])

        asked = wanted.select(F.col("page_id").cast("long").alias("page_id"), key.alias("key"))
        asked = asked.mapInArrow(place, "page_id long, key string, part int")

        def search(left: pa.Table, right: pa.Table) -> pa.Table:
            system, path = open_folder(folder)
            blocks = sorted(zip(*(right[c].to_pylist() for c in ("first", "block_file", "block_offset", "block_length")), strict=True))
            begin, out, now, lines, keys = [x[0] for x in blocks], [], -1, [], []
            asked = sorted(zip(left["key"].to_pylist(), left["page_id"].to_pylist(), strict=True))
            with contextlib.ExitStack() as opened:
                files = {}
                for key, page in asked:
                    # equal keys may begin in the block before the one whose first key they equal
                    k = max(0, bisect.bisect_left(begin, key) - 1) if begin else -1
                    while 0 <= k < len(begin) and begin[k] <= key:
                        if k != now:
                            _, name, offset, length = blocks[k]
                            if name not in files:
                                files[name] = opened.enter_context(system.open_input_file(f"{path}/{name}"))
                            lines = zlib.decompress(files[name].read_at(length, offset)).decode().split("\n")
                            lines = [x.rsplit(" ", 3) for x in lines]
                            keys, now = [x[0] for x in lines], k
                        at = bisect.bisect_left(keys, key)
                        while at < len(keys) and keys[at] == key:
                            out.append((page, lines[at][1], int(lines[at][2]), int(lines[at][3])))
                            at += 1
                        k += 1
            cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            return pa.table([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["page_id", "file", "offset", "length"])

        grouped = asked.distinct().groupBy("part").cogroup(self.directory.groupBy("part"))
        return grouped.applyInArrow(search, "page_id long, file string, offset long, length long")


def read_records(places: DataFrame, folder: str) -> DataFrame:
    """The records at ``places(page_id, file, offset, length)``, by range reads in order of place.

    ``page_id, record_type, refers_to, payload_bytes, payload_digest``; a response's digest and length are
    computed from what is read, a revisit's are those it states.
    """

    def scan(batches):
        system, path = open_folder(folder)
        name, source = None, None
        for b in batches:
            rows = []
            for page, file, offset, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, system.open_input_file(f"{path}/{file}")
                headers, block = parse(zlib.decompress(source.read_at(length, offset), 31))
                stated = headers["warc-payload-digest"].removeprefix("sha256:")
                if page_of(headers["warc-record-id"]) != page:
                    raise ValueError(f"the record of page {page} is not where the index says")
                if headers["warc-type"] == "response":
                    digest = hashlib.sha256(block).hexdigest()
                    if digest != stated:
                        raise ValueError(f"page {page}: digest of the payload differs from the header's")
                    rows.append((page, "response", None, len(block), digest))
                else:
                    rows.append((page, "revisit", page_of(headers["warc-refers-to"]), int(headers["x-payload-length"]), stated))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            names = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)
        if source is not None:
            source.close()

    schema = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string"
    # ranges of (file, offset) keep reads in order and deal a large file over several tasks
    spread = places.repartitionByRange(partitions(places.sparkSession), "file", "offset").sortWithinPartitions("file", "offset")
    return spread.mapInArrow(scan, schema)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write archives and index for all of ``pages(page_id, url, html)``, then read every page back through the index."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    captures = write_archives(with_decisions(pages), folder)
    index = CaptureIndex.build(captures, f"{folder}/index")
    wanted = pages.where("page_id is not null").select("page_id", clean_url(F.col("url")).alias("url"))
    return read_records(stored(index.lookup(wanted), "warc-places"), folder)


ORACLE = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id > first THEN first END AS refers_to FROM f
"""


@query("op4_warc_archive", ORACLE)
def op4_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    got = archive_round_trip(table(spark, folder, "pages"))
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
