"""End-to-end jobs: ingest, sync, search, flatten, match and mark."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.encoder import DEFAULT_DIM, Encoder, HashingEncoder, encode_column
from ..functions.text import MIN_TEXT_LEN
from ..functions.vectors import aspect_ratio
from ..operators import chunk, events, extract, flatten, identity, profile, search
from ..operators.sync import sync_store
from ..session import materialise, scratch
from ..sources.csv import ORDINAL, SOURCE, scan_csv, write_csv
from ..sources.json import scan_json
from ..sources.sqldump import scan_statements
from ..sources.store import RowStore, last_wins

CSV_TABLE = "csv"


def with_vectors(rows: DataFrame, make_encoder: Callable[[], Encoder] = HashingEncoder) -> DataFrame:
    return rows.withColumn("embedding", encode_column("text", make_encoder))


def csv_rows(
    cells: DataFrame,
    source: Column,
    ordinal: Column,
    text_columns: Sequence[str] | None = None,
    key_columns: Sequence[str] | None = None,
    min_text_len: int = MIN_TEXT_LEN,
) -> DataFrame:
    """Metadata rows of one table: columns chosen, texts built, short ones dropped, ids unique
    (the last row of an id wins)."""
    names = [c for c in cells.columns if c not in (SOURCE, ORDINAL)]
    placed = cells.withColumns({SOURCE: source, ORDINAL: ordinal})
    texts = profile.pick_text_columns(placed.drop(SOURCE), ORDINAL, text_columns)
    keys = profile.pick_key_columns(names, key_columns)
    keyed = profile.keyed_texts(placed, texts, keys, min_text_len, keep=(SOURCE, ORDINAL))
    unique = last_wins(keyed, ["id"], ORDINAL)
    return unique.select(
        "id",
        F.col(SOURCE).alias("source"),
        F.lit(CSV_TABLE).alias("table_name"),
        F.col("id").alias("row_id"),
        F.lit(0).alias("position"),
        "text",
    )


def _csv_incoming(spark: SparkSession, path: str, source: str, **columns) -> DataFrame:
    cells = scan_csv(spark, path, with_origin=True)
    return csv_rows(cells, F.lit(source), F.col(ORDINAL), **columns)


def ingest_csv(
    spark: SparkSession,
    path: str,
    store: RowStore,
    make_encoder: Callable[[], Encoder] = HashingEncoder,
    source: str | None = None,
    **columns,
) -> dict[str, int]:
    """Full load: the rows of this source are replaced."""
    source = source or path
    rows = with_vectors(_csv_incoming(spark, path, source, **columns), make_encoder)
    version = store.replace(rows, source=source)
    added = store.read(version).where(F.col("source") == source).count()
    return {"added": added, "removed": 0, "updated": 0}


def sync_csv(
    spark: SparkSession,
    path: str,
    store: RowStore,
    make_encoder: Callable[[], Encoder] = HashingEncoder,
    source: str | None = None,
    detect_updates: bool = False,
    **columns,
) -> dict[str, int]:
    """Incremental load: new rows added, missing rows removed, changed ones on request."""
    source = source or path
    incoming = _csv_incoming(spark, path, source, **columns)
    return sync_store(store, incoming, [source], lambda rows: with_vectors(rows, make_encoder), detect_updates)


def dump_records(
    spark: SparkSession, paths: str | Sequence[str], min_text_len: int = MIN_TEXT_LEN, compat: bool = False
) -> DataFrame:
    """Text records of a dump; ``compat`` reads it line by line, the older way."""
    if compat:
        return extract.line_records(spark, paths, min_text_len)
    return extract.text_records(scan_statements(spark, paths), min_text_len)


def dump_chunks(
    spark: SparkSession,
    paths: str | Sequence[str],
    min_text_len: int = MIN_TEXT_LEN,
    max_tokens: int = chunk.MAX_TOKENS,
    overlap: int = chunk.OVERLAP,
    compat: bool = False,
    source: str | None = None,
) -> DataFrame:
    """Chunks of a dump with unique ids. With ``source`` all its files are that one source, else each is its own; equal
    rows of a source are numbered on."""
    records = dump_records(spark, paths, min_text_len, compat)
    records = records if source is None else records.withColumn("source", F.lit(source))
    cut = chunk.chunk_records(chunk.counted_records(records), chunk.windows("text", max_tokens, overlap))
    return chunk.distinct_chunks(cut)


def ingest_sql_dump(
    spark: SparkSession,
    paths: str | Sequence[str],
    store: RowStore,
    make_encoder: Callable[[], Encoder] = HashingEncoder,
    **options,
) -> int:
    """Chunks of a dump go into the store, replacing chunks of the same id; returns the version."""
    return store.apply(adds=with_vectors(dump_chunks(spark, paths, **options), make_encoder))


def dry_run(
    spark: SparkSession, paths: str | Sequence[str], min_text_len: int = MIN_TEXT_LEN, compat: bool = False
) -> DataFrame:
    """Text records per table of a dump; nothing is chunked, encoded or stored."""
    return extract.record_counts(dump_records(spark, paths, min_text_len, compat))


def searcher(
    rows: DataFrame, factory: str = "Flat", metric: str = "ip", nprobe: int = 16, path: str | None = None
) -> Callable[[DataFrame, int], DataFrame]:
    """A function of ``(queries, k)`` giving hits, chosen by an index-factory name.

    "Flat" is exact; "IVF4096,Flat" builds a cell index of that many cells under ``path`` (the shared folder by
    default) and probes ``nprobe`` of them; "HNSW32", a graph elsewhere, means hashed candidates here.
    """
    vectors = rows.select("id", "embedding")
    name = factory.strip().lower()
    if name in ("", "flat"):
        return lambda queries, k: search.top_k(queries, vectors, k, metric)
    cells = re.fullmatch(r"ivf(\d+),flat", name)
    if cells:
        where = path or scratch(rows.sparkSession, "cells")
        index = search.CellIndex.build(vectors, where, int(cells[1]))
        return lambda queries, k: index.search(queries, k, nprobe, metric)
    if re.fullmatch(r"hnsw\d*(,flat)?", name):
        return lambda queries, k: search.hashed_top_k(queries, vectors, k, metric)
    raise ValueError(f"no such index: {factory}")


def search_texts(
    queries: DataFrame,
    rows: DataFrame,
    k: int = 10,
    metric: str = "ip",
    make_encoder: Callable[[], Encoder] = HashingEncoder,
    find: Callable[[DataFrame, int], DataFrame] | None = None,
) -> DataFrame:
    """Hits with metadata for ``queries(query_id, q)`` over stored rows, all queries in one job.

    A column ``k`` in the queries overrides ``k`` per query. ``find`` is a :func:`searcher`; without one the
    search is exact. Blank queries are dropped.
    """
    asked = search.query_table(queries).withColumn("query", encode_column("q", make_encoder))
    find = find or searcher(rows, metric=metric)
    if "k" in queries.columns:
        n, k = asked.agg(F.count("*"), F.coalesce(F.max("k"), F.lit(k))).first()
        own = asked.select("query_id", F.col("k").alias("wanted"))
        hits = find(asked, k).join(own, "query_id").where("rank <= wanted").drop("wanted")
    else:
        n, hits = asked.count(), find(asked, k)
    return search.with_metadata(hits, rows, max_hits=n * k)


def flatten_json(spark: SparkSession, paths: str | Sequence[str], out: str | None = None, lines: bool = False) -> DataFrame:
    """Flat STRING table of JSON documents, written as CSV when ``out`` is given."""
    records = scan_json(spark, paths, lines)
    flat = flatten.flatten_wide(records).drop("rec_id")
    if out is not None:
        write_csv(flat, out)
    return flat


def match_and_mark(
    frames: DataFrame,
    gallery: DataFrame,
    history: DataFrame | None = None,
    eye_threshold: float = events.LOW_THRESHOLD,
    min_run: int = events.MIN_RUN,
    match_threshold: float = identity.MATCH_THRESHOLD,
    seconds: int | None = None,
) -> DataFrame:
    """Marks of ``frames(site, ts, frame, left, right, faces)``.

    The mean aspect ratio of both point groups gives the run-length events that open a site's
    gate; faces are matched to the gallery; a match behind an open gate is marked once a day.
    """
    ratio = (aspect_ratio("left") + aspect_ratio("right")) / 2.0
    readings = frames.select("site", "ts", F.col("frame").alias("id"), ratio.alias("value"))
    opened = events.low_runs(readings, ["site"], eye_threshold, min_run, seconds).select(
        "site", "ts", F.col("id").alias("frame")
    )
    opened = materialise(opened, "opened")
    faces = frames.select("site", "ts", "frame", F.posexplode("faces").alias("face", "seen"))
    key = F.concat_ws("|", "site", F.col("frame").cast("string"), F.col("face").cast("string"))
    probes = faces.select("site", "ts", "frame", "face", key.alias("probe_id"), F.col("seen.embedding").alias("embedding"))
    matched = identity.match_gallery(probes, gallery, match_threshold, keep=["site", "ts", "frame", "face"])
    matches = matched.where("user_id is not null").select("site", "ts", "frame", "face", "user_id")
    # scored once; what follows reads this narrow table several times
    matches = materialise(matches, "matches")
    return events.gated_marks(opened, matches, history, seconds)


__all__ = [
    "DEFAULT_DIM",
    "csv_rows",
    "dry_run",
    "dump_chunks",
    "dump_records",
    "flatten_json",
    "ingest_csv",
    "ingest_sql_dump",
    "match_and_mark",
    "search_texts",
    "searcher",
    "sync_csv",
    "with_vectors",
]
