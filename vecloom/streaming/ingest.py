"""Incremental sync driven by a landing folder, and the streaming debounce."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.sync import sync_store
from ..sources.store import RowStore

DEBOUNCE_SECONDS = 1.5


def landed_files(spark: SparkSession, landing: str, glob: str = "*", max_files: int = 1000) -> DataFrame:
    """Stream ``(source, snapshot, path, ts)`` of files at ``landing/<source>/<snapshot>/<file>``.

    Only names are read; ``max_files`` bounds a micro-batch.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
    )
    # the folder is partition-free: names come from the path
    step: Callable[[int], Column] = lambda i: F.element_at(F.split("path", "/"), i)
    return files.select(
        step(-3).alias("source"),
        step(-2).alias("snapshot"),
        F.regexp_replace("path", "/[^/]+$", "").alias("path"),
        F.col("modificationTime").alias("ts"),
    )


def debounced(changes: DataFrame, gap_seconds: float = DEBOUNCE_SECONDS, delay: str = "10 seconds") -> DataFrame:
    """Stream ``(source, start, end, changes)``, one row once a source was quiet for the gap.

    Changes at most the gap apart merge. A session comes out when the watermark has passed it.
    """
    gap = f"{int(round(gap_seconds * 1000))} milliseconds"
    quiet = changes.withWatermark("ts", delay).groupBy("source", F.session_window("ts", gap).alias("w"))
    return quiet.agg(F.max("ts").alias("end"), F.count("*").alias("changes")).select(
        "source", F.col("w.start").alias("start"), "end", "changes"
    )


def stream_sync(
    files: DataFrame,
    store: RowStore,
    prepare: Callable[[str, str], DataFrame],
    encode: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    detect_updates: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep ``store`` in step with snapshots as they land.

    Each snapshot is the full content of its source, so a micro-batch syncs the newest snapshot of
    each source it names, in one job over all of them. ``prepare(source, path)`` reads a snapshot as
    metadata rows with unique ids. A repeated batch finds nothing to do.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        newest = batch.groupBy("source").agg(F.max(F.struct("snapshot", "path")).alias("last"))
        # at most one row per file of the micro-batch, which the source bounds
        changed = [(r["source"], r["last"]["path"]) for r in newest.collect()]
        if not changed:
            return
        incoming = None
        for source, path in changed:
            rows = prepare(source, path)
            incoming = rows if incoming is None else incoming.unionByName(rows)
        sync_store(store, incoming, [s for s, _ in changed], encode, detect_updates)

    writer = files.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
