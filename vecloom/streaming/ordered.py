"""Event-time streams run through the batch operators, one micro-batch at a time.

State between micro-batches lies in the shared folder, one directory per batch id: a retried
batch reads its predecessor's state and overwrites its own, so results are exact after a
failure. A micro-batch is processed with the sliced batch operators, so a key that fills a third of it is
not one task's work, as it would be in a keyed state function.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import events, identity


class BatchState:
    """Tables saved per micro-batch below ``path``."""

    def __init__(self, spark: SparkSession, path: str, batch_id: int) -> None:
        self.spark, self.path, self.batch_id = spark, path, batch_id

    def before(self, name: str, schema: StructType | str) -> DataFrame:
        """The table as the previous batch left it, empty ahead of the first."""
        if self.batch_id == 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{self.batch_id - 1}/{name}")

    def save(self, name: str, df: DataFrame) -> DataFrame:
        where = f"{self.path}/{self.batch_id}/{name}"
        df.write.mode("overwrite").parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def forget(self) -> None:
        """Drop the state two batches back, which no retry can ask for."""
        old = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{self.batch_id - 2}")
        if self.batch_id >= 2:
            old.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)


def write_part(df: DataFrame, out: str, batch_id: int) -> None:
    """One batch's share of an output table; a retry replaces it."""
    df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")


def read_parts(spark: SparkSession, out: str, schema: StructType | str, before: int | None = None) -> DataFrame:
    """Output of all batches, or of those ahead of ``before``."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    if not root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], schema)
    parts = spark.read.schema(schema).option("basePath", out).parquet(f"{out}/batch=*")
    if before is not None:
        parts = parts.where(F.col("batch") < before)
    return parts.drop("batch")


def in_order(
    rows: DataFrame, state: BatchState, delay_seconds: float, ts: str = "ts", final: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(ready, late)``: rows strictly before the watermark, held-back ones included, and rows that were
    before the last watermark already. The watermark trails the newest row by the delay; rows at it
    wait, since others of the same time may follow. ``final`` makes everything ready."""
    before = state.before("watermark", "micros bigint").first()
    mark = before["micros"] if before and before["micros"] is not None else None
    micros = F.unix_micros(ts)
    late = rows.limit(0) if mark is None else rows.where(micros < mark)
    on_time = rows if mark is None else rows.where(micros >= mark)
    both = state.before("pending", rows.schema).unionByName(on_time)
    newest = both.agg(F.max(micros)).first()[0]
    if newest is not None:
        newest -= int(delay_seconds * 1_000_000)
        mark = newest if mark is None else max(mark, newest)
    state.save("watermark", state.spark.createDataFrame([(mark,)], "micros bigint"))
    if final or mark is None:
        state.save("pending", both.limit(0))
        return both, late
    state.save("pending", both.where(micros >= mark))
    return both.where(micros < mark), late


def write_late(late: DataFrame, checkpoint: str, batch_id: int) -> None:
    """Rows that came after their time are kept beside the checkpoint, by batch."""
    write_part(late, f"{checkpoint}/late", batch_id)


def _finish(spark: SparkSession, schema: StructType | str, states: str, step: Callable[..., None]) -> None:
    """One last step without new rows, after the last batch that left a state; the stream must have ended for good."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(states)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return
    done = [int(f.getPath().getName()) for f in files.listStatus(root)]
    if done:
        step(spark.createDataFrame([], schema), max(done) + 1, final=True)


def _run(
    stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None], trigger: dict | None
) -> StreamingQuery:
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            step(batch, batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{checkpoint}/query")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stream_low_runs(
    readings: DataFrame,
    keys: Sequence[str],
    out: str,
    checkpoint: str,
    threshold: float = events.LOW_THRESHOLD,
    min_run: int = events.MIN_RUN,
    delay_seconds: float = 0.0,
    seconds: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run-length events of a stream ``(keys, ts, id, value)``, written to ``out``.

    Rows at the watermark wait for the next batch; :func:`finish_low_runs` takes the last ones.
    """
    step = _low_run_step(keys, out, checkpoint, threshold, min_run, delay_seconds, seconds)
    return _run(readings, checkpoint, step, trigger)


def finish_low_runs(
    spark: SparkSession,
    schema: StructType | str,
    keys: Sequence[str],
    out: str,
    checkpoint: str,
    threshold: float = events.LOW_THRESHOLD,
    min_run: int = events.MIN_RUN,
    seconds: int | None = None,
) -> None:
    """Events of the rows still held back, once a stream of ``schema`` has ended for good."""
    _finish(spark, schema, f"{checkpoint}/runs", _low_run_step(keys, out, checkpoint, threshold, min_run, 0.0, seconds))


def _low_run_step(keys, out, checkpoint, threshold, min_run, delay_seconds, seconds) -> Callable[..., None]:
    keys = list(keys)

    def step(batch: DataFrame, batch_id: int, final: bool = False) -> None:
        state = BatchState(batch.sparkSession, f"{checkpoint}/runs", batch_id)
        ready, late = in_order(batch.select(*keys, "ts", "id", "value"), state, delay_seconds, final=final)
        write_late(late, checkpoint, batch_id)
        open_schema = StructType([*[batch.schema[k] for k in keys]]).add("run", "long")
        carry = state.before("open", open_schema)
        width = events.slice_seconds(ready, keys) if seconds is None else seconds
        found = events.low_runs(ready, keys, threshold, min_run, width, carry)
        write_part(found, out, batch_id)
        state.save("open", events.open_runs(ready, keys, threshold, width, carry).select(*keys, F.col("run").cast("long").alias("run")))
        state.forget()

    return step


MARK_SCHEMA = "user_id bigint, date date, ts timestamp, id bigint"


def stream_daily_marks(
    sightings: DataFrame, out: str, checkpoint: str, zone: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """First mark per user and day of a stream ``(user_id, ts, id)``, also across restarts.

    Days already marked are looked up among the marks of the days the batch touches.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first = identity.daily_marks(batch, zone=zone)
        low, high = first.agg(F.min("date"), F.max("date")).first()
        history = read_parts(spark, out, MARK_SCHEMA, before=batch_id)
        if low is not None:
            history = history.where(F.col("date").between(F.lit(low), F.lit(high)))
        fresh = first.join(history.select("user_id", "date"), ["user_id", "date"], "left_anti")
        write_part(fresh.select("user_id", "date", "ts", "id"), out, batch_id)

    return _run(sightings, checkpoint, step, trigger)


def stream_matches(
    probes: DataFrame,
    gallery: Callable[[], DataFrame],
    out: str,
    checkpoint: str,
    threshold: float = identity.MATCH_THRESHOLD,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Matches of a probe stream; the gallery is read anew for each micro-batch."""

    def step(batch: DataFrame, batch_id: int) -> None:
        write_part(identity.match_gallery(batch, gallery(), threshold), out, batch_id)

    return _run(probes, checkpoint, step, trigger)


GATED_SCHEMA = "site string, ts timestamp, frame bigint, face int, user_id bigint, date date"


def stream_gated_marks(
    frames: DataFrame,
    out: str,
    checkpoint: str,
    threshold: float = events.LOW_THRESHOLD,
    min_run: int = events.MIN_RUN,
    delay_seconds: float = 0.0,
    seconds: int = events.SLICE_SECONDS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Gated marks of a stream ``(site, ts, frame, value, faces)``, ``faces`` being the matched
    user ids of a frame in order (null where unknown).

    Kept between batches: open runs, sites whose gate stands open, and the marks themselves.
    Rows at the watermark wait for the next batch; :func:`finish_gated_marks` takes the last ones.
    """
    step = _gate_step(out, checkpoint, threshold, min_run, delay_seconds, seconds)
    return _run(frames, checkpoint, step, trigger)


def finish_gated_marks(
    spark: SparkSession,
    schema: StructType | str,
    out: str,
    checkpoint: str,
    threshold: float = events.LOW_THRESHOLD,
    min_run: int = events.MIN_RUN,
    seconds: int = events.SLICE_SECONDS,
) -> None:
    """Marks of the rows still held back, once a stream of ``schema`` has ended for good."""
    _finish(spark, schema, f"{checkpoint}/gates", _gate_step(out, checkpoint, threshold, min_run, 0.0, seconds))


def _gate_step(out, checkpoint, threshold, min_run, delay_seconds, seconds) -> Callable[..., None]:
    def step(batch: DataFrame, batch_id: int, final: bool = False) -> None:
        spark = batch.sparkSession
        state = BatchState(spark, f"{checkpoint}/gates", batch_id)
        ready, late = in_order(batch.select("site", "ts", "frame", "value", "faces"), state, delay_seconds, final=final)
        write_late(late, checkpoint, batch_id)
        readings = ready.select("site", "ts", F.col("frame").alias("id"), "value")
        carry = state.before("open", "site string, run bigint")
        events_now = events.low_runs(readings, ["site"], threshold, min_run, seconds, carry).select(
            "site", "ts", F.col("id").alias("frame")
        )
        # a gate left open counts as an event ahead of everything in this batch
        gates = state.before("gates", "site string")
        start = ready.agg(F.min("ts")).first()[0]
        opened = events_now.unionByName(
            gates.select("site", F.lit(start).cast("timestamp").alias("ts"), F.lit(-1).cast("bigint").alias("frame"))
        ).where("ts is not null")
        opened = state.save("events", opened)
        matches = ready.select("site", "ts", "frame", F.posexplode("faces").alias("face", "user_id"))
        history = read_parts(spark, out, GATED_SCHEMA, before=batch_id)
        marks = events.gated_marks(opened, matches, history, seconds)
        write_part(marks.select("site", "ts", "frame", "face", "user_id", "date"), out, batch_id)
        written = spark.read.schema(GATED_SCHEMA).parquet(f"{out}/batch={batch_id}")
        last_open = opened.groupBy("site").agg(F.max(F.struct("ts", "frame")).alias("opened"))
        last_mark = written.groupBy("site").agg(F.max(F.struct("ts", "frame")).alias("closed"))
        still = last_open.join(last_mark, "site", "left").where("closed is null or opened > closed").select("site")
        idle = gates.join(last_open, "site", "left_anti")
        state.save("gates", still.unionByName(idle))
        run = events.open_runs(readings, ["site"], threshold, seconds, carry)
        state.save("open", run.select("site", F.col("run").cast("bigint").alias("run")))
        state.forget()

    return step
