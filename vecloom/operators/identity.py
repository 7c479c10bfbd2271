"""Identity matching against a gallery, registration and once-per-day marks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.keys import surrogate_key
from ..session import materialise
from ..sources.store import tie_break
from .search import Matrix, refuse_repeats, scores, sliced, small_matrix, to_matrix, top_k

MATCH_THRESHOLD = 0.50
UNKNOWN = "Unknown"


def match_gallery(
    probes: DataFrame, gallery: DataFrame, threshold: float = MATCH_THRESHOLD, keep: Sequence[str] = ()
) -> DataFrame:
    """``(probe_id, keep..., user_id, name, score)``: the best user by cosine if above ``threshold``.

    Otherwise the name is "Unknown" with the best score, null for a zero vector. Equal scores go
    to the lower user id. A gallery of checked size is shipped to the probes, which are then
    matched where they lie, in batches and streams alike; a larger one is matched block by block, each different
    vector of the probes once.
    Rows of a repeated ``probe_id`` are matched each; a repeated ``user_id`` is refused.
    """
    refuse_repeats(gallery.where("embedding is not null"), "user_id")
    few = small_matrix(gallery, "user_id", "embedding", "name")
    if few is not None:
        return _match_in_place(probes, few, threshold, keep)
    probes = materialise(probes.select("probe_id", *keep, "embedding"), "probes")
    # each different vector is matched once, however many probes show it
    seen = probes.select("embedding").where("embedding is not null").distinct()
    seen = materialise(seen.withColumn("__vector__", F.monotonically_increasing_id()), "vectors")
    best = top_k(
        seen.select(F.col("__vector__").alias("query_id"), F.col("embedding").alias("query")),
        gallery.select(F.col("user_id").alias("id"), "embedding"),
        k=1,
        metric="cosine",
    )
    named = best.join(gallery.select(F.col("user_id").alias("id"), "name"), "id").withColumnRenamed("query_id", "__vector__")
    named = materialise(seen.join(named, "__vector__").select("embedding", "id", "name", "score"), "matched")
    hit = F.col("score") > threshold
    out = ["probe_id", *keep, F.when(hit, F.col("id")).alias("user_id"), F.when(hit, F.col("name")).otherwise(F.lit(UNKNOWN)).alias("name"), "score"]
    # probes without a vector stay out of the join: they would meet in one task
    without = probes.where("embedding is null").select("*", *[F.lit(None).cast(named.schema[c].dataType).alias(c) for c in ("id", "name", "score")])
    return probes.where("embedding is not null").join(named, "embedding", "left").select(*out).unionByName(without.select(*out))


def _match_in_place(probes: DataFrame, few: Matrix, threshold: float, keep: Sequence[str]) -> DataFrame:
    order = np.argsort(few.keys.to_numpy(zero_copy_only=False), kind="stable")
    ids = few.keys.to_numpy(zero_copy_only=False)[order]
    names = pa.array([few.extra["name"][i] for i in order], pa.string())
    shared = probes.sparkSession.sparkContext.broadcast((ids, few.rows[order], names))
    kept = ["probe_id", *keep]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        users, rows, labels = shared.value
        for batch in (part for b in batches for part in sliced(b, len(users))):
            best = np.zeros(batch.num_rows, np.int64)
            score = np.full(batch.num_rows, np.nan)
            present = np.nonzero(batch.column("embedding").is_valid().to_numpy(zero_copy_only=False))[0]
            if len(users) and len(present):
                s = scores(to_matrix(batch.column("embedding").take(pa.array(present)), rows.shape[1]), rows, "cosine")
                s = np.where(np.isnan(s), -np.inf, s)
                best[present] = s.argmax(axis=1)
                score[present] = s.max(axis=1)
                score[np.isinf(score)] = np.nan
            hit = score > threshold
            at = pa.array(best, mask=~hit)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.array(users, pa.int64()).take(at),
                    pc.fill_null(labels.take(at), UNKNOWN),
                    pa.array(score, pa.float64(), mask=np.isnan(score)),
                ],
                names=[*kept, "user_id", "name", "score"],
            )

    schema = StructType([probes.schema[c] for c in kept])
    schema = schema.add("user_id", "long").add("name", "string").add("score", "double")
    return probes.select(*kept, "embedding").mapInArrow(match, schema)


def register_new(incoming: DataFrame, users: DataFrame, seq: str) -> DataFrame:
    """Users to add: names not yet present, the earliest per name (of equal ones the lowest content hash), with a stable new id."""
    w = W.partitionBy("name").orderBy(F.col(seq), tie_break(incoming))
    first = incoming.withColumn("__rn__", F.row_number().over(w)).where("__rn__ = 1").drop("__rn__")
    fresh = first.join(users.select("name"), "name", "left_anti")
    return fresh.withColumn("user_id", surrogate_key("name"))


def daily_marks(sightings: DataFrame, history: DataFrame | None = None, zone: str | None = None) -> DataFrame:
    """First sighting ``(user_id, date, ts, id)`` per user and day, days already marked left out.

    ``sightings(user_id, ts, id)``; ``zone`` sets the day boundary, else the session time zone.
    """
    ts = F.col("ts") if zone is None else F.from_utc_timestamp("ts", zone)
    dated = sightings.select("user_id", F.to_date(ts).alias("date"), "ts", "id")
    w = W.partitionBy("user_id", "date").orderBy("ts", "id")
    first = dated.withColumn("__rn__", F.row_number().over(w)).where("__rn__ = 1").drop("__rn__")
    if history is not None:
        first = first.join(history.select("user_id", "date"), ["user_id", "date"], "left_anti")
    return first
