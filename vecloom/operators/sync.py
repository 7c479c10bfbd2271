"""Snapshot comparison, upsert and delete over keyed tables, and vector checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import content_hash
from ..session import materialise
from ..sources.store import RowStore, last_wins


def new_rows(incoming: DataFrame, current: DataFrame, key: str = "id") -> DataFrame:
    return incoming.join(current.select(key), key, "left_anti")


def removed_rows(incoming: DataFrame, current: DataFrame, key: str = "id") -> DataFrame:
    return current.join(incoming.select(key), key, "left_anti")


def changed_rows(incoming: DataFrame, current: DataFrame, key: str = "id", content: str = "hash") -> DataFrame:
    """Incoming rows whose content differs from the stored row of the same key."""
    old = current.select(key, F.col(content).alias("__old__"))
    return incoming.join(old, key).where(~F.col(content).eqNullSafe(F.col("__old__"))).drop("__old__")


def delete_ids(current: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return current.join(ids.select(key), key, "left_anti")


def upsert(current: DataFrame, incoming: DataFrame, seq: str, key: str = "id") -> DataFrame:
    """Union in which incoming rows win over current ones and later incoming rows over earlier.

    Current rows are only anti-joined, never sorted; the last-wins step sees the batch alone.
    """
    latest = last_wins(incoming, [key], seq).drop(seq)
    return removed_rows(latest, current, key).unionByName(latest)


def snapshot_diff(incoming: DataFrame, current: DataFrame, key: str = "id", content: str = "hash") -> DataFrame:
    """``(key, status)`` with status new, removed, changed or same, from one full outer join."""
    new = incoming.select(key, F.col(content).alias("__new__"), F.lit(True).alias("__in__"))
    old = current.select(key, F.col(content).alias("__old__"), F.lit(True).alias("__cur__"))
    status = (
        F.when(F.col("__cur__").isNull(), "new")
        .when(F.col("__in__").isNull(), "removed")
        .when(~F.col("__new__").eqNullSafe(F.col("__old__")), "changed")
        .otherwise("same")
    )
    return new.join(old, key, "full_outer").select(key, status.alias("status"))


def sync_report(diff: DataFrame) -> DataFrame:
    """Counters of one diff in one row."""
    return diff.agg(
        *[
            F.count_if(F.col("status") == s).alias(name)
            for s, name in (("new", "added"), ("removed", "removed"), ("changed", "changed"), ("same", "unchanged"))
        ]
    )


def vector_quality(vectors: DataFrame, dim: int, column: str = "embedding") -> DataFrame:
    """Counts of missing, wrongly sized and unusable vectors."""
    v = F.col(column)
    broken = F.exists(v, lambda x: x.isNull() | F.isnan(x))
    return vectors.agg(
        F.count("*").alias("rows"),
        F.count_if(v.isNull()).alias("missing"),
        F.count_if(F.size(v) != dim).alias("wrong_width"),
        F.count_if(broken).alias("broken"),
        F.count_if(F.forall(v, lambda x: x == 0)).alias("zero"),
    )


def sync_store(
    store: RowStore,
    incoming: DataFrame,
    sources: Sequence[str],
    encode: Callable[[DataFrame], DataFrame],
    detect_updates: bool = False,
) -> dict[str, int]:
    """Bring the rows of ``sources`` in ``store`` in step with ``incoming``.

    Only rows to be stored are encoded. ``incoming`` holds the metadata columns with unique
    ids; ``encode`` adds the vectors. Rows of other sources are left alone. With
    ``detect_updates`` rows whose text changed under the same id are stored again.
    """
    # read, keyed and made unique once, for the comparison as well as for the rows to store
    incoming = materialise(incoming, "incoming")
    hashed = incoming.select("id", content_hash("text").alias("hash"))
    current = store.read().where(F.col("source").isin(list(sources))).select("id", content_hash("text").alias("hash"))
    diff = materialise(snapshot_diff(hashed, current), "diff")
    counts = sync_report(diff).first().asDict()
    if not detect_updates:
        counts["changed"] = 0
    wanted = ["new", "changed"] if detect_updates else ["new"]
    if counts["added"] or counts["removed"] or counts["changed"]:
        fresh = incoming.join(diff.where(F.col("status").isin(wanted)), "id", "left_semi")
        store.apply(adds=encode(fresh), removes=diff.where("status = 'removed'"))
    return {"added": counts["added"], "removed": counts["removed"], "updated": counts["changed"]}
