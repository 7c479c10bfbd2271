"""Sharding (1): balanced label propagation under capacity quotas, then an exact fill.

Documents that are linked get labels (shards) by propagation: in each round a document asks for the shard that holds most
of the weight of its links, and as many requests are granted per pair of shards as keep every shard within its
quota: requests in both directions are exchanged, the rest goes into free room. In a round either a star's leaves ask or its
hub does, so that the two never swap labels: half of the stars begin with the leaves, and all change over in the next round. Unlinked documents
have no edge to cut; they fill the shards up to counts that differ by at most one.

Links are a star per group of equal texts, not its pairs. A group larger than ``chunk`` rows is cut into chunks, each with
a star of its own, and the chunks' centres are linked to the group's centre; so a group larger
than a shard spreads over few shards.

Rounds read and write narrow tables of linked rows (id, label), each written to the shared folder. No
window holds a shard: rows are numbered per (shard, bucket) and bucket counts are added up.

Defined results: law ``rows``. A null text has size 1 and the CRC of the empty text, and is equal to the empty text; null and
repeated ids are kept, each row has one place; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import table
from .frames import buckets_for, gapless_rank, salt, stored
from .registry import query

SHARDS = 16
ROUNDS = 6
#: Stars that would fill a shard: a star holds at most the inverse of this of a shard's rows.
CHUNKS_PER_SHARD = 2


def star_edges(linked: DataFrame, chunk: int) -> DataFrame:
    """``src, dst, weight`` from rows ``(rid, digest, n)`` of groups: a star per chunk, chunk centres to the group's centre."""
    pieces = F.ceil(F.col("n") / F.lit(chunk)).cast("int")
    # hashing deals a group over its pieces; a group that fits is one piece
    rows = linked.withColumn("piece", F.pmod(F.xxhash64("rid"), pieces)).withColumn("_salt", salt("rid"))
    parts = rows.groupBy("digest", "piece", "_salt").agg(F.min("rid").alias("hub"))
    hubs = parts.groupBy("digest", "piece").agg(F.min("hub").alias("hub"), F.collect_set("_salt").alias("_salts"))
    back = hubs.withColumn("_salt", F.explode("_salts")).drop("_salts")
    leaves = rows.join(back, ["digest", "piece", "_salt"]).where("rid <> hub")
    tops = hubs.groupBy("digest").agg(F.min("hub").alias("top"))
    bridges = hubs.join(tops, "digest").where("hub <> top")
    return leaves.select(F.col("rid").alias("src"), F.col("hub").alias("dst"), F.lit(1.0).alias("weight")).unionByName(
        bridges.select(F.col("hub").alias("src"), F.col("top").alias("dst"), F.lit(0.5).alias("weight"))
    )


def propagate(nodes: DataFrame, edges: DataFrame, shards: int, quota: int, rounds: int = ROUNDS) -> DataFrame:
    """``rid, label`` for ``nodes(rid)`` under ``edges(src, dst, weight)``, at most about ``quota`` nodes per label.

    Every round costs one join of the edges with the labels and one aggregation by node; requests per pair of
    shards are ``shards`` squared numbers, from which the driver sets the granted share of each pair.
    """
    both = stored(edges.withColumn("hub", F.lit(False)).unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight", F.lit(True).alias("hub"))), "shard-edges")
    labels = stored(nodes.select("rid", F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int").alias("label")), "shard-labels")
    idle = False
    for turn in range(rounds):
        seen = labels.select(F.col("rid").alias("dst"), F.col("label").alias("near"))
        votes = both.join(seen, "dst").groupBy("src", "near").agg(F.sum("weight").alias("pull"), F.max("hub").alias("hub"), F.max("dst").alias("dst"))
        own = labels.withColumnRenamed("rid", "src")
        pulled = votes.join(own, "src").groupBy("src", "label").agg(
            F.max(F.struct("pull", (-F.abs(F.hash("src", "near", F.lit(turn)).cast("long"))).alias("tie"), "near")).alias("best"),
            F.sum(F.when(F.col("near") == F.col("label"), F.col("pull")).otherwise(0.0)).alias("stay"),
            F.max("hub").alias("hub"),
            F.max("dst").alias("dst"),  # of a leaf, its only neighbour
        )
        star = F.when(F.col("hub"), F.col("src")).otherwise(F.col("dst"))
        pulled = pulled.where(F.col("hub") == (F.pmod(F.xxhash64(star) + turn, F.lit(2)) == 1))
        asks = pulled.where((F.col("best.near") != F.col("label")) & (F.col("best.pull") > F.col("stay")))
        asks = stored(asks.select("src", "label", F.col("best.near").alias("wish")), "shard-asks")
        flows = {(r[0], r[1]): r[2] for r in asks.groupBy("label", "wish").count().collect()}  # at most shards^2 rows
        if not flows:
            if idle:  # neither leaves nor hubs ask
                break
            idle = True
            continue
        idle = False
        used = dict(labels.groupBy("label").count().collect())  # at most `shards` rows
        shares = granted(flows, [quota - used.get(s, 0) for s in range(shards)])
        rates = F.create_map(*[F.lit(x) for (a, b), p in shares.items() for x in (a * shards + b, float(p))])
        chance = F.pmod(F.xxhash64("src", F.lit(f"turn{turn}")), F.lit(1 << 30)) / F.lit(float(1 << 30))
        moved = asks.where(chance < F.element_at(rates, (F.col("label") * shards + F.col("wish")).cast("int")))
        moved = moved.select(F.col("src").alias("rid"), "wish")
        labels = labels.join(moved, "rid", "left").select("rid", F.coalesce("wish", "label").alias("label"))
        labels = stored(labels, "shard-labels")
    return labels


def granted(flows: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], float]:
    """Share of the requests of each (from, to) that keep quotas: exchanges first, then free room in equal parts."""
    swaps = {(a, b): min(n, flows.get((b, a), 0)) for (a, b), n in flows.items()}
    left = {k: n - swaps[k] for k, n in flows.items()}
    # what a shard takes beyond exchanges fits its room and what leaves it in turn: from all granted down to what holds
    rates = [1.0] * len(room)
    wanted = [sum(n for (_, b), n in left.items() if b == s) for s in range(len(room))]
    for _ in range(200):
        leaving = [sum(n * rates[b] for (a, b), n in left.items() if a == s) for s in range(len(room))]
        rates = [min(r, (max(0, m) + out) / max(1, w)) for r, m, out, w in zip(rates, room, leaving, wanted, strict=True)]
    return {(a, b): min(1.0, (swaps[a, b] + left[a, b] * rates[b]) / n) for (a, b), n in flows.items()}


def fill(rows: DataFrame, total: int, shards: int) -> DataFrame:
    """``rows(rid, label or null)`` with ``shard`` and ``slot``: counts at most one apart, slots gapless from 0.

    Labelled rows keep their shard up to its exact size; the rest, in one gapless order, take the free
    places in turn.
    """
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    buckets = buckets_for(total, shards)
    spread = F.pmod(F.xxhash64("rid"), F.lit(buckets))
    placed = gapless_rank(rows.where("label is not null"), "label", [F.col("rid")], spread, "slot")
    size_of = F.element_at(F.array(*[F.lit(n) for n in sizes]), F.col("label") + 1)
    placed = stored(placed.withColumn("fits", F.col("slot") < size_of), "shard-placed")
    held = dict(placed.where("fits").groupBy("label").count().collect())  # at most `shards` rows
    loose = rows.where("label is null").unionByName(placed.where("not fits").select(rows.columns))
    loose = loose.withColumn("all", F.lit(0))
    at = gapless_rank(loose, "all", [F.col("rid")], F.pmod(F.xxhash64("rid"), F.lit(buckets_for(total))), "turn")
    # places held..size of shard s are numbers starts[s].. of the loose rows' order
    shard, slot, start = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for s in range(shards):
        have = held.get(s, 0)
        inside = (F.col("turn") >= start) & (F.col("turn") < start + sizes[s] - have)
        shard = F.when(inside, F.lit(s)).otherwise(shard)
        slot = F.when(inside, F.col("turn") - start + have).otherwise(slot)
        start += sizes[s] - have
    keep = [c for c in rows.columns if c != "label"]
    return placed.where("fits").select(*keep, F.col("label").alias("shard"), "slot").unionByName(
        at.select(*keep, shard.alias("shard"), slot.alias("slot"))
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, linked`` per row of ``docs(doc_id, text)``."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = stored(
        docs.select(
            F.col("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.sha2(text, 256).alias("digest"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        "shard-rows",
    )
    total = rows.count()
    quota = -(-total // shards)
    salted = rows.withColumn("_salt", salt("rid"))
    parts = salted.groupBy("digest", "_salt").agg(F.count(F.lit(1)).alias("n"))
    groups = parts.groupBy("digest").agg(F.sum("n").alias("n"), F.collect_set("_salt").alias("_salts")).where("n > 1")
    back = groups.withColumn("_salt", F.explode("_salts")).drop("_salts")
    linked = stored(salted.join(back, ["digest", "_salt"]).select("rid", "digest", "n"), "shard-linked")
    edges = star_edges(linked, max(1, quota // CHUNKS_PER_SHARD))
    labels = propagate(linked, edges, shards, quota, rounds)
    labelled = stored(rows.join(labels, "rid", "left").drop("digest"), "shard-labelled")
    return fill(labelled, total, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op1_shard_documents")
def op1_shard_documents(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents"))
