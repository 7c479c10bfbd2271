"""Top-k search over vector tables: exact, cluster-pruned and hashed.

Inputs are ``queries(query_id, query)`` and ``vectors(id, embedding)``. Scores are computed
as matrix blocks inside Arrow batches, and only a task's best k per query leave it; pairs are
never rows. Which side is shipped to all tasks depends on a checked row count:

* few queries: they are broadcast and the vectors scanned where they lie, no vector shuffled;
* few vectors: they are broadcast and each query is answered where it lies;
* both large: both sides are cut into blocks of bounded size and each pair of blocks is one
  group, so a crowded cluster or hash bucket is spread over many tasks.

Scores are rounded to nine digits before ranking, so that summation order cannot decide
between equal vectors; ties go to the lower id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.text import base_name, preview, strip_blanks
from ..session import materialise

METRICS = ("ip", "l2", "cosine")
SCORE_DIGITS = 9
MAX_BROADCAST_ROWS = 4096
MAX_BROADCAST_FLOATS = 8_000_000
BLOCK_ROWS = 20_000
# Scores held at a time by a task; batches are sliced to stay below it.
MAX_SCORES = 4_000_000
MAX_BITS = 40


def sliced(batch: pa.RecordBatch, other_rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` small enough to be scored against ``other_rows`` rows."""
    step = max(1, MAX_SCORES // max(1, other_rows))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


@dataclass(frozen=True)
class Matrix:
    """Keys and rows of a side small enough to ship to every task."""

    keys: pa.Array
    rows: np.ndarray
    extra: dict[str, list]


def _check(k: int, metric: str) -> None:
    if k < 1:
        raise ValueError("k must be at least 1")
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")


def to_matrix(column: pa.Array, dim: int | None = None) -> np.ndarray:
    """Arrow list column as an (n, dim) double matrix, failing on uneven widths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = dim if dim is not None else (len(flat) // n if n else 0)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths != width).any():
        raise ValueError(f"vectors differ in width: expected {width}")
    return flat.reshape(n, width).astype(np.float64)


def scores(q: np.ndarray, v: np.ndarray, metric: str) -> np.ndarray:
    """(queries x vectors) scores, larger is better; NaN where a cosine is undefined."""
    product = q @ v.T
    if metric == "l2":
        squared = (q * q).sum(1)[:, None] + (v * v).sum(1)[None, :] - 2.0 * product
        product = -np.maximum(squared, 0.0)
    elif metric == "cosine":
        lengths = np.sqrt((q * q).sum(1))[:, None] * np.sqrt((v * v).sum(1))[None, :]
        product = np.divide(product, lengths, out=np.full_like(product, np.nan), where=lengths > 0)
    return np.round(product, SCORE_DIGITS)


class _Best:
    """Running best k ids per query of one task."""

    def __init__(self, n_queries: int, k: int) -> None:
        self.k = k
        self.floor = np.full(n_queries, -np.inf)
        self.q = np.empty(0, np.int64)
        self.score = np.empty(0)
        self.ids: np.ndarray = np.empty(0, object)

    def add(self, s: np.ndarray, ids: np.ndarray) -> None:
        s = np.where(np.isnan(s), -np.inf, s)
        cut = self.floor
        if s.shape[1] > self.k:
            at = s.shape[1] - self.k
            cut = np.maximum(cut, np.partition(s, at, axis=1)[:, at])
        q, col = np.nonzero((s >= cut[:, None]) & (s > -np.inf))
        self.q = np.concatenate([self.q, q])
        self.score = np.concatenate([self.score, s[q, col]])
        self.ids = np.concatenate([self.ids, ids[col]]) if len(self.ids) else ids[col]
        if len(q):
            self._trim()

    def _trim(self) -> None:
        order = np.lexsort((self.ids, -self.score, self.q))
        q = self.q[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        order = order[place < self.k]
        self.q, self.score, self.ids = self.q[order], self.score[order], self.ids[order]
        last = place[place < self.k] == self.k - 1
        self.floor[self.q[last]] = self.score[last]


def _table(query_keys, ids, score, schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(query_keys, schema.field(0).type), pa.array(ids, schema.field(1).type), pa.array(score, pa.float64())], schema=schema)


def _arrow(kind: DataType) -> pa.DataType:
    if isinstance(kind, StringType):
        return pa.string()
    if isinstance(kind, LongType):
        return pa.int64()
    raise ValueError("keys must be BIGINT or STRING")


def _hit_schema(queries: DataFrame, vectors: DataFrame) -> tuple[pa.Schema, str]:
    q, v = queries.schema["query_id"].dataType, vectors.schema["id"].dataType
    arrow = pa.schema([("query_id", _arrow(q)), ("id", _arrow(v)), ("score", pa.float64())])
    return arrow, f"query_id {q.simpleString()}, id {v.simpleString()}, score double"


def small_matrix(df: DataFrame, key: str, vector: str, *extra: str) -> Matrix | None:
    """``df`` as a matrix when it has at most ``MAX_BROADCAST_ROWS`` rows and
    ``MAX_BROADCAST_FLOATS`` numbers, else None. No more rows than that, plus one, reach the
    driver. ``extra`` columns are kept beside the keys."""
    got = df.select(key, F.col(vector).cast("array<double>").alias("v"), *extra).limit(MAX_BROADCAST_ROWS + 1).toArrow()
    if got.num_rows > MAX_BROADCAST_ROWS:
        return None
    rows = to_matrix(got.column(1))
    if rows.size > MAX_BROADCAST_FLOATS:
        return None
    return Matrix(got.column(0).combine_chunks(), rows, {name: got.column(name).to_pylist() for name in extra})


def top_k(
    queries: DataFrame, vectors: DataFrame, k: int = 10, metric: str = "ip", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Exact ``(query_id, id, score, rank)``: inner product and cosine descending, squared L2
    ascending. Fewer than k rows where there are fewer vectors; zero vectors have no cosine.
    A repeated ``query_id`` is refused: its rows could not be told apart in the result."""
    _check(k, metric)
    queries = queries.select("query_id", "query").where("query is not null")
    refuse_repeats(queries, "query_id")
    vectors = vectors.select("id", "embedding").where("embedding is not null")
    few = small_matrix(queries, "query_id", "query")
    if few is not None:
        return _ranked(_scan_vectors(few, queries, vectors, k, metric), k, metric)
    few = small_matrix(vectors, "id", "embedding")
    if few is not None:
        return _signed(_scan_queries(few, queries, vectors, k, metric), metric)
    cell = F.lit(0).alias("cell")
    return _ranked(
        _blocked(queries.select("*", cell), vectors.select("*", cell), k, metric, block_rows), k, metric
    )


def refuse_repeats(df: DataFrame, key: str) -> None:
    repeated = df.groupBy(key).count().where("count > 1").select(key).first()
    if repeated is not None:
        raise ValueError(f"{key} {repeated[0]!r} stands in several rows")


def _ranked(hits: DataFrame, k: int, metric: str) -> DataFrame:
    """Merge the tasks' candidates, whose number depends on k and the tasks, not on the data."""
    w = W.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return _signed(hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k), metric)


def _signed(best: DataFrame, metric: str) -> DataFrame:
    return best.withColumn("score", F.lit(0.0) - F.col("score")) if metric == "l2" else best


def _scan_vectors(few: Matrix, queries: DataFrame, vectors: DataFrame, k: int, metric: str, allowed=None) -> DataFrame:
    """Broadcast queries; ``allowed(batch)`` may give a (queries x rows) mask of pairs to score."""
    arrow, ddl = _hit_schema(queries, vectors)
    shared = vectors.sparkSession.sparkContext.broadcast(few)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        best = _Best(len(m.keys), k)
        for batch in batches if len(m.keys) else ():
            for part in sliced(batch, len(m.keys)):
                s = scores(m.rows, to_matrix(part.column("embedding"), m.rows.shape[1]), metric)
                if allowed is not None:
                    s = np.where(allowed(part), s, np.nan)
                best.add(s, part.column("id").to_numpy(zero_copy_only=False))
        out = _table(m.keys.take(pa.array(best.q)), best.ids, best.score, arrow)
        yield from out.to_batches()

    return vectors.mapInArrow(scan, ddl)


def _scan_queries(few: Matrix, queries: DataFrame, vectors: DataFrame, k: int, metric: str) -> DataFrame:
    """Broadcast vectors: ranks are final in the task, so nothing is shuffled."""
    arrow, ddl = _hit_schema(queries, vectors)
    ranked = arrow.append(pa.field("rank", pa.int32()))
    shared = queries.sparkSession.sparkContext.broadcast(few)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        ids = m.keys.to_numpy(zero_copy_only=False)
        for batch in batches if len(ids) else ():
            for part in sliced(batch, len(ids)):
                best = _Best(part.num_rows, k)
                best.add(scores(to_matrix(part.column("query"), m.rows.shape[1]), m.rows, metric), ids)
                keys = part.column("query_id").take(pa.array(best.q))
                rank = np.arange(1, len(best.q) + 1) - np.searchsorted(best.q, best.q)
                hits = _table(keys, best.ids, best.score, arrow)
                yield from hits.append_column(ranked.field("rank"), pa.array(rank, pa.int32())).to_batches()

    return queries.mapInArrow(scan, ddl + ", rank int")


def _blocked(queries: DataFrame, vectors: DataFrame, k: int, metric: str, block_rows: int) -> DataFrame:
    """Top-k within equal ``cell`` for two large sides.

    A cell with n queries and m vectors becomes ceil(n/b) x ceil(m/b) groups, each holding about b
    rows a side, whatever share of the data the cell has.
    """
    arrow, ddl = _hit_schema(queries, vectors)

    def blocks(df: DataFrame, name: str) -> DataFrame:
        n = F.ceil(F.count("*") / F.lit(block_rows)).cast("int")
        return df.groupBy("cell").agg(n.alias(name))

    # one row per probed cell, known in size once written: Spark broadcasts it where it is small
    grid = materialise(blocks(queries, "nq").join(blocks(vectors, "nv"), "cell"), "grid")

    def spread(df: DataFrame, key: str, own: str, other: str, own_block: str, other_block: str) -> DataFrame:
        cut = df.join(grid, "cell").withColumn(own_block, F.pmod(F.xxhash64(key), F.col(own)).cast("int"))
        copies = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return cut.withColumn(other_block, copies).select("cell", "qb", "vb", *df.drop("cell").columns)

    left = spread(queries, "query_id", "nq", "nv", "qb", "vb")
    right = spread(vectors, "id", "nv", "nq", "vb", "qb")

    def score_group(q: pa.Table, v: pa.Table) -> pa.Table:
        if not q.num_rows or not v.num_rows:
            return arrow.empty_table()
        qm = to_matrix(q.column("query"))
        ids = v.column("id").combine_chunks().to_numpy(zero_copy_only=False)
        best = _Best(q.num_rows, k)
        step = max(1, MAX_SCORES // q.num_rows)
        for start in range(0, v.num_rows, step):
            part = to_matrix(v.column("embedding").slice(start, step), qm.shape[1])
            best.add(scores(qm, part, metric), ids[start : start + step])
        return _table(q.column("query_id").combine_chunks().take(pa.array(best.q)), best.ids, best.score, arrow)

    grouped = left.groupBy("cell", "qb", "vb").cogroup(right.groupBy("cell", "qb", "vb"))
    return grouped.applyInArrow(score_group, ddl)


# cluster-pruned search


def train_centroids(vectors: DataFrame, cells: int, seed: int = 42) -> np.ndarray:
    """k-means centres of the whole table; ``cells`` x dim doubles on the driver."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = vectors.where("embedding is not null").select("embedding")
    n = rows.count()
    features = rows.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = KMeans(k=max(1, min(cells, n)), seed=seed, maxIter=10).fit(features)
    return np.array(model.clusterCenters())


def nearest_cells(df: DataFrame, vector: str, centroids: np.ndarray, n: int) -> DataFrame:
    """``df`` plus ``cells``, the n nearest centroids of each row, nearest first."""
    shared = df.sparkSession.sparkContext.broadcast(centroids)
    n = min(n, len(centroids))
    schema = StructType([*df.schema.fields, StructField("cells", ArrayType(IntegerType()))])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in sliced(b, len(shared.value))):
            s = scores(to_matrix(batch.column(vector), shared.value.shape[1]), shared.value, "l2")
            nearest = np.argsort(-s, axis=1, kind="stable")[:, :n].astype(np.int32)
            cells = pa.ListArray.from_arrays(
                pa.array(np.arange(0, nearest.size + 1, n, dtype=np.int32)), pa.array(nearest.ravel())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=[*batch.schema.names, "cells"])

    return df.mapInArrow(assign, schema)


class CellIndex:
    """Vectors laid out by nearest centroid under ``path``; a search reads only probed cells."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        rows = spark.read.parquet(f"{path}/centroids").orderBy("cell").collect()
        self.centroids = np.array([r["centre"] for r in rows])
        self.cells = spark.read.parquet(f"{path}/cells")

    @staticmethod
    def build(vectors: DataFrame, path: str, cells: int = 4096, seed: int = 42) -> "CellIndex":
        spark = vectors.sparkSession
        centroids = train_centroids(vectors, cells, seed=seed)
        spark.createDataFrame(
            [(i, [float(x) for x in c]) for i, c in enumerate(centroids)], "cell int, centre array<double>"
        ).write.mode("overwrite").parquet(f"{path}/centroids")
        rows = vectors.select("id", "embedding").where("embedding is not null")
        placed = nearest_cells(rows, "embedding", centroids, 1).withColumn("cell", F.element_at("cells", 1))
        # rebalanced by cell: few files per cell, and a crowded cell over several tasks
        placed = placed.drop("cells").hint("rebalance", F.col("cell"))
        placed.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/cells")
        return CellIndex(spark, path)

    def search(
        self, queries: DataFrame, k: int = 10, nprobe: int = 16, metric: str = "ip", block_rows: int = BLOCK_ROWS
    ) -> DataFrame:
        """Approximate top-k from the ``nprobe`` nearest cells; exact when all cells are probed."""
        _check(k, metric)
        queries = queries.select("query_id", "query").where("query is not null")
        refuse_repeats(queries, "query_id")
        probing = nearest_cells(queries, "query", self.centroids, nprobe)
        few = small_matrix(queries, "query_id", "query")
        if few is None:
            spread = probing.select("query_id", "query", F.explode("cells").alias("cell"))
            return _ranked(_blocked(spread, self.cells, k, metric, block_rows), k, metric)
        near = np.argsort(-scores(few.rows, self.centroids, "l2"), axis=1, kind="stable") if len(few.keys) else np.empty((0, 0), int)
        probes = np.zeros((len(few.keys), len(self.centroids)), bool)
        np.put_along_axis(probes, near[:, :nprobe], True, axis=1)
        shared = self.spark.sparkContext.broadcast(probes)
        wanted = [int(c) for c in np.nonzero(probes.any(axis=0))[0]]

        def allowed(batch: pa.RecordBatch) -> np.ndarray:
            return shared.value[:, batch.column("cell").to_numpy(zero_copy_only=False)]

        scanned = self.cells.where(F.col("cell").isin(wanted))
        return _ranked(_scan_vectors(few, queries, scanned, k, metric, allowed), k, metric)


# hashed candidates


def signatures(df: DataFrame, vector: str, tables: int, bits: int, seed: int, probes: int = 1) -> DataFrame:
    """``df`` with one row per hash table and probed bucket, ``cell`` holding both numbers.

    A bucket is the side of ``bits`` random hyperplanes a vector lies on. Further probes flip the
    side of the plane the vector is nearest to, then the next nearest, and so on.
    """
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"bits must be at most {MAX_BITS}")
    schema = StructType([*df.schema.fields, StructField("cell", LongType())])
    probes = min(probes, bits + 1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        weight = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            m = to_matrix(batch.column(vector))
            if planes is None:
                planes = np.random.default_rng(seed).standard_normal((m.shape[1], tables * bits))
            margin = (m @ planes).reshape(len(m), tables, bits)
            code = ((margin > 0) * weight).sum(axis=2)
            nearest = np.argsort(np.abs(margin), axis=2, kind="stable")
            for t in range(tables):
                for p in range(probes):
                    probed = code[:, t] if p == 0 else code[:, t] ^ weight[nearest[:, t, p - 1]]
                    cell = pa.array(probed | (t << MAX_BITS), pa.int64())
                    yield pa.RecordBatch.from_arrays([*batch.columns, cell], names=[*batch.schema.names, "cell"])

    return df.mapInArrow(sign, schema)


def hashed_top_k(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 10,
    metric: str = "ip",
    tables: int = 16,
    bits: int = 8,
    probes: int = 4,
    seed: int = 42,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Approximate top-k among vectors sharing a hash bucket with the query in some table.

    More bits mean fewer candidates; more tables, and more buckets a query probes per table, a
    better recall. A candidate met several times counts once.
    """
    _check(k, metric)
    queries = queries.select("query_id", "query").where("query is not null")
    refuse_repeats(queries, "query_id")
    vectors = vectors.select("id", "embedding").where("embedding is not null")
    near = _blocked(
        signatures(queries, "query", tables, bits, seed, probes),
        signatures(vectors, "embedding", tables, bits, seed),
        k,
        metric,
        block_rows,
    )
    return _ranked(near.groupBy("query_id", "id").agg(F.max("score").alias("score")), k, metric)


# queries, hits and results


def query_table(df: DataFrame, text: str = "q") -> DataFrame:
    """Queries with their text stripped, blank ones dropped."""
    return df.withColumn(text, strip_blanks(text)).where(F.col(text) != "")


def with_metadata(hits: DataFrame, chunks: DataFrame, max_hits: int | None = None) -> DataFrame:
    """Attach chunk metadata to hits after ranking; hits without metadata go.

    ``max_hits`` is the caller's bound on the number of hits (queries x k); up to a million of
    them are broadcast, so that the chunk table is scanned and not shuffled.
    """
    if max_hits is not None and max_hits <= 1_000_000:
        hits = F.broadcast(hits)
    joined = chunks.select("id", "source", "table_name", "row_id", "position", "text").join(hits, "id")
    return joined.withColumns(
        {"position": F.coalesce("position", F.lit(0)), "text": F.coalesce("text", F.lit(""))}
    )


def result_rows(hits: DataFrame) -> DataFrame:
    """Terminal form: score with four digits, a preview of 160 characters."""
    return hits.select(
        "query_id",
        "rank",
        F.format_string("%.4f", "score").alias("score"),
        F.coalesce("table_name", F.lit("")).alias("table_name"),
        F.coalesce("row_id", F.lit("")).alias("row_id"),
        preview("text").alias("preview"),
    )


def result_cards(hits: DataFrame) -> DataFrame:
    """Card form: title, two-digit score, a preview of 400 characters."""
    origin = F.coalesce(F.nullif("source", F.lit("")), F.nullif("table_name", F.lit("")), F.lit("Result"))
    return hits.select(
        "query_id",
        "rank",
        base_name(origin).alias("title"),
        origin.alias("origin"),
        F.round("score", 2).alias("score"),
        preview("text", 400, "...").alias("preview"),
    )


def result_documents(hits: DataFrame, queries: DataFrame, text: str = "q") -> DataFrame:
    """One nested ``(query_id, query, results)`` per query, results in rank order, none as []."""
    item = F.struct(
        "rank",
        F.struct(
            "id", "score", "source", "table_name", "row_id", "position", preview("text").alias("preview")
        ).alias("hit"),
    )
    lists = hits.groupBy("query_id").agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["hit"]).alias("results"))
    empty = F.array().cast(lists.schema["results"].dataType)
    return queries.select("query_id", F.col(text).alias("query")).join(lists, "query_id", "left").select(
        "query_id", "query", F.coalesce("results", empty).alias("results")
    )
