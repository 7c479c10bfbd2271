"""Versioned Parquet row store: vectors and metadata under one id.

A commit is one small manifest file, created atomically; it names the data folders that are
live. An upsert or delete writes only what changed: new rows, and the ids they supersede.
Readers leave out superseded rows with an anti-join on those ids and see one commit
throughout. ``compact`` folds everything into one folder again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

META_SCHEMA = "id string, source string, table_name string, row_id string, position int, text string"
ROW_SCHEMA = META_SCHEMA + ", embedding array<float>"
ROW_COLUMNS = ["id", "source", "table_name", "row_id", "position", "text", "embedding"]


def tie_break(df: DataFrame) -> Column:
    """A hash of a row's contents (maps and variants apart): settles equal positions alike in every run."""
    kinds = ("map", "variant")
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not any(k in f.dataType.simpleString() for k in kinds)])


def last_wins(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """One row per key, the one with the highest ``seq``, of equal ones the one with the highest content hash.
    Spark limits groups before the shuffle, so many copies of one key do not meet in a task."""
    w = W.partitionBy(*keys).orderBy(F.col(seq).desc(), tie_break(df).desc())
    return df.withColumn("__rn__", F.row_number().over(w)).where("__rn__ = 1").drop("__rn__")


class RowStore:
    """Rows keyed by ``id`` below ``path``; ``dim`` fixes the vector width."""

    def __init__(self, spark: SparkSession, path: str, dim: int | None = None) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._hpath = jvm.org.apache.hadoop.fs.Path
        self._fs = self._hpath(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        stored = self._manifest()["dim"]
        if dim is not None and stored is not None and dim != stored:
            raise ValueError(f"store holds {stored}-wide vectors, not {dim}")
        self.dim = dim if dim is not None else stored

    # manifests

    def version(self) -> int:
        folder = self._hpath(f"{self.path}/_commits")
        if not self._fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def _manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version == 0:
            return {"version": 0, "dim": None, "rows": [], "gone": []}
        stream = self._fs.open(self._hpath(f"{self.path}/_commits/{version:010d}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, base: dict, rows: list[str], gone: list[str]) -> int:
        """Publish the next version; a writer that lost the race gets an error and may retry."""
        version = base["version"] + 1
        body = json.dumps({"version": version, "dim": self.dim, "rows": rows, "gone": gone}).encode()
        stream = self._fs.create(self._hpath(f"{self.path}/_commits/{version:010d}"), False)
        try:
            stream.write(bytearray(body))
        finally:
            stream.close()
        return version

    def _write(self, df: DataFrame, kind: str, version: int) -> str:
        name = f"{kind}/{version:010d}-{uuid.uuid4().hex}"
        df.withColumn("v", F.lit(version)).write.parquet(f"{self.path}/{name}")
        return name

    def _checked(self, df: DataFrame) -> DataFrame:
        """The fixed columns, failing on a vector of the wrong width while it is written."""
        if self.dim is not None:
            message = F.concat(
                F.lit(f"vector is not {self.dim} wide: id "), F.coalesce(F.col("id"), F.lit("null"))
            )
            width = F.when(F.size("embedding") == self.dim, F.col("embedding")).otherwise(F.raise_error(message))
            df = df.withColumn("embedding", width)
        return df.select(*ROW_COLUMNS)

    # reads

    def _live(self, manifest: dict) -> DataFrame:
        if not manifest["rows"]:
            return self.spark.createDataFrame([], ROW_SCHEMA + ", v int")
        rows = self.spark.read.schema(ROW_SCHEMA + ", v int").parquet(*[f"{self.path}/{r}" for r in manifest["rows"]])
        if not manifest["gone"]:
            return rows
        gone = (
            self.spark.read.schema("id string, v int")
            .parquet(*[f"{self.path}/{g}" for g in manifest["gone"]])
            .groupBy(F.col("id").alias("gone_id"))
            .agg(F.max("v").alias("gone_v"))
        )
        return rows.join(gone, (F.col("id") == F.col("gone_id")) & (F.col("v") < F.col("gone_v")), "left_anti")

    def read(self, version: int | None = None) -> DataFrame:
        """Current rows, or those of an earlier version; empty when nothing was stored."""
        return self._live(self._manifest(version)).drop("v")

    def ids(self, source: str | None = None) -> DataFrame:
        rows = self.read()
        return (rows if source is None else rows.where(F.col("source") == source)).select("id")

    # writes

    def apply(self, adds: DataFrame | None = None, removes: DataFrame | None = None) -> int:
        """One commit: drop the ids of ``removes``, then store ``adds`` (unique ids), replacing
        rows that have the same id. Returns the new version."""
        base = self._manifest()
        version = base["version"] + 1
        rows, gone = list(base["rows"]), list(base["gone"])
        if adds is not None:
            rows.append(self._write(self._checked(adds), "rows", version))
        if base["rows"]:
            touched = [removes.select("id")] if removes is not None else []
            if adds is not None:
                touched.append(self.spark.read.parquet(f"{self.path}/{rows[-1]}").select("id"))
            if touched:
                ids = touched[0] if len(touched) == 1 else touched[0].unionByName(touched[1])
                present = self._live(base).select("id").join(ids, "id", "left_semi")
                gone.append(self._write(present, "gone", version))
        return self._commit(base, rows, gone)

    def upsert(self, df: DataFrame, seq: str) -> int:
        """Store rows, the highest ``seq`` winning within the batch and over older rows."""
        return self.apply(adds=last_wins(df, ["id"], seq))

    def delete(self, ids: DataFrame) -> int:
        """Remove ids; returns how many rows really went."""
        if not self._manifest()["rows"]:
            return 0
        version = self.apply(removes=ids.select("id"))
        return self.spark.read.parquet(f"{self.path}/{self._manifest(version)['gone'][-1]}").count()

    def replace(self, df: DataFrame, source: str | None = None) -> int:
        """Full load: the rows of ``source`` (of the whole store when null) become ``df``."""
        base = self._manifest()
        version = base["version"] + 1
        if source is not None and base["rows"]:
            return self.apply(adds=df, removes=self.ids(source))
        return self._commit(base, [self._write(self._checked(df), "rows", version)], [])

    def compact(self) -> int:
        base = self._manifest()
        live = self._live(base).drop("v")
        return self._commit(base, [self._write(live, "rows", base["version"] + 1)], [])
