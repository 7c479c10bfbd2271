"""Exact dedup (10): a persistent digest index, bucketed and sorted by hash, extended by sort-merge anti-join.

Texts are equal when they are identical after each run of ASCII blanks is replaced by one space. The
index is a table of one row per distinct text, bucketed and sorted by the text's SHA-256. A batch of new rows is
grouped by digest, joined to the index bucket by bucket (the index side is never shuffled), and the digests that are
new are appended. Only digests and ids travel; texts are read once and never shuffled.

Defined results: a null text counts as empty; rows with equal text and equal id are both counted, and both
stay if that id is the smallest; a null id is larger than every other; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import table
from ..session import scratch
from .frames import partitions, salt, stored
from .registry import query

#: Folder of the number of buckets; Spark's readers pass over names that begin with "_".
META = "_buckets"
BLANKS = "[\\x20\\x09-\\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest`` of every row."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.sha2(normalised(F.col(text_col)).cast("binary"), 256).alias("digest")
    )


class DigestIndex:
    """A bucketed, sorted table ``(digest, keep_id)`` that only grows.

    The folder ``path`` is the index: its rows, and beside them the number of buckets, so that :meth:`open` needs the
    path alone, in any later session. ``name`` is only this session's name for it in the catalog; :meth:`forget` drops the
    name and leaves the folder. One writer at a time.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets

    @classmethod
    def create(cls, spark: SparkSession, path: str | None = None, name: str | None = None, buckets: int | None = None):
        index = cls(
            spark,
            name or f"digest_index_{uuid.uuid4().hex}",
            path or scratch(spark, "digest-index"),
            buckets or min(partitions(spark), 4096),
        )
        index._write(spark.range(0).select(F.col("id").cast("string").alias("digest"), F.col("id").alias("keep_id")), "errorifexists")
        spark.range(1).select(F.lit(index.buckets).alias("buckets")).write.parquet(f"{index.path}/{META}")
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str, name: str | None = None):
        """The index that an earlier session left in ``path``."""
        buckets = spark.read.schema("buckets int").parquet(f"{path}/{META}").first()["buckets"]
        index = cls(spark, name or f"digest_index_{uuid.uuid4().hex}", path, buckets)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE `{index.name}` (digest STRING, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        return index

    def forget(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.name}`")

    def _write(self, rows: DataFrame, mode: str) -> None:
        (
            rows.write.mode(mode)
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.name)
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, batch: DataFrame) -> None:
        """Add the digests of ``batch(digest, keep_id)`` that the index does not hold yet."""
        fresh = batch.hint("merge").join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        # the anti-join leaves rows dealt by digest; each bucket is one file of one task
        self._write(fresh.repartition(self.buckets, "digest"), "append")

    def add(self, digested: DataFrame) -> None:
        """Append the digests of new rows ``(doc_id, digest)``; the smallest id of a new digest is its ``keep_id``."""
        parts = digested.groupBy("digest", salt("doc_id").alias("salt")).agg(F.min("doc_id").alias("keep_id"))
        # written before the join, else the planner moves the anti-join below the grouping, onto all rows of a hot text
        self.append(stored(parts.groupBy("digest").agg(F.min("keep_id").alias("keep_id")), "digest-batch"))

    def resolve(self, digested: DataFrame) -> DataFrame:
        """Rows ``(doc_id, digest)`` whose digest the index holds, with ``keep_id`` and ``group_size`` (rows given here).

        The rows of one digest are dealt over salts, and the decision goes to those salts that it has.
        """
        rows = digested.withColumn("salt", salt("doc_id"))
        parts = rows.groupBy("digest", "salt").agg(F.count(F.lit(1)).alias("n"))
        totals = parts.groupBy("digest").agg(F.sum("n").alias("group_size"), F.collect_set("salt").alias("salts"))
        decided = totals.hint("merge").join(self.rows().hint("merge"), "digest")
        back = decided.withColumn("salt", F.explode("salts")).drop("salts")
        return rows.join(back, ["digest", "salt"]).drop("salt")


ORACLE = """
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


@query("op10_exact_dedup", ORACLE)
def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Whole ``documents`` in two batches by id, so that the second meets the digests of the first."""
    rows = stored(digests(table(spark, folder, "documents")), "digests")
    middle = rows.agg(((F.min("doc_id") + F.max("doc_id")) / 2).cast("long")).first()[0]
    index = DigestIndex.create(spark)
    later = F.coalesce(F.col("doc_id") > F.lit(middle), F.lit(True))
    index.add(rows.where(~later))
    index.add(rows.where(later))
    return index.resolve(rows).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256")
    )
