"""DataFrame helpers shared by the operators: salted group totals, gapless ranks, released scratch tables."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch

#: Parts a group may be dealt over. A group of a third of all rows is then a hundredth per part.
SALTS = 32
#: Rows of one (shard, bucket) window when rows are numbered.
BUCKET_ROWS = 50_000


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that its lineage is cut.

    Shuffle files of the finished job are dropped as soon as the driver's JVM collects their handles;
    asking for that collection keeps the shuffle files of several phases from adding up on disk.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_in = path
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._stored_in)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def salt(*cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(SALTS)).cast("int")


def group_totals(df: DataFrame, keys: list[str], spread: list[str], aggs: dict[str, tuple[str, Column]]) -> DataFrame:
    """``df`` with one column per entry of ``aggs``, holding the aggregate over the rows of its group.

    ``aggs`` maps a new column to ``("min" | "sum", expression)``. Rows never meet by key alone: they are dealt
    by key and a salt made from ``spread``, salts are summed up in a second, small aggregation, and totals
    go back to those salts of a key that exist. Null keys form a group of their own.
    """
    fold = {"min": F.min, "sum": F.sum}
    salted = df.withColumn("_salt", salt(*spread))
    parts = salted.groupBy(*keys, "_salt").agg(*[fold[how](e).alias(n) for n, (how, e) in aggs.items()])
    totals = parts.groupBy(*keys).agg(
        *[fold[how](n).alias(n) for n, (how, _) in aggs.items()], F.collect_set("_salt").alias("_salts")
    )
    back = totals.withColumn("_salt", F.explode("_salts")).drop("_salts")
    back = back.select(*[F.col(c).alias(f"_r_{c}") for c in [*keys, "_salt"]], *aggs)
    on = [salted[c].eqNullSafe(back[f"_r_{c}"]) for c in keys] + [salted["_salt"] == back["_r__salt"]]
    return salted.join(back, on).drop("_salt", *[f"_r_{c}" for c in [*keys, "_salt"]])


def gapless_rank(df: DataFrame, group: str, order: list[Column], bucket: Column, rank: str) -> DataFrame:
    """``df`` with ``rank``: 0, 1, 2 ... within ``group``, by ``bucket`` and then ``order``.

    No window holds a whole group: rows are numbered per (group, bucket), and the number of rows in
    earlier buckets of the group is added. ``bucket`` is a non-negative whole number that spreads the
    rows; there are (groups x buckets) counts, which do not depend on the number of rows.
    """
    d = df.withColumn("_bucket", bucket)
    counts = d.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(group).alias("_g"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    own = Window.partitionBy(group, "_bucket").orderBy(*order)
    return (
        d.withColumn("_own", F.row_number().over(own) - 1)
        .join(starts, (F.col(group).eqNullSafe(F.col("_g"))) & (F.col("_bucket") == F.col("_b")))
        .withColumn(rank, (F.col("_own") + F.col("_start")).cast("long"))
        .drop("_bucket", "_own", "_g", "_b", "_start")
    )


def buckets_for(rows: int, groups: int = 1) -> int:
    return max(1, -(-rows // (BUCKET_ROWS * groups)))
