"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(app: str = "vecloom", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-node session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


#: Bytes of an Arrow batch for a Python worker, so that its memory depends neither on the input's size nor on the rows' width.
BATCH_BYTES = 4 << 20


#: Tasks per core that ``spread`` deals rows over.
SPREAD = 4


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


#: Temporary roots of local sessions, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Root of the folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Where that is unset a local session gets a temporary folder; a cluster session is
    refused, because a machine-local folder there would lose data with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="vecloom-")
    return _LOCAL_ROOTS[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path (not yet created) below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df, label: str):
    """Cut lineage by writing ``df`` to the shared folder and reading it back."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df):
    """``df`` dealt over all cores, for costly work on each row of a small file: one row group is one task, however many rows it has."""
    return df.repartition(SPREAD * df.sparkSession.sparkContext.defaultParallelism)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context.

    Needed where it is neither installed on the executors nor given with ``--py-files``.
    """
    context = spark.sparkContext
    if getattr(context, "_vecloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="vecloom-"), "vecloom.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._vecloom_shipped = True
