"""Column profiling: which columns hold text, and which identify a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.keys import content_hash, row_id
from ..functions.text import build_text, kept, quoted

# Columns taken first when they qualify, and the default key columns.
PREFERRED_TEXT = (
    "_source.file_name_text",
    "_source.product_name_text",
    "_source.project_name_text",
    "_source.asset_type_name",
    "_source.customer",
)
PREFERRED_KEYS = ("_id", "_source.assetResourceId", "_source.file_name_text", "_source.filename")

# Texts that a CSV reader takes for numbers or flags.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(?i:inf|infinity)\s*$"
FLAGS = ("True", "TRUE", "true", "False", "FALSE", "false")

SAMPLE_ROWS = 200
MIN_AVG_LEN = 5
MIN_DISTINCT_CAP = 2000
DISTINCT_SHARE = 0.9
MAX_COLUMNS = 12
_SAMPLE_SALTS = 64
_LONG_VALUE = 64


def profile_columns(df: DataFrame, ordinal: Column | str, columns: Sequence[str] | None = None) -> DataFrame:
    """Per string column: ``non_null``, ``distinct``, ``avg_len`` of the first values in
    ``ordinal`` order, ``candidate``, and its ``rank`` among the picked columns (null if not).

    A column holding nothing but numbers, or nothing but flags, is no text column even when it
    was read as STRING. One narrow unpivot feeds two aggregations. Distinct values are counted in two steps,
    long ones by their digest, so neither a frequent value nor a wide one burdens a task.
    """
    ordinal = F.col(ordinal) if isinstance(ordinal, str) else ordinal
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    columns = [c for c in strings if columns is None or c in columns]
    slots = [f"c{i}" for i in range(len(columns))]
    named = df.select(ordinal.alias("ord"), *[quoted(c).alias(s) for c, s in zip(columns, slots)])
    cells = named.unpivot("ord", slots, "slot", "value").where("value is not null")

    long_value = F.length("value") > _LONG_VALUE
    digest = F.when(long_value, F.concat(F.lit("#"), F.sha1("value"), F.length("value"))).otherwise(F.col("value"))
    counted = (
        cells.groupBy("slot", digest.alias("digest"))
        .agg(
            F.count("*").alias("n"),
            F.bool_and(F.col("value").rlike(NUMBER)).alias("numbers"),
            F.bool_and(F.col("value").isin(*FLAGS)).alias("flags"),
        )
        .groupBy("slot")
        .agg(
            F.sum("n").alias("non_null"),
            F.count("*").alias("distinct"),
            F.bool_and("numbers").alias("numbers"),
            F.bool_and("flags").alias("flags"),
        )
    )

    lens = cells.select("ord", "slot", F.length("value").alias("len"))
    salted = W.partitionBy("slot", F.pmod(F.xxhash64("ord"), F.lit(_SAMPLE_SALTS))).orderBy("ord")
    merged = W.partitionBy("slot").orderBy("ord")
    head = lens.withColumn("rn", F.row_number().over(salted)).where(f"rn <= {SAMPLE_ROWS}")
    head = head.withColumn("rn", F.row_number().over(merged)).where(f"rn <= {SAMPLE_ROWS}")
    sampled = head.groupBy("slot").agg(F.avg("len").alias("avg_len"))

    limit = F.greatest(F.lit(MIN_DISTINCT_CAP), F.floor(F.col("non_null") * DISTINCT_SHARE))
    text_like = ~(F.col("numbers") | F.col("flags"))
    stats = counted.join(sampled, "slot").withColumn(
        "candidate", text_like & (F.col("distinct") <= limit) & (F.col("avg_len") >= MIN_AVG_LEN)
    )
    order = [c for c in PREFERRED_TEXT if c in columns] + [c for c in columns if c not in PREFERRED_TEXT]
    name = F.get(F.array(*[F.lit(c) for c in columns]), F.substring("slot", 2, 9).cast("int"))
    stats = stats.withColumn("column", name)
    place = F.array_position(F.array(*[F.lit(c) for c in order]), F.col("column"))
    # a handful of rows by now, one per column
    position = F.when(F.col("candidate"), F.row_number().over(W.partitionBy("candidate").orderBy(place)))
    return stats.select(
        "column",
        "non_null",
        "distinct",
        "avg_len",
        "candidate",
        F.when(position <= MAX_COLUMNS, position).alias("rank"),
    )


def pick_text_columns(df: DataFrame, ordinal: Column | str, override: Sequence[str] | None = None) -> list[str]:
    """Names of the text columns, in order; ``override`` keeps its existing names and profiles nothing."""
    if override:
        return [c for c in override if c in df.columns]
    picked = profile_columns(df, ordinal).where("rank is not null").orderBy("rank").select("column")
    return [r["column"] for r in picked.collect()]


def pick_key_columns(columns: Sequence[str], override: Sequence[str] | None = None) -> list[str]:
    """Key columns by name. An override that matches nothing is an error: all rows would share one id."""
    if override:
        keys = [c for c in override if c in columns]
        if not keys:
            raise ValueError(f"none of the key columns {list(override)} exists")
        return keys
    return [c for c in PREFERRED_KEYS if c in columns] or [columns[0]]


def keyed_texts(
    df: DataFrame, text_columns: Sequence[str], key_columns: Sequence[str], min_text_len: int, keep: Sequence[str] = ()
) -> DataFrame:
    """``(id, text, hash)`` of rows with enough text; short rows go before ids are made."""
    texts = df.select(
        *[quoted(c) for c in dict.fromkeys([*key_columns, *keep])],
        kept(build_text([quoted(c) for c in text_columns]), lambda t: F.length(t) >= min_text_len).alias("__text__"),
    )
    return texts.select(
        row_id([quoted(c) for c in key_columns]).alias("id"),
        F.col("__text__").alias("text"),
        content_hash("__text__").alias("hash"),
        *[quoted(c) for c in keep],
    )
