"""Content keys: row ids, content hashes, chunk ids and 63-bit surrogates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import _col

KEY_SEP = "|"
CHUNK_KEY_CHARS = 64
POSITIVE_MASK = 0x7FFFFFFFFFFFFFFF


def _joined(parts: Sequence[Column]) -> Column:
    return F.concat_ws(KEY_SEP, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def row_id(columns: Sequence[Column | str]) -> Column:
    """SHA-1 of the key values; a null counts as an empty value."""
    if not columns:
        raise ValueError("no key column given: every row would get the same id")
    return F.sha1(_joined([_col(c) for c in columns]))


def content_hash(text: Column | str) -> Column:
    return F.sha1(F.coalesce(_col(text), F.lit("")))


def chunk_id(source, table_name, row, position, text) -> Column:
    """SHA-1 over where a chunk comes from and how it begins."""
    head = F.substring(_col(text), 1, CHUNK_KEY_CHARS)
    return F.sha1(_joined([_col(source), _col(table_name), _col(row), _col(position), head]))


def surrogate_key(c: Column | str) -> Column:
    """Stable non-negative BIGINT for a string id."""
    return F.xxhash64(_col(c)).bitwiseAND(F.lit(POSITIVE_MASK))


def key_collisions(df: DataFrame, id_col: str) -> DataFrame:
    """Surrogates shared by different ids; distinct pairs first, so repeats cost nothing."""
    pairs = df.select(F.col(id_col).alias("id"), surrogate_key(id_col).alias("idhash")).distinct()
    return pairs.groupBy("idhash").agg(F.count("*").alias("ids")).where("ids > 1")
