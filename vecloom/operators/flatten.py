"""Nested documents to flat paths.

A record is unrolled inside the row: each level replaces every object or mixed list in an
array of ``(path, value)`` entries by its children. There is no shuffle, neither for the long
form (one ``inline``) nor for the wide one (entries placed by their path's ordinal, any number of columns). How many levels are needed is
read from the data by one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, FloatType, StringType, StructField, StructType

from ..functions.text import quoted
from ..session import materialise

#: Cells of a wide table that a task holds at once.
CELLS = 1 << 20


def float_text(d: Column) -> Column:
    """A double the way ``repr`` prints it: plain from 1e-4 up to 1e16, else with an exponent."""
    text = d.cast("string")
    plain = text.cast("decimal(38,21)").cast("string")
    plain = F.regexp_replace(F.regexp_replace(plain, "0+$", ""), r"\.$", ".0")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    exponent = F.substring_index(text, "E", -1).cast("int")
    digits = F.abs(exponent).cast("string")
    digits = F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)
    scientific = F.concat(mantissa, F.when(exponent < 0, "e-").otherwise("e+"), digits)
    size = F.abs(d)
    in_plain_range = (size == 0) | ((size >= 1e-4) & (size < 1e16))
    special = F.when(F.isnan(d), "nan").when(d == float("inf"), "inf").when(d == float("-inf"), "-inf")
    return F.coalesce(special, F.when(in_plain_range, plain).otherwise(scientific))


def scalar_text(v: Column, kind: Column) -> Column:
    """Text of a scalar VARIANT of the given kind; JSON null gives null."""
    # whole numbers are BIGINT up to 18 digits, so a short DECIMAL without a fraction was "1.0"
    is_float = (kind == "DOUBLE") | kind.rlike(r"^DECIMAL\((\d+,[1-9]\d*|([1-9]|1[0-8]),0)\)$")
    as_text = F.try_variant_get(v, "$", "string")
    return (
        F.when(kind.isin("STRING", "BIGINT"), as_text)
        .when(kind == "BOOLEAN", F.initcap(as_text))
        .when(is_float, float_text(F.try_variant_get(v, "$", "double")))
        .otherwise(as_text)
    )


def _object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _entry(path: Column, v: Column) -> Column:
    """An entry carries its kind, so that it is looked at once and not at every level."""
    return F.struct(path.alias("path"), v.alias("v"), F.schema_of_variant(v).alias("kind"))


def _nested(kind: Column) -> Column:
    return kind.startswith("OBJECT") | kind.startswith("ARRAY")


def _children(e: Column, sep: str) -> Column:
    """Entries one level below ``e``; a leaf stays as it is."""
    path, v, kind = e["path"], e["v"], e["kind"]
    below = F.transform(
        F.map_entries(_object(v)),
        lambda kv: _entry(F.when(path == "", kv["key"]).otherwise(F.concat(path, F.lit(sep), kv["key"])), kv["value"]),
    )
    indexed = F.transform(_list(v), lambda x, i: _entry(F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), x))
    # a list of mixed kinds has to be looked into
    mixed = (kind == "ARRAY<VARIANT>") & F.exists(_list(v), lambda x: _nested(F.schema_of_variant(x)))
    deep = kind.startswith("ARRAY<OBJECT") | kind.startswith("ARRAY<ARRAY") | mixed
    return F.when(kind.startswith("OBJECT"), below).when(deep, indexed).otherwise(F.array(e))


def _leaf_text(v: Column, kind: Column) -> Column:
    def item(x: Column) -> Column:
        return F.coalesce(scalar_text(x, F.schema_of_variant(x)), F.lit("None"))

    joined = F.array_join(F.transform(_list(v), item), ", ")
    return F.when(kind.startswith("ARRAY"), joined).otherwise(scalar_text(v, kind))


def depth(df: DataFrame, column: str = "v") -> int:
    """Deepest nesting of any record, counted on the brackets of its JSON text; one aggregate.

    The merged schema of a record would not do: it stops at lists of mixed kinds.
    """
    unescaped = F.regexp_replace(F.to_json(F.col(column)), r"\\.", "")
    brackets = F.regexp_replace(unescaped, r'"[^"]*"|[^\[\]{}"]+', "")  # runs at once, not character by character
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def add(acc: Column, m: Column) -> Column:
        now = acc["now"] + F.when(m.isin("[", "{"), 1).when(m.isin("]", "}"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    most = F.aggregate(F.split(brackets, ""), zero, add, lambda acc: acc["most"])
    return df.agg(F.max(most)).first()[0] or 0


def leaves(column: str, levels: int, sep: str = ".") -> Column:
    """Flat ``array<(path, v, kind)>`` of a VARIANT record, empty objects leaving nothing."""
    flat = F.array(_entry(F.lit(""), F.col(column)))
    for _ in range(levels):
        flat = F.flatten(F.transform(flat, lambda e: _children(e, sep)))
    # an object still here has no keys
    return F.filter(flat, lambda e: ~e["kind"].startswith("OBJECT"))


def entries(column: str, levels: int, sep: str = ".") -> Column:
    """Flat ``array<(path, value)>`` of a VARIANT record, as ``leaves``."""
    text = lambda e: F.struct(e["path"].alias("path"), _leaf_text(e["v"], e["kind"]).alias("value"))
    return F.transform(leaves(column, levels, sep), text)


def flatten_long(df: DataFrame, key: str = "rec_id", column: str = "v", levels: int | None = None, sep: str = ".") -> DataFrame:
    """``(key, path, value)``, the form to use when keys are open-ended."""
    levels = depth(df, column) if levels is None else levels
    # numbered names inside, as the key may be called like a part of an entry; a leaf's text is compiled only outside of a lambda
    rows = df.select(F.col(key), F.inline(leaves(column, levels, sep))).toDF("c0", "c1", "c2", "c3")
    return rows.select(F.col("c0").alias(key), F.col("c1").alias("path"), _leaf_text(F.col("c2"), F.col("c3")).alias("value"))


def paths_of(df: DataFrame, column: str = "v", levels: int | None = None, sep: str = ".") -> list[str]:
    """All paths in sorted order."""
    levels = depth(df, column) if levels is None else levels
    return _distinct_paths(df.select(entries(column, levels, sep).alias("e")), "e")


def _distinct_paths(df: DataFrame, column: str) -> list[str]:
    paths = df.select(F.explode(F.transform(column, lambda e: e["path"])).alias("path")).distinct()
    return sorted(r["path"] for r in paths.collect())  # the table's header, however wide


def aligned(found: DataFrame, paths: Sequence[str]) -> DataFrame:
    """``found(key, entries)`` with one STRING column per path instead of the entries; the last value of a repeated path counts.

    The paths are a dictionary of ordinals. A record's entries are placed once each, whatever the number of columns, and
    batches are cut so that ``CELLS`` cells are held at a time.
    """
    key = found.schema.fields[0]
    sent = found.sparkSession.sparkContext.broadcast(list(paths))

    def scan(batches):
        header = pa.array(sent.value, pa.string())
        width = len(header)
        names = [f"c{k}" for k in range(width + 1)]
        for batch in batches:
            step = max(1, CELLS // max(1, width))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                lists, rows = part.column(1), part.num_rows
                path, value = lists.flatten().flatten()
                row = np.repeat(np.arange(rows), pc.fill_null(lists.value_lengths(), 0).to_numpy())
                ordinal = pc.fill_null(pc.index_in(path, value_set=header), -1).to_numpy().astype(np.int64)
                known = np.flatnonzero(ordinal >= 0)
                taken = np.full(width * rows, -1, np.int64)
                np.maximum.at(taken, ordinal[known] * rows + row[known], known)  # the last of a repeated path
                cells = pc.fill_null(value.take(pa.array(taken, mask=taken < 0)), "")
                columns = [cells.slice(k * rows, rows) for k in range(width)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)

    # numbered names inside, as a path may be called like the key
    fields = [StructField(f"c{k + 1}", StringType()) for k in range(len(paths))]
    return found.mapInArrow(scan, StructType([StructField("c0", key.dataType), *fields])).toDF(key.name, *paths)


def flatten_wide(
    df: DataFrame,
    key: str = "rec_id",
    column: str = "v",
    paths: Sequence[str] | None = None,
    levels: int | None = None,
    sep: str = ".",
) -> DataFrame:
    """One STRING column per path, "" where a record lacks it. Repeated paths keep the last value.

    Unless ``paths`` are given, the unrolled records are written once and read for the paths as well as for
    the table: unrolling costs more than that.
    """
    levels = depth(df, column) if levels is None else levels
    found = df.select(key, entries(column, levels, sep).alias("__e__"))
    if paths is None:
        found = materialise(found, "entries")
        paths = _distinct_paths(found, "__e__")
    return aligned(found, paths)


def fill_missing(df: DataFrame) -> DataFrame:
    """Every column as STRING with "" for null."""
    return df.select(*[F.coalesce(quoted(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def shape(df: DataFrame, skip: Sequence[str] = ("rec_id",)) -> DataFrame:
    """Row and column count in one row; the preview is ``df.limit(5)``."""
    n_columns = len([c for c in df.columns if c not in skip])
    return df.agg(F.count("*").alias("n_rows")).select("n_rows", F.lit(n_columns).cast("bigint").alias("n_columns"))


def flatten_struct(df: DataFrame, column: str, sep: str = ".") -> DataFrame:
    """Flatten a typed struct column into flat columns, beside the other columns of ``df``.

    Lists that hold structs or lists need their greatest length, which takes one aggregate over
    all of them per level of such lists.
    """
    other = [quoted(c) for c in df.columns if c != column]
    out: list[Column] = []
    pending: list[tuple[str, Column, DataType]] = [("", F.col(column), df.schema[column].dataType)]
    while pending:
        lists: list[tuple[str, Column, ArrayType]] = []
        while pending:
            path, c, kind = pending.pop(0)
            if isinstance(kind, StructType):
                fields = [
                    (f"{path}{sep}{f.name}" if path else f.name, c.getField(f.name), f.dataType) for f in kind.fields
                ]
                pending = fields + pending
            elif isinstance(kind, ArrayType) and isinstance(kind.elementType, (StructType, ArrayType)):
                lists.append((path, c, kind))
            elif isinstance(kind, ArrayType):
                item = kind.elementType
                text = F.transform(c, lambda x: F.coalesce(_typed_text(x, item), F.lit("None")))
                out.append(F.array_join(text, ", ").alias(path))
            else:
                out.append(_typed_text(c, kind).alias(path))
        if lists:
            sizes = df.agg(*[F.max(F.size(c)).alias(f"n{i}") for i, (_, c, _) in enumerate(lists)]).first()
            for n, (path, c, kind) in zip(sizes, lists):
                pending += [(f"{path}[{i}]", F.get(c, F.lit(i)), kind.elementType) for i in range(max(n or 0, 0))]
    return df.select(*other, *out)


def _typed_text(c: Column, kind: DataType) -> Column:
    if isinstance(kind, BooleanType):
        return F.initcap(c.cast("string"))
    if isinstance(kind, (DoubleType, FloatType)):
        return float_text(c.cast("double"))
    return c.cast("string")
