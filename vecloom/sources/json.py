"""JSON scan into one VARIANT per record, also out of one huge list.

A file up to a size, and any file that is no list, is parsed whole. A larger list is cut at ``},`` and pieces are
joined to list elements. Whether a cut lies inside a string, and how deep it lies, follows from
prefix compositions over the pieces (see :mod:`.pieces`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .pieces import glue, read_pieces, states_before

WHOLE_FILE_BYTES = 16 * 1024 * 1024
CUT = "},"


def scan_json(
    spark: SparkSession, paths: str | Sequence[str], lines: bool = False, whole_file_bytes: int = WHOLE_FILE_BYTES
) -> DataFrame:
    """``(rec_id, v)``: a root list gives one row per element, a root object one row.

    ``lines`` reads one document per line. Malformed documents are an error here;
    :func:`parse_documents` sets them aside instead.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.options(singleVariantColumn="v", multiLine=not lines, mode="FAILFAST")
    if lines:
        return records(reader.json(paths))
    large = F.col("_metadata.file_size") > whole_file_bytes
    files = spark.read.format("binaryFile").load(paths).select("path", "length")
    if files.where(F.col("length") > whole_file_bytes).isEmpty():
        return records(reader.json(paths).select("v"))
    # a large file that begins with a brace is one record, which nothing can split: it is parsed whole too
    first = F.substring(F.regexp_replace("body", r"\A\s+", ""), 1, 1)
    heads = read_pieces(spark, paths, CUT, large).groupBy("source").agg(F.min_by(first, F.struct("block", "seq")).alias("head"))
    single = F.col("_metadata.file_path").isin([r["source"] for r in heads.where("head <> '['").collect()])
    whole = reader.json(paths).where(~large | single).select("v")
    return records(whole.unionByName(_split_lists(spark, paths, large & ~single)))


def records(df: DataFrame, column: str = "v") -> DataFrame:
    """Spread root lists over rows and number the records."""
    items = F.try_variant_get(F.col(column), "$", "array<variant>")
    each = F.explode(F.when(items.isNotNull(), items).otherwise(F.array(F.col(column))))
    return df.select(each.alias("v")).select(F.monotonically_increasing_id().alias("rec_id"), "v")


def _split_lists(spark: SparkSession, paths: list[str], files: Column) -> DataFrame:
    """Parts of the large root lists, each a short list in itself."""
    pieces = read_pieces(spark, paths, CUT, files)
    # a backslash stands only inside strings, so what it escapes can go before quotes are counted
    bare = F.regexp_replace("body", r"\\.|\\$", "")
    quotes = F.length(F.regexp_replace(bare, '[^"]', "")) % 2
    before = states_before(pieces, [quotes, 1 - quotes])

    # depth of each piece: its brackets outside strings, and the one the cut took away
    opened = F.concat(F.when(F.col("before") == 1, '"').otherwise(""), bare)
    code = F.regexp_replace(F.regexp_replace(opened, '"[^"]*"', ""), '"[^"]*$', "")
    ups = F.length(F.regexp_replace(code, r"[^\[{]", ""))
    downs = F.length(F.regexp_replace(code, r"[^\]}]", ""))
    ends_outside = (F.col("before") + quotes) % 2 == 0
    delta = ups - downs - ends_outside.cast("int")
    steps = pieces.join(before, ["source", "block", "seq"]).select(
        "source", "block", "seq", "before", delta.alias("delta")
    )
    ahead = (W.unboundedPreceding, -1)
    local = F.sum("delta").over(W.partitionBy("source", "block").orderBy("seq").rowsBetween(*ahead))
    base = F.sum("total").over(W.partitionBy("source").orderBy("block").rowsBetween(*ahead))
    blocks = steps.groupBy("source", "block").agg(F.sum("delta").alias("total")).select("source", "block", base.alias("base"))
    depth = F.coalesce("local", F.lit(0)) + F.coalesce("base", F.lit(0))
    placed = steps.withColumn("local", local).join(blocks, ["source", "block"]).withColumn("depth", depth)
    # the file's first piece, and every piece that begins between two elements
    head = (F.col("before") == 0) & (F.col("depth") <= 1)
    parts = glue(pieces, placed.select("source", "block", "seq", head.alias("head")), CUT)

    inner = F.when(F.col("first"), F.regexp_replace("body", r"\A\s*\[", "")).otherwise(F.col("body"))
    firsts = parts.groupBy("source").agg(F.min(F.struct("block", "seq")).alias("start"))
    marked = parts.join(firsts, "source").withColumn("first", F.struct("block", "seq") == F.col("start"))
    # every part but a file's last lost its closing brace to the cut; the last ends with the list's bracket
    cut_off = F.try_parse_json(F.concat(F.lit("["), inner, F.lit("}]")))
    last = F.parse_json(F.concat(F.lit("["), inner))
    return marked.select(F.coalesce(cut_off, last).alias("v"))


def parse_documents(df: DataFrame, text: Column, keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Parse a JSON text column: ``(parsed, quarantined)``.

    Text the parser refuses, duplicate keys included, goes to the second frame untouched.
    """
    out = df.select(*keep, text.alias("json"))
    # as a generator, so that a filter on the outcome does not parse every text once more
    out = out.select(*keep, "json", F.explode(F.array(F.try_parse_json("json"))).alias("v"))
    return out.where("v is not null").drop("json"), out.where("v is null and json is not null").drop("v")
