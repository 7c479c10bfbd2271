"""CSV scan with null tokens, and the flat-table sink."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import quoted
from ..session import materialise
from .pieces import MAX_BROADCAST_FILES, REPLACEMENT, read_pieces, whole_pieces

# Cell texts that mean "missing" (the pandas default set).
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

WHOLE_FILE_BYTES = 256 * 1024 * 1024
ORDINAL = "__ordinal__"
SOURCE = "__source__"


_REST_OF_CELL = re.compile(r'[^"]*(?:""[^"]*)*(?P<close>"|\Z)[^,]*(?:,|\Z)')
_CELL = re.compile(r'"[^"]*(?:""[^"]*)*(?P<close>"|\Z)[^,]*(?:,|\Z)|[^,]*(?:,|\Z)')


def quoted_after(line: str, quoted: bool = False) -> bool:
    """Whether ``line`` ends inside a quoted cell. A quote counts only where a cell begins with it."""
    at = 0
    if quoted:
        m = _REST_OF_CELL.match(line)
        if m["close"] == "":
            return True
        at = m.end()
    return any(m["close"] == "" for m in _CELL.finditer(line, at))


def _quoted_after(quoted: bool) -> Column:
    @F.pandas_udf("int")
    def after(s: pd.Series) -> pd.Series:
        return s.map(lambda line: int(quoted_after(line, quoted)), na_action="ignore").astype("Int64")

    # lines without a quote stay in the state they start in and never reach Python
    return F.coalesce(after(F.when(F.contains("body", F.lit('"')), F.col("body"))), F.lit(int(quoted)))


def scan_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    na_tokens: Sequence[str] = NA_TOKENS,
    with_origin: bool = False,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """All columns as STRING, ``na_tokens`` as null; cells may hold quoted line breaks.

    Files up to ``whole_file_bytes`` are parsed whole, each in a task. Larger ones, and those with Windows line ends,
    which that parser would change inside cells too, are split line by line, and lines inside a quoted cell
    glued to the line their record begins on, so that no file is too large for its task. Both give the same rows: the
    first record of a file is its header wherever equal ones follow, line breaks inside cells stay as they are,
    and bytes that are no UTF-8 become U+FFFD. ``with_origin`` adds the file path and an ordinal struct that
    restores file order.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    parser = {"escape": '"', "mode": "PERMISSIVE"}
    whole = spark.read.options(header=True, multiLine=True, inferSchema=False, **parser).csv(paths)
    names = whole.columns
    slots = [f"c{i}" for i in range(len(names))]
    # a filter on the file size is applied to the file list, before anything is read
    size = F.col("_metadata.file_size")
    rows = whole.where(size <= whole_file_bytes).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        *[quoted(n).alias(s) for n, s in zip(names, slots)],
    )
    ends = read_pieces(spark, paths, "\n", size <= whole_file_bytes).where(F.rlike("body", F.lit("^[^\r]*\r$")))
    windows = materialise(ends.select("source").distinct(), "csv-windows")
    if not windows.isEmpty():
        windows = F.broadcast(windows) if len(whole.inputFiles()) <= MAX_BROADCAST_FILES else windows
        rows = rows.join(windows, "source", "left_anti")
        lines = read_pieces(spark, paths, "\n", size <= whole_file_bytes, REPLACEMENT).join(windows, "source", "left_semi")
        rows = rows.unionByName(_split_rows(lines, slots, parser))
    files = spark.read.format("binaryFile").load(paths).select("path", "length")
    if not files.where(F.col("length") > whole_file_bytes).isEmpty():
        rows = rows.unionByName(_split_rows(read_pieces(spark, paths, "\n", size > whole_file_bytes, REPLACEMENT), slots, parser))
    cells = [F.when(~F.col(s).isin(list(na_tokens)), F.col(s)).alias(n) for s, n in zip(slots, names)]
    if not with_origin:
        return rows.select(*cells)
    ordinal = F.struct(F.col("source").alias("file"), F.col("block").alias("offset"), "seq")
    return rows.select(*cells, F.col("source").alias(SOURCE), ordinal.alias(ORDINAL))


def _split_rows(lines: DataFrame, slots: list[str], parser: dict[str, str]) -> DataFrame:
    """Records of files that were split at line feeds, without each file's header."""
    records = whole_pieces(lines, _quoted_after(False) == 1, lambda: [_quoted_after(False), _quoted_after(True)], "\n")
    # the return before a record's line break belongs to the break, those inside cells to the text
    end = F.when(F.endswith("body", F.lit("\r")), F.expr("left(body, length(body) - 1)")).otherwise(F.col("body"))
    records = records.withColumn("body", end).where("body <> ''")
    # a record has the place of its first line, and the header is the first line that is not blank
    first = lines.where(~F.col("body").isin("", "\r")).groupBy("source").agg(F.min(F.struct("block", "seq")).alias("at"))
    first = materialise(first.select("source", "at.block", "at.seq"), "csv-headers")
    if len(lines.inputFiles()) <= MAX_BROADCAST_FILES:
        first = F.broadcast(first)
    records = records.join(first, ["source", "block", "seq"], "left_anti")
    # one parse per record, as a generator so that it is not repeated for each column
    row = F.from_csv("body", ", ".join(f"{s} string" for s in slots), parser)
    return records.select("source", "block", "seq", F.inline(F.array(row)))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header, no quotes around blanks, quotes doubled inside cells."""
    df.write.mode(mode).option("header", True).option("emptyValue", "").option("escape", '"').csv(path)
