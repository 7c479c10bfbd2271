"""Text files cut into pieces in parallel, pieces that belong together joined again.

A file is split wherever a separator stands, also where it stands inside something (a quoted cell, a
string, a block comment). Each piece is a step from the lexical state at its start to the one at its end;
what state a piece starts in is a prefix composition of the steps before it. It is folded within
parts of a file split first and over a file's parts second, so a task sees integers of ``PART_PIECES`` pieces at most, or one row
per part of one file, never a whole file's text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise

MAX_BROADCAST_FILES = 100_000
#: Pieces of a split that are folded at once, a power of two: what a Python worker holds follows neither from the size of a split nor of a file.
PART_PIECES = 1 << 15
START = 0
REPLACEMENT = "\ufffd"


def read_pieces(
    spark: SparkSession, paths: str | Sequence[str], cut: str, files: Column | None = None, bad_bytes: str = ""
) -> DataFrame:
    """``(source, block, seq, body)`` of text files split at ``cut``; ``bad_bytes`` stands for bytes that are no UTF-8.
    ``files`` is a condition on the file metadata."""
    raw = spark.read.text(list(paths) if not isinstance(paths, str) else paths, lineSep=cut)
    raw = raw if files is None else raw.where(files)
    valid = F.regexp_replace(F.make_valid_utf8("value"), REPLACEMENT, bad_bytes)
    text = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(valid)
    return raw.select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        text.alias("body"),
    )


def split_by_cut(pieces: DataFrame, opens: Column) -> tuple[DataFrame, DataFrame | None]:
    """``(pieces of whole files, pieces of cut files)``; ``opens`` tells that a piece does not end in
    the start state. One pass over the text; the second frame is None where no file is cut."""
    cut = pieces.select("source", opens.alias("open")).groupBy("source").agg(F.max("open").alias("open"))
    cut = materialise(cut.where("open").select("source"), "cut-files")
    if cut.isEmpty():
        return pieces, None
    if len(pieces.inputFiles()) <= MAX_BROADCAST_FILES:
        # at most one path per input file: text is filtered where it is read
        cut = F.broadcast(cut)
    return pieces.join(cut, "source", "left_anti"), pieces.join(cut, "source", "left_semi")


def _fold(steps: pd.DataFrame, names: list[str], state: int) -> list[int]:
    """State before each step, plus the state after the last one."""
    states = [state]
    for row in steps[names].to_numpy():
        states.append(int(row[states[-1]]))
    return states


def states_before(pieces: DataFrame, steps: Sequence[Column]) -> DataFrame:
    """``(source, block, seq, before)``: the state each piece starts in. ``steps[i]`` is the
    state at a piece's end when it starts in state i."""
    names = [f"s{i}" for i in range(len(steps))]
    ddl = ", ".join(f"{n} int" for n in names)
    # the pieces of a split are numbered on end, so equal high bits are neighbours
    part = F.shiftright("seq", PART_PIECES.bit_length() - 1).alias("part")
    stepped = pieces.select("source", "block", part, "seq", *[s.alias(n) for s, n in zip(steps, names)])

    def through(pdf: pd.DataFrame) -> pd.DataFrame:
        """A part of a split as one step."""
        pdf = pdf.sort_values("seq")
        ends = [_fold(pdf, names, i)[-1] for i in range(len(names))]
        key = ["source", "block", "part"]
        return pd.DataFrame([[*pdf[key].iloc[0], *ends]], columns=[*key, *names])

    def part_starts(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["block", "part"])
        return pdf[["source", "block", "part"]].assign(start=_fold(pdf, names, START)[:-1])

    def piece_starts(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq")
        return pdf[["source", "block", "seq"]].assign(before=_fold(pdf, names, int(pdf["start"].iloc[0]))[:-1])

    starts = (
        stepped.groupBy("source", "block", "part")
        .applyInPandas(through, f"source string, block bigint, part bigint, {ddl}")
        .groupBy("source")
        .applyInPandas(part_starts, "source string, block bigint, part bigint, start int")
    )
    return (
        stepped.join(starts, ["source", "block", "part"])
        .groupBy("source", "block", "part")
        .applyInPandas(piece_starts, "source string, block bigint, seq bigint, before int")
    )


def glue(pieces: DataFrame, heads: DataFrame, cut: str) -> DataFrame:
    """Join each piece to the ones before it up to a head.

    ``heads(source, block, seq, head)`` marks pieces that begin something. Groups hold the text of one
    statement or record.
    """
    in_split = W.partitionBy("source", "block").orderBy("seq")
    local = heads.withColumn(
        "at", F.last(F.when(F.col("head"), F.col("seq")), ignorenulls=True).over(in_split)
    )
    by_split = W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        local.groupBy("source", "block")
        .agg(F.max("at").alias("last"))
        .withColumn("carry", F.last("last", ignorenulls=True).over(by_split))
        .select("source", "block", "carry")
    )
    runs = local.join(carried, ["source", "block"]).select(
        "source", "block", "seq", F.coalesce("at", "carry").alias("at")
    )
    parts = F.sort_array(F.collect_list(F.struct("block", "seq", "body")))
    return (
        pieces.join(runs, ["source", "block", "seq"])
        .groupBy("source", "at")
        .agg(parts.alias("parts"))
        .select(
            "source",
            F.get("parts", F.lit(0))["block"].alias("block"),
            F.get("parts", F.lit(0))["seq"].alias("seq"),
            F.array_join("parts.body", cut).alias("body"),
        )
    )


def whole_pieces(pieces: DataFrame, opens: Column, steps: Callable[[], Sequence[Column]], cut: str) -> DataFrame:
    """``pieces`` with those that start inside something glued to the ones before."""
    whole, cut_ones = split_by_cut(pieces, opens)
    if cut_ones is None:
        return whole
    before = states_before(cut_ones, steps())
    heads = before.select("source", "block", "seq", (F.col("before") == START).alias("head"))
    return whole.unionByName(glue(cut_ones, heads, cut))
