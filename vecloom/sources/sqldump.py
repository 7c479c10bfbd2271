"""SQL-dump scan: statements in parallel, also out of one huge file.

Files are split on ``;`` + newline; a piece that starts inside a string or a block comment is glued to the
one before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pieces import glue, read_pieces, states_before, whole_pieces

CUT = ";\n"

# Lexical states at a cut: plain code, inside a string, inside a block comment.
CODE, STRING, BLOCK = 0, 1, 2

_STRING_BODY = r"[^'\\]*(?:\\.[^'\\]*)*"
LEX = re.compile(
    rf"'{_STRING_BODY}(?P<quote>'|\\?\Z)"
    r"|/\*(?P<block>.*?)(?P<close>\*/|\Z)"
    r"|^[^\S\n]*--(?P<line>[^\n]*)"
    r"|--[ \t][^\n]*"
    r"|(?P<end>;)",
    re.S | re.M,
)
_REST_OF_STRING = re.compile(_STRING_BODY + r"(?P<quote>'|\\?\Z)", re.S)


def state_after(text: str, state: int = CODE) -> int:
    """Lexical state at the end of ``text`` when it starts in ``state``."""
    at = 0
    if state == STRING:
        m = _REST_OF_STRING.match(text)
        if m["quote"] != "'":
            return STRING
        at = m.end()
    elif state == BLOCK:
        at = text.find("*/") + 2
        if at < 2:
            return BLOCK
    for m in LEX.finditer(text, at):
        if m["quote"] is not None and m["quote"] != "'":
            return STRING
        if m["close"] == "":
            return BLOCK
    return CODE


def _state_udf(start: int):
    @F.pandas_udf("int")
    def udf(s: pd.Series) -> pd.Series:
        return s.map(lambda t: state_after(t, start))

    return udf


def scan_statements(spark: SparkSession, paths: str | Sequence[str], cut: str = CUT) -> DataFrame:
    """``(source, block, seq, body)``: pieces of dump text that start and end in plain code.

    One pass looks for files with a cut inside a string or comment; where there is none, the scan
    is all there is. Dumps with Windows line ends pass ``cut=";\\r\\n"``.
    """
    pieces = read_pieces(spark, paths, cut)
    opens = _state_udf(CODE)("body") != CODE
    return whole_pieces(pieces, opens, lambda: [_state_udf(s)("body") for s in (CODE, STRING, BLOCK)], cut)


# The older, line-based reading: marks count wherever they stand in a line, also inside strings. A line
# starts in one of four states, bit 0: an INSERT is being gathered, bit 1: inside a block comment.
GATHERING, IN_COMMENT = 1, 2


def read_line(line: str, state: int) -> tuple[int, list[str], str | None]:
    """``(state after, comment texts, code of an INSERT)`` of one line."""
    gathering = state & GATHERING
    texts: list[str] = []
    if state & IN_COMMENT:
        text, closed, line = line.partition("*/")
        texts.append(text)
        if not closed:
            return state, texts, None
    if line.lstrip().startswith("--"):
        return gathering, [*texts, line.lstrip()[2:]], None
    before, opened, rest = line.partition("/*")
    if opened:
        text, closed, line = rest.partition("*/")
        texts.append(before)
        if not closed:
            return gathering | IN_COMMENT, texts, None
        texts.append(text)
    if not gathering and not line.lstrip()[:6].upper() == "INSERT":
        return 0, texts, None
    return 0 if ";" in line else GATHERING, texts, line


def scan_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(source, block, seq, before, texts, code)`` per line, read the older way.

    Line states are folded like those of pieces, so files stay split.
    """

    @F.pandas_udf("array<int>")
    def ends(s: pd.Series) -> pd.Series:
        return s.map(lambda line: [read_line(line, state)[0] for state in range(4)])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [read_line(body, before)[1:] for body, before in zip(pdf["body"], pdf["before"])]
            texts, code = [f[0] for f in found], [f[1] for f in found]
            yield pdf.drop(columns="body").assign(texts=texts, code=pd.Series(code, index=pdf.index, dtype=object))

    lines = read_pieces(spark, paths, "\n")
    before = states_before(lines, [F.get(ends("body"), F.lit(i)) for i in range(4)])
    keyed = lines.join(before, ["source", "block", "seq"])
    schema = "source string, block bigint, seq bigint, before int, texts array<string>, code string"
    return keyed.select("source", "block", "seq", "before", "body").mapInPandas(read, schema)


def gathered_statements(lines: DataFrame) -> DataFrame:
    """INSERT statements of :func:`scan_lines`, lines joined; one without ";" never ended."""
    code = lines.where("code is not null")
    heads = code.select(
        "source", "block", "seq", (F.col("before").bitwiseAND(F.lit(GATHERING)) == 0).alias("head")
    )
    pieces = code.select("source", "block", "seq", F.col("code").alias("body"))
    return glue(pieces, heads, "\n").where(F.contains("body", F.lit(";")))
