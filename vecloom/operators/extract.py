"""Text records out of SQL-dump statements: comments and textual cells of INSERTs."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import MIN_TEXT_LEN, TEXT_SEP, clean_text, collapse_blanks, html_text, kept, looks_textual, strip_blanks
from ..sources.sqldump import LEX, gathered_statements, scan_lines

RECORD_SCHEMA = "source string, table_name string, row_id string, text string"
RAW_ROW = ["source", "table_name", "cols", "cells", "texts"]
RAW_ROW_SCHEMA = "source string, table_name string, cols string, cells array<string>, texts array<string>"
TUPLES_PER_BATCH = 2048

# The column names that identify a row.
ID_COLUMNS = ("id", "pk", "uuid")

# A bare or back-quoted word of a statement, and a column list whose back-quoted names may hold parentheses.
_WORD = re.compile(r"\s*(`?[\w$]+`?)")
_COLUMNS = re.compile(r"\s*\(((?:`[^`]*`|[^)])*+)\)")
_ESCAPED = re.compile(r"\\(.)|''", re.S)
_CELL = re.compile(r"'((?:[^'\\]|\\.|'')*)'|([(),])|([^'(),]+)|'", re.S)


def comment_texts(body: str) -> Iterator[str]:
    """Raw comment texts of one piece, block comments line by line, and any code standing
    before a block comment on its line."""
    free_from = 0
    comment_line = -1
    for m in LEX.finditer(body):
        if m["line"] is not None:
            yield m["line"]
        elif m["block"] is not None:
            line = body.rfind("\n", 0, m.start()) + 1
            # only the first block comment opened on a line counts
            if line != comment_line:
                yield body[max(line, free_from) : m.start()]
                yield from m["block"].split("\n")
            comment_line = line
            free_from = m.end()


def read_insert(code: str) -> tuple[str, str, str] | None:
    """``(table, column list, values)`` of an INSERT, read word by word; a statement without a column list, or with
    a schema before the table's name, gives None."""
    words: list[str] = []
    at = 0
    while len(words) < 3 and (m := _WORD.match(code, at)):
        words.append(m[1])
        at = m.end()
    if len(words) < 3 or [w.lower() for w in words[:2]] != ["insert", "into"]:
        return None
    columns = _COLUMNS.match(code, at)
    values = columns and _WORD.match(code, columns.end())
    if not values or values[1].lower() != "values":
        return None
    return words[2].strip("`"), columns[1], code[values.end() :].lstrip()


def insert_parts(body: str) -> Iterator[tuple[str, str, str]]:
    """``(table, column list, values)`` of each INSERT in one piece, comments removed."""
    code: list[str] = []
    at = 0

    def statement() -> Iterator[tuple[str, str, str]]:
        found = read_insert("".join(code))
        if found:
            yield found
        code.clear()

    for m in LEX.finditer(body):
        code.append(body[at : m.start()])
        at = m.end()
        if m["end"]:
            yield from statement()
        elif m["quote"] is not None:
            code.append(m[0])
        else:
            code.append(" ")
    code.append(body[at:])
    yield from statement()


def value_tuples(values: str) -> Iterator[list[str]]:
    """Cells of each ``(…)`` group, quotes and escapes resolved, nested parentheses kept.

    Ends at the first thing after a group that is not a comma.
    """
    depth = 0
    cells: list[str] = []
    cell: list[str] = []
    for m in _CELL.finditer(values):
        text, mark, raw = m[1], m[2], m[3]
        if depth == 0:
            if mark == "(":
                depth, cells, cell = 1, [], []
            elif mark == ")" or text is not None or (raw and raw.strip()):
                return
            continue
        if depth == 1 and mark in (",", ")"):
            cells.append("".join(cell))
            cell = []
            if mark == ")":
                depth = 0
                yield cells
            continue
        depth += {"(": 1, ")": -1}.get(mark, 0)
        cell.append(m[0] if text is None else _ESCAPED.sub(lambda e: e[1] or "'", text))


_FLAT_GROUP = re.compile(r"\(((?:'(?:[^'\\]|\\.)*'|[^')])*)\)", re.S)
_FLAT_CELL = re.compile(r"((?:'(?:[^'\\]|\\.)*'|[^',])*)(?:,|\Z)", re.S)
_FLAT_QUOTED = re.compile(r"'((?:[^'\\]|\\.)*)'", re.S)


def flat_tuples(values: str) -> Iterator[list[str]]:
    """The older reading: a group ends at its first ")", whatever stands between groups is passed over,
    and a doubled quote is lost."""
    at = values.find("(")
    while at >= 0:
        group = _FLAT_GROUP.match(values, at)
        if group is None:
            # a string or group left open swallows the rest
            return
        at = values.find("(", group.end())
        body = group[1]
        cells = [m[1] for m in _FLAT_CELL.finditer(body)]
        # a match at the very end stands for a cell only after a comma
        if len(cells) > 1 and not body.endswith(","):
            cells.pop()
        yield [_FLAT_QUOTED.sub(lambda q: re.sub(r"\\(.)", r"\1", q[1], flags=re.S), c) for c in cells]


def comments(statements: DataFrame, min_text_len: int = MIN_TEXT_LEN) -> DataFrame:
    """Comment records; table and row id are null."""

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = pdf["body"].map(lambda b: list(comment_texts(b)) if "--" in b or "/*" in b else [])
            out = pd.DataFrame({"source": pdf["source"], "text": found}).explode("text").dropna(subset="text")
            yield out

    raw = statements.select("source", "body").mapInPandas(texts, "source string, text string")
    cleaned = raw.select("source", kept(clean_text("text"), lambda t: textual(t, min_text_len)).alias("text"))
    return cleaned.select(
        "source", F.lit(None).cast("string").alias("table_name"), F.lit(None).cast("string").alias("row_id"), "text"
    )


def inserts(statements: DataFrame) -> DataFrame:
    """``(source, block, seq, part, table_name, cols, vals)``, one row per INSERT with a column list."""

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                (*where, part, *found)
                for *where, body in pdf.itertuples(index=False)
                if "insert" in body.lower()
                for part, found in enumerate(insert_parts(body))
            ]
            yield pd.DataFrame(rows, columns=["source", "block", "seq", "part", "table_name", "cols", "vals"])

    schema = "source string, block bigint, seq bigint, part int, table_name string, cols string, vals string"
    return statements.select("source", "block", "seq", "body").mapInPandas(parts, schema)


def tuples(insert_rows: DataFrame) -> DataFrame:
    """One row per VALUES group: ``cells`` as written, ``texts`` with markup removed.

    Groups leave the worker a batch at a time, so a long INSERT is never held as rows.
    """
    keep = ["source", "block", "seq", "part", "table_name", "cols"]

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []
            for *where, vals in pdf.itertuples(index=False):
                for no, cells in enumerate(value_tuples(vals)):
                    rows.append((*where, no, cells, [_shown(_unquoted(c)) for c in cells]))
                    if len(rows) >= TUPLES_PER_BATCH:
                        yield pd.DataFrame(rows, columns=[*keep, "tuple_no", "cells", "texts"])
                        rows = []
            yield pd.DataFrame(rows, columns=[*keep, "tuple_no", "cells", "texts"])

    schema = (
        "source string, block bigint, seq bigint, part int, table_name string, cols string, "
        "tuple_no bigint, cells array<string>, texts array<string>"
    )
    return insert_rows.select(*keep, "vals").mapInPandas(spread, schema)


def _shown(raw: str) -> str:
    return html_text(raw) if "<" in raw or "&" in raw else raw


def _unquoted(cell: str) -> str:
    cell = cell.strip()
    return cell[1:-1] if len(cell) >= 2 and cell[0] == cell[-1] == "'" else cell


def textual(c: Column | str, min_text_len: int = MIN_TEXT_LEN) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (F.length(c) >= min_text_len) & looks_textual(c)


def row_id_of(cols: Column | str, cells: Column | str) -> Column:
    """Value of the first id-like column, else of the first column; blank or missing gives null."""
    cols = F.col(cols) if isinstance(cols, str) else cols
    cells = F.col(cells) if isinstance(cells, str) else cells
    names = F.transform(F.split(cols, ","), lambda c: F.lower(F.btrim(strip_blanks(c), F.lit("`"))))
    hit = F.array_position(F.transform(names, lambda n: n.isin(*ID_COLUMNS)), True)
    index = F.greatest(hit.cast("int") - 1, F.lit(0))
    return F.nullif(strip_blanks(F.get(cells, index)), F.lit(""))


def text_of_cells(cells: Column, min_text_len: int = MIN_TEXT_LEN, sep: str = TEXT_SEP) -> Column:
    """Join the cells that look textual; cells must have their markup removed already."""
    return F.array_join(F.filter(cells, lambda c: textual(c, min_text_len)), sep)


def row_texts(tuple_rows: DataFrame, min_text_len: int = MIN_TEXT_LEN) -> DataFrame:
    """Text records of VALUES groups; groups without a textual cell are dropped."""
    text = text_of_cells(F.transform("texts", collapse_blanks), min_text_len)
    return tuple_rows.select(
        "source", "table_name", row_id_of("cols", "cells").alias("row_id"), kept(text, lambda t: t != "").alias("text")
    )


def text_records(statements: DataFrame, min_text_len: int = MIN_TEXT_LEN) -> DataFrame:
    """Everything worth searching in a dump, comments and row texts, in one pass over it."""
    def both(body: str) -> Iterator[tuple]:
        if "--" in body or "/*" in body:
            for c in comment_texts(body):
                yield None, None, None, [_shown(c)]
        if "insert" in body.lower():
            for table_name, cols, vals in insert_parts(body):
                for cells in value_tuples(vals):
                    yield table_name, cols, cells, [_shown(_unquoted(c)) for c in cells]

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []
            for source, body in pdf.itertuples(index=False):
                for found in both(body):
                    rows.append((source, *found))
                    if len(rows) >= TUPLES_PER_BATCH:
                        yield pd.DataFrame(rows, columns=RAW_ROW)
                        rows = []
            yield pd.DataFrame(rows, columns=RAW_ROW)

    return row_texts(statements.select("source", "body").mapInPandas(spread, RAW_ROW_SCHEMA), min_text_len)


def line_records(spark: SparkSession, paths: str | Sequence[str], min_text_len: int = MIN_TEXT_LEN) -> DataFrame:
    """:func:`text_records` by the older, line-based reading of a dump.

    Comment and statement marks count inside strings too: an INSERT over several lines ends at the first line
    holding ";", text after "/*" on the line that opens a longer comment is left out.
    """
    lines = scan_lines(spark, paths)
    remarks = lines.where(F.size("texts") > 0).select("source", F.explode("texts").alias("text"))
    remarks = remarks.select("source", kept(clean_text("text"), lambda t: textual(t, min_text_len)).alias("text"))
    missing = F.lit(None).cast("string")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found: list[tuple] = []
            for source, body in pdf.itertuples(index=False):
                head = read_insert(body)
                for cells in flat_tuples(head[2].rpartition(";")[0]) if head else ():
                    found.append((source, *head[:2], cells, [_shown(_unquoted(c)) for c in cells]))
                    if len(found) >= TUPLES_PER_BATCH:
                        yield pd.DataFrame(found, columns=RAW_ROW)
                        found = []
            yield pd.DataFrame(found, columns=RAW_ROW)

    statements = gathered_statements(lines).select("source", "body")
    return remarks.select(
        "source", missing.alias("table_name"), missing.alias("row_id"), "text"
    ).unionByName(row_texts(statements.mapInPandas(rows, RAW_ROW_SCHEMA), min_text_len))


def record_counts(records: DataFrame) -> DataFrame:
    """Records per table, with a grand total; nothing is encoded."""
    per_table = records.groupBy("table_name").agg(F.count("*").alias("records"))
    total = per_table.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records"))
    return per_table.unionByName(total.select(F.lit("(total)").alias("table_name"), "records"))
