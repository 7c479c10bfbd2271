"""Queries: SQL dumps rendered by Spark from the document and page tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import extract
from ..session import scratch
from ..sources.sqldump import CUT, scan_statements
from ..sources.store import RowStore
from . import jobs
from .q_text import sql_chunks, sql_clean, sql_textual
from .registry import query, table


def _quoted(c: str):
    return F.concat(F.lit("'"), F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'"))


def write_dump(spark, sf: str) -> str:
    """One INSERT per document and page, with comments; page markup puts ";" into strings."""
    path = scratch(spark, "dump")
    docs = table(spark, sf, "documents").select(
        F.concat(
            F.format_string("-- document number %d in language %s\n", "doc_id", "lang"),
            F.format_string("/* it was taken from %s\n   and is number %d of them */\n", "source", "doc_id"),
            F.lit("INSERT INTO `documents` (`lang`,`id`,`text`) VALUES\n ("),
            F.concat_ws(", ", _quoted("lang"), F.col("doc_id").cast("string"), _quoted("text")),
            F.lit(")"),
        )
    )
    pages = table(spark, sf, "pages").select(
        F.concat(
            F.lit("INSERT INTO pages (url, html) VALUES ("),
            _quoted("url"),
            F.lit(","),
            _quoted("html"),
            F.lit("),("),
            _quoted("url"),
            F.lit(",NULL)"),
        )
    )
    docs.write.option("lineSep", CUT).text(f"{path}/documents")
    pages.write.option("lineSep", CUT).text(f"{path}/pages")
    return path


def statements(spark, sf: str):
    path = write_dump(spark, sf)
    return scan_statements(spark, [f"{path}/documents", f"{path}/pages"])


SQL_COMMENTS = """SELECT unnest(['document number ' || doc_id || ' in language ' || lang,
    'it was taken from ' || source, 'and is number ' || doc_id || ' of them']) AS text FROM documents"""

# one row per VALUES group with at least one textual cell
SQL_ROWS = f"""SELECT table_name, row_id, text FROM (
    SELECT 'documents' AS table_name, doc_id::VARCHAR AS row_id,
      CASE WHEN {sql_textual('t')} THEN t ELSE '' END AS text
      FROM (SELECT doc_id, {sql_clean('text')} AS t FROM documents)
    UNION ALL
    SELECT 'pages', url, concat_ws(' ' || chr(10), CASE WHEN {sql_textual('u')} THEN u END, CASE WHEN {sql_textual('t')} THEN t END)
      FROM (SELECT url, {sql_clean('url')} AS u, {sql_clean('html')} AS t FROM pages)
    UNION ALL
    SELECT 'pages', url, CASE WHEN {sql_textual('u')} THEN u ELSE '' END
      FROM (SELECT url, {sql_clean('url')} AS u FROM pages)) WHERE text <> ''"""


@query(
    "scan_sql_dump",
    "SELECT 'documents' AS file, count(*) AS statements FROM documents UNION ALL SELECT 'pages', count(*) FROM pages",
)
def scan_sql_dump(spark, sf):
    found = statements(spark, sf).where("length(trim(body)) > 0")
    folder = F.element_at(F.split("source", "/"), -2)
    return found.groupBy(folder.alias("file")).agg(F.count("*").alias("statements"))


@query("sql_comments", SQL_COMMENTS)
def sql_comments(spark, sf):
    return extract.comments(statements(spark, sf)).select("text")


@query(
    "sql_inserts",
    """SELECT 'documents' AS table_name, '`lang`,`id`,`text`' AS cols, count(*) AS n FROM documents
    UNION ALL SELECT 'pages', 'url, html', count(*) FROM pages""",
)
def sql_inserts(spark, sf):
    return extract.inserts(statements(spark, sf)).groupBy("table_name", "cols").agg(F.count("*").alias("n"))


@query(
    "sql_tuples",
    """SELECT 'documents' AS table_name, 0::BIGINT AS tuple_no, 3::INT AS n_cells, md5(lang || '|' || doc_id || '|' || text) AS cells_md5 FROM documents
    UNION ALL SELECT 'pages', 0, 2, md5(url || '|' || html) FROM pages
    UNION ALL SELECT 'pages', 1, 2, md5(url || '|NULL') FROM pages""",
)
def sql_tuples(spark, sf):
    cells = F.transform("cells", lambda c: F.trim(c))
    return extract.tuples(extract.inserts(statements(spark, sf))).select(
        "table_name",
        "tuple_no",
        F.size("cells").alias("n_cells"),
        F.md5(F.array_join(cells, "|")).alias("cells_md5"),
    )


@query(
    "sql_row_id",
    """SELECT 'documents' AS table_name, doc_id::VARCHAR AS row_id FROM documents
    UNION ALL SELECT 'pages', unnest([url, url]) FROM pages""",
)
def sql_row_id(spark, sf):
    return extract.tuples(extract.inserts(statements(spark, sf))).select(
        "table_name", extract.row_id_of("cols", "cells").alias("row_id")
    )


@query("sql_text_records", f"SELECT table_name, row_id, md5(text) AS text_md5 FROM ({SQL_ROWS}) UNION ALL SELECT NULL, NULL, md5(text) FROM ({SQL_COMMENTS})")
def sql_text_records(spark, sf):
    return extract.text_records(statements(spark, sf)).select("table_name", "row_id", F.md5("text").alias("text_md5"))


@query(
    "dry_run_counts",
    f"""WITH r AS (SELECT table_name FROM ({SQL_ROWS}) UNION ALL SELECT NULL FROM ({SQL_COMMENTS}))
    SELECT table_name, count(*) AS records FROM r GROUP BY table_name UNION ALL SELECT '(total)', count(*) FROM r""",
)
def dry_run_counts(spark, sf):
    path = write_dump(spark, sf)
    return jobs.dry_run(spark, [f"{path}/documents", f"{path}/pages"])


@query(
    "job_sql_dump",
    f"""SELECT DISTINCT table_name, row_id, position, text_md5 FROM (
      SELECT table_name, row_id, position, md5(max(text)) AS text_md5 FROM (
        SELECT split_part(key, chr(1), 1) AS table_name, split_part(key, chr(1), 2) AS row_id, position, text
        FROM ({sql_chunks(f"SELECT table_name || chr(1) || row_id || chr(1) || md5(text) AS key, text FROM ({SQL_ROWS})", 512, 64)}))
      GROUP BY table_name, row_id, position, substring(text, 1, 64))
    UNION ALL SELECT DISTINCT '', '', 0, md5(text) FROM ({SQL_COMMENTS})""",
)
def job_sql_dump(spark, sf):
    """Dump to stored chunks with vectors, its files being one source; the id holds more than the SQL has and is left out."""
    path = write_dump(spark, sf)
    store = RowStore(spark, scratch(spark, "store"), jobs.DEFAULT_DIM)
    jobs.ingest_sql_dump(spark, [f"{path}/documents", f"{path}/pages"], store, source="dump")
    rows = store.read()
    return rows.select(
        F.coalesce("table_name", F.lit("")).alias("table_name"),
        F.coalesce("row_id", F.lit("")).alias("row_id"),
        "position",
        F.md5("text").alias("text_md5"),
    ).distinct()
