"""Queries: snapshot comparison, upsert, delete, store and CSV jobs.

The stored snapshot is the labelled documents; the incoming one is all documents except those labelled
toxic, table-like texts rewritten, so that rows are new, removed, changed and unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import content_hash
from ..operators import identity, sync
from ..session import scratch
from ..sources.csv import write_csv
from ..sources.store import RowStore, last_wins
from . import jobs
from .registry import query, table


def stored_documents(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")


def incoming_documents(spark, sf) -> DataFrame:
    toxic = table(spark, sf, "labels").where("toxic = 1").select("doc_id")
    kept = table(spark, sf, "documents").join(toxic, "doc_id", "left_anti")
    return kept.withColumn("text", F.regexp_replace("text", r" \| ", " "))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("id"), content_hash("text").alias("hash"))


SQL_NEW = """SELECT doc_id AS id, sha1(replace(text, ' | ', ' ')) AS hash, text FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)"""
SQL_OLD = "SELECT doc_id AS id, sha1(text) AS hash FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"


@query("sync_new", f"SELECT id, hash FROM ({SQL_NEW}) n WHERE id NOT IN (SELECT id FROM ({SQL_OLD}))")
def sync_new(spark, sf):
    return sync.new_rows(_keyed(incoming_documents(spark, sf)), _keyed(stored_documents(spark, sf)))


@query("sync_removed", f"SELECT id, hash FROM ({SQL_OLD}) WHERE id NOT IN (SELECT id FROM ({SQL_NEW}))")
def sync_removed(spark, sf):
    return sync.removed_rows(_keyed(incoming_documents(spark, sf)), _keyed(stored_documents(spark, sf)))


@query("sync_changed", f"SELECT n.id, n.hash FROM ({SQL_NEW}) n JOIN ({SQL_OLD}) o USING (id) WHERE n.hash <> o.hash")
def sync_changed(spark, sf):
    return sync.changed_rows(_keyed(incoming_documents(spark, sf)), _keyed(stored_documents(spark, sf)))


@query(
    "sync_report",
    f"""SELECT count(*) FILTER (o.id IS NULL) AS added, count(*) FILTER (n.id IS NULL) AS removed,
      count(*) FILTER (n.hash <> o.hash) AS changed, count(*) FILTER (n.hash = o.hash) AS unchanged
    FROM ({SQL_NEW}) n FULL JOIN ({SQL_OLD}) o ON n.id = o.id""",
)
def sync_report(spark, sf):
    return sync.sync_report(
        sync.snapshot_diff(_keyed(incoming_documents(spark, sf)), _keyed(stored_documents(spark, sf)))
    )


@query("delete_ids", "SELECT doc_id AS id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def delete_ids(spark, sf):
    ids = table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").alias("id"))
    return sync.delete_ids(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang"), ids)


@query(
    "upsert_last_wins",
    """WITH e AS (SELECT user_id AS id, event_type AS state FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
    SELECT * FROM e UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT id FROM e)""",
)
def upsert_last_wins(spark, sf):
    """Customers keep their segment unless events name them; then the last event wins."""
    current = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("state"))
    incoming = table(spark, sf, "events").select(
        F.col("user_id").alias("id"), F.col("event_type").alias("state"), F.col("event_id").alias("seq")
    )
    return sync.upsert(current, incoming, "seq")


@query(
    "dedup_ids",
    "SELECT sha1(text) AS id, max(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY sha1(text)",
)
def dedup_ids(spark, sf):
    docs = table(spark, sf, "documents").select(F.sha1("text").alias("id"), "doc_id")
    copies = docs.groupBy("id").agg(F.count("*").alias("copies"))
    return last_wins(docs, ["id"], "doc_id").join(copies, "id")


@query(
    "register_new",
    """SELECT name, min(seq) AS seq FROM (SELECT o_custkey::VARCHAR AS name, o_orderkey AS seq FROM orders)
    WHERE name NOT IN (SELECT s_suppkey::VARCHAR FROM supplier) GROUP BY name""",
)
def register_new(spark, sf):
    """Order customers register by number, the earliest order first; supplier numbers are taken."""
    incoming = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("name"), F.col("o_orderkey").alias("seq")
    )
    users = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("name"))
    return identity.register_new(incoming, users, "seq").select("name", "seq")


def _vector_rows(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"),
        F.concat(F.lit("label-"), F.col("label").cast("string")).alias("source"),
        F.lit("embeddings").alias("table_name"),
        F.col("vec_id").cast("string").alias("row_id"),
        F.lit(0).alias("position"),
        F.concat(F.lit("vector "), F.col("vec_id").cast("string")).alias("text"),
        "embedding",
        "label",
        "vec_id",
    )


@query(
    "store_roundtrip",
    """SELECT vec_id::VARCHAR AS id, 'label-' || label AS source, CASE WHEN label = 5 THEN 'again ' ELSE 'vector ' END || vec_id AS text,
      len(embedding)::INT AS width FROM embeddings WHERE label <> 3""",
)
def store_roundtrip(spark, sf):
    """Stored, one label upserted with new texts, another deleted, compacted, read back."""
    rows = _vector_rows(spark, sf)
    path = scratch(spark, "store")
    store = RowStore(spark, path, 64)
    store.upsert(rows, "vec_id")
    again = rows.where("label = 5").withColumn("text", F.concat(F.lit("again "), "id"))
    store.upsert(again, "vec_id")
    store.delete(rows.where("label = 3").select("id"))
    store.compact()
    return RowStore(spark, path).read().select("id", "source", "text", F.size("embedding").alias("width"))


def _write_snapshot(df: DataFrame, path: str) -> None:
    write_csv(df.select("doc_id", "lang", "text"), path)


SQL_CSV_ROWS = "SELECT sha1(doc_id::VARCHAR) AS id, text FROM {0} WHERE length(text) >= 10"
CSV_OPTIONS = {"text_columns": ["text"], "key_columns": ["doc_id"]}


@query(
    "job_csv_full",
    """SELECT sha1(doc_id::VARCHAR) AS id, 'docs' AS source, 384::INT AS width,
      md5(concat_ws(' ' || chr(10), CASE WHEN picked THEN text END, 'a document in ' || lang)) AS text_md5
    FROM documents, (SELECT count(DISTINCT text) <= greatest(2000, floor(count(text) * 0.9)) AS picked FROM documents)""",
)
def job_csv_full(spark, sf):
    """Columns picked by profile (texts only while they repeat enough), rows keyed, encoded and stored."""
    path = scratch(spark, "csv")
    note = F.concat(F.lit("a document in "), "lang").alias("note")
    write_csv(table(spark, sf, "documents").select("doc_id", "lang", "text", note), path)
    store = RowStore(spark, scratch(spark, "store"), jobs.DEFAULT_DIM)
    jobs.ingest_csv(spark, path, store, source="docs", key_columns=["doc_id"])
    return store.read().select("id", "source", F.md5("text").alias("text_md5"), F.size("embedding").alias("width"))


@query(
    "job_csv_sync",
    f"""SELECT id, md5(text) AS text_md5 FROM ({SQL_CSV_ROWS.format('(SELECT id AS doc_id, replace(text, chr(32) || chr(124) || chr(32), chr(32)) AS text FROM (' + SQL_NEW + '))')})""",
)
def job_csv_sync(spark, sf):
    """Full load of the stored snapshot, then a sync with the incoming one, updates detected."""
    first, second = scratch(spark, "csv"), scratch(spark, "csv")
    _write_snapshot(stored_documents(spark, sf), first)
    _write_snapshot(incoming_documents(spark, sf), second)
    store = RowStore(spark, scratch(spark, "store"), jobs.DEFAULT_DIM)
    jobs.ingest_csv(spark, first, store, source="docs", **CSV_OPTIONS)
    jobs.sync_csv(spark, second, store, source="docs", detect_updates=True, **CSV_OPTIONS)
    return store.read().select("id", F.md5("text").alias("text_md5"))
