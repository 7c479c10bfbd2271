"""Queries: scans, columns, texts, keys, chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys, text
from ..operators import chunk, flatten, profile
from ..session import scratch, spread
from ..sources.csv import scan_csv, write_csv
from ..sources.json import parse_documents, scan_json
from .registry import query, table

# Building blocks of the checking SQL. Blanks are the ASCII ones on both sides: the tables hold no others.
STRIP = "trim({0}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def sql_text(*columns: str) -> str:
    return "concat_ws(' ' || chr(10), " + ", ".join(f"nullif({STRIP.format(c)}, '')" for c in columns) + ")"


def sql_textual(c: str) -> str:
    return (
        f"(length({c}) >= 10 AND length(regexp_replace({c}, '[^\\p{{L}}]+', '', 'g')) "
        f">= greatest(5.0::DOUBLE, length({c}) * 0.3::DOUBLE))"
    )


def sql_clean(c: str) -> str:
    """Decode, drop scripts and comments, drop tags, decode again, collapse blanks."""

    def decoded(x: str) -> str:
        for entity, char in text.BARE_ENTITIES.items():
            x = f"regexp_replace({x}, '{entity};?', '{char}', 'g')"
        for entity, char in text.NAMED_ENTITIES.items():
            quote = char.replace("'", "''")
            x = f"replace({x}, '{entity}', '{quote}')"
        return f"regexp_replace({x}, '&amp;?', '&', 'g')"

    x = decoded(c)
    x = f"regexp_replace({x}, '(?is)<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>|<!--.*?-->', ' ', 'g')"
    x = f"regexp_replace({x}, '(?s)<[!?/a-zA-Z][^>]*>', ' ', 'g')"
    return f"trim(regexp_replace({decoded(x)}, '[ \\t\\n\\r\\f\\v\u00a0]+', ' ', 'g'))"


@query(
    "scan_csv_na",
    """SELECT d.doc_id::VARCHAR AS doc_id, md5(d.text) AS text_md5, l.quality::VARCHAR AS quality, l.toxic::VARCHAR AS toxic
    FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def scan_csv_na(spark, sf):
    """Labels of unlabelled documents written as null tokens come back as nulls, multi-line texts whole."""
    labels = table(spark, sf, "labels")
    out = table(spark, sf, "documents").join(labels, "doc_id", "left").select(
        "doc_id",
        "text",
        F.coalesce(F.col("quality").cast("string"), F.lit("NA")).alias("quality"),
        F.coalesce(F.col("toxic").cast("string"), F.lit("None")).alias("toxic"),
    )
    path = scratch(spark, "csv")
    write_csv(out, path)
    return scan_csv(spark, path).select("doc_id", F.md5("text").alias("text_md5"), "quality", "toxic")


@query(
    "scan_csv_any_size",
    """SELECT doc_id::VARCHAR AS doc_id, md5(replace(text, chr(10), chr(13) || chr(10))) AS text_md5 FROM documents
    UNION ALL SELECT 'doc_id', md5('text') FROM documents WHERE doc_id % 10 = 0""",
)
def scan_csv_any_size(spark, sf):
    """Files split at lines as large ones are: Windows line breaks inside cells stay, rows equal to the header are data."""
    docs = table(spark, sf, "documents")
    out = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.replace("text", F.lit("\n"), F.lit("\r\n")).alias("text"))
    headers = docs.where("doc_id % 10 = 0").select(F.lit("doc_id").alias("doc_id"), F.lit("text").alias("text"))
    path = scratch(spark, "csv")
    write_csv(out.unionByName(headers), path)
    return scan_csv(spark, path, whole_file_bytes=0).select("doc_id", F.md5("text").alias("text_md5"))


@query("scan_json_props", "SELECT event_id, event_type, (props->>'k')::BIGINT AS k FROM events")
def scan_json_props(spark, sf):
    events = table(spark, sf, "events")
    path = scratch(spark, "json")
    # each line is one document: {"id": ..., "type": ..., "props": {...}}
    line = F.concat(
        F.lit('{"id":'), "event_id", F.lit(',"type":"'), "event_type", F.lit('","props":'), "props", F.lit("}")
    )
    events.select(line).write.text(path)
    v = F.col("v")
    return scan_json(spark, path, lines=True).select(
        F.variant_get(v, "$.id", "bigint").alias("event_id"),
        F.variant_get(v, "$.type", "string").alias("event_type"),
        F.variant_get(v, "$.props.k", "bigint").alias("k"),
    )


@query(
    "sink_csv_flat",
    """SELECT d.doc_id || ',' || d.lang || ',' || coalesce(l.quality::VARCHAR, '') || ',' || coalesce(l.toxic::VARCHAR, '') AS line
    FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def sink_csv_flat(spark, sf):
    flat = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    path = scratch(spark, "flat")
    write_csv(flatten.fill_missing(flat.select("doc_id", "lang", "quality", "toxic")), path)
    return spark.read.text(path).where("value <> 'doc_id,lang,quality,toxic'").withColumnRenamed("value", "line")


def _profile_sql(name: str, key: str, columns: list[str]) -> str:
    parts = [
        f"""SELECT '{c}' AS col, {i} AS place, (SELECT count({c}) FROM {name}) AS non_null,
        (SELECT count(DISTINCT {c}) FROM {name}) AS distinct_values,
        (SELECT avg(length(v)) FROM (SELECT {c} AS v FROM {name} WHERE {c} IS NOT NULL ORDER BY {key} LIMIT 200)) AS avg_len"""
        for i, c in enumerate(columns)
    ]
    return f"""SELECT '{name}' AS table_name, col, non_null, distinct_values, round(avg_len, 6) AS avg_len, candidate,
      CASE WHEN candidate THEN (row_number() OVER (PARTITION BY candidate ORDER BY place))::INT END AS rank
      FROM (SELECT *, distinct_values <= greatest(2000, floor(non_null * 0.9)) AND avg_len >= 5 AS candidate
      FROM ({" UNION ALL ".join(parts)}))"""


PROFILED = [
    ("documents", "doc_id", ["text", "lang", "source"]),
    ("customer", "c_custkey", ["c_name", "c_mktsegment"]),
    ("part", "p_partkey", ["p_name", "p_brand", "p_type"]),
    ("pages", "page_id", ["url", "html"]),
]


@query("profile_text_columns", " UNION ALL ".join(f"({_profile_sql(*p)})" for p in PROFILED))
def profile_text_columns(spark, sf):
    out: DataFrame | None = None
    for name, key, columns in PROFILED:
        one = profile.profile_columns(table(spark, sf, name), key, columns).select(
            F.lit(name).alias("table_name"),
            F.col("column").alias("col"),
            "non_null",
            F.col("distinct").alias("distinct_values"),
            F.round("avg_len", 6).alias("avg_len"),
            "candidate",
            "rank",
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "build_text",
    f"""SELECT d.doc_id, md5({sql_text("d.lang", "l.quality::VARCHAR", "d.text", "d.source")}) AS text_md5
    FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def build_text(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select("doc_id", F.md5(text.build_text(["lang", "quality", "text", "source"])).alias("text_md5"))


@query(
    "min_len_filter",
    f"SELECT doc_id, length({sql_text('text')}) AS n FROM documents WHERE length({sql_text('text')}) >= 10",
)
def min_len_filter(spark, sf):
    found = text.kept(text.build_text(["text"]), lambda t: F.length(t) >= text.MIN_TEXT_LEN)
    return table(spark, sf, "documents").select("doc_id", found.alias("t")).select("doc_id", F.length("t").cast("bigint").alias("n"))


@query(
    "row_id_sha1",
    """SELECT d.doc_id, sha1(concat_ws('|', d.source, coalesce(l.quality::VARCHAR, ''), d.doc_id::VARCHAR)) AS id
    FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def row_id_sha1(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select("doc_id", keys.row_id(["source", "quality", "doc_id"]).alias("id"))


@query("row_hash", f"SELECT doc_id, sha1({sql_text('lang', 'text')}) AS hash FROM documents")
def row_hash(spark, sf):
    built = text.build_text(["lang", "text"])
    return table(spark, sf, "documents").select("doc_id", keys.content_hash(built).alias("hash"))


@query(
    "chunk_id",
    """SELECT conv_id, turn, sha1(concat_ws('|', 'conversations', '', conv_id::VARCHAR, turn::VARCHAR, substring(text, 1, 64))) AS id
    FROM conversations""",
)
def chunk_id(spark, sf):
    missing = F.lit(None).cast("string")
    key = keys.chunk_id(F.lit("conversations"), missing, "conv_id", "turn", "text")
    return table(spark, sf, "conversations").select("conv_id", "turn", key.alias("id"))


@query(
    "surrogate_key",
    """SELECT count(*) AS ids, count(*) AS idhashes, 0::BIGINT AS negative, 0::BIGINT AS collisions
    FROM (SELECT DISTINCT url FROM pages UNION ALL SELECT DISTINCT sha1(text) FROM documents)""",
)
def surrogate_key(spark, sf):
    """Properties of the key: distinct like the ids, never negative, collisions reported."""
    ids = table(spark, sf, "pages").select(F.col("url").alias("id")).unionByName(
        table(spark, sf, "documents").select(F.sha1("text").alias("id"))
    )
    per_key = ids.distinct().groupBy(keys.surrogate_key("id").alias("idhash")).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.sum("n").alias("ids"),
        F.count("*").alias("idhashes"),
        F.count_if(F.col("idhash") < 0).alias("negative"),
        F.count_if(F.col("n") > 1).alias("collisions"),
    )


@query("clean_html", f"SELECT page_id, md5({sql_clean('html')}) AS text_md5 FROM pages")
def clean_html(spark, sf):
    """Parser tier."""
    return table(spark, sf, "pages").select("page_id", F.md5(text.clean_text("html")).alias("text_md5"))


@query("clean_html_native", f"SELECT page_id, md5({sql_clean('html')}) AS text_md5 FROM pages")
def clean_html_native(spark, sf):
    """Regex tier, without Python."""
    return table(spark, sf, "pages").select("page_id", F.md5(text.clean_text_native("html")).alias("text_md5"))


@query("looks_textual", f"SELECT doc_id, {sql_textual('text')} AS textual FROM documents")
def looks_textual(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.looks_textual("text").alias("textual"))


@query(
    "row_text_cells",
    f"""SELECT doc_id, md5(concat_ws(' ' || chr(10), CASE WHEN {sql_textual('t')} THEN t END,
      CASE WHEN {sql_textual('s')} THEN s END)) AS text_md5
    FROM (SELECT doc_id, {sql_clean('text')} AS t, 'taken from ' || source AS s FROM documents)""",
)
def row_text_cells(spark, sf):
    from ..operators.extract import text_of_cells

    cells = F.array(text.clean_text("text"), text.clean_text(F.concat(F.lit("taken from "), "source")))
    found = text.kept(text_of_cells(cells), lambda t: t != "")
    return table(spark, sf, "documents").select("doc_id", found.alias("t")).select("doc_id", F.md5("t").alias("text_md5"))


def sql_chunks(source: str, n_max: int, overlap: int) -> str:
    """Windows over ``source(key, text)`` as ``(key, position, text)``."""
    step = n_max - overlap
    return f"""SELECT key, (row_number() OVER (PARTITION BY key ORDER BY s) - 1)::INT AS position,
      CASE WHEN len(tokens) <= {n_max} THEN text ELSE array_to_string(tokens[s + 1 : s + {n_max}], ' ') END AS text
    FROM (SELECT *, unnest(range(0, greatest(len(tokens) - {overlap}, 1), {step})) AS s
      FROM (SELECT key, text, list_filter(string_split_regex(text, '[ \\t\\n\\r\\f\\v]+'), lambda t: t <> '') AS tokens
        FROM ({source}))) WHERE s = 0 OR len(tokens) > {n_max}"""


@query(
    "chunk_windows",
    f"""SELECT key AS doc_id, position, md5(text) AS text_md5
    FROM ({sql_chunks('SELECT doc_id AS key, text FROM documents', 512, 64)})""",
)
def chunk_windows(spark, sf):
    cut = table(spark, sf, "documents").select("doc_id", F.posexplode(chunk.windows("text")).alias("position", "text"))
    return cut.select("doc_id", "position", F.md5("text").alias("text_md5"))


@query(
    "chunk_conversations",
    f"""SELECT source, row_id, position, sha1(concat_ws('|', source, 'turns', row_id, position::VARCHAR, substring(text, 1, 64))) AS id
    FROM (SELECT split_part(key, '/', 1) AS source, split_part(key, '/', 2) AS row_id, position, text
      FROM ({sql_chunks("SELECT role || '/' || conv_id || '-' || turn AS key, text FROM conversations", 48, 12)}))""",
)
def chunk_conversations(spark, sf):
    """Turns as records, short windows, ids and per-record positions."""
    records = table(spark, sf, "conversations").select(
        F.col("role").alias("source"),
        F.lit("turns").alias("table_name"),
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("row_id"),
        "text",
    )
    return chunk.chunk_records(records, chunk.windows("text", 48, 12)).select("source", "row_id", "position", "id")


# nested documents, one per part, made by Spark from the part table

PART_JSON = """concat('{"part":{"key":', p_partkey, ',"names":["', p_name, '","', p_brand, '"]},"sizes":[{"size":',
  p_size, '},{"size":', p_size + 1, ',"type":"', p_type, '"}],"none":{},"flags":[true,null],"grid":[[1,2],[', p_size, ']]}')"""

FLAT_PATHS = {
    "flags": "'True, None'",
    "grid[0]": "'1, 2'",
    "grid[1]": "p_size::VARCHAR",
    "part.key": "p_partkey::VARCHAR",
    "part.names": "p_name || ', ' || p_brand",
    "sizes[0].size": "p_size::VARCHAR",
    "sizes[1].size": "(p_size + 1)::VARCHAR",
    "sizes[1].type": "p_type",
}


def _part_documents(spark, sf):
    docs = spread(table(spark, sf, "part")).select(F.col("p_partkey").alias("rec_id"), F.expr(PART_JSON).alias("json"))
    return parse_documents(docs, F.col("json"), ["rec_id"])[0]


@query("flatten_props", "SELECT event_id, 'k' AS path, props->>'k' AS value FROM events")
def flatten_props(spark, sf):
    parsed, _ = parse_documents(spread(table(spark, sf, "events")), F.col("props"), ["event_id"])
    return flatten.flatten_long(parsed, key="event_id")


@query(
    "flatten_long",
    " UNION ALL ".join(f"SELECT p_partkey AS rec_id, '{p}' AS path, {e} AS value FROM part" for p, e in FLAT_PATHS.items()),
)
def flatten_long(spark, sf):
    return flatten.flatten_long(_part_documents(spark, sf))


@query("flatten_wide", "SELECT p_partkey AS rec_id, " + ", ".join(f'{e} AS "{p}"' for p, e in FLAT_PATHS.items()) + " FROM part")
def flatten_wide(spark, sf):
    return flatten.flatten_wide(_part_documents(spark, sf))


@query("flat_shape", f"SELECT count(*) AS n_rows, {len(FLAT_PATHS)}::BIGINT AS n_columns FROM part")
def flat_shape(spark, sf):
    return flatten.shape(flatten.flatten_wide(_part_documents(spark, sf)))


@query(
    "job_flatten",
    "SELECT p_partkey::VARCHAR AS \"part.key\", "
    + ", ".join(f'{e} AS "{p}"' for p, e in FLAT_PATHS.items() if p != "part.key")
    + " FROM part",
)
def job_flatten(spark, sf):
    """JSON files to a flat CSV, read back."""
    from .jobs import flatten_json

    json, out = scratch(spark, "json"), scratch(spark, "flat")
    table(spark, sf, "part").select(F.expr(PART_JSON)).write.text(json)
    flatten_json(spark, json, out, lines=True)
    return scan_csv(spark, out)


@query(
    "result_preview",
    """SELECT doc_id, CASE WHEN length(text) > 160 THEN substring(text, 1, 160) || '…' ELSE text END AS preview,
      CASE WHEN length(text) > 400 THEN substring(text, 1, 400) || '...' ELSE text END AS card,
      source || '.txt' AS title, round(n_chars / 7.0::DOUBLE, 2) AS score FROM documents""",
)
def result_preview(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        text.preview("text").alias("preview"),
        text.preview("text", 400, "...").alias("card"),
        text.base_name(F.concat(F.lit("/data/"), "lang", F.lit("/"), "source", F.lit(".txt"))).alias("title"),
        F.round(F.col("n_chars") / F.lit(7.0), 2).alias("score"),
    )
