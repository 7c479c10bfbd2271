"""Queries against their SQL on tables with rows that the test tables lack."""

import os

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vecloom.functions.encoder import HashingEncoder
from vecloom.plans.queries import ORACLES, QUERIES
from vecloom.session import BATCH_BYTES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def differences(spark, folder, name, **tables):
    """``(missing, surplus)`` rows of a query over the test tables with some of them replaced; a value gives a table's files as SELECTs."""
    con = duckdb.connect()
    for file in os.listdir(SF):
        t = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{file}'")
        if t not in tables:
            os.symlink(f"{SF}/{file}", folder / file)
    for t, selects in tables.items():
        (folder / f"{t}.parquet").mkdir()
        for i, select in enumerate(selects):
            con.execute(f"COPY ({select}) TO '{folder}/{t}.parquet/part-{i}.parquet' (FORMAT parquet)")
    for t in tables:
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    df = QUERIES[name](spark, str(folder))
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    want = sorted(repr(tuple(row)) for row in result.fetchall())
    got = sorted(repr(tuple(row[c] for c in names)) for row in df.collect())
    return [w for w in want if w not in set(got)], [g for g in got if g not in set(want)], len(got) - len(want)


def test_embeddings_of_texts_without_a_bucket_and_sums_next_to_zero(spark, tmp_path):
    encoder = HashingEncoder()
    slots = {f"w{i}": encoder._slot(f"w{i}") for i in range(3000)}
    bucket, sign = slots["w0"]
    against = next(w for w, s in slots.items() if s == (bucket, -sign))

    def total(text):
        return sum(float(x) * (i + 1) for i, x in enumerate(encoder.encode([text])[0]))

    by_slot = {s: w for w, s in slots.items()}
    pairs = (f"{a} {a} {a} {by_slot[3 * b + 2, -s]}" for a, (b, s) in slots.items() if (3 * b + 2, -s) in by_slot)
    below = next(t for t in pairs if -1e-5 < total(t) < 0)
    assert np.all(encoder.encode([f"w0 {against}"]) == 0)
    texts = ", ".join([f"({900000 + i}, {t}, 'en', 'web', 1)" for i, t in enumerate([f"'w0 {against}'", "''", "' '", "NULL", f"'{below}'"])])
    docs = ["documents", f"(VALUES {texts}) t(doc_id, text, lang, source, n_chars)"]
    docs = [f"SELECT doc_id::BIGINT AS doc_id, text, lang, source, n_chars::BIGINT AS n_chars FROM {d}" for d in docs]
    assert differences(spark, tmp_path, "embed_documents", documents=docs) == ([], [], 0)


def repeated_pages():
    """Pages in two files, urls standing in both: once with the same markup, once with another that begins alike."""
    head = "<p>" + "words that begin a page and go on for a while until they differ " * 2
    more = f"SELECT page_id + 1000000 AS page_id, url, CASE WHEN page_id % 2 = 0 THEN html ELSE '{head}' || page_id || '</p>' END AS html FROM pages WHERE page_id < 20"
    first = f"SELECT page_id, url, CASE WHEN page_id % 2 = 1 AND page_id < 20 THEN '{head}' || '</p>' ELSE html END AS html FROM pages"
    return [first, more]


def test_stream_of_pages_with_repeated_urls(spark, tmp_path):
    assert differences(spark, tmp_path, "stream_ingest", pages=repeated_pages()) == ([], [], 0)


def test_dump_of_pages_with_repeated_urls(spark, tmp_path):
    assert differences(spark, tmp_path, "job_sql_dump", pages=repeated_pages()) == ([], [], 0)


def test_batches_of_long_rows_stay_small(spark, tmp_path):
    """Registered queries bound a Python worker's batch by its bytes."""
    QUERIES["sql_row_id"](spark, SF)
    long = spark.range(400, numPartitions=1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    sizes = long.mapInArrow(lambda batches: (pa.record_batch([pa.array([b.nbytes])], names=["n"]) for b in batches), "n bigint").collect()
    assert sum(r["n"] for r in sizes) > 40_000_000
    assert max(r["n"] for r in sizes) < 2 * BATCH_BYTES
