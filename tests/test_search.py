import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecloom.functions.encoder import HashingEncoder, encode_column
from vecloom.functions.vectors import aspect_ratio, cosine, l2_normalize, squared_l2
from vecloom.operators import identity, search
from vecloom.operators.sync import vector_quality
from vecloom.plans import jobs
from vecloom.session import materialise

DIM = 8


def frame(spark, m, key, vector, start=0):
    rows = [(i + start, [float(x) for x in r]) for i, r in enumerate(m)]
    return spark.createDataFrame(rows, f"{key} bigint, {vector} array<float>")


def brute(q, v, k, metric):
    q, v = np.asarray(q, np.float32).astype(float), np.asarray(v, np.float32).astype(float)
    out = []
    for i, a in enumerate(q):
        if metric == "ip":
            s = v @ a
        elif metric == "l2":
            s = -((v - a) ** 2).sum(1)
        else:
            n = np.linalg.norm(v, axis=1) * np.linalg.norm(a)
            s = np.where(n > 0, v @ a / np.where(n > 0, n, 1), np.nan)
        ranked = sorted((-round(x, 9), j) for j, x in enumerate(s) if not np.isnan(x))[:k]
        out += [(i, r + 1, j) for r, (_, j) in enumerate(ranked)]
    return out


def hits(df):
    return sorted((r["query_id"], r["rank"], r["id"]) for r in df.collect())


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    q, v = rng.standard_normal((30, DIM)), rng.standard_normal((400, DIM))
    v[17] = v[18] = v[250]  # equal vectors: ties go to the lower id
    v[5] = 0
    return q, v


@pytest.mark.parametrize("metric", ["ip", "l2", "cosine"])
@pytest.mark.parametrize("path", ["few queries", "few vectors", "blocks"])
def test_every_path_equals_brute_force(spark, data, metric, path, monkeypatch):
    q, v = data
    limit = {"few queries": 100, "few vectors": 20, "blocks": 10}[path]
    monkeypatch.setattr(search, "MAX_BROADCAST_ROWS", limit)
    if path == "few vectors":
        v = v[:20]
        v[17] = v[18] = v[3]
    got = search.top_k(frame(spark, q, "query_id", "query"), frame(spark, v, "id", "embedding"), 7, metric, block_rows=50)
    assert hits(got) == brute(q, v, 7, metric)


def test_batches_are_sliced(spark, data, monkeypatch):
    q, v = data
    monkeypatch.setattr(search, "MAX_SCORES", 90)
    got = search.top_k(frame(spark, q, "query_id", "query"), frame(spark, v, "id", "embedding"), 7)
    assert hits(got) == brute(q, v, 7, "ip")


def test_hot_cell_is_split_and_whole(spark, data, monkeypatch):
    """A third of all vectors equal one another: results stay exact over many blocks."""
    q, v = data
    v = v.copy()
    v[: len(v) // 3] = v[0]
    monkeypatch.setattr(search, "MAX_BROADCAST_ROWS", 10)
    got = search.top_k(frame(spark, q, "query_id", "query"), frame(spark, v, "id", "embedding"), 200, block_rows=40)
    assert hits(got) == brute(q, v, 200, "ip")


def test_string_ids_and_small_tables(spark):
    v = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", None)], "id string, embedding array<float>")
    q = spark.createDataFrame([(1, [2.0, 0.0])], "query_id bigint, query array<float>")
    rows = search.top_k(q, v, 5).orderBy("rank").collect()
    assert [(r["id"], r["score"]) for r in rows] == [("a", 2.0), ("b", 2.0)]
    assert search.top_k(q, v.limit(0), 5).count() == 0
    assert search.top_k(q.limit(0), v, 5).count() == 0


def test_bad_arguments_and_widths(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "id bigint, embedding array<float>")
    q = spark.createDataFrame([(1, [2.0, 0.0])], "query_id bigint, query array<float>")
    with pytest.raises(ValueError):
        search.top_k(q, v, 0)
    with pytest.raises(ValueError):
        search.top_k(q, v, 1, "hamming")
    with pytest.raises(Exception, match="differ in width"):
        search.top_k(q, v, 1).collect()


@pytest.mark.parametrize("limit", [1000, 5])
def test_cell_index(spark, data, tmp_path, monkeypatch, limit):
    q, v = data
    queries, vectors = frame(spark, q, "query_id", "query"), frame(spark, v, "id", "embedding")
    index = search.CellIndex.build(vectors, str(tmp_path / "cells"), cells=6)
    monkeypatch.setattr(search, "MAX_BROADCAST_ROWS", limit)
    exact = brute(q, v, 5, "ip")
    assert hits(index.search(queries, 5, nprobe=6, block_rows=60)) == exact
    recall = []
    for nprobe in (1, 3, 6):
        found = {(a, c) for a, _, c in hits(index.search(queries, 5, nprobe, block_rows=60))}
        recall.append(len(found & {(a, c) for a, _, c in exact}) / len(exact))
    assert recall == sorted(recall) and recall[-1] == 1.0


def test_hashed_search_is_a_subset_with_good_recall(spark, data):
    q, v = data
    queries, vectors = frame(spark, q, "query_id", "query"), frame(spark, v, "id", "embedding")
    near = search.hashed_top_k(queries, vectors, 5, "cosine", tables=12, bits=3, probes=2)
    exact = {(a, c) for a, _, c in brute(q, v, 5, "cosine")}
    found = {(r["query_id"], r["id"]): r["score"] for r in near.collect()}
    assert len(exact & set(found)) / len(exact) > 0.9
    # one bucket per table: every vector is a candidate
    assert hits(search.hashed_top_k(queries, vectors, 5, "ip", tables=1, bits=0)) == brute(q, v, 5, "ip")


def test_metadata_results_and_documents(spark):
    h = spark.createDataFrame([(1, "a", 0.98765, 1), (1, "gone", 0.5, 2), (1, "b", 0.25, 3)], "query_id bigint, id string, score double, rank int")
    rows = [("a", "/x/y.txt", "t", "r", None, None), ("b", "", "t", None, 2, "z" * 500)]
    chunks = spark.createDataFrame(rows, "id string, source string, table_name string, row_id string, position int, text string")
    found = search.with_metadata(h, chunks, max_hits=3)
    assert {r["id"]: (r["position"], len(r["text"])) for r in found.collect()} == {"a": (0, 0), "b": (2, 500)}
    cli = {r["rank"]: r for r in search.result_rows(found).collect()}
    assert (cli[1]["score"], cli[3]["row_id"], len(cli[3]["preview"])) == ("0.9877", "", 161)
    ui = {r["rank"]: r for r in search.result_cards(found).collect()}
    assert (ui[1]["title"], ui[3]["title"], ui[1]["score"], len(ui[3]["preview"])) == ("y.txt", "t", 0.99, 403)
    asked = spark.createDataFrame([(1, " q "), (2, "none"), (3, " \n")], "query_id bigint, q string")
    docs = {r["query_id"]: r for r in search.result_documents(found, search.query_table(asked)).collect()}
    assert sorted(docs) == [1, 2]
    assert docs[1]["query"] == "q" and [x["id"] for x in docs[1]["results"]] == ["a", "b"] and docs[2]["results"] == []


def test_encoder(spark):
    texts = ["Alpha beta", "alpha  BETA\n", "", None, "gamma"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(encode_column("t", lambda: HashingEncoder(16), 2)).collect()]
    assert got[0] == got[1] and got[3] is None and not any(got[2])
    assert np.allclose([np.linalg.norm(got[i]) for i in (0, 4)], 1, atol=1e-6)


def test_encoder_of_wrong_width_fails(spark):
    class Broken:
        dimension = 4

        def encode(self, texts):
            return np.zeros((len(texts), 3))

    df = spark.createDataFrame([("x",)], "t string")
    with pytest.raises(Exception, match="encoder gave shape"):
        df.select(encode_column("t", Broken)).collect()


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>")
    r = df.select(l2_normalize("a"), l2_normalize("z"), cosine("a", "z"), cosine("a", "a"), squared_l2("a", "z")).first()
    assert list(r) == [[0.6, 0.8], [0.0, 0.0], None, 1.0, 25.0]


def test_aspect_ratio(spark):
    points = [(0, 0), (1, 1), (3, 1), (4, 0), (3, -1), (1, -1)]
    df = spark.createDataFrame(
        [([(float(x), float(y)) for x, y in points],), ([(0.0, 0.0)] * 6,), (None,)], "p array<struct<x:double,y:double>>"
    )
    assert [r[0] for r in df.select(aspect_ratio("p")).collect()] == [0.5, None, None]


def test_vector_quality(spark):
    rows = [([1.0, 2.0],), (None,), ([1.0],), ([0.0, 0.0],), ([float("nan"), 1.0],)]
    got = vector_quality(spark.createDataFrame(rows, "embedding array<float>"), 2).first().asDict()
    assert got == {"rows": 5, "missing": 1, "wrong_width": 1, "broken": 1, "zero": 1}


@pytest.mark.parametrize("limit", [100, 1])
def test_match_gallery(spark, monkeypatch, limit):
    monkeypatch.setattr(search, "MAX_BROADCAST_ROWS", limit)
    users = [(2, "two", [1.0, 0.0]), (1, "one", [2.0, 0.0]), (3, "three", [0.0, 1.0]), (4, "zero", [0.0, 0.0])]
    gallery = spark.createDataFrame(users, "user_id bigint, name string, embedding array<float>")
    probes = [("tie", [5.0, 0.0]), ("nil", [0.0, 0.0]), ("far", [-1.0, -1.0]), ("up", [0.1, 1.0]), ("null", None)]
    p = spark.createDataFrame(probes, "probe_id string, embedding array<float>")
    got = {r["probe_id"]: (r["user_id"], r["name"], r["score"] and round(r["score"], 4)) for r in identity.match_gallery(p, gallery).collect()}
    assert got == {
        "tie": (1, "one", 1.0),
        "nil": (None, "Unknown", None),
        "far": (None, "Unknown", -0.7071),
        "up": (3, "three", 0.995),
        "null": (None, "Unknown", None),
    }
    # a cosine of exactly one half is not above it
    edge = spark.createDataFrame([("half", [1.0, 1.0, 1.0, 1.0])], "probe_id string, embedding array<float>")
    only = spark.createDataFrame([(1, "one", [1.0, 0.0, 0.0, 0.0])], "user_id bigint, name string, embedding array<float>")
    assert identity.match_gallery(edge, only).first()["name"] == "Unknown"
    assert identity.match_gallery(edge, only, 0.49).first()["name"] == "one"


@settings(max_examples=4, deadline=None)
@given(st.integers(1, 6), st.integers(1, 30), st.integers(1, 12), st.sampled_from(["ip", "l2"]))
def test_random_sizes(spark, nq, nv, k, metric):
    rng = np.random.default_rng(nq * 100 + nv)
    q, v = rng.integers(-2, 3, (nq, 3)), rng.integers(-2, 3, (nv, 3))
    got = search.top_k(frame(spark, q, "query_id", "query"), frame(spark, v, "id", "embedding"), k, metric)
    assert hits(got) == brute(q, v, k, metric)


def test_searchers_by_factory_name(spark, tmp_path):
    words = ["red box", "green box", "blue bag", "yellow bag of apples", "a red apple"]
    rows = [(str(i), "s", "t", str(i), 0, w) for i, w in enumerate(words)]
    store = jobs.with_vectors(spark.createDataFrame(rows, "id string, source string, table_name string, row_id string, position int, text string"))
    store = materialise(store, "rows")
    asked = spark.createDataFrame([(1, " Red box "), (2, "\t")], "query_id bigint, q string")

    def best(**how):
        found = jobs.search_texts(asked, store, 2, **how).orderBy("rank").collect()
        return [(r["query_id"], r["text"]) for r in found]

    exact = best()
    assert exact[0] == (1, "red box") and len(exact) == 2
    for factory in ("Flat", "IVF2,Flat"):
        assert best(find=jobs.searcher(store, factory, path=str(tmp_path / "cells"))) == exact
    assert best(find=jobs.searcher(store, "HNSW32"))[0] == exact[0]
    with pytest.raises(ValueError):
        jobs.searcher(store, "PQ8")
    own = spark.createDataFrame([(1, "red box", 1), (2, "bag", 3), (3, " ", 9)], "query_id bigint, q string, k int")
    counts = {r["query_id"]: r["count"] for r in jobs.search_texts(own, store).groupBy("query_id").count().collect()}
    assert counts == {1: 1, 2: 3}


def test_repeated_ids(spark):
    v = frame(spark, np.eye(4), "id", "embedding")
    q = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0, 0.0])], "query_id bigint, query array<float>")
    with pytest.raises(ValueError, match="query_id"):
        search.top_k(q, v, 2)


def test_repeated_probes_are_matched_each_on_both_paths(spark, monkeypatch):
    gallery = spark.createDataFrame([(k, f"u{k}", [float(k == j) for j in range(4)]) for k in range(4)], "user_id bigint, name string, embedding array<float>")
    probes = spark.createDataFrame([(7, [1.0, 0.0, 0.0, 0.0]), (7, [0.0, 0.0, 1.0, 0.0])], "probe_id bigint, embedding array<float>")
    rows = lambda: sorted((r["probe_id"], r["user_id"]) for r in identity.match_gallery(probes, gallery).collect())
    assert rows() == [(7, 0), (7, 2)]
    monkeypatch.setattr(search, "MAX_BROADCAST_ROWS", 1)
    assert rows() == [(7, 0), (7, 2)]
    with pytest.raises(ValueError, match="user_id"):
        identity.match_gallery(probes, gallery.unionByName(gallery))


def test_a_large_gallery_meets_each_different_probe_once(spark, monkeypatch):
    """Frames that show one face again add no pairs of vectors to compare."""
    monkeypatch.setattr(search, "MAX_BROADCAST_ROWS", 1)
    asked, plain = [], search.top_k

    def counted(queries, *args, **kwargs):
        asked.append(queries.count())
        return plain(queries, *args, **kwargs)

    monkeypatch.setattr(identity, "top_k", counted)
    gallery = spark.createDataFrame([(k, f"u{k}", [float(k == j) for j in range(3)]) for k in range(3)], "user_id bigint, name string, embedding array<float>")
    shown = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.1], None]
    probes = spark.createDataFrame([(i, shown[i % 3]) for i in range(60)], "probe_id bigint, embedding array<float>")
    got = {r["probe_id"]: r["user_id"] for r in identity.match_gallery(probes, gallery).collect()}
    assert got == {i: (0, 1, None)[i % 3] for i in range(60)}
    assert asked == [2]
