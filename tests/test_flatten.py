import csv
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecloom.operators import flatten
from vecloom.plans import jobs
from vecloom.plans.queries import QUERIES
from vecloom.sources.csv import scan_csv, write_csv
from vecloom.sources.json import parse_documents, scan_json

SHAPES = [
    ({"a": {"b": 1}}, {"a.b": "1"}),
    ({"t": ["x", 2, True, None]}, {"t": "x, 2, True, None"}),
    ({"t": []}, {"t": ""}),
    ({"o": {}}, {}),
    ({"r": [{"x": 1}, {"x": 2}]}, {"r[0].x": "1", "r[1].x": "2"}),
    ({"m": [1, {"x": 2}]}, {"m[0]": "1", "m[1].x": "2"}),
    ({"n": [[1, 2], [3]]}, {"n[0]": "1, 2", "n[1]": "3"}),
    ({"f": [1.5, 1.0, 1e16, 1e-05, 0.0001, 123456789.125, -2.0]}, {"f": "1.5, 1.0, 1e+16, 1e-05, 0.0001, 123456789.125, -2.0"}),
    ({"b": False, "z": None, "big": 12345678901234567890}, {"b": "False", "z": None, "big": "12345678901234567890"}),
    ({"d.o t": {"`<": 1}}, {"d.o t.`<": "1"}),
]


def long_form(spark, docs):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "rec_id int, j string")
    parsed, bad = parse_documents(df, F.col("j"), ["rec_id"])
    assert bad.count() == 0
    out = [{} for _ in docs]
    for r in flatten.flatten_long(parsed).collect():
        out[r["rec_id"]][r["path"]] = r["value"]
    return out


def test_shapes(spark):
    assert long_form(spark, [d for d, _ in SHAPES]) == [w for _, w in SHAPES]


KEYS = st.text("abc", min_size=1, max_size=2)
TREES = st.recursive(
    st.none() | st.booleans() | st.integers(-(10**9), 10**9) | st.text("xyz é", max_size=4),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(KEYS, inner, max_size=3),
    max_leaves=8,
)


def leaves(value, path=""):
    """Independent check: (path, text) of a document."""
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in leaves(v, f"{path}.{k}" if path else k)]
    if isinstance(value, list) and any(isinstance(v, (dict, list)) for v in value):
        return [x for i, v in enumerate(value) for x in leaves(v, f"{path}[{i}]")]
    if isinstance(value, list):
        return [(path, ", ".join(str(v) for v in value))]
    return [(path, None if value is None else str(value))]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.dictionaries(KEYS, TREES, max_size=3), min_size=1, max_size=5))
def test_random_documents(spark, docs):
    assert long_form(spark, docs) == [dict(leaves(d)) for d in docs]


def test_duplicate_keys_are_quarantined(spark):
    df = spark.createDataFrame([(1, '{"a":1,"a":2}'), (2, '{"a":1}'), (3, None), (4, "{oops")], "rec_id int, j string")
    good, bad = parse_documents(df, F.col("j"), ["rec_id"])
    assert [r[0] for r in good.select("rec_id").collect()] == [2]
    assert sorted(r[0] for r in bad.select("rec_id").collect()) == [1, 4]


def test_root_list_and_root_object_to_csv(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "list.json").write_text(json.dumps([{"a": 1, "b": {"c": 'say "x",\nthen y'}}, {"a": None}]))
    (tmp_path / "in" / "one.json").write_text(json.dumps({"d": [1, 2]}))
    assert scan_json(spark, str(tmp_path / "in")).count() == 3
    flat = jobs.flatten_json(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert flat.columns == ["a", "b.c", "d"]
    assert flatten.shape(flat).first().asDict() == {"n_rows": 3, "n_columns": 3}
    back = {tuple(r) for r in scan_csv(spark, str(tmp_path / "out"), na_tokens=()).na.fill("").collect()}
    assert back == {("1", 'say "x",\nthen y', ""), ("", "", ""), ("", "", "1, 2")}


@pytest.mark.parametrize("indent", [None, 1])
def test_huge_list_is_split(spark, tmp_path, indent):
    """Lists over many splits, cuts inside strings and nested objects, elements of every kind."""
    docs = []
    for i in range(90):
        docs.append({"i": i, "s": 'a}, "b\\', "n": [{"x": {"y": i}}, {"z": '},{"'}], "e": {}})
        docs += [[i, "},", [{}]], i, "text }, here", None, True][: i % 7]
    (tmp_path / "big.json").write_text(json.dumps(docs, indent=indent))
    (tmp_path / "other.json").write_text(" \n" + json.dumps([[{"k": [1, {"m": "}, "}]}, 7]] * 40))
    (tmp_path / "small.json").write_text(json.dumps({"one": 1}))
    root = {"root": ["}, {", {"n": list(range(200))}]}
    (tmp_path / "object.json").write_text("\n " + json.dumps(root, indent=indent))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        got = scan_json(spark, str(tmp_path), whole_file_bytes=100).select(F.to_json("v")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    key = lambda d: json.dumps(d, sort_keys=True)
    want = [*docs, *[[{"k": [1, {"m": "}, "}]}, 7]] * 40, {"one": 1}, root]
    assert sorted(key(json.loads(r[0])) for r in got) == sorted(map(key, want))


def test_malformed_file_is_an_error(spark, tmp_path):
    (tmp_path / "bad.json").write_text('[{"a": 1}, {"a": ')
    with pytest.raises(Exception):
        scan_json(spark, str(tmp_path)).collect()


def test_five_thousand_paths_to_csv(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(flatten, "CELLS", 12_000)  # some rows per batch
    docs = [{f"k{i * 1000 + j:04d}": f"{i}-{j}" for j in range(1000)} for i in range(5)] + [{}, {"k0007": None, "k4999": 'a "b",\nc'}]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "rec_id int, j string")
    parsed, _ = parse_documents(df, F.col("j"), ["rec_id"])
    wide = flatten.flatten_wide(parsed)
    assert wide.columns == ["rec_id", *[f"k{i:04d}" for i in range(5000)]]
    write_csv(wide.orderBy("rec_id"), str(tmp_path / "wide"))
    with open(next((tmp_path / "wide").glob("*.csv")), newline="") as f:
        header, *lines = csv.reader(f)
    got = [dict(zip(header, line, strict=True)) for line in lines]
    want = [{"rec_id": str(i), **{f"k{k:04d}": "" for k in range(5000)}, **{k: v or "" for k, v in d.items()}} for i, d in enumerate(docs)]
    assert sorted(got, key=lambda r: r["rec_id"]) == want


def test_wide_form_with_given_paths_and_a_path_like_the_key(spark):
    df = spark.sql("""SELECT 1 AS rec_id, parse_json('{"rec_id":5,"a":{"b":1},"c":2}') AS v""")
    out = flatten.flatten_wide(df, paths=["c", "rec_id", "gone"])
    assert out.columns == ["rec_id", "c", "rec_id", "gone"] and tuple(out.first()) == (1, "2", "5", "")


def test_typed_struct(spark):
    df = spark.sql(
        """SELECT 7 AS id, named_struct('a', named_struct('b', 1.5D), 'r', array(named_struct('x', 1), named_struct('x', 2)),
        't', array(true, null), 'g', array(array(1, 2), array(3))) AS s"""
    )
    out = flatten.flatten_struct(df, "s")
    assert out.first().asDict() == {
        "id": 7, "a.b": "1.5", "t": "True, None", "r[0].x": "1", "r[1].x": "2", "g[0]": "1, 2", "g[1]": "3",
    }


def test_fill_missing(spark):
    out = flatten.fill_missing(spark.createDataFrame([(1, None)], "`a.b` int, c string"))
    assert out.first().asDict() == {"a.b": "1", "c": ""}


@pytest.mark.parametrize("name", ["flatten_long", "flatten_props"])
def test_one_row_group_is_unrolled_by_all_cores(spark, name):
    """The scan of such a file is one task; each record is parsed once, whatever is filtered."""
    out = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert out.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    assert out._jdf.queryExecution().optimizedPlan().toString().count("parseJson(") == 1


def test_depth_sees_no_brackets_in_strings(spark):
    docs = [{"a": '[[{"[', "b{": [[1]]}, {'x"]': "\\", "y": "}{", "z": {}}]
    for doc, levels in zip(docs, (3, 2)):
        df = spark.createDataFrame([(0, json.dumps(doc))], "rec_id int, j string")
        assert flatten.depth(parse_documents(df, F.col("j"), ["rec_id"])[0]) == levels
    assert long_form(spark, docs) == [{"a": '[[{"[', "b{[0]": "1"}, {'x"]': "\\", "y": "}{"}]
