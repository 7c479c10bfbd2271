import pytest
from pyspark.sql import functions as F

from vecloom.operators import profile, sync
from vecloom.plans import jobs
from vecloom.sources.csv import NA_TOKENS, ORDINAL, quoted_after, scan_csv
from vecloom.sources.store import RowStore, last_wins

HEAD = "index,_id,_source.file_name_text,_source.customer,num,flag,short\n"
FIRST = HEAD + '''1,a1,"first ""quoted"" file,
with a second line",Customer One GmbH,123456,True,ab
2,a2, second file name ,NA,234567,False,cd
3,a3,tiny,None,345678,True,ef
4,a4,exactly 10,null,456789,False,
5,a5,to be removed later,,567890,True,gh
'''
SECOND = HEAD + '''1,a1,"first ""quoted"" file,
with a second line",Customer Two GmbH,123456,True,ab
2,a2, second file name ,NA,234567,False,cd
4,a4,shortened,null,456789,False,
6,a6,added in the end,,1,True,gh
'''
KEYS = {"key_columns": ["_id"], "text_columns": ["_source.file_name_text", "_source.customer"]}


def write(path, text):
    path.write_text(text)
    return str(path)


def row(i, text="t", source="s", width=2):
    return (i, source, None, None, 0, text, [float(len(text))] * width)


def rows(spark, *items):
    return spark.createDataFrame(list(items), "id string, source string, table_name string, row_id string, position int, text string, embedding array<float>")


def texts(store, version=None):
    return {r["id"]: r["text"] for r in store.read(version).collect()}


def test_scan_csv_null_tokens_and_quotes(spark, tmp_path):
    df = scan_csv(spark, write(tmp_path / "a.csv", FIRST), with_origin=True).orderBy(ORDINAL)
    got = df.select("`_source.file_name_text`", "`_source.customer`", "short").collect()
    assert [tuple(r) for r in got] == [
        ('first "quoted" file,\nwith a second line', "Customer One GmbH", "ab"),
        (" second file name ", None, "cd"),
        ("tiny", None, "ef"),
        ("exactly 10", None, None),
        ("to be removed later", None, "gh"),
    ]


@pytest.mark.parametrize(
    "line, start, end",
    [
        ('a,b', False, False),
        ('a,"b', False, True),
        ('a,"b""', False, True),
        ('a,"b""",c', False, False),
        ('5" pipe,c', False, False),
        ('5" pipe,"c', False, True),
        ('rest",5" pipe', True, False),
        ('rest"" of it', True, True),
        ('rest","next', True, True),
        ('"x" y,"z"', False, False),
        ('', False, False),
        ('', True, True),
        ('"",""', False, False),
        ('"a,b', False, True),
    ],
)
def test_lines_inside_quoted_cells(line, start, end):
    assert quoted_after(line, start) is end


def test_csv_over_tiny_splits(spark, tmp_path):
    """Records with line breaks, stray quotes and blank lines, one file over many splits."""
    lines, want = ["id,text,note"], []
    for i in range(150):
        text = [f"plain {i}", f"two\nlines, {i}", f'say "{i}"\n\nand "more"', f'{i}" wide'][i % 4]
        raw = text if i % 4 in (0, 3) else '"' + text.replace('"', '""') + '"'
        lines.append(f"{i},{raw},end")
        if i % 10 == 0:
            lines.append("")
        want.append((str(i), text, "end"))
    write(tmp_path / "a.csv", "\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    try:
        write(tmp_path / "small.csv", "id,text,note\n0,small file,end\n")
        df = scan_csv(spark, str(tmp_path), with_origin=True, whole_file_bytes=1000)
        assert df.where("text = 'small file'").count() == 1
        df = df.where("text <> 'small file'")
        assert df.select(f"{ORDINAL}.offset").distinct().count() > 3
        assert [tuple(r)[:3] for r in df.orderBy(ORDINAL).collect()] == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_read_alike_at_any_size(spark, tmp_path):
    """Rows equal to the header, both line ends inside cells, blank lines, bytes that are no UTF-8, other headers."""
    body = b'\r\nid,text\r\n1,"two\r\nlines"\r\nid,text\r\n\r\n2,"one\nline\r\n"\r\n3,caf\xe9 \xff\xfe!\r\nid,text\r\n4,"a\rb"\r\n5,\xef\xbf\xbd'
    (tmp_path / "a.csv").write_bytes(body)
    (tmp_path / "b.csv").write_bytes(b'"id","the\ntext"\nid,text\n6,plain\n')
    got = [
        [tuple(r)[:2] for r in scan_csv(spark, str(tmp_path), with_origin=True, whole_file_bytes=size).orderBy(ORDINAL).collect()]
        for size in (1 << 20, 0, 60)
    ]
    assert got[0] == got[1] == got[2]
    assert got[1] == [
        ("1", "two\r\nlines"), ("id", "text"), ("2", "one\nline\r\n"), ("3", "caf\ufffd \ufffd\ufffd!"), ("id", "text"),
        ("4", "a\rb"), ("5", "\ufffd"), ("id", "text"), ("6", "plain"),
    ]


def test_every_null_token(spark, tmp_path):
    body = "k,v\n" + "".join(f'{i},"{t}"\n' for i, t in enumerate(NA_TOKENS)) + "x,nah\n"
    df = scan_csv(spark, write(tmp_path / "a.csv", body))
    assert df.where("v is not null").select("k").collect()[0][0] == "x"
    assert df.where("v is null").count() == len(NA_TOKENS)


def test_full_load_then_sync(spark, tmp_path):
    store = RowStore(spark, str(tmp_path / "store"), jobs.DEFAULT_DIM)
    path = tmp_path / "a.csv"
    assert jobs.ingest_csv(spark, write(path, FIRST), store, source="x", **KEYS) == {"added": 4, "removed": 0, "updated": 0}
    by_text = lambda: sorted(texts(store).values())
    assert by_text() == ["exactly 10", 'first "quoted" file,\nwith a second line \nCustomer One GmbH', "second file name", "to be removed later"]
    # rows of another source stay
    store.apply(adds=jobs.with_vectors(rows(spark, row("other", source="y")).drop("embedding")))
    write(path, SECOND)
    assert jobs.sync_csv(spark, str(path), store, source="x", **KEYS) == {"added": 1, "removed": 2, "updated": 0}
    assert by_text()[:2] == ["added in the end", 'first "quoted" file,\nwith a second line \nCustomer One GmbH']
    assert jobs.sync_csv(spark, str(path), store, source="x", detect_updates=True, **KEYS)["updated"] == 1
    assert "Customer Two" in by_text()[1]
    version = store.version()
    assert jobs.sync_csv(spark, str(path), store, source="x", detect_updates=True, **KEYS) == {"added": 0, "removed": 0, "updated": 0}
    assert store.version() == version
    assert store.ids("y").count() == 1
    assert all(len(r["embedding"]) == jobs.DEFAULT_DIM for r in store.read().collect())


def test_equal_keys_keep_the_later_row(spark, tmp_path):
    body = HEAD + "1,a,the earlier of two rows,,,,\n2,a,the later of two rows,,,,\n"
    store = RowStore(spark, str(tmp_path / "store"), jobs.DEFAULT_DIM)
    jobs.ingest_csv(spark, write(tmp_path / "a.csv", body), store, **KEYS)
    assert list(texts(store).values()) == ["the later of two rows"]


def test_store_versions(spark, tmp_path):
    store = RowStore(spark, str(tmp_path / "s"), 2)
    assert store.read().count() == 0 and store.version() == 0 and store.delete(rows(spark, row("a"))) == 0
    batch = rows(spark, row("a", "old"), row("a", "new!"), row("b", "bb")).withColumn("seq", F.length("text"))
    store.upsert(batch, "seq")
    assert texts(store) == {"a": "new!", "b": "bb"}
    store.upsert(rows(spark, row("b", "b again"), row("c", "c")).withColumn("seq", F.lit(1)), "seq")
    assert store.delete(spark.createDataFrame([("a",), ("zz",)], "id string")) == 1
    assert texts(store) == {"b": "b again", "c": "c"}
    # an id may come back after it was deleted
    store.apply(adds=rows(spark, row("a", "back")))
    assert texts(store) == {"a": "back", "b": "b again", "c": "c"}
    assert texts(store, 1) == {"a": "new!", "b": "bb"}
    store.compact()
    again = RowStore(spark, str(tmp_path / "s"))
    assert again.dim == 2 and texts(again) == {"a": "back", "b": "b again", "c": "c"}
    again.replace(rows(spark, row("d", "d", source="n")), source="n")
    again.replace(rows(spark, row("e", "e", source="s")), source="s")
    assert texts(again) == {"d": "d", "e": "e"}
    again.replace(rows(spark, row("f", "f")))
    assert texts(again) == {"f": "f"}


def test_store_widths_and_lost_races(spark, tmp_path):
    path = str(tmp_path / "s")
    store = RowStore(spark, path, 2)
    store.apply(adds=rows(spark, row("a")))
    with pytest.raises(ValueError):
        RowStore(spark, path, 3)
    with pytest.raises(Exception, match="vector is not 2 wide"):
        store.apply(adds=rows(spark, row("b", width=3)))
    assert texts(store) == {"a": "t"}
    stale = store._manifest()
    store.apply(adds=rows(spark, row("b")))
    with pytest.raises(Exception, match="already exists|exist"):
        store._commit(stale, [], [])
    assert sorted(texts(store)) == ["a", "b"]


def test_hot_id_is_collapsed(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"), F.col("id").alias("seq"))
    kept = last_wins(df, ["id"], "seq")
    assert kept.count() == 2001 and kept.where("id = 'hot'").first()["seq"] == 2997
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_snapshot_operators(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", None)], "id string, hash string")
    new = spark.createDataFrame([("b", "2"), ("c", None), ("d", "1")], "id string, hash string")
    assert [r[0] for r in sync.new_rows(new, old).select("id").collect()] == ["d"]
    assert [r[0] for r in sync.removed_rows(new, old).select("id").collect()] == ["a"]
    assert [r[0] for r in sync.changed_rows(new, old).select("id").collect()] == ["b"]
    diff = sync.snapshot_diff(new, old)
    assert dict(map(tuple, diff.collect())) == {"a": "removed", "b": "changed", "c": "same", "d": "new"}
    assert sync.sync_report(diff).first().asDict() == {"added": 1, "removed": 1, "changed": 1, "unchanged": 1}
    batch = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("e", "z", 1)], "id string, hash string, seq int")
    once = sync.upsert(old, batch, "seq")
    assert dict(map(tuple, once.collect())) == {"a": "y", "b": "1", "c": None, "e": "z"}
    assert sorted(map(tuple, sync.upsert(once, batch, "seq").collect())) == sorted(map(tuple, once.collect()))


def test_profile(spark):
    n = 2500
    df = spark.range(n).select(
        F.col("id").alias("ord"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("name of "), F.col("id") % 7)).alias("some text"),
        F.concat(F.lit("unique value "), F.col("id")).alias("unique"),
        F.lit(None).cast("string").alias("empty"),
        F.lit("abcd").alias("short"),
        (F.col("id") + 100000).cast("string").alias("number"),
        F.lit("True").alias("flag"),
        # short in the first 200 rows, long after them
        F.when(F.col("id") < 200, "x").otherwise("a long value").alias("late"),
        F.concat(F.lit("customer "), F.col("id") % 3).alias("_source.customer"),
    )
    got = {r["column"]: r for r in profile.profile_columns(df, "ord").collect()}
    assert "empty" not in got
    assert {c: (r["candidate"], r["rank"]) for c, r in got.items()} == {
        "some text": (True, 2),
        "unique": (False, None),
        "short": (False, None),
        "number": (False, None),
        "flag": (False, None),
        "late": (False, None),
        "_source.customer": (True, 1),
    }
    assert (got["some text"]["non_null"], got["some text"]["distinct"], got["late"]["avg_len"]) == (1250, 7, 1.0)
    assert profile.pick_text_columns(df, "ord") == ["_source.customer", "some text"]
    assert profile.pick_text_columns(df, "ord", ["short", "nope"]) == ["short"]


def test_at_most_twelve_columns(spark):
    df = spark.range(5).select(F.col("id").alias("ord"), *[F.concat(F.lit("words "), F.col("id")).alias(f"c{i}") for i in range(15)])
    assert profile.pick_text_columns(df, "ord") == [f"c{i}" for i in range(12)]


def test_key_columns():
    assert profile.pick_key_columns(["x", "_source.filename", "_id"]) == ["_id", "_source.filename"]
    assert profile.pick_key_columns(["x", "y"]) == ["x"]
    assert profile.pick_key_columns(["x", "y"], ["y", "z"]) == ["y"]
    with pytest.raises(ValueError):
        profile.pick_key_columns(["x"], ["y"])
