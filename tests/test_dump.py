import pytest
from pyspark.sql import functions as F

from vecloom.operators import extract
from vecloom.plans import jobs
from vecloom.sources import pieces
from vecloom.sources.sqldump import BLOCK, CODE, STRING, scan_statements, state_after
from vecloom.sources.store import RowStore

DUMP = r"""-- A single line comment that is long enough
/* block comment on one line, long enough */
/* first line of a long block comment
   second line of the block comment */
INSERT INTO `assets` (`name`,`id`,`note`) VALUES
 ('Avocado pieces in a box', 7, 'fresh &amp; <b>green</b> product'),
 ('short', 8, NULL),
 ('a text with ; and, comma (and parens)', 9, 'it\'s escaped here');
INSERT INTO nocols VALUES (1,'no column list, so this row is skipped');
CREATE TABLE ignored (id INT);
"""


@pytest.fixture
def dump(tmp_path):
    path = tmp_path / "a.sql"
    path.write_text(DUMP)
    return str(path)


def records(spark, path):
    rows = extract.text_records(scan_statements(spark, path)).collect()
    return sorted((r["table_name"] or "", r["row_id"] or "", r["text"]) for r in rows)


def test_fixture(spark, dump):
    assert records(spark, dump) == [
        ("", "", "A single line comment that is long enough"),
        ("", "", "block comment on one line, long enough"),
        ("", "", "first line of a long block comment"),
        ("", "", "second line of the block comment"),
        ("assets", "7", "Avocado pieces in a box \nfresh & green product"),
        ("assets", "9", "a text with ; and, comma (and parens) \nit's escaped here"),
    ]


def test_dry_run_counts(spark, dump):
    assert {r["table_name"]: r["records"] for r in jobs.dry_run(spark, dump).collect()} == {
        None: 4,
        "assets": 2,
        "(total)": 6,
    }


def test_cuts_in_strings_and_comments_are_mended_in_tiny_splits(spark, tmp_path):
    """One file over many splits, every other statement holding a cut."""
    parts, want = [], []
    for i in range(120):
        if i % 3 == 0:
            parts.append(f"/* remark number {i} holds a cut;\nand then goes on here */\n")
            want += [("", "", f"remark number {i} holds a cut;"), ("", "", "and then goes on here")]
        body = f"first part of text {i};\nsecond part; with it\\'s quote" if i % 2 else f"plain text of the row {i}"
        parts.append(f"INSERT INTO t (id, v) VALUES ({i}, '{body}');\n")
        want.append(("t", str(i), " ".join(body.replace("\\", "").split())))
    (tmp_path / "cut.sql").write_text("".join(parts))
    (tmp_path / "whole.sql").write_text("INSERT INTO u (k, v) VALUES ('k1', 'a file without any cut');\n")
    want.append(("u", "k1", "a file without any cut"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        statements = scan_statements(spark, str(tmp_path))
        assert statements.select("block").distinct().count() > 3
        assert records(spark, str(tmp_path)) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(
    "text, start, end",
    [
        ("a 'b' c", CODE, CODE),
        ("a 'b", CODE, STRING),
        ("a 'b''", CODE, STRING),
        ("a 'b\\'", CODE, STRING),
        ("a 'b\\", CODE, STRING),
        ("it''s', 2", STRING, CODE),
        ("still", STRING, STRING),
        ("/* x", CODE, BLOCK),
        ("/* ' */", CODE, CODE),
        ("x */ 'y", BLOCK, STRING),
        ("-- it's\n'", CODE, STRING),
        ("-- it's", CODE, CODE),
        ("'/*'", CODE, CODE),
    ],
)
def test_lexical_state(text, start, end):
    assert state_after(text, start) == end


@pytest.mark.parametrize(
    "values, want",
    [
        ("(1,'a'),(2, 'b')", [["1", "a"], ["2", " b"]]),
        ("(1,'it''s')", [["1", "it's"]]),
        ("(1,'a\\'b\\\\')", [["1", "a'b\\"]]),
        ("('x\\ny')", [["xny"]]),
        ("(NOW(), f(1,2), 'z')", [["NOW()", " f(1,2)", " z"]]),
        ("(1) ON DUPLICATE KEY UPDATE a=VALUES(a)", [["1"]]),
        ("('a,(b);c')", [["a,(b);c"]]),
        ("()", [[""]]),
        ("('open", []),
    ],
)
def test_value_tuples(values, want):
    assert list(extract.value_tuples(values)) == want


def test_row_id_choice(spark):
    rows = [("`name`, `UUID`", ["n", " u "]), ("a,b", ["x", "y"]), ("a,id", ["only"]), ("id", ["  "]), ("pk,id", ["p", "i"])]
    df = spark.createDataFrame(rows, "cols string, cells array<string>")
    got = [r[0] for r in df.select(extract.row_id_of("cols", "cells")).collect()]
    assert got == ["u", "x", None, None, "p"]


def test_comment_forms():
    body = "CREATE TABLE wide ( /* note */ a int /* second */\n-- line\n  -- indented\nx -- trailing\n/* a\n b */ tail /* other */"
    assert [t.strip() for t in extract.comment_texts(body)] == [
        "CREATE TABLE wide (", "note", "line", "indented", "", "a", "b", "tail", "other",
    ]


def test_inserts_with_comments_inside():
    body = "INSERT INTO t (a) /* why's that */ VALUES ('x') ; insert into `u` (b) values ('y;z')"
    assert [(t, c) for t, c, _ in extract.insert_parts(body)] == [("t", "a"), ("u", "b")]


@pytest.mark.parametrize(
    ("code", "want"),
    [
        ("\n insert  into `t` (`a (x)`, b)\nvalues  (1, 2)", ("t", "`a (x)`, b", "(1, 2)")),
        ("INSERT INTO a$1(x)VALUES(1)", ("a$1", "x", "(1)")),
        ("INSERT INTO t (`a, b) VALUES (1)", ("t", "`a, b", "(1)")),
        ("INSERT INTO t VALUES (1)", None),
        ("INSERT INTO s.t (a) VALUES (1)", None),
        ("INSERT INTO t (a SELECT 1", None),
        ("INSERT IGNORE t (a) VALUES (1)", None),
        ("INSERT INTO t (a) SELECT 1", None),
        ("INSERT INTO", None),
        ("", None),
    ],
)
def test_insert_heads(code, want):
    assert extract.read_insert(code) == want


def test_dump_job_is_idempotent(spark, dump, tmp_path):
    store = RowStore(spark, str(tmp_path / "store"), jobs.DEFAULT_DIM)
    jobs.ingest_sql_dump(spark, dump, store)
    jobs.ingest_sql_dump(spark, dump, store)
    assert store.read().count() == store.read().select("id").distinct().count() == 6


def line_form(spark, path):
    rows = jobs.dump_records(spark, path, compat=True).collect()
    return sorted((r["table_name"] or "", r["row_id"] or "", r["text"]) for r in rows)


def test_older_reading_of_the_fixture(spark, dump, tmp_path):
    remarks = [
        ("", "", "A single line comment that is long enough"),
        ("", "", "block comment on one line, long enough"),
        ("", "", "second line of the block comment"),
    ]
    # the ";" of an entity ends the statement inside an open string
    assert line_form(spark, dump) == remarks
    one_line = DUMP.replace("VALUES\n (", "VALUES (").replace("),\n (", "), (")
    (tmp_path / "one.sql").write_text(one_line)
    assert line_form(spark, str(tmp_path / "one.sql")) == [
        *remarks,
        ("assets", "7", "Avocado pieces in a box \nfresh & green product"),
        ("assets", "9", "a text with ; and, comma (and parens) \nit's escaped here"),
    ]


def test_older_reading_over_tiny_splits(spark, tmp_path):
    parts, want = [], []
    for i in range(60):
        parts.append(f"/* opening text is left out\n   inner remark number {i} is kept\n closing remark {i} */ INSERT INTO t (id, v)\n")
        parts.append(f"-- remark inside statement {i}\nVALUES ({i}, 'it''s the text of row {i}',\n NOW(), 'lost beyond the call');\n")
        want += [
            ("", "", f"inner remark number {i} is kept"),
            ("", "", f"closing remark {i}"),
            ("", "", f"remark inside statement {i}"),
            ("t", str(i), f"its the text of row {i}"),
        ]
    (tmp_path / "x.sql").write_text("".join(parts))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        assert line_form(spark, str(tmp_path)) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(
    "values, want",
    [
        ("(1,'a'),(2, 'b')", [["1", "a"], ["2", " b"]]),
        ("(1,'it''s')", [["1", "its"]]),
        ("(1,'a\\'b')", [["1", "a'b"]]),
        ("(f(1), 2)", [["f(1"]]),
        ("(1) ON DUPLICATE KEY UPDATE a=VALUES(a)", [["1"], ["a"]]),
        ("('a,(b);c',)", [["a,(b);c", ""]]),
        ("()", [[""]]),
        ("('open", []),
        ("('a'),('open, (1,2)", [["a"]]),
    ],
)
def test_flat_tuples(values, want):
    assert list(extract.flat_tuples(values)) == want


def test_states_are_folded_in_parts_of_a_split(spark, tmp_path, monkeypatch):
    """A split of many short pieces: no task folds more of them at once than its bound, and states cross the parts' borders."""
    most, fold = 1 << 16, pieces._fold

    def guarded(steps, names, state):
        assert len(steps) <= most, f"{len(steps)} pieces in a group"
        return fold(steps, names, state)

    monkeypatch.setattr(pieces, "_fold", guarded)
    n = 150_000
    opening = {10, 32767, 32768, 40_000, 65_535, 149_998}
    (tmp_path / "a.txt").write_text("".join(f'{i}{"#" if i in opening else ""}\n' for i in range(n)))
    lines = pieces.read_pieces(spark, str(tmp_path), "\n")
    turns = F.endswith("body", F.lit("#")).cast("int")
    got = pieces.states_before(lines, [turns, 1 - turns])
    assert got.select("source", "block").distinct().count() == 1 and got.count() == n
    body = lines.join(got.where("before = 1"), ["source", "block", "seq"]).select(F.regexp_replace("body", "#", "").cast("int"))
    inside = [*range(11, 32768), *range(32769, 40_001), *range(65_536, 149_999)]
    assert sorted(r[0] for r in body.collect()) == inside
