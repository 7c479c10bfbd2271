import hashlib
import html
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecloom.functions import keys, text


def column(spark, values, schema="s string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)


def results(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


BLANKS = [chr(c) for c in range(0x3100) if chr(c).isspace()]


def test_strip_covers_every_blank(spark):
    values = [f"{b}a{b} b{b}{b}" for b in BLANKS] + ["", " \n", "x"]
    assert results(column(spark, values), text.strip_blanks("s")) == [v.strip() for v in values]


def test_collapse_covers_every_blank(spark):
    values = [f"{b}a{b}{b}b{b}" for b in BLANKS]
    assert results(column(spark, values), text.collapse_blanks("s")) == [re.sub(r"\s+", " ", v).strip() for v in values]


def test_build_text_skips_nulls_and_blanks(spark):
    df = spark.createDataFrame([(0, " a ", None, "\n", "b"), (1, None, None, "", " ")], "i int, w string, x string, y string, z string")
    assert results(df, text.build_text(["w", "x", "y", "z"])) == ["a \nb", ""]


def test_looks_textual_counts_letters(spark):
    values = ["short", "exactly 10", "1234567890", "12345 abcd", "12345 abcde", "é" * 10, "你好世界你好世界你好", None, "a" * 5 + "1" * 12, "a" * 5 + "1" * 11]
    want = [v is not None and len(v) >= 10 and sum(c.isalpha() for c in v) >= max(5, len(v) * 0.3) for v in values]
    assert results(column(spark, values), text.looks_textual("s")) == want


def test_letter_class_equals_isalpha_for_common_scripts(spark):
    values = [chr(c) * 10 for c in range(0x20, 0x530) if unicodedata.category(chr(c)) != "Cn"]
    want = [sum(c.isalpha() for c in v) for v in values]
    assert results(column(spark, values), text.letter_count("s")) == want


CLEAN = {
    "": "",
    "plain  text\n here": "plain text here",
    "a <b>bold</b>move": "a bold move",
    "x &amp;amp; y": "x & y",
    "&lt;b&gt;seen&lt;/b&gt; as tag": "seen as tag",
    "<script>var a = '</p>';</script>after<style>p{}</style>": "after",
    "one<!-- hidden -->two": "one two",
    "caf&eacute; &#233; &#xe9;": "café é é",
    "R&ampD &copy 2024 &lt5 &amp;amp": "R&D © 2024 <5 &",
    "line<br>break<br/>twice": "line break twice",
    "5 < 6 and 7 > 2": "5 < 6 and 7 > 2",
    "<p>unclosed <b>tags": "unclosed tags",
    "<template><p>never</p></template>shown": "shown",
    "<![CDATA[kept text]]>": "kept text",
}


def test_clean_text_parser_tier(spark):
    assert results(column(spark, [*CLEAN, None]), text.clean_text("s")) == [*CLEAN.values(), ""]


def test_clean_text_native_tier_on_simple_markup(spark):
    skip = ("eacute", "CDATA")
    cases = {k: v for k, v in CLEAN.items() if not any(s in k for s in skip)}
    assert results(column(spark, [*cases, None]), text.clean_text_native("s")) == [*cases.values(), ""]


def test_numeric_entities_jvm_side(spark):
    values = ["&#65;&#x1F600;&#8217;", "&#0; &#99999999; &#xD800; &#12", "a&#x41;b", "&amp;#65;"]
    got = results(column(spark, values), text.decode_entities("s"))
    assert got[0] == html.unescape(values[0])
    assert got[2] == "aAb"
    assert got[3] == "&#65;"
    assert got[1].startswith("&#0;")


def test_keys(spark):
    df = spark.createDataFrame([(0, "a|b", None, "é" * 70)], "i int, x string, y string, t string")
    sha = lambda s: hashlib.sha1(s.encode()).hexdigest()
    got = df.select(
        keys.row_id(["x", "y"]),
        keys.content_hash("t"),
        keys.chunk_id(F.lit("s"), "y", "x", F.lit(3), "t"),
    ).first()
    assert list(got) == [sha("a|b|"), sha("é" * 70), sha("s||a|b|3|" + "é" * 64)]
    with pytest.raises(ValueError):
        keys.row_id([])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=30))
def test_surrogates_are_stable_and_not_negative(spark, values):
    values = [v.encode("utf-8", "ignore").decode() for v in values]
    df = column(spark, values)
    first = results(df, keys.surrogate_key("s"))
    assert first == results(df, keys.surrogate_key("s"))
    assert all(v >= 0 for v in first)
    assert len(set(first)) == len(set(values))
    assert keys.key_collisions(df, "s").count() == 0
