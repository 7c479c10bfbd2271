"""Text columns: blanks, assembly, cleaning and the "looks textual" predicate."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The characters Python counts as blank, in a regex class and as a string. Java's \s
# covers neither all of them nor, with its Unicode flag, the four ASCII separators.
BLANK = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

TEXT_SEP = " \n"
MIN_TEXT_LEN = 10
MIN_LETTERS = 5
MIN_LETTER_SHARE = 0.3

# Named entities the native tier decodes; the first ones are also valid without their
# semicolon. The ampersand is decoded last so that "&amp;lt;" is decoded once per pass.
BARE_ENTITIES = {"&lt": "<", "&gt": ">", "&quot": '"', "&nbsp": "\u00a0", "&copy": "©", "&reg": "®", "&middot": "·"}
NAMED_ENTITIES = {
    "&apos;": "'",
    "&hellip;": "…",
    "&ndash;": "–",
    "&mdash;": "—",
    "&lsquo;": "‘",
    "&rsquo;": "’",
    "&ldquo;": "“",
    "&rdquo;": "”",
    "&bull;": "•",
    "&euro;": "€",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> Column:
    """Column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip_blanks(c: Column | str) -> Column:
    """Unicode strip of both ends."""
    return F.btrim(_col(c), F.lit(BLANKS))


def collapse_blanks(c: Column | str) -> Column:
    """Runs of blanks become one space, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), BLANK + "+", " "))


def build_text(columns: Sequence[Column | str], sep: str = TEXT_SEP) -> Column:
    """Join the non-blank values of ``columns`` in order."""
    parts = [F.nullif(strip_blanks(_col(c).cast("string")), F.lit("")) for c in columns]
    return F.concat_ws(sep, *parts)


def letter_count(c: Column | str) -> Column:
    return F.length(F.regexp_replace(_col(c), r"[^\p{L}]+", ""))


def looks_textual(c: Column | str, min_len: int = MIN_TEXT_LEN) -> Column:
    """True when the value is long enough and mostly made of letters; never null."""
    c = _col(c)
    need = F.greatest(F.lit(float(MIN_LETTERS)), F.length(c) * F.lit(MIN_LETTER_SHARE))
    return F.coalesce((F.length(c) >= max(min_len, MIN_TEXT_LEN)) & (letter_count(c) >= need), F.lit(False))


def decode_entities(c: Column | str) -> Column:
    """Decode numeric entities and the fixed named ones, JVM-side.

    A lone numeric reference is rewritten piecewise after a split on "&#", because a regex
    replacement cannot compute a character.
    """
    c = _col(c)
    for entity, char in BARE_ENTITIES.items():
        c = F.regexp_replace(c, entity + ";?", char)
    for entity, char in NAMED_ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(char))

    def piece(part: Column, i: Column) -> Column:
        dec = F.regexp_extract(part, r"^([0-9]{1,7});", 1)
        hexa = F.regexp_extract(part, r"^[xX]([0-9a-fA-F]{1,6});", 1)
        code = F.coalesce(
            F.nullif(dec, F.lit("")).cast("int"),
            F.conv(F.nullif(hexa, F.lit("")), 16, 10).cast("int"),
        )
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code.cast("bigint")), 8, "0")), "UTF-32")
        rest = F.regexp_replace(part, r"^[xX]?[0-9a-fA-F]+;", "")
        return F.when(i == 0, part).when(valid, F.concat(char, rest)).otherwise(F.concat(F.lit("&#"), part))

    # text without "&#" is one piece, which stays as it is
    c = F.array_join(F.transform(F.split(c, "&#"), piece), "")
    return F.regexp_replace(c, "&amp;?", "&")


def clean_text_native(c: Column | str) -> Column:
    """Regex tier of :func:`clean_text`: well-formed markup, JVM only."""
    c = decode_entities(_col(c))
    c = F.regexp_replace(c, r"(?is)<(script|style|template)\b[^>]*>.*?</\1\s*>|<!--.*?-->", " ")
    c = F.regexp_replace(c, r"(?s)<[!?/a-zA-Z][^>]*>", " ")
    return F.coalesce(collapse_blanks(decode_entities(c)), F.lit(""))


class _TextNodes(HTMLParser):
    """Collects the visible text nodes of one fragment."""

    # Elements without content, and elements whose text is not shown.
    VOID = frozenset(
        "area base br col embed hr img input keygen link menuitem meta param source track wbr "
        "basefont bgsound command frame image isindex nextid spacer".split()
    )
    HIDDEN = frozenset("script style template rt rp".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[list[str]] = []
        self.open: list[str] = []
        self.in_node = False

    def handle_starttag(self, tag, attrs):
        self.in_node = False
        if tag not in self.VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.in_node = False

    def handle_endtag(self, tag):
        self.in_node = False
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.HIDDEN.isdisjoint(self.open):
            return
        # the parser hands over a text in parts, which are one node until some markup comes
        if not self.in_node:
            self.nodes.append([])
        self.nodes[-1].append(data)
        self.in_node = True

    def handle_comment(self, data):
        self.in_node = False

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self.in_node = False
        if data[:6].upper() == "CDATA[":
            self.handle_data(data[6:])
            self.in_node = False


def html_text(raw: str) -> str:
    """Visible text of ``raw`` after one entity decode, text nodes set apart by a space."""
    parser = _TextNodes()
    parser.feed(unescape(raw))
    parser.close()
    return " ".join("".join(node) for node in parser.nodes)


@F.pandas_udf(StringType())
def _html_text_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(html_text, na_action="ignore")


def clean_text(c: Column | str) -> Column:
    """Decode, strip markup, collapse blanks; null gives "".

    Values without "<" or "&" need no parser: they reach the Python worker as null and are
    collapsed JVM-side.
    """
    c = _col(c)
    marked = F.when(c.rlike("[<&]"), c)
    return F.coalesce(collapse_blanks(F.coalesce(_html_text_udf(marked), c)), F.lit(""))


def kept(value: Column, keep) -> Column:
    """``value`` where ``keep(value)`` holds, as a generator: rows without it go.

    A filter over a projected expression is pushed below the projection and computes the
    expression twice; a generator computes it once.
    """
    return F.explode(F.filter(F.array(value), keep))


def preview(c: Column | str, width: int = 160, tail: str = "…") -> Column:
    """First ``width`` characters, with ``tail`` when something was cut."""
    c = F.coalesce(_col(c), F.lit(""))
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit(tail))).otherwise(c)


def base_name(c: Column | str) -> Column:
    return F.element_at(F.split(_col(c), "/"), -1)
