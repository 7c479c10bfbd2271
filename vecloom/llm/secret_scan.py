"""Secret scans (6): fixed patterns, plus a randomness test battery under false-discovery control.

Base spans are the leftmost non-overlapping matches of each pattern (assign, access, hex), minus matches that are too short.

The battery looks at tokens of ``MIN_TOKEN`` characters or more: maximal runs of ``[A-Za-z0-9+/_-]`` (``=`` only as padding
at the end of a run, elsewhere it separates name and value), and the parts of such a run between ``/``, ``-`` and ``_``. A part is a
span of its own if it passes and its run does not. The narrowest encoding that
holds all characters of a token is inferred (hex, base32, base36, base64), and three tests compare it with random
characters of that encoding: chi-squared uniformity of ranges of the alphabet and of kinds of characters, a runs test on the
upper and lower half of the alphabet, and lag-one serial correlation of the symbols' places. The three are combined by Fisher's
method and by Bonferroni's, so that one clear failure is enough.
A token that is no secret (a word chain, a path, a counter) fails them: each test rejects randomness. The decision is made for
all tokens of the corpus together: per encoding and length class, Benjamini-Hochberg at level ``FDR`` picks the tokens whose
randomness is rejected, but none whose p-value is above ``MOST_P``: however many junk tokens share a stratum, a random token is
lost with that chance at most. What is left and has ``MIN_BITS`` bits of possible content is a span of kind ``random``. Strata by length keep the many short tokens from setting the
threshold of the few long ones.

Only p-value histograms (encodings x length classes x ``BINS`` numbers) reach the driver, texts are read once.

Defined results: a null text is empty and has no spans; offsets are code points; a token covered by a base span gives
no span of its own; repeated rows are scanned each; null ids are kept; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import table
from .frames import stored
from .registry import query

KINDS = ("assign", "access", "hex", "random")
MIN_TOKEN = 20
#: The bits of ``MIN_TOKEN`` hex digits, the least of any encoding.
MIN_BITS = 80
FDR = 0.2
MOST_P = 0.01
#: Bins of -log10 p, a tenth each; the last takes all that is smaller.
BINS = 200

# patterns run over UTF-8 bytes in which A-Z are a-z: all their characters are ASCII, so places agree
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_RUN = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN)
_PIECE = re.compile(rb"[A-Za-z0-9+/_-]+(?:=+\Z)?")
_PART = re.compile(rb"[A-Za-z0-9+]+(?:=+\Z)?")


def _mask(chars: bytes) -> bytes:
    return bytes(49 if b in chars else 48 for b in range(256))


_LOWER_HEX = _mask(b"0123456789abcdef")
_TOKEN_CHARS = _mask(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")

_DIGITS, _LOW = "0123456789", "abcdefghijklmnopqrstuvwxyz"
#: name, alphabet in order (a second form of a symbol shares its place)
_ENCODINGS = (
    ("hex", _DIGITS + "abcdef", None),
    ("hex", _DIGITS + "ABCDEF", None),
    ("base32", _LOW.upper() + "234567", None),
    ("base36", _DIGITS + _LOW, None),
    ("base36", _DIGITS + _LOW.upper(), None),
    ("base64", _LOW.upper() + _LOW + _DIGITS + "+/", {"-": 62, "_": 63}),
)
_PLACES = [
    (name, len(alphabet), {c: k for k, c in enumerate(alphabet)} | (extra or {})) for name, alphabet, extra in _ENCODINGS
]
NAMES = tuple(dict.fromkeys(e[0] for e in _ENCODINGS))
LENGTH_CLASSES = 16


def _chi_tail(x: float, df: int) -> float:
    """P(chi-squared with df degrees of freedom > x): exact finite sum, even and odd df."""
    if x <= 0:
        return 1.0
    half = x / 2
    if df % 2 == 0:
        term = total = math.exp(-half)
        for k in range(1, df // 2):
            term *= half / k
            total += term
        return min(1.0, total)
    total = math.erfc(math.sqrt(half))
    term = math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
    for k in range(1, (df - 1) // 2 + 1):
        total += term
        term *= half / (k + 0.5)
    return min(1.0, total)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(token: str) -> tuple[str, float, float]:
    """Inferred encoding, combined p-value of the hypothesis of random characters, bits of possible content."""
    body = token.rstrip("=")
    for name, size, places in _PLACES:
        if all(c in places for c in body):
            break
    else:
        return "base64", 0.0, 0.0
    at = [places[c] for c in body]
    n = len(at)
    if n < 8:
        return name, 0.0, 0.0
    # classes of equal size, as many as give an expected count of four or more
    classes = max(2, min(size // 4 if size > 16 else 8, n // 4))
    bounds = [size * (k + 1) / classes for k in range(classes)]
    counts, widths = [0] * classes, [0] * classes
    owner = [next(k for k, b in enumerate(bounds) if s < b) for s in range(size)]
    for s in range(size):
        widths[owner[s]] += 1
    for s in at:
        counts[owner[s]] += 1
    chi = sum((c - n * w / size) ** 2 / (n * w / size) for c, w in zip(counts, widths, strict=True))
    p_chi = _chi_tail(chi, classes - 1)
    # kinds of symbols (letters by case, digits and signs): a chain of words has one kind only
    kinds = {(c.isdigit() or not c.isalpha(), c.isupper()): 0 for c in places if c not in "-_"}
    for c in body:
        kinds[c.isdigit() or not c.isalpha(), c.isupper()] += 1
    shares = Counter((c.isdigit() or not c.isalpha(), c.isupper()) for c in places if c not in "-_")
    off = sum((kinds[k] - n * w / size) ** 2 / (n * w / size) for k, w in shares.items())
    p_chi = min(1.0, 2 * min(p_chi, _chi_tail(off, len(shares) - 1)))
    upper = [s >= size / 2 for s in at]
    ones = sum(upper)
    zeros = n - ones
    if ones and zeros:
        mean = 2 * ones * zeros / n + 1
        var = (mean - 1) * (mean - 2) / max(1, n - 1)
        runs = 1 + sum(a != b for a, b in zip(upper, upper[1:], strict=False))
        p_runs = _two_sided((runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    middle = sum(at) / n
    spread = sum((s - middle) ** 2 for s in at)
    if spread:
        corr = sum((a - middle) * (b - middle) for a, b in zip(at, at[1:], strict=False)) / spread
        p_corr = _two_sided((corr + 1 / n) * math.sqrt(n))
    else:
        p_corr = 2.0 ** (1 - n)
    tests = (p_chi, p_runs, p_corr)
    fisher = _chi_tail(-2 * sum(math.log(max(p, 1e-300)) for p in tests), 6)
    return name, min(1.0, 2 * min(fisher, 3 * min(tests))), n * math.log2(size)


def base_spans(data: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes; searches for fixed strings decide which patterns need to run."""
    out = []
    low = data.lower()
    if any(w in low for w in _WORDS):
        out += [(*m.span(), "assign") for m in _ASSIGN.finditer(low) if m.end(1) - m.start(1) >= 6]
    if b"AKIA" in data:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(data) if m.end() - m.start() >= 20]
    if b"1" * 24 in data.translate(_LOWER_HEX):
        out += [(*m.span(), "hex") for m in _HEX.finditer(data)]
    return out


def tokens_of(data: bytes) -> list[tuple[int, int, int]]:
    """(start, end, place of the token that it is a part of, or -1) in bytes."""
    out = []
    for run in _RUN.finditer(data):
        for m in _PIECE.finditer(run.group()):
            start, whole = run.start() + m.start(), len(out)
            if len(m.group()) < MIN_TOKEN:
                continue
            out.append((start, start + len(m.group()), -1))
            for part in _PART.finditer(m.group()):
                if MIN_TOKEN <= len(part.group()) < len(m.group()):
                    out.append((start + part.start(), start + part.end(), whole))
    return out


def _strata(name: str, n: int) -> int:
    return NAMES.index(name) * LENGTH_CLASSES + min(LENGTH_CLASSES - 1, int(2 * math.log2(n / MIN_TOKEN)) if n > MIN_TOKEN else 0)


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id, base, tokens``: spans in code points; tokens with stratum, bin of -log10 p, and whether long enough."""
    base_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    token_type = pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64()), ("stratum", pa.int32()), ("bin", pa.int32()), ("long", pa.bool_()), ("whole", pa.int32())])
    )

    def spans_of(data: bytes):
        base = base_spans(data)
        tokens = []
        if b"1" * MIN_TOKEN in data.translate(_TOKEN_CHARS):
            places = {}  # of the tokens that are judged
            for k, (start, end, whole) in enumerate(tokens_of(data)):
                if any(s < end and start < e for s, e, _ in base):
                    continue
                name, p, bits = battery(data[start:end].decode())
                low = min(BINS - 1, int(-10 * math.log10(p))) if p > 0 else BINS - 1
                places[k] = len(tokens)
                tokens.append((start, end, _strata(name, end - start), low, bits >= MIN_BITS, places.get(whole, -1)))
        if not base and not tokens:
            return [], []
        wide = not data.isascii()
        if wide:  # code points before a byte: bytes that start a character
            marks = sorted({x for s in (*base, *tokens) for x in s[:2]})
            at, last, seen = {}, 0, 0
            for x in marks:
                seen += len(data[last:x].decode())
                at[x], last = seen, x
        else:
            at = range(len(data) + 1)
        return (
            [{"start": at[s], "kind": KINDS.index(k), "end": at[e]} for s, e, k in base],
            [{"start": at[t[0]], "end": at[t[1]], "stratum": t[2], "bin": t[3], "long": t[4], "whole": t[5]} for t in tokens],
        )

    def scan(batches):
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            got = [spans_of(t.as_py() or b"") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], base_type), pa.array([g[1] for g in got], token_type)],
                names=["doc_id", "base", "tokens"],
            )

    schema = (
        "doc_id long, base array<struct<start: long, kind: int, end: long>>, "
        "tokens array<struct<start: long, end: long, stratum: int, bin: int, long: boolean, whole: int>>"
    )
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, schema)


def rejections(counts: list[tuple[int, int, int]], fdr: float) -> dict[int, int]:
    """Per stratum the least bin of -log10 p at which Benjamini-Hochberg rejects randomness (``BINS``: none), above ``MOST_P`` in no case."""
    strata: dict[int, list[int]] = {}
    for stratum, low, n in counts:
        strata.setdefault(stratum, [0] * BINS)[low] += n
    out = {}
    for stratum, bins in strata.items():
        total, cut, seen = sum(bins), BINS, 0
        for low in range(BINS - 1, -1, -1):
            seen += bins[low]
            if 10 ** (-low / 10) <= fdr * seen / total:
                cut = low
        out[stratum] = max(cut, round(-10 * math.log10(MOST_P)))
    return out


def find_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """``doc_id, spans``: all spans ``(start, kind, end)`` in order; kind is a place in ``KINDS``."""
    rows = stored(scanned(docs), "secret-spans")
    seen = rows.select(F.explode("tokens").alias("t")).groupBy("t.stratum", "t.bin").count()
    cuts = rejections([tuple(r) for r in seen.collect()], fdr)  # strata x BINS rows at most
    if cuts:
        cut = F.create_map(*[F.lit(int(x)) for pair in sorted(cuts.items()) for x in pair])

        def passes(t):
            return t["long"] & (t["bin"] < cut[t["stratum"]])

        def whole_passes(t):
            return (t["whole"] >= 0) & passes(F.get("tokens", F.greatest(t["whole"], F.lit(0))))

        random = F.transform(
            F.filter("tokens", lambda t: passes(t) & ~whole_passes(t)),
            lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), t["end"].alias("end")),
        )
        spans = F.concat("base", random)
    else:
        spans = F.col("base")
    return rows.select("doc_id", F.array_sort("base").alias("base"), F.array_sort(spans).alias("spans"))


def joined(spans):
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


@query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    got = find_secrets(table(spark, folder, "documents"))

    def n_of(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return got.select(
        "doc_id",
        *[n_of(k) for k in KINDS[:3]],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
