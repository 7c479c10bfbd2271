"""Cross-tokenizer alignment (11): the places where two tokenizers of the same bytes both end a token.

A text is tokenized by a byte-level BPE (A) and by a piece BPE with byte fallback (B). Each token is a range of bytes; offsets at which a
token of A and one of B end cut the tokens into groups, and the two that end there are linked.

The unit of work is a byte range of a text, ``CHUNK`` bytes at most, and its result a ``Fragment``: tokens that end in the range, as an open
prefix (up to the first common end, its beginning may lie in an earlier range), closed groups, and an open suffix. Fragments
are a monoid under ``compose``: the left one's suffix and the right one's prefix become a group. Ranges of one text go to different tasks and are
composed in a tree, ``FAN`` neighbours at a time, until each text is one fragment; most texts are one range and skip that.

A range is tokenized with the bytes around it up to places where no token of either tokenizer can cross: before a space between two
characters that are no white space. That holds for A by its splitting pattern and is checked for B's vocabulary (no piece has a
space behind another character). A stretch without such a place is not divided.

Pairs of ids are counted over the corpus from the composed fragments, which are stored. The table of pairs is bounded by the vocabularies, not
by the corpus; up to ``PAIRS`` rows go to the tasks as a sorted array, more are joined to the distinct pairs of each text.

Defined results: texts that are null or empty, and texts whose tokens do not give back their bytes, have no tokens and count nowhere; null
ids are rows like others and repeated rows count each; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import table
from .frames import stored
from .registry import query

TOKENIZERS = "/opt/tokenizers"
#: Bytes of a range; texts up to twice that are one range.
CHUNK = 1 << 16
FAN = 8
#: Pairs of ids that are sent to the tasks (16 bytes each), and that a task holds before it hands them on.
PAIRS = 4 << 20
HELD = 1 << 20
#: Characters that are tokenized, and tokens that are written out, at once.
BATCH = 1 << 20

#: Fixed: the splitting pattern of the byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """The alphabet of a byte-level vocabulary: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteTokenizer:
    """A: ids and byte strings from the JSON file of a byte-level BPE without a prefix space."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        alphabet, special = _byte_of_char(), {t["content"] for t in model.get("added_tokens", [])}
        vocabulary = {t: i for t, i in model["model"]["vocab"].items() if t not in special}
        ranks = {bytes(alphabet[c] for c in t): i for t, i in vocabulary.items()}
        merged = [m if isinstance(m, str) else " ".join(m) for m in model["model"]["merges"]]
        made = [vocabulary["".join(m.split(" "))] for m in merged]
        if made != sorted(made) or model["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("ids must follow the order of merges, and no space be added")
        self.coder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.table = [b""] * (1 + max(ranks.values()))
        for token, i in ranks.items():
            self.table[i] = token

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [self.coder.encode_ordinary(" " + t) for t in texts]


class PieceTokenizer:
    """B: a piece BPE that puts a space before each text."""

    def __init__(self, path: str):
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.coder.id_to_piece(i) for i in range(self.coder.vocab_size())]
        #: Whether a space begins a piece wherever it follows another character.
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)
        self.table = [
            bytes([int(p[3:5], 16)]) if self.coder.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.coder.encode(texts, num_threads=1)


@dataclass
class Fragment:
    """Tokens of neighbouring bytes: ``a``, ``b`` are ids, ``na``, ``nb`` how many lie up to the first common end, then up to the second ...

    The first entry of ``na`` and ``nb`` is the open prefix, the others are closed groups, and what is left of ``a`` and ``b`` is the open
    suffix. Without a common end everything is one open run. ``ok`` is false if some token did not give back its bytes.
    """

    a: np.ndarray
    b: np.ndarray
    na: np.ndarray
    nb: np.ndarray
    ok: bool = True


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of both byte ranges: the suffix of ``x`` goes before the prefix of ``y``. Associative; an empty one changes nothing."""
    na, nb = y.na.copy(), y.nb.copy()
    if len(na):
        na[0] += len(x.a) - x.na.sum()
        nb[0] += len(x.b) - x.nb.sum()
    join = np.concatenate
    return Fragment(join((x.a, y.a)), join((x.b, y.b)), join((x.na, na)), join((x.nb, nb)), x.ok and y.ok)


def fragments(texts: list[str], lows: list[int], highs: list[int], one, two) -> list[Fragment]:
    """The fragment of each text's bytes with ends in ``(low, high]``; offsets count the space before the text."""
    out = []
    size_a, size_b = (np.array([len(t) for t in x.table], np.int64) for x in (one, two))
    for text, low, high, a, b in zip(texts, lows, highs, one.ids(texts), two.ids(texts), strict=True):
        data = b" " + text.encode()
        if not text or b"".join([one.table[i] for i in a]) != data or b"".join([two.table[i] for i in b]) != data:
            none = np.zeros(0, np.int32)
            out.append(Fragment(none, none, none, none, False))
            continue
        a, b = np.array(a, np.int32), np.array(b, np.int32)
        ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
        if low > 0 or high < len(data):
            in_a, in_b = (ends_a > low) & (ends_a <= high), (ends_b > low) & (ends_b <= high)
            a, b, ends_a, ends_b = a[in_a], b[in_b], ends_a[in_a], ends_b[in_b]
        common = np.zeros(len(data) + 1, bool)
        common[ends_a] = True
        at_b = np.flatnonzero(common[ends_b])
        at_a = np.searchsorted(ends_a, ends_b[at_b])
        na, nb = (np.diff(x + 1, prepend=0).astype(np.int32) for x in (at_a, at_b))
        out.append(Fragment(a, b, na, nb, True))
    return out


def safe_starts(data: np.ndarray) -> np.ndarray:
    """Places of spaces in the UTF-8 bytes ``data`` that stand between two characters that are surely no white space.

    ASCII apart, a character counts as such unless its first byte also begins some white space (C2, E1, E2 or E3).
    """
    graphic = (data > 0x20) & (data < 0x7F)
    doubtful = (data == 0xC2) | (data >= 0xE1) & (data <= 0xE3)
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 2) & (at < len(data) - 1)]
    after = graphic[at + 1] | (data[at + 1] > 0x7F) & ~doubtful[at + 1]
    before = graphic[at - 1] | (data[at - 1] > 0x7F) & (data[at - 2] != 0xC2) & ~doubtful[at - 3]
    return at[after & before]


def byte_ranges(text: str, chunk: int, cuttable: bool) -> list[tuple[str, int, int]]:
    """``text`` as ranges of ``chunk`` bytes or more: what to tokenize for each, and which ends count (``low`` excluded).

    Ranges begin at multiples of ``chunk``, wherever that is in a word, but not within a stretch of more than ``chunk``
    bytes that cannot be cut. Offsets count the space that the tokenizers see before the text.
    """
    data = text.encode()
    total = len(data) + 1
    starts = safe_starts(np.frombuffer(data, np.uint8)) + 1 if cuttable else np.zeros(0, np.int64)
    starts = np.concatenate(([0], starts, [total]))
    lows = [0]
    for at in range(chunk, total, chunk):
        k = int(np.searchsorted(starts, at, "right"))
        if starts[k] - starts[k - 1] <= chunk:
            lows.append(at)
    out = []
    for low, high in zip(lows, [*lows[1:], total], strict=True):
        first = int(starts[np.searchsorted(starts, low, "right") - 1])
        last = int(starts[np.searchsorted(starts, high, "left")])
        # the space at ``first`` is the one that the tokenizers see before this part
        out.append((data[first : last - 1].decode(), low - first, high - first))
    return out


FIELDS = "a binary, b binary, na binary, nb binary, ok boolean"


def pack(values: np.ndarray) -> bytes:
    """Non-negative numbers below 2 to 32 in as few bytes each as the greatest needs; the first byte says how many."""
    size = next(k for k in (1, 2, 4) if not len(values) or values.max() < 1 << 8 * k)
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def unpack(packed) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.int32)


def _columns(found: list[Fragment]) -> dict[str, pa.Array]:
    out = {name: pa.array([pack(getattr(f, name)) for f in found], pa.binary()) for name in ("a", "b", "na", "nb")}
    return out | {"ok": pa.array([f.ok for f in found], pa.bool_())}


def _fragment(batch, k: int) -> Fragment:
    return Fragment(*(unpack(batch.column(c)[k].as_py()) for c in ("a", "b", "na", "nb")), batch.column("ok")[k].as_py())


class Aligner:
    """The operator for one pair of vocabulary files; the files must be there on every executor."""

    def __init__(self, byte_bpe: str = f"{TOKENIZERS}/byte_bpe_50k.json", piece_bpe: str = f"{TOKENIZERS}/piece_bpe_32k.model", chunk: int = CHUNK):
        self.byte_bpe, self.piece_bpe, self.chunk = byte_bpe, piece_bpe, chunk

    def _open(self):
        return ByteTokenizer(self.byte_bpe), PieceTokenizer(self.piece_bpe)

    def _ranges(self, long: DataFrame) -> DataFrame:
        """``row, doc_id, part, text, low, high``: the ranges of ``long(doc_id, text)``."""
        chunk, piece_bpe = self.chunk, self.piece_bpe

        def scan(batches):
            cuttable = PieceTokenizer(piece_bpe).cuttable
            for b in batches:
                for row, doc_id, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    for part, (t, low, high) in enumerate(byte_ranges(text, chunk, cuttable)):
                        one = {"row": [row], "doc_id": [doc_id], "part": [part], "text": [t], "low": [low], "high": [high]}
                        yield pa.RecordBatch.from_pydict(one, schema=schema)

        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        schema = pa.schema(list(zip(["row", "doc_id", "part", "text", "low", "high"], kinds, strict=True)))
        rows = long.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        return rows.mapInArrow(scan, "row long, doc_id long, part int, text string, low long, high long")

    def _tokenized(self, ranges: DataFrame) -> DataFrame:
        """``ranges(row, doc_id, part, text, low, high)`` with the fragment of each instead of its text."""
        opened = self._open

        def scan(batches):
            one, two = opened()
            for b in batches:
                texts, lows, highs = (b.column(c).to_pylist() for c in ("text", "low", "high"))
                found, held, size = [], [], 0
                for k, t in enumerate(texts):
                    held.append(k)
                    size += len(t)
                    if size >= BATCH or k == len(texts) - 1:
                        found += fragments([texts[i] for i in held], [lows[i] for i in held], [highs[i] for i in held], one, two)
                        held, size = [], 0
                lists = _columns(found)
                yield pa.record_batch([b.column(c) for c in ("row", "doc_id", "part")] + list(lists.values()), names=["row", "doc_id", "part", *lists])

        return ranges.mapInArrow(scan, f"row long, doc_id long, part int, {FIELDS}")

    def aligned(self, docs: DataFrame) -> DataFrame:
        """``row, doc_id, a, b, na, nb, ok`` of every row of ``docs(doc_id, text)``: ids of A and B and the sizes of their groups."""
        own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        small = F.octet_length("text") <= 2 * self.chunk
        whole = own.where(small).select(
            F.lit(0).cast("long").alias("row"), "doc_id", F.lit(0).alias("part"), "text",
            F.lit(0).cast("long").alias("low"), (F.octet_length("text") + 1).cast("long").alias("high"),
        )
        ranges = stored(self._ranges(own.where(~small)), "align-ranges")
        most = ranges.agg(F.max("part")).first()[0]
        done = self._tokenized(whole)
        if most is not None:
            dealt = ranges.repartition(F.xxhash64("row", "part"))
            done = done.unionByName(composed(self._tokenized(dealt), most + 1))
        named = done.select(F.monotonically_increasing_id().alias("row"), "doc_id", "a", "b", "na", "nb", "ok")
        return stored(named, "align-groups")


def composed(parts: DataFrame, most: int) -> DataFrame:
    """One fragment per ``row`` of ``parts``, which has ``most`` at most: a tree of ``FAN`` neighbours a level."""

    def fold(t: pa.Table) -> pa.Table:
        t = t.combine_chunks().sort_by("part")
        whole = _fragment(t, 0)
        for k in range(1, t.num_rows):
            whole = compose(whole, _fragment(t, k))
        if not whole.ok:
            none = np.zeros(0, np.int32)
            whole = Fragment(none, none, none, none, False)
        head = {c: t.column(c)[:1] for c in ("row", "doc_id", "up")}
        return pa.table({"row": head["row"], "doc_id": head["doc_id"], "part": head["up"], **_columns([whole])})

    while most > 1:
        level = parts.withColumn("up", F.floor(F.col("part") / FAN).cast("int"))
        parts = level.groupBy("row", "up").applyInArrow(fold, f"row long, doc_id long, part int, {FIELDS}")
        most = -(-most // FAN)
    return parts


def _flat(batch: pa.RecordBatch):
    """Parts of a batch's rows with about ``BATCH`` tokens: first row, ids and group sizes in one piece each, and the bounds of the rows."""
    names = ("a", "b", "na", "nb")
    columns = [[x.as_buffer() for x in batch.column(c)] for c in names]
    lo = 0
    while lo < batch.num_rows:
        hi, size = lo, 0
        while hi < batch.num_rows and size < 2 * BATCH:  # two bytes an id
            size += columns[0][hi].size + columns[1][hi].size
            hi += 1
        parts = [[unpack(x) for x in c[lo:hi]] for c in columns]
        flat = {n: np.concatenate(x) for n, x in zip(names, parts, strict=True)}
        bounds = {n: np.concatenate(([0], np.cumsum([len(y) for y in x]))) for n, x in zip(names, parts, strict=True)}
        yield lo, flat, bounds
        lo = hi


def _links(flat: dict) -> np.ndarray:
    """The pair of ids that end each group, as one number."""
    a = flat["a"][np.cumsum(flat["na"], dtype=np.int64) - 1].astype(np.int64)
    return a << 32 | flat["b"][np.cumsum(flat["nb"], dtype=np.int64) - 1]


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: links of each pair of ids (A's times 2 to 32, plus B's), and whether no pair of its B id has more."""

    def scan(batches):
        held, size = [], 0

        def packed():
            pairs, inverse = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            n = np.zeros(len(pairs), np.int64)
            np.add.at(n, inverse, np.concatenate([c for _, c in held]))
            return pairs, n

        for batch in batches:
            for _, flat, _ in _flat(batch):
                held.append(np.unique(_links(flat), return_counts=True))
                size += len(held[-1][0])
                if size > HELD:
                    held = [packed()]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield pa.record_batch([pa.array(x) for x in held[0]], names=["pair", "n"])
                        held, size = [], 0
        if held:
            yield pa.record_batch([pa.array(x) for x in packed()], names=["pair", "n"])

    found = aligned.select("a", "b", "na", "nb").mapInArrow(scan, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = stored(found, "align-pairs")
    tops = found.groupBy(F.col("pair").bitwiseAND(0xFFFFFFFF).alias("_b")).agg(F.max("n").alias("_top"))
    joined = found.join(tops, found["pair"].bitwiseAND(0xFFFFFFFF) == tops["_b"])
    return stored(joined.select("pair", "n", (F.col("n") == F.col("_top")).alias("best")), "align-best")


def _hot(pairs: DataFrame) -> tuple[pa.Table, int]:
    """The most frequent pairs, ``PAIRS`` at most, sorted, and the number of links from which on all pairs are among them."""
    cut = 0
    if pairs.count() > PAIRS:
        sizes = pairs.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("c")).collect()  # 64 at most
        total, cut = 0, 1 << 62
        for k, c in sorted(((r["k"], r["c"]) for r in sizes), reverse=True):
            total += c
            if total > PAIRS:
                break
            cut = 1 << k
    return pairs.where(F.col("n") >= cut).toArrow().combine_chunks().sort_by("pair"), cut


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


class Digits:
    """Groups as text, ``a1,a2|b1;a3|b2,b3``, for many rows at once."""

    def __init__(self, most: int = 1 << 17):
        written = [str(i).encode() for i in range(most)]
        self.width = np.array([len(w) for w in written])
        self.table = np.frombuffer(b"".join(w.ljust(7, b"\0") for w in written), np.uint8).reshape(most, 7)

    def digests(self, flat: dict, bounds: dict) -> list[str]:
        """SHA-256 of each row's groups; an empty string for a row without tokens."""
        after_a, after_b = (np.cumsum(flat[x], dtype=np.int64) for x in ("na", "nb"))
        place_a = np.arange(len(flat["a"])) + np.repeat(after_b - flat["nb"], flat["na"])
        place_b = np.arange(len(flat["b"])) + np.repeat(after_a, flat["nb"])
        ids = np.empty(len(place_a) + len(place_b), np.int32)
        ids[place_a], ids[place_b] = flat["a"], flat["b"]
        mark = np.full(len(ids), ord(","), np.uint8)
        mark[place_a[after_a - 1]], mark[place_b[after_b - 1]] = ord("|"), ord(";")
        signs, width = self.table[ids], self.width[ids]
        signs[np.arange(len(ids)), width] = mark
        text = signs.ravel()
        text = text[text != 0].tobytes()
        ends = np.concatenate(([0], np.cumsum(width + 1)))[bounds["a"] + bounds["b"]]
        return [hashlib.sha256(text[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def summaries(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``aligned``."""
    hot, cut = _hot(pairs)
    shared = aligned.sparkSession.sparkContext.broadcast([hot.column(c).to_numpy() for c in ("pair", "n", "best")])

    def looked_up(links: np.ndarray):
        known, n, best = shared.value
        at = np.minimum(np.searchsorted(known, links), max(0, len(known) - 1))
        hit = known[at] == links if len(known) else np.zeros(len(links), bool)
        return hit, np.where(hit, n[at], 0) if len(known) else hit, (hit & best[at]) if len(known) else hit

    def scan(batches):
        digits = Digits()
        for batch in batches:
            for lo, flat, bounds in _flat(batch):
                _, n, best = looked_up(_links(flat))
                sizes = [np.diff(bounds[x]) for x in ("a", "b", "na", "na")]
                sums = [_sums(x, bounds["na"]) for x in (best, n)]
                head = batch.slice(lo, len(sizes[0]))
                yield pa.record_batch(
                    [head.column("row"), head.column("doc_id"), *[pa.array(x) for x in (*sizes, *sums)], pa.array(digits.digests(flat, bounds), pa.string())],
                    names=["row", "doc_id", *names, "groups_sha256"],
                )

    def cold(batches):
        for batch in batches:
            for lo, flat, bounds in _flat(batch):
                links = _links(flat)
                hit, _, _ = looked_up(links)
                row = lo + np.repeat(np.arange(len(bounds["na"]) - 1), np.diff(bounds["na"]))[~hit]
                got, n = np.unique(np.stack([row, links[~hit]]), axis=1, return_counts=True)
                yield pa.record_batch([batch.column("row").take(pa.array(got[0])), pa.array(got[1].copy()), pa.array(n)], names=["row", "pair", "m"])

    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    columns = aligned.select("row", "doc_id", "a", "b", "na", "nb")
    out = columns.mapInArrow(scan, f"row long, doc_id long, {', '.join(f'{c} long' for c in names)}, groups_sha256 string")
    if cut:  # the rest of the pairs is rare, so a join by pair has no hot key
        rest = columns.mapInArrow(cold, "row long, pair long, m long").join(pairs.where(F.col("n") < cut), "pair")
        rest = rest.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("_best"), F.sum(F.col("m") * F.col("n")).alias("_sum"))
        out = out.join(rest, "row", "left").withColumn("n_best", F.col("n_best") + F.coalesce("_best", F.lit(0)))
        out = out.withColumn("count_sum", F.col("count_sum") + F.coalesce("_sum", F.lit(0)))
    return out.select("doc_id", *names, "groups_sha256")


@query("op11_align_tokenizers")
def op11_align_tokenizers(spark: SparkSession, folder: str) -> DataFrame:
    aligned = Aligner().aligned(table(spark, folder, "documents"))
    return summaries(aligned, pair_counts(aligned))
