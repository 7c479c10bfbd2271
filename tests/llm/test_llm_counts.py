"""Tokenizer alignment, phrase collocations and quality rules: against brute force on small tables."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from vecloom.llm import align, phrases, quality, queries, registry

from . import fixtures as fx

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    registry.prepare(spark)


def aligned_brute(rows):
    """Summary of each row by two pointers over both tokenizations, A by the tokenizer library itself."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_coder = Tokenizer.from_file(f"{align.TOKENIZERS}/byte_bpe_50k.json")
    a_coder.encode_special_tokens = True
    b_coder = sentencepiece.SentencePieceProcessor(model_file=f"{align.TOKENIZERS}/piece_bpe_32k.model")
    one, two = align.ByteTokenizer(f"{align.TOKENIZERS}/byte_bpe_50k.json").table, align.PieceTokenizer(f"{align.TOKENIZERS}/piece_bpe_32k.model").table
    found, counts = [], Counter()
    for i, t in rows:
        data = (" " + (t or "")).encode()
        a, b = (a_coder.encode(" " + t, add_special_tokens=False).ids, b_coder.encode(t)) if t else ([], [])
        groups = []
        if t and b"".join(one[x] for x in a) == data == b"".join(two[x] for x in b):
            ends = ({0}, {0})
            for side, ids, table in ((ends[0], a, one), (ends[1], b, two)):
                at = 0
                for x in ids:
                    at += len(table[x])
                    side.add(at)
            for ids, table, place in ((a, one, 0), (b, two, 1)):
                at = 0
                for x in ids:
                    at += len(table[x])
                    groups.append((place, at, x))
            common = sorted((ends[0] & ends[1]) - {0})
            made = [([], []) for _ in common]
            for place, at, x in groups:
                made[int(np.searchsorted(common, at))][place].append(x)
            groups = made
        else:
            a = b = []
        links = [(x[-1], y[-1]) for x, y in groups]
        counts.update(links)
        found.append((i, a, b, groups, links))
    top = defaultdict(int)
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    for i, a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(counts[p] == top[p[1]] for p in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        yield i, len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), digest


class TestAlignment:
    odd = [
        None, "", " ", "  two  spaces ", "a▁b c", "<|endoftext|> <s> <0x41>", "naïve 日本語 テスト", "é" * 90, "x" * 400,
        "tab\tline\r\nend  nbsp 　wide a b", "\x00 \x1c \x85 z", "😀 smile 😀😀", "word " * 200, "don't can't I'll",
    ]

    @pytest.mark.parametrize("chunk, pairs", [(align.CHUNK, align.PAIRS), (97, 40)])
    def test_against_brute_force(self, spark, monkeypatch, chunk, pairs):
        monkeypatch.setattr(align, "PAIRS", pairs)
        texts = self.odd + [t[:3000] if t else t for t in fx.texts()[:60]] + ["repeated row here"] * 2
        rows = [(k if k % 9 else None, t, None, None, None) for k, t in enumerate(texts)]
        aligned = align.Aligner(chunk=chunk).aligned(fx.documents(spark, rows))
        got = sorted((tuple(r) for r in align.summaries(aligned, align.pair_counts(aligned)).collect()), key=repr)
        assert got == sorted(aligned_brute([r[:2] for r in rows]), key=repr)

    def test_registered_query(self, spark):
        if not os.path.isdir(SF):
            pytest.skip("test tables not present")
        rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
        got = sorted(tuple(r) for r in queries.QUERIES["op11_align_tokenizers"](spark, SF).collect())
        assert got == sorted(aligned_brute(rows))

    def test_fragments_are_a_monoid(self):
        rng = random.Random(3)

        def fragment():
            a, b = [np.array([rng.randrange(9) for _ in range(rng.randrange(6))], np.int32) for _ in range(2)]
            cuts = rng.randrange(min(len(a), len(b)) + 1)
            parts = [np.diff(sorted(rng.sample(range(1, len(x) + 1), cuts)), prepend=0).astype(np.int32) for x in (a, b)]
            return align.Fragment(a, b, *parts, rng.random() < 0.9)

        same = lambda x, y: all(np.array_equal(getattr(x, f), getattr(y, f)) for f in ("a", "b", "na", "nb")) and x.ok == y.ok
        none = np.zeros(0, np.int32)
        unit = align.Fragment(none, none, none, none)
        for _ in range(300):
            x, y, z = fragment(), fragment(), fragment()
            assert same(align.compose(align.compose(x, y), z), align.compose(x, align.compose(y, z)))
            assert same(align.compose(unit, x), x) and same(align.compose(x, unit), x)

    def test_ranges_cover_a_text(self):
        for text in [t for t in self.odd if t] + ["no" * 90 + " a b c d e f g h", "ж щ " * 50]:
            for chunk in (8, 33):
                parts = align.byte_ranges(text, chunk, True)
                assert sum(high - low for _, low, high in parts) == len(text.encode()) + 1
                assert max(len(t.encode()) for t, _, _ in parts) <= len(text.encode())

    def test_empty(self, spark):
        aligned = align.Aligner().aligned(fx.empty(spark))
        assert align.summaries(aligned, align.pair_counts(aligned)).count() == 0


def collocations_brute(rows, support, first):
    counts, words = Counter(), Counter()
    for t, lang in rows:
        lang = lang or "und"
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in (1, 2, 3):
                counts.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    often = {p: n for p, n in counts.items() if n >= support}
    out = []
    for p, a in often.items():
        lang, w = p[0], p[1:]
        if len(w) == 1:
            continue
        cuts = [(10**6 * a * a // (often[(lang, *w[:k])] * often[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        longer = [n for q, n in often.items() if q[0] == lang and len(q) > len(p) and any(q[i : i + len(w)] == w for i in range(1, len(q)))]
        if not any(100 * n >= 50 * a for n in longer):
            out.append((lang, " ".join(w), a, often[(lang, *w[:k])], often[(lang, *w[k:])], words[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:first]
        ranked += [(lang, k + 1, *r[1:]) for k, r in enumerate(mine)]
    return sorted(ranked)


class TestCollocations:
    @pytest.mark.parametrize("support, shards, held", [(4, 3, 50), (10, 4, phrases.HELD_PHRASES)])
    def test_against_brute_force(self, spark, monkeypatch, support, shards, held):
        monkeypatch.setattr(phrases, "HELD_PHRASES", held)
        monkeypatch.setattr(phrases, "HELD", 2000)
        rng = random.Random(support)
        rows = [(k, fx.words(rng, 60, 25), ["en", "fr", None][k % 3], "s", 1) for k in range(90)]
        rows += [(1000 + k, t, "en", None, None) for k, t in enumerate(fx.texts())]
        rows += [(5, "New York, new york! É NEW\tYork\x0bnew  york", "und", None, None)] * 6 + [(None, "new york city", None, None, None)] * 3
        got = phrases.top_collocations(fx.documents(spark, rows), first=30, support=support, shards=shards).collect()
        assert sorted(tuple(r) for r in got) == collocations_brute([(r[1], r[2]) for r in rows], support, 30)

    def test_block_borders(self, spark, monkeypatch):
        monkeypatch.setattr(phrases, "BLOCK", 64)
        rng = random.Random(1)
        rows = [(k, fx.words(rng, 70, 6) + ". end", "en", "s", 1) for k in range(20)] + [(99, "w" * 500, "en", "s", 1)]
        got = phrases.top_collocations(fx.documents(spark, rows), first=50, support=5).collect()
        assert sorted(tuple(r) for r in got) == collocations_brute([(r[1], r[2]) for r in rows], 5, 50)

    def test_empty(self, spark):
        assert phrases.top_collocations(fx.empty(spark)).count() == 0


BLANKS = r"[\x20\x09-\x0D]"


def quality_brute(rows, labels):
    words = lambda t: [w for w in re.split(BLANKS + "+", t or "") if w]
    good, marks = defaultdict(lambda: True), set()
    for i, q, x in labels:
        marks.add(i)
        good[i] &= q == 1 and x == 0
    trusted = {i for i in marks if i is not None and good[i]}
    held = {i for i in trusted if zlib.crc32(str(i).encode()) % 3 == 1}

    def grams(t):
        c = [zlib.crc32(w.encode()) for w in words(t)]
        return [x % 65536 for x in c] + [(a * 1000003 + b) % 65536 for a, b in zip(c, c[1:], strict=False)]

    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        if i in trusted - held:
            target.update(grams(t))
    n_raw, n_target = sum(raw.values()) + 65536, sum(target.values()) + 65536

    def score(t):
        g = grams(t)
        ratio = lambda b: math.floor((math.log((target[b] + 1) / n_target) - math.log((raw[b] + 1) / n_raw)) * 1000000 + 0.5)
        return math.floor(sum(map(ratio, g)) / len(g)) if g and target else None

    steps = sorted(s // 1000 for s in (score(t) for i, t in rows if i in held) if s is not None)
    least = next((s * 1000 for k, s in enumerate(steps) if 1000 * (len(steps) - sum(x > s for x in steps)) > 5 * len(steps)), None)
    for i, t in rows:
        w, text = words(t), t or ""
        seen = defaultdict(list)
        for k in range(len(w) - 4):
            seen[tuple(w[k : k + 5])].append(k)
        covered = {k + d for ks in seen.values() if len(ks) > 1 for k in ks for d in range(5)}
        lines = [x for x in text.split("\n") if words(x)]
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        s = score(t)
        kept = not failed and (least is None or s >= least)
        yield i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), s, failed, kept


class TestQuality:
    def rows(self):
        rng = random.Random(8)
        rows = [(k, fx.words(rng, 40, 300), "en", "s", 1) for k in range(60)]
        rows += [(100 + k, " ".join(f"{w}%%%" for w in fx.words(rng, 30, 300).split()), "en", "s", 1) for k in range(20)]
        rows += [(200 + k, t, "en", None, None) for k, t in enumerate(fx.texts())]
        line = "one two three four five six"
        rows += [(300, f"{line}\n{line}\n \n{line}\t\n", None, None, None), (301, "a a a a a a a a a a a a", None, None, None)]
        rows += [(None, rows[0][1], None, None, None), (7, "again " + rows[3][1], None, None, None), (7, rows[4][1], None, None, None)]
        return rows

    def labels(self, spark, rows):
        schema = "doc_id long, quality int, toxic int"
        return spark.createDataFrame(rows, schema)

    @pytest.mark.parametrize("marks", [[(k, 1, 0) for k in range(40)] + [(5, 0, 0), (6, 1, 1), (8, None, 0), (None, 1, 0), (9, 1, 0)], [(1, 0, 0)], []])
    def test_against_brute_force(self, spark, marks):
        rows = self.rows()
        docs = fx.documents(spark, rows)
        got = quality.judged(docs, quality.fit(docs, quality.trusted_ids(self.labels(spark, marks))))
        names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words score base_failed kept".split()
        got = sorted((tuple(r) for r in got.select(*names).collect()), key=repr)
        assert got == sorted(quality_brute([r[:2] for r in rows], marks), key=repr)

    def test_marked_words_go_and_clean_texts_stay(self, spark):
        rows = self.rows()[:80]
        docs = fx.documents(spark, rows)
        model = quality.fit(docs, quality.trusted_ids(self.labels(spark, [(k, 1, 0) for k in range(50)])))
        kept = {r["doc_id"] for r in quality.judged(docs, model).where("kept").collect()}
        assert not any(i >= 100 for i in kept) and len([i for i in kept if i < 60]) >= 57

    def test_bound_on_trusted_documents(self, spark):
        labels = self.labels(spark, [(k, 1, 0) for k in range(50)])
        ids = [r["doc_id"] for r in quality.trusted_ids(labels, most=5).collect()]
        assert ids == sorted(range(50), key=lambda i: zlib.crc32(str(i).encode()))[:5]

    @pytest.mark.parametrize("bits", [quality.BITS, 8])
    def test_every_trusted_document_counts(self, spark, monkeypatch, bits):
        monkeypatch.setattr(quality, "BITS", bits)
        rng = random.Random(9)
        rows = [(k, fx.words(rng, 11, 500)) for k in range(20_600)]
        marks = [(k, 1, 0) for k in range(20_300)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        trusted = quality.trusted_ids(self.labels(spark, marks))
        assert trusted.count() == len(marks)
        got = sorted(tuple(r) for r in quality.judged(docs, quality.fit(docs, trusted)).collect())
        assert got == sorted(quality_brute(rows, marks)) and not all(r[-1] for r in got)

    def test_empty(self, spark):
        none = fx.empty(spark)
        assert quality.judged(none, quality.fit(none, quality.trusted_ids(self.labels(spark, [(1, 1, 0)])))).count() == 0
