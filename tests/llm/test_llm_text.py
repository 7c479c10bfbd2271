"""Exact dedup, sharding, mixing, decontamination, near-duplicates, passages: against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom.llm import decontam, exact_dedup, minhash, mixing, registry, sharding, suffix_dedup
from vecloom.llm.components import connected_components

from . import fixtures as fx

BLANKS = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    registry.prepare(spark)


@pytest.fixture(scope="module")
def docs(spark):
    return fx.documents(spark)


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


class TestExactDedup:
    def test_two_batches(self, spark, docs):
        rows = exact_dedup.digests(docs)
        index = exact_dedup.DigestIndex.create(spark)
        index.add(rows.where("doc_id < 30"))
        index.add(rows.where("doc_id >= 30"))
        groups: dict[str, list[int]] = {}
        for i, t in pairs(docs):
            groups.setdefault(BLANKS.sub(" ", t or ""), []).append(i)
        want = {i: (min(g), len(g)) for g in groups.values() for i in g}
        got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in index.resolve(rows).collect()}
        assert got == want
        assert index.rows().count() == len(groups)
        index.add(rows)  # known texts are not appended again
        assert index.rows().count() == len(groups)

    def test_known_text_keeps_the_id_of_the_index(self, spark):
        index = exact_dedup.DigestIndex.create(spark)
        row = lambda i, t: fx.documents(spark, [(i, t, None, None, None)])
        index.add(exact_dedup.digests(row(50, "a b")))
        index.add(exact_dedup.digests(row(7, "a  b")))
        assert index.resolve(exact_dedup.digests(row(7, "a\tb"))).first()["keep_id"] == 50

    def test_opened_from_its_folder(self, spark, docs, tmp_path):
        """The second batch finds an index whose name is gone, as in a later session."""
        rows, path = exact_dedup.digests(docs), str(tmp_path / "it's an index")
        first = exact_dedup.DigestIndex.create(spark, path, buckets=3)
        first.add(rows.where("doc_id < 30"))
        kept = sorted(tuple(r) for r in first.rows().collect())
        first.forget()
        index = exact_dedup.DigestIndex.open(spark, path)
        assert index.buckets == 3 and sorted(tuple(r) for r in index.rows().collect()) == kept
        index.add(rows.where("doc_id >= 30"))
        at_once = exact_dedup.DigestIndex.create(spark)
        at_once.add(rows)
        want = sorted(tuple(r) for r in at_once.resolve(rows).select("doc_id", "digest", "keep_id", "group_size").collect())
        assert sorted(tuple(r) for r in index.resolve(rows).select("doc_id", "digest", "keep_id", "group_size").collect()) == want
        plan = spark._jvm.PythonSQLUtils.explainString(index.rows().groupBy("digest").count()._jdf.queryExecution(), "formatted")
        assert "Bucketed: true" in plan and "Exchange" not in plan

    def test_nulls_and_empty(self, spark):
        index = exact_dedup.DigestIndex.create(spark)
        rows = exact_dedup.digests(fx.documents(spark, [(None, "x", None, None, None), (3, "x", None, None, None), (None, None, None, None, None)]))
        index.add(rows)
        assert sorted((r["doc_id"] or -1, r["keep_id"] or -1) for r in index.resolve(rows).collect()) == [(-1, -1), (-1, 3), (3, 3)]
        index.add(exact_dedup.digests(fx.empty(spark)))
        assert index.resolve(exact_dedup.digests(fx.empty(spark))).count() == 0


class TestSharding:
    def check(self, docs, shards):
        got = sharding.shard_documents(docs, shards).collect()
        texts = pairs(docs)
        assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in texts)
        sizes = Counter(r["shard"] for r in got)
        counts = [sizes.get(s, 0) for s in range(shards)]
        assert set(sizes) <= set(range(shards)) and max(counts) - min(counts) <= 1
        for s in range(shards):
            assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
        by_id = dict(texts)
        for r in got:
            raw = (by_id[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        return got

    def test_counts_slots_and_groups(self, spark, docs):
        got = self.check(docs, 4)
        shard = {r["doc_id"]: r["shard"] for r in got}
        groups: dict[str, list[int]] = {}
        for i, t in pairs(docs):
            groups.setdefault(t or "", []).append(i)
        cut = sum(len({shard[i] for i in g}) - 1 for g in groups.values())
        whole = sum(len(g) - 1 for g in groups.values())
        assert cut <= whole // 3

    def test_a_third_of_all_rows_is_one_text(self, spark):
        rows = [(k, "same" if k % 3 == 0 else f"t{k}", None, None, None) for k in range(600)]
        got = self.check(fx.documents(spark, rows), 16)
        assert len({r["shard"] for r in got if r["doc_id"] % 3 == 0}) < 16

    def test_repeated_and_null_ids(self, spark):
        rows = [(1, "a", None, None, None)] * 5 + [(None, None, None, None, None)] * 4
        got = sharding.shard_documents(fx.documents(spark, rows), 3).collect()
        assert len(got) == 9 and sorted(Counter(r["shard"] for r in got).values()) == [3, 3, 3]

    def test_small_stars_meet(self, spark):
        pairs_ = [(g + 1000, g, 1.0) for g in range(1000)]
        tens = [(10000 + g * 10 + k, 10000 + g * 10, 1.0) for g in range(200) for k in range(1, 10)]
        edges = spark.createDataFrame(pairs_ + tens, "src long, dst long, weight double")
        nodes = edges.selectExpr("src as rid").union(edges.selectExpr("dst as rid")).distinct()
        label = dict(sharding.propagate(nodes, edges, 16, 250).collect())
        assert sum(label[a] != label[b] for a, b, _ in pairs_) < 0.6 * len(pairs_)
        assert sum(label[a] != label[b] for a, b, _ in tens) < 0.6 * len(tens)

    def test_empty(self, spark):
        assert sharding.shard_documents(fx.empty(spark)).count() == 0

    def test_fewer_rows_than_shards(self, spark):
        self.check(fx.documents(spark, [(k, "t", None, None, None) for k in range(3)]), 16)

    def test_grants_keep_quotas(self):
        flows = {(0, 1): 10, (1, 0): 4, (2, 1): 6}
        shares = sharding.granted(flows, [0, 3, 5])
        assert shares[1, 0] == 1.0
        assert shares[0, 1] * 10 + shares[2, 1] * 6 <= 4 + 3 + 1e-9


class TestMixing:
    def test_weights_meet_targets(self, spark):
        rows = [(k, "w " * (1 + k % 5), "en" if k % 4 else "fr", "x" if k % 3 else "y", None) for k in range(400)]
        got = mixing.mix(fx.documents(spark, rows), topic=F.lit("t"), rounds=20).collect()
        tokens = sum(r["tokens"] for r in got)
        for m in ("source", "lang"):
            seen = Counter()
            for r in got:
                seen[r[m]] += r["tokens"]
            norm = sum(n**mixing.TEMPER for n in seen.values())
            for value, n in seen.items():
                drawn = sum(r["tokens"] * r["prob"] for r in got if r[m] == value)
                goal = n**mixing.TEMPER / norm * tokens * mixing.BUDGET
                assert drawn == pytest.approx(min(goal, n), rel=0.02)

    def test_edges(self, spark, docs):
        got = mixing.mix(docs).collect()
        assert len(got) == docs.count() and all(0 <= r["prob"] <= 1 for r in got)
        assert {r["tokens"] for r in got if r["doc_id"] in {i for i, t in pairs(docs) if not (t or "").strip()}} == {0}
        kept = mixing.sample_documents(docs)
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in got if r["sampled"])
        assert mixing.mix(fx.empty(spark)).count() == 0
        twice = mixing.mix(docs.unionByName(docs)).collect()
        assert len({(r["doc_id"], r["sampled"]) for r in twice}) == len(got)


class TestDecontamination:
    ITEMS = "item_id long, text string"

    def brute(self, docs, items):
        word = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
        split = lambda t: word.findall((t or "").translate(LOWER))
        gram = lambda w, n: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        out = set()
        for j, t in items:
            w = split(t)
            if j is None or not w:
                continue
            g = gram(w, min(5, len(w)))
            for i, d in docs:
                n = len(g & gram(split(d), min(5, len(w))))
                if n and n >= 0.8 * len(g) - 1e-9:
                    out.add((i, j, n, len(g)))
        return out

    @pytest.mark.parametrize("block_bytes", [64 << 20, 500])
    def test_against_brute_force(self, spark, docs, block_bytes, monkeypatch):
        monkeypatch.setattr(decontam, "LEAKS_SENT", block_bytes >> 20)  # 64 and 0: leaks broadcast, and joined as planned
        texts = fx.texts()
        long = texts[-2].split()
        items = [(0, " ".join(long[500:540])), (1, "no such passage anywhere at all"), (2, texts[25]), (3, ""), (4, None)]
        items += [(5, long[7]), (6, "A-b, C"), (6, "A-b, C"), (7, texts[59][60:200]), (None, texts[3])]
        items += [(8, " ".join([*long[100:130], "x1", "x2", *long[130:160]]))]
        bench = spark.createDataFrame(items, self.ITEMS).withColumn("doc_id", F.lit(1))
        got = decontam.contained_items(docs, bench, block_bytes=block_bytes)
        assert {tuple(r)[:4] for r in got.collect()} == self.brute(pairs(docs), items)
        clean = decontam.clean_documents(docs, bench)
        leaks = {r["doc_id"] for r in got.collect()}
        plan = clean._jdf.queryExecution().logical().toString()
        assert 0 < len(leaks) <= 64 and ("strategy=broadcast" in plan) == (block_bytes > 500)
        assert clean.columns == docs.columns
        assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in pairs(docs)} - leaks

    def test_empty(self, spark, docs):
        none = spark.createDataFrame([], self.ITEMS)
        assert decontam.contained_items(docs, none).count() == 0
        assert decontam.clean_documents(docs, none).count() == docs.count()
        some = spark.createDataFrame([(1, "a b c d e f")], self.ITEMS)
        assert decontam.contained_items(fx.empty(spark), some).count() == 0

    def test_leaks_are_sent_as_numbers(self, spark):
        """What the driver builds of the leaks are checksums; a clean text with the checksum of a leak stays."""
        item = "one two three four five six seven"
        hashed = [hashlib.md5(str(k).encode()).hexdigest() for k in range(300_000)]
        sums = {zlib.crc32(f"{item} {h}".encode()): h for h in hashed}
        leak, plain = next((sums[c], h) for h in hashed if (c := zlib.crc32(f"plain {h[::-1]}".encode())) in sums)
        plain = f"plain {plain[::-1]}"
        texts = [f"{item} {leak}", plain, None, f"{item} {leak}", "", plain, f"{item} x"]
        docs = fx.documents(spark, [(k % 3 or None, t, None, str(k), None) for k, t in enumerate(texts)])
        was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            clean = decontam.clean_documents(docs, spark.createDataFrame([(1, item)], self.ITEMS))
            plan = clean._jdf.queryExecution().executedPlan().toString()
            assert sorted(r["source"] for r in clean.collect()) == ["1", "2", "4", "5"]
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
        assert set(re.findall(r"BroadcastMode\(List\(input\[0, (\w+)", plan)) == {"bigint"}


def near_brute(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


class TestNearDuplicates:
    @pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
    def test_against_brute_force(self, spark, docs, width, percent):
        got = minhash.near_duplicates(docs, width, percent).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == near_brute(pairs(docs), width, percent)
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
        kept = minhash.without_near_copies(docs, width, percent)
        assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["kept"]}

    def test_crowded_buckets(self, spark):
        """Many texts that share most words and are partly linked: large buckets with several components."""
        import random

        rng = random.Random(3)
        base = fx.words(rng, 60).split()
        rows = []
        for k in range(150):
            w = list(base)
            for _ in range(rng.choice([1, 2, 3, 4])):
                w[rng.randrange(60)] = f"z{rng.randrange(12)}"
            rows.append((k, " ".join(w), None, None, None))
        docs = fx.documents(spark, rows)
        got = minhash.near_duplicates(docs, 3, 85).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == near_brute(pairs(docs), 3, 85)

    def test_hot_template(self, spark, monkeypatch):
        """Pairs of near copies among many texts that share most shingles, but too few for a link."""
        import random

        rng = random.Random(5)
        base, rows = fx.words(rng, 100).split(), []
        for k in range(150):
            one = list(base)
            for at in rng.sample(range(1, 96, 4), 2):
                one[at : at + 2] = [f"x{k}.{at}", f"y{k}.{at}"]
            two = list(one)
            for at in rng.sample(range(3, 98, 4), 2):
                two[at] = f"q{k}.{at}"
            rows += [(2 * k, " ".join(one), None, None, None), (2 * k + 1, " ".join(two), None, None, None)]
        want = near_brute([r[:2] for r in rows], 3, 85)
        assert len(set(want.values())) > 100
        # no round finds a link: what is left is found by prefix groups alone, listed or in blocks
        monkeypatch.setattr(minhash, "buckets", lambda r, f=minhash.buckets: f(r) if "at" in r.columns else f(r).where("n < 0"))
        monkeypatch.setattr(minhash, "LISTED", 16)
        got = minhash.near_duplicates(fx.documents(spark, rows), 3, 85).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want

    def test_one_shingle_in_a_third_of_all_texts(self, spark, monkeypatch):
        monkeypatch.setattr(minhash, "LISTED", 8)  # so that its group goes by blocks
        monkeypatch.setattr(minhash, "BLOCK", 6)
        rng = random.Random(12)
        notice = "all rights reserved by us"
        rows = [(k, f"{notice} {fx.words(rng, rng.choice([1, 2, 9, 30]))}" if k % 3 == 0 else fx.words(rng, 30), None, None, None) for k in range(120)]
        rows += [(200 + k, rows[3 * k][1] + " w", None, None, None) for k in range(20)]
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(fx.documents(spark, rows), 3, 80).collect()}
        assert got == near_brute([r[:2] for r in rows], 3, 80)

    def test_scratch_is_bounded_and_released(self, spark, docs, monkeypatch):
        """Prefix rows and pairs in turns give the same result; each turn's rows, and wide tables that nothing reads any more, are deleted."""
        kept, most, gone = {}, {}, set()

        def stored(df, label, f=minhash.stored):
            out = f(df, label)
            kept[out._stored_in] = label
            now = [x for x in kept.values() if x == label]
            most[label] = max(most.get(label, 0), len(now))
            return out

        def release(*tables, f=minhash.release):
            gone.update(kept.pop(t._stored_in) for t in tables)
            f(*tables)

        monkeypatch.setattr(minhash, "stored", stored)
        monkeypatch.setattr(minhash, "release", release)
        for name, value in (("TURN_ENTRIES", 1), ("TURN_PAIRS", 0), ("TURN_PAIRS_LEAST", 4)):
            monkeypatch.setattr(minhash, name, value)
        got = minhash.near_duplicates(docs, 3, 85).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == near_brute(pairs(docs), 3, 85)
        assert most["near-open"] == 1 and most["near-met"] >= minhash.TURNS
        assert {"near-sigs", "near-bands", "near-open", "near-marked"} <= gone

    @pytest.mark.parametrize("sizes", [(5, 5), (40, 47), (3000, 2600), (700, 700)])
    def test_histograms_bound_what_sets_share(self, sizes):
        rng = np.random.default_rng(sum(sizes))
        for share in (0.0, 0.5, 1.0):
            x, y = (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) for n in sizes)
            n = int(share * min(sizes))
            y[:n] = x[:n]
            got = minhash.most_shared(*(np.frombuffer(minhash.histogram(np.unique(s)), np.uint8) for s in (x, y)))
            assert got is None or got >= n

    def test_nulls_repeats_empty(self, spark):
        rows = [(None, "a b c d", None, None, None), (4, "a b c d", None, None, None), (4, "a b c d", None, None, None), (5, "A b  c D", None, None, None)]
        got = minhash.near_duplicates(fx.documents(spark, rows), 3, 85).collect()
        assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in got) == [
            (-1, -1, True), (4, 4, True), (4, 4, True), (5, 4, False),
        ]
        assert minhash.near_duplicates(fx.empty(spark)).count() == 0

    def test_components_of_a_chain(self, spark):
        edges = [(k, k + 1) for k in range(200)] + [(500, 501)]
        got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
        assert {r["node"]: r["comp"] for r in got} == {k: 0 for k in range(201)} | {500: 500, 501: 500}


def passages_brute(rows):
    low: dict[bytes, int] = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        for k in range(len(b) - 49):
            low.setdefault(b[k : k + 50], i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        m = bytearray(len(b))
        if i is not None:
            for k in range(len(b) - 49):
                if low[b[k : k + 50]] < i:
                    m[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, y in zip(b, m, strict=True) if not y)
        runs = sum(1 for k in range(len(m)) if m[k] and (k == 0 or not m[k - 1]))
        out.append((-1 if i is None else i, len(b), sum(m), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


class TestPassages:
    def got(self, docs):
        return sorted(
            (-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
            for r in suffix_dedup.repeated_passages(docs).collect()
        )

    def test_against_brute_force(self, spark, docs):
        assert self.got(docs) == passages_brute(pairs(docs))

    def test_repeats_nulls_short(self, spark):
        t = "0123456789" * 7
        rows = [(3, t), (3, t), (1, t[:49]), (2, t[5:60]), (None, t), (9, None), (8, "x" + t + "y"), (7, "k" * 120), (6, "k" * 70), (5, t[:49])]
        docs = fx.documents(spark, [(i, x, None, None, None) for i, x in rows])
        assert self.got(docs) == passages_brute(rows)

    def test_text_longer_than_a_block(self, spark):
        import random

        rng = random.Random(9)
        long = "".join(rng.choice("abcdefgh ") for _ in range(suffix_dedup.BLOCK + 5000))
        cut = suffix_dedup.BLOCK - 30
        rows = [(1, long[cut - 40 : cut + 120]), (2, long), (3, long[200:260] + long[-90:])]
        docs = fx.documents(spark, [(i, x, None, None, None) for i, x in rows])
        assert self.got(docs) == passages_brute(rows)

    def test_empty(self, spark):
        assert suffix_dedup.repeated_passages(fx.empty(spark)).count() == 0
