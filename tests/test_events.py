import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vecloom.operators import events, identity
from vecloom.streaming import ingest, ordered

T0 = dt.datetime(2024, 3, 1, 23, 59, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def readings(spark, values, key="k", step=1):
    rows = [(key, at(i * step), i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key string, ts timestamp, id bigint, value double")


def loop_runs(rows, threshold, min_run):
    run, out = {}, []
    for key, ts, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        if v is None:
            continue
        if v < threshold:
            run[key] = run.get(key, 0) + 1
        else:
            if run.get(key, 0) >= min_run:
                out.append((key, i, run[key]))
            run[key] = 0
    return sorted(out), {k: n for k, n in run.items() if n}


def found(df):
    return sorted((r["key"], r["id"], r["run"]) for r in df.collect())


@pytest.mark.parametrize("seconds", [1, 2, 3, 1000, None])
def test_low_run_fixture(spark, seconds):
    df = readings(spark, [0.3, 0.2, 0.2, 0.3, 0.2, 0.3, 0.1, 0.1, 0.1])
    assert found(events.low_runs(df, ["key"], seconds=seconds)) == [("k", 3, 2)]
    assert [tuple(r) for r in events.open_runs(df, ["key"], seconds=seconds).collect()] == [("k", 3)]


def test_null_reading_neither_extends_nor_ends(spark):
    df = readings(spark, [0.1, None, 0.1, None, 0.9, None, 0.1, 0.25])
    assert found(events.low_runs(df, ["key"], seconds=2)) == [("k", 4, 2)]


@pytest.mark.parametrize("seed", range(3))
def test_low_runs_equal_a_loop_with_a_hot_key(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(5)}"
        value = None if rng.random() < 0.1 else rng.choice([0.1, 0.1, 0.2, 0.25, 0.5])
        rows.append((key, at(rng.randrange(300)), i, value))
    df = spark.createDataFrame(rows, "key string, ts timestamp, id bigint, value double")
    want, left = loop_runs(rows, 0.25, 3)
    assert found(events.low_runs(df, ["key"], min_run=3, seconds=7)) == want
    assert {r["key"]: r["run"] for r in events.open_runs(df, ["key"], seconds=7).collect()} == left


def test_slice_width_follows_the_busiest_key(spark):
    df = readings(spark, [0.1] * 100, step=10)
    assert events.slice_seconds(df, ["key"], target_rows=10) == 99
    assert events.slice_seconds(df.limit(0), ["key"]) == events.SLICE_SECONDS


@pytest.mark.parametrize("seconds", [1, 3, 10_000])
@pytest.mark.parametrize("gaps, sizes", [([1.4], [2]), ([1.5], [2]), ([1.6], [1, 1]), ([1.0, 1.0, 5.0, 0.5], [3, 2]), ([], [1])])
def test_debounce(spark, gaps, sizes, seconds):
    times = [0.0]
    for g in gaps:
        times.append(times[-1] + g)
    df = spark.createDataFrame([("s", at(t)) for t in times], "source string, ts timestamp")
    got = events.sessions(df, ["source"], ingest.DEBOUNCE_SECONDS, seconds).orderBy("start").collect()
    assert [r["changes"] for r in got] == sizes


def test_daily_marks(spark):
    rows = [(1, at(0), 5), (1, at(30), 6), (1, at(90), 7), (2, at(10), 8), (2, at(10), 9)]
    df = spark.createDataFrame(rows, "user_id bigint, ts timestamp, id bigint")
    got = sorted((r["user_id"], str(r["date"]), r["id"]) for r in identity.daily_marks(df).collect())
    assert got == [(1, "2024-03-01", 5), (1, "2024-03-02", 7), (2, "2024-03-01", 8)]
    history = spark.createDataFrame([(1, dt.date(2024, 3, 1))], "user_id bigint, date date")
    assert sorted(r["id"] for r in identity.daily_marks(df, history).collect()) == [7, 8]
    # east of Greenwich all of it is the second of March
    assert sorted(r["id"] for r in identity.daily_marks(df, zone="Europe/Berlin").collect()) == [5, 8]


def test_register_new(spark):
    batch = spark.createDataFrame([("Ann", 2), ("Ann", 1), ("ann", 3), ("Bob", 4)], "name string, seq int")
    users = spark.createDataFrame([("Bob",)], "name string")
    got = identity.register_new(batch, users, "seq").collect()
    assert sorted((r["name"], r["seq"]) for r in got) == [("Ann", 1), ("ann", 3)]
    assert len({r["user_id"] for r in got}) == 2 and all(r["user_id"] >= 0 for r in got)


def loop_marks(opened, matches, history=()):
    gates, done, out = set(), set(history), []
    frames = sorted({(ts, f, s) for s, ts, f in opened} | {(m[1], m[2], m[0]) for m in matches})
    for ts, frame, site in frames:
        if (site, ts, frame) in opened:
            gates.add(site)
        for m in sorted((m for m in matches if m[:3] == (site, ts, frame)), key=lambda m: m[3]):
            day = (m[4], ts.date())
            if site in gates and m[4] is not None and day not in done:
                done.add(day)
                gates.discard(site)
                out.append((site, frame, m[3], m[4]))
    return sorted(out)


def marks(df):
    return sorted((r["site"], r["frame"], r["face"], r["user_id"]) for r in df.collect())


def gate_frames(spark, opened, matches):
    return (
        spark.createDataFrame(sorted(opened), "site string, ts timestamp, frame bigint"),
        spark.createDataFrame(matches, "site string, ts timestamp, frame bigint, face int, user_id bigint"),
    )


def test_gate_cases(spark):
    opened = {("a", at(2), 2), ("a", at(5), 5)}
    matches = [
        ("a", at(1), 1, 0, 7),  # before any event
        ("a", at(2), 2, 0, None),  # unknown face
        ("a", at(3), 3, 0, 8),  # marked last time: gate stays open
        ("a", at(4), 4, 0, 7),
        ("a", at(4), 4, 1, 9),  # second face after one event
        ("a", at(5), 5, 0, 7),  # already marked
        ("a", at(70), 6, 0, 7),  # the next day
    ]
    history = spark.createDataFrame([(8, T0.date())], "user_id bigint, date date")
    e, m = gate_frames(spark, opened, matches)
    assert marks(events.gated_marks(e, m, history, 10)) == [("a", 4, 0, 7), ("a", 6, 0, 7)]


@pytest.mark.parametrize("limit", [100_000, 3])
@pytest.mark.parametrize("seed", range(2))
def test_gated_marks_equal_a_loop(spark, seed, limit):
    rng = random.Random(seed)
    times = [at(i) for i in range(150)]
    opened = {(rng.choice("aab"), times[i], i) for i in range(150) if rng.random() < 0.3}
    matches = [(rng.choice("aab"), times[i], i, f, rng.choice([None, 1, 2, 3, 4, 5])) for i in range(150) for f in range(rng.randrange(3))]
    e, m = gate_frames(spark, opened, matches)
    assert marks(events.gated_marks(e, m, seconds=20, component_edges=limit)) == loop_marks(opened, matches)


def test_edges_in_order_by_component(spark, monkeypatch):
    """Chains in which every edge waits for the one before it, and one hub, next to each other."""
    chains = [(f"c{k}", f"l{k}-{i // 2}", f"r{k}-{(i + 1) // 2}", i) for k in range(20) for i in range(4 + k % 9)]
    hub = [("hub", f"h{i % 7}", f"u{i % 11}", 40 + i) for i in range(77)]
    edges = spark.createDataFrame([(l, r, n, c) for c, l, r, n in chains + hub], "l string, r string, n int, c string")
    monkeypatch.setattr(events, "ROUNDS", 1)
    monkeypatch.setattr(events, "SHRINK", 0.5)
    used, want = set(), set()
    for n, l, r in sorted((n, l, r) for _, l, r, n in chains + hub):
        if l not in used and r not in used:
            used |= {l, r}
            want.add((l, r))
    for limit in (6, 1000):
        got = events.match_in_order(edges, ["l"], ["r"], ["n", "l", "r"], limit)
        assert sorted((x["l"], x["r"]) for x in got.collect()) == sorted(want)
    parted = events._with_component(edges, ["l"], ["r"]).groupBy("__comp__").agg(F.collect_set("c").alias("c"))
    assert sorted(x["c"] for x in parted.collect()) == sorted([c] for c in {e[0] for e in chains + hub})


# streams


def land(df, path):
    df.coalesce(1).write.mode("append").parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


def test_stream_waits_for_the_watermark_and_counts_late_rows(spark, tmp_path):
    rows = [("k", at(i), i, v) for i, v in enumerate([0.1, 0.9, 0.1, 0.1, 0.9, 0.1, 0.1, 0.9])]
    schema = "key string, ts timestamp, id bigint, value double"
    out, path, ckpt = (str(tmp_path / n) for n in ("out", "in", "ckpt"))
    # rows may come two seconds late; the third landing holds one behind the watermark
    for ids in ([0, 1, 3], [4, 2, 5], [1, 7, 6]):
        stream = land(spark.createDataFrame([rows[i] for i in ids], schema), path)
        ordered.stream_low_runs(stream, ["key"], out, ckpt, delay_seconds=2, seconds=3).awaitTermination()
    got = ordered.read_parts(spark, out, "key string, ts timestamp, id bigint, run bigint")
    assert found(got) == [("k", 4, 2)]
    state = ordered.BatchState(spark, f"{ckpt}/runs", 3)
    assert sorted(r["id"] for r in state.before("pending", schema).collect()) == [5, 6, 7]
    assert [r["id"] for r in ordered.read_parts(spark, f"{ckpt}/late", schema).collect()] == [1]
    ordered.finish_low_runs(spark, stream.schema, ["key"], out, ckpt, seconds=3)
    assert found(ordered.read_parts(spark, out, "key string, ts timestamp, id bigint, run bigint")) == [("k", 4, 2), ("k", 7, 2)]
    batch = spark.createDataFrame([rows[0], rows[7]], schema)
    ready, late = ordered.in_order(batch, ordered.BatchState(spark, f"{ckpt}/runs", 3), 0)
    assert [r["id"] for r in late.collect()] == [0] and sorted(r["id"] for r in ready.collect()) == [5, 6]


def test_stream_keeps_rows_that_share_the_newest_timestamp(spark, tmp_path):
    schema = "key string, ts timestamp, id bigint, value double"
    out, path, ckpt = (str(tmp_path / n) for n in ("out", "in", "ckpt"))
    for rows in ([(1, 1, 1.0), (2, 2, 1.0)], [(2, 3, 50.0), (3, 4, 1.0), (4, 5, 60.0)]):
        stream = land(spark.createDataFrame([("k", at(t), i, v) for t, i, v in rows], schema), path)
        ordered.stream_low_runs(stream, ["key"], out, ckpt, threshold=10, min_run=2, seconds=3).awaitTermination()
    ordered.finish_low_runs(spark, stream.schema, ["key"], out, ckpt, threshold=10, min_run=2, seconds=3)
    assert found(ordered.read_parts(spark, out, "key string, ts timestamp, id bigint, run bigint")) == [("k", 3, 2)]


def test_retried_batch_gives_the_same_output(spark, tmp_path):
    """State is kept per batch id, so running a batch again replaces its results."""
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    state = ordered.BatchState(spark, ckpt, 0)
    df = readings(spark, [0.1, 0.1, 0.9])
    for _ in range(2):
        ready, _ = ordered.in_order(df, state, 0, final=True)
        ordered.write_part(events.low_runs(ready, ["key"], seconds=10), out, 0)
    assert found(ordered.read_parts(spark, out, "key string, ts timestamp, id bigint, run bigint")) == [("k", 2, 2)]


def test_stream_daily_marks_across_restarts(spark, tmp_path):
    out, path, ckpt = (str(tmp_path / n) for n in ("out", "in", "ckpt"))
    schema = "user_id bigint, ts timestamp, id bigint"
    for rows in ([(1, at(0), 1), (2, at(1), 2)], [(1, at(30), 3), (1, at(90), 4), (1, at(91), 5)], [(2, at(-5), 6), (3, at(2), 7)]):
        stream = land(spark.createDataFrame(rows, schema), path)
        ordered.stream_daily_marks(stream, out, ckpt).awaitTermination()
    assert sorted(r["id"] for r in ordered.read_parts(spark, out, ordered.MARK_SCHEMA).collect()) == [1, 2, 4, 7]


def test_stream_gate_stays_open_between_batches(spark, tmp_path):
    out, path, ckpt = (str(tmp_path / n) for n in ("out", "in", "ckpt"))
    schema = "site string, ts timestamp, frame bigint, value double, faces array<bigint>"
    batches = [
        [("a", at(1), 1, 0.1, []), ("a", at(2), 2, 0.1, [5])],
        [("a", at(3), 3, 0.9, [])],  # the event, its run begun in the batch before
        [("b", at(4), 4, 0.9, [5])],
        [("a", at(5), 5, 0.9, [None, 5, 6])],  # marked behind the gate still open
        [("a", at(6), 6, 0.9, [6])],  # closed again
    ]
    for rows in batches:
        stream = land(spark.createDataFrame(rows, schema), path)
        ordered.stream_gated_marks(stream, out, ckpt).awaitTermination()
    ordered.finish_gated_marks(spark, stream.schema, out, ckpt)
    assert marks(ordered.read_parts(spark, out, ordered.GATED_SCHEMA)) == [("a", 5, 1, 5)]


def test_stream_debounce(spark, tmp_path):
    rows = [("s", at(t)) for t in (0, 1.4, 2.9, 6)] + [("t", at(0)), ("z", at(100))]
    df = spark.createDataFrame(rows, "source string, ts timestamp")
    stream = land(df, str(tmp_path / "in"))
    query = (
        ingest.debounced(stream, delay="0 seconds")
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    # the last change is still inside its quiet time
    assert sorted((r["source"], r["changes"], r["end"]) for r in got) == [("s", 1, at(6)), ("s", 3, at(2.9)), ("t", 1, at(0))]
    batch = events.sessions(df, ["source"], ingest.DEBOUNCE_SECONDS, 1000)
    assert {("s", 3), ("s", 1), ("t", 1), ("z", 1)} == {(r["source"], r["changes"]) for r in batch.collect()}
    assert batch.where(F.col("source") == "s").count() == 2
