"""Ordered-event operators that do not gather a key in one task.

Every operator cuts a key's history into time slices, works inside ``(key, slice)`` windows,
and passes what crosses a slice border through a window over slice summaries, of which there is
one row per key and slice. A key holding a third of the data thus spreads over its slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise

LOW_THRESHOLD = 0.25
MIN_RUN = 2
SLICE_SECONDS = 86_400
TARGET_SLICE_ROWS = 1_000_000
# After so many rounds they go on while one leaves at most this share of its edges; then the most edges of a component
# that a task takes in order.
ROUNDS, SHRINK = 8, 0.8
COMPONENT_EDGES = 100_000


def slice_seconds(df: DataFrame, keys: Sequence[str], ts: str = "ts", target_rows: int = TARGET_SLICE_ROWS) -> int:
    """Slice width at which the busiest key has about ``target_rows`` rows in a slice; one aggregate."""
    seconds = F.unix_seconds(F.col(ts).cast("timestamp"))
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"), (F.max(seconds) - F.min(seconds) + 1).alias("span"))
    width = per_key.agg(F.min(F.greatest(F.lit(1.0), F.col("span") * target_rows / F.col("n")))).first()[0]
    return int(min(width or SLICE_SECONDS, 366 * SLICE_SECONDS))


def time_slice(ts: Column | str, seconds: int) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / seconds)




def low_runs(
    readings: DataFrame,
    keys: Sequence[str],
    threshold: float = LOW_THRESHOLD,
    min_run: int = MIN_RUN,
    seconds: int | None = None,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Events ``(keys, ts, id, run)``: the first reading at or above ``threshold`` after at least
    ``min_run`` readings below it. Null readings neither extend nor end a run; an open run gives
    no event. ``carry(keys, run)`` holds runs left open by earlier data.
    """
    inside, summary = _run_slices(readings, keys, threshold, seconds)
    within = inside.where((F.col("low") == 0) & (F.col("highs_before") > 0)).select(
        *keys, "ts", "id", F.col("lows_before").alias("run")
    )
    border = _with_carry(summary, keys, carry).where("first_high is not null").select(
        *keys, "first_high.ts", "first_high.id", (F.col("carry") + F.col("lead")).alias("run")
    )
    return within.unionByName(border).where(F.col("run") >= min_run)


def open_runs(
    readings: DataFrame,
    keys: Sequence[str],
    threshold: float = LOW_THRESHOLD,
    seconds: int | None = None,
    carry: DataFrame | None = None,
) -> DataFrame:
    """``(keys, run)``: length of the run still open at the end of each key, zeros left out."""
    _, summary = _run_slices(readings, keys, threshold, seconds)
    w = W.partitionBy(*keys).orderBy(F.col("slice").desc())
    last = _with_carry(summary, keys, carry).withColumn("__rn__", F.row_number().over(w)).where("__rn__ = 1")
    run = F.when(F.col("highs") > 0, F.col("trail")).otherwise(F.col("carry") + F.col("trail"))
    return last.select(*keys, run.alias("run")).where("run > 0")


def _run_slices(
    readings: DataFrame, keys: Sequence[str], threshold: float, seconds: int | None
) -> tuple[DataFrame, DataFrame]:
    """Rows with their counts inside a slice, and one summary row per slice."""
    readings = readings.select(*keys, "ts", "id", "value").where("value is not null")
    seconds = slice_seconds(readings, keys) if seconds is None else seconds
    part = [*keys, "slice"]
    before = W.partitionBy(*part).orderBy("ts", "id").rowsBetween(W.unboundedPreceding, -1)
    inside = (
        readings.withColumn("slice", time_slice("ts", seconds))
        .withColumn("low", (F.col("value") < threshold).cast("int"))
        .withColumn("highs_before", F.coalesce(F.sum(1 - F.col("low")).over(before), F.lit(0)))
    )
    run = W.partitionBy(*part, "highs_before").orderBy("ts", "id").rowsBetween(W.unboundedPreceding, -1)
    inside = inside.withColumn("lows_before", F.coalesce(F.sum("low").over(run), F.lit(0)))
    high = F.col("low") == 0
    first = (F.col("highs_before") == 0) & high
    # lows after the last high are those of the highest island
    per_island = inside.groupBy(*part, "highs_before").agg(
        F.sum("low").alias("lows"),
        F.sum(F.when(high, 1).otherwise(0)).alias("highs"),
        F.max(F.when(first, F.struct("ts", "id"))).alias("first_high"),
    )
    summary = per_island.groupBy(*part).agg(
        F.sum("highs").alias("highs"),
        F.max("first_high").alias("first_high"),
        F.sum(F.when(F.col("highs_before") == 0, F.col("lows"))).alias("lead"),
        F.max(F.struct("highs_before", F.when(F.col("highs") == 0, F.col("lows")).otherwise(0).alias("lows"))).alias("top"),
    )
    return inside, summary.withColumn("trail", F.col("top.lows")).drop("top")


def _with_carry(summary: DataFrame, keys: Sequence[str], carry: DataFrame | None) -> DataFrame:
    """Each slice with ``carry``, the run it inherits from the slices before it."""
    if carry is not None:
        # earlier data acts as a slice before all others
        earlier = carry.select(*keys, F.lit(None).cast("bigint").alias("slice"), F.col("run").alias("trail"))
        summary = summary.unionByName(earlier, allowMissingColumns=True).na.fill({"highs": 0, "lead": 0})
    by_time = W.partitionBy(*keys).orderBy("slice")
    era = F.sum(F.when(F.col("highs") > 0, 1).otherwise(0)).over(by_time)
    in_era = W.partitionBy(*keys, "era").orderBy("slice")
    return (
        summary.withColumn("era", era)
        .withColumn("open", F.sum("trail").over(in_era))
        .withColumn("carry", F.coalesce(F.lag("open").over(by_time), F.lit(0)))
        .drop("era", "open")
    )


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: Column, name: str, seconds: int
) -> DataFrame:
    """``df`` plus the inclusive running sum of ``amount`` over ``order``, whose first column is a
    timestamp."""
    part = [*keys, "__slice__"]
    cut = df.withColumn("__slice__", time_slice(order[0], seconds)).withColumn("__amount__", amount)
    local = cut.withColumn("__local__", F.sum("__amount__").over(W.partitionBy(*part).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))
    earlier = W.partitionBy(*keys).orderBy("__slice__").rowsBetween(W.unboundedPreceding, -1)
    base = cut.groupBy(*part).agg(F.sum("__amount__").alias("__sum__")).withColumn(
        "__base__", F.coalesce(F.sum("__sum__").over(earlier), F.lit(0))
    ).drop("__sum__")
    total = (F.col("__local__") + F.col("__base__")).alias(name)
    return local.join(base, part).select(*df.columns, total)


def sessions(changes: DataFrame, keys: Sequence[str], gap_seconds: float, seconds: int | None = None) -> DataFrame:
    """Trailing debounce ``(keys, start, end, changes)``: changes at most the gap apart merge.

    Only the first and last session of a slice can reach into another slice; the others are final
    where they are.
    """
    changes = changes.select(*keys, F.col("ts").cast("timestamp").alias("ts"))
    seconds = slice_seconds(changes, keys) if seconds is None else seconds
    part = [*keys, "slice"]
    micros = F.unix_micros("ts")
    gap = int(round(gap_seconds * 1_000_000))
    by_time = W.partitionBy(*part).orderBy("ts")
    is_start = F.coalesce(micros - F.lag(micros).over(by_time) > gap, F.lit(True)).cast("int")
    numbered = changes.withColumn("slice", time_slice("ts", seconds)).withColumn("is_start", is_start)
    numbered = numbered.withColumn("no", F.sum("is_start").over(by_time.rowsBetween(W.unboundedPreceding, 0)))
    local = numbered.groupBy(*part, "no").agg(
        F.min("ts").alias("start"), F.max("ts").alias("end"), F.count("*").alias("changes")
    )
    local = local.withColumn("last_no", F.max("no").over(W.partitionBy(*part)))
    edge = (F.col("no") == 1) | (F.col("no") == F.col("last_no"))
    inner = local.where(~edge).select(*keys, "start", "end", "changes")
    across = W.partitionBy(*keys).orderBy("start")
    since = F.unix_micros("start") - F.unix_micros(F.lag("end").over(across))
    merged = (
        local.where(edge)
        .withColumn("opens", F.coalesce(since > gap, F.lit(True)).cast("int"))
        .withColumn("session", F.sum("opens").over(across.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy(*keys, "session")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("changes").alias("changes"))
        .select(*keys, "start", "end", "changes")
    )
    return inner.unionByName(merged)


# gated marks

EDGE_ORDER = ["ts", "frame", "face", "site"]


def gate_segments(events: DataFrame, matches: DataFrame, seconds: int | None = None) -> DataFrame:
    """Matches with ``segment``, the number of events at their site in the same frame or before;
    matches ahead of the first event fall out.

    ``events(site, ts, frame)``, ``matches(site, ts, frame, face, user_id)``.
    """
    rows = events.select(
        "site", "ts", "frame", F.lit(-1).alias("face"), F.lit(None).cast("bigint").alias("user_id")
    ).unionByName(matches.select("site", "ts", "frame", F.col("face").cast("int").alias("face"), "user_id"))
    seconds = slice_seconds(rows, ["site"]) if seconds is None else seconds
    opened = running_total(
        rows, ["site"], ["ts", "frame", "face"], (F.col("face") == -1).cast("int"), "segment", seconds
    )
    return opened.where("face >= 0 and segment > 0")


def gated_marks(
    events: DataFrame,
    matches: DataFrame,
    history: DataFrame | None = None,
    seconds: int | None = None,
    component_edges: int = COMPONENT_EDGES,
) -> DataFrame:
    """Marks ``(site, ts, frame, face, user_id, date)``.

    An event opens a site's gate; the first match after it of a user not yet marked that day is
    marked and closes the gate; other matches leave it as it is.

    Each segment between events yields at most one mark, and each user and day at most one, so
    the marks are the matching that taking edges (segment, user-day) in time order gives. An edge
    earliest at both its ends is always part of it: rounds take all such edges at once and
    drop the others at these ends. Where long chains make rounds slow, what is left is split into connected
    components, which do not touch each other: those of up to ``component_edges`` edges are dealt over
    tasks and taken in order, larger ones go on in rounds.
    """
    matches = matches.where("user_id is not null")
    segments = gate_segments(events, matches, seconds).withColumn("date", F.to_date("ts"))
    w = W.partitionBy("site", "segment", "user_id", "date").orderBy("ts", "frame", "face")
    edges = segments.withColumn("__rn__", F.row_number().over(w)).where("__rn__ = 1").drop("__rn__")
    if history is not None:
        edges = edges.join(history.select("user_id", "date"), ["user_id", "date"], "left_anti")
    return match_in_order(edges, ["site", "segment"], ["user_id", "date"], EDGE_ORDER, component_edges).select(
        "site", "ts", "frame", "face", "user_id", "date"
    )


def match_in_order(
    edges: DataFrame, left: Sequence[str], right: Sequence[str], order: Sequence[str], component_edges: int = COMPONENT_EDGES
) -> DataFrame:
    """Edges taken when going through them in ``order``, each needing both ends free; a pair of ends is one edge.

    Each round writes its result to the shared folder, so a lost executor costs one round.
    """
    spark, left, right = edges.sparkSession, list(left), list(right)
    names = edges.columns
    rest = materialise(edges, "edges")
    taken = rest.limit(0)
    n, least = rest.count(), ROUNDS
    while n:
        # labels are dearer than rounds, so there are twice as many rounds before each further split
        done, slow = 0, False
        while n and not (slow and done >= least):
            won, rest = _earliest_at_both_ends(rest, left, right, order)
            taken = taken.unionByName(won)
            before, n, done = n, rest.count(), done + 1
            slow = n > SHRINK * before
        if not n:
            break
        least *= 2
        parted = _with_component(rest, left, right)
        # one row per component, salted first: a component may hold most of the edges
        sizes = parted.groupBy("__comp__", F.pmod("__l__", F.lit(32)).alias("salt")).agg(F.count("*").alias("n"))
        sizes = materialise(sizes.groupBy("__comp__").agg(F.sum("n").alias("n")), "components")
        is_large = F.col("n") > component_edges
        n_small, n_large = sizes.agg(F.sum(F.when(~is_large, F.col("n"))), F.count_if(is_large)).first()
        large = sizes.where(is_large)
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(n_small or 0) // component_edges))
        small = parted.join(large, "__comp__", "left_anti") if n_large else parted
        small = small.withColumn("__task__", F.pmod(F.xxhash64("__comp__"), F.lit(tasks)))
        taken = taken.unionByName(materialise(_take_in_order(small, left, right, order, names), "taken"))
        if not n_large:
            break
        rest = materialise(parted.join(large, "__comp__", "left_semi").select(*names), "edges")
        n = rest.count()
    return taken


def _earliest_at_both_ends(
    edges: DataFrame, left: list[str], right: list[str], order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """``(edges taken, edges whose ends are both still free)``."""
    rank = F.struct(*order)
    first_left = edges.groupBy(*left).agg(F.min(rank).alias("fl"))
    first_right = edges.groupBy(*right).agg(F.min(rank).alias("fr"))
    marked = edges.join(first_left, left).join(first_right, right)
    won = materialise(marked.where((rank == F.col("fl")) & (rank == F.col("fr"))).select(*edges.columns), "taken")
    rest = edges.join(won.select(*left), left, "left_anti").join(won.select(*right), right, "left_anti")
    return won, materialise(rest, "edges")


def _with_component(edges: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """``edges`` with ``__l__``, the hash of the left end, and ``__comp__``, the smallest such hash that is connected.

    Ends are told apart by hashes; two ends of one hash join their components, which does no harm. Each round passes the
    smallest label over right ends and goes on to the label found there, so that long chains shorten by half.
    """
    rows = edges.withColumn("__l__", F.xxhash64(*left)).withColumn("__r__", F.xxhash64(*right))
    links = materialise(rows.select("__l__", "__r__"), "links")
    labels = links.groupBy("__l__").agg(F.first("__l__").alias("__comp__"))
    while True:
        over = links.join(labels, "__l__").groupBy("__r__").agg(F.min("__comp__").alias("low"))
        near = links.join(over, "__r__").groupBy("__l__").agg(F.min("low").alias("low"))
        jumps = near.select(F.col("__l__").alias("low"), F.col("low").alias("jump"))
        step = labels.join(near, "__l__").join(jumps, "low")
        new = materialise(step.select("__l__", F.col("jump").alias("__comp__"), F.col("__comp__").alias("was")), "labels")
        labels = new.select("__l__", "__comp__")
        if new.where("__comp__ <> was").isEmpty():
            return rows.join(labels, "__l__")


def _take_in_order(parted: DataFrame, left: list[str], right: list[str], order: Sequence[str], names: list[str]) -> DataFrame:
    """Edges taken in order within each ``__task__``, which holds whole components of a checked size."""
    order = list(order)

    def take(pdf):
        used_left, used_right, keep = set(), set(), []
        pdf = pdf.sort_values(order)
        for l, r in zip(pdf[left].itertuples(index=False, name=None), pdf[right].itertuples(index=False, name=None)):
            free = l not in used_left and r not in used_right
            keep.append(free)
            if free:
                used_left.add(l)
                used_right.add(r)
        return pdf.loc[keep, names]

    return parted.groupBy("__task__").applyInPandas(take, parted.select(*names).schema)
