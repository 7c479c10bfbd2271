"""Mixing sources to target weights (8): iterative proportional fitting of token weights.

Documents are counted into cells (source, language, topic) by tokens. The cells' weights are raked: for one margin after
the other they are scaled to that margin's target, and no cell may exceed the tokens that it has, so
that nothing is repeated. Weight over tokens is the probability with which each document of a cell is drawn; the
draw is a hash of id and seed, so that a rerun draws the same documents.

Only the cell table (as many rows as there are source, language and topic combinations) goes through the
iterations, as window sums over its margins; documents are read once for their counts. Documents get their cell's
probability by a join on cell and salt, so that a cell of a third of all rows is dealt over many tasks.

Defined results: a null source, language or topic is a value of its own; a null or blank text has no tokens and
its document is drawn with its cell's probability (1 where a cell has no tokens); a null id is hashed as
the empty text; repeated rows share their fate; an empty table gives an empty result; other columns are kept or
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.registry import table
from .frames import SALTS, salt, stored
from .registry import query

MARGINS = ("source", "lang", "topic")
#: Target shares are the observed shares to this power, scaled to one: 1 keeps the mixture, 0 makes all equal.
TEMPER = 0.5
#: Tokens to draw, as a share of all tokens.
BUDGET = 0.5
ROUNDS = 8
SEED = "mix"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic by surface marks; any other column can be given instead."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(F.lower(t).contains("license"), "legal")
        .when(t.contains("@"), "contact")
        .when(t.contains("%%%") | t.contains("***") | t.contains("###"), "markup")
        .when(F.length(t) < 1000, "short")
        .otherwise("prose")
    )


def draw(id_col: Column, seed: str) -> Column:
    """A number in [0, 1) from 48 bits of an MD5."""
    key = F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def rake(cells: DataFrame, margins=MARGINS, temper: float = TEMPER, budget: float = BUDGET, rounds: int = ROUNDS) -> DataFrame:
    """``cells(*margins, tokens)`` with ``weight``: raked tokens per cell, at most ``tokens``.

    A margin that its cells cannot fill (all at their limit) stays below its target.
    """
    out = cells
    for m in margins:
        seen = cells.groupBy(m).agg(F.sum("tokens").cast("double").alias("_n"))
        shares = seen.select(F.col(m).alias("_m"), "_n", F.pow("_n", F.lit(float(temper))).alias("_p"))
        powers, tokens = shares.agg(F.sum("_p"), F.sum("_n")).first()  # two numbers
        goal = F.col("_p") / F.lit(powers) * F.lit(tokens) * F.lit(float(budget))
        goals = shares.select("_m", goal.alias(f"_goal_{m}"))
        out = out.join(goals, out[m].eqNullSafe(goals["_m"])).drop("_m")
    out = stored(out.withColumn("weight", F.col("tokens") * F.lit(float(budget))), "mix-goals")
    for _ in range(rounds):
        for m in margins:
            now = F.sum("weight").over(Window.partitionBy(m))
            scaled = F.when(now > 0, F.col("weight") * F.col(f"_goal_{m}") / now).otherwise(F.lit(0.0))
            out = out.withColumn("weight", F.least(scaled, F.col("tokens").cast("double")))
    return out.select(*margins, "tokens", "weight")


def counted(docs: DataFrame, topic: Column) -> DataFrame:
    """``doc_id, source, lang, topic, tokens`` of every row; the only pass over the texts."""
    tokens = token_count(F.col("text")).alias("tokens")
    return stored(docs.select("doc_id", "source", "lang", topic.alias("topic"), tokens), "mix-rows")


def cell_probabilities(rows: DataFrame, temper=TEMPER, budget=BUDGET, rounds=ROUNDS) -> DataFrame:
    """``_source, _lang, _topic, _s, prob``: the probability of each cell, once for each salt."""
    parts = rows.withColumn("_salt", salt("doc_id")).groupBy(*MARGINS, "_salt").agg(F.sum("tokens").alias("tokens"))
    cells = stored(parts.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    raked = stored(rake(cells, MARGINS, temper, budget, rounds), "mix-raked")
    prob = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(1.0))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s")
    return raked.select(*[F.col(m).alias(f"_{m}") for m in MARGINS], F.round(prob, 9).alias("prob"), salts)


def mix(docs: DataFrame, topic: Column | None = None, seed: str = SEED, **raking) -> DataFrame:
    """One row per document: ``doc_id, source, lang, topic, tokens, prob, sampled``."""
    rows = counted(docs, topic_of(F.col("text")) if topic is None else topic)
    probs = cell_probabilities(rows, **raking)
    rows = rows.withColumn("_salt", salt("doc_id"))
    on = [rows[m].eqNullSafe(probs[f"_{m}"]) for m in MARGINS] + [rows["_salt"] == probs["_s"]]
    sampled = (draw(F.col("doc_id"), seed) < F.col("prob")).alias("sampled")
    return rows.join(probs, on).select("doc_id", *MARGINS, "tokens", "prob", sampled)


def sample_documents(docs: DataFrame, topic: Column | None = None, seed: str = SEED, **raking) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; documents meet their cell, not their id, again."""
    topic = topic_of(F.col("text")) if topic is None else topic
    probs = cell_probabilities(counted(docs, topic), **raking).withColumnRenamed("prob", "_prob")
    rows = docs.withColumns({"_t": topic, "_salt": salt("doc_id")})
    on = [rows["source"].eqNullSafe(probs["_source"]), rows["lang"].eqNullSafe(probs["_lang"])]
    on += [rows["_t"].eqNullSafe(probs["_topic"]), rows["_salt"] == probs["_s"]]
    return rows.join(probs, on).where(draw(F.col("doc_id"), seed) < F.col("_prob")).select(*[rows[f"`{c}`"] for c in docs.columns])


def _oracle() -> str:
    blanks = "[^ \\t\\n\\x0b\\f\\r]+"
    steps, last = [], "w"
    k = 0
    for _ in range(ROUNDS):
        for m in MARGINS:
            k += 1
            steps.append(
                f"r{k} AS MATERIALIZED (SELECT * REPLACE (least(CASE WHEN sum(weight) OVER (PARTITION BY {m}) > 0 THEN weight * goal_{m} / "
                f"sum(weight) OVER (PARTITION BY {m}) ELSE 0 END, tokens::DOUBLE) AS weight) FROM {last})"
            )
            last = f"r{k}"
    goals = ",\n".join(
        f"g_{m} AS (SELECT {m}, pow(n, {TEMPER}) / sum(pow(n, {TEMPER})) OVER () * sum(n) OVER () * {BUDGET} AS goal_{m} "
        f"FROM (SELECT {m}, sum(tokens)::DOUBLE AS n FROM cells GROUP BY {m}))"
        for m in MARGINS
    )
    joins = " ".join(f"JOIN g_{m} ON cells.{m} IS NOT DISTINCT FROM g_{m}.{m}" for m in MARGINS)
    return f"""
WITH docs AS (
  SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '{blanks}'))::BIGINT AS tokens,
    CASE WHEN lower(coalesce(text, '')) LIKE '%license%' THEN 'legal' WHEN text LIKE '%@%' THEN 'contact'
         WHEN contains(text, '%%%') OR contains(text, '***') OR contains(text, '###') THEN 'markup'
         WHEN length(coalesce(text, '')) < 1000 THEN 'short' ELSE 'prose' END AS topic FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY ALL),
{goals},
w AS (SELECT cells.source, cells.lang, cells.topic, tokens, {', '.join(f'goal_{m}' for m in MARGINS)}, tokens * {BUDGET}::DOUBLE AS weight FROM cells {joins}),
{", ".join(steps)},
p AS (SELECT source, lang, topic, round(CASE WHEN tokens > 0 THEN weight / tokens ELSE 1 END, 9) AS prob FROM {last})
SELECT doc_id, docs.source, docs.lang, docs.topic, tokens, prob,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{SEED}'), 1, 12))::BIGINT / {1 << 48}::DOUBLE < prob AS sampled
FROM docs JOIN p ON docs.source IS NOT DISTINCT FROM p.source AND docs.lang IS NOT DISTINCT FROM p.lang AND docs.topic = p.topic
"""


@query("op8_mix_sources", _oracle())
def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"))
