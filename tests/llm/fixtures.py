"""Small tables with the cases every operator has to survive, and plain brute-force versions."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Columns whose names clash with names that the operators use themselves.
CLASHING = ("digest", "salt", "_salt", "label", "node", "rep", "rid", "weight", "score", "kind", "bucket", "a.b")


def words(rng: random.Random, n: int, vocabulary: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary):x}q" for _ in range(n))


def texts(seed: int = 1) -> list[str | None]:
    """Plain texts, exact and near copies, shared passages, blanks, nulls, accents, one very long text."""
    rng = random.Random(seed)
    base = [words(rng, rng.choice([1, 2, 3, 8, 40, 120])) for _ in range(40)]
    out: list[str | None] = list(base)
    out += base[:6] + [base[7]] * 9
    for t in base[20:30]:  # near copies
        w = t.split()
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    passage = words(rng, 30)
    out += [f"{words(rng, 20)} {passage} {words(rng, 20)}" for _ in range(6)]
    out += [None, None, "", " \t\n ", "é" * 80, "日本語 " * 30, "a" * 300, "a" * 301, "A  b\nC", "a b c", "a b\tc "]
    out.append(words(rng, 60_000))
    out.append(out[-1] + " tail")
    return out


def documents(spark, rows=None, extra: bool = True):
    if rows is None:
        rows = [(k, t, ["en", "fr", None][k % 3], ["x", "y", None][k % 7 % 3], None) for k, t in enumerate(texts())]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in CLASHING:
            df = df.withColumn(name, df["n_chars"])
    return df


def empty(spark):
    return documents(spark, [])
