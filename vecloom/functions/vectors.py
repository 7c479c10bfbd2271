"""Vector expressions over ARRAY<FLOAT> columns, accumulated in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return _sum(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")))


def squared_l2(a: Column | str, b: Column | str) -> Column:
    return _sum(F.zip_with(_col(a), _col(b), lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))))


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(_col(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Null, not NaN, when a side is the zero vector: NaN would pass every threshold."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def l2_normalize(a: Column | str) -> Column:
    """Unit-length copy; a zero vector stays zero.

    The norm is bound as a one-element array so it is computed once per row, not per element.
    """
    a = _col(a)

    def scaled(n: Column) -> Column:
        unit = F.transform(a, lambda x: x.cast("double") / n)
        return F.when(n > 0, unit).otherwise(F.transform(a, lambda x: x.cast("double")))

    return F.element_at(F.transform(F.array(norm(a)), scaled), 1)


def mean_vector(c: str, dim: int) -> Column:
    """Element-wise mean as an aggregate with map-side partials, one accumulator per axis."""
    return F.array(*[F.avg(F.get(F.col(c), F.lit(i)).cast("double")) for i in range(dim)])


def aspect_ratio(points: Column | str) -> Column:
    """Opening ratio of six outline points: mean of two heights over the width.

    Points are (x, y) structs ordered corner, upper pair, corner, lower pair. Null when the
    width is zero or a point is missing.
    """
    p = _col(points)

    def dist(i: int, j: int) -> Column:
        a, b = F.get(p, F.lit(i)), F.get(p, F.lit(j))
        return F.sqrt(F.pow(a["x"] - b["x"], F.lit(2.0)) + F.pow(a["y"] - b["y"], F.lit(2.0)))

    return F.try_divide(dist(1, 5) + dist(2, 4), F.lit(2.0) * dist(0, 3))
