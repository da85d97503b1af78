"""Column expressions over embedding arrays, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def same_size(a: Column, b: Column) -> Column:
    """True, or an error that names the sizes."""
    text = F.concat(F.lit("vectors of different sizes: "), F.size(a).cast("string"), F.lit(", "), F.size(b).cast("string"))
    return F.when(F.size(a) == F.size(b), F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 if a norm is 0, an error if sizes differ."""
    scale = norm(a) * norm(b)
    return F.when(same_size(a, b), F.when(scale == 0, F.lit(0.0)).otherwise(dot(a, b) / scale))


def squared_l2(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x
    )


def normalized(a: Column) -> Column:
    """The vector at length 1; a zero vector stays."""
    size = norm(a)
    return F.when(size == 0, F.transform(a, lambda x: x.cast("double"))).otherwise(F.transform(a, lambda x: x.cast("double") / size))


def rounded(x: Column, digits: int = 6) -> Column:
    """Rounded by scaling, half away from zero; unlike ``round`` a negative number that rounds to zero keeps its sign, as -0.0."""
    out = F.round(x * F.lit(10.0**digits)) / F.lit(10.0**digits)
    return F.when(out == 0, x * F.lit(0.0)).otherwise(out)
