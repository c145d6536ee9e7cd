"""Vector expressions over ARRAY<DOUBLE|FLOAT> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(v: Column, term) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + term(x.cast("double")))


def vector_mean(v: Column) -> Column:
    return F.try_divide(_total(v, lambda x: x), F.size(v).cast("double"))


def vector_norm(v: Column) -> Column:
    return F.sqrt(_total(v, lambda x: x * x))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def scaled_dot(a: Column, b: Column) -> Column:
    return dot(a, b) / F.sqrt(F.size(a).cast("double"))


def argmax(v: Column) -> Column:
    """Zero-based position of the first largest element."""
    return F.array_position(v, F.array_max(v)) - F.lit(1)


def one_hot(position: Column, size: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: (i == position).cast("double"))


def bounds_position(bounds: Column, x: Column, size: int) -> Column:
    """How many of the ascending `bounds` lie strictly below `x`: a binary search of log2(size) steps."""
    steps, step = [], 1
    while step <= size:
        steps.append(step)
        step *= 2
    ladder = F.array(*[F.lit(s) for s in reversed(steps)])
    return F.aggregate(
        ladder,
        F.lit(0),
        lambda pos, s: F.when(F.get(bounds, pos + s - F.lit(1)) < x, pos + s).otherwise(pos),
    )
