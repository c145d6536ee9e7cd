"""Column expressions shared by every operator. All stay on the JVM side."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_PI = 2.0 * math.pi


def clip(x: Column, low=None, high=None) -> Column:
    if low is not None:
        x = F.greatest(x, F.lit(low))
    if high is not None:
        x = F.least(x, F.lit(high))
    return x


def logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def settle(x: Column, digits: int = 6) -> Column:
    """Round a measure; the nudge, far below the last digit, sends half-way cases up on every engine."""
    return F.round(x + F.lit(1e-9), digits)


def ratio(num: Column, den: Column) -> Column:
    """Division that yields NULL on a zero denominator (ANSI mode would raise)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def padded(key: Column, width: int) -> Column:
    """Zero-padded number; longer numbers keep all their digits (lpad alone would cut them)."""
    text = key.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def entity_id(node_type: str, key: Column) -> Column:
    """Four-letter upper-case type prefix and the zero-padded key; NULL for a NULL key."""
    return F.concat(F.lit(node_type[:4].upper() + "_"), padded(key, 8))


def entity_code(node_id: Column) -> Column:
    """A whole number for every id that `entity_id` makes, another one for each; NULL for other texts and numbers over 13 digits."""
    letters = F.lit(0)
    for i in range(1, 5):
        letters = letters * 26 + (F.ascii(F.substring(node_id, i, 1)) - 65)
    made = node_id.rlike("^[A-Z]{4}_([0-9]{8}|[1-9][0-9]{8,12})$")
    return F.when(made, letters.cast("bigint") * F.lit(10 ** 13) + F.substring(node_id, 6, 13).cast("bigint"))


def brand_number(brand: Column) -> Column:
    return F.regexp_replace(brand, "Brand#", "").cast("bigint")


def stable_hash(*parts, salt: str = "") -> Column:
    """32-bit number from md5: the same on every engine, run and partitioning."""
    text = F.concat_ws("|", F.lit(salt), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def days_from_turnover(turnover: Column) -> Column:
    return F.lit(365.0) / F.greatest(turnover, F.lit(0.1))


def fourier(day: Column, period: float, harmonic: int) -> tuple[Column, Column]:
    angle = F.lit(TWO_PI * harmonic / period) * day
    return F.sin(angle), F.cos(angle)


def lookup(key: Column, mapping: dict, default=None) -> Column:
    """Constant-map lookup as a CASE expression (a handful of keys)."""
    items = list(mapping.items())
    expr = F.when(key == F.lit(items[0][0]), F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(key == F.lit(k), F.lit(v))
    return expr if default is None else expr.otherwise(F.lit(default))
