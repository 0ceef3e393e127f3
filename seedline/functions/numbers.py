"""Numeric expressions: race times, rounding, points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, to_number


def minutes_from_text(c: Column) -> Column:
    """``h:m:s``, ``m:s`` or ``s`` (fractions allowed) to minutes; anything else to NULL."""
    parts = F.split(F.replace(strip(c), F.lit("'"), F.lit("")), ":")
    count = F.size(parts)
    seconds, minutes, hours = (to_number(F.try_element_at(parts, F.lit(-i))) for i in (1, 2, 3))
    return F.when(
        count <= 3,
        seconds * F.lit(1.0 / 60)
        + F.when(count >= 2, minutes).otherwise(F.lit(0.0))
        + F.when(count >= 3, hours).otherwise(F.lit(0.0)) * 60,
    )


def minutes_to_text(c: Column) -> Column:
    """``MM:SS.ss``; no time is the empty text.

    The seconds are rounded from their exact binary value, halves to even, in whole numbers:
    ``format_string`` rounds the shortest decimal text instead, which differs next to a half.
    """
    whole = c.cast("bigint")
    seconds = (c - whole) * 60
    fraction = seconds - F.floor(seconds)
    scaled = (fraction * F.lit(2.0**56)).cast("bigint") * 100
    down = F.shiftright(scaled, 56)
    rest = scaled.bitwiseAND(F.lit(2**56 - 1))
    half = F.lit(2**55)
    up = (rest > half) | ((rest == half) & (down % 2 == 1))
    hundredths = F.floor(seconds) * 100 + down + up.cast("bigint")
    text = F.format_string("%02d:%02d.%02d", whole, F.floor(hundredths / 100), hundredths % 100)
    return F.when(c.isNotNull(), text).otherwise(F.lit(""))


def round2(c: Column) -> Column:
    """Two decimals, rounding the scaled binary value (``round(x, 2)`` goes through decimal text)."""
    return F.round(c * 100) / 100


def positive_ln(c: Column) -> Column:
    return F.when(c > 0, F.ln(c))


def mean_ln(c: Column) -> Column:
    """Aggregate: the log of the geometric mean of the positive values."""
    return F.avg(positive_ln(c))


def compensated_sum(values: list[Column]) -> Column:
    """Kahan sum of a fixed list of columns in this order, NULLs left out; NULL when all are.

    A mean of two-decimal points often lies on half a cent, where the last bit of the sum decides
    the rounding. Published points come from a compensated sum in slot order, so that is the rule.
    """
    zero = F.lit(0.0)
    start = F.struct(zero.alias("total"), zero.alias("error"))

    def add(state: Column, value: Column) -> Column:
        corrected = value - state["error"]
        total = state["total"] + corrected
        return F.struct(total.alias("total"), (total - state["total"] - corrected).alias("error"))

    total = F.aggregate(F.array_compact(F.array(*values)), start, add, lambda state: state["total"])
    return F.when(F.coalesce(*values).isNotNull(), total)


def race_points(penalty: Column, ratio: Column, compression: Column) -> Column:
    return round2(penalty * F.pow(ratio, compression))
