"""Joins with special shapes: spelling lookups, date windows, as-of dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

# No broadcast hints for lookups: they are small as a rule but nothing bounds them. They are
# written down instead, so that their measured size decides, and so that a name shared by a third
# of all rows can be split (adaptive execution only splits joins of two plain shuffles).


def spelling_lookup(df: DataFrame, canonical: str, variant: str, line: str) -> DataFrame:
    """(variant, canonical) with one row per variant; the row of the highest ``line`` wins."""
    rows = df.select(
        F.col(variant).alias("variant"), F.col(canonical).alias("canonical"), F.col(line).alias("line")
    )
    rows = rows.filter(F.col("variant").isNotNull()).groupBy("variant")
    return durable(rows.agg(F.max_by("canonical", "line").alias("canonical")), "spellings")


def replace_by_lookup(df: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
    """Replace whole values of ``column`` found in ``lookup``; replaced values are not looked up again."""
    found = lookup.select(F.col("variant").alias(column), F.col("canonical").alias("_canonical"))
    found = found.withColumn("_hit", F.lit(True))
    value = F.when(F.col("_hit"), F.col("_canonical")).otherwise(F.col(column))
    return df.join(found, column, "left").withColumn(column, value).drop("_canonical", "_hit")


def flag_members(df: DataFrame, column: str, members: DataFrame, member: str, out: str) -> DataFrame:
    """True where ``column`` is listed in ``members``."""
    listed = durable(members.select(F.col(member).alias(column)).distinct(), "members")
    listed = listed.withColumn(out, F.lit(True))
    return df.join(listed, column, "left").withColumn(out, F.coalesce(out, F.lit(False)))


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    *,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
) -> DataFrame:
    """Rows of ``points`` with ``start <= at < end`` and equal ``keys``.

    Each interval is listed once per calendar month it touches, which turns the range condition
    into an equi join on (keys, month) with the exact condition on top: no nested loop, and a
    series that owns most races is spread over its months.
    """
    months = F.sequence(
        F.trunc(start, "MM"), F.trunc(F.date_sub(end, 1), "MM"), F.expr("interval 1 month")
    )
    listed = intervals.filter(F.col(start) < F.col(end)).withColumn("_month", F.explode(months))
    dated = points.filter(F.col(at).isNotNull()).withColumn("_month", F.trunc(at, "MM"))
    return (
        dated.join(listed, [*keys, "_month"])
        .filter((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end)))
        .drop("_month")
    )


def latest_on_or_before(dates: DataFrame, at: str, marks: DataFrame, mark: str) -> DataFrame:
    """For each distinct date ``at``: the latest ``mark`` not after it (NULL when none).

    Both sides are reduced to distinct calendar dates first. Their number is bounded by the
    calendar (a few hundred per year), so the ordered pass over them is small however many rows
    carry them, and the result may be broadcast.
    """
    asked = dates.filter(F.col(at).isNotNull()).select(F.col(at).alias("_d")).distinct()
    given = marks.filter(F.col(mark).isNotNull()).select(F.col(mark).alias("_d")).distinct()
    line = asked.select("_d", F.lit(None).cast("date").alias("_m"), F.lit(True).alias("_asked"))
    line = line.unionByName(given.select("_d", F.col("_d").alias("_m"), F.lit(False).alias("_asked")))
    upto = Window.orderBy("_d").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        line.withColumn("_latest", F.max("_m").over(upto))
        .filter("_asked")
        .select(F.col("_d").alias(at), F.col("_latest").alias(mark))
    )
