"""Ranks, running numbers and group statistics that survive a hot group.

A window puts a whole group into one task. That is the cheapest plan while every group is
small, so the operators take it when the largest group has been counted and fits
``seedline.rowsPerTask``. Otherwise they take the distributed route (``spread=True``), where
no task holds more of a group than its slice:

* statistics: ``groupBy`` with partial aggregation, written down and joined back. Adaptive
  execution splits a hot key only when both sides of the join come straight from a shuffle, which
  a grouped side does not; a table does, and its measured size may even allow a broadcast;
* ranks and row numbers: range-partitioned slices with a carried count (``prefix_sums``).

Both routes give the same answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable, rows_per_task


DEALT_ROWS = 100_000  # of wide rows that several windows hold at once


def group_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows in the biggest group and in all. Partial aggregation; two numbers reach the driver."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    most, total = sizes.agg(F.max("n"), F.sum("n")).first()
    return most or 0, total or 0


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    return group_sizes(df, keys)[0]


def is_hot(df: DataFrame, keys: Sequence[str]) -> bool:
    return largest_group(df, keys) > rows_per_task(df.sparkSession)


def dealt(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt by ``keys`` to as many tasks as give each about ``DEALT_ROWS``, at least one for each core.

    What the windows of a task hold then does not grow with the table, but for a group that is larger than that by itself."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // DEALT_ROWS))
    return df.repartition(tasks, *keys)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` treating NULL as a value, keeping the left key columns."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    on = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def with_group_stats(
    df: DataFrame, keys: Sequence[str], stats: dict[str, Column], *, spread: bool = False
) -> DataFrame:
    """Add aggregates of the row's group as columns."""
    if not spread:
        window = Window.partitionBy(*keys)
        return df.withColumns({name: agg.over(window) for name, agg in stats.items()})
    totals = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in stats.items()])
    return null_safe_join(df, durable(totals, "totals"), keys)


def prefix_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str, out: str
) -> DataFrame:
    """Sum of ``weight`` over the rows before this one in its group; ``order`` must be unique.

    Rows are range-partitioned on (keys, order), so a hot group lies across many slices. The
    slices are written down once, because their bounds are sampled and both branches below
    have to see the same ones.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = durable(
        df.repartitionByRange(slices, *keys, *order).withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    before = Window.partitionBy(*keys, "_slice").orderBy(*order)
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    inside = cut.withColumn(out, F.coalesce(F.sum(weight).over(before), F.lit(0)))

    totals = cut.groupBy(*keys, "_slice").agg(F.sum(weight).alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_slice")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        totals.withColumn("_carried", F.sum("_total").over(earlier))
        .filter("_carried IS NOT NULL")
        .drop("_total")
    )
    # Each bound between two slices lies in at most one group: fewer than `slices` rows.
    joined = null_safe_join(inside, F.broadcast(carried), [*keys, "_slice"])
    total = F.col(out) + F.coalesce("_carried", F.lit(0))
    return joined.withColumn(out, total).drop("_slice", "_carried")


def with_rank(
    df: DataFrame, keys: Sequence[str], by: str, out: str, *, spread: bool = False
) -> DataFrame:
    """Minimum rank of ``by`` in its group, NULL where ``by`` is NULL (NULLs rank last)."""
    if not spread:
        window = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(by))
        return df.withColumn(out, F.when(F.col(by).isNotNull(), F.rank().over(window)).cast("bigint"))
    # Ties collapse before anything is sorted, so a value shared by most rows costs one row.
    values = df.filter(F.col(by).isNotNull()).groupBy(*keys, by).agg(F.count(F.lit(1)).alias("_n"))
    ranks = prefix_sums(values, keys, [by], "_n", out).drop("_n")
    ranks = ranks.withColumn(out, F.col(out) + 1)
    return null_safe_join(df, ranks, [*keys, by])


def with_row_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, *, spread: bool = False
) -> DataFrame:
    """Running number in the group; the last column of ``order`` breaks ties and is unique."""
    if not spread:
        window = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_last(c) for c in order])
        return df.withColumn(out, F.row_number().over(window).cast("bigint"))
    first = order[0]
    flagged = df.withColumns({"_one": F.lit(1), "_null": F.col(first).isNull().cast("int")})
    numbered = prefix_sums(flagged, [*keys], ["_null", *order], "_one", out)
    return numbered.withColumn(out, F.col(out) + 1).drop("_one", "_null")


def robust_means(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    percentiles: tuple[float, float],
    *,
    spread: bool | None = None,
) -> DataFrame:
    """Per group: mean of the values inside the two (interpolated, inclusive) percentiles."""
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    if spread is None:
        spread = is_hot(rows, keys)
    if spread:
        # one row per distinct value with its count, so that equal values cannot pile up
        rows = rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
        rows = prefix_sums(rows, keys, ["_v"], "_n", "_first")
    else:
        window = Window.partitionBy(*keys).orderBy("_v")
        rows = rows.withColumns({"_n": F.lit(1), "_first": F.row_number().over(window) - 1})
    rows = with_group_stats(rows, keys, {"_size": F.sum("_n")}, spread=spread)

    bounds = {}
    for side, p in zip(("_lo", "_hi"), percentiles):
        place = (F.col("_size") - 1) * F.lit(p)
        for edge, at in (("a", F.floor(place)), ("b", F.ceil(place))):
            holds = (F.col("_first") <= at) & (at < F.col("_first") + F.col("_n"))
            bounds[side + edge] = F.max(F.when(holds, F.col("_v")))
    rows = with_group_stats(rows, keys, bounds, spread=spread)

    limits = []
    for side, p in zip(("_lo", "_hi"), percentiles):
        place = (F.col("_size") - 1) * F.lit(p)
        t = place - F.floor(place)
        a, b = F.col(side + "a"), F.col(side + "b")
        limits.append(F.when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (1 - t)))
    inner = rows.filter(F.col("_v").between(*limits))
    mean = F.sum(F.col("_v") * F.col("_n")) / F.sum("_n")
    # one row per group, written down so that joining it back needs no shuffle of the rows
    return durable(inner.groupBy(*keys).agg(mean.alias(out)), "robust-means")
