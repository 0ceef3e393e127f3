"""Row order of the published tables. Sorting happens here, at the sink, and nowhere earlier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable

# The last column of each order is ours: many rows share the published order (a season and gender
# may be a third of the standings), and sorting by range could not spread them otherwise.
ORDERS = {
    "dim_registrations": ["athlete_name", "-race_season", "registration_id"],
    "dim_athletes": ["athlete_name", "gender", "athlete_id"],
    "ext_races_by_penalty_window": [
        "-penalty_list_season",
        "penalty_list_date",
        "series",
        "race_date",
        "race_id",
    ],
    "ext_results_by_penalty_window": ["race_date", "race_id", "gender", "athlete_id", "penalty_list_date"],
    "ext_athlete_penalties": [
        "penalty_list_season",
        "penalty_list_date",
        "gender",
        "standardized_athlete_penalty_26",
        "athlete_id",
    ],
    "ext_results": ["race_date", "race_id", "gender", "time_float", "result_id"],
    "ext_points_contributing_results": [
        "athlete_name",
        "race_season",
        "technique",
        "description",
        "registration_id",
    ],
    "ext_registrations": ["race_season", "gender", "registration_id"],
    "infra_result_files": ["race_id", "-modified_at", "file_id"],
    "result_file_inventory": ["sheet_name", "-modified_at", "source_file_id"],
}


def sort_output(df: DataFrame, table: str) -> DataFrame:
    """Order ``df`` as the table is published; a leading ``-`` means descending. NULLs come last."""
    order = [
        F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc_nulls_last(c) for c in ORDERS[table]
    ]
    return df.orderBy(*order)


def with_positions(df: DataFrame, table: str, name: str = "position") -> DataFrame:
    """``df`` with each row's place in the published order, from 1, under a ``name`` that ``df`` does not have.

    Sorted by range and written down, so that the slices stand still; a row's place is its number in its slice
    and the rows of the slices before. Only one count per slice comes to the driver. Rows that agree
    in the whole order take neighbouring places in any order. An empty table stays empty.
    """
    if name in df.columns:
        raise ValueError(f"the table has a column {name} already")
    slice_bits = 33  # monotonically_increasing_id: the slice above, the row's number in it below
    row = f"{name}_"
    while row in df.columns:
        row += "_"
    numbered = durable(sort_output(df, table).withColumn(row, F.monotonically_increasing_id()), f"sorted-{table}")
    of_slice = F.shiftright(row, slice_bits)
    counts = numbered.groupBy(of_slice.alias("slice")).agg(F.count(F.lit(1)).alias("n")).collect()
    starts, before = [], 0
    for slice_, n in sorted((r["slice"], r["n"]) for r in counts):
        starts.append((slice_, before))
        before += n
    if not starts:
        return numbered.withColumnRenamed(row, name)
    start = F.element_at(F.create_map(*[F.lit(v).cast("bigint") for pair in starts for v in pair]), of_slice)
    place = start + F.col(row) - F.shiftleft(of_slice, slice_bits) + 1
    return numbered.withColumn(name, place).drop(row)
