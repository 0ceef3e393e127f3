"""Hand-kept tables: one folder per worksheet, typed by a companion schema."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# names used by schema tables, next to Spark's own type names
TYPE_NAMES = {
    "string": "string",
    "object": "string",
    "Int64": "bigint",
    "int64": "bigint",
    "float64": "double",
    "Float64": "double",
    "boolean": "boolean",
    "bool": "boolean",
    "datetime64[ns]": "timestamp",
}


def scan_prep_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One worksheet. With a schema nothing is inferred; without one Spark infers the types."""
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True, escape='"')
    return spark.read.csv(path, header=True, schema=schema, escape='"')


def scan_seasons(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """All worksheets of a book stored as ``race_season=YYYY`` folders; the folder is a column.

    Readers that filter on race_season only open the folders they need.
    """
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    whole = T.StructType([*fields.fields, T.StructField("race_season", T.LongType())])
    return spark.read.csv(root, header=True, schema=whole, escape='"')


def schema_table(df: DataFrame) -> DataFrame:
    """Name, type and description of each column, the companion of a stored table."""
    rows = [(f.name, f.dataType.simpleString(), (f.metadata or {}).get("comment", "")) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "name string, dtype string, description string")


def write_prep_table(df: DataFrame, path: str, schema_path: str) -> None:
    """Store a table as text, next to a companion table that names its types and describes its columns."""
    df.write.csv(path, header=True, escape='"')
    schema_table(df).write.csv(schema_path, header=True, escape='"')


def read_prep_table(spark: SparkSession, path: str, schema_path: str) -> DataFrame:
    """A table stored as text, typed by its companion; descriptions become column comments.

    The companion has one row per column, so it may come to the driver. Columns it does not name stay text.
    """
    rows = scan_prep_table(spark, schema_path, "name string, dtype string, description string").collect()
    text = spark.read.csv(path, header=True, escape='"')
    typed = apply_schema(text, {r["name"]: r["dtype"] for r in rows if r["dtype"]})
    return with_descriptions(typed, {r["name"]: r["description"] for r in rows if r["description"] and r["name"] in typed.columns})


def with_descriptions(df: DataFrame, descriptions: dict[str, str]) -> DataFrame:
    """Attach column comments; they are stored with the table."""
    for name, text in descriptions.items():
        df = df.withMetadata(name, {"comment": text})
    return df


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty text means missing."""
    columns = [
        F.nullif(F.col(f"`{f.name}`"), F.lit("")).alias(f.name)
        if isinstance(f.dataType, T.StringType)
        else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    return df.select(*columns)


def _converted(name: str, dtype: str) -> Column:
    value = F.col(f"`{name}`")
    if dtype in ("bigint", "int", "smallint"):
        number = value.try_cast("double")
        return F.when(number == F.floor(number), F.coalesce(value.try_cast(dtype), number.try_cast(dtype)))
    return value.try_cast(dtype)


def apply_schema(df: DataFrame, dtypes: dict[str, str]) -> DataFrame:
    """Cast text columns to their stored types.

    Rows and columns without any value are dropped, absent columns are skipped, and a column with
    a value that does not convert stays as it is, with a warning. One aggregate finds out all that.
    A column whose type name is unknown stays as it is too, with a warning.
    """
    df = blank_to_null(df).dropna("all")
    given = {n: t for n, t in dtypes.items() if n in df.columns}
    for name in [n for n, t in given.items() if t not in TYPE_NAMES and t not in TYPE_NAMES.values()]:
        warnings.warn(f"column {name!r} has the unknown type {given.pop(name)!r}, left as it is", stacklevel=2)
    wanted = {n: TYPE_NAMES.get(t, t) for n, t in given.items()}
    known = [F.count(F.col(f"`{c}`")).alias(f"known_{i}") for i, c in enumerate(df.columns)]
    failed = [
        F.count(F.when(F.col(f"`{c}`").isNotNull() & _converted(c, wanted[c]).isNull(), 1)).alias(f"failed_{i}")
        for i, c in enumerate(df.columns)
        if c in wanted
    ]
    facts = df.agg(*known, *failed).first().asDict()
    columns = []
    for i, name in enumerate(df.columns):
        if not facts[f"known_{i}"]:
            continue
        column = F.col(f"`{name}`")
        if name in wanted:
            if facts[f"failed_{i}"]:
                warnings.warn(f"column {name!r} does not convert to {wanted[name]}, left as it is", stacklevel=2)
            else:
                column = _converted(name, wanted[name]).alias(name)
        columns.append(column)
    return df.select(*columns)
