"""Both routes of every group operator give the same answer, hot groups and ties included."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seedline.operators import groups
from seedline.session import durable


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 600
    grp = rng.choice(["hot", "warm", "cold", None], n, p=[0.6, 0.2, 0.1, 0.1])
    value = rng.integers(0, 40, n) / 4.0
    value[rng.random(n) < 0.4] = 5.0  # one value shared by many rows
    pdf = pd.DataFrame({"grp": grp, "id": [f"i{i:04d}" for i in range(n)], "v": value})
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.col("id").endswith("7"), F.col("v")))
    return df.cache()


def collected(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_rank(rows):
    a, b = (groups.with_rank(rows, ["grp"], "v", "r", spread=s) for s in (False, True))
    assert collected(a, "id", "r") == collected(b, "id", "r")
    pdf = rows.toPandas()
    want = pdf.groupby("grp", dropna=False)["v"].rank(method="min")
    got = dict(collected(b, "id", "r"))
    assert all((pd.isna(w) and got[i] is None) or got[i] == w for i, w in zip(pdf["id"], want))


def test_row_number(rows):
    a, b = (groups.with_row_number(rows, ["grp"], ["v", "id"], "r", spread=s) for s in (False, True))
    assert collected(a, "id", "r") == collected(b, "id", "r")
    assert b.count() == rows.count()


def test_group_stats(rows):
    stats = {"n": F.count("v"), "m": F.max("v")}
    a, b = (groups.with_group_stats(rows, ["grp"], stats, spread=s) for s in (False, True))
    assert collected(a, "id", "n", "m") == collected(b, "id", "n", "m")


@pytest.mark.parametrize("spread", [False, True])
def test_robust_mean(rows, spread):
    got = dict(groups.robust_means(rows, ["grp"], "v", "m", (0.25, 0.75), spread=spread).collect())
    for grp, part in rows.toPandas().groupby("grp"):
        v = part["v"].dropna().to_numpy()
        lo, hi = np.quantile(v, [0.25, 0.75])
        assert abs(got[grp] - v[(v >= lo) & (v <= hi)].mean()) < 1e-9


def test_hot_group_is_cut_into_slices(spark, rows):
    """No task of the ordered pass sees more of the hot group than its slice."""
    numbered = rows.withColumn("one", F.lit(1)).filter("v IS NOT NULL AND grp = 'hot'")
    summed = groups.prefix_sums(numbered, ["grp"], ["v", "id"], "one", "before")
    assert sorted(r[0] for r in summed.select("before").collect()) == list(range(numbered.count()))


def test_budget_decides(spark, rows, tiny_tasks):
    assert groups.is_hot(rows, ["grp"])
    spark.conf.set("seedline.rowsPerTask", "100000")
    assert not groups.is_hot(rows, ["grp"])


def test_skewed_join_is_split(spark):
    """A join key that holds most rows is split by adaptive execution, without losing rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(40000).select(
            F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("race_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        ).repartition(8)
        right = durable(left.select("race_id").distinct().withColumn("series", F.lit("s")), "series")
        joined = left.join(right, "race_id", "left")
        assert joined.count() == 40000
        out = joined.groupBy("series").agg(F.max("payload"))
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
