"""Least-squares fits of many groups at once.

Two models, both with the minimum-norm answer where the data leave a choice:

* race effects: ``y = race + athlete`` with the athletes of a group summing to zero;
* winner differences: ``y = c + athlete - winner`` with the mean athlete tied to ``-c``.

Both are graphs whose rows are differences of two nodes, and both are solved by ``laplacian``: the same elimination,
stopping test and bound on rounds whether a group fits ``seedline.rowsPerTask`` and is solved in one task (all such
groups in parallel, one shuffle) or is larger, where no task ever holds a group. A larger group is eliminated down to its hubs (races, or
winners) slice by slice in one pass where these are few enough for a task, and otherwise solved over DataFrames. No design matrix
is formed on any route.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable, rows_per_task, ship
from .laplacian import most_hubs, solve, solve_by_hubs, solve_in_task

LEVELLED = 1e-16  # share of ones that may be left over where all differences are steps between levels
BROADCAST_GROUPS = 100_000


# --- routing ---------------------------------------------------------------------


def fit_by_size(
    rows: DataFrame,
    keys: list[str],
    hub: str,
    in_task: Callable[[DataFrame], DataFrame],
    by_hubs: Callable[[DataFrame, DataFrame], DataFrame],
    distributed: Callable[[DataFrame, bool], DataFrame],
) -> DataFrame:
    """Send each group to the route that fits its row count and its number of hubs.

    The rows are read once for both. The distributed route is told whether its groups are few enough to broadcast a row for each.
    """
    spark = rows.sparkSession
    limit, most = rows_per_task(spark), most_hubs(spark)
    hubs = durable(rows.groupBy(*keys, F.col(hub).alias("hub")).agg(F.count(F.lit(1)).alias("n")), "hub-sizes")
    sizes = hubs.groupBy(*keys).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("hubs"))
    route = F.when(F.col("n") <= limit, "task").when(F.col("hubs") <= most, "hubs").otherwise("distributed")
    sizes = durable(sizes.select(*keys, route.alias("route")), "routes")
    counts = {r["route"]: r["count"] for r in sizes.groupBy("route").count().collect()}

    def part(name: str) -> DataFrame:
        if len(counts) <= 1:
            return rows
        mine = sizes.where(F.col("route") == name if name != "task" else F.col("route") != name).select(*keys)
        # one row per group above the limit, which are few as a rule; otherwise the measured size decides
        few = sum(n for other, n in counts.items() if other != "task") <= BROADCAST_GROUPS
        return rows.join(F.broadcast(mine) if few else mine, keys, "left_anti" if name == "task" else "left_semi")

    fits = []
    if "task" in counts or not counts:
        fits.append(in_task(part("task")))
    if "hubs" in counts:
        fits.append(by_hubs(part("hubs"), hubs.join(sizes.where("route = 'hubs'").select(*keys), keys, "left_semi")))
    if "distributed" in counts:
        fits.append(distributed(part("distributed"), counts["distributed"] <= BROADCAST_GROUPS))
    return reduce(DataFrame.unionByName, fits)


# --- in one task -------------------------------------------------------------------


def centred(x: np.ndarray, is_athlete: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Effects shifted per part so that all athletes sum to zero with the smallest norm (see ``centre_components``)."""
    part = np.unique(label, return_inverse=True)[1]
    sign = np.where(is_athlete, 1.0, -1.0)
    size, n_a = np.bincount(part), np.bincount(part, is_athlete)
    gap, s_a = np.bincount(part, sign * x), np.bincount(part, np.where(is_athlete, x, 0.0))
    pull = (s_a.sum() - (n_a * gap / size).sum()) / (n_a * n_a / size).sum()
    return x - sign * ((gap + pull * n_a) / size)[part]


def solve_race_effects(pdf: pd.DataFrame, name: str = "a list") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    race, races = pd.factorize(pdf["race_id"])
    athlete, athletes = pd.factorize(pdf["athlete_id"])
    n_r, n_a, y = len(races), len(athletes), pdf["y"].to_numpy()
    # a race's node is its effect with the sign turned: then every row is a difference of two nodes
    rhs = np.concatenate([-np.bincount(race, y, n_r), np.bincount(athlete, y, n_a)])
    x, label = solve_in_task(race, n_r + athlete, np.ones(len(y)), n_r + n_a, rhs[:, None], name)
    is_athlete = np.arange(n_r + n_a) >= n_r
    effects = centred(np.where(is_athlete, x[:, 0], -x[:, 0]), is_athlete, label)
    return races, effects[:n_r], athletes, effects[n_r:]


def solve_winner_differences(pdf: pd.DataFrame, name: str = "a list") -> tuple[np.ndarray, np.ndarray]:
    m = len(pdf)
    codes, athletes = pd.factorize(pd.concat([pdf["athlete_id"], pdf["reference_athlete_id"]]))
    slow, fast, n = codes[:m], codes[m:], len(athletes)
    y = pdf["y"].to_numpy()
    rhs = np.stack([np.bincount(slow, v, n) - np.bincount(fast, v, n) for v in (y, np.ones(m))], axis=1)
    x, label = solve_in_task(slow, fast, np.ones(m), n, rhs, name)
    part = np.unique(label, return_inverse=True)[1]
    for k in (0, 1):
        x[:, k] -= (np.bincount(part, x[:, k]) / np.bincount(part))[part]
    by_time, by_one = x.T
    left = 1.0 - (by_one[slow] - by_one[fast])
    if left @ left > LEVELLED * m:
        c = (left @ y) / left.sum()
    else:
        c = (by_one @ by_time) / (by_one @ by_one + n)
    return athletes, by_time - c * (by_one + 1.0)


def _list_name(key: tuple) -> str:
    return "list " + ", ".join(map(str, key))


def _key_fields(df: DataFrame, keys: list[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


def race_effects_in_tasks(rows: DataFrame, keys: list[str]) -> DataFrame:
    schema = T.StructType(
        _key_fields(rows, keys)
        + [
            T.StructField("kind", T.StringType()),
            T.StructField("node", T.StringType()),
            T.StructField("effect", T.DoubleType()),
        ]
    )

    def solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        races, race_effect, athletes, athlete_effect = solve_race_effects(pdf, _list_name(key))
        out = pd.DataFrame(
            {
                "kind": ["race"] * len(races) + ["athlete"] * len(athletes),
                "node": np.concatenate([races, athletes]),
                "effect": np.concatenate([race_effect, athlete_effect]),
            }
        )
        return out.assign(**dict(zip(keys, key)))[schema.names]

    ship(rows.sparkSession)
    return rows.select(*keys, "race_id", "athlete_id", "y").groupBy(*keys).applyInPandas(solve, schema)


def winner_differences_in_tasks(rows: DataFrame, keys: list[str]) -> DataFrame:
    schema = T.StructType(
        _key_fields(rows, keys)
        + [T.StructField("athlete_id", T.StringType()), T.StructField("effect", T.DoubleType())]
    )

    def solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        athletes, effect = solve_winner_differences(pdf, _list_name(key))
        out = pd.DataFrame({"athlete_id": athletes, "effect": effect})
        return out.assign(**dict(zip(keys, key)))[schema.names]

    columns = [*keys, "athlete_id", "reference_athlete_id", "y"]
    ship(rows.sparkSession)
    return rows.select(*columns).groupBy(*keys).applyInPandas(solve, schema)


# --- over the hubs ---------------------------------------------------------------------


def race_effects_by_hubs(rows: DataFrame, hubs: DataFrame, keys: list[str]) -> DataFrame:
    """The races are the hubs, a race's node being its effect with the sign turned."""
    athlete = F.concat(F.lit("a"), "athlete_id")  # an athlete is never a race, also under the same id
    race = F.concat(F.lit("r"), "race_id")
    links = rows.select(*keys, athlete.alias("node"), race.alias("hub"), F.col("y").alias("x"))
    races, athletes = solve_by_hubs(links, hubs.withColumn("hub", F.concat(F.lit("r"), "hub")), keys, ["x"])
    return centre_components(_race_and_athlete(races.unionByName(athletes), keys), keys)


def winner_differences_by_hubs(rows: DataFrame, hubs: DataFrame, keys: list[str]) -> DataFrame:
    """The winners are the hubs; a winner may stand behind another one."""
    ids = {"athlete_id": "node", "reference_athlete_id": "hub"}
    links = rows.select(*keys, *ids, F.col("y").alias("by_time"), F.lit(1.0).alias("by_one")).withColumnsRenamed(ids)
    winners, others = solve_by_hubs(links, hubs, keys, ["by_time", "by_one"])
    solved = _centred_parts(durable(winners.unionByName(others), "winners-solved"), keys)
    ones = solved.select(*keys, "node", F.col("by_one").alias("own"))
    fast = durable(ones.join(winners.select(*keys, "node"), [*keys, "node"], "left_semi"), "winners-ones")
    pairs = links.select(*keys, "node", F.col("hub").alias("other"), F.col("by_time").alias("y"), F.lit(1.0).alias("w"))
    met = pairs.join(fast.select(*keys, F.col("node").alias("other"), F.col("own").alias("others")), [*keys, "other"]).join(ones, [*keys, "node"])
    return _with_intercept(met, solved, keys, few=False)


# --- distributed ---------------------------------------------------------------------


def _by_group(rows: DataFrame, groups: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """Put one row per oversized group onto the rows; the number of groups was counted."""
    return rows.join(F.broadcast(groups) if few else groups, keys)


def race_effects_distributed(rows: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """The bipartite graph of races and athletes, a race's node being its effect with the sign turned."""
    athlete, race = F.concat(F.lit("a"), "athlete_id"), F.concat(F.lit("r"), "race_id")
    cells = rows.groupBy(*keys, athlete.alias("node"), race.alias("other")).agg(F.count(F.lit(1)).cast("double").alias("w"), F.sum("y").alias("y"))
    cells = durable(cells, "cells")
    ends = [cells.groupBy(*keys, F.col(end).alias("node")).agg((sign * F.sum("y")).alias("x")) for end, sign in (("node", F.lit(1.0)), ("other", F.lit(-1.0)))]
    solved = solve(cells.drop("y"), ends[0].unionByName(ends[1]), keys, ["x"])
    return centre_components(_race_and_athlete(solved, keys), keys)


def _race_and_athlete(solved: DataFrame, keys: list[str]) -> DataFrame:
    is_athlete = F.left("node", F.lit(1)) == "a"
    return solved.select(
        *keys, "label", F.when(is_athlete, "athlete").otherwise("race").alias("kind"), F.substr(F.col("node"), F.lit(2)).alias("node"),
        F.when(is_athlete, F.col("x")).otherwise(-F.col("x")).alias("x"),
    )


def centre_components(effects: DataFrame, keys: list[str]) -> DataFrame:
    """Shift each component so that athletes sum to zero per group with the smallest norm. ``effects``: keys, label, kind, node, x.

    Within a component a constant may move from races to athletes without changing the fit.
    """
    effects = durable(effects, "effects")
    athlete = F.col("kind") == "athlete"
    sign = F.when(athlete, 1.0).otherwise(-1.0)
    parts = effects.groupBy(*keys, "label").agg(
        F.count(F.lit(1)).alias("size"),
        F.count(F.when(athlete, 1)).alias("n_a"),
        F.sum(F.when(athlete, F.col("x"))).alias("s_a"),
        F.sum(sign * F.col("x")).alias("gap"),
    )
    n_a, size, gap = F.col("n_a"), F.col("size"), F.col("gap")
    pull = parts.groupBy(*keys).agg(
        ((F.sum("s_a") - F.sum(n_a * gap / size)) / F.sum(n_a * n_a / size)).alias("lam")
    )
    shifts = parts.join(pull, keys).select(
        *keys, "label", (-(gap + F.col("lam") * n_a) / size).alias("shift")
    )
    moved = effects.join(durable(shifts, "shifts"), [*keys, "label"])
    return moved.select(*keys, "kind", "node", (F.col("x") + sign * F.col("shift")).alias("effect"))


def winner_differences_distributed(rows: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """Athlete effects from differences to the winner.

    With the intercept c, the effects are ``by_time - c * by_one`` up to a constant per part, where the two solve the graph for the
    differences and for ones. The row that ties the mean to -c, and the smallest norm, make that constant -c in every part.
    c itself is the fit of what ones leave over; where they leave nothing over it is free, and the smallest norm decides.
    """
    pairs = rows.groupBy(*keys, F.col("athlete_id").alias("node"), F.col("reference_athlete_id").alias("other")).agg(
        F.count(F.lit(1)).cast("double").alias("w"), F.sum("y").alias("y")
    )
    pairs = durable(pairs, "pairs")
    ends = [
        pairs.select(*keys, F.col(end).alias("node"), (sign * F.col("y")).alias("by_time"), (sign * F.col("w")).alias("by_one"))
        for end, sign in (("node", F.lit(1.0)), ("other", F.lit(-1.0)))
    ]
    nodes = ends[0].unionByName(ends[1]).groupBy(*keys, "node").agg(F.sum("by_time").alias("by_time"), F.sum("by_one").alias("by_one"))
    solved = durable(solve(pairs.drop("y"), nodes, keys, ["by_time", "by_one"]), "pairs-solved")
    solved = _centred_parts(solved, keys)
    one = solved.select(*keys, "node", F.col("by_one").alias("own"))
    met = pairs.join(one, [*keys, "node"]).join(one.select(*keys, F.col("node").alias("other"), F.col("own").alias("others")), [*keys, "other"])
    return _with_intercept(met, solved, keys, few)


def _centred_parts(solved: DataFrame, keys: list[str]) -> DataFrame:
    means = solved.groupBy(*keys, "label").agg(F.avg("by_time").alias("mean_time"), F.avg("by_one").alias("mean_one"))
    solved = solved.join(durable(means, "part-means"), [*keys, "label"]).select(
        *keys, "node", (F.col("by_time") - F.col("mean_time")).alias("by_time"), (F.col("by_one") - F.col("mean_one")).alias("by_one")
    )
    return durable(solved, "parts-centred")


def _with_intercept(met: DataFrame, solved: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """``met``: the differences (y, w) with ``by_one`` of both ends (own, others)."""
    left = F.lit(1.0) - (F.col("own") - F.col("others"))
    over = met.groupBy(*keys).agg(F.sum(left * F.col("y")).alias("ly"), F.sum(left * F.col("w")).alias("l"), F.sum(left * left * F.col("w")).alias("ll"), F.sum("w").alias("m"))
    norms = solved.groupBy(*keys).agg(F.sum(F.col("by_one") * F.col("by_time")).alias("ot"), F.sum(F.col("by_one") ** 2).alias("oo"), F.count("*").alias("n"))
    free = F.col("ot") / (F.col("oo") + F.col("n"))
    c = F.when(F.col("ll") > LEVELLED * F.col("m"), F.try_divide("ly", "l")).otherwise(free)
    intercepts = durable(over.join(norms, keys).select(*keys, c.alias("c")), "intercepts")
    effect = F.col("by_time") - F.col("c") * (F.col("by_one") + 1)
    return _by_group(solved, intercepts, keys, few).select(*keys, F.col("node").alias("athlete_id"), effect.alias("effect"))


# --- public ------------------------------------------------------------------------------


def fit_race_effects(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows``: keys, race_id, athlete_id, y. Returns keys, kind (race/athlete), node, effect."""
    return fit_by_size(
        rows,
        keys,
        "race_id",
        lambda part: race_effects_in_tasks(part, keys),
        lambda part, hubs: race_effects_by_hubs(part, hubs, keys),
        lambda part, few: race_effects_distributed(part, keys, few),
    )


def fit_winner_differences(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows``: keys, athlete_id, reference_athlete_id, y, winners already left out.

    Returns keys, athlete_id, effect for every athlete on either side.
    """
    return fit_by_size(
        rows,
        keys,
        "reference_athlete_id",
        lambda part: winner_differences_in_tasks(part, keys),
        lambda part, hubs: winner_differences_by_hubs(part, hubs, keys),
        lambda part, few: winner_differences_distributed(part, keys, few),
    )
