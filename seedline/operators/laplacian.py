"""Weighted graph Laplacians of many groups: ``sum of w * (x_node - x_other) = rhs`` at every node.

One rule for lists of any size, in one task (``solve_in_task``) or over DataFrames (``solve``):

1. Nodes with one or two neighbours are eliminated exactly, as many at once as do not touch each other (drawn by
   lot, so that a chain is folded up in logarithmically many rounds). A node with two neighbours leaves a link between them.
2. What is left, the core, has three neighbours everywhere. It is solved by conjugate gradients, scaled by degree, up to
   ``TOLERANCE``; ``most_rounds`` of the core's size bounds them. A list that needs more is an error that names it.
3. The eliminated nodes follow in reverse order.

Where every link of a list has a hub at one end and the hubs are few (the races of a list, the winners of races), ``solve_by_hubs`` does the
first step in one pass: the other nodes do not touch each other and leave at once, each as links between its hubs, which slices of the
list add up on their own. Only the hubs, at most ``most_hubs``, are solved in one task.

Right-hand sides have to sum to zero in every connected part. The answer is one of those that differ by a constant per
part; ``label`` says which nodes belong together.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import bucketed, durable, rows_per_task, scratch_path, ship
from .components import components

TOLERANCE = 1e-12  # on the relative residual of the core


def most_rounds(unknowns: int) -> int:
    """Rounds of conjugate gradients end after as many as there are unknowns, but for rounding."""
    return 100 + 2 * unknowns


# --- in one task -------------------------------------------------------------------


def merged(a: np.ndarray, b: np.ndarray, w: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between the same two nodes as one; links of a node to itself leave."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    apart = low != high
    pair, place = np.unique(low[apart].astype(np.int64) * n + high[apart], return_inverse=True)
    return pair // n, pair % n, np.bincount(place, w[apart], len(pair))


def _gradients(a: np.ndarray, b: np.ndarray, w: np.ndarray, n: int, rhs: np.ndarray, name: str) -> np.ndarray:
    degree = np.bincount(a, w, n) + np.bincount(b, w, n)
    linked = degree > 0
    scale = np.where(linked, degree, 1.0)
    x, r = np.zeros(n), np.where(linked, rhs, 0.0)
    z = r / scale
    p, rz = z.copy(), r @ z
    first = rz
    if not np.isfinite(first):
        raise RuntimeError(f"{name} has times that are not finite")
    for _ in range(most_rounds(n)):
        if rz <= first * TOLERANCE**2:
            return x
        q = degree * p - np.bincount(a, w * p[b], n) - np.bincount(b, w * p[a], n)
        step = rz / (p @ q)
        x, r = x + step * p, r - step * q
        z = r / scale
        rz, old = r @ z, rz
        p = z + rz / old * p
    raise RuntimeError(f"{name} did not converge, relative residual {(rz / first) ** 0.5:.1e}")


def labels_in_task(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node of each connected part."""
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, label[a], label[b])
        np.minimum.at(least, label[b], label[a])
        while (least != least[least]).any():
            least = least[least]
        fresh = least[label]
        if (fresh == label).all():
            return label
        label = fresh


def solve_in_task(a: np.ndarray, b: np.ndarray, w: np.ndarray, n: int, rhs: np.ndarray, name: str = "a list") -> tuple[np.ndarray, np.ndarray]:
    """(x, label) for the columns of ``rhs`` (n rows). ``a``, ``b``: ends of the links, as numbers below ``n``."""
    if not np.isfinite(rhs).all():
        raise RuntimeError(f"{name} has times that are not finite")
    label = labels_in_task(a, b, n)
    rhs, lots, gone = rhs.copy(), np.random.default_rng(0), []
    a, b, w = merged(a, b, w, n)
    while True:
        node, other, weight = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([w, w])
        count = np.bincount(node, minlength=n)
        few = (count > 0) & (count <= 2)
        lot = lots.permutation(n)
        rival = np.full(n, n)
        between = few[node] & few[other]
        np.minimum.at(rival, node[between], lot[other[between]])
        chosen = few & (lot < rival)
        if not chosen.any():
            break
        at = np.flatnonzero(chosen[node])
        at = at[np.argsort(node[at], kind="stable")]
        nodes, first = np.unique(node[at], return_index=True)
        second = first + count[nodes] - 1  # the same link again where there is only one
        one = count[nodes] == 1
        u, v = other[at[first]], other[at[second]]
        share_u, share_v = weight[at[first]], np.where(one, 0.0, weight[at[second]])
        total = share_u + share_v
        own = rhs[nodes].copy()
        gone.append((nodes, u, v, share_u / total, share_v / total, own / total[:, None]))
        for k in range(rhs.shape[1]):
            rhs[:, k] += np.bincount(u, own[:, k] * share_u / total, n) + np.bincount(v, own[:, k] * share_v / total, n)
        rhs[nodes] = 0.0
        stay = ~(chosen[a] | chosen[b])
        a, b, w = merged(np.concatenate([a[stay], u[~one]]), np.concatenate([b[stay], v[~one]]), np.concatenate([w[stay], (share_u * share_v / total)[~one]]), n)
    core = np.unique(np.concatenate([a, b]))
    x = np.zeros_like(rhs)
    if len(core):
        place = np.zeros(n, dtype=np.int64)
        place[core] = np.arange(len(core))
        for k in range(rhs.shape[1]):
            x[core, k] = _gradients(place[a], place[b], w, len(core), rhs[core, k], name)
    for nodes, u, v, share_u, share_v, own in reversed(gone):
        x[nodes] = share_u[:, None] * x[u] + share_v[:, None] * x[v] + own
    return x, label


# --- over a few hubs -------------------------------------------------------------------


SQUARE = 1 << 22  # cells of nodes by hubs that are laid out at a time


def most_hubs(spark: SparkSession) -> int:
    """A square of so many hubs has as many cells as four times the rows that a task may be handed (2,000 hubs by default)."""
    return 2 * isqrt(rows_per_task(spark))


def folded(node: np.ndarray, own: np.ndarray, hub: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, w, hubs, rhs): links between hubs and the hubs' right-hand sides once all other nodes are eliminated.

    Every row says ``x_node - x_hub = y`` (a column for each right-hand side). ``own`` is the number of a node that is a hub itself, else -1.
    """
    hubs, place = np.unique(np.concatenate([hub, own[own >= 0]]), return_inverse=True)
    m, h = len(hub), len(hubs)
    other, both = place[:m], np.flatnonzero(own >= 0)
    mine = place[m:]
    rhs = np.stack([np.bincount(mine, c[both], h) - np.bincount(other, c, h) for c in y.T], axis=1)
    square = np.bincount(mine * h + other[both], minlength=h * h).reshape(h, h).astype(float)
    square += square.T
    rest = np.flatnonzero(own < 0)
    code = np.unique(node[rest], return_inverse=True)[1]
    rest = rest[np.argsort(code, kind="stable")]
    code = np.sort(code)
    n, step = (code[-1] + 1 if len(code) else 0), max(1, SQUARE // max(h, 1))
    for start in range(0, n, step):
        at = slice(*np.searchsorted(code, [start, start + step]))
        size, row, col = min(step, n - start), code[at] - start, other[rest[at]]
        cells = np.bincount(row * h + col, minlength=size * h).reshape(size, h)
        degree = cells.sum(axis=1)
        shares = cells / degree[:, None]
        square += cells.T.astype(float) @ shares
        pull = np.stack([np.bincount(row, c[rest[at]], size) for c in y.T], axis=1)
        rhs += shares.T @ pull
    a, b = np.nonzero(np.triu(square, 1))
    return hubs[a], hubs[b], square[a, b], hubs, rhs


def solve_by_hubs(rows: DataFrame, hubs: DataFrame, keys: Sequence[str], rhs: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(keys, node, label and the answers of the hubs; the same of all other nodes). Answers are named as the columns of ``rhs``.

    ``rows``: keys, node, hub and a column for each right-hand side, where every row says ``x_node - x_hub = rhs``; ``hubs``: keys, hub and n,
    the hubs of each list with their rows. The lists have at most ``most_hubs`` hubs; a task is handed a slice of a list's nodes.
    """
    spark, limit, c = rows.sparkSession, rows_per_task(rows.sparkSession), len(rhs)
    each = Window.partitionBy(*keys)
    numbered = hubs.withColumn("_at", (F.row_number().over(each.orderBy("hub")) - 1).cast("int"))
    numbered = durable(numbered.withColumn("_slices", F.ceil(F.sum("n").over(each) / F.lit(limit)).cast("int")).drop("n"), "hubs")
    rows = rows.join(numbered, [*keys, "hub"])
    selves = numbered.select(*keys, F.col("hub").alias("node"), F.col("_at").alias("_own"))
    rows = rows.join(selves, [*keys, "node"], "left").withColumn("_own", F.coalesce("_own", F.lit(-1)))

    fields = [rows.schema[k] for k in keys]
    out = T.StructType(fields + [T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())] + [T.StructField(x, T.DoubleType()) for x in ("w", *rhs)])

    def fold(key: tuple, part: pa.Table) -> pa.Table:
        node = part["node"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        y = np.stack([part[x].to_numpy() for x in rhs], axis=1)
        a, b, w, own, sums = folded(node, part["_own"].to_numpy(), part["_at"].to_numpy(), y)
        n, m = len(a), len(own)
        columns = [pa.array([k.as_py()] * (n + m), part.schema.field(name).type) for name, k in zip(keys, key)]
        columns += [pa.array(np.concatenate([a, own]), pa.int32()), pa.array(np.concatenate([b, own]), pa.int32())]
        columns += [pa.array(np.concatenate([w, np.zeros(m)]))] + [pa.array(np.concatenate([np.zeros(n), sums[:, k]])) for k in range(c)]
        return pa.table(columns, names=out.names)

    ship(spark)
    narrow = rows.select(*keys, F.pmod(F.xxhash64("node"), F.col("_slices")).alias("_slice"), "node", "_own", "_at", *rhs)
    parts = narrow.groupBy(*keys, "_slice").applyInArrow(fold, out)
    core = parts.groupBy(*keys, "a", "b").agg(*[F.sum(x).alias(x) for x in ("w", *rhs)])

    answer = T.StructType(fields + [T.StructField("_at", T.IntegerType()), T.StructField("_label", T.IntegerType())] + [T.StructField(x, T.DoubleType()) for x in rhs])

    def solved(key: tuple, part: pa.Table) -> pa.Table:
        a, b = part["a"].to_numpy(), part["b"].to_numpy()
        own = a == b
        n = int(a.max()) + 1
        sums = np.zeros((n, c))
        for k, x in enumerate(rhs):
            sums[a[own], k] = part[x].to_numpy()[own]
        name = "list " + ", ".join(str(k.as_py()) for k in key)
        x, label = solve_in_task(a[~own], b[~own], part["w"].to_numpy()[~own], n, sums, name)
        columns = [pa.array([k.as_py()] * n, part.schema.field(name).type) for name, k in zip(keys, key)]
        columns += [pa.array(np.arange(n), pa.int32()), pa.array(label, pa.int32())] + [pa.array(x[:, k]) for k in range(c)]
        return pa.table(columns, names=answer.names)

    found = durable(core.groupBy(*keys).applyInArrow(solved, answer), "hubs-solved")
    named = durable(numbered.drop("_slices").join(found, [*keys, "_at"]), "hubs-named")
    known = named.select(*keys, "hub", F.col("_label").cast("string").alias("label"), *[F.col(x).alias(f"_{x}") for x in rhs])
    rest = rows.where("_own < 0").drop("_at", "_slices", "_own").join(known, [*keys, "hub"])
    means = [(F.sum(F.col(x) + F.col(f"_{x}")) / F.count("*")).alias(x) for x in rhs]
    rest = rest.groupBy(*keys, "node").agg(F.min("label").alias("label"), *means)
    return known.select(*keys, F.col("hub").alias("node"), "label", *[F.col(f"_{x}").alias(x) for x in rhs]), rest


# --- distributed ---------------------------------------------------------------------


def _summed(links: DataFrame, keys: Sequence[str]) -> DataFrame:
    return links.where("node <> other").groupBy(*keys, "node", "other").agg(F.sum("w").alias("w"))


def _chosen(links: DataFrame, keys: Sequence[str], turn: int) -> DataFrame:
    """keys, node, u, wu, v, wv (null with one neighbour): nodes to eliminate that do not touch each other."""
    pair = F.struct("other", "w")
    ends = links.groupBy(*keys, "node").agg(F.count("*").alias("n"), F.min(pair).alias("lo"), F.max(pair).alias("hi")).where("n <= 2")
    lot = F.struct(F.xxhash64("node", F.lit(turn)).alias("lot"), F.col("node").alias("of"))
    two = F.col("n") == 2
    few = durable(
        ends.select(*keys, "node", lot.alias("lot"), F.col("lo.other").alias("u"), F.col("lo.w").alias("wu"), F.when(two, F.col("hi.other")).alias("v"), F.when(two, F.col("hi.w")).alias("wv")),
        "few-neighbours",
    )
    asked = few.select(*keys, "node", F.explode(F.array("u", "v")).alias("other")).where("other IS NOT NULL")
    rivals = asked.join(few.select(*keys, F.col("node").alias("other"), F.col("lot").alias("rival")), [*keys, "other"])
    least = rivals.groupBy(*keys, "node").agg(F.min("rival").alias("rival"))
    return few.join(least, [*keys, "node"], "left").where("rival IS NULL OR lot < rival").drop("lot", "rival")


def _eliminated(links: DataFrame, nodes: DataFrame, keys: Sequence[str], rhs: Sequence[str]) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(links and nodes of the core, what was eliminated in each round)."""
    gone: list[DataFrame] = []
    while True:
        seen = Observation()
        picked = _chosen(links, keys, len(gone)).join(nodes, [*keys, "node"])
        picked = durable(picked, "eliminated", seen, F.count("*").alias("n"))
        if not seen.get["n"]:
            return links, nodes, gone
        gone.append(picked)
        total = F.col("wu") + F.coalesce("wv", F.lit(0.0))
        given = [
            picked.where(F.col(end).isNotNull()).select(*keys, F.col(end).alias("node"), *[(F.col(c) * F.col(w) / total).alias(c) for c in rhs])
            for end, w in (("u", "wu"), ("v", "wv"))
        ]
        names = picked.select(*keys, "node")
        rest = nodes.join(names, [*keys, "node"], "left_anti").unionByName(given[0]).unionByName(given[1])
        nodes = durable(rest.groupBy(*keys, "node").agg(*[F.sum(c).alias(c) for c in rhs]), "core-nodes")
        between = picked.where("v IS NOT NULL").withColumn("w", F.col("wu") * F.col("wv") / total)
        stay = links.join(names, [*keys, "node"], "left_anti").join(names.withColumnRenamed("node", "other"), [*keys, "other"], "left_anti")
        there, back = (between.select(*keys, F.col(x).alias("node"), F.col(y).alias("other"), "w") for x, y in (("u", "v"), ("v", "u")))
        links = durable(_summed(stay.select(*keys, "node", "other", "w").unionByName(there).unionByName(back), keys), "core-links")


def _worst(rows: DataFrame, keys: Sequence[str], residual: Column) -> str:
    row = rows.groupBy(*keys).agg(F.max(residual).alias("residual")).orderBy(F.desc("residual")).first()
    return ", ".join(str(row[k]) for k in keys)


def core_table(links: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(links in buckets of the node they bring a value from; keys, node, degree, parts), written once for all rounds.

    A node with more links than a task may hold is in several parts, and its value goes to each of them."""
    limit = rows_per_task(links.sparkSession)
    sizes = links.groupBy(*keys, "node").agg(F.sum("w").alias("degree"), F.ceil(F.count("*") / F.lit(limit)).cast("int").alias("parts"))
    sizes = durable(sizes, "core-sizes")
    at = sizes.select(*keys, F.col("node").alias("other"), "parts")
    cut = links.join(at, [*keys, "other"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    return bucketed(cut.select(*keys, "other", "part", "node", "w"), "core-table", [*keys, "other", "part"]), sizes


def neighbour_sums(table: DataFrame, vector: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, node, s: the weighted sum of ``p`` around every node. ``vector``: keys, node, parts, p. The links are not shuffled."""
    sent = vector.select(*keys, F.col("node").alias("other"), "p", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return table.join(sent, [*keys, "other", "part"]).groupBy(*keys, "node").agg(F.sum(F.col("w") * F.col("p")).alias("s"))


def _core_gradients(table: DataFrame, sizes: DataFrame, nodes: DataFrame, keys: Sequence[str], rhs: str) -> DataFrame:
    """keys, node, x. The vectors are written once a round, over those of the last but one, and the residual is observed by the same job; a
    list that has converged stands still."""
    start = nodes.select(*keys, "node", F.col(rhs).alias("r")).join(sizes, [*keys, "node"])
    start = start.select(*keys, "node", "degree", "parts", "r", F.lit(0.0).alias("x"), (F.col("r") / F.col("degree")).alias("p"))
    state = durable(start, "cg-start")
    places = [scratch_path(nodes.sparkSession, "cg-round") for _ in range(2)]
    opening = state.groupBy(*keys).agg(F.sum(F.col("r") * F.col("p")).alias("rz"), F.count("*").alias("unknowns"))
    opening = durable(opening.withColumn("first", F.col("rz")), "cg-lists")
    bound = most_rounds(opening.agg(F.max("unknowns")).first()[0] or 0)
    state = state.join(opening.drop("unknowns"), [*keys])
    ratio = F.when(F.col("first") != 0, F.col("rz") / F.col("first")).otherwise(0.0)
    m, r, p, q = (F.col(c) for c in ("degree", "r", "p", "q"))
    for turn in range(bound):
        sums = neighbour_sums(table, state, keys)
        seen = Observation()
        work = state.join(sums, [*keys, "node"], "left").withColumn("q", m * p - F.coalesce("s", F.lit(0.0))).drop("s")
        work = durable(work, "cg-round", seen, F.max(ratio).alias("worst"), path=places[turn % 2])
        worst = seen.get["worst"] or 0.0
        if not np.isfinite(worst):
            raise RuntimeError(f"list {_worst(work, keys, ratio)} has times that are not finite")
        if worst <= TOLERANCE**2:
            return work.select(*keys, "node", "x")
        sums = work.groupBy(*keys).agg(
            F.sum(p * q).alias("pq"), F.sum(r * r / m).alias("rr"), F.sum(r * q / m).alias("rq"), F.sum(q * q / m).alias("qq"), F.first("first").alias("first")
        )
        moving = (F.col("rr") > F.col("first") * TOLERANCE**2) & (F.col("pq") > 0)
        sums = sums.withColumn("step", F.when(moving, F.col("rr") / F.col("pq")).otherwise(0.0))
        after = F.greatest(F.col("rr") - 2 * F.col("step") * F.col("rq") + F.col("step") ** 2 * F.col("qq"), F.lit(0.0))
        sums = sums.withColumn("rz", after).withColumn("turn", F.when(moving, F.col("rz") / F.col("rr")).otherwise(0.0))
        state = work.drop("rz", "first").join(sums.select(*keys, "step", "turn", "rz", "first"), [*keys])
        fresh = r - F.col("step") * q
        state = state.withColumns({"x": F.col("x") + F.col("step") * p, "r": fresh, "p": fresh / m + F.col("turn") * p}).drop("q", "step", "turn")
    raise RuntimeError(f"list {_worst(work, keys, ratio)} did not converge, relative residual {worst**0.5:.1e}")


def solve(links: DataFrame, nodes: DataFrame, keys: Sequence[str], rhs: Sequence[str]) -> DataFrame:
    """keys, node, label and the answer for each column of ``rhs`` under its name.

    ``links``: keys, node, other, w, each link once or more, from either end; ``nodes``: keys, node, rhs columns, every node once."""
    both = links.unionByName(links.select(*keys, F.col("other").alias("node"), F.col("node").alias("other"), "w"))
    core_links, core, gone = _eliminated(durable(_summed(both, keys), "links"), durable(nodes, "nodes"), keys, rhs)
    linked, _ = components(core_links.select(*keys, F.col("node").alias("a"), F.col("other").alias("b")), keys)
    known = core.select(*keys, "node").join(linked, [*keys, "node"], "left").withColumn("label", F.coalesce("label", "node"))
    empty = core_links.isEmpty()
    if not empty:
        table, sizes = core_table(core_links, keys)
    for c in rhs:
        if empty:
            known = known.withColumn(c, F.lit(0.0))
        else:
            x = _core_gradients(table, sizes, core, keys, c).withColumnRenamed("x", c)
            known = known.join(x, [*keys, "node"], "left").withColumn(c, F.coalesce(c, F.lit(0.0)))
    known = durable(known, "core-solved")
    for picked in reversed(gone):
        at_u = known.select(*keys, F.col("node").alias("u"), "label", *[F.col(c).alias(f"u_{c}") for c in rhs])
        at_v = known.select(*keys, F.col("node").alias("v"), *[F.col(c).alias(f"v_{c}") for c in rhs])
        met = picked.join(at_u, [*keys, "u"]).join(at_v, [*keys, "v"], "left")
        wv = F.coalesce("wv", F.lit(0.0))
        answers = [((F.col("wu") * F.col(f"u_{c}") + wv * F.coalesce(f"v_{c}", F.lit(0.0)) + F.col(c)) / (F.col("wu") + wv)).alias(c) for c in rhs]
        known = known.unionByName(durable(met.select(*keys, "node", "label", *answers), "followed"))
    return known
