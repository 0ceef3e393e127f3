"""Hard negatives by exact integer scores from a residue-number-system matrix product.

Components become integers. Their residues modulo small primes, taken around zero, are multiplied as float32
matrices; every sum of a block of dimensions stays below 2**24 and is therefore exact. The residues of a score are
put together by Chinese remaindering (mixed radix, 64-bit integers) into the exact signed score; as many primes are
used as the largest possible score needs. A table whose scores could leave their product is an error.

Anchors and rows are cut into tiles: a block of about ``ANCHORS`` anchors meets a shard of about ``ROWS`` rows, each
pair of them one group of one shuffle, so that a task holds one tile whatever the table's size. A first pass gives
each tile's best rows of the anchor's label, and a window over these the anchor's positives; a second pass scores the
tiles again and gives, for each positive, the best rows of other labels inside the positive's window of scores, and a window
over these the answer.

Rows with a null id, label or vector, or with a null or non-finite component, take no part. Rows equal in id, vector and
label count once; rows equal in id alone are rows of their own, but never each other's positives or negatives. Missing
components of shorter vectors are zero. Ties go to the smaller id. Anchors without positives, and positives without
negatives, have no result. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable, ship

ANCHOR_EVERY, RELABEL_EVERY, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95  # a negative's score, in hundredths of the positive's
SCALE = 256
ROWS, ANCHORS = 8192, 4096  # of a tile
AT_ONCE = 128  # anchors scored at once in a tile
PRIMES = [1021, 1019, 1013, 1009, 997, 991]  # their product is below 2**60


# --- scores --------------------------------------------------------------------------


def primes_for(most: int) -> list[int]:
    """As many primes as scores from -most to most need."""
    for n in range(1, len(PRIMES) + 1):
        if prod(PRIMES[:n]) > 2 * most:
            return PRIMES[:n]
    raise ValueError(f"scores up to {most} leave the range of the residues")


def residues(values: np.ndarray, prime: int) -> np.ndarray:
    """Around zero, as float32."""
    r = np.mod(values, prime)
    return np.where(r > prime // 2, r - prime, r).astype(np.float32)


def modular_product(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """a @ b.T modulo the prime (0 to prime - 1) of residues around zero, in blocks of dimensions that stay exact."""
    block = (2**24 - 1) // (prime // 2) ** 2
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    for start in range(0, a.shape[1], block):
        out += (a[:, start : start + block] @ b[:, start : start + block].T).astype(np.int64)
        out %= prime
    return out


def remaindered(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed numbers with these residues, by mixed radix."""
    value, base = parts[0].copy(), primes[0]
    for part, prime in zip(parts[1:], primes[1:]):
        digit = (part - value) % prime * pow(base, -1, prime) % prime
        value += digit * base
        base *= prime
    return np.where(value > base // 2, value - base, value)


class Rows:
    """The rows of one tile by their residues, in the order of their ids."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, primes: list[int]) -> None:
        order = np.argsort(ids, kind="stable")
        self.order, self.ids, self.labels, self.primes = order, ids[order], labels[order], primes
        self.residues = [residues(vectors[order], p) for p in primes]

    def scores(self, anchors: list[np.ndarray]) -> np.ndarray:
        return remaindered([modular_product(a, r, p) for a, r, p in zip(anchors, self.residues, self.primes)], self.primes)


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> list[np.ndarray]:
    """For each line the places of its k best allowed scores, best first, of equal ones the first."""
    out = []
    for line, good in zip(scores, allowed):
        at = np.flatnonzero(good)
        if len(at) > k:  # all that reach the k-th best, ties included
            found = line[at]
            at = at[found >= np.partition(found, len(at) - k)[len(at) - k]]
        out.append(at[np.argsort(-line[at], kind="stable")][:k])
    return out


# --- tiles ---------------------------------------------------------------------------


def prepared(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, v (floor(SCALE * x) of the components) of the rows that take part."""
    x = F.col(vector).cast("array<double>")
    usable = F.col(vector).isNotNull() & F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float("inf")) & ~F.isnan(c))
    whole = F.transform(x, lambda c: F.floor(c * F.lit(SCALE)))
    used = rows.where(usable & F.col(vec_id).isNotNull() & F.col(label).isNotNull())
    return used.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), whole.alias("v")).distinct()


def relabelled(rows: DataFrame) -> DataFrame:
    """Labels of every ``RELABEL_EVERY``-th id moved on by one."""
    moved = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return rows.withColumn("label", moved)


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), dims), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
    return out


def _tiles(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int) -> DataFrame:
    """``rows`` and ``anchors`` (row, vec_id, label, v; anchors also windows), each put into every tile it belongs to."""
    shards, blocks = -(-n_rows // ROWS) or 1, -(-n_anchors // ANCHORS) or 1

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    held = rows.select(F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), every(blocks).alias("block"), F.lit(False).alias("asks"), "row", "vec_id", "label", "v")
    held = held.withColumn("windows", F.lit(None).cast("array<bigint>"))
    asking = anchors.select(every(shards).alias("shard"), F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), F.lit(True).alias("asks"), "row", "vec_id", "label", "v", "windows")
    return held.unionByName(asking).groupBy("shard", "block")


def _answers(tiles, dims: int, primes: list[int], k: int, choose) -> DataFrame:
    """anchor_row, positive (its place in ``windows``, 0 in the first pass), row, vec_id, score: of each tile the k best.

    ``choose(scores, tile's rows, anchor labels, anchor ids, windows)`` gives the masks of allowed rows, one for each place."""

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        every = {c: table.column(c).to_numpy() for c in ("row", "vec_id", "label")}
        vectors = _matrix(table.column("v"), dims)
        rows = Rows(every["vec_id"][~asks], every["label"][~asks], vectors[~asks], primes)
        row_of = every["row"][~asks][rows.order]
        places = np.flatnonzero(asks)
        windows = table.column("windows").take(pa.array(places)).to_pylist()
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        for start in range(0, len(places), AT_ONCE):
            part = places[start : start + AT_ONCE]
            scores = rows.scores([residues(vectors[part], p) for p in primes])
            masks = choose(scores, rows, every["label"][part], every["vec_id"][part], windows[start : start + AT_ONCE])
            for place, mask in enumerate(masks):
                for line, at in enumerate(best(scores, mask, k)):
                    for kept, value in zip(out, (np.full(len(at), every["row"][part[line]]), np.full(len(at), place), row_of[at], rows.ids[at], scores[line, at])):
                        kept.append(value)
        columns = [pa.array(np.concatenate([np.empty(0, np.int64), *c]).astype(np.int64)) for c in out]
        return pa.Table.from_arrays(columns, names=["anchor_row", "positive", "row", "vec_id", "score"])

    return tiles.applyInArrow(run, "anchor_row bigint, positive bigint, row bigint, vec_id bigint, score bigint")


def _same_label(scores, rows: Rows, labels, ids, windows) -> list[np.ndarray]:
    return [(rows.labels == labels[:, None]) & (rows.ids != ids[:, None])]


def _in_window(scores, rows: Rows, labels, ids, windows) -> list[np.ndarray]:
    other = (rows.labels != labels[:, None]) & (rows.ids != ids[:, None])
    masks = []
    for place in range(max(map(len, windows), default=0)):
        known = np.array([len(w) > place for w in windows])
        score = np.array([w[place] if len(w) > place else 0 for w in windows], dtype=np.int64)[:, None]
        low, high = -(-score * LEAST // 100), score * MOST // 100  # the least and the largest integer inside
        masks.append(other & known[:, None] & (scores >= low) & (scores <= high))
    return masks


def _first(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best rows by key, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for every row for which ``is_anchor`` holds.

    ``rows``: vec_id, label (bigint), v (array of bigint), as from ``prepared``."""
    ship(rows.sparkSession)
    rows = durable(rows.select("vec_id", "label", "v").withColumn("row", F.monotonically_increasing_id()), "vectors")
    largest = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    n, n_anchors, dims, most = rows.agg(F.count("*"), F.count_if(is_anchor), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(largest), F.lit(0.0))).first()
    primes = primes_for(int(most) ** 2 * max(dims, 1))
    anchors = rows.where(is_anchor)

    near = _answers(_tiles(rows, anchors.withColumn("windows", F.lit(None).cast("array<bigint>")), n, n_anchors), dims, primes, positives, _same_label)
    near = durable(_first(near, ["anchor_row"], positives).select("anchor_row", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # at most `positives` to an anchor
    windows = near.groupBy(F.col("anchor_row").alias("row")).agg(F.sort_array(F.collect_list(F.struct("rank", "positive_score")))["positive_score"].alias("windows"))
    asking = durable(anchors.join(windows, "row"), "anchors-asking")
    hard = _answers(_tiles(rows, asking, n, n_anchors), dims, primes, negatives, _in_window)
    hard = _first(hard, ["anchor_row", "positive"], negatives).withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score", "rank": "place"})
    named = near.withColumn("positive", F.col("rank").cast("bigint") - 1).drop("rank")
    named = named.join(anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id")), "anchor_row")
    out = hard.join(named, ["anchor_row", "positive"])
    return out.select("anchor_id", "positive_id", F.col("place").alias("rank"), "negative_id", "positive_score", "negative_score")


NEGATIVES_SQL = r"""
WITH v AS (
  SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
    (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INT AS rank
  FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id
  WHERE NOT s.alike AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3"""
