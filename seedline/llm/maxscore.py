"""Exact top k by inner product with MaxScore over sharded postings.

A vector's components, as integers, are term weights: the terms are dimensions, and a term's posting list holds the
shard's weights of it, in stretches of vectors that each know their largest weight of either sign. A query's term can
add at most its weight times the largest weight of the same sign in the stretch; that is the term's bound. Terms are
put in order of their bounds, and those whose bounds together stay below the score to beat are non-essential: a vector
cannot win by them alone, and where no term is essential the stretch is passed over. The essential lists are traversed, for many
queries at once, as one matrix product; the vectors whose score plus the bounds of what is left can still reach the
score to beat are probed for the other terms, one by one where they are few, else as a second product. The score to beat, a query's k-th best so far,
is carried from stretch to stretch and from shard to shard; a window over at most k rows per task and query merges the tasks.

Vectors are dealt by hash to shards of at most about ``SHARD_VECTORS`` and ``SHARD_BYTES``, queries to blocks of at
most about ``QUERY_BLOCK`` and ``BLOCK_BYTES``; each shard and block is one packed row, in the narrowest integers that hold the
weights. Every block meets every shard in a product of partitions: a task reads a few blocks and about ``TASK_BYTES`` of
shards, and no meeting is written down, shuffled or sent through the driver. Scores are exact: a product runs in
float32, float64 or int64, whichever holds all sums of these vectors; a table whose products could leave 64 bits is an error.

Vectors that are null or hold null or non-finite components take no part. Missing components of shorter
vectors are zero. Rows without id take no part, rows equal in id and vector count once. Ties go to the
smaller id. Queries with no other row in the table have no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable, ship
from .hard_negatives import _matrix, best

K = 5
QUERY_EVERY = 50
SCALE = 256
SHARD_VECTORS, SHARD_BYTES = 8192, 4 << 20
QUERY_BLOCK, BLOCK_BYTES = 1024, 1 << 20
TASK_BYTES = 16 << 20  # of shards in a task
TASKS = 4096  # from here on tasks take more blocks instead of being more
STRETCH, AT_ONCE = 4096, 128  # vectors with bounds of their own, queries that meet them at once
PROBED = 32  # one vector in so many, or fewer, is probed by itself
NONE, LAST = -(2**62), 2**63 - 1  # the score and id of a place that is still free


def quantised(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v: floor(SCALE * x) of every component, of the vectors that take part."""
    x = F.col(vector).cast("array<double>")
    usable = F.col(vector).isNotNull() & F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float("inf")) & ~F.isnan(c))
    whole = F.transform(x, lambda c: F.floor(c * F.lit(SCALE)))
    return rows.where(usable & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("bigint").alias("vec_id"), whole.alias("v")).distinct()


class Postings:
    """One shard in the order of its ids: stretches of (ids, weights by term, largest and smallest weight by term)."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, kind: str) -> None:
        order = np.argsort(ids, kind="stable")  # so that of equal scores the first found has the smaller id
        ids, terms = ids[order], np.ascontiguousarray(weights[order].T)
        self.stretches = []
        for start in range(0, len(ids), STRETCH):
            part = terms[:, start : start + STRETCH]
            highest, lowest = (x.astype(np.int64) for x in (part.max(axis=1, initial=0), part.min(axis=1, initial=0)))
            self.stretches.append((ids[start : start + STRETCH], part.astype(kind), highest, lowest))


def _exactly(score: np.ndarray, kind: str) -> np.ndarray:
    """Limits of scores in the kind of the scores, which are all smaller than the ones cut off here."""
    most = {"f4": 2**24, "f8": 2**53}.get(kind)
    return score if most is None else np.clip(score, -most, most).astype(kind)


class Search:
    """A block of queries and the k best (score, vector) of each so far, best first."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, kind: str, k: int) -> None:
        self.query_ids, self.queries, self.kind, self.k = ids, weights.astype(np.int64), kind, k
        self.scores, self.ids = np.full((len(ids), k), NONE), np.full((len(ids), k), LAST)

    def meet(self, shard: Postings) -> None:
        for stretch in shard.stretches:
            for start in range(0, len(self.query_ids), AT_ONCE):
                self._meet(np.arange(start, min(start + AT_ONCE, len(self.query_ids))), *stretch)

    def _meet(self, at: np.ndarray, ids: np.ndarray, terms: np.ndarray, highest: np.ndarray, lowest: np.ndarray) -> None:
        # a vector of these ids with the score of the k-th best wins only by a smaller id
        to_beat = self.scores[at, -1] + (ids[0] >= self.ids[at, -1])
        bounds = np.maximum(self.queries[at] * highest, self.queries[at] * lowest)
        order = np.argsort(-bounds.sum(axis=0, dtype=float), kind="stable")
        left = np.zeros((len(at), len(order) + 1), dtype=np.int64)  # bound of the terms from each place on
        left[:, :-1] = np.cumsum(bounds[:, order][:, ::-1], axis=1)[:, ::-1]
        able = left[:, 0] >= to_beat
        if not able.any():
            return
        at, to_beat, left = at[able], to_beat[able], left[able]
        essential = min(int((left >= to_beat[:, None]).sum(axis=1).max()), len(order))  # terms before this place; left[:, place] < to_beat
        queries = self.queries[at][:, order]
        score = queries[:, :essential].astype(self.kind) @ terms[order[:essential]]
        if essential < len(order):
            competitive = score >= _exactly(to_beat - left[:, essential], self.kind)[:, None]
            if np.count_nonzero(competitive) * PROBED <= competitive.size:
                line, found = np.divmod(np.flatnonzero(competitive), len(ids))
                self._probe(at, to_beat, left, essential, order, queries, ids, terms, line, found, score[line, found].astype(np.int64))
                return
            score += queries[:, essential:].astype(self.kind) @ terms[order[essential:]]

        reach = score >= _exactly(to_beat, self.kind)[:, None]
        own = self.query_ids[at]
        first, end = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
        for line in np.flatnonzero(first < end):
            reach[line, first[line] : end[line]] = False
        if np.count_nonzero(reach) > 8 * self.k * len(at):
            chosen = best(score, reach, self.k)
            line, found = np.repeat(np.arange(len(at)), [len(c) for c in chosen]), np.concatenate(chosen)
        else:
            line, found = np.divmod(np.flatnonzero(reach), len(ids))
        self._take(at[line], score[line, found].astype(np.int64), ids[found])

    def _probe(self, at, to_beat, left, place, order, queries, ids, terms, line, found, score) -> None:
        """Add the terms from ``place`` on to the scores of the vectors ``found``, as long as they can win."""
        others = ids[found] != self.query_ids[at[line]]
        line, found, score = line[others], found[others], score[others]
        for here in range(place, len(order)):
            score = score + queries[line, here] * terms[order[here], found].astype(np.int64)
            competitive = score + left[line, here + 1] >= to_beat[line]
            line, found, score = line[competitive], found[competitive], score[competitive]
        self._take(at[line], score, ids[found])

    def _take(self, line: np.ndarray, score: np.ndarray, vector: np.ndarray) -> None:
        if not len(line):
            return
        touched = np.unique(line)
        line = np.concatenate([np.repeat(touched, self.k), line])
        score, vector = np.concatenate([self.scores[touched].ravel(), score]), np.concatenate([self.ids[touched].ravel(), vector])
        order = np.lexsort((vector, -score, line))
        first = order[np.searchsorted(line[order], touched)[:, None] + np.arange(self.k)]
        self.scores[touched], self.ids[touched] = score[first], vector[first]

    def found(self) -> pa.RecordBatch:
        line, place = np.nonzero(self.scores > NONE)
        columns = [self.query_ids[line], self.ids[line, place], self.scores[line, place]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


def _packed(rows: DataFrame, group: str, dims: int, width: str) -> DataFrame:
    """One row per group: its number, the ids and the weights as bytes. Groups are of bounded size by construction."""
    ship(rows.sparkSession)

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy().astype("<i8")
        weights = _matrix(table.column("v"), dims).astype(width)
        columns = [pa.array([table.column("g")[0].as_py()], pa.int64()), pa.array([ids.tobytes()], pa.binary()), pa.array([weights.tobytes()], pa.binary())]
        return pa.Table.from_arrays(columns, names=["g", "ids", "weights"])

    return rows.withColumn("g", F.col(group)).select("g", "vec_id", "v").groupBy("g").applyInArrow(pack, "g bigint, ids binary, weights binary")


def search(rows: DataFrame, is_query, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows for every row for which ``is_query`` holds.

    ``rows``: vec_id, v (array of long), as from ``quantised``.
    """
    rows = durable(rows, "vectors")
    squares = F.aggregate("v", F.lit(0.0), lambda sum_, x: sum_ + x.cast("double") * x.cast("double"))
    n, n_queries, dims, most, reach = rows.agg(
        F.count("*"), F.coalesce(F.sum(is_query.cast("int")), F.lit(0)), F.coalesce(F.max(F.size("v")), F.lit(0)),
        F.coalesce(F.max(F.greatest(F.array_max(F.transform("v", lambda x: F.abs(x))), F.lit(0))), F.lit(0)),
        F.coalesce(F.max(squares), F.lit(0.0)),
    ).first()
    if most * most * max(dims, 1) >= 2**62 or most < 0:
        raise ValueError(f"components up to {most} in {dims} dimensions: scores could leave 64 bits")
    width = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
    # no sum over some terms of two vectors is larger than the larger of their squared lengths
    kind = "f4" if reach < 2**24 else "f8" if reach < 2**52 else "i8"

    vector = max(dims, 1) * np.dtype(width).itemsize  # bytes
    in_shard, in_block = max(1, min(SHARD_VECTORS, SHARD_BYTES // vector)), max(1, min(QUERY_BLOCK, BLOCK_BYTES // vector))
    n_shards, n_blocks = -(-n // in_shard) or 1, -(-n_queries // in_block) or 1
    shard_groups = -(-n_shards // max(1, TASK_BYTES // (in_shard * vector)))
    block_groups = min(n_blocks, max(1, TASKS // shard_groups))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_shards)))
    shards = _packed(dealt, "shard", dims, width).repartitionById(shard_groups, F.col("g").cast("int"))
    asked = rows.where(is_query).withColumn("block", F.pmod(F.xxhash64("v", "vec_id"), F.lit(n_blocks)))
    blocks = _packed(asked, "block", dims, width).repartitionById(block_groups, F.col("g").cast("int"))
    # without the hint a side may be broadcast by the size of its files, which says little of its size in memory
    pairs = blocks.select("g", F.col("ids").alias("query_ids"), F.col("weights").alias("query_weights")).crossJoin(shards.drop("g").hint("shuffle_replicate_nl"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read(batch: pa.RecordBatch, column: str, row: int, kind: str) -> np.ndarray:
            return np.frombuffer(batch.column(column)[row].as_buffer(), dtype=kind)

        block, asking = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                if (g := batch.column("g")[row].as_py()) != block:  # the shards of a block come one after the other
                    if asking is not None:
                        yield asking.found()
                    ids = read(batch, "query_ids", row, "<i8")
                    block, asking = g, Search(ids, read(batch, "query_weights", row, width).reshape(len(ids), dims), kind, k)
                ids = read(batch, "ids", row, "<i8")
                asking.meet(Postings(ids, read(batch, "weights", row, width).reshape(len(ids), dims), kind))
        if asking is not None:
            yield asking.found()

    found = pairs.select("g", "query_ids", "query_weights", "ids", "weights").mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


SEARCH_SQL = r"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""
