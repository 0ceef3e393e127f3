"""Near-duplicate classes: ProbMinHash signatures, banding, exact verification, components.

A text is a set of five-word shingles. ``signatures`` takes weighted sets; all weights are one here, so that the bands
look for the similarity that decides on links, however often a shingle stands in a text. Every shingle is a Poisson
process whose rate is its weight: arrivals at times drawn from its hash, each at one of the signature's registers; a register keeps the
shingle of the earliest arrival. A shingle is given up once its next arrival is later than all registers. Two
signatures agree in a register with the probability Jaccard similarity of the weighted sets, which is the Jaccard
similarity if all weights are one. Bands of registers
that agree make candidates; a link is a pair whose shingle sets have an exact Jaccard similarity of 0.8 or more.

Texts that are equal are one class before anything else, so copies are never paired. Within a bucket, texts are
not paired either: each is compared to the least text of the bucket (first only to the least over all its
buckets) and components are formed. Texts of buckets that still hold several components are then joined by their
rarest shingles: in one order of all shingles, rare ones first, two similar texts have a shingle in common among
the first of either, and enough shingles after it. This exact condition, not the bucket, makes the last pairs, so
a large bucket of texts that are all a little too different costs no pair. Shingles that no other candidate has
bound the similarity of the pairs before. Two linked texts of a common bucket end in one class, whatever the bucket's size.

A text of fewer than five words is one shingle. Null, empty and blank texts are alone in their classes. A null id
has no class (null) and links nothing. Rows are answered one by one, repeated rows alike; a class is named by its
least id. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable, ship
from .components import components, with_links

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 30, 5  # at similarity 0.8 a pair is missed with probability 7e-6
DOCS_AT_ONCE = 1024
WORDS_KEPT = 500_000
FEW = 1_000_000  # ids (8 bytes each) that may be broadcast; beyond, a shuffle join

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


# --- signatures ----------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_words = _Words()


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the five-word windows, in order, repeats included."""
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(WORDS, len(words))
    out = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = out * MULTIPLIER + hashes[k : len(hashes) - width + 1 + k]
    return _mixed(out)


def weighted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and their weights, all one."""
    found = np.unique(shingles(text))
    return found, np.ones(len(found))


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """A row of ``registers`` shingle hashes per non-empty set; zeros for an empty one."""
    sizes = [len(s[0]) for s in sets]
    earliest = np.full(len(sets) * registers, np.inf)
    held = np.zeros(len(sets) * registers, dtype=np.uint64)
    if not sum(sizes):
        return held.reshape(len(sets), registers)
    element = np.concatenate([s[0] for s in sets])
    weight = np.concatenate([s[1] for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    time, arrival = np.zeros(len(element)), 0
    while len(element):
        arrival += 1
        with np.errstate(over="ignore"):
            drawn = _mixed(element + np.uint64(arrival) * MULTIPLIER)
            where = _mixed(drawn + MULTIPLIER)
        time = time - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        at = owner * registers + ((where >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(earliest, at, time)
        first = earliest[at] == time
        held[at[first]] = element[first]
        open_until = earliest.reshape(len(sets), registers).max(axis=1)
        going = time < open_until[owner]
        element, weight, owner, time = element[going], weight[going], owner[going], time[going]
    return held.reshape(len(sets), registers)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, the band's number mixed in."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), bands)).copy()
    with np.errstate(over="ignore"):
        for k in range(rows):
            key = _mixed(key * MULTIPLIER + parts[:, :, k])
    return key.astype(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays without repeats."""
    if not len(a) or not len(b):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def signed(docs: DataFrame, text: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, text_key, n (distinct shingles), bands (array of long): one row per input row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(start, DOCS_AT_ONCE)
                texts = part.column(1).to_pylist()
                sets = [weighted(t) for t in texts]
                keys = band_keys(signatures(sets, bands * rows), bands, rows)
                md5 = [hashlib.md5((t or "").encode("utf-8", "surrogatepass")).hexdigest() for t in texts]
                ends = pa.array(np.arange(len(texts) + 1) * bands, pa.int32())
                columns = [part.column(0), pa.array(md5), pa.array([len(s[0]) for s in sets], pa.int64()), pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "n", "bands"])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id bigint, text_key string, n bigint, bands array<bigint>")


# --- links ---------------------------------------------------------------------------


def _by_size(ids: DataFrame) -> DataFrame:
    """A written table of ids, marked for broadcast if it is small by count."""
    return F.broadcast(ids) if ids.count() <= FEW else ids


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Of the pairs a, b those with similar texts. ``texts``: node, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @functools.lru_cache(maxsize=64)
        def of(node: int, text: str) -> np.ndarray:
            return np.unique(shingles(text))

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            good = [
                jaccard(of(x, t), of(y, u)) >= similarity for x, y, t, u in zip(a, b, batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(good, pa.bool_())) for i in (0, 1)], names=["a", "b"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return durable(both.mapInArrow(run, "a bigint, b bigint"), "links-verified")


def _rooted(nodes: DataFrame, roots: DataFrame, node: str, name: str) -> DataFrame:
    """Add the component of column ``node``."""
    r = roots.select(F.col("node").alias(node), F.col("root").alias(name))
    return nodes.join(r, node, "left").withColumn(name, F.coalesce(name, node))


def _reach(n: Column, shared: Column, other_n: Column, other_shared: Column, similarity: float) -> Column:
    """Whether two texts can be similar at all: their common shingles are at most the lesser of ``shared``."""
    return F.least(shared, other_shared) * (1 + similarity) >= similarity * (n + other_n) - 1e-6


def _shared(rows: DataFrame, lone: DataFrame, node: str, n: str, name: str) -> DataFrame:
    """Add how many shingles of column ``node`` other texts have too."""
    found = lone.select(F.col("node").alias(node), "lone")
    return rows.join(found, node, "left").withColumn(name, F.col(n) - F.coalesce("lone", F.lit(0))).drop("lone")


def _shingle_rows(texts: DataFrame) -> DataFrame:
    """node, n, shingle: a row per text and distinct shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sets = [np.unique(shingles(t)).astype(np.int64) for t in part.column(1).to_pylist()]
                sizes = np.array([len(x) for x in sets], dtype=np.int64)
                owner = np.array(part.column(0).to_pylist(), dtype=np.int64)
                columns = [np.repeat(owner, sizes), np.repeat(sizes, sizes), np.concatenate(sets)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["node", "n", "shingle"])

    return texts.select("node", "text").mapInArrow(run, "node bigint, n bigint, shingle bigint")


def _rarest(rows: DataFrame, counts: DataFrame, similarity: float) -> DataFrame:
    """node, n, shingle, rest: of each text the rarest shingles, as many as leave too few others for a similar text.

    ``rest``: shingles of the text from this one on, itself included, rare ones first. Shingles that one text alone
    has come first of all and join nothing; they are left out without changing ``rest``, which counts from the end."""
    from_end = Window.partitionBy("node").orderBy(F.desc("texts"), F.desc("shingle"))
    common = rows.join(counts.where("texts > 1").select("shingle", "texts"), "shingle")
    return common.withColumn("rest", F.row_number().over(from_end).cast("bigint")).where(F.col("rest") >= similarity * F.col("n") - 1e-6).drop("texts")


def classes(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_key, class_id; one row per input row."""
    signs = durable(signed(docs, text), "signatures")
    usable = signs.where("doc_id IS NOT NULL AND n > 0")
    nodes = usable.groupBy("text_key").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    nodes = durable(nodes, "distinct-texts")

    banded = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    heads = banded.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("head"), F.max("node").alias("last"))
    heads = durable(heads.where("head.node < last").select("bucket", F.col("head.node").alias("head"), F.col("head.n").alias("head_n")), "bucket-heads")
    members = durable(banded.join(heads, "bucket"), "bucket-members")

    wanted = durable(members.select("node").distinct(), "candidates")
    ids = docs.select(F.col("doc_id").cast("bigint").alias("node"), F.col(text).cast("string").alias("text"))
    texts = durable(ids.join(_by_size(wanted), "node").groupBy("node", F.md5("text").alias("text_key")).agg(F.first("text").alias("text"))
                    .join(nodes.select("node", "text_key"), ["node", "text_key"]).select("node", "text"), "candidate-texts")

    # what two texts have in common is at most what the one with less has in common with anything
    rows = durable(_shingle_rows(texts), "shingles")
    counts = durable(rows.groupBy("shingle").agg(F.count("*").alias("texts"), F.min("node").alias("node")), "shingle-counts")
    lone = durable(counts.where("texts = 1").groupBy("node").agg(F.count("*").alias("lone")), "lone-shingles")
    rarest = durable(_rarest(rows, counts, similarity), "rarest-shingles")
    members = durable(_shared(_shared(members, lone, "node", "n", "shared"), lone, "head", "head_n", "head_shared"), "members-shared")

    # each text with the least of the heads of its buckets
    fits = members.where((F.col("node") != F.col("head")) & _reach(F.col("n"), F.col("shared"), F.col("head_n"), F.col("head_shared"), similarity))
    first = durable(fits.groupBy("node").agg(F.min("head").alias("head")), "pairs-first")
    roots = components(_verified(first.select(F.col("head").alias("a"), F.col("node").alias("b")), texts, similarity))

    # with the other heads, where these are still elsewhere
    apart = _rooted(_rooted(fits.select("node", "head").distinct(), roots, "node", "root"), roots, "head", "head_root")
    apart = apart.where("root <> head_root").join(first, ["node", "head"], "left_anti")
    second = durable(apart.select(F.col("head").alias("a"), F.col("node").alias("b")), "pairs-second")
    roots = with_links(roots, _verified(second, texts, similarity))

    # what is still elsewhere in a common bucket, by rare shingles in common
    placed = durable(_rooted(members.select("bucket", "node"), roots, "node", "root"), "members-placed")
    mixed = durable(placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("bucket"), "buckets-mixed")
    unsettled = durable(placed.join(mixed, "bucket").select("node", "root").distinct(), "nodes-unsettled")
    rare = durable(rarest.join(unsettled, "node"), "rarest-unsettled")
    mixed = durable(rare.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("shingle"), "shingles-mixed")
    rare = durable(rare.join(mixed, "shingle"), "rarest-mixed")
    other = rare.select("shingle", *[F.col(c).alias(f"b_{c}") for c in ("node", "n", "root", "rest")]).withColumnRenamed("b_node", "b")
    reach = _reach(F.col("n"), F.col("rest"), F.col("b_n"), F.col("b_rest"), similarity)
    cross = rare.join(other, "shingle").where((F.col("root") != F.col("b_root")) & (F.col("node") < F.col("b")) & reach)
    compared = first.select(F.col("head").alias("a"), F.col("node").alias("b")).unionByName(second)
    third = durable(cross.select(F.col("node").alias("a"), "b").distinct().join(compared, ["a", "b"], "left_anti"), "pairs-third")
    roots = with_links(roots, _verified(third, texts, similarity))

    classed = durable(_rooted(nodes.select("node", "text_key"), roots, "node", "root").select("text_key", "root"), "text-classes")
    out = signs.select("doc_id", "text_key", "n").join(classed, "text_key", "left")
    return out.select("doc_id", "text_key", F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("doc_id"))).alias("class_id"))


def representatives(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stand for their classes, with the columns of ``docs``.

    A row goes if its class is named by another id; of rows equal in id and text one stays. Rows without id stay.
    """
    found = durable(classes(docs, text, similarity), "classes")
    gone = durable(found.where("class_id <> doc_id").select("doc_id", "text_key").distinct(), "not-representative")
    again = durable(found.where("doc_id IS NOT NULL").groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key"), "repeated-rows")
    keyed = docs.withColumn("_text_key", text_key(F.col(text)))
    same = [(keyed["doc_id"] == t["doc_id"]) & (keyed["_text_key"] == t["text_key"]) for t in (gone, again)]
    rest = keyed.join(_by_size(gone), same[0], "left_anti")
    single = rest.join(_by_size(again), same[1], "left_anti")
    repeated = rest.join(_by_size(again), same[1], "left_semi").dropDuplicates(["doc_id", "_text_key"])
    return single.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])
