"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents stand in a shuffled, repeatable order as one line of words, cut into blocks of nearly
equal size. Golden-ratio points i * phi mod 1, mapped through the cumulative numbers of blocks that the targets
ask for, say which source fills slot i. A source's slots are ranked; the slot of rank r takes block r mod
(number of blocks), so a source that is asked for more than it has starts again, ``REPEATS`` times at most. What a source
gives is what its slots take: as the points' discrepancy is low, it is within a few blocks of its target.

Targets share all words by weight (1, 2, 3, repeating over the sources by code point, null last), none above
``REPEATS`` times its source; the excess is shared again by weight until none is above.

Null texts and texts without words have size 0 and are never taken. Rows equal in id, source and text are one place of
the order and share what is taken of it. A null source is a source, the last one. The block size grows with the root of all words, so slots are fewer than documents at any size.
Nothing here holds all rows of a source in one task: the order's running sums are formed per (source, bucket of
the order) and shifted by the buckets' totals, the slots' ranks likewise per run of ``RUN`` slots.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .columns import free_prefix, quoted

REPEATS = 3  # times that a document may be taken
WEIGHTS = 3  # weights run from 1 to this, repeating
BUCKET_DIGITS = 3  # of a key: 4096 buckets of each source's order
RUN = 1 << 16  # slots ranked together
FINENESS = 16  # blocks per root of all words
GOLDEN = 0.6180339887498949
FEW_SOURCES = 10_000  # rows of about 100 bytes that may be broadcast; beyond, a shuffle join

WORD_GAPS = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null: 0."""
    parts = F.split(text, WORD_GAPS)
    empty = (F.element_at(parts, 1) == "").cast("int") + ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")
    return F.coalesce(F.when(text == "", 0).otherwise(F.size(parts) - empty), F.lit(0)).cast("bigint")


@dataclass
class Mix:
    """sources: source, size, weight, target, blocks, asked, have (slots that the points give it). slots: slot, source, rank, turn, block.
    lines: key, source, doc_id, size, copies (rows equal in all), start. takes: doc_id, source, size, source_size, target,
    taken, first_slot; one row per row of the documents. cuts: source, turns, edge, cut_key, cut_taken: all that a document's
    share follows from."""

    sources: DataFrame
    slots: DataFrame
    lines: DataFrame
    takes: DataFrame
    cuts: DataFrame


def targets(sizes: DataFrame) -> DataFrame:
    """source, size -> source, size, weight, target: one row per source, few enough to be put in order."""
    ranked = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.select("source", "size", ((F.col("place") - 1) % WEIGHTS + 1).cast("bigint").alias("weight"))
    ranked = durable(ranked, "source-weights")
    total, level = ranked.agg(F.sum("size")).first()[0] or 0, 0.0
    while True:  # the level only rises; every round but the last caps at least one source
        capped = F.lit(level) * F.col("weight") > REPEATS * F.col("size")
        fixed, free = ranked.agg(
            F.coalesce(F.sum(F.when(capped, REPEATS * F.col("size"))), F.lit(0)), F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0))
        ).first()
        rises = (total - fixed) / free if free else level
        if rises <= level:
            break
        level = rises
    reached = F.lit(level) * F.col("weight")
    return ranked.withColumn("target", F.when(reached > REPEATS * F.col("size"), (REPEATS * F.col("size")).cast("double")).otherwise(reached))


def line_key(doc_id: Column, source: Column, text: Column) -> Column:
    """32 hex digits by which a source's documents are put in order: the same for the same id, source and text only."""
    told = F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(","), F.md5(F.coalesce(text, F.lit(""))), F.lit(","))
    return F.md5(F.concat(told, F.coalesce(F.concat(F.lit("+"), source), F.lit("-"))))


def _lines(rows: DataFrame) -> DataFrame:
    """key, source, doc_id, size, copies, start: the words of the same source that stand before the rows of a key."""
    made = rows.groupBy("key").agg(F.first("source").alias("source"), F.first("doc_id").alias("doc_id"), F.first("size").alias("size"), F.count("*").alias("copies"))
    made = durable(made.withColumn("words", F.col("size") * F.col("copies")).withColumn("bucket", F.left("key", F.lit(BUCKET_DIGITS))), "mix-order")
    within = Window.partitionBy("source", "bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = made.groupBy("source", "bucket").agg(F.sum("words").alias("bucket_words"))
    totals = durable(totals.withColumn("bucket_start", F.coalesce(F.sum("bucket_words").over(before), F.lit(0))), "mix-buckets")
    placed = made.withColumn("inner", F.coalesce(F.sum("words").over(within), F.lit(0)))
    same = placed["source"].eqNullSafe(totals["source"]) & (placed["bucket"] == totals["bucket"])
    joined = placed.join(totals.select("source", "bucket", "bucket_start"), same).drop(totals["source"]).drop(totals["bucket"])
    return durable(joined.withColumn("start", F.col("bucket_start") + F.col("inner")).drop("inner", "bucket", "bucket_start"), "mix-lines")


def _schedule(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sources with ``have``, slots). The source list is walked once for the cumulative weights; slots stay distributed."""
    spark = sources.sparkSession
    upto = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    asked = durable(sources.withColumn("upper", F.sum("asked").over(upto)), "mix-asked")
    n = asked.agg(F.sum("asked")).first()[0] or 0
    asked = asked.withColumn("lower", F.col("upper") - F.col("asked"))
    points = spark.range(n).select(F.col("id").alias("slot"), (F.floor(((F.col("id") + 1) * F.lit(GOLDEN) % 1.0) * n)).cast("bigint").alias("at"))
    # cells of equal width: a point meets the sources that share its cell, which an exact comparison then decides
    width = max(1, n // 1024)
    cells = asked.where("asked > 0").withColumn("cell", F.explode(F.sequence(F.floor(F.col("lower") / width), F.floor((F.col("upper") - 1) / width))))
    hit = points.withColumn("cell", F.floor(F.col("at") / width)).join(cells.select("cell", "source", "blocks", "lower", "upper"), "cell")
    hit = hit.where((F.col("at") >= F.col("lower")) & (F.col("at") < F.col("upper"))).withColumn("run", F.floor(F.col("slot") / RUN))
    hit = durable(hit.select("slot", "run", "source", "blocks"), "mix-slots")
    counts = hit.groupBy("source", "run").agg(F.count("*").alias("in_run"))
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = durable(counts.withColumn("run_start", F.coalesce(F.sum("in_run").over(before), F.lit(0))), "mix-runs")
    inner = hit.withColumn("inner", F.row_number().over(Window.partitionBy("source", "run").orderBy("slot")) - 1)
    same = inner["source"].eqNullSafe(counts["source"]) & (inner["run"] == counts["run"])
    ranked = inner.join(counts, same).select("slot", inner["source"], "blocks", (F.col("run_start") + F.col("inner")).alias("rank"))
    ranked = ranked.where(F.col("rank") < REPEATS * F.col("blocks"))  # no source is gone through more often
    slots = ranked.select("slot", "source", "rank", F.floor(F.col("rank") / F.col("blocks")).alias("turn"), (F.col("rank") % F.col("blocks")).alias("block"))
    given = counts.groupBy(F.col("source").alias("g")).agg(F.sum("in_run").alias("given"))
    most = F.least(F.coalesce("given", F.lit(0)), REPEATS * F.col("blocks"))
    return asked.join(given, asked["source"].eqNullSafe(given["g"]), "left").withColumn("have", most).drop("g", "given", "upper", "lower"), slots


def _begin(block: Column, size: Column, blocks: Column) -> Column:
    """Where a block begins: blocks cut a line of words into parts that differ by one word at most, the longer ones first."""
    return block * F.floor(size / blocks) + F.least(block, size % blocks)


def _block_of(at: Column, size: Column, blocks: Column) -> Column:
    short, longer = F.floor(size / blocks), size % blocks
    early = longer * (short + 1)
    return F.when(at < early, F.floor(at / (short + 1))).otherwise(longer + F.floor((at - early) / F.greatest(short, F.lit(1))))


def mix(docs: DataFrame, text: str = "text") -> Mix:
    """Schedule all documents."""
    ids = F.col("doc_id").cast("bigint")
    rows = docs.select(ids.alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col(text)).alias("size"), line_key(ids, F.col("source"), F.col(text)).alias("key"))
    rows = durable(rows, "mix-rows")
    lines = _lines(rows)
    sources = targets(lines.groupBy("source").agg(F.sum("words").alias("size")))
    total = sources.agg(F.sum("size")).first()[0] or 0
    block_words = max(1, int(total**0.5) // FINENESS)
    sources = sources.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("size") / block_words)).cast("bigint"))
    sources = durable(sources.withColumn("asked", F.round(F.coalesce(F.try_divide(F.col("target") * F.col("blocks"), "size"), F.lit(0.0))).cast("bigint")), "mix-sources")
    sources, slots = _schedule(sources)
    sources, slots = durable(sources, "mix-shares"), durable(slots, "mix-schedule")

    # whole turns through the source, and one that ends at the edge
    known = sources.select(
        F.col("source").alias("s"), F.col("size").alias("source_size"), "target", "blocks", F.floor(F.col("have") / F.col("blocks")).alias("turns"),
        _begin(F.col("have") % F.col("blocks"), F.col("size"), F.col("blocks")).alias("edge"),
    )
    placed = lines.join(known, lines["source"].eqNullSafe(known["s"])).drop("s")
    inside = F.greatest(F.lit(0), F.least(F.col("start") + F.col("words"), F.col("edge")) - F.col("start"))
    taken = F.floor((F.col("turns") * F.col("words") + inside) / F.col("copies"))  # rows equal in all share alike
    first_block = F.when(F.col("size") > 0, _block_of(F.col("start"), F.col("source_size"), F.col("blocks")))
    shares = placed.select("key", "source", "source_size", "target", "turns", "edge", "start", "words", taken.cast("bigint").alias("taken"), first_block.alias("first_block"))
    shares = durable(shares, "mix-taken")
    first = slots.where("turn = 0").select(F.col("source").alias("p"), F.col("block").alias("b"), F.col("slot").alias("first_slot"))
    shown = shares.join(first, shares["source"].eqNullSafe(F.col("p")) & (F.col("first_block") == F.col("b")), "left")
    shown = durable(shown.select("key", "source_size", "target", "taken", "first_slot"), "mix-shown")
    takes = rows.join(shown, "key").select("doc_id", "source", "size", "source_size", "target", "taken", "first_slot")

    split = (F.col("start") < F.col("edge")) & (F.col("start") + F.col("words") > F.col("edge"))
    half = 2 * (F.col("edge") - F.col("start")) >= F.col("words")
    cuts = shares.groupBy("source").agg(
        F.first("turns").alias("turns"), F.first("edge").alias("edge"), F.max(F.when((F.col("start") + F.col("words") <= F.col("edge")) | (split & half), F.col("key"))).alias("last_key"),
    )
    return Mix(sources, slots, lines, takes, cuts)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: each comes as often as its taken words, in whole documents, are nearest to. Columns of ``docs`` stay.

    A source is gone through in whole turns and one that ends at a key of its order: a row's copies follow from its own key and one
    small row for its source, so texts are neither shuffled nor joined with other documents."""
    cuts = durable(mix(docs).cuts, "mix-cuts")
    p = free_prefix(docs)
    few = cuts.count() <= FEW_SOURCES
    cuts = cuts.select(F.col("source").alias(f"{p}s"), F.col("turns").alias(f"{p}turns"), F.col("last_key").alias(f"{p}last"))
    keyed = docs.withColumn(f"{p}key", line_key(F.col("doc_id").cast("bigint"), F.col("source"), F.col("text"))).withColumn(f"{p}size", word_count(F.col("text")))
    met = keyed.join(F.broadcast(cuts) if few else cuts, keyed["source"].eqNullSafe(F.col(f"{p}s")))
    again = F.coalesce((F.col(f"{p}key") <= F.col(f"{p}last")).cast("int"), F.lit(0))
    copies = F.when(F.col(f"{p}size") > 0, F.col(f"{p}turns") + again).otherwise(0).cast("int")
    return met.withColumn(f"{p}again", F.explode(F.array_repeat(F.lit(True), copies))).select(*quoted(docs))


MIX_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    md5(concat(coalesce(CAST(doc_id AS VARCHAR), '-'), ',', md5(coalesce(text, '')), ',', coalesce('+' || source, '-'))) AS key
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM totals),
by_need AS (SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS place FROM weighed),
levels AS (
  SELECT place, 3.0 * source_size / weight AS need,
    ((SELECT sum(source_size) FROM weighed) - coalesce(3 * sum(source_size) OVER before, 0))::DOUBLE
      / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM by_need WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final AS (SELECT level FROM levels WHERE need >= level ORDER BY place LIMIT 1),
targeted AS (
  SELECT source, source_size, CASE WHEN level * weight > 3 * source_size THEN (3 * source_size)::DOUBLE ELSE level * weight END AS target,
    greatest(1, ceil(source_size / greatest(1, floor(sqrt((SELECT sum(source_size) FROM totals)))::BIGINT // 16)))::BIGINT AS blocks
  FROM weighed CROSS JOIN final),
asked AS (
  SELECT *, coalesce(round(target * blocks / nullif(source_size, 0)), 0)::BIGINT AS asked,
    (sum(coalesce(round(target * blocks / nullif(source_size, 0)), 0)::BIGINT) OVER (ORDER BY source NULLS LAST))::BIGINT AS upper
  FROM targeted),
points AS (
  SELECT i - 1 AS slot, floor(((i * 0.6180339887498949::DOUBLE) % 1.0::DOUBLE) * (SELECT sum(asked) FROM asked)::DOUBLE)::BIGINT AS at
  FROM range(1, (SELECT sum(asked) FROM asked)::BIGINT + 1) r(i)),
hits AS (
  SELECT p.slot, a.source, a.blocks, row_number() OVER (PARTITION BY a.source ORDER BY p.slot) - 1 AS rank
  FROM points p JOIN asked a ON p.at >= a.upper - a.asked AND p.at < a.upper),
given AS (SELECT source, count(*) AS given FROM hits GROUP BY source),
shares AS (
  SELECT a.*, h // blocks AS turns, (h % blocks) * (source_size // blocks) + least(h % blocks, source_size % blocks) AS edge
  FROM (SELECT a.*, least(coalesce(g.given, 0), 3 * blocks) AS h FROM asked a LEFT JOIN given g ON a.source IS NOT DISTINCT FROM g.source) a),
lines AS (
  SELECT key, any_value(source) AS source, any_value(size) AS size, count(*) AS copies FROM rows GROUP BY key),
placed AS (
  SELECT l.*, s.source_size, s.target, s.blocks, s.turns, s.edge, size * copies AS words,
    coalesce(sum(size * copies) OVER (PARTITION BY l.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM lines l JOIN shares s ON l.source IS NOT DISTINCT FROM s.source),
cut AS (
  SELECT *, CASE WHEN size > 0 THEN CASE WHEN start < (source_size % blocks) * (source_size // blocks + 1) THEN start // (source_size // blocks + 1)
      ELSE source_size % blocks + (start - (source_size % blocks) * (source_size // blocks + 1)) // greatest(1, source_size // blocks) END END AS first_block
  FROM placed)
SELECT r.doc_id, r.size::BIGINT AS size, c.source_size, c.target,
  ((c.turns * c.words + greatest(0, least(c.start + c.words, c.edge) - c.start)) // c.copies)::BIGINT AS taken, h.slot AS first_slot
FROM rows r JOIN cut c ON r.key = c.key LEFT JOIN hits h ON h.source IS NOT DISTINCT FROM c.source AND h.rank = c.first_block"""
