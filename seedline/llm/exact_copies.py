"""Exact duplicates by progressive refinement: length, then hash of the beginning, then hash of the whole text.

Texts are equal when identical after deleting every character of ``[\\x20\\x09-\\x0D]``. One scan measures each text
(length without white space, hash of its first ``HEAD`` characters). Texts whose length stands alone leave first,
then those whose (length, beginning) stands alone; a second scan takes the full hash of what is left, and only equal
full hashes make a group. Who is left is handed to the scan as a sieve: one bit per slot of a hash of the key, set
where more than one text fell into the slot. A sieve has the same size (1 MB) for any table, so it is broadcast; a slot that two different keys share costs a full hash and changes no result. No text is ever shuffled.

Of a group the row with the most code points in its original text stays, then the smallest id (null last), then
the first of rows equal in both. Null, empty and blank texts are equal to each other. Rows are answered one by one, repeated rows
too; extra columns are ignored by ``groups`` and kept by ``deduplicated``; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .columns import free_prefix, quoted
from .sieve import shared, sieve

HEAD = 64  # characters of the beginning
WHITE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without white space; null: empty."""
    out = F.coalesce(text, F.lit(""))
    for character in WHITE:
        out = F.replace(out, F.lit(character), F.lit(""))
    return out


def _chars(text: str) -> Column:
    return F.coalesce(F.length(F.col(text)), F.lit(0)).cast("bigint")


def _measured(docs: DataFrame, text: str) -> DataFrame:
    """doc_id, chars, whole, n, head. ``whole`` is the normalised text, for expressions of the same scan."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _chars(text).alias("chars"), normalised(F.col(text)).alias("whole"))
    return rows.withColumn("n", F.length("whole").cast("bigint")).withColumn("head", F.xxhash64(F.left("whole", F.lit(HEAD))))


def judged(docs: DataFrame, text: str = "text", digests: bool = False) -> DataFrame:
    """row, doc_id, chars, n, head, full (sha256 of the normalised text of the rows left by the refinement, else null); with
    ``digests`` also sha256 of every row. Written down."""
    measured = durable(_measured(docs, text).drop("whole"), "copies-measured")
    lengths = durable(sieve(measured, "n"), "copies-lengths")
    beginnings = durable(sieve(shared(measured, lengths, "left", "n").where("left"), "n", "head"), "copies-beginnings")
    rows = shared(shared(_measured(docs, text), lengths, "by_length", "n"), beginnings, "by_head", "n", "head")
    digest = F.sha2("whole", 256)
    columns = ["doc_id", "chars", "n", "head", F.when(F.col("by_length") & F.col("by_head"), digest).alias("full")]
    rows = rows.select(*columns, *([digest.alias("sha256")] if digests else []))
    return durable(rows.withColumn("row", F.monotonically_increasing_id()), "copies-judged")


def groups(docs: DataFrame, text: str = "text", digests: bool = False) -> DataFrame:
    """row, doc_id, chars, full, keep_id, group_size, kept (and sha256 with ``digests``); one row per input row."""
    rows = judged(docs, text, digests)
    first = F.min(F.struct((-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    made = rows.where("full IS NOT NULL").groupBy(F.col("full").alias("g_full")).agg(F.count("*").alias("g_size"), first)
    made = durable(made.where("g_size > 1").select("g_full", "g_size", F.col("first.doc_id").alias("g_keep"), F.col("first.row").alias("g_row")), "copies-groups")
    carried = ["row", "doc_id", "chars", "full", *(["sha256"] if digests else [])]
    alone = F.col("g_size").isNull()
    met = rows.where("full IS NOT NULL").join(made, F.col("full") == F.col("g_full"), "left").select(
        *carried, F.when(alone, F.col("doc_id")).otherwise(F.col("g_keep")).alias("keep_id"), F.coalesce("g_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("row") == F.col("g_row"))).alias("kept"),
    )
    single = rows.where("full IS NULL").select(*carried, F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"))
    return met.unionByName(single)


def deduplicated(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Of rows equal in id, length and normalised text one stays.

    Rows outside the sieve of the keys that lose a row pass as they are; only the others are joined with these keys."""
    found = durable(groups(docs, text).where("full IS NOT NULL"), "copies-found")
    same = found.groupBy("doc_id", "chars", "full").agg(F.count("*").alias("times"), F.max("kept").alias("stays"))
    same = durable(same.where("times > 1 OR NOT stays"), "copies-decided")
    p = free_prefix(docs)
    key = {f"{p}id": F.col("doc_id").cast("bigint"), f"{p}chars": _chars(text), f"{p}full": F.sha2(normalised(F.col(text)), 256)}
    same = same.select(*[F.col(c).alias(f"{p}{k}") for c, k in (("doc_id", "d"), ("chars", "c"), ("full", "f"), ("times", "times"), ("stays", "stays"))])
    bits = durable(sieve(same, f"{p}d", f"{p}f", least=1), "copies-touched")
    marked = shared(docs.withColumns(key), bits, f"{p}hit", f"{p}id", f"{p}full")
    equal = F.col(f"{p}id").eqNullSafe(F.col(f"{p}d")) & (F.col(f"{p}chars") == F.col(f"{p}c")) & (F.col(f"{p}full") == F.col(f"{p}f"))
    met = marked.where(f"{p}hit").join(same, equal, "left")
    once = met.where(f"{p}stays").dropDuplicates([f"{p}id", f"{p}chars", f"{p}full"])
    parts = [marked.where(~F.col(f"{p}hit")), met.where(F.col(f"{p}times").isNull()), once]
    out = [part.select(*quoted(docs)) for part in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


COPIES_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(length(text), 0) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
w AS (
  SELECT doc_id, text_sha256, first_value(doc_id) OVER g AS keep_id, row_number() OVER g AS place, count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t WINDOW g AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, place = 1 AS kept, text_sha256 FROM w"""
