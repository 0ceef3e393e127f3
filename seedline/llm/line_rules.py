"""Quality rules: rules per text, and removal of lines that many documents of a host share.

Lines are normalised (lower case, white space to one blank, digits to 0, trimmed) and hashed. A line counts
once per document (row) of a host (the ``source``). Lines in more than ``MOST_SHARE`` of a host's documents, and in
more than ``LEAST_DOCUMENTS`` of them, are removed: the share means the same at every size, the number keeps hosts of
a few documents whole. A document that keeps less than ``LEAST_LEFT`` of its words, or fewer than ``LEAST_WORDS``, is
rejected.

Null and empty texts have no words and fail the base rules. Equal rows get equal verdicts; a null source is a
host of its own, null ids are kept as they are. Hot lines and hosts are aggregated before each shuffle; frequent lines
are joined back on (host, line), where adaptive execution splits the hot ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .mixing import WORD_GAPS, word_count

LEAST_WORDS = 50
MOST_REPEATED = 0.5  # share of words in repeated three-word windows
MOST_SHARE = 0.05  # of a host's documents that may share a line
LEAST_DOCUMENTS = 5  # that may share a line on any host
LEAST_LEFT = 0.2  # share of words that must remain

HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAPS), lambda w: w != "")


def _covered(w: Column) -> Column:
    """Words within three-word windows that stand twice or more in the array ``w``."""
    # windows by hash with their places, in order of hash, so that equal windows are neighbours
    places = F.sequence(F.lit(0), F.size(w) - 3)
    hashes = F.transform(places, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    any_twice = F.size(F.array_distinct(hashes)) < F.size(hashes)
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(pairs: Column) -> Column:
        same = F.filter(
            F.transform(pairs, lambda x, k: F.when((x["h"] == F.get(pairs, k - 1)["h"]) | (x["h"] == F.get(pairs, k + 1)["h"]), x["i"])),
            lambda i: i.isNotNull(),
        )
        return F.sort_array(same)

    def length(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda i, k: F.coalesce(F.least(F.lit(3), F.get(at, k + 1) - i), F.lit(3))), F.lit(0), lambda a, b: a + b
        )

    # transform over a one-element array binds a value that is used several times
    bound = F.transform(F.array(pairs), lambda p: F.transform(F.array(twice(p)), length))
    return F.when(F.size(w) < 4, 0).when(~any_twice, 0).otherwise(F.get(F.get(bound, F.lit(0)), F.lit(0)))


def base_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(HAS_WORD))
    counted = docs.withColumn("n_words", word_count(whole)).withColumn("word_chars", F.length(F.regexp_replace(whole, WORD_GAPS, "")).cast("bigint"))
    counted = counted.withColumn("n_symbols", F.regexp_count(whole, F.lit(SYMBOLS)).cast("bigint"))
    counted = counted.withColumn("n_dup_lines", F.get(F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x))), F.lit(0)).cast("bigint"))
    repeated = F.get(F.transform(F.array(words(whole)), _covered), F.lit(0))
    counted = counted.withColumn("n_repeat_words", repeated.cast("bigint"))
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def line_key(line: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.lower(line), r"[0-9]", "0"), r"[\x20\x09-\x0D]+", " ")
    return F.xxhash64(F.trim(plain))


def line_counts(keyed: DataFrame) -> DataFrame:
    """host, text_key, whole -> per line of a text: words, documents, each summed over the rows of that text."""
    split = F.transform(
        F.filter(F.split("whole", "\n"), lambda x: x.rlike(HAS_WORD)), lambda x: F.struct(line_key(x).alias("line_key"), word_count(x).alias("words"))
    )

    # in order of key the first of equal lines is marked, so that a document counts once
    def marked(lines: Column) -> Column:
        return F.transform(
            lines,
            lambda x, k: F.struct(
                x["line_key"].alias("line_key"),
                x["words"].alias("words"),
                (~F.get(lines, k - 1)["line_key"].eqNullSafe(x["line_key"])).cast("bigint").alias("documents"),
            ),
        )

    bound = F.get(F.transform(F.array(F.sort_array(split)), marked), F.lit(0))
    exploded = keyed.select("host", "text_key", F.explode(bound).alias("line")).select("host", "text_key", "line.*")
    return exploded.groupBy("host", "text_key", "line_key").agg(F.sum("words").alias("words"), F.sum("documents").alias("documents"))


def shared_lines(lines: DataFrame, hosts: DataFrame, most_share: float = MOST_SHARE, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """host, line_key of the lines above the limit; ``hosts`` has host, host_documents."""
    totals = lines.groupBy("host", "line_key").agg(F.sum("documents").alias("documents")).where(F.col("documents") > least_documents)
    return totals.join(hosts, "host").where(F.col("documents") > most_share * F.col("host_documents")).select("host", "line_key")


def verdicts(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    most_share: float = MOST_SHARE,
    least_documents: int = LEAST_DOCUMENTS,
    least_left: float = LEAST_LEFT,
) -> DataFrame:
    """doc_id, the base statistics, base_failed, removed_words, kept; one row per input row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select("doc_id", F.coalesce(F.col(host), F.lit("\u0000")).alias("host"), F.md5(whole).alias("text_key"), whole.alias("whole"))
    measured = durable(base_statistics(keyed, "whole").drop("whole"), "line-rules")
    hosts = durable(measured.groupBy("host").agg(F.count(F.lit(1)).alias("host_documents")), "line-hosts")
    lines = durable(line_counts(keyed), "line-counts")
    frequent = durable(shared_lines(lines, hosts, most_share, least_documents), "line-frequent")
    # equal texts have equal lines, so each row of a text has an equal part of the words
    gone = lines.join(frequent, ["host", "line_key"]).groupBy("host", "text_key").agg(F.sum(F.expr("words div documents")).alias("removed_words"))
    gone = durable(gone, "line-removed")

    judged = measured.join(gone, ["host", "text_key"], "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("bigint"))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (left < least_left * F.col("n_words")) | (left < LEAST_WORDS)
    return judged.withColumn("kept", ~F.col("base_failed") & ~depleted).drop("host", "text_key")


RULES_SQL = r"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM texts),
windows AS (
  SELECT doc_id, i, CASE WHEN lead(w, 2) OVER places IS NOT NULL THEN hash(w, lead(w, 1) OVER places, lead(w, 2) OVER places) END AS h
  FROM words WINDOW places AS (PARTITION BY doc_id ORDER BY i)),
found AS (SELECT doc_id, i, h IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, h) > 1 AS twice FROM windows),
covered AS (
  SELECT doc_id, count(*) FILTER (twice) AS n
  FROM (SELECT doc_id, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS 2 PRECEDING) AS twice FROM found) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, line,
    trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS plain,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
hosts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
totals AS (SELECT source, plain, count(DISTINCT doc_id) AS n FROM lines GROUP BY source, plain),
frequent AS (SELECT t.source, plain FROM totals t JOIN hosts h ON t.source IS NOT DISTINCT FROM h.source WHERE t.n > 5 AND t.n > 0.05 * h.n),
gone AS (SELECT doc_id, sum(n) AS n FROM lines l JOIN frequent f ON l.plain = f.plain AND l.source IS NOT DISTINCT FROM f.source GROUP BY doc_id),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w) AS n_words, coalesce(length(array_to_string(w, '')), 0) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS removed_words
  FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, n_words < 50 OR n_repeat_words > 0.5 * n_words AS base_failed, removed_words,
  NOT (n_words < 50 OR n_repeat_words > 0.5 * n_words OR n_words - removed_words < 0.2 * n_words OR n_words - removed_words < 50) AS kept
FROM base"""
