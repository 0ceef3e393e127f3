"""Spelling variants: words one inserted, deleted or replaced character apart, by a dictionary of trie-node pairs.

The words' prefixes are the nodes of a trie, their suffixes those of the trie of the reversed words; both are
numbered. A word cut before its i-th character is a pair of integers (node of what stands before, node of what stands after); cut
around the i-th character it is the pair of the word with that character skipped. Equal pairs of two words that skip
a character each are a replacement; a skipped pair equal to another word's plain cut is a deletion, seen from the
other word an insertion. So one equality join of integer pairs gives exactly the words at distance one. Of equal
characters in a row only the first is skipped for deletions, so no link comes twice. A pair is shared by at most
as many words as there are letters, plus the one that is cut there.

Nodes near the root, which most words share, are numbered from their characters and never joined; the others
get numbers from a written dictionary of distinct nodes (known by running 128-bit digests, so that a word costs time in
proportion to its length).

Words of a text: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z in lower case; occurrences are counted per batch of texts
before they are shuffled. Null and empty texts have none; a null id counts as an empty one in the digest that picks the
runs to be shortened. Repeated rows count as often as they come. A run of any length is a word. Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable, ship

LEAST_LENGTH, LEAST_COUNT = 6, 5
SHORTENED = 199  # one run in so many loses a character
RATIO = 5  # a form is so many times as frequent as the word
SHALLOW = 2  # nodes of so many characters are numbered by rule
COUNTED_AT_ONCE = 200_000  # distinct words held by a task

LETTERS = bytes(range(ord("a"), ord("z") + 1)) + bytes(range(0xC0, 0x100))
# bytes of Latin-1 text: A-Z to lower case, letters as they are, all else to blanks
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b in LETTERS else 32 for b in range(256))


# --- words ---------------------------------------------------------------------------


def words_of(doc_id: int | None, text: str) -> Iterator[tuple[bytes, int]]:
    """Latin-1 words of at least ``LEAST_LENGTH`` characters with their number, the drawn ones shortened."""
    # a character outside Latin-1 is no letter here, nor is the mark that stands for it
    found = Counter(text.encode("latin-1", "replace").translate(FOLDED).split())
    drawn = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in found.items():
        if len(word) >= LEAST_LENGTH:
            h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), drawn)
            if h % SHORTENED == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
                if len(word) < LEAST_LENGTH:
                    continue
            yield word, n


def counted(docs: DataFrame, text: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words with at least so many occurrences."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def emptied() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, body in zip(batch.column(0), batch.column(1)):
                if body.is_valid:
                    for word, n in words_of(doc_id.as_py(), body.as_py()):
                        held[word] = held.get(word, 0) + n
                    if len(held) >= COUNTED_AT_ONCE:
                        yield emptied()
        yield emptied()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counts = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least)


# --- nodes and pairs -----------------------------------------------------------------


def _numbers_by_rule(word: str) -> list[int]:
    """Numbers of the nodes of at most ``SHALLOW`` characters: the characters as digits."""
    out = [0]
    for character in word[:SHALLOW]:
        out.append(out[-1] << 21 | ord(character) + 1)
    return out


def _digests(word: str) -> list[bytes | None]:
    """A digest for each longer prefix; null for the nodes numbered by rule."""
    running, out = blake2b(digest_size=16), []
    for at, character in enumerate(word):
        running.update(character.encode("utf-8", "surrogatepass"))
        if at >= SHALLOW:
            out.append(running.copy().digest())
    return [None] * (len(word) + 1 - len(out)) + out


def cuts(words: DataFrame) -> DataFrame:
    """word, n, skips, first, and the nodes before and after: number by rule, or digest. A row per plain cut and per skipped character.

    ``first``: the skipped character is the first of equal ones in a row."""
    ship(words.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "n", "skips", "first", "before", "before_digest", "after", "after_digest"]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                size = len(word)
                before, after = (_numbers_by_rule(w) for w in (word, word[::-1]))
                before, after = ([*x, *[None] * (size + 1 - len(x))] for x in (before, after))
                before_digest, after_digest = _digests(word), _digests(word[::-1])
                at = [(i, i) for i in range(size + 1)] + [(i, i + 1) for i in range(size)]
                first = [False] * (size + 1) + [i == 0 or word[i] != word[i - 1] for i in range(size)]
                for start in range(0, len(at), 4096):
                    part = at[start : start + 4096]
                    columns = [
                        [word] * len(part), [n] * len(part), [j > i for i, j in part], first[start : start + 4096], [before[i] for i, _ in part],
                        [before_digest[i] for i, _ in part], [after[size - j] for _, j in part], [after_digest[size - j] for _, j in part],
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = "word string, n bigint, skips boolean, first boolean, before bigint, before_digest binary, after bigint, after_digest binary"
    return words.select("word", "n").mapInArrow(run, schema)


def _numbered(rows: DataFrame, side: str) -> DataFrame:
    """The nodes of one trie, all as integers: those by rule as they are, the others from a dictionary, below zero."""
    digest = f"{side}_digest"
    deep = rows.where(F.col(digest).isNotNull())
    nodes = deep.select(digest).distinct().withColumn("number", -1 - F.monotonically_increasing_id())
    nodes = durable(nodes, f"trie-{side}")
    found = deep.drop(side).join(nodes, digest).withColumnRenamed("number", side)
    return rows.where(F.col(digest).isNull()).unionByName(found).drop(digest)


def pairs(words: DataFrame) -> DataFrame:
    """word, n, skips, first, before, after: the dictionary of node pairs, written down."""
    rows = durable(cuts(words), "spelling-cuts")
    rows = durable(_numbered(rows, "before"), "spelling-before")
    return durable(_numbered(rows, "after"), "spelling-pairs")


def neighbours(words: DataFrame) -> DataFrame:
    """word, near, near_n: every two words at distance one, from both ends. ``words``: word (distinct), n."""
    cut = pairs(words)
    skipped = cut.where("skips").select("before", "after", "word", "n", "first")
    other = cut.select("before", "after", "skips", F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = skipped.join(other, ["before", "after"]).where((F.col("word") != F.col("near")) & (F.col("skips") | F.col("first")))
    met = durable(met.select("word", "n", "skips", "near", "near_n"), "spelling-links")
    inserted = met.where(~F.col("skips")).select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return met.select("word", "near", "near_n").unionByName(inserted)


# --- forms ---------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """word, root from word, form (not null): forms followed to the last one, twice as far in every round."""
    current = durable(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = durable(current.join(further, "root", "left"), "spelling-followed")
        if moved.where("next IS NOT NULL").isEmpty():
            return current
        current = moved.select("word", F.coalesce("next", "root").alias("root"))


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word. ``words``: word (distinct), n."""
    words = durable(words.select("word", "n"), "spelling-words")
    largest = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("largest")
    near = durable(neighbours(words).groupBy("word").agg(F.count("*").alias("n_near"), largest), "spelling-near")
    most = -F.col("largest.minus")
    reached = most >= ratio * F.col("n")
    out = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(reached, F.col("largest.near")).alias("form"), F.when(reached, most).alias("form_n")
    )
    out = durable(out, "spelling-variants")
    followed = roots(out.where("form IS NOT NULL"))
    met = out.join(followed, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return met.select("word", "form", "root", "n", "n_near", "form_n")
