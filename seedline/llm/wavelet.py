"""Token-id files as wavelet matrices.

A shard holds the ids of a run of documents as one bit-plane per bit, highest first. Each plane is stored in
the order the planes above it leave (zeros first, both kept in order), with the number of ones before every
``BLOCK`` bits, so that rank is one look-up and one small count, and select a binary search. One shard is one
row of a compressed Parquet file; files and shards follow ascending document id.

Columns: part, shard (place in the part), n_tokens, bits, zeros (per plane), planes and ranks (all planes, one
after the other), doc_ids, doc_tokens.

Null and empty texts are documents with the end id alone. Documents of equal id (repeated rows) are all
written, next to each other, in the order of their texts; a null id comes first. Strings of special tokens in a text get the ids
that the library gives them. An empty table gives no shard.
Extra input columns are not stored.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import string
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, ship

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
SHARD_TOKENS = 1 << 20  # a shard is closed after the document that reaches this many ids
BLOCK = 512  # bits between stored counts of ones
WORDS_KEPT = 1_000_000  # entries of a worker's table before it is cut back
WORDS_LEFT = 200_000  # entries left then: those met first, which are the frequent ones
MARK = "\x01"  # stands between words encoded in one call
BYTES_AT_ONCE = 8 << 20  # of texts encoded together

# How byte-level vocabularies show bytes: printable ones of Latin-1 as they are, the others as the characters from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
SHOWN = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}

# How the default vocabulary's file normalises and cuts texts.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

SHARD_SCHEMA = (
    "part int, shard bigint, n_tokens bigint, bits int, zeros array<bigint>, planes binary, ranks binary, "
    "doc_ids array<bigint>, doc_tokens array<bigint>"
)


# --- one shard -----------------------------------------------------------------------


def build(ids: np.ndarray, bits: int) -> tuple[list[int], bytes, bytes]:
    """Zeros per plane, the packed planes, and the counts of ones before each block."""
    zeros, planes, ranks = [], [], []
    for shift in range(bits - 1, -1, -1):
        ones = (ids & ids.dtype.type(1 << shift)) != 0
        packed = np.packbits(ones)
        planes.append(packed.tobytes())
        full = np.zeros(-(-len(ids) // BLOCK) * BLOCK // 8, dtype=np.uint8)
        full[: len(packed)] = packed
        per_block = np.bitwise_count(full.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.uint32)
        ranks.append((np.cumsum(per_block, dtype=np.uint32) - per_block).astype("<u4").tobytes())
        left = ids[np.flatnonzero(~ones)]  # by place: quicker than by mask on mixed bits
        zeros.append(len(left))
        ids = np.concatenate([left, ids[np.flatnonzero(ones)]])
    return zeros, b"".join(planes), b"".join(ranks)


class Shard:
    """Reading access to one stored shard."""

    def __init__(self, n_tokens: int, bits: int, zeros: list[int], planes: bytes, ranks: bytes) -> None:
        self.n, self.bits, self.zeros = n_tokens, bits, zeros
        self.planes = np.frombuffer(planes, dtype=np.uint8).reshape(bits, -1)
        self.ranks = np.frombuffer(ranks, dtype="<u4").reshape(bits, -1)

    def ones_before(self, plane: int, at: int) -> int:
        if at == 0:
            return 0
        block = (at - 1) // BLOCK
        start = block * BLOCK // 8
        inside = np.unpackbits(self.planes[plane, start : -(-at // 8)], count=at - block * BLOCK)
        return int(self.ranks[plane, block]) + int(inside.sum())

    def bit(self, plane: int, at: int) -> int:
        return int(self.planes[plane, at >> 3] >> (7 - (at & 7))) & 1

    def access(self, at: int) -> int:
        """The id at a place."""
        value = 0
        for plane in range(self.bits):
            bit, ones = self.bit(plane, at), self.ones_before(plane, at)
            value = value << 1 | bit
            at = self.zeros[plane] + ones if bit else at - ones
        return value

    def _range(self, token: int, start: int, stop: int) -> tuple[int, int]:
        for plane in range(self.bits):
            low, high = self.ones_before(plane, start), self.ones_before(plane, stop)
            if token >> (self.bits - 1 - plane) & 1:
                start, stop = self.zeros[plane] + low, self.zeros[plane] + high
            else:
                start, stop = start - low, stop - high
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """How often an id stands in a range of places."""
        if token >> self.bits or token < 0:
            return 0
        start, stop = self._range(token, start, self.n if stop is None else stop)
        return stop - start

    def _select(self, plane: int, bit: int, k: int) -> int:
        """The place of the k-th (from 0) one or zero of a plane."""
        before = self.ranks[plane].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        start = block * BLOCK // 8
        inside = np.unpackbits(self.planes[plane, start : start + BLOCK // 8])[: self.n - block * BLOCK]
        return block * BLOCK + int(np.flatnonzero(inside == bit)[k - int(before[block])])

    def locate(self, token: int, k: int) -> int:
        """The place of the k-th (from 0) occurrence of an id; -1 if there are fewer."""
        if token >> self.bits or token < 0:
            return -1
        start, stop = self._range(token, 0, self.n)
        if k < 0 or start + k >= stop:
            return -1
        at = start + k
        for plane in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - plane) & 1
            at = self._select(plane, bit, at - self.zeros[plane] if bit else at)
        return at

    def tokens(self) -> np.ndarray:
        """All ids, in order."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        ids = np.zeros(self.n, dtype=kind)
        for plane in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[plane], count=self.n).view(bool)
            up = np.empty(self.n, dtype=kind)
            up[np.flatnonzero(ones)] = ids[self.zeros[plane] :] | kind(1 << (self.bits - 1 - plane))
            up[np.flatnonzero(~ones)] = ids[: self.zeros[plane]]
            ids = up
        return ids


# --- encoding ------------------------------------------------------------------------


def _splits_at_blanks(path: str) -> bool:
    """Whether the file's tokens never reach over a blank or line end, and letters never share one with what stands behind them."""
    with open(path, encoding="utf-8") as file:
        config = json.load(file)
    return config.get("normalizer") == NORMALIZER and config.get("pre_tokenizer") == PRE_TOKENIZER


class Encoder:
    """The library's tokenizer with a table of words it has seen; one per worker and file.

    The default vocabulary's pattern drops white space and never matches across it, so a text's ids are the ids of
    its words, split at blanks and line ends. New words are encoded in one call with a mark between them. With any other
    file whole texts are encoded, one by one.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.by_words = _splits_at_blanks(path)
        self.bits = max(1, (self.library.get_vocab_size() - 1).bit_length())
        self.kind = np.dtype("<u2" if self.bits <= 16 else "<u4")
        self.mark = self._ids(MARK)
        self.known: dict[str, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, words: list[str]) -> None:
        """Letters and the punctuation behind them never share an id, and letters lose their case: so such
        words are put together from their two parts, and only parts not seen before are encoded."""
        parts = [_parts(word) for word in words]
        known = self.known
        self._encode_new(list({x for pair in parts for x in pair}.difference(known)))
        for word, pair in zip(words, parts):
            known[word] = known[pair[0]] if len(pair) == 1 else known[pair[0]] + known[pair[1]]

    def _encode_new(self, words: list[str]) -> None:
        tokenize, kind = self.library.model.tokenize, self.kind
        for word in words:
            if word.isalpha() and word == word.lower() and (word.isascii() or unicodedata.is_normalized("NFC", word)):
                # normalised and one match of the pattern: only the model is left to apply, on bytes shown as characters
                shown = word if word.isascii() else word.encode().decode("latin-1").translate(SHOWN)
                self.known[word] = np.array([token.id for token in tokenize(shown)], dtype=kind).tobytes()
        words = [w for w in words if w not in self.known]
        together = [w for w in words if MARK not in w] if len(self.mark) == 1 else []
        for at in range(0, len(together), 2000):
            part = together[at : at + 2000]
            ids = np.array(self._ids(f" {MARK} ".join(part)), dtype=self.kind)
            cuts = np.flatnonzero(ids == self.mark[0])
            if len(cuts) != len(part) - 1:  # the mark's id came up inside a word
                continue
            raw, width = ids.tobytes(), self.kind.itemsize
            starts, stops = [0, *((cuts + 1) * width).tolist()], [*(cuts * width).tolist(), len(raw)]
            self.known.update((word, raw[start:stop]) for word, start, stop in zip(part, starts, stops))
        for word in words:
            if word not in self.known:
                self.known[word] = np.array(self._ids(word), dtype=self.kind).tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each text has."""
        if not self.by_words:
            each = [np.array(self._ids(text or ""), dtype=self.kind) for text in texts.to_pylist()]
            return np.concatenate([np.empty(0, self.kind), *each]), np.array([len(x) for x in each], dtype=np.int64)
        words = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        ends = words.offsets.to_numpy() - words.offsets[0].as_py()
        named = words.flatten().dictionary_encode()
        distinct, places = named.dictionary.to_pylist(), named.indices.to_numpy()
        if len(self.known) + len(distinct) > WORDS_KEPT:
            self.known = dict(itertools.islice(self.known.items(), WORDS_LEFT))
        if new := [word for word in distinct if word not in self.known]:
            self._learn(new)
        found = [self.known[word] for word in distinct]
        ids = np.frombuffer(b"".join(found), dtype=self.kind)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // self.kind.itemsize
        # every word's ids are copied to its places: from where they stand in ``ids`` to where they stand in the texts
        size = sizes[places]
        upto = np.concatenate([[0], np.cumsum(size)])
        source = np.repeat((np.cumsum(sizes) - sizes)[places] - upto[:-1], size) + np.arange(upto[-1])
        return ids[source], np.diff(upto[ends])


def _parts(word: str) -> tuple[str, ...]:
    """A word of letters as (letters, punctuation behind them); ASCII letters in lower case, as the library makes them."""
    letters = word.rstrip(string.punctuation)
    if not letters.lower().isalpha():  # İ gains a mark in lower case, which goes with the punctuation
        return (word,)
    lower = letters.lower() if letters.isascii() else letters
    return (lower,) if len(letters) == len(word) else (lower, word[len(letters) :])


def portions(texts: pa.Array, most: int = BYTES_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Runs of rows (start, length) of about so many bytes, a row at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield start, at - start
            start, held = at, 0
        held += size + 1
    if start < len(sizes):
        yield start, len(sizes) - start


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# --- files ---------------------------------------------------------------------------


def write(
    docs: DataFrame, path: str, text: str = "text", vocabulary: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Encode and write all documents, ordered by id. One range shuffle of the texts; each task streams its rows."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, part, shard = encoder(vocabulary or public_tokenizers.path(VOCABULARY)), TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        doc_tokens: list[int] = []

        def close() -> pa.RecordBatch:
            nonlocal shard
            ids = np.concatenate(held)
            zeros, planes, ranks = build(ids, coder.bits)
            row = (part, shard, len(ids), coder.bits, zeros, planes, ranks, doc_ids[:], doc_tokens[:])
            kinds = (
                pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()),
            )
            for kept in (held, doc_ids, doc_tokens):
                kept.clear()
            shard += 1
            names = ["part", "shard", "n_tokens", "bits", "zeros", "planes", "ranks", "doc_ids", "doc_tokens"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        size = 0
        for batch in batches:
            for start, length in portions(batch.column(1)):
                ids, counts = coder.encode(batch.column(1).slice(start, length))
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
                at = first = 0  # ids and documents of the portion that are in a shard already
                upto = np.cumsum(counts)
                docs_here = batch.column(0).slice(start, length).to_pylist()
                while first < len(counts):
                    # up to the document that fills the shard
                    last = int(np.searchsorted(upto, at + shard_tokens - size))
                    full = last < len(counts)
                    last = min(last, len(counts) - 1)
                    held.append(ids[at : upto[last]])
                    doc_ids += docs_here[first : last + 1]
                    doc_tokens += counts[first : last + 1].tolist()
                    size += int(upto[last]) - at
                    at, first = int(upto[last]), last + 1
                    if full:
                        yield close()
                        size = 0
        if held:
            yield close()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, SHARD_SCHEMA).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def starts(shards: DataFrame) -> DataFrame:
    """part, shard, start: the ids in all shards before it. One row per part meets in one window, the rest per part."""
    sizes = shards.select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inner = sizes.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return inner.join(parts, "part").select("part", "shard", (F.col("part_start") + F.col("inner")).alias("start"))


def documents(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the stored planes."""
    ship(shards.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = Shard(row["n_tokens"], row["bits"], row["zeros"], row["planes"], row["ranks"]).tokens()
                ends = np.cumsum(row["doc_tokens"])
                raw = ids.astype("<u4")
                sums = [zlib.crc32(raw[e - n : e]) for e, n in zip(ends.tolist(), row["doc_tokens"])]
                n = len(sums)
                columns = [
                    pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int64()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array(ends - np.array(row["doc_tokens"]), pa.int64()), pa.array(row["doc_tokens"], pa.int64()), pa.array(sums, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "shard", "doc_id", "local_start", "n_tokens", "ids_crc32"])

    schema = "part int, shard bigint, doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint"
    found = shards.mapInArrow(run, schema).join(starts(shards), ["part", "shard"])
    return found.select("doc_id", (F.col("start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """part, shard, occurrences, first_at (null where there is none): read from the planes by rank and select."""
    ship(shards.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["n_tokens"], row["bits"], row["zeros"], row["planes"], row["ranks"])
                found = shard.count(token)
                values = [row["part"], row["shard"], found, shard.locate(token, 0) if found else None]
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["part", "shard", "occurrences", "first_at"])

    return shards.mapInArrow(run, "part int, shard bigint, occurrences bigint, first_at bigint")


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write the documents to the shared folder and read the digest of each back from the files."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write(docs, path, **options)
    return documents(read(spark, path))
