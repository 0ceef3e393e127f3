"""Byte-level BPE encoding and decoding over Arrow batches.

The vocabulary is a rank file (base64 token, rank per line). It is loaded into the tokenizers library:
every byte stands for one printable character, a token of several bytes is merged from every pair of
shorter tokens that makes it, in rank order, and a piece that is itself a token is taken whole. The text
is split by the published pattern first. Decoding goes back through the byte table, so tokens that end
inside a character are no special case for bytes; ``decode_text`` replaces what is no valid UTF-8.

Texts are encoded in chunks that start at white space. No match of the pattern runs from a character
that is no white space to one that is, so the chunks' ids, put together, are the text's ids; chunks seen
before are looked up in a table of bounded size per worker.

Null and empty texts have no ids. Rows are independent of each other: repeated rows, ties and null keys
come back as they are. Input columns beside the text are carried through unless the operator's own
columns (``n_tokens``, ``ids``, ``starts``, ``ends``) have the same name; those replace them.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship

MULTI_VOCABULARY = "byte_bpe_multi_50k.tiktoken"
DOCS_AT_ONCE = 64  # texts whose ids are in memory together
CHUNKS_KEPT = 400_000  # entries of a worker's table before it is emptied

# The characters with the Unicode property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")


def byte_characters() -> list[str]:
    """The printable character standing for each byte: itself where printable, else the next one from 256 up."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Codec:
    """A loaded rank file; one per worker and file."""

    def __init__(self, path: str, pattern: str) -> None:
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        characters = byte_characters()
        shown = {token: "".join(characters[b] for b in token) for token in ranks}
        merges = []
        for token in sorted(ranks, key=ranks.__getitem__):
            pairs = [(token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
            merges += [(shown[a], shown[b]) for a, b in sorted(pairs, key=lambda p: (ranks[p[0]], ranks[p[1]]))]
        vocabulary = {shown[token]: rank for token, rank in ranks.items()}
        self.library = Tokenizer(models.BPE(vocabulary, merges, ignore_merges=True))
        self.library.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.token_bytes = [b""] * (max(ranks.values()) + 1)
        byte_of = {c: b for b, c in enumerate(characters)}
        for token, rank in vocabulary.items():  # back through the byte table
            self.token_bytes[rank] = bytes(byte_of[c] for c in token)
        self.lengths = np.array([len(x) for x in self.token_bytes], dtype=np.int64)
        self.known: dict[str, bytes] = {}

    def _learn(self, chunks: list[str]) -> None:
        """Encode unseen chunks: those that start with white space in one go, cut by their length in bytes."""
        glued = [c for c in chunks if c[0] in WHITE_SPACE and c[-1] not in WHITE_SPACE]
        alone = set(chunks).difference(glued)
        for at in range(0, len(glued), 2000):
            part = glued[at : at + 2000]
            ids = np.array(self.library.encode("".join(part), add_special_tokens=False).ids, dtype="<u4")
            ends = np.cumsum(self.lengths[ids])
            cuts = np.searchsorted(ends, np.cumsum([len(c.encode()) for c in part]), side="left") + 1
            start = 0
            for chunk, stop in zip(part, cuts.tolist()):
                self.known[chunk] = ids[start:stop].tobytes()
                start = stop
        for chunk in alone:
            self.known[chunk] = np.array(self.library.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [CHUNK.findall(text) if text else [] for text in texts]
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > CHUNKS_KEPT:
            self.known.clear()
            new = set().union(*split)
        if new:
            self._learn(sorted(new))
        return [b"".join(map(self.known.__getitem__, chunks)) for chunks in split]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist()))

    def spans(self, ids: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each token in characters; a token inside a character covers that character."""
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
        ends = np.cumsum(self.lengths[ids])
        return character[ends - self.lengths[ids]], character[ends - 1] + 1


@functools.lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _vocabulary(vocabulary: str | None, pattern: str | None) -> tuple[str, str]:
    return vocabulary or public_tokenizers.path(MULTI_VOCABULARY), pattern or public_tokenizers.PATTERN


def encode(
    docs: DataFrame, text: str = "text", offsets: bool = False, vocabulary: str | None = None, pattern: str | None = None
) -> DataFrame:
    """Add ``n_tokens`` long and ``ids`` array of int, and with ``offsets`` the tokens' ``starts`` and ``ends`` in characters."""
    ship(docs.sparkSession)
    path, pattern = _vocabulary(vocabulary, pattern)
    own = ["n_tokens", "ids"] + ["starts", "ends"] * offsets
    carried = [c for c in docs.columns if c not in own]
    rows = docs.select(*[F.col(f"`{c}`") for c in carried])
    added = [("n_tokens", T.LongType())] + [(c, T.ArrayType(T.IntegerType())) for c in own[1:]]
    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, k) for n, k in added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for start in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(start, DOCS_AT_ONCE)
                texts = part.column(at).to_pylist()
                ids = [np.frombuffer(x, dtype="<u4") for x in coder.encode(texts)]
                columns = [pa.array([len(x) for x in ids], pa.int64()), _lists(ids)]
                if offsets:
                    both = [coder.spans(i, t or "") if len(i) else (i, i) for i, t in zip(ids, texts)]
                    columns += [_lists([b[0] for b in both]), _lists([b[1] for b in both])]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*carried, *own])

    return rows.mapInArrow(run, schema)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32)))


def decode(
    encoded: DataFrame, ids: str = "ids", to: str = "decoded", vocabulary: str | None = None, pattern: str | None = None
) -> DataFrame:
    """Add the bytes that the ids stand for. Null ids give null; an id outside the vocabulary is an error."""
    ship(encoded.sparkSession)
    path, pattern = _vocabulary(vocabulary, pattern)
    rows = encoded.select(*[F.col(f"`{c}`") for c in encoded.columns if c != to])
    schema = T.StructType([*rows.schema.fields, T.StructField(to, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            for start in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(start, DOCS_AT_ONCE)
                raw = [None if x is None else b"".join(map(coder.token_bytes.__getitem__, x)) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)


def decode_text(encoded: DataFrame, ids: str = "ids", to: str = "decoded", **files) -> DataFrame:
    """As ``decode``, as text; bytes that are no whole character become U+FFFD."""
    return decode(encoded, ids, to, **files).withColumn(to, F.expr(f"make_valid_utf8(CAST(`{to}` AS string))"))


def fingerprints(
    docs: DataFrame, text: str = "text", carried: tuple[str, ...] = (), ids: bool = False, vocabulary: str | None = None, pattern: str | None = None
) -> DataFrame:
    """Encode, decode again, and return digests of ids and bytes with the number of tokens, in one pass.

    doc_id, carried columns, n_tokens, ids_sha256, decoded_sha256 and, where asked, ids; one row per input row.
    """
    ship(docs.sparkSession)
    path, pattern = _vocabulary(vocabulary, pattern)
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col("doc_id").cast("bigint").alias("doc_id"), *[F.col(f"`{c}`") for c in carried])
    added = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    schema = T.StructType([*rows.schema.fields[1:], *T._parse_datatype_string(added).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(start, DOCS_AT_ONCE)
                raw = coder.encode(part.column(0).to_pylist())
                found = [np.frombuffer(x, dtype="<u4") for x in raw]
                digests = [[hashlib.sha256(x).hexdigest() for x in raw], [hashlib.sha256(coder.decode(x)).hexdigest() for x in found]]
                columns = [pa.array([len(x) for x in found], pa.int64()), *(pa.array(x, pa.string()) for x in digests)]
                columns += [_lists(found)] if ids else []
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *columns], names=schema.names)

    return rows.mapInArrow(run, schema)
