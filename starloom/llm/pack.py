"""Packing documents into training sequences along a space-filling curve.

1. Tokens: each text is tokenized once, where it is read, and closed with ``END_ID``.
2. Curve: a document's hashed vector (counts of its token ids over ``HASH_DIMS`` hashed buckets, with signs) is
   projected to ``CURVE_DIMS`` dimensions; its cell's index on the Hilbert curve is the sort key, so documents with
   similar tokens get close keys.
3. One range shuffle by (key, doc_id) brings curve neighbours together, sorted. Each partition fills sequences of
   ``LENGTH`` tokens one after the other, cutting documents where a sequence is full. What is left at a partition's end
   goes into sequences whose lengths are powers of two, so nothing is padded.

No state crosses partitions (the sequence id carries the partition's number), nothing is collected, and equal keys are
split by doc_id, so a group of copies can't make one partition large. Memory: one document's ids and one slice of a
batch.

Edge cases: a null or empty text is the single token ``END_ID``; very long texts are tokenized in segments; repeated
rows and null ids are packed like any others, every row on its own; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import map_arrow, slices, text_or_empty
from starloom.sources.store import materialize

LENGTH = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k.json"
HASH_DIMS, CURVE_DIMS, CURVE_BITS = 1024, 3, 10
#: The characters tokenized together.
SLICE_CHARS = 4_000_000


# ------------------------------------------------------------------------------------------------ tokens
#: Fixed value: the pattern by which byte-level BPE of this vocabulary splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A space between two other characters always begins a pre-token; very long texts are cut there.
SAFE = re.compile(r"(?<=\S)(?= \S)")


def byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable Latin-1 characters stand for
    themselves, the other bytes, in order, for the characters from 256 on."""
    own = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or 174 <= b]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoder:
    """The ids that the vocabulary file's own library gives, several times faster: the file's tokens as ranks (their
    ids are in merge order) for the byte-pair engine of tiktoken. With ``special``, the file's added tokens in a text are
    their own ids, as that library has it by default; otherwise they are ordinary text."""

    def __init__(self, path: str, segment: int = 100_000, special: bool = False):
        import tiktoken

        byte = byte_of()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        self.engine = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.segment = segment
        self.added = added if special else {}
        # cut apart before anything else, the longest first where several begin at one place
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") \
            if self.added else None

    def segments(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > 2 * self.segment and (m := SAFE.search(text, at + self.segment)):
            yield text[at:m.start()]
            at = m.start()
        yield text[at:]

    def __call__(self, text: str) -> np.ndarray:
        parts = []
        for piece in self.cut.split(text) if self.cut else [text]:
            if piece in self.added:
                parts.append([self.added[piece]])
            elif piece:
                parts += [self.engine.encode_to_numpy(x, disallowed_special=()) for x in self.segments(piece)]
        return np.concatenate([*parts, [END_ID]]).astype("<u2")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder; it outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, special=True)
    return _ENCODERS[path]


# ------------------------------------------------------------------------------------------------ curve
def projection(vocabulary: int = 1 << 16, seed: int = 7) -> np.ndarray:
    """For each token id, what it adds to a document's projected vector: its hashed bucket's row of a random
    projection, with the id's sign."""
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((HASH_DIMS, CURVE_DIMS)).astype(np.float32)
    ids = np.arange(vocabulary, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bucket = (ids >> np.uint64(54)).astype(np.int64) % HASH_DIMS
    sign = np.where((ids >> np.uint64(20)) & np.uint64(1), 1, -1).astype(np.float32)
    return rows[bucket] * sign[:, None]


def cells(ids: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """The grid cell of each document: the direction of its projected vector, each axis in 2^CURVE_BITS steps."""
    flat = np.concatenate(ids)
    starts = np.cumsum([0] + [len(x) for x in ids[:-1]])
    sums = np.add.reduceat(table[flat], starts, axis=0).astype(np.float64)
    unit = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return np.clip(((unit + 1) / 2 * (1 << CURVE_BITS)).astype(np.int64), 0, (1 << CURVE_BITS) - 1)


def hilbert(cell: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Index along the Hilbert curve of points (n, dims), by the transposed-axes method."""
    x = [cell[:, i].astype(np.int64).copy() for i in range(cell.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            has = (x[i] & q) != 0
            swap = np.where(has, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(has, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ t) >> b) & 1)
    return key


# ------------------------------------------------------------------------------------------------ stages
def tokenized(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, key, ids): ids as binary, little-endian unsigned 16-bit, closed with ``END_ID``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, table = encoder(vocabulary_path), projection()
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1).to_pylist(), len, SLICE_CHARS):
                ids = [encode(t) for t in texts]
                key = hilbert(cells(ids, table))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(key, pa.int64()),
                     pa.array([x.tobytes() for x in ids], pa.binary())],
                    names=["doc_id", "key", "ids"])
                at += len(texts)

    return map_arrow(docs.select("doc_id", text_or_empty().alias("text")), run, f"doc_id {id_type}, key long, ids binary")


def halves(n: int) -> list[int]:
    """The powers of two that n consists of, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Filler:
    """Fills sequences one after the other. Pieces of the open sequence wait, so that what is left at the end can be
    dealt anew over sequences of powers of two."""

    def __init__(self, partition: int, length: int = LENGTH):
        self.length, self.next_id = length, partition << 40
        self.open: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        self.used = 0
        self.rows: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next_id, at))
            at += len(ids)
        self.next_id += 1

    def add(self, doc_id, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            n = min(self.length - self.used, len(ids) - start)
            self.open.append((doc_id, start, ids[start:start + n], len(ids)))
            self.used += n
            start += n
            if self.used == self.length:
                self._close(self.open)
                self.open, self.used = [], 0

    def finish(self) -> None:
        rest = self.open
        for size in halves(self.used):
            pieces, need = [], size
            while need:
                doc_id, start, ids, total = rest[0]
                n = min(need, len(ids))
                pieces.append((doc_id, start, ids[:n], total))
                rest = ([(doc_id, start + n, ids[n:], total)] if n < len(ids) else []) + rest[1:]
                need -= n
            self._close(pieces)
        self.open, self.used = [], 0


def pack(docs: DataFrame, vocabulary_path: str, length: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    id_type = docs.schema["doc_id"].dataType
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        filler, arrow_id = Filler(TaskContext.get().partitionId(), length), None

        def out() -> pa.RecordBatch:
            cols = list(zip(*filler.rows, strict=True)) or [()] * len(names)
            filler.rows = []
            return pa.RecordBatch.from_arrays([pa.array(cols[0], arrow_id), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                                              names=names)

        for batch in batches:
            arrow_id = batch.schema.field(0).type
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                filler.add(doc_id, np.frombuffer(ids.as_py(), dtype="<u2"))
                if len(filler.rows) >= 20_000:
                    yield out()
        filler.finish()
        if filler.rows:
            yield out()

    # written first: choosing the ranges reads all rows as well, and would tokenize them a second time
    rows = materialize(tokenized(docs, vocabulary_path))
    ordered = rows.repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id")
    schema = f"doc_id {id_type.simpleString()}, " + ", ".join(f"{n} long" for n in names[1:])
    return map_arrow(ordered.select("doc_id", "ids"), run, schema)
