"""Substring de-duplication by membership of word windows; it stands in for a relative Lempel-Ziv parse.

A window of ``WINDOW`` consecutive words of a document that also starts in a document with a smaller id is a duplicate;
the words that duplicate windows cover, merged to stretches, go, the words between stay. No factor is made: there is no
reference position, no longest match and no parse from left to right.

The reference index. Documents are cut into overlapping *blocks* by content: each window of 13 words is assigned to the
5-word anchor in it with the smallest hash, and consecutive windows with the same anchor form a block (about five
windows). Equal windows have equal anchors wherever they occur, so whether a window is a duplicate can be decided among
the blocks of its anchor alone, and every document's blocks are indexed: nothing is sampled.

1. Index: per anchor, the smallest and largest document and the smallest and largest block hash, beside each of its blocks
   (one window over the anchor: blocks are shuffled once). An anchor of one document needs no more work.
2. Parse: where all blocks of an anchor are equal, a block is part of a factor if the smallest document isn't its own.
3. Factor boundaries: where an anchor has different blocks (a factor ends inside one of them), their single windows are
   compared, by the smallest document of each window hash (80 bits).

The lookups travel by document: each document gets the anchors and window hashes found for it, never other texts, and
parses its own text, which travels compressed, with them. Lists are bounded by the document's own length. All blocks of an anchor, and all open
windows of one hash, meet in one task, as rows of a few integers that spill to disk beyond its memory.

Edge cases: a null text has no words; a null ``doc_id`` counts as larger than all others, so such a document loses what
any document with an id has, and nothing to another without; ids may be of any type with an order; rows that share a ``doc_id`` are one document (they take
nothing from each other); texts under 13 words stay; very long texts are parsed whole; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import map_arrow, slices, text_or_empty
from starloom.llm.wordhash import U, Words, mix
from starloom.sources.store import materialize

WINDOW, ANCHOR = 13, 5
SLICE_BYTES = 500_000


class Blocks:
    """The blocks of a batch of texts. ``at``: the first word of each window; ``block``: the window's block; ``anchor``,
    ``hash`` and ``doc`` of each block."""

    def __init__(self, words: Words, window: int = WINDOW, k: int = ANCHOR):
        n, width = len(words.hash), window - k + 1
        empty = np.empty(0, dtype=np.int64)
        if n < window:
            self.at, self.block, self.anchor, self.hash, self.doc = empty, empty, empty.astype(U), empty.astype(U), empty
            return
        gram = np.full(n, 2**64 - 1, dtype=np.uint64)
        at, h = words.windows(k)
        gram[at] = h
        best = gram[:n - window + 1].copy()
        where = np.zeros(n - window + 1, dtype=np.int64)
        for i in range(1, width):  # the last of equal smallest grams
            g = gram[i:n - window + 1 + i]
            less = g <= best
            best[less] = g[less]
            where[less] = i
        doc = words.doc
        self.at = np.flatnonzero(doc[:n - window + 1] == doc[window - 1:])
        place = self.at + where[self.at]
        anchor = best[self.at]
        new = np.ones(len(self.at), dtype=bool)
        if len(self.at):
            new[1:] = (place[1:] != place[:-1]) | (doc[self.at[1:]] != doc[self.at[:-1]])
        self.block = np.cumsum(new) - 1
        head = np.flatnonzero(new)
        tail = np.concatenate([head[1:], [len(self.at)]]) - 1
        self.anchor, self.doc = anchor[head], doc[self.at[head]]
        # a block's hash: the words it covers, and where its anchor is
        sums = np.concatenate([np.zeros(1, dtype=U), np.cumsum(
            mix(words.hash + U(1)) * _powers_at(np.arange(n)), dtype=U)])
        begin, end = self.at[head], self.at[tail] + window
        self.hash = mix((sums[end] - sums[begin]) * _powers_at(-begin) + (end - begin).astype(U) * U(0x2545F4914F6CDD1D)
                        + mix((place[head] - begin).astype(U)))


_STEP = 0xD1342543DE82EF95  # odd
_TABLES: dict[int, np.ndarray] = {}


def _powers_at(exponents: np.ndarray) -> np.ndarray:
    """Powers of the odd step modulo 2^64, also for negative exponents; two table lookups each."""
    if not len(exponents):
        return np.empty(0, dtype=U)
    sign = -1 if exponents[-1] < 0 or exponents[0] < 0 else 1
    if sign not in _TABLES:
        base = pow(_STEP, sign, 2**64)
        low = np.full(4096, base, dtype=U)
        low[0] = 1
        low = np.multiply.accumulate(low)
        high = np.full(65536, pow(base, 4096, 2**64), dtype=U)
        high[0] = 1
        _TABLES[sign] = np.concatenate([low, np.multiply.accumulate(high)])
    t, e = _TABLES[sign], np.abs(exponents)
    return t[e & 4095] * t[4096 + (e >> 12)]


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _isin(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return np.isin(values, wanted) if len(wanted) else np.zeros(len(values), dtype=bool)


# ------------------------------------------------------------------------------------------------ index
def block_rows(docs: DataFrame) -> DataFrame:
    """(doc, anchor, block): one row per block, known by 48 bits of its anchor and 40 of its words. (Anchors that meet in 48
    bits have different blocks, so their single windows are compared.)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            ids = batch.column(0)
            for part in slices((t.as_buffer().to_pybytes() for t in batch.column(1)), len, SLICE_BYTES):
                b = Blocks(Words(part))
                for i in range(0, len(b.doc), 500_000):
                    s = slice(i, i + 500_000)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(at + b.doc[s])), pa.array(_anchors(b)[s].astype(np.int64)),
                         pa.array((b.hash[s] >> U(24)).astype(np.int64))], names=["doc", "anchor", "block"])
                at += len(part)

    return map_arrow(docs, run, f"doc {_kind(docs)}, anchor long, block long")


def _anchors(b: Blocks) -> np.ndarray:
    return b.anchor >> U(16)


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc"].dataType.simpleString()


def _before() -> Column:
    """Whether document ``d0`` comes before ``doc``; those without an id come last."""
    return F.col("d0").isNotNull() & (F.col("doc").isNull() | (F.col("d0") < F.col("doc")))


SHARED = "d0 < d1 or (none and d0 is not null)"


def anchor_hits(docs: DataFrame) -> DataFrame:
    """(doc, same, mixed): the anchors found for a document. ``same``: all blocks of the anchor are equal and a smaller
    document has it; ``mixed``: the anchor is in several documents, with different blocks."""
    of = Window.partitionBy("anchor")
    index = block_rows(docs).select(
        "doc", "anchor", F.min("doc").over(of).alias("d0"), F.max("doc").over(of).alias("d1"),
        F.max(F.col("doc").isNull()).over(of).alias("none"),
        (F.min("block").over(of) != F.max("block").over(of)).alias("differ"))
    found = index.filter(SHARED).filter(F.col("differ") | _before())
    return found.groupBy("doc").agg(F.collect_set(F.when(~F.col("differ"), F.col("anchor"))).alias("same"),
                                    F.collect_set(F.when(F.col("differ"), F.col("anchor"))).alias("mixed"))


# ------------------------------------------------------------------------------------------------ parse
def _removed(n: int, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which of n words are covered by windows that start at ``starts``."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change[:-1]) > 0


def _merged(starts: np.ndarray, window: int = WINDOW) -> list[int]:
    """Sorted window starts as merged stretches of words: begin, end, begin, end, ..."""
    if not len(starts):
        return []
    new = np.flatnonzero(np.diff(starts) > window) + 1
    begin = starts[np.concatenate([[0], new])]
    end = starts[np.concatenate([new, [len(starts)]]) - 1] + window
    return np.stack([begin, end], axis=1).reshape(-1).tolist()


def _second(h: np.ndarray) -> np.ndarray:
    """The second window hash, 16 bits beside the first's 64."""
    return (h >> U(48)).astype(np.uint16).view(np.int16)


def packed(docs: DataFrame) -> DataFrame:
    """(doc, text) with each text compressed: texts are shuffled twice and make up most of what is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices((zlib.compress(memoryview(t.as_buffer()), 1) for t in batch.column(1)), len, SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.array(part, pa.binary())],
                                                 names=["doc", "text"])
                at += len(part)

    return map_arrow(docs.select("doc", "text"), run, f"doc {_kind(docs)}, text binary")


PARSED = "n_words long, n_removed long, kept_sha256 string, text binary, found array<int>, at array<int>, " \
         "w1 array<long>, w2 array<smallint>"


def first_parse(joined: DataFrame) -> DataFrame:
    """Parse (doc, text, same, mixed), the text as ``packed`` gives it. A document without mixed anchors is finished; any other comes with the
    duplicate stretches found so far (``found``), the words outside them (``text``, compressed), and the place and hashes of the
    windows still open (``at``, ``w1``, ``w2``). ``row`` numbers the rows: ids may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = ((zlib.decompress(t.as_buffer()), i) for i, t in enumerate(batch.column(1)))
            for part in slices(rows, lambda r: len(r[0]), SLICE_BYTES):
                yield parse([t for t, _ in part], batch.slice(part[0][1], len(part)), row)
                row += len(part)

    def parse(texts: list[bytes], batch: pa.RecordBatch, row: int) -> pa.RecordBatch:
        words = Words(texts)
        b = Blocks(words)
        anchors = _anchors(b)
        bounds = np.searchsorted(b.doc, np.arange(len(texts) + 1))
        w_bounds = np.searchsorted(words.doc[b.at] if len(b.at) else b.at, np.arange(len(texts) + 1))
        _, w1 = words.windows(WINDOW)  # in the order of b.at
        _, w2 = words.windows(WINDOW, salt=1)
        out = []
        for i, (same, mixed) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            n, first = int(words.count[i]), int(words.first[i])
            mine = slice(w_bounds[i], w_bounds[i + 1])
            blocks = slice(bounds[i], bounds[i + 1])
            lists = [np.asarray(x.values, dtype=np.int64).astype(U) if x.is_valid else np.empty(0, dtype=U)
                     for x in (same, mixed)]
            dup, unsure = _isin(anchors[blocks], lists[0]), _isin(anchors[blocks], lists[1])
            of = b.block[mine] - bounds[i]
            found = b.at[mine][dup[of]] - first
            gone = _removed(n, found)
            kept = words.text(i) if not len(found) else [x for x, g in zip(words.text(i), gone, strict=True) if not g]
            if unsure.any():
                o = unsure[of]
                out.append((n, None, None, zlib.compress(b" ".join(kept), 1), _merged(found), (b.at[mine][o] - first).astype(np.int32),
                            w1[mine][o].astype(np.int64), _second(w2[mine][o])))
            else:
                out.append((n, int(gone.sum()), _sha(kept), None, None, None, None, None))
        cols = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(range(row, row + len(texts)), pa.int64()), batch.column(0), pa.array(cols[0], pa.int64()),
             pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
             pa.array(cols[3], pa.binary()), *(pa.array(cols[j], pa.list_(t)) for j, t in (
                 (4, pa.int32()), (5, pa.int32()), (6, pa.int64()), (7, pa.int16())))],
            names=["row", "doc", "n_words", "n_removed", "kept_sha256", "text", "found", "at", "w1", "w2"])

    return map_arrow(joined.select("doc", "text", "same", "mixed"), run, f"row long, doc {_kind(joined)}, {PARSED}")


def boundary_hits(open_rows: DataFrame) -> DataFrame:
    """(row, starts): the places of the open windows that a smaller document has too."""
    windows = open_rows.select("row", "doc", F.explode(F.arrays_zip("at", "w1", "w2")).alias("w")).select(
        "row", "doc", "w.at", "w.w1", "w.w2")
    first = windows.withColumn("d0", F.min("doc").over(Window.partitionBy("w1", "w2")))
    hits = first.filter(_before())
    return hits.groupBy("row").agg(F.collect_list("at").alias("starts"))


def second_parse(joined: DataFrame) -> DataFrame:
    """Finish (doc, n_words, text, found, starts): the open windows at ``starts`` are duplicates as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, shas = [], []
            for n, text, found, starts in zip(*(batch.column(i) for i in range(1, 5)), strict=True):
                before = np.zeros(n.as_py(), dtype=bool)
                stretches = found.values.to_pylist()
                for begin, end in zip(stretches[::2], stretches[1::2], strict=True):
                    before[begin:end] = True
                gone, words = before, zlib.decompress(text.as_buffer()).split()
                if starts.is_valid:
                    gone = before | _removed(len(before), np.asarray(starts.values, dtype=np.int64))
                    words = [x for x, g in zip(words, gone[~before], strict=True) if not g]
                removed.append(int(gone.sum()))
                shas.append(_sha(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()),
                                              pa.array(shas, pa.string())],
                                             names=["doc", "n_words", "n_removed", "kept_sha256"])

    return map_arrow(joined.select("doc", "n_words", "text", "found", "starts"), run,
                     f"doc {_kind(joined)}, n_words long, n_removed long, kept_sha256 string")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by one space)."""
    source = docs.select(F.col("doc_id").alias("doc"), text_or_empty().alias("text"))
    hits = anchor_hits(source).withColumnRenamed("doc", "_doc")
    parsed = materialize(first_parse(packed(source).join(hits, F.col("doc").eqNullSafe(F.col("_doc")), "left")))
    done = parsed.filter("text is null").select("doc", "n_words", "n_removed", "kept_sha256")
    rest = parsed.filter("text is not null")
    rest_words = rest.select("row", "doc", "n_words", "text", "found")
    finished = second_parse(rest_words.join(boundary_hits(rest), "row", "left"))
    return done.unionByName(finished).withColumnRenamed("doc", "doc_id")
