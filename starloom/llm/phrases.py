"""Phrase collocations, counted in HAT-tries: burstable hash containers under a shallow trie of word ids.

Everything is per language. Phrases of one to four words are counted level by level: a phrase can only reach the least
count if both phrases of one word less inside it do, so each level counts what the level before leaves possible. What is
left is told to the tasks by a bit filter of fixed size (``FILTER_BITS``), whatever the size of the corpus; a false positive
costs a row, never a result.

In a task a trie counts. Its root and the nodes below (one a word deep, two levels at most) hold hash containers, each
for a range of word ids. A container that grows past ``BURST`` entries bursts: a range of several words is split in two, a
single word's container becomes a node of its own, with containers by the next word. When a task's tries hold more than
``ENTRIES`` phrases, the largest subtrees are spilled whole, each as a sorted run of (phrase, count) rows. Spark partitions the
runs by prefix and merges them by sums: a phrase belongs to its first word's partition, or, if that word makes up a
thousandth of all words or more (there are at most a thousand of those), to one of its own.

Scores, ranks and the test for longer phrases are exact decimal arithmetic in Spark.

Edge cases: a null text is empty, a null ``lang`` counts as ``und``; rows that repeat count each; ids and other columns
aren't read; a text without a phrase gives nothing; an empty table gives an empty result; texts of any length are cut into
words whole, slice by slice of ``SLICE`` bytes, and the last words of a slice go before the next.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import map_arrow, slices
from starloom.llm.wordhash import mix
from starloom.sources.store import materialize

LONGEST, LEAST, SHARE, TOP = 4, 30, 80, 2000
UNKNOWN = "und"
FILTER_BITS = 1 << 27
BURST, ENTRIES, SLICE, RUN = 1 << 14, 800_000, 1 << 21, 1 << 16
#: Word ids have 21 bits, so that three of them fit a long; a task that meets more words spills all and starts anew.
_ID = 21
_WORDS = (1 << _ID) - 1
WORDS_KEPT = 1_000_000

# The characters that end a piece, and those that separate words in it.
_ENDS, _SPACES = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _ENDS + _SPACES,
                         b"abcdefghijklmnopqrstuvwxyz" + b"." * len(_ENDS) + b" " * len(_SPACES))
_GAP = re.compile(rb"[ .]")
_FACTOR = np.random.default_rng(12).integers(1, 2**63, LONGEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def slices_of(text: bytes, size: int) -> Iterator[pa.Array]:
    """The words of a text in UTF-8, with ``b"."`` wherever a piece ends, in slices of about ``size`` bytes."""
    text, at = text.translate(_TABLE), 0
    while at < len(text):
        stop = _GAP.search(text, min(at + size, len(text)))
        end = stop.end() if stop else len(text)
        part = pa.array([text[at:end].replace(b".", b" . ").strip(b" ")], pa.binary()).cast(pa.string())
        words = pc.ascii_split_whitespace(part).flatten().cast(pa.binary())
        yield words if len(words) != 1 or words[0].as_py() else words.slice(1)
        at = end


# ------------------------------------------------------------------------------------------------ the trie
class Entries(NamedTuple):
    """Phrases of n words, as the id of the first and the ids of the others (21 bits each, the second highest), and counts."""

    first: np.ndarray
    rest: np.ndarray
    count: np.ndarray

    def part(self, rows) -> Entries:
        return Entries(self.first[rows], self.rest[rows], self.count[rows])


def _concat(parts: list[Entries]) -> Entries:
    return parts[0] if len(parts) == 1 else Entries(*(np.concatenate(x) for x in zip(*parts, strict=True)))


NONE = Entries(*(np.empty(0, dtype=np.int64),) * 3)


class Container:
    """Counts of phrases whose word at this depth has an id from ``low`` to below ``high``: a hash table (Arrow's grouped
    sum), and chunks of entries that came since; those are hashed into it once they are as many as it holds."""

    __slots__ = ("low", "high", "table", "fresh", "waiting")

    def __init__(self, low: int, high: int, table: Entries = NONE):
        self.low, self.high, self.table = low, high, table
        self.fresh: list[Entries] = []
        self.waiting = 0

    @property
    def size(self) -> int:
        return len(self.table.first) + self.waiting

    def add(self, entries: Entries) -> None:
        self.fresh.append(entries)
        self.waiting += len(entries.first)

    def settle(self) -> Entries:
        if self.fresh:
            rows = pa.table(_concat([self.table, *self.fresh])._asdict()).group_by(["first", "rest"]).aggregate([("count", "sum")])
            self.table = Entries(*(rows.column(c).to_numpy() for c in ("first", "rest", "count_sum")))
            self.fresh, self.waiting = [], 0
        return self.table


class Node:
    """The children of a prefix, in order of the ranges of word ids they hold. ``depth`` words are the same in all."""

    def __init__(self, n: int, depth: int, table: Entries = NONE):
        self.n, self.depth = n, depth
        self.lows, self.kids = [0], [Container(0, _WORDS + 1, table)]
        self._burst(0)

    @property
    def size(self) -> int:
        return sum(kid.size for kid in self.kids)

    def _words(self, entries: Entries) -> np.ndarray:
        """The word of each phrase that tells the child."""
        return entries.first if self.depth == 0 else entries.rest >> _ID * (self.n - 2)

    def add(self, entries: Entries) -> None:
        """Add entries in order of their words."""
        at = np.searchsorted(self._words(entries), [*self.lows[1:], _WORDS + 1])
        begin = 0
        for i, end in reversed(list(enumerate(at.tolist()))):
            begin = int(at[i - 1]) if i else 0
            if begin == end:
                continue
            kid = self.kids[i]
            kid.add(entries.part(slice(begin, end)))
            if isinstance(kid, Container) and kid.waiting > max(BURST, len(kid.table.first)):
                self._burst(i)

    def _burst(self, i: int) -> None:
        """Settle the i-th container and split it until none is too large that can be split."""
        work, done = [self.kids[i]], []
        while work:
            box = work.pop()
            table = box.settle()
            if box.size <= BURST or (box.high - box.low == 1 and self.depth + 1 >= min(self.n, 3) - 1):
                done.append(box)
            elif box.high - box.low == 1:
                done.append((box.low, Node(self.n, self.depth + 1, table)))
            else:
                words = self._words(table)
                cut = max(int(np.partition(words, len(words) // 2)[len(words) // 2]), box.low + 1)
                high = words >= cut
                work += [Container(box.low, cut, table.part(~high)), Container(cut, box.high, table.part(high))]
        done = sorted((x if isinstance(x, tuple) else (x.low, x) for x in done), key=lambda x: x[0])
        self.lows[i:i + 1], self.kids[i:i + 1] = [x[0] for x in done], [x[1] for x in done]

    def settle(self) -> Entries:
        return _concat([kid.settle() for kid in self.kids])

    def tidy(self) -> None:
        """Make equal phrases one, everywhere."""
        for kid in self.kids:
            kid.tidy() if isinstance(kid, Node) else kid.settle()

    def spill(self, keep: int) -> Iterator[Entries]:
        """Take out whole subtrees, the largest first, until at most ``keep`` phrases are left."""
        self.tidy()
        left = self.size
        for i in sorted(range(len(self.kids)), key=lambda i: -self.kids[i].size):
            if left <= keep:
                break
            kid = self.kids[i]
            if kid.size:
                left -= kid.size
                yield kid.settle()
                self.kids[i] = Container(self.lows[i], kid.high if isinstance(kid, Container) else self.lows[i] + 1)


class Words(dict):
    """Ids of words in order of first use, with the hash that the bit filter goes by. Id 0 ends a piece."""

    def __init__(self, lang: str):
        super().__init__({b".": 0})
        self.names, self.hashes, self.seed = [b"."], [0], xxhash.xxh3_64_intdigest(lang.encode())
        self._known = np.empty(0, dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = i = len(self.names)
        self.names.append(word)
        self.hashes.append(xxhash.xxh3_64_intdigest(word, self.seed))
        return i

    def hashed(self, ids: np.ndarray) -> np.ndarray:
        if len(self._known) < len(self.hashes):
            self._known = np.concatenate([self._known, np.array(self.hashes[len(self._known):], dtype=np.uint64)])
        return self._known[ids]


def _bits(hashes: list[np.ndarray]) -> np.ndarray:
    """The filter's bit for phrases of words with these hashes (a list of columns)."""
    total = np.zeros(len(hashes[0]), dtype=np.uint64)
    for h, f in zip(hashes, _FACTOR, strict=False):
        total += h * f
    return (mix(total) % np.uint64(FILTER_BITS)).astype(np.int64)


class Filter:
    """A set of phrases of n words as bits in bytes; says yes for all its phrases and few others."""

    def __init__(self, n: int, bits: np.ndarray):
        self.n, self.bits = n, bits

    def has(self, hashes: list[np.ndarray]) -> np.ndarray:
        at = _bits(hashes)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


class Counter:
    """Counts of phrases of n words in one language."""

    def __init__(self, lang: str, n: int, known: Filter | None):
        self.lang, self.n, self.known = lang, n, known
        self.words, self.trie = Words(lang), Node(n, 0)

    def add(self, text: bytes) -> Iterator[pa.RecordBatch]:
        """Count a text; yields what had to be spilled to make room for more words."""
        before = pa.array([], pa.binary())
        for part in slices_of(text, SLICE):
            part = pa.concat_arrays([before, part])
            coded = part.dictionary_encode()
            if len(self.words.names) + len(coded.dictionary) >= WORDS_KEPT:
                yield from self.spill(0)
                self.words, self.trie = Words(self.lang), Node(self.n, 0)
            ids = np.fromiter(map(self.words.__getitem__, coded.dictionary.to_pylist()), dtype=np.int64, count=len(coded.dictionary))
            self._count(ids[coded.indices.to_numpy()])
            before = part.slice(max(0, len(part) - self.n + 1))

    def _count(self, ids: np.ndarray) -> None:
        words, n = self.words, self.n
        if len(ids) < n:
            return
        ok = ids != 0
        at = np.flatnonzero(np.logical_and.reduce([ok[j:len(ids) - n + 1 + j] for j in range(n)]))
        if self.known is not None:
            # the two phrases of one word less in each
            h = words.hashed(ids)
            has = np.zeros(len(ids) + 1, dtype=bool)
            parts = np.unique(np.concatenate([at, at + 1]))
            has[parts] = self.known.has([h[parts + j] for j in range(n - 1)])
            at = at[has[at] & has[at + 1]]
        if not len(at):
            return
        first, rest = ids[at], np.zeros(len(at), dtype=np.int64)
        for j in range(1, n):
            rest = rest << _ID | ids[at + j]
        if n <= 3:
            key, count = np.unique(first << _ID * (n - 1) | rest, return_counts=True)
            first, rest = key >> _ID * (n - 1), key & (1 << _ID * (n - 1)) - 1
        else:
            order = np.lexsort((rest, first))
            first, rest = first[order], rest[order]
            new = np.flatnonzero(np.concatenate([[True], (rest[1:] != rest[:-1]) | (first[1:] != first[:-1])]))
            first, rest, count = first[new], rest[new], np.diff(np.append(new, len(rest)))
        self.trie.add(Entries(first, rest, count.astype(np.int64)))

    def spill(self, keep: int) -> Iterator[pa.RecordBatch]:
        """Whole subtrees as sorted runs of (lang, phrase, n), until at most ``keep`` phrases are left."""
        names = None
        for entries in self.trie.spill(keep):
            names = pa.array(self.words.names, pa.binary()).cast(pa.string()) if names is None else names
            columns = [entries.first, *((entries.rest >> _ID * (self.n - 1 - j)) & _WORDS for j in range(1, self.n))]
            words = [names.take(pa.array(c)) for c in columns]
            phrases = pc.binary_join_element_wise(*words, " ") if self.n > 1 else words[0]
            order = pc.sort_indices(phrases)
            for at in range(0, len(order), RUN):
                rows = order.slice(at, RUN)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([self.lang]).take(pa.array(np.zeros(len(rows), dtype=np.int32))), phrases.take(rows),
                     pa.array(entries.count).take(rows)], names=["lang", "phrase", "n"])


def runs(docs: DataFrame, n: int, known: Filter | None = None) -> DataFrame:
    """(lang, phrase, n): the tasks' counts of phrases of ``n`` words, some of them in several runs. With ``known``, only
    phrases whose parts of one word less it has."""
    def run(batches):
        counters: dict[str, Counter] = {}
        for b in batches:
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), strict=True):
                if text:
                    by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                counter = counters.setdefault(lang, Counter(lang, n, known))
                for part in slices(texts, len, SLICE):
                    yield from counter.add(b".".join(part))
                    if sum(x.trie.size for x in counters.values()) > ENTRIES:
                        for x in counters.values():  # what is left once equal phrases are one
                            x.trie.tidy()
                    while sum(x.trie.size for x in counters.values()) > ENTRIES * 3 // 4:
                        yield from max(counters.values(), key=lambda x: x.trie.size).spill(ENTRIES // 8)
                    pa.default_memory_pool().release_unused()
        for c in counters.values():
            yield from c.spill(0)

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, "lang string, phrase string, n long")


def _cell(lang: Column, first: Column) -> Column:
    return F.concat(lang, F.lit("\0"), first)


def merged(parts: DataFrame, hot: list[str]) -> DataFrame:
    """(lang, phrase, f): the runs merged by prefix partition, the prefix being the first word, or the whole phrase if the
    first word is one of ``hot``."""
    first = F.substring_index("phrase", " ", 1)
    prefix = F.when(_cell(F.col("lang"), first).isin(hot), F.col("phrase")).otherwise(first)
    return (parts.withColumn("prefix", prefix).repartition("lang", "prefix")
            .groupBy("lang", "prefix", "phrase").agg(F.sum("n").alias("f")).drop("prefix"))


def bit_filter(phrases: DataFrame, n: int) -> Filter:
    """The phrases (lang, phrase) of n words as a filter. The driver gets ``FILTER_BITS`` bits at most."""
    def run(batches):
        for b in batches:
            hashes = [[] for _ in range(n)]
            for lang, phrase in zip(b.column("lang").to_pylist(), b.column("phrase").cast(pa.binary()).to_pylist(), strict=True):
                seed = xxhash.xxh3_64_intdigest(lang.encode())
                for h, w in zip(hashes, phrase.split(b" "), strict=True):
                    h.append(xxhash.xxh3_64_intdigest(w, seed))
            at = _bits([np.array(h, dtype=np.uint64) for h in hashes])
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))], names=["at", "bits"])

    rows = map_arrow(phrases.select("lang", "phrase"), run, "at long, bits long")
    found = rows.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(FILTER_BITS // 32, dtype="<u4")
    words[found.column("at").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return Filter(n, words.view(np.uint8))


def counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of up to ``longest`` words that occur ``least`` times or more, and (lang, n), the number
    of words."""
    words = materialize(runs(docs, 1).groupBy("lang", "phrase").agg(F.sum("n").alias("f")))
    totals = materialize(words.groupBy("lang").agg(F.sum("f").alias("n")))
    n = totals.agg(F.sum("n")).first()[0] or 0
    # at most a thousand words make up a thousandth of all
    hot = [r[0] for r in words.filter(F.col("f") * 1000 >= n).select(_cell(F.col("lang"), F.col("phrase"))).collect()]
    levels = [words.filter(F.col("f") >= least)]
    for size in range(2, longest + 1):
        known = bit_filter(levels[-1], size - 1)
        levels.append(materialize(merged(runs(docs, size, known), hot).filter(F.col("f") >= least)))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out, totals


def _join(words: Column) -> Column:
    return F.array_join(words, " ")


def _wide(c: str) -> Column:
    return F.col(c).cast("decimal(27,0)")


def scored(found: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of each phrase of two words or more: the lowest-scoring cut, then the shortest first part."""
    w = F.split("phrase", " ")
    cuts = F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda k: F.struct(
        k.alias("k"), _join(F.slice(w, 1, k)).alias("left"), _join(F.slice(w, k + 1, F.size(w))).alias("right")))
    rows = found.filter(F.size(w) > 1).select("lang", "phrase", F.col("f").alias("a"), F.explode(cuts).alias("c")).select(
        "lang", "phrase", "a", "c.*")
    rows = rows.join(found.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    rows = rows.join(found.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    rows = rows.select("lang", "phrase", "a", "k", "l", "r", _wide("a").alias("wa"), (_wide("l") + _wide("r")).alias("lr"))
    best = F.min(F.struct(F.expr("(2000000 * wa) div lr").alias("score"), "k", "l", "r")).alias("b")
    return rows.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "b.l", "b.r", "b.score")


def swallowed(found: DataFrame, share: int = SHARE) -> DataFrame:
    """(lang, phrase): phrases inside a longer one that occurs in at least ``share`` percent of the cases."""
    w = F.split("phrase", " ")
    part = lambda size: F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: _join(F.slice(w, i, size)))
    inside = F.flatten(F.transform(F.sequence(F.lit(2), F.size(w) - 1), part))
    longer = (found.filter(F.size(w) > 2).select("lang", F.col("f").alias("g"), F.explode(inside).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("g").alias("g")))
    rows = found.filter(F.size(w) > 1).join(longer, ["lang", "phrase"])
    return rows.filter(100 * _wide("g") >= share * _wide("f")).select("lang", "phrase")


def report(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    found, totals = counts(docs, least)
    rows = scored(found).join(swallowed(found), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
