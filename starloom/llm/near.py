"""Near-duplicate documents by ProbMinHash over weighted word shingles.

A document is the weighted set of its five-word shingles (weight 1 + ln of the count; a shorter text is one shingle of
all its words). Similarity is the probability Jaccard index J_P of two such sets, which equals the Jaccard index where
all weights are equal.

1. Sketch: every shingle starts a Poisson process whose rate is its weight; its arrivals hit random registers, a
   register keeps the shingle that hit it first. A shingle stops when its next arrival is later than the latest first
   hit of its document (early termination). Two documents agree in a register with probability J_P.
2. Texts with equal word sequences are collapsed first; what follows works on one representative of each.
3. Banding: representatives that agree in all ``ROWS`` registers of one of ``BANDS`` bands share a bucket. In each
   bucket the member that shares buckets with the most others leads; every member is compared with its leader, so a
   bucket of n costs n comparisons, not n^2 / 2.
4. Verification: J_P of the pair is computed exactly from the two texts; from ``THRESHOLD`` on it is a link.
5. Links are closed to classes (connected components, alternating star contraction). Where a bucket still has members
   of several classes, its members outside the leader's class are compared with all members of other classes, and
   the classes are closed again. Pairs that can't be links are left out before: 1 - J_P is a metric, so two texts whose
   similarities to the leader differ by more than 1 - ``THRESHOLD`` aren't linked; and finer sketches (``FINE`` registers,
   four bits of each, of these texts only) that agree ``FINE_SIGMAS`` standard deviations less often than at the
   threshold rule a pair out (a link is lost so with probability 3e-6). In the end any two members of a bucket are in
   one class, or have been compared, or are ruled out.

Scale: bucket leaders and collapses are aggregates with map-side combine, lookups are equi joins that adaptive
execution splits at hot keys; no list of a group is ever built. What later steps read more than once is written as
Parquet to the shared checkpoint folder.

Edge cases: a null text counts as empty; texts without words form one class (equal word sequences); very long texts are
sketched whole; a null ``doc_id`` is allowed and never names a class that has another id; rows that repeat a document
are copies of it; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import map_arrow, slices, text_or_empty
from starloom.llm.exact import others
from starloom.llm.wordhash import U, Words, mix
from starloom.sources.store import materialize

SHINGLE = 5
THRESHOLD = 0.8
#: A pair of similarity 0.8 shares no band with probability (1 - 0.8^5)^28 = 1.5e-5.
BANDS, ROWS = 28, 5
#: Registers of the finer sketches, a multiple of 16.
FINE, FINE_SIGMAS = 448, 4.5
SLICE_BYTES = 1_000_000


# ------------------------------------------------------------------------------------------------ sketches
def weighted(words: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, shingle, weight) of the distinct shingles of each text, ordered by doc."""
    at, h = words.windows(k)
    doc = words.doc[at]
    short = np.flatnonzero((words.count > 0) & (words.count < k))
    if len(short):
        c, _ = words.content()
        doc, h = np.concatenate([doc, short]), np.concatenate([h, c[short]])
    if not len(h):
        return doc, h, np.empty(0)
    order = np.argsort(h)  # equal shingles together; then, stably, by text
    order = order[np.argsort(doc[order], kind="stable")]
    doc, h = doc[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]))
    count = np.diff(np.concatenate([new, [len(h)]]))
    return doc[new], h[new], 1.0 + np.log(count)


def sketch(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """ProbMinHash registers, shape (n_docs, m): the shingle whose process reached the register first; 0 for a text
    without shingles. All documents advance together, one arrival of each running process per round."""
    first = np.full(n_docs * m, np.inf)
    who = np.zeros(n_docs * m, dtype=np.uint64)
    t = np.zeros(len(doc))
    last = np.full(n_docs, np.inf)
    step = 0
    while len(doc):
        step += 1
        r = mix(shingle + U(step * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        t = t - np.log(((r >> U(11)).astype(np.float64) + 1.0) * 2.0**-53) / weight
        on = t < last[doc]
        if not on.all():
            doc, shingle, weight, t, r = doc[on], shingle[on], weight[on], t[on], r[on]
            if not len(doc):
                break
        register = ((mix(r) >> U(32)) * U(m) >> U(32)).astype(np.int64) + doc * m
        np.minimum.at(first, register, t)
        won = t == first[register]
        who[register[won]] = shingle[won]
        live = np.flatnonzero(np.bincount(doc, minlength=n_docs))
        last[live] = first.reshape(n_docs, m)[live].max(axis=1)
    return who.reshape(n_docs, m)


def band_keys(registers: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band of each document, shape (n_docs, bands)."""
    out = np.zeros((len(registers), bands), dtype=np.uint64)
    for i in range(rows):
        out = mix(out + registers[:, i::rows][:, :bands] + U(i + 1))
    return mix(out + np.arange(bands, dtype=np.uint64) * U(0x9E3779B97F4A7C15))


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, c1, c2, bands): the word sequence's 128-bit hash and the band keys (empty: no words)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_hash", "c1", "c2", "bands"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(2).cast(pa.binary()).to_pylist(), len, SLICE_BYTES):
                words = Words(part)
                c1, c2 = words.content()
                keys = band_keys(sketch(*weighted(words), len(part), BANDS * ROWS)).astype("<i8")
                sizes = np.where(words.count > 0, BANDS, 0)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                    pa.array(keys[words.count > 0].reshape(-1), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), batch.column(1).slice(at, len(part)),
                     pa.array(c1.astype(np.int64)), pa.array(c2.astype(np.int64)), lists], names=names)
                at += len(part)

    text = text_or_empty()
    return map_arrow(docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text")),
                     run, f"doc_id {id_type}, text_hash long, c1 long, c2 long, bands array<long>")


# ------------------------------------------------------------------------------------------------ verification
def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """J_P of two weighted sets given as (sorted shingles, weights): the sum, over the common shingles d, of
    1 / sum over all d' of max(a[d'] / a[d], b[d'] / b[d])."""
    (sa, wa), (sb, wb) = a, b
    if not len(sa) or not len(sb):
        return float(len(sa) == len(sb))
    _, ia, ib = np.intersect1d(sa, sb, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    total_a, total_b = wa.sum(), wb.sum()
    common_a, common_b = wa[ia], wb[ib]
    only_a, only_b = total_a - common_a.sum(), total_b - common_b.sum()
    ratio, inverse = np.unique(common_a / common_b, return_inverse=True)
    whole = np.array([only_a + x * only_b + np.maximum(common_a, x * common_b).sum() for x in ratio])
    return float((common_a / whole[inverse]).sum())


def shingles_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    _, h, w = weighted(Words([text]))
    return h, w


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) with their similarity. The rows of one b come together (the join sorts by it), so its shingles
    are computed once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, other = None, None
        for batch in batches:
            sims = []
            for b, text_a, text_b in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if other is None or b != last:
                    last, other = b, shingles_of(text_b.as_py().encode())
                sims.append(probability_jaccard(shingles_of(text_a.as_py().encode()), other))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sims, pa.float64())],
                                             names=["a", "b", "similarity"])

    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return map_arrow(both.select("a", "b", "text_a", "text_b"), run, "a long, b long, similarity double")


def links(pairs: DataFrame, threshold: float) -> DataFrame:
    return pairs.filter(F.col("similarity") >= threshold - 1e-9).select("a", "b")


# ------------------------------------------------------------------------------------------------ finer sketches
def fine_sketches(texts: DataFrame, registers: int = FINE) -> DataFrame:
    """(node, fine): four bits of each register, sixteen registers to a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = (np.arange(16) * 4).astype(np.uint64)
        for batch in batches:
            at = 0
            for part in slices(batch.column(1).cast(pa.binary()).to_pylist(), len, SLICE_BYTES):
                r = sketch(*weighted(Words(part)), len(part), registers)
                nibbles = (mix(r) & U(15)).reshape(len(part), -1, 16)
                packed = (nibbles << shift).sum(axis=2, dtype=np.uint64).astype(np.int64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(packed.reshape(-1)), registers // 16)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), lists.cast(pa.list_(pa.int64()))],
                                                 names=["node", "fine"])
                at += len(part)

    return map_arrow(texts.select("node", "text"), run, "node long, fine array<long>")


def least_agreement(threshold: float, registers: int = FINE) -> int:
    """The agreeing nibbles that a pair at the threshold has, less ``FINE_SIGMAS`` standard deviations."""
    p = threshold + (1 - threshold) / 16
    return int(registers * p - FINE_SIGMAS * (registers * p * (1 - p)) ** 0.5)


def agreement(x: str, y: str, registers: int = FINE) -> Column:
    """How many nibbles of two packed sketches are equal."""
    total = F.lit(0)
    for i in range(registers // 16):
        d = F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2)).bitwiseAND(F.lit(0x1111111111111111))
        total = total + (16 - F.bit_count(d))
    return total


def first_common_band(x: str, y: str, band: str) -> Column:
    """Whether two lists of band keys agree in no band before this one: a pair is formed in its first common bucket."""
    earlier = F.lit(False)
    for i in range(BANDS - 1):
        earlier = earlier | ((F.col(band) > i) & (F.get(x, F.lit(i)) == F.get(y, F.lit(i))))
    return ~earlier


# ------------------------------------------------------------------------------------------------ classes
def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b): root is the smallest node it is connected with. Alternating
    large-star and small-star contraction: every round replaces links by links to smaller neighbours, in a number of
    rounds that grows with the logarithm of the longest chain."""
    links = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .filter("u <> v").distinct())
    before = None
    while True:
        sides = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sides.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter(
            "u <> v").distinct()
        large = materialize(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        links = materialize(small.filter("u <> v").distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return links.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")


def labelled(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes: those without links are their own root."""
    return nodes.select("node").join(components(edges), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"))


def led_by_hubs(shared: DataFrame) -> DataFrame:
    """(key, band, node, lead): each bucket's leader is its member with the most fellow members over all bands (then the
    largest node). The text in the middle of a family meets more of it than any other, so most of a family's buckets
    get one leader, and the one that most members are linked with."""
    fellows = shared.groupBy("node").agg(F.sum("n").alias("fellows"))
    rows = shared.select("key", "band", "node").join(fellows, "node")
    hub = rows.groupBy("key").agg(F.max(F.struct("fellows", "node")).alias("hub"))
    return rows.join(hub, "key").select("key", "band", "node", F.col("hub.node").alias("lead"))


def across_classes(members: DataFrame, label: DataFrame, led_pairs: DataFrame, reps: DataFrame, texts: DataFrame,
                   threshold: float) -> DataFrame:
    """The pairs (a, b) of buckets that hold several classes which are still to be compared: between a member outside
    the leader's class and one of another class, neither the leader, once per pair, unless ruled out."""
    named = members.join(label, "node")
    mixed = named.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("n"),
                                     F.min(F.when(F.col("node") == F.col("lead"), F.col("root"))).alias("lead_root"))
    mixed = mixed.filter("r0 <> r1 and n > 2").select("key", "lead_root")
    rows = materialize(named.filter("node <> lead").join(mixed, "key"))
    sims = led_pairs.select(F.col("a").alias("node"), F.col("b").alias("lead"), F.col("similarity").alias("s"))
    own = rows.select("node").distinct()
    sketches = fine_sketches(own.join(texts, "node")).join(reps.select("node", "bands"), "node")
    rows = rows.join(sims, ["node", "lead"]).join(sketches, "node")
    side = lambda c: [F.col(x).alias(f"{x}_{c}") for x in ("node", "root", "s", "bands", "fine")]
    x = rows.filter("root <> lead_root").select("key", "band", F.col("lead_root").alias("main"), *side("x"))
    y = rows.select("key", *side("y"))
    once = (F.col("root_y") == F.col("main")) | (F.col("node_x") > F.col("node_y"))
    pairs = x.join(y, "key").filter(
        (F.col("root_x") != F.col("root_y")) & once & (F.abs(F.col("s_x") - F.col("s_y")) <= 1 - threshold + 1e-9)
        & first_common_band("bands_x", "bands_y", "band") & (agreement("fine_x", "fine_y") >= least_agreement(threshold)))
    return pairs.select(F.greatest("node_x", "node_y").alias("a"), F.least("node_x", "node_y").alias("b"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, text_hash, root (the class), class_id (the smallest doc_id of the class),
    class_size, n_texts (the different word sequences of the class)."""
    rows = materialize(sketched(docs))
    reps = materialize(
        rows.groupBy("c1", "c2").agg(F.min(F.struct("doc_id", "text_hash")).alias("r"), F.count("*").alias("copies"),
                                     F.min("doc_id").alias("min_id"), F.first("bands").alias("bands"))
        .select(F.monotonically_increasing_id().alias("node"), "c1", "c2", "r.*", "copies", "min_id", "bands"))
    buckets = reps.select("node", F.posexplode("bands").alias("band", "key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = materialize(led_by_hubs(materialize(buckets.join(shared, "key"))))
    first = members.filter("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()

    ids = members.select("node").distinct().join(reps, "node").select("node", "doc_id", "text_hash")
    source = docs.select(F.col("doc_id").alias("_id"), text_or_empty().alias("text"))
    source = source.withColumn("_h", F.xxhash64("text"))
    found = ids.join(source, ids["doc_id"].eqNullSafe(source["_id"]) & (ids["text_hash"] == source["_h"]))
    one = Window.partitionBy("node").orderBy("node")  # of rows that repeat a document
    texts = materialize(found.select("node", "text").withColumn("_n", F.row_number().over(one)).filter("_n = 1")
                        .select("node", "text"))

    led_pairs = materialize(compared(first, texts))
    label = materialize(labelled(reps, links(led_pairs, threshold)))
    more = materialize(across_classes(members, label, led_pairs, reps, texts, threshold))
    if not more.isEmpty():
        extra = links(materialize(compared(more, texts)), threshold)
        if not extra.isEmpty():
            label = materialize(labelled(reps, links(led_pairs, threshold).unionByName(extra)))

    owned = reps.join(label, "node")
    named_class = owned.groupBy("root").agg(F.min("min_id").alias("class_id"), F.sum("copies").alias("class_size"),
                                            F.count("*").alias("n_texts"))
    per_text = owned.select("c1", "c2", "root").join(named_class, "root")
    return rows.select("doc_id", "text_hash", "c1", "c2").join(per_text, ["c1", "c2"]).select(
        "doc_id", "text_hash", "root", "class_id", "class_size", "n_texts")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, n_texts, kept (it names its class)."""
    return classes(docs).select("doc_id", "class_id", "class_size", "n_texts",
                                F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def keep_documents(docs: DataFrame) -> DataFrame:
    """One document of each class, with its own columns."""
    key = lambda h: F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), h)
    best = (classes(docs).groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash"))
                                              .alias("b")).select("b.*").select(key(F.col("text_hash")).alias("_key")))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), key(F.xxhash64(text_or_empty())).alias("_key"), others(docs).alias("_o"))
    one = Window.partitionBy("_key").orderBy("_o")  # rows that repeat a document differ in other columns at most
    return (rows.join(best, "_key", "left_semi").withColumn("_n", F.row_number().over(one)).filter("_n = 1")
            .select("_row.*"))
