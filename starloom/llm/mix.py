"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule w(t) over training time t in [0, 1]. Its integral, scaled to the source's target, is
the source's cumulative demand of words D(t). The source's documents, in a fixed shuffled order and repeated as often
as needed, form a stream of words; the copy that starts at word x of the stream is trained on at the time t with
D(t) = x, so the inverse of the demand assigns its position. Sorting all copies by position (a range shuffle) gives
the mixed training order, in which every stretch follows the schedules.

Targets: sources by code point (null last) weigh 1, 2, 3, 1, ... and share all words by weight; a target stops at three
times its source's size and the excess is reshared by weight among the rest. That fixed point has a closed form:
with the sources in order of cap / weight, the level L is the largest of (total - caps before) / (weights from here
on), and target = least(cap, L * weight).

Scale: a source may hold a third of all rows, so its order is cut by hash into 2^``BUCKET_BITS`` buckets. Bucket sums are
aggregated on the map side and prefix-summed (a row per source and bucket); running sums then need only the rows of
one bucket together. Only the table of sources, one row each, is ever ordered as a whole.

Edge cases: null or empty texts have size 0 and are not taken; a null source is a source; null ids are allowed; ties
(repeated rows) are interchangeable, the totals don't depend on which goes first; an empty table gives an empty
result; the last copy of a source may be cut, so that the words taken equal the target rounded down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import WORD, text_or_empty
from starloom.sources.store import materialize

BUCKET_BITS = 10
MAX_COPIES = 3
#: Weight at the beginning and the end of training, in turn over the sources; each pair sums to 2, so that the
#: integral over all of training is 1.
SCHEDULES = ((1.5, 0.5), (0.5, 1.5), (1.0, 1.0))


def sized(docs: DataFrame, *carry: str) -> DataFrame:
    """Add the word count, the key of the source and the place in the source's shuffled order."""
    t = text_or_empty()
    order = F.conv(F.substring(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), t)), 1, 15),
                   16, 10).cast("long")  # 60 bits
    return docs.select(
        "doc_id", F.regexp_count(t, F.lit(WORD)).cast("long").alias("size"),
        F.col("source").isNull().alias("no_source"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"),
        order.alias("place"), F.shiftright(order, 60 - BUCKET_BITS).alias("bucket"), *carry)


def targets(bucket_sums: DataFrame) -> DataFrame:
    """Per source: its size, weight and schedule, and the words to take of it. ``bucket_sums``: (no_source, name, size)
    rows that add up to the sources."""
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    src = bucket_sums.groupBy("no_source", "name").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("no_source", "name")) - 1
    src = src.select("*", rank.alias("rank")).withColumn("weight", (F.col("rank") % 3 + 1).cast("long"))
    cap = MAX_COPIES * F.col("source_size")
    by_ratio = Window.orderBy(cap / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weights = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    src = src.withColumn("level", left.cast("double") / weights.cast("double"))
    src = src.withColumn("target", F.least(cap.cast("double"), F.max("level").over(every) * F.col("weight")))
    pick = lambda i: F.array(*[F.lit(s[i]) for s in SCHEDULES])
    nth = (F.col("rank") % len(SCHEDULES)).cast("int")
    return src.select("no_source", "name", "source_size", "target", F.get(pick(0), nth).alias("w_begin"),
                      F.get(pick(1), nth).alias("w_end"))


def when_reached(share: Column, begin: Column, end: Column) -> Column:
    """The time by which a linear schedule from ``begin`` to ``end`` has used up ``share`` of its integral:
    solves begin * t + (end - begin) * t^2 / 2 = share."""
    slope = end - begin
    root = F.sqrt(F.greatest(begin * begin + 2 * slope * share, F.lit(0.0)))
    return F.when(slope == 0, share).otherwise(2 * share / (begin + root))


def placed(rows: DataFrame) -> DataFrame:
    """Add ``source_size``, ``target`` and ``starts``: the word of the source's stream at which each document's first
    copy begins, with the schedule's ends."""
    key = ["no_source", "name", "bucket"]
    sums = rows.groupBy(*key).agg(F.sum("size").alias("size"))
    earlier = Window.partitionBy("no_source", "name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = materialize(sums)  # else each use would count all words again
    sums = sums.withColumn("bucket_start", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    heads = sums.drop("size").join(targets(sums), ["no_source", "name"])
    inside = Window.partitionBy(*key).orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return rows.join(heads, key).withColumn("starts", F.col("bucket_start") + F.col("_in")).drop("_in", "bucket_start")


def copies(df: DataFrame) -> Column:
    """The copies of a placed document that the mix takes: (copy, words, position), at most ``MAX_COPIES``."""
    demand = F.floor("target").cast("long")

    def one(j: Column) -> Column:
        at = F.col("starts") + j * F.col("source_size")
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), demand - at))
        share = F.when(F.col("target") > 0, at / F.col("target")).otherwise(F.lit(0.0))
        return F.struct(j.cast("int").alias("copy"), words.alias("words"),
                        when_reached(share, F.col("w_begin"), F.col("w_end")).alias("position"))

    return F.filter(F.array(*[one(F.lit(j)) for j in range(MAX_COPIES)]), lambda c: c["words"] > 0)


def mixture(docs: DataFrame) -> DataFrame:
    """One row per document, range-sorted by the position of its first copy: doc_id, size, source_size, target, taken,
    n_copies, position (null: not taken)."""
    out = placed(materialize(sized(docs))).withColumn("_c", copies(docs))
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id", "size", "source_size", "target",
        F.aggregate("_c", zero, lambda a, c: a + c["words"]).alias("taken"),
        F.size("_c").cast("long").alias("n_copies"), F.get(F.col("_c"), F.lit(0))["position"].alias("position"),
    ).repartitionByRange(F.col("position").asc_nulls_last(), F.col("doc_id")).sortWithinPartitions(
        F.col("position").asc_nulls_last(), "doc_id")


def training_order(docs: DataFrame) -> DataFrame:
    """The copies the mix takes, as documents in training order (range-sorted by position). A copy of which only the
    first words are taken is cut after them; ``n_chars``, where there is one, follows the text."""
    rows = docs.withColumn("_row", F.struct(*docs.columns))
    out = placed(sized(rows, "_row")).withColumn("_c", F.explode(copies(docs)))
    pieces = F.split("_row.text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    text = F.when(F.col("_c.words") == F.col("size"), F.col("_row.text")).otherwise(
        F.array_join(F.slice(pieces, F.lit(1), F.col("_c.words").cast("int")), ""))
    out = out.repartitionByRange("_c.position", "doc_id", "_c.copy").sortWithinPartitions(
        "_c.position", "doc_id", "_c.copy")
    cut = {"text": text}
    if "n_chars" in docs.columns:
        cut["n_chars"] = F.when(F.col("_c.words") == F.col("size"), F.col("_row.n_chars")).otherwise(
            F.length(text)).cast(docs.schema["n_chars"].dataType)
    return out.select(*[cut[c].alias(c) if c in cut else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
