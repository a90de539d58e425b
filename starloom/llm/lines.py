"""Line de-duplication over overlapping windows of three lines.

The lines of a text that hold a word are numbered; every three consecutive ones form a window, known by 128 bits of
hash. Of equal windows anywhere in the table, the first (smallest ``doc_id``, then smallest position) is the original;
the lines covered by later ones go. Covered positions are merged to intervals first, and a text is rebuilt from the
stretches between them (lines without a word inside an interval go with it, all others stay).

Scale: windows are aggregated on the map side, so a line block in a third of all documents arrives as one row per map
task; the join that hands the verdict back to the windows is an equi join that adaptive execution splits. Texts are
shuffled once, to meet their intervals. Everything is built-in expressions.

Edge cases: a null text has no lines and comes back empty; texts with fewer than three lines stay; a null ``doc_id``
comes after all others; ids may be of any type with an order; rows that repeat both id and text are one document (they take nothing from each other), rows
with the same id and different texts are two; long texts are handled in time proportional to their length; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import WORD, keep, text_or_empty

LINES = 3


def _lined(docs: DataFrame) -> DataFrame:
    """(doc, th, lines, at): the lines of each text and the positions of those with a word."""
    rows = docs.select(F.col("doc_id").alias("doc"), text_or_empty().alias("text"))
    rows = keep(rows.withColumn("th", F.xxhash64("text")), "lines", F.split("text", "\n", -1))
    at = F.filter(F.transform("lines", lambda x, i: F.when(x.rlike(WORD), i)), lambda i: i.isNotNull())
    return keep(rows.select("doc", "th", "lines"), "at", at)


def windows(docs: DataFrame, size: int = LINES) -> DataFrame:
    """(doc, th, k, h1, h2): window k covers the numbered lines k to k + size - 1."""
    rows = _lined(docs).filter(F.size("at") >= size)
    rows = keep(rows, "_l", F.transform("at", lambda i: F.get("lines", i)))
    part = lambda k: [F.get("_l", k + j) for j in range(size)]
    each = F.transform(F.sequence(F.lit(0), F.size("_l") - size), lambda k: F.struct(
        k.alias("k"), F.xxhash64(*part(k)).alias("h1"), F.xxhash64(F.lit(1), *part(k)).alias("h2")))
    return rows.select("doc", "th", F.explode(each).alias("w")).select("doc", "th", "w.*")


def later(docs: DataFrame, size: int = LINES) -> DataFrame:
    """(doc, th, ks): the windows of each document that aren't their text's first."""
    rows = windows(docs, size)
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "th", "k")  # null ids last
    first = rows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    repeats = rows.join(first, ["h1", "h2"]).filter(~place.eqNullSafe(F.col("first")))
    return repeats.groupBy("doc", "th").agg(F.sort_array(F.collect_set("k")).alias("ks"))


def intervals(ks: Column, size: int = LINES) -> Column:
    """Sorted window positions merged to (s, e): numbered lines s to e - 1. Two passes mark where a run of overlapping
    or touching windows begins and ends."""
    begins = F.filter(ks, lambda k, i: F.coalesce(k > F.get(ks, i - 1) + size, F.lit(True)))
    ends = F.transform(F.filter(ks, lambda k, i: F.coalesce(F.get(ks, i + 1) > k + size, F.lit(True))), lambda k: k + size)
    return F.zip_with(begins, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e")))


def deduplicated(docs: DataFrame, size: int = LINES) -> DataFrame:
    """One row per document: doc_id, n_lines (with a word), n_removed, kept_text."""
    gone = later(docs, size).withColumnsRenamed({"doc": "_doc", "th": "_th"})
    rows = _lined(docs).join(gone, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("th") == F.col("_th")), "left")
    rows = keep(rows, "gone", F.when(F.col("ks").isNotNull(), intervals(F.col("ks"), size)))
    # the stretches between intervals, as 1-based beginnings and lengths in ``lines``
    n = F.size("gone")
    stretch = lambda i: F.slice(
        "lines",
        F.when(i == 0, F.lit(1)).otherwise(F.get("at", F.get("gone", i - 1)["e"] - 1) + 2),
        F.when(i == n, F.size("lines")).otherwise(F.get("at", F.get("gone", i)["s"]))
        - F.when(i == 0, F.lit(0)).otherwise(F.get("at", F.get("gone", i - 1)["e"] - 1) + 1))
    parts = F.flatten(F.transform(F.sequence(F.lit(0), n), stretch))
    removed = F.aggregate("gone", F.lit(0).cast("long"), lambda a, g: a + (g["e"] - g["s"]))
    return rows.select(
        F.col("doc").alias("doc_id"), F.size("at").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), F.lit(0).cast("long")).otherwise(removed).alias("n_removed"),
        F.when(F.col("gone").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(parts, "\n")).alias("kept_text"))
