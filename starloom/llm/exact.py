"""Exact de-duplication by content-defined chunk recipes.

1. Each text is normalised (A-Z to lower case) and cut where its content says so: after a cut pattern, at least
   ``LEAST`` and at most ``MOST`` characters on. Equal texts get equal cuts; shared passages share most chunks.
2. Chunks are de-duplicated: each distinct chunk crosses the network once per map task at most, however many
   documents hold it. Its identifier is a 128-bit hash, *verified* by that pass: no two distinct chunks may share it.
   Should two do so, the identifiers are widened to SHA-256 for all chunks.
3. A document becomes its recipe, the ordered list of chunk identifiers (16 bytes for about a thousand characters).
   Two texts are equal if and only if their recipes are, so documents are grouped by recipe and the long texts
   themselves are never moved or compared again.

Grouping aggregates on the map side, so a group with a third of all rows arrives as one row per map task; the join
back is an ordinary equi join whose hot keys adaptive execution splits.

Edge cases: null text counts as empty (its recipe is the empty list); equal texts keep the largest ``doc_id``; a null
``doc_id`` sorts below all others, and a group with no other id has a null ``keep_id`` and is kept; rows that repeat
both text and ``doc_id`` are one document: ``groups`` gives each of them the same answer, ``keep_documents`` returns the one
whose other columns, as JSON, come first; an empty table gives an empty result; other columns are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import keep, text_or_empty
from starloom.sources.store import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST, MOST = 512, 4096
#: A chunk ends after a space that follows one of the first pairs and precedes one of the last letters.
CUT_BEFORE, CUT_AFTER = "(?:[aeiou][dgnr]|[nrst]e)\\x20", "[acdefm]"


def normalised(name: str = "text") -> Column:
    return F.translate(text_or_empty(name), UPPER, LOWER)


def chunks_of(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The chunks of a text, in order; joined together they are the text again."""
    cut = f"(?s).{{{least},{most}}}?(?<={CUT_BEFORE})(?={CUT_AFTER})"
    return F.regexp_extract_all(text, F.lit(f"{cut}|(?s).{{1,{most}}}"), F.lit(0))


def wide_id(chunk: Column, bits: int = 128) -> Column:
    """128 bits of hash as two longs; fewer bits (for tests) make clashes likely."""
    a, b = F.xxhash64(chunk), F.xxhash64(F.lit(1), chunk)
    if bits < 64:
        a, b = F.shiftrightunsigned(a, 64 - bits), F.lit(0).cast("long")
    return F.struct(a.alias("a"), b.alias("b"))


def verified(chunks: DataFrame) -> bool:
    """Whether each identifier in (id, chunk) names one chunk. One job; only identifiers that clash, normally none,
    are written (to the shared checkpoint folder)."""
    clash = chunks.distinct().groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
    return materialize(clash).isEmpty()


def recipes(docs: DataFrame, bits: int = 128) -> DataFrame:
    """(doc_id, text_sha256, recipe), the recipe made of verified chunk identifiers."""
    base = keep(docs.select("doc_id", "text"), "_t", normalised())
    base = keep(base, "_c", chunks_of(F.col("_t")))
    chunks = base.select(F.explode("_c").alias("chunk")).select(wide_id(F.col("chunk"), bits).alias("id"), "chunk")
    name = (lambda c: wide_id(c, bits)) if verified(chunks) else (lambda c: F.sha2(c, 256))
    return base.select("doc_id", F.sha2("_t", 256).alias("text_sha256"), F.transform("_c", name).alias("recipe"))


def groups(docs: DataFrame, bits: int = 128) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = recipes(docs, bits)
    totals = rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return rows.join(totals, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def _key(sha: Column) -> Column:
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), sha)


def others(docs: DataFrame) -> Column:
    """The columns beside id and text as one string, by which rows that repeat a document are told apart in a fixed order."""
    names = [c for c in docs.columns if c not in ("doc_id", "text")]
    return F.to_json(F.struct(*names)) if names else F.lit("")


def keep_documents(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns. The full rows are shuffled once, for the semi join; the
    choice among rows that repeat a document reuses that partitioning and order."""
    kept = groups(docs).filter("kept").select(_key(F.col("text_sha256")).alias("_key"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), _key(F.sha2(normalised(), 256)).alias("_key"), others(docs).alias("_o"),
                       F.xxhash64(text_or_empty()).alias("_t"))
    one = Window.partitionBy("_key").orderBy("_o", "_t", "_row.text")
    return (rows.join(kept, "_key", "left_semi").withColumn("_n", F.row_number().over(one))
            .filter("_n = 1").select("_row.*"))
