"""CSV whose quoted values hold line breaks, read by many tasks a file.

Whether a line starts a record depends on all quotes before it. Each line is looked at twice, as if it stood outside and as
if it stood inside a quoted value, which gives a map of two states; lines and byte ranges compose their maps, so a range
needs nothing of the ranges before it but one state. That is one scan within the ranges and one over the table of ranges:

1. the text source reads byte ranges of the files as lines; per range, a running scan gives the state before each line and
   the number of records started so far, for both states in which the range may begin;
2. a scan over the ranges of a file (a row each) gives the state in which each begins, and the last record that started
   before it, to which its first lines belong if it begins inside a value;
3. a line that is a record by itself passes as it is; only lines of records that hold breaks are grouped.

A quote that isn't closed up to the end of its file makes the rest of the file broken, line by line: no record is made of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.sources.store import materialize

CORRUPT = "_corrupt_record"

#: Whole values, each with its comma, then a quoted value that is still open at the end of the line. A quote opens a value
#: only as its first character; what follows a closing quote up to the comma belongs to the value.
_OPEN_AT_END = r'(?s)^(?:(?:"(?:[^"]++|"")*+"(?!")[^,]*+|[^",][^,]*+|),)*+"(?:[^"]++|"")*+$'


def _running(outside: Column, inside: Column, group: list[str], order: str) -> tuple[Column, Column]:
    """The states before each row, if the group begins outside (0) and if it begins inside (1) a quoted value.

    ``outside``, ``inside``: the state behind the row for each state before it. Rows that give the same state for both fix
    it; since the last such row it has been turned over by each row that swaps the two."""
    upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    swaps = (outside > inside).cast("int")
    fixed = F.when(outside == inside, F.struct(outside.alias("state"), F.sum(swaps).over(upto).alias("swaps")))
    last = F.last(fixed, ignorenulls=True).over(before)
    turned = F.coalesce(F.sum(swaps).over(before), F.lit(0))
    since = F.when(last.isNotNull(), last["state"] + turned - last["swaps"])
    return (F.coalesce(since, turned) % 2).cast("int"), (F.coalesce(since, turned + 1) % 2).cast("int")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line_id, line, out0, out1): the lines of all byte ranges. ``line_id`` rises within a range."""
    text = spark.read.option("lineSep", "\n").text(path)
    line = F.col("value")
    open_at_end = lambda c: F.when(F.contains(c, F.lit('"')), c.rlike(_OPEN_AT_END)).otherwise(False).cast("int")
    # a line without a quote leaves either state as it is
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("line_id"), line.alias("line"),
                       open_at_end(line).alias("out0"),
                       F.when(F.contains(line, F.lit('"')), open_at_end(F.concat(F.lit('"'), line))).otherwise(1).alias("out1"))


def _numbered(lines: DataFrame) -> DataFrame:
    """Adds the state before each line (``s0``, ``s1``) and the records started up to it (``n0``, ``n1``) for a range that
    begins outside and for one that begins inside a value."""
    s0, s1 = _running(F.col("out0"), F.col("out1"), ["file", "block"], "line_id")
    upto = Window.partitionBy("file", "block").orderBy("line_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (lines.withColumns({"s0": s0, "s1": s1})
            .withColumns({"n0": F.sum(1 - F.col("s0")).over(upto), "n1": F.sum(1 - F.col("s1")).over(upto)}))


def _ranges(numbered: DataFrame) -> DataFrame:
    """Per byte range: the state in which it begins, the last record that started before it, and whether the file's last
    record stays open and which it is."""
    behind = lambda s: F.when(F.col(s) == 0, F.col("out0")).otherwise(F.col("out1"))
    totals = numbered.groupBy("file", "block").agg(
        F.max_by(F.struct(behind("s0").alias("e0"), behind("s1").alias("e1"), "n0", "n1"), "line_id").alias("t")
    ).select("file", "block", "t.*")
    begin, _ = _running(F.col("e0"), F.col("e1"), ["file"], "block")
    states = totals.withColumn("begin", begin)
    started = F.when(F.col("begin") == 0, F.col("n0")).otherwise(F.col("n1"))
    own = F.when(started > 0, F.struct("block", started.alias("n")))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    end = F.last(F.when(F.col("begin") == 0, F.col("e0")).otherwise(F.col("e1"))).over(whole)
    return states.select("file", "block", "begin", F.last(own, ignorenulls=True).over(before).alias("carried"),
                         F.when(end == 1, F.last(own, ignorenulls=True).over(whole)).alias("unclosed"),
                         F.min("block").over(whole).alias("first_block"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, first, closed): the records of CSV files as texts. ``first`` marks a file's first record (its header, if
    it has one); ``closed`` is false for the lines behind a quote that is never closed, which come one by one."""
    numbered = materialize(_numbered(_lines(spark, path)))
    ranges = materialize(_ranges(numbered))
    j = numbered.join(ranges, ["file", "block"])
    inside = F.when(F.col("begin") == 0, F.col("s0")).otherwise(F.col("s1"))
    n = F.when(F.col("begin") == 0, F.col("n0")).otherwise(F.col("n1"))
    behind = F.when(inside == 0, F.col("out0")).otherwise(F.col("out1"))
    of = F.when(n > 0, F.struct("block", n.alias("n"))).otherwise(F.col("carried"))
    j = j.select("file", "block", "line_id", "line", of.alias("of"), "unclosed", "first_block",
                 ((inside == 0) & (behind == 0)).alias("alone"))
    j = j.withColumn("closed", ~F.col("of").eqNullSafe(F.col("unclosed")))
    first = (F.col("of.block") == F.col("first_block")) & (F.col("of.n") == 1)
    single = j.filter(F.col("alone") | ~F.col("closed")).select(
        "file", F.col("line").alias("record"), first.alias("first"), "closed")
    joined = (j.filter(~F.col("alone") & F.col("closed")).groupBy("file", "of", "first_block")
              .agg(F.sort_array(F.collect_list(F.struct("block", "line_id", "line"))).alias("lines"))
              .select("file", F.array_join(F.col("lines.line"), "\n").alias("record"), first.alias("first"),
                      F.lit(True).alias("closed")))
    return single.unionByName(joined).withColumn("record", F.regexp_replace("record", r"\r\z", ""))


def read_csv_ranges(spark: SparkSession, path: str, columns: Sequence[str], names: Sequence[str] | None = None
                    ) -> tuple[DataFrame, DataFrame]:
    """Read a CSV extract (UTF-8) as text columns by byte ranges: ``(good, bad)``, which partition its records.

    Columns are bound by the header's names (a requested column that it lacks is NULL; files whose headers differ fail), or
    by ``names`` for files without a header. Quoted values may hold line breaks and commas, doubled quotes are quotes, an
    empty value is NULL. Records with too few or too many values, and all lines behind a quote that is never closed, go to
    ``bad`` as they are (column ``line``). Empty lines between records are no records. The lines are shuffled once, by
    byte range, and written to the shared checkpoint folder; a record, not a file, has to fit a task's memory."""
    records = csv_records(spark, path)
    if names is None:
        headers = [r["record"] for r in records.filter("first and closed").select("record").distinct().limit(2).collect()]
        if len(headers) > 1:
            raise ValueError(f"files under {path} have different headers")
        names = _values(spark, headers[0].removeprefix("\ufeff")) if headers else []
        records = records.filter("not first or not closed")
    rows = records.filter("record <> ''")
    place = {c: f"c{i}" for i, c in enumerate(names)}
    schema = ", ".join(f"{p} string" for p in [*place.values(), CORRUPT])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"', "multiLine": "true",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1"}
    parsed = materialize(rows.select("record", "closed", F.from_csv("record", schema, options).alias("v")))
    broken = ~F.col("closed") | F.col(f"v.{CORRUPT}").isNotNull()
    good = parsed.filter(~broken).select(
        *[(F.col(f"v.{place[c]}") if c in place else F.lit(None).cast("string")).alias(c) for c in columns])
    return good, parsed.filter(broken).select(F.col("record").alias("line"))


def _values(spark: SparkSession, header: str) -> list[str]:
    """The names in a header line."""
    at_most = header.count(",") + 1
    schema = ", ".join(f"c{i} string" for i in range(at_most))
    row = spark.range(1).select(F.from_csv(F.lit(header), schema, {"escape": '"', "multiLine": "true"}).alias("v")).first()["v"]
    return [v for v in row if v is not None]
