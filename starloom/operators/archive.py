"""Versioned archive: initial load and change capture by snapshot diff.

An archive row is one version of a source row: the business columns (id renamed ``original_<x>_id``) plus
``load_timestamp``, ``valid_from_timestamp`` and ``valid_to_timestamp``; the open version has
``valid_to_timestamp = 9999-12-31 23:59:59``.

The diff is one full-outer join of the current source snapshot with the *open* archive versions on the id. Change hashes are
compared behind the join, and only of rows in which some compared value differs. Every row of the result carries an ``op``:

* ``I`` new id (only in the source)          -> a new open version
* ``D`` deleted id (only in the archive)      -> the open version is closed at ``run_ts - 1 µs``
* ``U`` hash differs                          -> closed, and a new open version inserted
* ``N`` unchanged                             -> the open version stays as it is

``closed_versions`` / ``new_versions`` / ``open_after`` / ``change_counts`` are projections of the same diff, so a
runner materialises the diff once and derives all outputs from it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.clean import minus_one_micro
from starloom.functions.hashing import row_hash, value_hash
from starloom.session import FAR_FUTURE, ts_lit
from starloom.sources import buckets as B
from starloom.spec import EntitySpec

LOAD_TS = "load_timestamp"
VALID_FROM = "valid_from_timestamp"
VALID_TO = "valid_to_timestamp"
AUDIT_COLUMNS = (LOAD_TS, VALID_FROM, VALID_TO)


def _ts(v: datetime | Column) -> Column:
    return v if isinstance(v, Column) else ts_lit(v)


def conform(source: DataFrame, spec: EntitySpec) -> DataFrame:
    """Project the spec's columns, cast them to the spec's types, rename to archive names, drop NULL ids.

    Casting first makes the hash independent of how the source delivered a value (``5`` vs ``5.0``).
    Source columns missing from the frame become typed NULLs (schema drift), extra columns are dropped.
    """
    have = set(source.columns)
    cols = []
    for c, t in spec.columns.items():
        v = F.col(c).try_cast(t) if c in have else F.lit(None).cast(t)
        cols.append(v.alias(spec.archive_name(c)))
    return source.select(*cols).filter(F.col(spec.archive_id).isNotNull())


def stamp_open(df: DataFrame, run_ts: datetime | Column) -> DataFrame:
    """Stamp rows as versions opened by the run at ``run_ts``."""
    ts = _ts(run_ts)
    return df.withColumns({LOAD_TS: ts, VALID_FROM: ts, VALID_TO: _ts(FAR_FUTURE)})


def archive_initial(source: DataFrame, spec: EntitySpec, run_ts: datetime | Column) -> DataFrame:
    """Initial archive: every source row becomes an open version stamped with ``run_ts``."""
    return stamp_open(conform(source, spec), run_ts)


def open_versions(archive: DataFrame) -> DataFrame:
    return archive.filter(F.col(VALID_TO) == _ts(FAR_FUTURE))


def add_change_hash(df: DataFrame, cols, name: str = "_change_hash") -> DataFrame:
    return df.withColumn(name, row_hash(df, cols))


def snapshot_diff(source: DataFrame, open_archive: DataFrame, spec: EntitySpec) -> DataFrame:
    """Classify every id of (source snapshot ∪ open archive) as I / U / D / N.

    Returns ``(<archive_id>, op, _src, _arc)`` where ``_src`` is the conformed source row and ``_arc`` the open
    archive row (either may be NULL). One shuffle on the id, without hashes: equal values have equal hashes.
    """
    src = conform(source, spec)
    arc_cols = spec.archive_columns + list(AUDIT_COLUMNS)
    arc = open_archive.select(*arc_cols)
    idc = spec.archive_id
    s = src.select(
        F.col(idc).alias("_id"),
        F.struct(*[F.col(c) for c in src.columns]).alias("_src"),
    )
    a = arc.select(
        F.col(idc).alias("_id"),
        F.struct(*[F.col(c) for c in arc.columns]).alias("_arc"),
    )
    j = s.join(a, "_id", "full_outer")
    op = (
        F.when(F.col("_arc").isNull(), F.lit("I"))
        .when(F.col("_src").isNull(), F.lit("D"))
        .when(_changed(src, arc, spec.compare), F.lit("U"))
        .otherwise(F.lit("N"))
    )
    return j.select(F.col("_id").alias(idc), op.alias("op"), "_src", "_arc")


def _changed(src: DataFrame, arc: DataFrame, cols: Sequence[str]) -> Column:
    """Whether the change hashes of ``_src`` and ``_arc`` differ; computed only where some value differs."""
    same = F.lit(True)
    for c in cols:
        alike = src.schema[c].dataType == arc.schema[c].dataType
        same = same & (F.col(f"_src.{c}").eqNullSafe(F.col(f"_arc.{c}")) if alike else F.lit(False))
    hashes = row_hash(src, cols, "_src") != row_hash(arc, cols, "_arc")
    # within a lambda the hashes, long code that few rows need, stay out of the method compiled for all rows
    return F.when(same, F.lit(False)).otherwise(F.exists(F.array(F.lit(True)), lambda _: hashes))


def to_write(diff: DataFrame) -> DataFrame:
    """The diff without the source rows of unchanged ids, which nothing is derived from: for writing it."""
    return diff.withColumn("_src", F.when(F.col("op") != "N", F.col("_src")))


def digest_diff(source: DataFrame, entry: Mapping, spec: EntitySpec,
                cut: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, list[int]]:
    """The changes between a source snapshot and a bucketed archive, by digests first: ``(diff, buckets)``.

    The source's digests are compared with those kept with the archive; only the differing buckets of the archive are
    read, and joined with the source rows of the same buckets. ``diff`` has the columns of ``snapshot_diff``, with the ids of
    differing buckets only (all other ids are unchanged); ``buckets`` are the differing ones. ``cut`` (e.g.
    ``materialize``) is applied to the conformed source, which both the digests and the join read.
    """
    n = entry["of"]
    src = cut(conform(source, spec)) if cut else conform(source, spec)
    found = B.differing(B.digests(src, spec.archive_id, value_hash(spec.compare), n), B.known_digests(entry))
    own = {a: c for c, a in ((c, spec.archive_name(c)) for c in spec.columns)}
    part = src.filter(B.bucket_of(spec.archive_id, n).isin(found)) if found else src.limit(0)
    back = part.select(*[F.col(a).alias(c) for a, c in own.items()])
    return snapshot_diff(back, B.read_buckets(source.sparkSession, entry, found), spec), found


def unchanged_elsewhere(source: DataFrame, n: int, found: Sequence[int], spec: EntitySpec) -> DataFrame:
    """(id, op = N) of the source rows in the buckets that don't differ; the archive isn't read for them."""
    ids = conform(source, spec).select(spec.archive_id)
    return ids.filter(~B.bucket_of(spec.archive_id, n).isin(list(found)) if found else F.lit(True)).withColumn("op", F.lit("N"))


def closed_versions(diff: DataFrame, run_ts: datetime | Column) -> DataFrame:
    """Open versions ended by this run (updated or deleted ids), ``valid_to = run_ts - 1 µs``."""
    return (
        diff.filter(F.col("op").isin("U", "D"))
        .select("_arc.*")
        .withColumn(VALID_TO, minus_one_micro(_ts(run_ts)))
    )


def new_versions(diff: DataFrame, run_ts: datetime | Column) -> DataFrame:
    """Versions opened by this run (new or updated ids) taken from the source snapshot."""
    return stamp_open(diff.filter(F.col("op").isin("I", "U")).select("_src.*"), run_ts)


def open_after(diff: DataFrame, run_ts: datetime | Column) -> DataFrame:
    """The complete set of open versions after the run: unchanged open rows plus the new versions, in one pass over the
    diff."""
    stamps = {LOAD_TS: _ts(run_ts), VALID_FROM: _ts(run_ts), VALID_TO: _ts(FAR_FUTURE)}
    kept = F.col("op") == "N"
    return diff.filter(F.col("op").isin("N", "I", "U")).select(
        *[F.when(kept, F.col(f"_arc.{c}")).otherwise(stamps[c] if c in stamps else F.col(f"_src.{c}")).alias(c)
          for c in diff.schema["_arc"].dataType.names])


def change_counts(diff: DataFrame) -> DataFrame:
    """``(op, n)`` for all four kinds of change, zero counts included."""
    ops = diff.sparkSession.createDataFrame([("I",), ("U",), ("D",), ("N",)], "op string")
    counts = diff.groupBy("op").agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(ops).join(counts, "op", "left").select("op", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))

