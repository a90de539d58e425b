"""A snapshot that arrives late is spliced into an archive that later runs have already built on.

The late snapshot tells the state from its own time up to the next run, which is known. Per id it is compared with the
version in force at that time, and only versions of ids that differ are replaced:

=========  ==================================================================================================
change     versions in place of the one in force, ``[f, t]``
=========  ==================================================================================================
changed    ``[f, at)`` as it was, ``[at, next)`` from the snapshot, ``[next, t]`` as it was (if it reached there)
deleted    ``[f, at)`` and ``[next, t]`` as they were
new        ``[at, next)`` from the snapshot
=========  ==================================================================================================

Where the version that begins at the next run equals the snapshot's, the two are one, as the next run would have found no
change. The result equals that of runs in true order; applying the snapshot again changes nothing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.clean import minus_one_micro
from starloom.functions.hashing import hash_key, row_hash
from starloom.operators.archive import AUDIT_COLUMNS, LOAD_TS, VALID_FROM, VALID_TO, snapshot_diff
from starloom.operators.dims import scd2_row
from starloom.operators.lookup import anti_join
from starloom.session import FAR_FUTURE, ts_lit
from starloom.spec import EntitySpec, Scd2Spec


def _piece(df: DataFrame, row: str, spec: EntitySpec, load: Column, start: Column, end: Column) -> DataFrame:
    return df.select(*[F.col(f"{row}.{c}").alias(c) for c in spec.archive_columns],
                     load.alias(LOAD_TS), start.alias(VALID_FROM), end.alias(VALID_TO))


def splice_snapshot(archive: DataFrame, source: DataFrame, spec: EntitySpec, at: datetime, next_run: datetime
                    ) -> tuple[DataFrame, DataFrame]:
    """``(removed, added)``: the versions that a snapshot taken at ``at`` replaces in an archive (all versions) of which
    ``next_run`` is the first run after ``at``, and those in their place."""
    idc = spec.archive_id
    at_, next_ = ts_lit(at), ts_lit(next_run)
    archive = archive.select(*spec.archive_columns, *AUDIT_COLUMNS)
    in_force = archive.filter((F.col(VALID_FROM) <= at_) & (F.col(VALID_TO) >= at_))
    diff = snapshot_diff(source, in_force, spec).filter("op <> 'N'")
    # the version that begins at the next run, if it is the snapshot's row again
    following = archive.filter(F.col(VALID_FROM) == next_)
    following = following.select(F.col(idc).alias("_fid"), row_hash(following, spec.compare).alias("_fh"),
                                 F.struct(*[F.col(c) for c in following.columns]).alias("_next"))
    flat = diff.select(idc, "op", "_arc", "_src", *[F.col(f"_src.{c}").alias(c) for c in spec.compare if c != idc])
    src = flat.withColumn("_sh", row_hash(flat, spec.compare))
    same = (F.col(idc) == F.col("_fid")) & F.col("_src").isNotNull() & (F.col("_sh") == F.col("_fh"))
    j = src.join(following, same, "left")
    old = F.col("_arc").isNotNull()
    goes_on = F.col(f"_arc.{VALID_TO}") >= next_
    end = F.when(F.col("_next").isNotNull(), F.col(f"_next.{VALID_TO}")).otherwise(minus_one_micro(next_))
    head = _piece(j.filter(old & (F.col(f"_arc.{VALID_FROM}") < at_)), "_arc", spec, F.col(f"_arc.{LOAD_TS}"),
                  F.col(f"_arc.{VALID_FROM}"), minus_one_micro(at_))
    mid = _piece(j.filter(F.col("_src").isNotNull()), "_src", spec, at_, at_, end)
    tail = _piece(j.filter(old & goes_on), "_arc", spec, next_, next_, F.col(f"_arc.{VALID_TO}"))
    removed = j.filter(old).select("_arc.*").unionByName(j.filter(F.col("_next").isNotNull()).select("_next.*"))
    return removed, head.unionByName(mid).unionByName(tail)


def apply_splice(archive: DataFrame, removed: DataFrame, added: DataFrame, spec: EntitySpec) -> DataFrame:
    """The archive with the replaced versions."""
    kept = anti_join(archive, removed, [spec.archive_id, VALID_FROM], null_safe=False)
    return kept.unionByName(added.select(*archive.columns))


def splice_dimension(dim: DataFrame, removed: DataFrame, added: DataFrame, spec: Scd2Spec
                     ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(dim, gone, new)``: a type-2 dimension after the same splice, its rows that went, and those that came for them."""
    old = removed.select(F.col(spec.archive_id), F.col(VALID_FROM).alias(spec.valid_from))
    gone = dim.join(old, [spec.archive_id, spec.valid_from], "left_semi").select(*dim.columns)
    new = scd2_row(added, spec, F.col(VALID_FROM), F.col(VALID_TO), F.col(VALID_TO) == ts_lit(FAR_FUTURE)).select(*dim.columns)
    kept = anti_join(dim, old, [spec.archive_id, spec.valid_from], null_safe=False)
    return kept.unionByName(new), gone, new


def rekey_facts(facts: DataFrame, gone: DataFrame, new: DataFrame, spec: Scd2Spec, at: str) -> DataFrame:
    """Facts whose dimension row was replaced get the key of the row in force at the time in column ``at``: of the (at most
    three) rows that came for theirs, the last that begins by then, else the first. All other facts stay as they are."""
    came = new.groupBy(spec.archive_id).agg(F.sort_array(F.collect_list(F.struct(
        F.col(spec.valid_from).alias("start"), F.col(spec.key).alias("key")))).alias("_came"))
    moved = gone.select(F.col(spec.key).alias("_old"), spec.archive_id).join(came, spec.archive_id).select("_old", "_came")
    j = facts.join(moved, F.col(spec.key) == F.col("_old"), "left")
    by_then = F.filter("_came", lambda v: v["start"] <= F.col(at))
    key = F.coalesce(F.try_element_at(by_then, F.lit(-1))["key"], F.get("_came", F.lit(0))["key"], F.col(spec.key))
    return j.withColumn(spec.key, key).select(*facts.columns)
