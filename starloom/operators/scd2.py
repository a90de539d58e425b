"""Type-2 slowly changing dimensions maintained from the versioned archive -- set-based, no per-id queries.

``scd2_apply`` processes the archive versions of one run window ``(last_run, run_ts]``:

1. changed ids: archive versions opened in the window (and, with ``on_delete="close"``, versions closed in it);
2. per changed id, in one aggregate over just those ids' versions: the latest *open* version and the
   ``valid_to`` of the latest version overall;
3. join with the current dimension rows and decide per id:

   =====================  ==============================  ============================================
   current row?           open version?                   action
   =====================  ==============================  ============================================
   yes                    yes                             close at ``open.valid_from - 1 µs``, insert
   yes                    no (deleted)                    close at the last known ``valid_to``
   no                     yes                             insert
   no                     no                              nothing
   =====================  ==============================  ============================================

   A current row whose ``dim_valid_from`` already equals the open version's ``valid_from`` was produced by this
   very window: it is left alone, so re-running a window is a no-op. With ``track`` set, a new version whose
   tracked attributes equal the current row's is suppressed (changes only in untracked columns).

The result is the full new dimension: history rows untouched, current rows closed where needed, new rows
appended. Only the changed ids are aggregated; the current rows meet the (small) change set in one join that
AQE turns into a broadcast at runtime when the change set is small.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.clean import minus_one_micro
from starloom.operators.archive import VALID_FROM, VALID_TO
from starloom.operators.dims import scd2_row
from starloom.operators.lookup import semi_join
from starloom.session import FAR_FUTURE, ts_lit
from starloom.spec import Scd2Spec


def _ts(v: datetime | Column) -> Column:
    return v if isinstance(v, Column) else ts_lit(v)


def _far() -> Column:
    return ts_lit(FAR_FUTURE)


def changed_ids(archive: DataFrame, id_col: str, last_run, run_ts, include_closed: bool = True) -> DataFrame:
    """Distinct ids with a version opened in ``(last_run, run_ts]`` (or closed in it, if ``include_closed``)."""
    last, run = _ts(last_run), _ts(run_ts)
    cond = (F.col(VALID_FROM) > last) & (F.col(VALID_FROM) <= run)
    if include_closed:
        cond = cond | ((F.col(VALID_TO) >= last) & (F.col(VALID_TO) < run))
    return archive.filter(cond).select(id_col).distinct()


def scd2_plan(
    dim: DataFrame,
    archive: DataFrame,
    spec: Scd2Spec,
    last_run: datetime | Column,
    run_ts: datetime | Column,
    on_delete: str = "close",
    track: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Return ``(to_close, to_insert)``: ``(key, close_ts)`` of current rows to end, and new dimension rows."""
    idc = spec.archive_id
    ids = changed_ids(archive, idc, last_run, run_ts, include_closed=(on_delete == "close"))
    versions = semi_join(archive, ids, [idc])
    is_open = F.col(VALID_TO) == _far()
    row = F.struct(*[F.col(c) for c in archive.columns])
    per_id = versions.groupBy(idc).agg(
        F.max_by(F.when(is_open, row), F.when(is_open, F.col(VALID_FROM))).alias("_open"),
        F.max_by(F.col(VALID_TO), F.col(VALID_FROM)).alias("_last_to"),
    )
    cur_cols = [spec.key, idc, spec.valid_from] + list(track or [])
    cur = dim.filter(F.col(spec.current)).select(
        *[F.col(c).alias(f"_c_{c}") if c != idc else F.col(c) for c in cur_cols]
    )
    j = per_id.join(cur, idc, "left")
    has_cur = F.col(f"_c_{spec.key}").isNotNull()
    has_open = F.col("_open").isNotNull()
    already = has_cur & has_open & (F.col(f"_c_{spec.valid_from}") == F.col(f"_open.{VALID_FROM}"))

    if not track:
        new_rows = scd2_row(
            j.filter(has_open & ~already).select(*[F.col(f"_open.{c}").alias(c) for c in archive.columns]),
            spec, F.col(VALID_FROM), _far(), F.lit(True),
        )
        close_upd = j.filter(has_cur & has_open & ~already).select(
            F.col(f"_c_{spec.key}").alias(spec.key), minus_one_micro(F.col(f"_open.{VALID_FROM}")).alias("_close_ts")
        )
    else:
        base = j.filter(has_open & ~already)
        mapped = scd2_row(
            base.select(*[F.col(f"_open.{c}").alias(c) for c in archive.columns]),
            spec, F.col(VALID_FROM), _far(), F.lit(True),
        )
        cur_attrs = base.select(idc, f"_c_{spec.key}", *[f"_c_{c}" for c in track])
        m = mapped.join(cur_attrs, idc, "left")
        same = F.lit(True)
        for c in track:
            same = same & F.col(c).eqNullSafe(F.col(f"_c_{c}"))
        suppressed = F.col(f"_c_{spec.key}").isNotNull() & same
        new_rows = m.filter(~suppressed).select(*mapped.columns)
        keep_ids = new_rows.select(idc)
        close_upd = (
            semi_join(j.filter(has_cur & has_open & ~already), keep_ids, [idc])
            .select(F.col(f"_c_{spec.key}").alias(spec.key), minus_one_micro(F.col(f"_open.{VALID_FROM}")).alias("_close_ts"))
        )
    close_del = j.filter(has_cur & ~has_open).select(
        F.col(f"_c_{spec.key}").alias(spec.key), F.col("_last_to").alias("_close_ts")
    )
    new_rows = new_rows.select(spec.key, idc, *spec.attributes, spec.valid_from, spec.valid_to, spec.current)
    return close_upd.unionByName(close_del), new_rows


def scd2_apply(
    dim: DataFrame,
    archive: DataFrame,
    spec: Scd2Spec,
    last_run: datetime | Column,
    run_ts: datetime | Column,
    on_delete: str = "close",
    track: Sequence[str] | None = None,
) -> DataFrame:
    """The full dimension after applying the window ``(last_run, run_ts]`` (see module doc)."""
    to_close, to_insert = scd2_plan(dim, archive, spec, last_run, run_ts, on_delete, track)
    cols = dim.columns
    history = dim.filter(~F.col(spec.current))
    current = dim.filter(F.col(spec.current)).join(to_close, spec.key, "left")
    closed = current.select(
        *[
            F.when(F.col("_close_ts").isNotNull(), F.col("_close_ts")).otherwise(F.col(c)).alias(c)
            if c == spec.valid_to
            else (F.col("_close_ts").isNull().alias(c) if c == spec.current else F.col(c))
            for c in cols
        ]
    )
    return history.unionByName(closed).unionByName(to_insert.select(*cols))


def scd2_rebuild(archive: DataFrame, spec: Scd2Spec, on_delete: str = "close") -> DataFrame:
    """The whole dimension history rebuilt from the archive in one pass (one dimension row per version).

    ``close``: intervals are the archive's own; ``ignore``: a version ends just before the id's next version
    (deletions do not end it), computed with ``lead`` over the id's versions.
    """
    if on_delete == "close":
        vt = F.col(VALID_TO)
        cur = F.col(VALID_TO) == _far()
        return scd2_row(archive, spec, F.col(VALID_FROM), vt, cur)
    w = Window.partitionBy(spec.archive_id).orderBy(VALID_FROM)
    nxt = F.lead(F.col(VALID_FROM)).over(w)
    a = archive.withColumn("_next", nxt)
    vt = F.when(F.col("_next").isNull(), _far()).otherwise(minus_one_micro(F.col("_next")))
    return scd2_row(a, spec, F.col(VALID_FROM), vt, F.col("_next").isNull())
