"""Dimension builders: calendar, insert-only ("junk") dimensions, initial type-2 dimensions.

All builders are append-only: given the rows already in the dimension (``existing``) they return only the new
rows, found with a null-safe anti join -- never a collected list of keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.calendar import calendar_attributes, flags_mask
from starloom.functions.clean import clean_text
from starloom.functions.hashing import hash_key
from starloom.operators.archive import VALID_FROM, VALID_TO, open_versions
from starloom.operators.dedupe import keep_first, keep_last
from starloom.operators.lookup import anti_join
from starloom.session import DEFAULT_VALID_FROM, FAR_FUTURE, ts_lit
from starloom.spec import JunkDimSpec, Scd2Spec

CALENDAR_GRAIN = ("full_date", "hour")


def date_hours(df: DataFrame, ts: str | Column | None = None, date: str | Column | None = None,
               hour: str | Column | None = None) -> DataFrame:
    """Project one source of calendar points to ``(full_date, hour)``: from a timestamp, or a date + hour."""
    if ts is not None:
        t = F.col(ts) if isinstance(ts, str) else ts
        out = df.select(F.to_date(t).alias("full_date"), F.hour(t).alias("hour"))
    else:
        d = F.col(date) if isinstance(date, str) else date
        h = F.lit(0) if hour is None else (F.col(hour) if isinstance(hour, str) else hour)
        out = df.select(d.cast("date").alias("full_date"), h.cast("int").alias("hour"))
    return out.filter(F.col("full_date").isNotNull() & F.col("hour").isNotNull())


def calendar_dim(points: Sequence[DataFrame], existing: DataFrame | None = None) -> DataFrame:
    """Calendar dimension at (date, hour) grain from any number of ``date_hours`` projections.

    Each projection is de-duplicated before the union (partial aggregation keeps the shuffle to distinct
    values); the dimension's size is bounded by 24 x days in the covered range, whatever the data volume.
    """
    u = None
    for p in points:
        p = p.select(*CALENDAR_GRAIN).distinct()
        u = p if u is None else u.unionByName(p)
    u = u.distinct()
    if existing is not None:
        u = anti_join(u, existing, CALENDAR_GRAIN)
    return u.select(*calendar_attributes())


def junk_dim(df: DataFrame, spec: JunkDimSpec, existing: DataFrame | None = None) -> DataFrame:
    """Distinct natural keys with first-row attributes, minus the keys already present (NULL = NULL).

    The first row per key is chosen by ``spec.order`` then all attribute values (deterministic). The surrogate
    key is the 60-bit hash of the natural key.
    """
    nk = list(spec.natural_key)
    d = df.select(*nk, *spec.attributes, *[c for c in spec.order if c not in nk and c not in spec.attributes])
    if spec.drop_all_null:
        d = d.dropna(how="all", subset=nk)
    if spec.attributes:
        d = keep_first(d, nk, list(spec.order))
    else:
        d = d.select(*nk).distinct()
    d = d.select(*nk, *spec.attributes)
    if existing is not None:
        d = anti_join(d, existing, nk, null_safe=True)
    return d.select(hash_key(d, nk).alias(spec.key), *nk, *spec.attributes)


def flags_dim(df: DataFrame, flags: Sequence[str], key: str = "road_features_key",
              existing: DataFrame | None = None) -> DataFrame:
    """Distinct combinations of boolean flags (NULL -> False). The key is the bit mask of the flags, so a fact
    can compute it without a join; the dimension holds at most 2^len(flags) rows."""
    d = df.select(*[F.coalesce(F.col(c).cast("boolean"), F.lit(False)).alias(c) for c in flags]).distinct()
    if existing is not None:
        d = anti_join(d, existing, list(flags), null_safe=False)
    return d.select(flags_mask(list(flags)).alias(key), *flags)


def name_dim(df: DataFrame, col: str, name: str, key: str, existing: DataFrame | None = None) -> DataFrame:
    """Distinct stripped, non-blank names (service types): ``(key, name)``."""
    d = df.select(clean_text(col).alias(name)).filter(F.col(name).isNotNull()).distinct()
    if existing is not None:
        d = anti_join(d, existing, [name], null_safe=False)
    return d.select(hash_key(d, [name]).alias(key), name)


def scd2_row(df: DataFrame, spec: Scd2Spec, valid_from: Column, valid_to: Column, current: Column) -> DataFrame:
    """Map archive rows to dimension rows: key, id, mapped attributes, validity."""
    mapped = df.select(
        F.col(spec.archive_id),
        *spec.mapper(),
        F.coalesce(valid_from, ts_lit(DEFAULT_VALID_FROM)).alias(spec.valid_from),
        valid_to.alias(spec.valid_to),
        current.alias(spec.current),
    )
    key = hash_key(mapped, [spec.archive_id, spec.valid_from])
    return mapped.select(key.alias(spec.key), *mapped.columns)


def scd2_initial(
    archive: DataFrame,
    spec: Scd2Spec,
    keep: str = "first",
    second_key: Sequence[str] = (),
    require: Sequence[str] = (),
) -> DataFrame:
    """Initial type-2 dimension from the open archive versions: one current row per id.

    ``keep`` chooses the first or last version per id (by ``valid_from``); ``second_key`` adds a second
    de-duplication on another natural key (VIN, part number) among the survivors. Every row gets its validity:
    ``dim_valid_from`` = the version's ``valid_from`` (1900-01-01 if missing), ``dim_valid_to`` = open,
    ``is_current`` = true.
    """
    a = open_versions(archive).filter(F.col(spec.archive_id).isNotNull())
    for c in require:
        a = a.filter(F.col(c).isNotNull())
    pick = keep_last if keep == "last" else keep_first
    a = pick(a, [spec.archive_id], [VALID_FROM])
    if second_key:
        a = pick(a, list(second_key), [VALID_FROM, spec.archive_id])
    return scd2_row(a, spec, F.col(VALID_FROM), ts_lit(FAR_FUTURE), F.lit(True))


__all__ = [
    "date_hours", "calendar_dim", "junk_dim", "flags_dim", "name_dim", "scd2_row", "scd2_initial",
    "VALID_TO",
]
