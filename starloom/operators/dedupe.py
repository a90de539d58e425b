"""Keep-first / keep-last de-duplication with an explicit total order.

``dropDuplicates(subset)`` keeps an arbitrary row; these operators pick the row that is minimal (first) or
maximal (last) under ``order`` -- ties broken by all remaining columns, so the result does not depend on
partitioning or retries. They run as ``min``/``max`` aggregates over
one struct: partial aggregation collapses each key on
the map side before the shuffle, so a key that holds a third of all rows costs one row per map task, not a
third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], last: bool) -> DataFrame:
    """The row is carried once, in the order it is compared in: ``order`` first, then all other columns."""
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    cols = [F.col(o).alias(f"_o{i}") if isinstance(o, str) else o.alias(f"_o{i}") for i, o in enumerate(order)]
    place = {o: f"_o{i}" for i, o in enumerate(order) if isinstance(o, str)}
    rest = [c for c in payload if c not in place]
    place |= {c: f"_r{j}" for j, c in enumerate(rest)}
    row = F.struct(*cols, *[F.col(c).alias(place[c]) for c in rest])
    agg = F.max(row) if last else F.min(row)
    return df.groupBy(*keys).agg(agg.alias("_row")).select(*keys, *[F.col(f"_row.{place[c]}").alias(c) for c in payload])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """One row per ``keys``: the smallest under ``order`` (then all other columns)."""
    return _pick(df, keys, order, last=False)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """One row per ``keys``: the largest under ``order`` (then all other columns)."""
    return _pick(df, keys, order, last=True)


def two_stage(
    df: DataFrame,
    first_keys: Sequence[str],
    second_keys: Sequence[str],
    order: Sequence[str | Column] = (),
    last: bool = False,
) -> DataFrame:
    """De-duplicate by ``first_keys``, then the survivors by ``second_keys`` (e.g. id, then VIN / part number).

    The order matters: a row dropped in stage one cannot win stage two.
    """
    pick = keep_last if last else keep_first
    return pick(pick(df, first_keys, order), second_keys, order)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest row per key by ``ts`` (``ORDER BY ts DESC LIMIT 1`` per key)."""
    return keep_last(df, keys, [ts, *tiebreak])
