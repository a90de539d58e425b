"""Dimension lookups and null-safe set operations.

Null semantics follow the warehouse rule for multi-column natural keys: NULL matches NULL (``<=>``). Spark
plans ``<=>`` keys as ordinary hash keys (``coalesce(k, default), isnull(k)``), so these joins stay hash / sort-
merge joins, never nested loops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cond(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], null_safe: bool) -> Column:
    cond = None
    for lc, rc in pairs:
        c = left[lc].eqNullSafe(right[rc]) if null_safe else left[lc] == right[rc]
        cond = c if cond is None else cond & c
    return cond


def lookup_key(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    key: str,
    null_safe: bool = False,
    bounded: bool = False,
    alias: str | None = None,
) -> DataFrame:
    """Left-join ``dim`` and add its surrogate ``key`` (as ``alias``) to every row of ``df``.

    The dimension side is reduced to the key and the match columns before the join. It is broadcast explicitly
    only when ``bounded`` (its size does not grow with the data); otherwise Catalyst's size estimate and AQE's
    runtime statistics choose between broadcast and a shuffled join, and AQE splits skewed partitions.
    The dimension must be unique on the match columns (junk / current type-2 rows are).
    """
    out = alias or key
    tmp = [(lc, f"__lk_{i}") for i, (lc, _) in enumerate(on)]
    d = dim.select(F.col(key).alias(f"__lk_key"), *[F.col(rc).alias(t) for (_, rc), (_, t) in zip(on, tmp)])
    if bounded:
        d = F.broadcast(d)
    joined = df.join(d, _cond(df, d, tmp, null_safe), "left")
    return joined.select(*[df[c] for c in df.columns], F.col("__lk_key").alias(out))


def anti_join(df: DataFrame, other: DataFrame, on: Sequence[tuple[str, str]] | Sequence[str],
              null_safe: bool = True) -> DataFrame:
    """Rows of ``df`` with no match in ``other`` (NOT IN / set difference), NULL equal to NULL by default."""
    pairs = [(c, c) if isinstance(c, str) else c for c in on]
    o = other.select(*[F.col(rc).alias(f"__aj_{i}") for i, (_, rc) in enumerate(pairs)])
    cond = _cond(df, o, [(lc, f"__aj_{i}") for i, (lc, _) in enumerate(pairs)], null_safe)
    return df.join(o, cond, "left_anti")


def semi_join(df: DataFrame, other: DataFrame, on: Sequence[tuple[str, str]] | Sequence[str],
              null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` that have a match in ``other`` (IN / EXISTS)."""
    pairs = [(c, c) if isinstance(c, str) else c for c in on]
    o = other.select(*[F.col(rc).alias(f"__sj_{i}") for i, (_, rc) in enumerate(pairs)])
    cond = _cond(df, o, [(lc, f"__sj_{i}") for i, (lc, _) in enumerate(pairs)], null_safe)
    return df.join(o, cond, "left_semi")
