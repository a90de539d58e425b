"""Fact building: surrogate-key lookups, measures, required keys and a reject path.

``build_facts`` adds every lookup's key with a left join, then splits the rows into facts (all required keys
found) and rejects (a ``reject_reason`` naming the first missing key). Rejects are data, not a printed count:
the next run feeds them back (``replay_rejects``), until the missing dimension row exists.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.hashing import hash_key
from starloom.operators.lookup import anti_join, lookup_key, semi_join
from starloom.spec import LookupSpec

REJECT_REASON = "reject_reason"


def apply_lookups(df: DataFrame, dims: Mapping[str, DataFrame], lookups: Sequence[LookupSpec],
                  current_col: str = "is_current") -> DataFrame:
    """Add each lookup's surrogate key. Type-2 dimensions are restricted to current rows when asked."""
    out = df
    for lk in lookups:
        dim = dims[lk.dim]
        if lk.current_only:
            dim = dim.filter(F.col(current_col))
        out = lookup_key(out, dim, lk.on, lk.key, null_safe=lk.null_safe, bounded=lk.bounded)
    return out


def reject_reason(required: Sequence[str]) -> Column:
    """Name of the first required column that is NULL (NULL when none is)."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"missing_{c}")) for c in required], F.lit(None).cast("string"))


def split_facts(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(facts, rejects)`` from one looked-up frame; rejects carry ``reject_reason``."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return df.filter(ok), df.filter(~ok).withColumn(REJECT_REASON, reject_reason(required))


def build_facts(
    df: DataFrame,
    dims: Mapping[str, DataFrame],
    lookups: Sequence[LookupSpec],
    measures: Sequence[Column] = (),
    required: Sequence[str] | None = None,
    carry: Sequence[str] = (),
    key: tuple[str, str] | None = None,
    cut: Callable[[DataFrame], DataFrame] | None = None,
    orphan: tuple[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Look up keys, compute ``measures`` and split into ``(facts, rejects)``.

    ``required`` defaults to the keys of the lookups marked ``required``; ``carry`` lists source columns kept
    in the output (ids, degenerate dimensions); ``key`` = (name, id column) adds the fact's own surrogate key. ``cut``
    (e.g. ``materialize``) is applied to the looked-up rows before the split, so that a caller that writes both
    halves runs the lookups once. ``orphan`` = (column, reason): rows where that is true are rejects for this reason.
    """
    looked = apply_lookups(df, dims, lookups)
    keys = [lk.key for lk in lookups]
    req = list(required) if required is not None else [lk.key for lk in lookups if lk.required]
    own = [hash_key(looked, [key[1]]).alias(key[0])] if key else []
    out = looked.select(*own, *carry, *keys, *measures, *([orphan[0]] if orphan else []))
    out = cut(out) if cut else out
    if not orphan:
        return split_facts(out, req)
    facts, rejects = split_facts(out.withColumn("_parent", F.when(~F.col(orphan[0]), True)).drop(orphan[0]), ["_parent", *req])
    reason = F.when(F.col("_parent").isNull(), F.lit(orphan[1])).otherwise(F.col(REJECT_REASON))
    return facts.drop("_parent"), rejects.withColumn(REJECT_REASON, reason).drop("_parent")


def with_parent(child: DataFrame, parent: DataFrame, on: tuple[str, str], cols: Sequence[str]) -> DataFrame:
    """All child rows with the parent's columns; ``__parent_id`` is NULL where there is no parent."""
    lc, rc = on
    p = parent.select(F.col(rc).alias("__parent_id"), *[F.col(c) for c in cols])
    return child.join(p, child[lc] == p["__parent_id"], "left")


def attach_parent(child: DataFrame, parent: DataFrame, on: tuple[str, str], cols: Sequence[str],
                  reason: str = "missing_parent") -> tuple[DataFrame, DataFrame]:
    """Inner-attach parent columns to child rows (details -> appointment date/vehicle).

    Returns ``(matched, unmatched)``; unmatched child rows carry ``reject_reason``. One shuffled left join on the
    parent id (AQE splits a parent id that holds a large share of the children).
    """
    j = with_parent(child, parent, on, cols)
    matched = j.filter(F.col("__parent_id").isNotNull()).drop("__parent_id")
    unmatched = j.filter(F.col("__parent_id").isNull()).select(*child.columns).withColumn(REJECT_REASON, F.lit(reason))
    return matched, unmatched


def new_facts_only(candidates: DataFrame, existing_facts: DataFrame | Callable[[DataFrame], DataFrame],
                   id_cols: Sequence[str]) -> DataFrame:
    """Insert-only facts: drop candidates whose id is already in the fact table. The facts are reduced to the
    candidates' ids first (a day's candidates are few; adaptive execution broadcasts them), so the history isn't
    shuffled. In place of the facts, a function may give those of the candidates' ids that are known (see
    ``sources.parts``), so that only some parts of the history are read."""
    if callable(existing_facts):
        return anti_join(candidates, existing_facts(candidates), list(id_cols), null_safe=False)
    seen = semi_join(existing_facts.select(*id_cols), candidates.select(*id_cols), list(id_cols))
    return anti_join(candidates, seen, list(id_cols), null_safe=False)


def upsert_facts(existing_facts: DataFrame, accepted: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """All facts after a run that replaces: the accepted rows, and every earlier fact they don't replace (a fact whose
    new version was rejected stays)."""
    kept = anti_join(existing_facts, accepted, list(id_cols), null_safe=False)
    return kept.unionByName(accepted)


def replay_rejects(window_rows: DataFrame, archive: DataFrame, previous_rejects: DataFrame | None, id_col: str
                   ) -> DataFrame:
    """The run window's rows and, for each earlier reject outside it, the archive's row of that id, so that a
    dimension row that came late heals it. ``archive``: the rows that may become facts (open versions)."""
    if previous_rejects is None:
        return window_rows
    again = semi_join(archive, previous_rejects, [id_col])
    again = anti_join(again, window_rows, [id_col], null_safe=False)
    return window_rows.unionByName(again.select(*window_rows.columns))
