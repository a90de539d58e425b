"""Declarative specs. Data only -- the operators read them, nothing here touches Spark."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column


@dataclass(frozen=True)
class EntitySpec:
    """One source table mirrored into a versioned archive.

    ``columns`` maps every source column to keep onto its Spark SQL type (the source is cast to these types
    before hashing, so the same value always renders the same way). ``rename`` maps source names to archive
    names; the id is renamed to ``archive_id``. ``compare`` lists the *archive* names whose change makes a new
    version.
    """

    name: str
    source_id: str
    archive_id: str
    columns: dict[str, str]
    compare: tuple[str, ...]
    rename: dict[str, str] = field(default_factory=dict)

    def archive_name(self, src_col: str) -> str:
        if src_col == self.source_id:
            return self.archive_id
        return self.rename.get(src_col, src_col)

    @property
    def archive_columns(self) -> list[str]:
        return [self.archive_name(c) for c in self.columns]


@dataclass(frozen=True)
class Scd2Spec:
    """A type-2 dimension maintained from an archive.

    ``mapper`` returns the dimension's attribute columns computed from an archive row (the id and validity
    columns are added by the operator).
    """

    name: str
    archive_id: str
    key: str
    mapper: Callable[[], list[Column]]
    attributes: tuple[str, ...]
    valid_from: str = "dim_valid_from"
    valid_to: str = "dim_valid_to"
    current: str = "is_current"


@dataclass(frozen=True)
class JunkDimSpec:
    """An insert-only dimension whose rows are the distinct values of a natural key.

    ``attributes`` are carried from the first row (by ``order``) of each key. Keys whose parts are all NULL are
    dropped when ``drop_all_null``.
    """

    name: str
    key: str
    natural_key: tuple[str, ...]
    attributes: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    drop_all_null: bool = True


@dataclass(frozen=True)
class LookupSpec:
    """Left lookup of a surrogate key: fact columns ``on[i][0]`` match dimension columns ``on[i][1]``.

    ``null_safe`` makes NULL match NULL (multi-column junk keys). ``bounded`` declares that the dimension's size
    is bounded by its definition (13 flags: at most 2^13 rows): only then is it broadcast explicitly; otherwise the join strategy is left to the optimizer's size estimate and AQE's runtime sizes.
    ``current_only`` restricts a type-2 dimension to its current rows.
    """

    dim: str
    key: str
    on: tuple[tuple[str, str], ...]
    null_safe: bool = False
    bounded: bool = False
    current_only: bool = False
    required: bool = True

