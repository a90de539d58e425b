"""Row-change hashes and hash-derived surrogate keys.

The change hash decides "updated or not" in the snapshot diff, so the text it hashes must not depend on how a
value happens to be typed or rendered:

* columns are taken in name order;
* fractional numbers are rendered as ``DECIMAL(38,4)`` (4 decimals, half-up), integers as plain digits;
* timestamps as ``yyyy-MM-dd HH:mm:ss`` (second precision), dates as ``yyyy-MM-dd``;
* text has CRLF turned into LF and outer whitespace removed;
* NULL becomes a token that no text value can produce, and fields are joined by a control character, so
  ``('a|b','c')`` and ``('a','b|c')`` or ``NULL`` and ``'None'`` can never collide.

The same rules written in SQL (``md5(concat_ws(chr(31), ...))``) reproduce the hash outside Spark.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.clean import crlf_to_lf, strip

# Field separator (unit separator, U+001F) and the NULL token (record separator U+001E + 'NULL').
FIELD_SEP = "\x1f"
NULL_TOKEN = "\x1eNULL"


def normalise(c: Column, dtype: T.DataType, exact: bool = False) -> Column:
    """Render one value as the canonical text used by change hashes (``exact=False``: 4 decimals, seconds) or
    by surrogate keys (``exact=True``: decimals at their own scale, timestamps to the microsecond)."""
    if isinstance(dtype, T.DecimalType) and exact:
        return c.cast("string")
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return c.try_cast("decimal(38,4)").cast("string")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("string")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS" if exact else "yyyy-MM-dd HH:mm:ss")
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit("true")).when(~c, F.lit("false"))
    return strip(crlf_to_lf(c.cast("string")))


def _typed(df: DataFrame, cols: Iterable[str]) -> list[tuple[str, T.DataType]]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [(c, types[c]) for c in cols if c in types]


def canonical_text(df: DataFrame, cols: Iterable[str], sort: bool = True, exact: bool = False, within: str = "") -> Column:
    """Canonical, collision-safe concatenation of ``cols`` (sorted by name unless ``sort=False``). ``within``: the columns are
    fields of this struct, typed as in ``df``."""
    typed = _typed(df, sorted(cols) if sort else list(cols))
    if not typed:
        return F.lit("")
    parts = [F.coalesce(normalise(F.col(f"{within}.{n}" if within else n), t, exact), F.lit(NULL_TOKEN)) for n, t in typed]
    return F.concat_ws(FIELD_SEP, *parts)


def row_hash(df: DataFrame, cols: Iterable[str], within: str = "") -> Column:
    """md5 hex of the canonical text of ``cols`` -- the change hash of the snapshot diff."""
    return F.md5(canonical_text(df, cols, within=within))


def value_hash(cols: Iterable[str]) -> Column:
    """64 bits of hash over the values of ``cols`` as they are, NULL told from any value: no text is made, so that it is far
    cheaper than ``row_hash``. Rows with equal values have equal hashes; of rows that differ, those that ``row_hash`` takes for
    equal (outer blanks, line breaks) have different ones."""
    return F.xxhash64(*[x for c in sorted(cols) for x in (F.col(c), F.col(c).isNull())])


def hash_key(df: DataFrame, cols: Iterable[str]) -> Column:
    """Surrogate key: the first 60 bits of md5(canonical text of ``cols`` in the given order) as a BIGINT.

    Needs no coordination between tasks or runs and is stable under retries and re-partitioning. Uniqueness is
    checked by the quality operator ``duplicate_keys``; use ``operators.keys.dense_key`` where consecutive keys
    are wanted.
    """
    h = F.md5(canonical_text(df, cols, sort=False, exact=True))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")
