"""Scalar cleaning functions: ``Column -> Column``, all built-in expressions (whole-stage codegen, no UDF).

ANSI mode is on by default in Spark 4, so every coercion that may meet bad input uses a ``try_*`` form and turns
bad values into NULL instead of failing the task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace set removed by ``strip`` (space, tab, LF, CR, form feed, vertical tab) and the
# literal texts a loosely typed source uses for a missing value.
WHITESPACE_CLASS = "[ \\t\\n\\r\\f\\x0B]"
NULL_TOKENS = ("nan", "NaN", "NAN", "None", "NaT")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading/trailing whitespace, tabs and line breaks included (``trim`` only removes spaces). The pattern, which is
    slow, is kept for text that ends in another line separator: its ``$`` matches before one."""
    text = _c(c).cast("string")
    odd = text.endswith("\x85") | text.endswith("\u2028") | text.endswith("\u2029")
    # within a lambda the pattern stays out of the code compiled for all rows, and the step out of whole-stage code, whose
    # one method would be too long for the JVM to compile with a few such columns
    by_pattern = F.transform(F.array(text), lambda t: F.regexp_replace(t, f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$", ""))
    return F.when(odd, by_pattern.getItem(0)).otherwise(F.btrim(text, F.lit(" \t\n\r\f\x0b")))


def crlf_to_lf(c: Column | str) -> Column:
    return F.replace(_c(c), F.lit("\r\n"), F.lit("\n"))


def null_if_token(c: Column | str, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Map the textual null markers (``'nan'``, ``'None'`` ...) to a real NULL."""
    c = _c(c)
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def clean_text(c: Column | str, upper: bool = False, blank_to_null: bool = True) -> Column:
    """Strip, map null tokens and (optionally) blank strings to NULL, optionally upper-case. Tokens are looked for in the value
    itself and blanks with ``nullif``, so that the stripped text is in the generated code once: with a copy for each use, the
    code of a few such columns passes the 8,000 bytes up to which the JVM compiles a method."""
    text = _c(c).cast("string")
    v = F.when(F.find_in_set(text, F.lit(",".join(NULL_TOKENS))) > 0, F.lit(None).cast("string")).otherwise(strip(text))
    if blank_to_null:
        v = F.nullif(v, F.lit(""))
    return F.upper(v) if upper else v


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first + ' ' + last`` with outer whitespace removed; a missing part is skipped, not rendered."""
    return strip(F.concat_ws(" ", _c(first), _c(last)))


def to_decimal(c: Column | str, precision: int, scale: int) -> Column:
    """Numeric coercion; unparsable text or overflow gives NULL."""
    return _c(c).try_cast(f"decimal({precision},{scale})")


def to_timestamp_ntz(c: Column | str) -> Column:
    return _c(c).try_cast("timestamp_ntz")


def to_date(c: Column | str) -> Column:
    return _c(c).try_cast("date")


def to_boolean(c: Column | str) -> Column:
    return _c(c).try_cast("boolean")


def parse_time_of_day(c: Column | str) -> Column:
    """Parse ``H:m:s`` text (``9:05:03`` and ``09:05:03`` both work); out of range or bad text gives NULL."""
    return F.try_to_timestamp(_c(c).cast("string"), F.lit("H:m:s"))


def _plain_time(c: Column) -> Column:
    """Whether text is ``H:mm:ss`` or ``HH:mm:ss`` in range: then it needs no parser, which takes far longer than this test."""
    return c.rlike(r"^(?:[01]?[0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\z")


def hour_of_time(c: Column | str) -> Column:
    """Hour of a time-of-day string; NULL or unparsable gives 0 (the warehouse's lookup rule)."""
    text = _c(c).cast("string")
    return F.when(_plain_time(text), F.substring_index(text, ":", 1).cast("int")).otherwise(
        F.coalesce(F.hour(parse_time_of_day(text)), F.lit(0)))


def time_to_hms(c: Column | str) -> Column:
    """Normalise a time-of-day string to ``HH:mm:ss``; bad input gives NULL."""
    text = _c(c).cast("string")
    return F.when(_plain_time(text), F.lpad(text, 8, "0")).otherwise(F.date_format(parse_time_of_day(text), "HH:mm:ss"))


def seconds_to_hms(c: Column | str) -> Column:
    """A duration in whole seconds (e.g. a database TIME delivered as seconds) as ``HH:MM:SS``."""
    s = _c(c).cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60)


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """Minutes between two timestamps as ``DECIMAL(10,2)``, rounded half away from zero.

    Computed in integers (microseconds -> hundredths of a minute) so the rounding is exact, not a double tie.
    """
    us = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    hundredths = F.signum(us).cast("bigint") * F.call_function("div", F.abs(us) + F.lit(300000), F.lit(600000))
    return (hundredths.cast("decimal(18,0)") / F.lit(100)).cast("decimal(10,2)")


def minus_one_micro(c: Column | str) -> Column:
    """``ts - 1 µs``: the closing stamp of a version replaced at ``ts``."""
    return _c(c) - F.expr("INTERVAL '0.000001' SECOND")


def coalesce_default(c: Column | str, default) -> Column:
    return F.coalesce(_c(c), F.lit(default))


def line_amount(qty: Column | str, unit: Column | str, precision: int = 10, scale: int = 2) -> Column:
    """``qty * unit`` in exact decimal arithmetic, NULL operands count as 0, result rounded to ``scale``."""
    q = F.coalesce(_c(qty).try_cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)"))
    u = F.coalesce(_c(unit).try_cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)"))
    return F.round(q * u, scale).cast(f"decimal({precision},{scale})")
