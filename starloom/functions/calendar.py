"""Calendar attributes and smart keys for the (date, hour) grain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_hour_key(d: Column | str, hour: Column | str) -> Column:
    """Smart key ``yyyyMMddHH`` as BIGINT: lookups can compute it instead of joining the calendar."""
    d = F.col(d) if isinstance(d, str) else d
    h = F.col(hour) if isinstance(hour, str) else hour
    return (
        F.year(d).cast("bigint") * 1000000 + F.month(d) * 10000 + F.dayofmonth(d) * 100 + h
    ).cast("bigint")


def calendar_attributes(date_col: str = "full_date", hour_col: str = "hour") -> list[Column]:
    """Attribute columns of the calendar dimension for a (date, hour) row."""
    d = F.col(date_col)
    return [
        date_hour_key(d, F.col(hour_col)).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.quarter(d).alias("quarter"),
        F.col(hour_col).cast("int").alias("hour"),
    ]


def flags_mask(cols: list[str]) -> Column:
    """Smart key of a set of boolean flags: bit i is set when flag i is true (NULL counts as false)."""
    expr = F.lit(0).cast("bigint")
    for i, c in enumerate(cols):
        expr = expr + F.when(F.coalesce(F.col(c), F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0))
    return expr.cast("bigint")
