"""Analysis over the star schema: trends, usage, drill-across, and point-in-time (as-of) dimension lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import FAR_FUTURE, ts_lit


def _money_sum(c: str, alias: str):
    return F.sum(F.col(c).cast("decimal(18,2)")).alias(alias)


def service_trends(fact: DataFrame, dim_date: DataFrame, dim_service_type: DataFrame,
                   cost: str = "total_service_cost") -> DataFrame:
    """Appointments and cost per (year, month, service type). How the dimensions are joined is left to their written sizes;
    the fact is aggregated map-side before the shuffle."""
    j = (
        fact.join(dim_date.select("date_key", "year", "month"), "date_key")
        .join(dim_service_type.select("service_type_key", "service_type_name"), "service_type_key")
    )
    return j.groupBy("year", "month", "service_type_name").agg(
        F.count(F.lit(1)).alias("appointments"),
        _money_sum(cost, "total_cost"),
    )


def parts_usage_by_category(fact: DataFrame, dim_part: DataFrame) -> DataFrame:
    """Quantity and cost of parts used per part category (dimension size is left to AQE)."""
    j = fact.join(dim_part.select("part_key", "category"), "part_key")
    return j.groupBy("category").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("quantity_used").cast("bigint")).alias("quantity"),
        _money_sum("total_cost_for_part_line", "cost"),
    )


def employee_performance(fact: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Appointments and billed cost per employee; appointments without a technician form their own group."""
    j = fact.join(dim_employee.select("employee_key", "employee_name"), "employee_key", "left")
    return j.groupBy("employee_name").agg(
        F.count(F.lit(1)).alias("appointments"),
        _money_sum("total_service_cost", "billed"),
    )


def drill_across(left: DataFrame, right: DataFrame, keys: Sequence[str], fill: Sequence[str] = ()) -> DataFrame:
    """Combine two facts aggregated to the same grain (``keys``) with a full outer join; measures in ``fill``
    missing on one side become 0."""
    j = left.join(right, list(keys), "full_outer")
    return j.select(*keys, *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in fill else F.col(c)
                             for c in j.columns if c not in keys])


def _bounds(facts: DataFrame, fact_ts: str, slices: int) -> list[int]:
    """Times (microseconds) that cut the facts into about equal slices; their number is bounded by ``slices``."""
    if slices < 2:
        return []
    t = facts.select(F.unix_micros(F.col(fact_ts).cast("timestamp_ltz")).cast("double").alias("t")).filter("t is not null")
    return sorted({int(x) for x in t.approxQuantile("t", [i / slices for i in range(1, slices)], 0.002)})


def as_of_sliced(facts: DataFrame, fact_id: str, fact_ts: str, dim: DataFrame, dim_id: str, key: str,
                 valid_from: str = "dim_valid_from", valid_to: str = "dim_valid_to", alias: str | None = None,
                 slices: int = 64) -> DataFrame:
    """``as_of_lookup`` for facts of which one id may have a great part: a prefix scan on two levels.

    Time is cut into slices that hold about equally many facts. (1) Each (id, slice) is reduced to its last version. (2) A
    scan over an id's slices, ``slices`` rows at most, gives every slice the last version before it, its carry. (3) Facts, versions
    and carries are scanned by (id, slice), so an id's facts are spread over as many tasks as it has slices. Facts are
    shuffled once, as in the plain form. Facts without an id or a time match nothing.
    """
    out, cols, far = alias or key, facts.columns, ts_lit(FAR_FUTURE)
    bounds = _bounds(facts, fact_ts, slices)

    def slice_of(t: str) -> Column:
        micros, at = F.unix_micros(F.col(t).cast("timestamp_ltz")), F.lit(0)
        for i, b in enumerate(bounds):  # the last bound reached counts
            at = F.when(micros >= b, F.lit(i + 1)).otherwise(at)
        return at

    usable = F.col(fact_id).isNotNull() & F.col(fact_ts).isNotNull()
    without = facts.filter(~usable).select(*cols, F.lit(None).cast("bigint").alias(out))
    f = facts.filter(usable).select(
        F.col(fact_id).alias("_id"), F.col(fact_ts).alias("_t"), F.lit(2).alias("_kind"),
        F.struct(*[F.col(c) for c in cols]).alias("_f"), F.lit(None).cast("struct<k:bigint,vt:timestamp_ntz>").alias("_v"))
    f = f.withColumn("_s", slice_of("_t"))
    version = F.struct(F.col(key).cast("bigint").alias("k"), F.coalesce(F.col(valid_to), far).cast("timestamp_ntz").alias("vt"))
    none = F.lit(None).cast(f.schema["_f"].dataType).alias("_f")
    d = dim.filter(F.col(dim_id).isNotNull()).select(
        F.col(dim_id).cast(f.schema["_id"].dataType).alias("_id"), F.col(valid_from).cast(f.schema["_t"].dataType).alias("_t"),
        F.lit(1).alias("_kind"), none, version.alias("_v"))
    d = d.withColumn("_s", slice_of("_t"))

    last = d.groupBy("_id", "_s").agg(F.max_by("_v", "_t").alias("_v"))
    places = last.unionByName(f.select("_id", "_s").distinct().select("_id", "_s", F.lit(None).cast(last.schema["_v"].dataType).alias("_v")))
    before = Window.partitionBy("_id").orderBy("_s").rangeBetween(Window.unboundedPreceding, -1)
    carry = (places.select("_id", "_s", F.last("_v", ignorenulls=True).over(before).alias("_v")).filter("_v is not null")
             .distinct().select("_id", F.lit(None).cast(f.schema["_t"].dataType).alias("_t"), F.lit(0).alias("_kind"), none, "_v", "_s"))

    # a carry has no time and sorts first; at one instant a version comes before the facts
    scan = Window.partitionBy("_id", "_s").orderBy(F.col("_t").asc_nulls_first(), "_kind").rowsBetween(Window.unboundedPreceding, 0)
    u = f.unionByName(d).unionByName(carry).select("_kind", "_f", "_t", F.last("_v", ignorenulls=True).over(scan).alias("_v"))
    hit = F.when(F.col("_t") <= F.col("_v.vt"), F.col("_v.k"))
    return u.filter("_kind = 2").select(*[F.col(f"_f.{c}").alias(c) for c in cols], hit.alias(out)).unionByName(without)


def as_of_lookup(facts: DataFrame, fact_id: str, fact_ts: str, dim: DataFrame, dim_id: str, key: str,
                 valid_from: str = "dim_valid_from", valid_to: str = "dim_valid_to", alias: str | None = None
                 ) -> DataFrame:
    """Attach the key of the dimension version valid at each fact's time (``valid_from <= t <= valid_to``).

    No range join and no pairs: facts and versions are unioned, sorted per id by time (a version sorts before a
    fact at the same instant), and each fact takes the last version seen (``last(..., ignorenulls)``) if that
    version has not ended before the fact. Cost is one shuffle + sort of facts ∪ versions. Facts without an id, which
    may be many and match nothing, are set aside first.
    """
    out = alias or key
    cols = facts.columns
    far = ts_lit(FAR_FUTURE)
    without = facts.filter(F.col(fact_id).isNull()).select(*cols, F.lit(None).cast("bigint").alias(out))
    f = facts.filter(F.col(fact_id).isNotNull()).select(
        F.col(fact_id).alias("_id"), F.col(fact_ts).alias("_t"), F.lit(1).alias("_kind"),
        F.struct(*[F.col(c) for c in cols]).alias("_f"),
        F.lit(None).cast("bigint").alias("_k"), F.lit(None).cast("timestamp_ntz").alias("_vt"),
    )
    d = dim.select(
        F.col(dim_id).alias("_id"), F.col(valid_from).alias("_t"), F.lit(0).alias("_kind"),
        F.lit(None).cast(f.schema["_f"].dataType).alias("_f"),
        F.col(key).cast("bigint").alias("_k"), F.coalesce(F.col(valid_to), far).alias("_vt"),
    )
    w = Window.partitionBy("_id").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    u = f.unionByName(d).select(
        "_kind", "_f", "_t",
        F.last("_k", ignorenulls=True).over(w).alias("_lk"),
        F.last("_vt", ignorenulls=True).over(w).alias("_lvt"),
    )
    hit = F.when(F.col("_t") <= F.col("_lvt"), F.col("_lk"))
    found = u.filter(F.col("_kind") == 1).select(*[F.col(f"_f.{c}").alias(c) for c in cols], hit.alias(out))
    return found.unionByName(without)
