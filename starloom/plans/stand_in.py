"""Derive the warehouse's source snapshots from the TPC-H-style driver tables.

Role mapping (every source is a projection of a whole driver table, so its volume grows with the scale factor):

=====================  ===========================================================================================
Customers              ``customer`` ⋈ ``nation`` ⋈ ``region``: first name = c_name, last name = c_mktsegment,
                       address = 'ADDR <key>', city = n_name, state = r_name
Vehicles               one vehicle per customer: id = c_custkey, VIN = 'VIN<key>', make = segment
Employees              ``supplier``: first name = s_name, role 'Technician'
PartsInventory         ``part``: name = p_brand, number = 'PN<key>' (of key mod 20 = 19: the number of the part before,
                       so the de-duplication by number drops one part in twenty and rejects its details),
                       category = p_type, stock = p_size, cost = p_retailprice
ServiceAppointments    ``orders``: vehicle/customer = o_custkey, date/time = o_orderdate, service type =
                       o_orderpriority, status = o_orderstatus, technician = o_orderkey mod 10 (0 -> none),
                       service cost = o_totalprice
ServiceDetails         ``lineitem`` (rows equal in all columns once): id = hash of all columns, part = l_partkey,
                       quantity = l_quantity, unit cost = l_extendedprice / l_quantity
Accident extract       ``events``: start = ts, end = ts + value minutes, weather condition = event_type except
                       'error', temperature = round(value) except 0, city 'CITY_<user>', state = event_type
=====================  ===========================================================================================

Change days (run timestamps ``T0 < T1 < T2``): day 1 deletes customers with key mod 50 = 7, renames the segment of
key mod 20 = 3 to 'CHANGED' and adds copies (key + 2^40) of key mod 100 = 1; it also cancels orders with key
mod 25 = 0 and books a repeat order (key + 2^40, one day and nine hours later, service type
'<priority>-REPEAT') with
its line items for key mod 40 = 1. Day 2 brings the deleted customers back.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.hashing import hash_key

# The run timestamps of the three stand-in load days and the change-rule constants.
T0 = datetime(2024, 1, 1, 0, 0, 0)
T1 = datetime(2024, 1, 11, 0, 0, 0)
T2 = datetime(2024, 1, 21, 0, 0, 0)
CUSTOMER_COPY_OFFSET = 2**40
ORDER_COPY_OFFSET = 2**40


_READS: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One DataFrame per (session, file): plans that use a table several times share one relation (and the
    driver lists and reads its footers once)."""
    path = f"{sf_dir}/{name}.parquet"
    key = (id(spark), path)
    df = _READS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _READS[key] = df
    return df


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region: 25 rows by the benchmark's definition (fixed size), safe to broadcast."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


def customers(spark: SparkSession, sf_dir: str, day: int = 0) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    if day >= 1:
        seg = F.when(F.col("c_custkey") % 20 == 3, F.lit("CHANGED")).otherwise(F.col("c_mktsegment"))
        base = c.withColumn("c_mktsegment", seg)
        copies = c.filter(F.col("c_custkey") % 100 == 1).withColumn(
            "c_custkey", F.col("c_custkey") + CUSTOMER_COPY_OFFSET)
        c = base.unionByName(copies)
        if day == 1:
            c = c.filter(F.col("c_custkey") % 50 != 7)
    g = _geo(spark, sf_dir)
    j = c.join(F.broadcast(g), c.c_nationkey == g.n_nationkey)
    return j.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.lit(None).cast("string").alias("email"),
        F.lit(None).cast("string").alias("phone_number"),
        F.concat(F.lit("ADDR "), F.col("c_custkey").cast("string")).alias("address"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lit(None).cast("string").alias("zip_code"),
        F.lit(None).cast("date").alias("registration_date"),
        F.lit(None).cast("timestamp_ntz").alias("last_updated_timestamp"),
    )


def vehicles(spark: SparkSession, sf_dir: str, day: int = 0) -> DataFrame:
    c = customers(spark, sf_dir, day)
    return c.select(
        F.col("customer_id").alias("vehicle_id"),
        F.col("customer_id"),
        F.concat(F.lit("VIN"), F.col("customer_id").cast("string")).alias("VIN"),
        F.col("last_name").alias("make"),
        F.lit(None).cast("string").alias("model"),
        F.lit(None).cast("int").alias("year"),
        F.lit(None).cast("int").alias("mileage"),
        F.lit(None).cast("string").alias("fuel_type"),
        F.lit(None).cast("string").alias("transmission_type"),
        F.lit(None).cast("timestamp_ntz").alias("last_updated_timestamp"),
    )


def employees(spark: SparkSession, sf_dir: str, day: int = 0) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("employee_id"),
        F.col("s_name").alias("first_name"),
        F.lit(None).cast("string").alias("last_name"),
        F.lit("Technician").alias("role"),
        F.lit(None).cast("date").alias("hire_date"),
        F.lit(None).cast("timestamp_ntz").alias("last_updated_timestamp"),
    )


def parts(spark: SparkSession, sf_dir: str, day: int = 0) -> DataFrame:
    p, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    return p.select(
        F.col("p_partkey").alias("part_id"),
        F.col("p_brand").alias("part_name"),
        F.concat(F.lit("PN"), (key - F.when(key % 20 == 19, 1).otherwise(0)).cast("string")).alias("part_number"),
        F.col("p_type").alias("category"),
        F.col("p_size").alias("current_stock_quantity"),
        F.col("p_retailprice").try_cast("decimal(10,2)").alias("unit_cost"),
        F.lit(None).cast("timestamp_ntz").alias("last_updated_timestamp"),
    )


def _orders(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    if day >= 1:
        status = F.when(F.col("o_orderkey") % 25 == 0, F.lit("CANCELLED")).otherwise(F.col("o_orderstatus"))
        base = o.withColumn("o_orderstatus", status)
        repeat = o.filter(F.col("o_orderkey") % 40 == 1).select(
            (F.col("o_orderkey") + ORDER_COPY_OFFSET).alias("o_orderkey"), "o_custkey", "o_orderstatus",
            "o_totalprice", (F.col("o_orderdate") + F.expr("INTERVAL '1 09:00:00' DAY TO SECOND")).alias("o_orderdate"),
            F.concat("o_orderpriority", F.lit("-REPEAT")).alias("o_orderpriority"))
        o = base.unionByName(repeat)
    return o


def appointments(spark: SparkSession, sf_dir: str, day: int = 0) -> DataFrame:
    o = _orders(spark, sf_dir, day)
    tech = F.col("o_orderkey") % 10
    return o.select(
        F.col("o_orderkey").alias("appointment_id"),
        F.col("o_custkey").alias("vehicle_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("appointment_date"),
        F.date_format("o_orderdate", "H:mm:ss").alias("appointment_time"),
        F.col("o_orderpriority").alias("service_type"),
        F.col("o_orderstatus").alias("status"),
        F.when(tech != 0, tech).alias("technician_id"),
        F.lit(None).cast("decimal(10,2)").alias("total_labor_hours"),
        F.lit(None).cast("decimal(10,2)").alias("total_parts_cost"),
        F.col("o_totalprice").try_cast("decimal(10,2)").alias("total_service_cost"),
        F.lit(None).cast("string").alias("notes"),
        F.col("o_orderdate").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("last_updated_timestamp"),
    )


def lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` without exact repetitions."""
    return table(spark, sf_dir, "lineitem").distinct()


def _rounded(x):
    """``round(x)`` of a double as BIGINT, half away from zero: below 2^52 from the exact remainder, without the decimal number
    that ``round`` makes of every value."""
    whole = F.floor(F.abs(x))
    near = F.when(F.abs(x) - whole >= 0.5, whole + 1).otherwise(whole)
    return F.when(F.abs(x) < 2.0**52, F.when(x < 0, -near).otherwise(near)).otherwise(F.round(x).cast("bigint"))


def _detail_id(li: DataFrame):
    """60 bits of hash over all columns; amounts in hundredths, so that the text is the same everywhere."""
    cents = lambda c: _rounded(F.col(c) * 100).alias(c)
    typed = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
                      F.to_date("l_shipdate").alias("l_shipdate"),
                      *[cents(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")], *[
                          F.col(c).alias(f"_{c}") for c in li.columns])
    return typed.withColumn("service_detail_id", hash_key(typed, DETAIL_COLUMNS)).select(
        "service_detail_id", *[F.col(f"_{c}").alias(c) for c in li.columns])


DETAIL_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                  "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _unit_cost():
    """``l_extendedprice / l_quantity`` rounded half-up to cents in integer arithmetic (exact, no double ties)."""
    cents = _rounded(F.col("l_extendedprice") * 100)
    q = F.col("l_quantity").cast("bigint")
    unit_cents = F.call_function("div", cents * 2 + q, q * 2)
    return F.when(q > 0, (unit_cents.cast("decimal(12,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(10,2)"))


def _detail_rows(li: DataFrame, *more: str) -> DataFrame:
    return _detail_id(li).select(
        "service_detail_id",
        F.col("l_orderkey").alias("appointment_id"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("task_description"),
        F.lit(None).cast("decimal(5,2)").alias("labor_hours"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_quantity").cast("int").alias("quantity_used"),
        _unit_cost().alias("unit_cost_at_time_of_service"),
        F.col("l_shipdate").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("last_updated_timestamp"),
        *more,
    )


def detail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The details of all days, with the day they come on (``_day``), in one pass over ``lineitems``."""
    key = F.col("l_orderkey")
    days = F.when(key % 40 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    li = lineitems(spark, sf_dir).select("*", F.explode(days).alias("_day"))
    return _detail_rows(li.withColumn("l_orderkey", F.when(F.col("_day") == 1, key + ORDER_COPY_OFFSET).otherwise(key)), "_day")


def details(spark: SparkSession, sf_dir: str, day: int = 0, lines: DataFrame | None = None) -> DataFrame:
    """``lines``: the written ``detail_lines``, for callers that take several days."""
    if lines is not None:
        return lines.filter(F.col("_day") <= day).drop("_day")
    li = lineitems(spark, sf_dir)
    if day >= 1:
        repeat = li.filter(F.col("l_orderkey") % 40 == 1).withColumn(
            "l_orderkey", F.col("l_orderkey") + ORDER_COPY_OFFSET)
        li = li.unionByName(repeat)
    return _detail_rows(li)


def sources(spark: SparkSession, sf_dir: str, day: int = 0, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    return {
        "Customers": customers(spark, sf_dir, day),
        "Vehicles": vehicles(spark, sf_dir, day),
        "Employees": employees(spark, sf_dir, day),
        "PartsInventory": parts(spark, sf_dir, day),
        "ServiceAppointments": appointments(spark, sf_dir, day),
        "ServiceDetails": details(spark, sf_dir, day, lines),
    }


def accident_extract_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table shaped like the accident CSV (original names, unit suffixes included)."""
    e = table(spark, sf_dir, "events")
    hr = F.hour("ts")
    et = F.col("event_type")
    not_err = et != "error"
    end = F.timestamp_add("MICROSECOND", F.round(F.col("value") * 60000000).cast("bigint"), F.col("ts"))
    temp = F.round(F.col("value"), 0)

    def daylight(lo: int, hi: int):
        return F.when(not_err, F.when((hr >= lo) & (hr <= hi), F.lit("Day")).otherwise(F.lit("Night")))

    return e.select(
        F.col("event_id").cast("string").alias("ID"),
        F.lit("events").alias("Source"),
        (F.lit(1) + F.call_function("div", hr, F.lit(6))).alias("Severity"),
        F.col("ts").alias("Start_Time"),
        end.alias("End_Time"),
        F.col("value").alias("Start_Lat"),
        (-F.col("value")).alias("Start_Lng"),
        F.col("value").alias("Distance(mi)"),
        F.col("props").alias("Description"),
        F.lit(None).cast("string").alias("Street"),
        F.concat(F.lit("CITY_"), F.col("user_id").cast("string")).alias("City"),
        F.lit(None).cast("string").alias("County"),
        et.alias("State"),
        F.lit(None).cast("string").alias("Zipcode"),
        F.lit(None).cast("string").alias("Country"),
        F.when(not_err, et).alias("Weather_Condition"),
        F.when(temp != 0, temp).alias("Temperature(F)"),
        F.lit(None).cast("double").alias("Visibility(mi)"),
        F.lit(None).cast("double").alias("Wind_Speed(mph)"),
        (et == "click").alias("Bump"),
        F.when(F.col("value") > 100, F.lit(True)).alias("Crossing"),
        (hr < 6).alias("Give_Way"),
        (et == "view").alias("Junction"),
        F.when(et == "signup", F.lit(True)).alias("No_Exit"),
        daylight(6, 17).alias("Sunrise_Sunset"),
        daylight(5, 18).alias("Civil_Twilight"),
        daylight(4, 19).alias("Nautical_Twilight"),
        F.when(et == "purchase", daylight(3, 20)).alias("Astronomical_Twilight"),
    )
