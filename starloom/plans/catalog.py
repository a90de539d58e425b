"""The query catalog: one entry per operator of the warehouse, each a ``(spark, sf_dir) -> DataFrame``.

Every query reads whole driver tables through the stand-in sources and calls the library operator it is named
after; results go through ``finalize`` (engine-neutral types).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import clean as X
from starloom.functions.hashing import hash_key, row_hash, value_hash
from starloom.operators import archive as A
from starloom.operators import dedupe as DD
from starloom.operators import dims as D
from starloom.operators import keys as K
from starloom.operators import lookup as L
from starloom.operators import marts as M
from starloom.operators import quality as Q
from starloom.operators.facts import upsert_facts
from starloom.operators.late import splice_dimension, splice_snapshot
from starloom.operators.scd2 import scd2_rebuild
from starloom.plans import car_service as CS
from starloom.plans import stand_in as SI
from starloom.plans import state as ST
from starloom.plans.ledger import Extract, apply_extract
from starloom.plans.loads import run_full, run_id_of, run_incremental, table_digests, together
from starloom.plans.output import finalize
from starloom.session import checkpoint_dir
from starloom.sources import buckets as B
from starloom.sources import evolution as E
from starloom.sources.csv_ranges import read_csv_ranges
from starloom.sources.sql import register_views, run_sql
from starloom.sources.store import Store, materialize
from starloom.sources.tables import read_csv_with_quarantine, write_csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------------------------------------ step 0: slice
@query("m2_service_trends")
def m2_service_trends(spark, sf):
    wh = ST.initial_warehouse(spark, sf, written=("dim_date", "dim_service_type"))
    return finalize(M.service_trends(wh.facts["fact_service_appointments"], wh.dims["dim_date"],
                                     wh.dims["dim_service_type"]))


# ------------------------------------------------------------------------------------- step 1: scalars, primitives
@query("x_clean_strings")
def x_clean_strings(spark, sf):
    c = SI.table(spark, sf, "customer")
    n = SI.table(spark, sf, "nation")
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    raw = F.concat(F.lit("\t "), F.lower("n_name"), F.lit(" \r\n"))
    seg = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("nan")).otherwise(F.col("c_mktsegment"))
    return finalize(j.select(
        "c_custkey",
        X.strip(raw).alias("stripped"),
        X.clean_text(raw, upper=True).alias("city_upper"),
        X.full_name("c_name", "c_mktsegment").alias("full_name"),
        X.null_if_token(seg).alias("segment"),
        X.crlf_to_lf(F.concat("c_name", F.lit("\r\n"), "c_mktsegment")).alias("lf_text"),
    ))


@query("x_numeric_coerce")
def x_numeric_coerce(spark, sf):
    c = SI.table(spark, sf, "customer")
    text = F.concat(c.c_acctbal.cast("decimal(12,2)").cast("string"),
                    F.when(c.c_acctbal < 0, F.lit(" USD")).otherwise(F.lit("")))
    return finalize(c.select(
        "c_custkey",
        X.to_decimal("c_acctbal", 12, 2).alias("balance"),
        X.to_decimal("c_acctbal", 5, 2).alias("balance_small"),
        X.to_decimal(text, 12, 2).alias("balance_from_text"),
    ))


@query("x_time_of_day")
def x_time_of_day(spark, sf):
    e = SI.table(spark, sf, "events")
    t = F.date_format("ts", "H:mm:ss")
    raw = F.when(F.col("event_type") == "error", F.concat(F.lit("25:"), F.substring_index(t, ":", -2))).otherwise(t)
    return finalize(e.select("event_id", X.hour_of_time(raw).alias("hour"), X.time_to_hms(raw).alias("hms")))


@query("x_duration_minutes")
def x_duration_minutes(spark, sf):
    acc = CS.accident_extract(SI.accident_extract_raw(spark, sf))
    return finalize(acc.select(F.col("ID").alias("event_id"),
                               X.duration_minutes("Start_Time", "End_Time").alias("duration_minutes")))


_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
            "l_linestatus", "l_shipdate"]


@query("r_dedupe_first")
def r_dedupe_first(spark, sf):
    return finalize(DD.keep_first(SI.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LI_REST))


@query("r_dedupe_last")
def r_dedupe_last(spark, sf):
    return finalize(DD.keep_last(SI.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LI_REST))


@query("r_dedupe_two_stage")
def r_dedupe_two_stage(spark, sf):
    return finalize(DD.two_stage(SI.table(spark, sf, "part"), ["p_partkey"], ["p_name"]))


@query("r_latest_per_key")
def r_latest_per_key(spark, sf):
    o = SI.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return finalize(DD.latest_per_key(o, ["o_custkey"], "o_orderdate", ["o_orderkey"]))


def _weather_keys(spark, sf):
    acc = CS.accident_extract(SI.accident_extract_raw(spark, sf))
    return acc.select("Start_Time", "ID", F.col("Weather_Condition").alias("weather_condition"),
                      F.col("Temperature_F").alias("temperature_f"))


@query("r_anti_join_nullsafe")
def r_anti_join_nullsafe(spark, sf):
    k = _weather_keys(spark, sf)
    allk = k.select("weather_condition", "temperature_f").distinct()
    early = k.filter(F.col("Start_Time") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")) \
        .select("weather_condition", "temperature_f")
    return finalize(L.anti_join(allk, early, ["weather_condition", "temperature_f"], null_safe=True))


@query("r_left_join_nullsafe")
def r_left_join_nullsafe(spark, sf):
    acc = CS.accident_extract(SI.accident_extract_raw(spark, sf))
    dim = CS.dim_weather(acc)
    src = acc.select(F.col("ID").alias("event_id"), X.clean_text("Weather_Condition").alias("_wc"),
                     F.col("Temperature_F").alias("_tf"), F.col("Wind_Speed_mph").alias("_ws"),
                     F.col("Visibility_mi").alias("_vis"))
    out = L.lookup_key(src, dim, [("_wc", "weather_condition"), ("_tf", "temperature_f"),
                                  ("_ws", "wind_speed_mph"), ("_vis", "visibility_mi")], "weather_key", null_safe=True)
    return finalize(out.select("event_id", "weather_key"))


# --------------------------------------------------------------------------------------- step 2: archive + diff
def _customer_diff(spark, sf, day=1):
    arch = ST.initial_archives(spark, sf)["archive_customers"]
    return ST.diff_entity(spark, sf, arch, "archive_customers", day)


@query("a1_archive_accidents")
def a1_archive_accidents(spark, sf):
    a = CS.archive_accidents(SI.accident_extract_raw(spark, sf), SI.T0)
    return finalize(a.select("ID", "Severity", "Start_Time", "End_Time", "Start_Lat", "Start_Lng", "Distance_mi",
                             "City", "State", "Weather_Condition", "Temperature_F", "Bump",
                             "Sunrise_Sunset", "load_timestamp", "valid_to_timestamp"))


@query("a2_archive_initial")
def a2_archive_initial(spark, sf):
    a = ST.initial_archives(spark, sf)["archive_customers"]
    return finalize(a.select("original_customer_id", "first_name", "last_name", "address", "city", "state",
                             "load_timestamp", "valid_from_timestamp", "valid_to_timestamp"))


@query("a6_archive_appointments")
def a6_archive_appointments(spark, sf):
    a = ST.initial_archives(spark, sf)["archive_service_appointments"]
    return finalize(a.select("original_appointment_id", "customer_id", "appointment_date", "appointment_time",
                             "service_type", "status", "technician_id", "total_service_cost", "source_created_at"))


@query("a8_change_hash")
def a8_change_hash(spark, sf):
    src = A.conform(SI.customers(spark, sf, 0), CS.CUSTOMERS)
    return finalize(src.select("original_customer_id", row_hash(src, CS.CUSTOMERS.compare).alias("change_hash")))


@query("a9_snapshot_diff")
def a9_snapshot_diff(spark, sf):
    return finalize(_customer_diff(spark, sf).select("original_customer_id", "op"))


@query("a10_closed_versions")
def a10_closed_versions(spark, sf):
    c = A.closed_versions(_customer_diff(spark, sf), SI.T1)
    return finalize(c.select("original_customer_id", "first_name", "last_name", "valid_from_timestamp",
                             "valid_to_timestamp"))


@query("a11_open_versions")
def a11_open_versions(spark, sf):
    o = A.open_after(_customer_diff(spark, sf), SI.T1)
    return finalize(o.select("original_customer_id", "first_name", "last_name", "load_timestamp",
                             "valid_from_timestamp", "valid_to_timestamp"))


@query("a12_change_counts")
def a12_change_counts(spark, sf):
    return finalize(A.change_counts(_customer_diff(spark, sf)))


@query("a13_appointment_changes")
def a13_appointment_changes(spark, sf):
    arch = ST.initial_archives(spark, sf)["archive_service_appointments"]
    diff = ST.diff_entity(spark, sf, arch, "archive_service_appointments", 1)
    return finalize(A.change_counts(diff))


# ------------------------------------------------------------------------------------------------- step 3: dims
def _dims(spark, sf):
    arch = ST.initial_archives(spark, sf)
    return arch, ST.initial_dims(arch, written=False)


@query("d1_dim_date")
def d1_dim_date(spark, sf):
    return finalize(_dims(spark, sf)[1]["dim_date"])


@query("d2_dim_location")
def d2_dim_location(spark, sf):
    return finalize(_dims(spark, sf)[1]["dim_location"])


@query("d3_dim_weather")
def d3_dim_weather(spark, sf):
    return finalize(_dims(spark, sf)[1]["dim_weather"])


@query("d4_dim_flags")
def d4_dim_flags(spark, sf):
    return finalize(_dims(spark, sf)[1]["dim_road_features"])


@query("d5_dim_daylight")
def d5_dim_daylight(spark, sf):
    return finalize(_dims(spark, sf)[1]["dim_daylight"])


@query("d6_dim_customer")
def d6_dim_customer(spark, sf):
    return finalize(_dims(spark, sf)[1]["dim_customer"])


@query("d7_dim_vehicle")
def d7_dim_vehicle(spark, sf):
    return finalize(_dims(spark, sf)[1]["dim_vehicle"])


@query("d8_dim_employee")
def d8_dim_employee(spark, sf):
    return finalize(_dims(spark, sf)[1]["dim_employee"])


@query("d9_dim_part")
def d9_dim_part(spark, sf):
    return finalize(_dims(spark, sf)[1]["dim_part"])


@query("d10_dim_service_type")
def d10_dim_service_type(spark, sf):
    return finalize(_dims(spark, sf)[1]["dim_service_type"])


@query("k1_dense_key")
def k1_dense_key(spark, sf):
    dim = _dims(spark, sf)[1]["dim_customer"].select("original_customer_id")
    return finalize(K.dense_key(dim, ["original_customer_id"], key="dense_key"))


@query("k2_hash_key")
def k2_hash_key(spark, sf):
    a = ST.initial_archives(spark, sf)["archive_customers"]
    return finalize(a.select("original_customer_id",
                             hash_key(a, ["original_customer_id", "valid_from_timestamp"]).alias("hash_key")))


# ------------------------------------------------------------------------------------------------ step 4: SCD-2
def _dim_customer_after(spark, sf, on_delete="close", track=None):
    arch0 = ST.initial_archives(spark, sf)["archive_customers"]
    dim0 = CS.dim_customer(arch0)
    arch1 = ST.archives_at(spark, sf, "archive_customers", 1)
    return CS.scd2_update(dim0, arch1, "dim_customer", SI.T0, SI.T1, on_delete=on_delete, track=track)


@query("d11_scd2_apply")
def d11_scd2_apply(spark, sf):
    return finalize(_dim_customer_after(spark, sf))


@query("d11_scd2_delete")
def d11_scd2_delete(spark, sf):
    return finalize(_dim_customer_after(spark, sf, on_delete="ignore"))


@query("d11_scd2_track_subset")
def d11_scd2_track_subset(spark, sf):
    return finalize(_dim_customer_after(spark, sf, track=["city", "state"]))


@query("d11_scd2_two_runs")
def d11_scd2_two_runs(spark, sf):
    return finalize(d11_scd2_two_runs_raw(spark, sf))


@query("d11_scd2_rebuild")
def d11_scd2_rebuild(spark, sf):
    arch2 = ST.archives_at(spark, sf, "archive_customers", 2)
    return finalize(scd2_rebuild(arch2, CS.DIM_CUSTOMER))


@query("d11_scd2_late")
def d11_scd2_late(spark, sf):
    """Day 2 runs before the extract of day 1 arrives, which is then spliced in: as after both days in order."""
    spec = CS.CUSTOMERS
    arch0 = ST.initial_archives(spark, sf)[spec.name]
    diff = materialize(A.snapshot_diff(SI.sources(spark, sf, 2)["Customers"], arch0, spec))
    arch2 = materialize(A.open_after(diff, SI.T2).unionByName(A.closed_versions(diff, SI.T2)))
    removed, added = (materialize(d) for d in splice_snapshot(arch2, SI.sources(spark, sf, 1)["Customers"], spec, SI.T1, SI.T2))
    dim, _, _ = splice_dimension(scd2_rebuild(arch2, CS.DIM_CUSTOMER), removed, added, CS.DIM_CUSTOMER)
    return finalize(dim)


@query("d16_dim_date_incr")
def d16_dim_date_incr(spark, sf):
    arch, dims = _dims(spark, sf)
    appts1 = ST.archives_at(spark, sf, "archive_service_appointments", 1)
    return finalize(CS.dim_date_incremental(appts1, dims["dim_date"], SI.T0, SI.T1))


@query("d17_service_type_incr")
def d17_service_type_incr(spark, sf):
    arch, dims = _dims(spark, sf)
    appts1 = ST.archives_at(spark, sf, "archive_service_appointments", 1)
    return finalize(CS.dim_service_type_incremental(appts1, dims["dim_service_type"], SI.T0, SI.T1))


# ------------------------------------------------------------------------------------------------- step 5: facts
@query("f1_fact_accidents")
def f1_fact_accidents(spark, sf):
    return finalize(ST.initial_warehouse(spark, sf).facts["fact_accidents"])


@query("f2_fact_appointments")
def f2_fact_appointments(spark, sf):
    return finalize(ST.initial_warehouse(spark, sf).facts["fact_service_appointments"])


@query("f3_fact_parts_usage")
def f3_fact_parts_usage(spark, sf):
    return finalize(ST.initial_warehouse(spark, sf).facts["fact_service_parts_usage"])


@query("f4_fact_appointments_incr")
def f4_fact_appointments_incr(spark, sf):
    return finalize(ST.incremental_warehouse(spark, sf).facts["fact_service_appointments"])


@query("f4_pruned_append")
def f4_pruned_append(spark, sf):
    """The appointment facts that a run adds on a store whose fact parts have filters: as ``f4_fact_appointments_incr``."""
    store = Store(spark, _fresh_store(spark).root, buckets=8)
    lines = _lines(spark, sf)
    _full(spark, sf, store, lines=lines)
    run_incremental(spark, store, SI.sources(spark, sf, 1, lines), SI.T1)
    added = store.manifest()["tables"]["fact_service_appointments"]["parts"][-1]
    return finalize(spark.read.parquet(added))


@query("f5_fact_parts_incr")
def f5_fact_parts_incr(spark, sf):
    return finalize(ST.incremental_warehouse(spark, sf).facts["fact_service_parts_usage"])


@query("f4_fact_appointments_replace")
def f4_fact_appointments_replace(spark, sf):
    """All appointment facts after a run in which changed appointments replace theirs."""
    wh0 = ST.initial_warehouse(spark, sf, written=True)
    wh1 = ST.incremental_warehouse(spark, sf, wh0)
    old = materialize(wh0.facts["fact_service_appointments"])
    new, _ = CS.fact_service_appointments_incremental(wh1.archives["archive_service_appointments"], old, wh1.dims, SI.T0,
                                                      SI.T1, cut=materialize, on_update="replace")
    return finalize(upsert_facts(old, new, ["original_appointment_id"]))


@query("f_rejects")
def f_rejects(spark, sf):
    wh = ST.initial_warehouse(spark, sf)
    return finalize(wh.rejects["fact_service_parts_usage"])


@query("f_rejects_incr")
def f_rejects_incr(spark, sf):
    return finalize(ST.incremental_warehouse(spark, sf).rejects["fact_service_appointments"])


# --------------------------------------------------------------------------------------- step 6: quality, watermark
def _all_tables(wh: ST.Warehouse) -> dict[str, DataFrame]:
    return {**wh.archives, **wh.dims, **wh.facts}


@query("q1_row_counts")
def q1_row_counts(spark, sf):
    wh = ST.initial_warehouse(spark, sf, share=True)
    ST.write_together(wh, wh.archives.keys(), wh.dims.keys(), wh.facts.keys())
    return finalize(Q.row_counts(_all_tables(wh)))


FACT_REQUIRED = {
    "fact_accidents": ["original_accident_id", "date_key", "location_key", "weather_key", "road_features_key",
                       "daylight_key"],
    "fact_service_appointments": ["original_appointment_id", "date_key", "customer_key", "vehicle_key",
                                  "employee_key", "service_type_key"],
    "fact_service_parts_usage": ["original_service_detail_id", "original_appointment_id", "date_key",
                                 "vehicle_key", "part_key"],
}


@query("q2_fk_nulls")
def q2_fk_nulls(spark, sf):
    wh = ST.initial_warehouse(spark, sf, share=True)
    ST.write_together(wh, wh.archives.keys(), wh.dims.keys(), FACT_REQUIRED)
    parts = [Q.null_counts(wh.facts[t], t, cols) for t, cols in FACT_REQUIRED.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return finalize(out)


@query("q3_star_join")
def q3_star_join(spark, sf):
    wh = ST.initial_warehouse(spark, sf, share=True)
    d = wh.dims
    ST.write_together(wh, ("archive_accidents_csv", "archive_service_appointments", "archive_customers", "archive_vehicles",
                           "archive_employees"), [t for t in d.keys() if t != "dim_part"], ("fact_accidents", "fact_service_appointments"))
    acc = Q.star_join_count(wh.facts["fact_accidents"], [(d["dim_date"], "date_key"),
                                                          (d["dim_location"], "location_key")])
    app = Q.star_join_count(wh.facts["fact_service_appointments"], [
        (d["dim_date"], "date_key"), (d["dim_customer"], "customer_key"), (d["dim_vehicle"], "vehicle_key"),
        (d["dim_service_type"], "service_type_key")])
    out = acc.select(F.lit("fact_accidents").alias("fact"), "*").unionByName(
        app.select(F.lit("fact_service_appointments").alias("fact"), "*"))
    return finalize(out)


UNIQUE_KEYS = {
    "dim_date": ["full_date", "hour"],
    "dim_location": ["latitude", "longitude", "city", "state"],
    "dim_weather": ["weather_condition", "temperature_f", "wind_speed_mph", "visibility_mi"],
    "dim_road_features": list(CS.ROAD_FLAG_COLUMNS),
    "dim_daylight": list(CS.DAYLIGHT_COLUMNS),
    "dim_service_type": ["service_type_name"],
    "fact_service_appointments": ["original_appointment_id"],
    "fact_service_parts_usage": ["original_service_detail_id"],
}


#: Dimensions that the checks of keys and the facts read; others have one reader and aren't written.
READ_TWICE = ("dim_date", "dim_customer", "dim_vehicle", "dim_service_type", "dim_location", "dim_weather")


@query("q4_one_pass")
def q4_one_pass(spark, sf):
    """As ``q4_uniqueness``: all declared keys of a table in one pass over it."""
    wh = ST.initial_warehouse(spark, sf, written=READ_TWICE[:4])
    own = {"dim_location": "location_key", "dim_weather": "weather_key", "dim_customer": "customer_key"}
    sets = {t: [k for k in (UNIQUE_KEYS.get(t), [own[t]] if t in own else None) if k] for t in dict.fromkeys([*UNIQUE_KEYS, *own])}
    tabs = _all_tables(wh)
    frames = {t: tabs[t] for t in sets}  # plans are built one after the other, jobs run together
    done = together({t: (lambda t=t: Q.uniqueness_one_pass(frames[t], t, sets[t])) for t in sets})
    out = None
    for t in sets:
        out = done[t] if out is None else out.unionByName(done[t])
    return finalize(out)


@query("q4_uniqueness")
def q4_uniqueness(spark, sf):
    wh = ST.initial_warehouse(spark, sf, written=READ_TWICE)
    ST.write_together(wh, dims=READ_TWICE)
    tabs = _all_tables(wh)
    parts = [Q.uniqueness_summary(tabs[t], t, keys) for t, keys in UNIQUE_KEYS.items()]
    key_parts = [Q.uniqueness_summary(wh.dims[t], t, [k]) for t, k in
                 (("dim_location", "location_key"), ("dim_weather", "weather_key"), ("dim_customer", "customer_key"))]
    out = parts[0]
    for p in parts[1:] + key_parts:
        out = out.unionByName(p)
    return finalize(out)


@query("q5_load_accounting")
def q5_load_accounting(spark, sf):
    wh = ST.initial_warehouse(spark, sf, share=True)
    cand = wh.archives["archive_service_details"].filter(F.col("part_id").isNotNull())
    return finalize(Q.load_accounting(cand, wh.facts["fact_service_parts_usage"],
                                      wh.rejects["fact_service_parts_usage"], "fact_service_parts_usage"))


@query("q6_scd2_invariants")
def q6_scd2_invariants(spark, sf):
    return finalize(Q.scd2_invariants(d11_scd2_two_runs_raw(spark, sf), "original_customer_id"))


def d11_scd2_two_runs_raw(spark, sf):
    dim1 = materialize(_dim_customer_after(spark, sf))
    arch2 = ST.archives_at(spark, sf, "archive_customers", 2)
    return CS.scd2_update(dim1, arch2, "dim_customer", SI.T1, SI.T2)


@query("p3_high_water_mark")
def p3_high_water_mark(spark, sf):
    arch = [ST.archives_at(spark, sf, e, 1) for e in
            ("archive_customers", "archive_service_appointments", "archive_vehicles")]
    return finalize(Q.high_water_mark(arch))


# ------------------------------------------------------------------------------------------------ step 8: marts
@query("m1_as_of_lookup")
def m1_as_of_lookup(spark, sf):
    dim = d11_scd2_two_runs_raw(spark, sf)
    ev = SI.table(spark, sf, "events").select("event_id", "user_id", "ts")
    out = M.as_of_lookup(ev, "user_id", "ts", dim, "original_customer_id", "customer_key")
    return finalize(out.select("event_id", "customer_key"))


@query("m1_as_of_sliced")
def m1_as_of_sliced(spark, sf):
    """As ``m1_as_of_lookup``, with a third of all events by one user, in time slices."""
    dim = materialize(d11_scd2_two_runs_raw(spark, sf))
    ev = SI.table(spark, sf, "events").select("event_id", "user_id", "ts")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id")).cast(ev.schema["user_id"].dataType)
    out = M.as_of_sliced(ev.withColumn("user_id", hot), "user_id", "ts", dim, "original_customer_id", "customer_key")
    return finalize(out.select("event_id", "customer_key"))


@query("m3_parts_usage")
def m3_parts_usage(spark, sf):
    wh = ST.initial_warehouse(spark, sf)
    return finalize(M.parts_usage_by_category(wh.facts["fact_service_parts_usage"], wh.dims["dim_part"]))


@query("m3_staff_performance")
def m3_staff_performance(spark, sf):
    wh = ST.initial_warehouse(spark, sf)
    return finalize(M.employee_performance(wh.facts["fact_service_appointments"], wh.dims["dim_employee"]))


@query("m4_drill_across")
def m4_drill_across(spark, sf):
    wh = ST.initial_warehouse(spark, sf, share=True)
    dd = wh.dims["dim_date"].select("date_key", "full_date")
    acc = wh.facts["fact_accidents"].join(dd, "date_key").groupBy("full_date").agg(
        F.count(F.lit(1)).alias("accidents"))
    app = wh.facts["fact_service_appointments"].join(dd, "date_key").groupBy("full_date").agg(
        F.count(F.lit(1)).alias("appointments"),
        F.sum(F.col("total_service_cost").cast("decimal(18,2)")).alias("billed"))
    return finalize(M.drill_across(acc, app, ["full_date"], fill=["accidents", "appointments", "billed"]))


# ------------------------------------------------------------------------------------------ step 7: load runs
def _fresh_store(spark) -> Store:
    return Store(spark, f"{checkpoint_dir(spark).rstrip('/')}/starloom-wh-{uuid.uuid4().hex}")


def _full(spark, sf, store, ts=SI.T0, lines=None):
    run_full(spark, store, SI.sources(spark, sf, 0, lines), ts, SI.accident_extract_raw(spark, sf))


def _lines(spark, sf):
    """The details of all days, written once for a query that loads several days."""
    return materialize(SI.detail_lines(spark, sf))


#: The columns whose contents the load queries digest, per table (archives: business columns).
DIGEST_COLUMNS = {
    "archive_customers": ["original_customer_id", "first_name", "last_name", "address", "city", "state"],
    "archive_vehicles": ["original_vehicle_id", "customer_id", "VIN", "make"],
    "archive_employees": ["original_employee_id", "first_name", "role"],
    "archive_parts_inventory": ["original_part_id", "part_name", "part_number", "category", "unit_cost"],
    "archive_service_appointments": ["original_appointment_id", "customer_id", "appointment_date", "appointment_time",
                                     "service_type", "status", "technician_id", "total_service_cost"],
    "archive_service_details": ["original_service_detail_id", "appointment_id", "part_id", "quantity_used",
                                "unit_cost_at_time_of_service"],
    "archive_accidents_csv": ["ID", "Severity", "City", "State", "Weather_Condition", "Temperature_F", "Bump"],
}


@query("p1_full_load")
def p1_full_load(spark, sf):
    store = _fresh_store(spark)
    _full(spark, sf, store)
    return finalize(table_digests(spark, store, DIGEST_COLUMNS))


@query("p1_full_reload")
def p1_full_reload(spark, sf):
    """A second full load replaces the first: same contents as one."""
    store = _fresh_store(spark)
    lines = _lines(spark, sf)
    _full(spark, sf, store, SI.T0 - timedelta(days=1), lines)
    _full(spark, sf, store, lines=lines)
    return finalize(table_digests(spark, store, DIGEST_COLUMNS))


@query("p2_incremental_load")
def p2_incremental_load(spark, sf):
    store = _fresh_store(spark)
    lines = _lines(spark, sf)
    _full(spark, sf, store, lines=lines)
    run_incremental(spark, store, SI.sources(spark, sf, 1, lines), SI.T1)
    return finalize(table_digests(spark, store, DIGEST_COLUMNS))


@query("p2_resumed_run")
def p2_resumed_run(spark, sf):
    """An incremental run that ends behind its dimensions, and its second attempt, which takes over what was written: the
    contents of all tables, as in ``p2_incremental_load``."""
    store = _fresh_store(spark)
    lines = _lines(spark, sf)
    _full(spark, sf, store, lines=lines)
    run_incremental(spark, store, SI.sources(spark, sf, 1, lines), SI.T1, resume="day 1", until="dimensions")
    run_incremental(spark, store, SI.sources(spark, sf, 1, lines), SI.T1, resume="day 1")
    return finalize(table_digests(spark, store, DIGEST_COLUMNS))


@query("p6_late_extract")
def p6_late_extract(spark, sf):
    """Day 2 is applied before day 1 arrives, then day 1, and day 1 again: the customer dimension is as after both days
    in order."""
    store = _fresh_store(spark)
    lines = _lines(spark, sf)
    _full(spark, sf, store, lines=lines)
    for day, ts in ((2, SI.T2), (1, SI.T1), (1, SI.T1)):
        apply_extract(spark, store, Extract(ts.isoformat(), str(day)), lambda s, root: SI.sources(s, sf, int(root), lines))
    return finalize(store.read("dim_customer"))


@query("s5_bucket_update")
def s5_bucket_update(spark, sf):
    """A full load and an incremental run on a store with id buckets: the contents of all tables, as in
    ``p2_incremental_load``."""
    store = Store(spark, _fresh_store(spark).root, buckets=32)
    lines = _lines(spark, sf)
    _full(spark, sf, store, lines=lines)
    run_incremental(spark, store, SI.sources(spark, sf, 1, lines), SI.T1)
    return finalize(table_digests(spark, store, DIGEST_COLUMNS))


@query("a9_digest_diff")
def a9_digest_diff(spark, sf):
    """Customers of day 1 against the bucketed archive of day 0: the changes, read from the differing buckets only, and the
    unchanged ids of all others."""
    store = _fresh_store(spark)
    spec, n = CS.CUSTOMERS, 64
    entry = B.write_buckets(store, ST.initial_archives(spark, sf)[spec.name], spec.name, run_id_of(SI.T0), spec.archive_id,
                            value_hash(spec.compare), n)
    source = materialize(SI.sources(spark, sf, 1)["Customers"])
    diff, found = CS.digest_diff(spec.name, source, entry)
    return finalize(diff.select(spec.archive_id, "op").unionByName(A.unchanged_elsewhere(source, n, found, spec)))


@query("p4_reject_replay")
def p4_reject_replay(spark, sf):
    """Appointments rejected on day 1 (their customers were missing) become facts on day 2, when the customers are
    back; with the number of rejects left."""
    store = _fresh_store(spark)
    lines = _lines(spark, sf)
    _full(spark, sf, store, lines=lines)
    run_incremental(spark, store, SI.sources(spark, sf, 1, lines), SI.T1)
    run_incremental(spark, store, SI.sources(spark, sf, 2, lines), SI.T2)
    day1 = store.read("rejects_fact_service_appointments", run_id=run_id_of(SI.T1)).select("original_appointment_id")
    left = store.read("rejects_fact_service_appointments").select("original_appointment_id").withColumn("_left", F.lit(1))
    facts = store.read("fact_service_appointments").select(
        "original_appointment_id", "customer_key", "vehicle_key", "date_key")
    out = day1.join(facts, "original_appointment_id", "left").join(left, "original_appointment_id", "left")
    return finalize(out.select("original_appointment_id", "customer_key", "vehicle_key", "date_key",
                               F.coalesce("_left", F.lit(0)).alias("still_rejected")))


# ------------------------------------------------------------------------------------------ sources
@query("s2_csv_round_trip")
def s2_csv_round_trip(spark, sf):
    """``documents`` written as CSV and read back: texts with quotes, commas and line breaks survive."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/starloom-csv-{uuid.uuid4().hex}"
    docs = SI.table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    write_csv(docs, path)
    good, bad = read_csv_with_quarantine(spark, path, ["n_chars", "doc_id", "source", "lang", "text", "absent"])
    rows = good.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5("text").alias("text_md5"), "lang", "source",
                       F.col("n_chars").cast("bigint").alias("n_chars"), F.col("absent").alias("absent"))
    lost = bad.select(F.lit(None).cast("bigint").alias("doc_id"), F.md5("line").alias("text_md5"),
                      *[F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("source", "string"),
                                                                  ("n_chars", "bigint"), ("absent", "string"))])
    return finalize(rows.unionByName(lost))


@query("s8_csv_quarantine")
def s8_csv_quarantine(spark, sf):
    """``documents`` as CSV lines, of which every seventh lacks values and another seventh has one too many, read by byte
    ranges: the good ones by their columns, the broken ones as they are."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/starloom-csv-{uuid.uuid4().hex}"
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    kind = F.col("doc_id") % 7
    more = F.when(kind == 0, F.lit("")).when(kind == 1, F.concat(F.lit(","), F.col("lang"), F.lit(',one,"more"'))).otherwise(
        F.concat(F.lit(","), F.col("lang")))
    docs = SI.table(spark, sf, "documents")
    line = F.concat(F.col("doc_id").cast("string"), F.lit(","), F.coalesce(quoted, F.lit("")), F.coalesce(more, F.lit(",")))
    docs.select(line.alias("value")).write.text(path)
    good, bad = read_csv_ranges(spark, path, ["lang", "text", "doc_id"], names=["doc_id", "text", "lang"])
    rows = good.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5("text").alias("text_md5"), "lang",
                       F.lit(False).alias("broken"))
    lost = bad.select(F.substring_index("line", ",", 1).cast("bigint").alias("doc_id"), F.md5("line").alias("text_md5"),
                      F.lit(None).cast("string").alias("lang"), F.lit(True).alias("broken"))
    return finalize(rows.unionByName(lost))


@query("s7_evolved_read")
def s7_evolved_read(spark, sf):
    """``orders`` in three parts, before and after columns were renamed, widened, added and dropped, read in the last
    columns."""
    store = _fresh_store(spark)
    o = SI.table(spark, sf, "orders")
    third = F.pmod("o_orderkey", F.lit(3))
    price = F.col("o_totalprice").cast("decimal(10,2)")
    placed = F.col("o_orderdate").cast("date")
    schemas = E.declare({"order_id": "bigint", "total": "decimal(10,2)", "placed": "date", "priority": "string"})
    extracts = [o.filter(third == 0).select(F.col("o_orderkey").alias("order_id"), price.alias("total"),
                                            placed.alias("placed"), F.col("o_orderpriority").alias("priority"))]
    changes = [{"rename": {"total": "amount"}, "widen": {"total": "decimal(14,2)"}, "add": {"status": "string"}},
               {"drop": ["priority"], "widen": {"placed": "timestamp_ntz"}, "add": {"customer": "bigint", "priority": "string"}}]
    rest = [F.col("o_orderkey").alias("order_id"), price.alias("amount"), placed.alias("placed"),
            F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")]
    extracts += [o.filter(third == 1).select(*rest),
                 o.filter(third == 2).select(*rest, F.col("o_custkey").alias("customer"))]
    for n, (rows, change) in enumerate(zip(extracts, [None, *changes])):
        schemas = E.evolve(schemas, **change) if change else schemas
        ts = SI.T0 + timedelta(days=n)
        entry = E.write_part(store, rows, "orders", run_id_of(ts), schemas)
        store.publish(run_id_of(ts), ts.isoformat(), {"orders": entry})
    return finalize(store.read("orders"))


@query("s9_parameterised_sql")
def s9_parameterised_sql(spark, sf):
    """Published tables as views, queried with named parameters."""
    wh = ST.initial_warehouse(spark, sf)
    views = register_views({"fact_service_appointments": wh.facts["fact_service_appointments"],
                            "dim_service_type": wh.dims["dim_service_type"]}, "s9_")
    return finalize(run_sql(spark, f"""
        SELECT t.service_type_name, count(*) AS appointments, sum(f.total_service_cost) AS billed
        FROM {views['fact_service_appointments']} f JOIN {views['dim_service_type']} t USING (service_type_key)
        WHERE f.total_service_cost >= :least GROUP BY t.service_type_name""", {"least": 1000}))


@query("x9_timestamp_coerce")
def x9_timestamp_coerce(spark, sf):
    e = SI.table(spark, sf, "events")
    text = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return finalize(e.select("event_id", X.to_timestamp_ntz(text).alias("at"),
                             X.to_date(F.substring(text, 1, 10)).alias("on_day")))


@query("x20_boolean_coerce")
def x20_boolean_coerce(spark, sf):
    e = SI.table(spark, sf, "events")
    text = (F.when(F.col("event_type") == "click", "True").when(F.col("event_type") == "view", "false")
            .when(F.col("event_type") == "error", "maybe").otherwise("no"))
    return finalize(e.select("event_id", X.to_boolean(text).alias("flag"),
                             F.coalesce(X.to_boolean(text), F.lit(False)).alias("flag_or_false")))


@query("a3_archive_vehicles")
def a3_archive_vehicles(spark, sf):
    a = ST.initial_archives(spark, sf)["archive_vehicles"]
    return finalize(a.select("original_vehicle_id", "customer_id", "VIN", "make", "load_timestamp", "valid_to_timestamp"))


@query("a4_archive_employees")
def a4_archive_employees(spark, sf):
    a = ST.initial_archives(spark, sf)["archive_employees"]
    return finalize(a.select("original_employee_id", "first_name", "last_name", "role", "load_timestamp"))


@query("a5_archive_parts")
def a5_archive_parts(spark, sf):
    a = ST.initial_archives(spark, sf)["archive_parts_inventory"]
    return finalize(a.select("original_part_id", "part_name", "part_number", "category", "current_stock_quantity",
                             "unit_cost", "load_timestamp"))


@query("a7_archive_details")
def a7_archive_details(spark, sf):
    a = ST.initial_archives(spark, sf)["archive_service_details"]
    return finalize(a.select("original_service_detail_id", "appointment_id", "part_id", "quantity_used",
                             "unit_cost_at_time_of_service", "task_description", "load_timestamp"))
