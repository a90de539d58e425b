"""The car-service + traffic-accident warehouse: 6 OLTP entities and an accident extract -> 7 archives ->
10 dimensions -> 3 facts. Every function here wires generic operators to the warehouse's column names.

Source schemas follow the OLTP tables (Customers, Employees, PartsInventory, Vehicles, ServiceAppointments,
ServiceDetails) and the accident CSV after its unit-suffix renames.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import ts_lit

from starloom.functions.calendar import date_hour_key, flags_mask
from starloom.functions.clean import (
    clean_text,
    duration_minutes,
    full_name,
    hour_of_time,
    line_amount,
    strip,
    time_to_hms,
)
from starloom.operators import archive as A
from starloom.operators import dims as D
from starloom.operators import facts as FX
from starloom.operators.dedupe import keep_first
from starloom.operators.lookup import semi_join
from starloom.operators.scd2 import scd2_apply
from starloom.spec import EntitySpec, JunkDimSpec, LookupSpec, Scd2Spec

# --------------------------------------------------------------------------------------------------------------
# Warehouse column names, types and change-tracking sets of the source entities.
# --------------------------------------------------------------------------------------------------------------
CUSTOMERS = EntitySpec(
    name="archive_customers", source_id="customer_id", archive_id="original_customer_id",
    columns={
        "customer_id": "bigint", "first_name": "string", "last_name": "string", "email": "string",
        "phone_number": "string", "address": "string", "city": "string", "state": "string", "zip_code": "string",
        "registration_date": "date", "last_updated_timestamp": "timestamp_ntz",
    },
    rename={"last_updated_timestamp": "source_last_updated_timestamp"},
    compare=("first_name", "last_name", "email", "phone_number", "address", "city", "state", "zip_code",
             "registration_date"),
)
VEHICLES = EntitySpec(
    name="archive_vehicles", source_id="vehicle_id", archive_id="original_vehicle_id",
    columns={
        "vehicle_id": "bigint", "customer_id": "bigint", "VIN": "string", "make": "string", "model": "string",
        "year": "int", "mileage": "int", "fuel_type": "string", "transmission_type": "string",
        "last_updated_timestamp": "timestamp_ntz",
    },
    rename={"last_updated_timestamp": "source_last_updated_timestamp"},
    compare=("customer_id", "VIN", "make", "model", "year", "mileage", "fuel_type", "transmission_type"),
)
EMPLOYEES = EntitySpec(
    name="archive_employees", source_id="employee_id", archive_id="original_employee_id",
    columns={
        "employee_id": "bigint", "first_name": "string", "last_name": "string", "role": "string",
        "hire_date": "date", "last_updated_timestamp": "timestamp_ntz",
    },
    rename={"last_updated_timestamp": "source_last_updated_timestamp"},
    compare=("first_name", "last_name", "role", "hire_date"),
)
PARTS = EntitySpec(
    name="archive_parts_inventory", source_id="part_id", archive_id="original_part_id",
    columns={
        "part_id": "bigint", "part_name": "string", "part_number": "string", "category": "string",
        "current_stock_quantity": "int", "unit_cost": "decimal(10,2)", "last_updated_timestamp": "timestamp_ntz",
    },
    rename={"last_updated_timestamp": "source_last_updated_timestamp"},
    compare=("part_name", "part_number", "category", "current_stock_quantity", "unit_cost"),
)
APPOINTMENTS = EntitySpec(
    name="archive_service_appointments", source_id="appointment_id", archive_id="original_appointment_id",
    columns={
        "appointment_id": "bigint", "vehicle_id": "bigint", "customer_id": "bigint", "appointment_date": "date",
        "appointment_time": "string", "service_type": "string", "status": "string", "technician_id": "bigint",
        "total_labor_hours": "decimal(10,2)", "total_parts_cost": "decimal(10,2)",
        "total_service_cost": "decimal(10,2)", "notes": "string", "created_at": "timestamp_ntz",
        "last_updated_timestamp": "timestamp_ntz",
    },
    rename={"created_at": "source_created_at", "last_updated_timestamp": "source_last_updated_timestamp"},
    compare=("vehicle_id", "customer_id", "appointment_date", "appointment_time", "service_type", "status",
             "technician_id", "total_labor_hours", "total_parts_cost", "total_service_cost"),
)
DETAILS = EntitySpec(
    name="archive_service_details", source_id="service_detail_id", archive_id="original_service_detail_id",
    columns={
        "service_detail_id": "bigint", "appointment_id": "bigint", "task_description": "string",
        "labor_hours": "decimal(5,2)", "part_id": "bigint", "quantity_used": "int",
        "unit_cost_at_time_of_service": "decimal(10,2)", "created_at": "timestamp_ntz",
        "last_updated_timestamp": "timestamp_ntz",
    },
    rename={"created_at": "source_created_at", "last_updated_timestamp": "source_last_updated_timestamp"},
    compare=("appointment_id", "task_description", "labor_hours", "part_id", "quantity_used",
             "unit_cost_at_time_of_service"),
)
ENTITIES = {e.name: e for e in (CUSTOMERS, VEHICLES, EMPLOYEES, PARTS, APPOINTMENTS, DETAILS)}
SOURCE_TABLES = {
    "archive_customers": "Customers", "archive_vehicles": "Vehicles", "archive_employees": "Employees",
    "archive_parts_inventory": "PartsInventory", "archive_service_appointments": "ServiceAppointments",
    "archive_service_details": "ServiceDetails",
}

# Accident extract: the eight unit-suffixed CSV names and their warehouse names, the 13 road flags, the
# four daylight columns, timestamp columns.
ACCIDENT_RENAMES = {
    "Distance(mi)": "Distance_mi", "Temperature(F)": "Temperature_F", "Wind_Chill(F)": "Wind_Chill_F",
    "Humidity(%)": "Humidity_pct", "Pressure(in)": "Pressure_in", "Visibility(mi)": "Visibility_mi",
    "Wind_Speed(mph)": "Wind_Speed_mph", "Precipitation(in)": "Precipitation_in",
}
ROAD_FLAGS = ("Amenity", "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway", "Roundabout", "Station",
              "Stop", "Traffic_Calming", "Traffic_Signal", "Turning_Loop")
ROAD_FLAG_COLUMNS = ("has_amenity", "has_bump", "has_crossing", "has_give_way", "has_junction", "has_no_exit",
                     "has_railway", "has_roundabout", "has_station", "has_stop", "has_traffic_calming",
                     "has_traffic_signal", "is_turning_loop")
DAYLIGHT = ("Sunrise_Sunset", "Civil_Twilight", "Nautical_Twilight", "Astronomical_Twilight")
DAYLIGHT_COLUMNS = ("sunrise_sunset", "civil_twilight", "nautical_twilight", "astronomical_twilight")
ACCIDENT_TIMESTAMPS = ("Start_Time", "End_Time", "Weather_Timestamp")
DEFAULT_COUNTRY = "US"

ACCIDENT_TYPES = {
    "ID": "string", "Source": "string", "Severity": "int", "Start_Time": "timestamp_ntz",
    "End_Time": "timestamp_ntz", "Start_Lat": "decimal(9,6)", "Start_Lng": "decimal(10,6)",
    "End_Lat": "decimal(9,6)", "End_Lng": "decimal(10,6)", "Distance_mi": "decimal(10,2)", "Description": "string",
    "Street": "string", "City": "string", "County": "string", "State": "string", "Zipcode": "string",
    "Country": "string", "Timezone": "string", "Airport_Code": "string", "Weather_Timestamp": "timestamp_ntz",
    "Temperature_F": "decimal(5,2)", "Wind_Chill_F": "decimal(5,2)", "Humidity_pct": "decimal(5,2)",
    "Pressure_in": "decimal(5,2)", "Visibility_mi": "decimal(5,2)", "Wind_Direction": "string",
    "Wind_Speed_mph": "decimal(6,2)", "Precipitation_in": "decimal(6,2)", "Weather_Condition": "string",
    **{f: "boolean" for f in ROAD_FLAGS}, **{d: "string" for d in DAYLIGHT},
}

# --------------------------------------------------------------------------------------------------------------
# Dimension specs
# --------------------------------------------------------------------------------------------------------------
DIM_CUSTOMER = Scd2Spec(
    name="dim_customer", archive_id="original_customer_id", key="customer_key",
    mapper=lambda: [
        full_name("first_name", "last_name").alias("customer_name"), F.col("email"), F.col("phone_number"),
        F.col("address"), F.col("city"), F.col("state"), F.col("zip_code"), F.col("registration_date"),
    ],
    attributes=("customer_name", "email", "phone_number", "address", "city", "state", "zip_code",
                "registration_date"),
)
DIM_VEHICLE = Scd2Spec(
    name="dim_vehicle", archive_id="original_vehicle_id", key="vehicle_key",
    mapper=lambda: [F.col(c) for c in ("VIN", "make", "model", "year", "fuel_type", "transmission_type")],
    attributes=("VIN", "make", "model", "year", "fuel_type", "transmission_type"),
)
DIM_EMPLOYEE = Scd2Spec(
    name="dim_employee", archive_id="original_employee_id", key="employee_key",
    mapper=lambda: [full_name("first_name", "last_name").alias("employee_name"), F.col("role"), F.col("hire_date")],
    attributes=("employee_name", "role", "hire_date"),
)
DIM_PART = Scd2Spec(
    name="dim_part", archive_id="original_part_id", key="part_key",
    mapper=lambda: [F.col("part_name"), F.col("part_number"), F.col("category")],
    attributes=("part_name", "part_number", "category"),
)
SCD2_DIMS = {s.name: s for s in (DIM_CUSTOMER, DIM_VEHICLE, DIM_EMPLOYEE, DIM_PART)}
SCD2_ARCHIVE = {"dim_customer": "archive_customers", "dim_vehicle": "archive_vehicles",
                "dim_employee": "archive_employees", "dim_part": "archive_parts_inventory"}

LOCATION = JunkDimSpec(
    name="dim_location", key="location_key", natural_key=("latitude", "longitude", "city", "state"),
    attributes=("street", "county", "zip_code", "country"), order=("_src_rank", "_src_order"), drop_all_null=False,
)
WEATHER = JunkDimSpec(
    name="dim_weather", key="weather_key",
    natural_key=("weather_condition", "temperature_f", "wind_speed_mph", "visibility_mi"),
    attributes=("wind_chill_f", "humidity_percent", "pressure_in", "wind_direction", "precipitation_in"),
    order=("_src_order",),
)
DAYLIGHT_DIM = JunkDimSpec(name="dim_daylight", key="daylight_key", natural_key=DAYLIGHT_COLUMNS)
#: The surrogate key of every dimension.
DIM_KEYS = {"dim_date": "date_key", "dim_location": "location_key", "dim_weather": "weather_key",
            "dim_road_features": "road_features_key", "dim_daylight": "daylight_key",
            "dim_service_type": "service_type_key", **{n: s.key for n, s in SCD2_DIMS.items()}}


# --------------------------------------------------------------------------------------------------------------
# Archive layer
# --------------------------------------------------------------------------------------------------------------
def accident_extract(raw: DataFrame) -> DataFrame:
    """Accident extract -> archive columns: unit-suffix renames, typed coercion (bad values -> NULL)."""
    df = raw.withColumnsRenamed({k: v for k, v in ACCIDENT_RENAMES.items() if k in raw.columns})
    have = set(df.columns)
    cols = []
    for c, t in ACCIDENT_TYPES.items():
        if c not in have:
            cols.append(F.lit(None).cast(t).alias(c))
        elif t == "string":
            cols.append(F.col(c).cast("string").alias(c))
        else:
            cols.append(F.col(c).try_cast(t).alias(c))
    return df.select(*cols)


def archive_accidents(raw: DataFrame, run_ts: datetime) -> DataFrame:
    """A1: the accident archive (full load only; the extract has no incremental path)."""
    return A.stamp_open(accident_extract(raw), run_ts)


def prepare_source(name: str, df: DataFrame) -> DataFrame:
    """Source-specific normalisation applied before archiving and diffing: appointment times as ``HH:mm:ss``
    (a database TIME may arrive as ``9:05:03`` text; unparsable values become NULL)."""
    if name == "archive_service_appointments" and "appointment_time" in df.columns:
        return df.withColumn("appointment_time", time_to_hms("appointment_time"))
    return df


def archive_all_initial(sources: Mapping[str, DataFrame], run_ts: datetime) -> dict[str, DataFrame]:
    """Every OLTP source becomes its initial archive."""
    return {name: A.archive_initial(prepare_source(name, sources[SOURCE_TABLES[name]]), spec, run_ts)
            for name, spec in ENTITIES.items()}


def snapshot_diff(name: str, source: DataFrame, archive: DataFrame) -> DataFrame:
    """A9 for one entity: the day's source snapshot against the archive's open versions."""
    return A.snapshot_diff(prepare_source(name, source), A.open_versions(archive), ENTITIES[name])


def digest_diff(name: str, source: DataFrame, entry: Mapping, cut=None) -> tuple[DataFrame, list[int]]:
    """A9 by digests, for a bucketed archive: the changes and the buckets that have any."""
    return A.digest_diff(prepare_source(name, source), entry, ENTITIES[name], cut)


# --------------------------------------------------------------------------------------------------------------
# Dimensions
# --------------------------------------------------------------------------------------------------------------
def appointment_points(appts: DataFrame) -> DataFrame:
    return D.date_hours(appts, date="appointment_date", hour=hour_of_time("appointment_time"))


def dim_date(accidents: DataFrame | None, customers: DataFrame, appts: DataFrame, employees: DataFrame,
             existing: DataFrame | None = None) -> DataFrame:
    """Calendar at (date, hour) from accident start/end, registrations, appointments, hire dates."""
    pts = []
    if accidents is not None:
        pts += [D.date_hours(accidents, ts="Start_Time"), D.date_hours(accidents, ts="End_Time")]
    pts += [
        D.date_hours(customers, date="registration_date"),
        appointment_points(appts),
        D.date_hours(employees, date="hire_date"),
    ]
    return D.calendar_dim(pts, existing)


def _location_rows(accidents: DataFrame | None, customers: DataFrame) -> DataFrame:
    cust = customers.select(
        F.lit(None).cast("decimal(9,6)").alias("latitude"), F.lit(None).cast("decimal(9,6)").alias("longitude"),
        clean_text("city", upper=True).alias("city"), clean_text("state", upper=True).alias("state"),
        clean_text("address").alias("street"), F.lit(None).cast("string").alias("county"),
        clean_text("zip_code").alias("zip_code"), F.lit(DEFAULT_COUNTRY).alias("country"),
        F.lit(1).alias("_src_rank"), F.col("original_customer_id").cast("string").alias("_src_order"),
    )
    if accidents is None:
        return cust.filter(F.col("city").isNotNull() & F.col("state").isNotNull())
    acc = accidents.select(
        F.round(F.col("Start_Lat"), 6).cast("decimal(9,6)").alias("latitude"),
        F.round(F.col("Start_Lng"), 6).cast("decimal(9,6)").alias("longitude"),
        clean_text("City", upper=True).alias("city"), clean_text("State", upper=True).alias("state"),
        clean_text("Street").alias("street"), clean_text("County").alias("county"),
        clean_text("Zipcode").alias("zip_code"),
        F.coalesce(clean_text("Country"), F.lit(DEFAULT_COUNTRY)).alias("country"),
        F.lit(0).alias("_src_rank"), F.col("ID").alias("_src_order"),
    )
    return acc.unionByName(cust).filter(F.col("city").isNotNull() & F.col("state").isNotNull())


def dim_location(accidents: DataFrame | None, customers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Null-safe key (lat, lng, CITY, STATE); accident rows win over customer rows, then by source id."""
    return D.junk_dim(_location_rows(accidents, customers), LOCATION, existing)


def _weather_rows(accidents: DataFrame) -> DataFrame:
    return accidents.select(
        clean_text("Weather_Condition").alias("weather_condition"),
        F.col("Temperature_F").cast("decimal(5,2)").alias("temperature_f"),
        F.col("Wind_Chill_F").cast("decimal(5,2)").alias("wind_chill_f"),
        F.col("Humidity_pct").cast("decimal(5,2)").alias("humidity_percent"),
        F.col("Pressure_in").cast("decimal(5,2)").alias("pressure_in"),
        F.col("Visibility_mi").cast("decimal(5,2)").alias("visibility_mi"),
        clean_text("Wind_Direction").alias("wind_direction"),
        F.col("Wind_Speed_mph").cast("decimal(6,2)").alias("wind_speed_mph"),
        F.col("Precipitation_in").cast("decimal(6,2)").alias("precipitation_in"),
        F.col("ID").alias("_src_order"),
    )


def dim_weather(accidents: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """D3: key (condition, temperature, wind speed, visibility); all-NULL keys dropped; first row's attributes."""
    return D.junk_dim(_weather_rows(accidents), WEATHER, existing)


def _flag_rows(accidents: DataFrame) -> DataFrame:
    return accidents.select(*[F.col(s).alias(t) for s, t in zip(ROAD_FLAGS, ROAD_FLAG_COLUMNS)])


def dim_road_features(accidents: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct 13-flag combinations, NULL -> False; key = bit mask."""
    return D.flags_dim(_flag_rows(accidents), ROAD_FLAG_COLUMNS, "road_features_key", existing)


def _daylight_rows(accidents: DataFrame) -> DataFrame:
    return accidents.select(*[clean_text(s).alias(t) for s, t in zip(DAYLIGHT, DAYLIGHT_COLUMNS)])


def dim_daylight(accidents: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct trimmed daylight quadruples, all-NULL dropped."""
    return D.junk_dim(_daylight_rows(accidents), DAYLIGHT_DIM, existing)


def dim_customer(archive: DataFrame) -> DataFrame:
    """One current row per customer id (first version), validity set."""
    return D.scd2_initial(archive, DIM_CUSTOMER, keep="first")


def dim_vehicle(archive: DataFrame) -> DataFrame:
    """Id and VIN required; first by id, then first by VIN."""
    return D.scd2_initial(archive, DIM_VEHICLE, keep="first", second_key=("VIN",), require=("VIN",))


def dim_employee(archive: DataFrame) -> DataFrame:
    """One current row per employee id."""
    return D.scd2_initial(archive, DIM_EMPLOYEE, keep="first")


def dim_part(archive: DataFrame) -> DataFrame:
    """Open versions, last by id, then last by part number."""
    return D.scd2_initial(archive, DIM_PART, keep="last", second_key=("part_number",), require=("part_number",))


def dim_service_type(appts: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct trimmed, non-blank service types."""
    return D.name_dim(appts, "service_type", "service_type_name", "service_type_key", existing)


def dim_date_incremental(appts_archive: DataFrame, existing: DataFrame, last_run, run_ts) -> DataFrame:
    """(date, hour) of appointment versions with ``valid_from`` in ``[last_run, run_ts]`` not yet present."""
    vf = F.col(A.VALID_FROM)
    w = appts_archive.filter((vf >= ts_lit(last_run)) & (vf <= ts_lit(run_ts)))
    return D.calendar_dim([appointment_points(w)], existing)


def dim_service_type_incremental(appts_archive: DataFrame, existing: DataFrame, last_run, run_ts) -> DataFrame:
    """Service types of open appointment versions opened in ``(last_run, run_ts]`` not yet present."""
    vf = F.col(A.VALID_FROM)
    w = A.open_versions(appts_archive).filter(
        (vf > ts_lit(last_run)) & (vf <= ts_lit(run_ts)))
    return dim_service_type(w, existing)


def scd2_update(dim: DataFrame, archive: DataFrame, name: str, last_run, run_ts, on_delete: str = "close",
                track=None) -> DataFrame:
    """The generic SCD-2 apply with the dimension's mapper."""
    return scd2_apply(dim, archive, SCD2_DIMS[name], last_run, run_ts, on_delete=on_delete, track=track)


# --------------------------------------------------------------------------------------------------------------
# Facts
# --------------------------------------------------------------------------------------------------------------
LK_DATE = LookupSpec(dim="dim_date", key="date_key", on=(("_date_key", "date_key"),))
LK_SERVICE_TYPE = LookupSpec(dim="dim_service_type", key="service_type_key",
                             on=(("_service_type", "service_type_name"),))


def _lk_scd2(dim: str, key: str, fact_col: str, id_col: str, current: bool, required: bool = True) -> LookupSpec:
    return LookupSpec(dim=dim, key=key, on=((fact_col, id_col),), current_only=current, required=required)


def fact_accidents(accidents: DataFrame, dims: Mapping[str, DataFrame], cut=None) -> tuple[DataFrame, DataFrame]:
    """five lookups (date by start hour; location, weather, daylight null-safe; road features by mask);
    ``duration_minutes`` from start/end; id, date and location required."""
    src = accidents.select(
        F.col("ID").alias("original_accident_id"),
        date_hour_key(F.to_date("Start_Time"), F.hour("Start_Time")).alias("_date_key"),
        F.round(F.col("Start_Lat"), 6).cast("decimal(9,6)").alias("_lat"),
        F.round(F.col("Start_Lng"), 6).cast("decimal(9,6)").alias("_lng"),
        clean_text("City", upper=True).alias("_city"), clean_text("State", upper=True).alias("_state"),
        clean_text("Weather_Condition").alias("_wc"), F.col("Temperature_F").cast("decimal(5,2)").alias("_tf"),
        F.col("Wind_Speed_mph").cast("decimal(6,2)").alias("_ws"),
        F.col("Visibility_mi").cast("decimal(5,2)").alias("_vis"),
        flags_mask(list(ROAD_FLAGS)).alias("_rf"),
        *[clean_text(s).alias(f"_{t}") for s, t in zip(DAYLIGHT, DAYLIGHT_COLUMNS)],
        F.col("Severity").alias("severity"), F.col("Distance_mi").cast("decimal(10,2)").alias("distance_mi"),
        duration_minutes("Start_Time", "End_Time").alias("duration_minutes"),
        F.col("Description").alias("description"), F.col("Source").alias("source_system"),
    )
    lookups = [
        LK_DATE,
        LookupSpec(dim="dim_location", key="location_key", null_safe=True,
                   on=(("_lat", "latitude"), ("_lng", "longitude"), ("_city", "city"), ("_state", "state"))),
        LookupSpec(dim="dim_weather", key="weather_key", null_safe=True, required=False,
                   on=(("_wc", "weather_condition"), ("_tf", "temperature_f"), ("_ws", "wind_speed_mph"),
                       ("_vis", "visibility_mi"))),
        LookupSpec(dim="dim_road_features", key="road_features_key", on=(("_rf", "road_features_key"),),
                   bounded=True, required=False),
        LookupSpec(dim="dim_daylight", key="daylight_key", null_safe=True, required=False,
                   on=tuple((f"_{t}", t) for t in DAYLIGHT_COLUMNS)),
    ]
    return FX.build_facts(
        src, dims, lookups,
        measures=[F.col(c) for c in ("severity", "distance_mi", "duration_minutes", "description", "source_system")],
        required=["original_accident_id", "date_key", "location_key"],
        carry=["original_accident_id"], key=("fact_accident_key", "original_accident_id"), cut=cut,
    )


def _appointment_src(appts: DataFrame) -> DataFrame:
    return appts.select(
        "original_appointment_id", "customer_id", "vehicle_id", "technician_id",
        date_hour_key(F.col("appointment_date"), hour_of_time("appointment_time")).alias("_date_key"),
        strip("service_type").alias("_service_type"),
        *[F.col(c) for c in ("total_labor_hours", "total_parts_cost", "total_service_cost")],
    )


def fact_service_appointments(appts: DataFrame, dims: Mapping[str, DataFrame], current_only: bool = False,
                              zero_fill: bool = True, cut=None) -> tuple[DataFrame, DataFrame]:
    """Date, customer, vehicle, employee (optional), service type; measures NULL -> 0."""
    src = _appointment_src(appts)
    lookups = [
        LK_DATE,
        _lk_scd2("dim_customer", "customer_key", "customer_id", "original_customer_id", current_only),
        _lk_scd2("dim_vehicle", "vehicle_key", "vehicle_id", "original_vehicle_id", current_only),
        _lk_scd2("dim_employee", "employee_key", "technician_id", "original_employee_id", current_only,
                 required=False),
        LK_SERVICE_TYPE,
    ]
    zero = F.lit(0).cast("decimal(10,2)")
    measures = [
        (F.coalesce(F.col(c), zero) if zero_fill else F.col(c)).cast("decimal(10,2)").alias(c)
        for c in ("total_labor_hours", "total_parts_cost", "total_service_cost")
    ]
    return FX.build_facts(src, dims, lookups, measures=measures, carry=["original_appointment_id"],
                          key=("fact_service_appointment_key", "original_appointment_id"), cut=cut,
                          required=["original_appointment_id", "date_key", "customer_key", "vehicle_key",
                                    "service_type_key"])


def fact_service_parts_usage(details: DataFrame, appts: DataFrame, dims: Mapping[str, DataFrame],
                             current_only: bool = False, cut=None) -> tuple[DataFrame, DataFrame]:
    """Details with a part, attached to their appointment (date, vehicle); lookups date, vehicle,
    part; ``total_cost_for_part_line = qty * unit cost``. Details without an appointment are rejects too.

    Date and vehicle are looked up for appointments, of which there are fewer, before details are attached; orphans go
    along with the details, so that facts and rejects come from one pass."""
    d = details.filter(F.col("part_id").isNotNull()).select(
        "original_service_detail_id", F.col("appointment_id").alias("original_appointment_id"), "part_id",
        "quantity_used", "unit_cost_at_time_of_service")
    parent = FX.apply_lookups(appts.select(
        F.col("original_appointment_id").alias("_appointment"), F.col("vehicle_id").alias("_vehicle_id"),
        date_hour_key(F.col("appointment_date"), hour_of_time("appointment_time")).alias("_date_key"),
    ), dims, [LK_DATE, _lk_scd2("dim_vehicle", "vehicle_key", "_vehicle_id", "original_vehicle_id", current_only)])
    src = FX.with_parent(d, parent, ("original_appointment_id", "_appointment"), ["date_key", "vehicle_key"])
    src = src.withColumn("_orphan", F.col("__parent_id").isNull()).drop("__parent_id")
    zero = F.lit(0).cast("decimal(10,2)")
    facts, rejects = FX.build_facts(
        src, dims, [_lk_scd2("dim_part", "part_key", "part_id", "original_part_id", current_only)],
        measures=[
            F.coalesce(F.col("quantity_used"), F.lit(0)).cast("int").alias("quantity_used"),
            F.coalesce(F.col("unit_cost_at_time_of_service"), zero).cast("decimal(10,2)").alias("unit_cost_at_time_of_service"),
            line_amount("quantity_used", "unit_cost_at_time_of_service").alias("total_cost_for_part_line"),
        ],
        carry=["original_service_detail_id", "original_appointment_id", "date_key", "vehicle_key"],
        key=("fact_service_parts_usage_key", "original_service_detail_id"), cut=cut, orphan=("_orphan", "missing_parent"),
        required=["original_service_detail_id", "original_appointment_id", "date_key", "vehicle_key", "part_key"],
    )
    return facts, rejects.select("original_service_detail_id", "original_appointment_id", FX.REJECT_REASON)


def window_rows(archive: DataFrame, last_run, run_ts, open_only: bool = True, after: bool = False) -> DataFrame:
    """Archive versions with ``valid_from`` in the closed window ``[last_run, run_ts]`` (incremental facts), or, with
    ``after``, in ``(last_run, run_ts]``: what has changed since."""
    vf = F.col(A.VALID_FROM)
    a = A.open_versions(archive) if open_only else archive
    return a.filter(((vf > ts_lit(last_run)) if after else (vf >= ts_lit(last_run))) & (vf <= ts_lit(run_ts)))


def fact_candidates(archive: DataFrame, last_run, run_ts, previous_rejects: DataFrame | None, id_col: str,
                    on_update: str = "ignore") -> DataFrame:
    """The open versions that a run tries to make facts of: those of its window and those rejected before. With
    ``previous_rejects`` (all that the last run rejected), a version opened at ``last_run`` itself counts if its id was
    rejected: any other was made a fact by the last run, which tried it, so the history isn't looked up again."""
    opened = A.open_versions(archive)
    if on_update == "replace" or previous_rejects is None:
        w = window_rows(archive, last_run, run_ts, after=on_update == "replace")
    else:
        edge = opened.filter(F.col(A.VALID_FROM) == ts_lit(last_run))
        w = window_rows(archive, last_run, run_ts, after=True).unionByName(semi_join(edge, previous_rejects, [id_col]))
    return FX.replay_rejects(w, opened, previous_rejects, id_col)


def fact_service_appointments_incremental(appts_archive: DataFrame, existing_facts: DataFrame,
                                          dims: Mapping[str, DataFrame], last_run, run_ts,
                                          previous_rejects: DataFrame | None = None, cut=None,
                                          on_update: str = "ignore"):
    """new open appointment versions of the window and those rejected before, against current dimension rows.
    ``on_update="ignore"``: insert-only, ids that are in the fact stay as they are; ``"replace"``: changed
    appointments (cancelled, re-priced) come again, for ``facts.upsert_facts``."""
    w = fact_candidates(appts_archive, last_run, run_ts, previous_rejects, "original_appointment_id", on_update)
    w = cut(w) if cut else w  # few rows, read several times
    if on_update == "ignore":
        w = FX.new_facts_only(w, existing_facts, ["original_appointment_id"])
    return fact_service_appointments(w, dims, current_only=True, cut=cut)


def fact_service_parts_usage_incremental(details_archive: DataFrame, appts_archive: DataFrame,
                                         existing_facts: DataFrame, dims: Mapping[str, DataFrame], last_run,
                                         run_ts, previous_rejects: DataFrame | None = None, cut=None,
                                         on_update: str = "ignore"):
    """new open detail versions of the window with a part and those rejected before, against open appointments
    and current dims (``on_update`` as for F4)."""
    w = fact_candidates(details_archive.filter(F.col("part_id").isNotNull()), last_run, run_ts, previous_rejects,
                        "original_service_detail_id", on_update)
    w = cut(w) if cut else w
    if on_update == "ignore":
        w = FX.new_facts_only(w, existing_facts, ["original_service_detail_id"])
    return fact_service_parts_usage(w, A.open_versions(appts_archive), dims, current_only=True, cut=cut)


__all__ = [n for n in dir() if not n.startswith("_")]
