"""Independent SQL formulations of the catalog queries (DuckDB dialect) over the driver tables.

They re-derive every stand-in source and warehouse rule from the raw tables with plain SQL (window functions
for first/last-wins, ``FULL JOIN`` for the diff, ``EXCEPT`` for null-safe set difference, md5 text for hashes),
so a match is evidence that the Spark operators implement the stated semantics.
"""

from __future__ import annotations

# Fixed values shared with starloom.functions.hashing / clean: whitespace class, separators, null token.
WS = "[ \\t\\n\\r\\f\\x0B]"
TOK = "(chr(30) || 'NULL')"
SEP = "chr(31)"
FAR = "TIMESTAMP '9999-12-31 23:59:59'"
T0, T1, T2 = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-11 00:00:00'", "TIMESTAMP '2024-01-21 00:00:00'"


# ----------------------------------------------------------------------------------------------- scalar helpers
def strip(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '^{WS}+|{WS}+$', '', 'g')"


def clean(x: str, upper: bool = False) -> str:
    v = strip(f"CASE WHEN CAST({x} AS VARCHAR) IN ('nan','NaN','NAN','None','NaT') THEN NULL ELSE CAST({x} AS VARCHAR) END")
    v = f"NULLIF({v}, '')"
    return f"upper({v})" if upper else v


def n_str(x):
    return strip(f"replace(CAST({x} AS VARCHAR), chr(13) || chr(10), chr(10))")


def n_dec(x):
    return f"CAST(TRY_CAST({x} AS DECIMAL(38,4)) AS VARCHAR)"


def n_exact(x):
    return f"CAST({x} AS VARCHAR)"


def n_int(x):
    return f"CAST({x} AS VARCHAR)"


def n_ts(x, exact=False):
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')" if exact else f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def n_date(x):
    return f"strftime({x}, '%Y-%m-%d')"


def canon(parts):
    return f"concat_ws({SEP}, " + ", ".join(f"coalesce({p}, {TOK})" for p in parts) + ")"


def hkey(parts):
    return f"('0x' || substr(md5({canon(parts)}), 1, 15))::BIGINT"


def ts_out(x):
    return f"CASE WHEN {x} <> {FAR} THEN strftime({x}, '%Y-%m-%d %H:%M:%S.%f') END"


def date_out(x):
    return f"strftime({x}, '%Y-%m-%d')"


def hour_of(t):
    return f"coalesce(hour(try_strptime({t}, '%H:%M:%S')), 0)"


def hms(t):
    return f"strftime(try_strptime({t}, '%H:%M:%S'), '%H:%M:%S')"


def date_key(d, h):
    return f"(year({d}) * 1000000 + month({d}) * 10000 + day({d}) * 100 + {h})::BIGINT"


def calendar_cols(d="d", h="h"):
    return (f"{date_key(d, h)} AS date_key, {date_out(d)} AS full_date, year({d})::BIGINT AS year, "
            f"month({d})::BIGINT AS month, monthname({d}) AS month_name, day({d})::BIGINT AS day, "
            f"dayname({d}) AS day_of_week, quarter({d})::BIGINT AS quarter, {h}::BIGINT AS hour")


# ------------------------------------------------------------------------------------------------ source CTEs
GEO = "geo AS (SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"


def cust_base(day: int) -> str:
    if day == 0:
        return "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer"
    b = ("SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 20 = 3 THEN 'CHANGED' ELSE c_mktsegment END "
         "AS c_mktsegment FROM customer UNION ALL SELECT c_custkey + 1099511627776, c_name, c_nationkey, c_mktsegment "
         "FROM customer WHERE c_custkey % 100 = 1")
    if day == 1:
        b = f"SELECT * FROM ({b}) WHERE c_custkey % 50 <> 7"
    return b


def customers(name: str, day: int) -> str:
    return (f"{name} AS (SELECT b.c_custkey AS customer_id, b.c_name AS first_name, b.c_mktsegment AS last_name, "
            "CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone_number, "
            "'ADDR ' || CAST(b.c_custkey AS VARCHAR) AS address, g.n_name AS city, g.r_name AS state, "
            "CAST(NULL AS VARCHAR) AS zip_code, CAST(NULL AS DATE) AS registration_date "
            f"FROM ({cust_base(day)}) b JOIN geo g ON b.c_nationkey = g.n_nationkey)")


CUST_HASH = canon([n_str("address"), n_str("city"), n_str("email"), n_str("first_name"), n_str("last_name"),
                   n_str("phone_number"), n_date("registration_date"), n_str("state"), n_str("zip_code")])


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def orders_base(day: int) -> str:
    if day == 0:
        return "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"
    return ("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 25 = 0 THEN 'CANCELLED' ELSE o_orderstatus END "
            "AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders UNION ALL "
            "SELECT o_orderkey + 1099511627776, o_custkey, o_orderstatus, o_totalprice, o_orderdate + INTERVAL 1 DAY + INTERVAL 9 HOUR, "
            "o_orderpriority || '-REPEAT' FROM orders WHERE o_orderkey % 40 = 1")


def appointments(name: str, day: int) -> str:
    t = "strftime(o_orderdate, '%-H:%M:%S')"
    return (f"{name} AS (SELECT o_orderkey AS appointment_id, o_custkey AS vehicle_id, o_custkey AS customer_id, "
            f"CAST(o_orderdate AS DATE) AS appointment_date, {hms(t)} AS appointment_time, "
            "o_orderpriority AS service_type, o_orderstatus AS status, "
            "CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 10 END AS technician_id, "
            "CAST(NULL AS DECIMAL(10,2)) AS total_labor_hours, CAST(NULL AS DECIMAL(10,2)) AS total_parts_cost, "
            "TRY_CAST(o_totalprice AS DECIMAL(10,2)) AS total_service_cost, o_orderdate AS created_at "
            f"FROM ({orders_base(day)}))")


APPT_HASH = canon([n_str("appointment_date_s"), n_str("appointment_time"), n_int("customer_id"),
                   n_str("service_type"), n_str("status"), n_int("technician_id"), n_dec("total_labor_hours"),
                   n_dec("total_parts_cost"), n_dec("total_service_cost"), n_int("vehicle_id")])

LI_ORDER = ("l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, "
            "l_shipdate")
LI_FIRST = "li AS (SELECT DISTINCT * FROM lineitem)"
DETAIL_ID = hkey([n_int("l_orderkey"), n_int("l_partkey"), n_int("l_suppkey"), n_int("l_linenumber"),
                  *(n_int(f"CAST(round({c} * 100) AS BIGINT)") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
                  n_str("l_returnflag"), n_str("l_linestatus"), n_date("l_shipdate")])
PART_NUMBER = "'PN' || CAST(p_partkey - CASE WHEN p_partkey % 20 = 19 THEN 1 ELSE 0 END AS VARCHAR)"
KEPT_PARTS = (f"kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {PART_NUMBER} ORDER BY p_partkey DESC) "
              "AS rn FROM part) WHERE rn = 1)")


def details(name: str, day: int) -> str:
    src = "SELECT * FROM li" if day == 0 else (
        "SELECT * FROM li UNION ALL SELECT * REPLACE (l_orderkey + 1099511627776 AS l_orderkey) FROM li "
        "WHERE l_orderkey % 40 = 1")
    return (f"{name} AS (SELECT {DETAIL_ID} AS service_detail_id, l_orderkey AS appointment_id, "
            "l_partkey AS part_id, CAST(l_quantity AS INTEGER) AS quantity_used, "
            "CASE WHEN CAST(l_quantity AS BIGINT) > 0 THEN CAST(CAST((CAST(round(l_extendedprice * 100) AS BIGINT) * 2 "
            "+ CAST(l_quantity AS BIGINT)) // (CAST(l_quantity AS BIGINT) * 2) AS DECIMAL(12,0)) * 0.01 AS DECIMAL(10,2)) END "
            "AS unit_cost, l_returnflag || l_linestatus AS task_description, l_shipdate AS created_at "
            f"FROM ({src}))")


def daylight(lo, hi):
    return f"CASE WHEN event_type <> 'error' THEN CASE WHEN hour(ts) BETWEEN {lo} AND {hi} THEN 'Day' ELSE 'Night' END END"


ACC = ("acc AS (SELECT CAST(event_id AS VARCHAR) AS ID, ts AS Start_Time, "
       "ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS End_Time, "
       "CAST(1 + hour(ts) // 6 AS INTEGER) AS Severity, "
       "TRY_CAST(value AS DECIMAL(9,6)) AS Start_Lat, TRY_CAST(-value AS DECIMAL(10,6)) AS Start_Lng, "
       "TRY_CAST(value AS DECIMAL(10,2)) AS Distance_mi, props AS Description, "
       "CAST(NULL AS VARCHAR) AS Street, 'CITY_' || CAST(user_id AS VARCHAR) AS City, "
       "CAST(NULL AS VARCHAR) AS County, event_type AS State, CAST(NULL AS VARCHAR) AS Zipcode, "
       "CAST(NULL AS VARCHAR) AS Country, "
       "CASE WHEN event_type <> 'error' THEN event_type END AS Weather_Condition, "
       "TRY_CAST(CASE WHEN round(value, 0) <> 0 THEN round(value, 0) END AS DECIMAL(5,2)) AS Temperature_F, "
       "CAST(NULL AS DECIMAL(6,2)) AS Wind_Speed_mph, CAST(NULL AS DECIMAL(5,2)) AS Visibility_mi, "
       "CAST(NULL AS DECIMAL(5,2)) AS Wind_Chill_F, CAST(NULL AS DECIMAL(5,2)) AS Humidity_pct, "
       "CAST(NULL AS DECIMAL(5,2)) AS Pressure_in, CAST(NULL AS VARCHAR) AS Wind_Direction, "
       "CAST(NULL AS DECIMAL(6,2)) AS Precipitation_in, "
       "CAST(NULL AS BOOLEAN) AS Amenity, (event_type = 'click') AS Bump, "
       "CASE WHEN value > 100 THEN TRUE END AS Crossing, (hour(ts) < 6) AS Give_Way, (event_type = 'view') AS Junction, "
       "CASE WHEN event_type = 'signup' THEN TRUE END AS No_Exit, "
       f"{daylight(6, 17)} AS Sunrise_Sunset, {daylight(5, 18)} AS Civil_Twilight, "
       f"{daylight(4, 19)} AS Nautical_Twilight, "
       f"CASE WHEN event_type = 'purchase' THEN {daylight(3, 20)} END AS Astronomical_Twilight FROM events)")

FLAGS = ["Amenity", "Bump", "Crossing", "Give_Way", "Junction", "No_Exit"]
FLAG_COLS = ["has_amenity", "has_bump", "has_crossing", "has_give_way", "has_junction", "has_no_exit",
             "has_railway", "has_roundabout", "has_station", "has_stop", "has_traffic_calming", "has_traffic_signal",
             "is_turning_loop"]


def flags_mask(alias=""):
    p = f"{alias}." if alias else ""
    terms = [f"CASE WHEN coalesce({p}{f}, FALSE) THEN {1 << i} ELSE 0 END" for i, f in enumerate(FLAGS)]
    return "(" + " + ".join(terms) + ")::BIGINT"


# ----------------------------------------------------------------------------------------------------- queries
SQL: dict[str, str] = {}

SQL["m2_service_trends"] = (
    "SELECT year(o_orderdate)::BIGINT AS year, month(o_orderdate)::BIGINT AS month, "
    "o_orderpriority AS service_type_name, count(*)::BIGINT AS appointments, "
    "CAST(sum(TRY_CAST(o_totalprice AS DECIMAL(10,2))) AS DOUBLE) AS total_cost "
    "FROM orders GROUP BY 1, 2, 3"
)

SQL["x_clean_strings"] = (
    "WITH j AS (SELECT c.*, chr(9) || ' ' || lower(n.n_name) || ' ' || chr(13) || chr(10) AS raw, "
    "CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'nan' ELSE c.c_mktsegment END AS seg "
    "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey) "
    f"SELECT c_custkey, {strip('raw')} AS stripped, {clean('raw', upper=True)} AS city_upper, "
    + strip("concat_ws(' ', c_name, c_mktsegment)") + " AS full_name, "
    "CASE WHEN seg IN ('nan','NaN','NAN','None','NaT') THEN NULL ELSE seg END AS segment, "
    "replace(c_name || chr(13) || chr(10) || c_mktsegment, chr(13) || chr(10), chr(10)) AS lf_text FROM j"
)

SQL["x_numeric_coerce"] = (
    "SELECT c_custkey, CAST(TRY_CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS balance, "
    "CAST(TRY_CAST(c_acctbal AS DECIMAL(5,2)) AS DOUBLE) AS balance_small, "
    "CAST(TRY_CAST(CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) || CASE WHEN c_acctbal < 0 THEN ' USD' ELSE '' END "
    "AS DECIMAL(12,2)) AS DOUBLE) AS balance_from_text FROM customer"
)

_T = "strftime(ts, '%-H:%M:%S')"
_RAW = f"CASE WHEN event_type = 'error' THEN '25:' || strftime(ts, '%M:%S') ELSE {_T} END"
SQL["x_time_of_day"] = f"SELECT event_id, {hour_of(_RAW)}::BIGINT AS hour, {hms(_RAW)} AS hms FROM events"

SQL["x_duration_minutes"] = (
    "WITH d AS (SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(round(value * 60000000) AS BIGINT) AS us "
    "FROM events) SELECT event_id, CAST(sign(us) * ((abs(us) + 300000) // 600000) AS DOUBLE) / 100 "
    "AS duration_minutes FROM d"
)

_LI_OUT = ("l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, l_quantity, l_extendedprice, "
           "l_discount, l_tax, l_returnflag, l_linestatus, " + ts_out("l_shipdate") + " AS l_shipdate")
SQL["r_dedupe_first"] = (
    f"SELECT {_LI_OUT} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    f"ORDER BY {LI_ORDER}) AS rn FROM lineitem) WHERE rn = 1"
)
SQL["r_dedupe_last"] = (
    f"SELECT {_LI_OUT} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    f"ORDER BY {', '.join(c + ' DESC' for c in LI_ORDER.split(', '))}) AS rn FROM lineitem) WHERE rn = 1"
)
SQL["r_dedupe_two_stage"] = (
    "SELECT p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size, p_retailprice FROM (SELECT *, "
    "row_number() OVER (PARTITION BY p_name ORDER BY p_partkey, p_brand, p_type, p_size, p_retailprice) AS rn "
    "FROM part) WHERE rn = 1"
)
SQL["r_latest_per_key"] = (
    f"SELECT o_custkey, o_orderkey, {ts_out('o_orderdate')} AS o_orderdate, o_totalprice FROM (SELECT *, "
    "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) AS rn "
    "FROM orders) WHERE rn = 1"
)
SQL["r_anti_join_nullsafe"] = (
    with_(ACC)
    + "SELECT weather_condition, CAST(temperature_f AS DOUBLE) AS temperature_f FROM ("
    "SELECT DISTINCT Weather_Condition AS weather_condition, Temperature_F AS temperature_f FROM acc EXCEPT "
    "SELECT DISTINCT Weather_Condition, Temperature_F FROM acc WHERE Start_Time < TIMESTAMP '2024-01-16 00:00:00')"
)
_WKEY = hkey([n_str(clean("Weather_Condition")), n_exact("Temperature_F"), n_exact("Wind_Speed_mph"),
              n_exact("Visibility_mi")])
SQL["r_left_join_nullsafe"] = (
    with_(ACC)
    + f"SELECT ID AS event_id, CASE WHEN {clean('Weather_Condition')} IS NULL AND Temperature_F IS NULL THEN NULL "
    f"ELSE {_WKEY} END AS weather_key FROM acc"
)

# --------------------------------------------------------------------------------------- archive + diff
SQL["a1_archive_accidents"] = (
    with_(ACC)
    + f"SELECT ID, Severity::BIGINT AS Severity, {ts_out('Start_Time')} AS Start_Time, {ts_out('End_Time')} AS End_Time, "
    "CAST(Start_Lat AS DOUBLE) AS Start_Lat, CAST(Start_Lng AS DOUBLE) AS Start_Lng, "
    "CAST(Distance_mi AS DOUBLE) AS Distance_mi, City, State, Weather_Condition, "
    "CAST(Temperature_F AS DOUBLE) AS Temperature_F, Bump, Sunrise_Sunset, "
    f"{ts_out(T0)} AS load_timestamp, CAST(NULL AS VARCHAR) AS valid_to_timestamp FROM acc"
)
SQL["a2_archive_initial"] = (
    with_(GEO, customers("c0", 0))
    + f"SELECT customer_id AS original_customer_id, first_name, last_name, address, city, state, "
    f"{ts_out(T0)} AS load_timestamp, {ts_out(T0)} AS valid_from_timestamp, "
    "CAST(NULL AS VARCHAR) AS valid_to_timestamp FROM c0"
)
SQL["a6_archive_appointments"] = (
    with_(appointments("a0", 0))
    + f"SELECT appointment_id AS original_appointment_id, customer_id, {date_out('appointment_date')} AS appointment_date, "
    "appointment_time, service_type, status, technician_id::BIGINT AS technician_id, "
    f"CAST(total_service_cost AS DOUBLE) AS total_service_cost, {ts_out('created_at')} AS source_created_at FROM a0"
)
SQL["a8_change_hash"] = (
    with_(GEO, customers("c0", 0))
    + f"SELECT customer_id AS original_customer_id, md5({CUST_HASH}) AS change_hash FROM c0"
)

_DIFF = (
    with_(GEO, customers("c0", 0), customers("c1", 1),
          f"d AS (SELECT coalesce(s.customer_id, a.customer_id) AS original_customer_id, "
          "CASE WHEN a.customer_id IS NULL THEN 'I' WHEN s.customer_id IS NULL THEN 'D' "
          "WHEN s.h <> a.h THEN 'U' ELSE 'N' END AS op, s.first_name AS s_first, s.last_name AS s_last, "
          "a.first_name AS a_first, a.last_name AS a_last "
          f"FROM (SELECT *, md5({CUST_HASH}) AS h FROM c1) s FULL JOIN (SELECT *, md5({CUST_HASH}) AS h FROM c0) a "
          "ON s.customer_id = a.customer_id)")
)
SQL["a9_snapshot_diff"] = _DIFF + "SELECT original_customer_id, op FROM d"
SQL["a9_digest_diff"] = SQL["a9_snapshot_diff"]
SQL["a10_closed_versions"] = (
    _DIFF + f"SELECT original_customer_id, a_first AS first_name, a_last AS last_name, "
    f"{ts_out(T0)} AS valid_from_timestamp, {ts_out(T1 + ' - INTERVAL 1 MICROSECOND')} AS valid_to_timestamp "
    "FROM d WHERE op IN ('U', 'D')"
)
SQL["a11_open_versions"] = (
    _DIFF + f"SELECT original_customer_id, a_first AS first_name, a_last AS last_name, {ts_out(T0)} AS load_timestamp, "
    f"{ts_out(T0)} AS valid_from_timestamp, CAST(NULL AS VARCHAR) AS valid_to_timestamp FROM d WHERE op = 'N' "
    f"UNION ALL SELECT original_customer_id, s_first, s_last, {ts_out(T1)}, {ts_out(T1)}, CAST(NULL AS VARCHAR) "
    "FROM d WHERE op IN ('I', 'U')"
)
SQL["a12_change_counts"] = (
    _DIFF + "SELECT o.op, count(d.op)::BIGINT AS n FROM (VALUES ('I'), ('U'), ('D'), ('N')) o(op) "
    "LEFT JOIN d ON d.op = o.op GROUP BY o.op"
)
SQL["a13_appointment_changes"] = (
    with_(appointments("a0", 0), appointments("a1", 1),
          "d AS (SELECT CASE WHEN a.appointment_id IS NULL THEN 'I' WHEN s.appointment_id IS NULL THEN 'D' "
          "WHEN s.h <> a.h THEN 'U' ELSE 'N' END AS op "
          f"FROM (SELECT *, md5({APPT_HASH}) AS h FROM (SELECT *, {date_out('appointment_date')} AS appointment_date_s FROM a1)) s "
          f"FULL JOIN (SELECT *, md5({APPT_HASH}) AS h FROM (SELECT *, {date_out('appointment_date')} AS appointment_date_s FROM a0)) a "
          "ON s.appointment_id = a.appointment_id)")
    + "SELECT o.op, count(d.op)::BIGINT AS n FROM (VALUES ('I'), ('U'), ('D'), ('N')) o(op) "
    "LEFT JOIN d ON d.op = o.op GROUP BY o.op"
)

# ------------------------------------------------------------------------------------------------- dimensions
EMP = ("e0 AS (SELECT s_suppkey AS employee_id, s_name AS first_name, CAST(NULL AS VARCHAR) AS last_name, "
       "'Technician' AS role, CAST(NULL AS DATE) AS hire_date FROM supplier)")
_PTS0 = ("pts0 AS (SELECT CAST(Start_Time AS DATE) AS d, hour(Start_Time) AS h FROM acc UNION "
         "SELECT CAST(End_Time AS DATE), hour(End_Time) FROM acc UNION "
         f"SELECT appointment_date, {hour_of('appointment_time')} FROM a0)")
SQL["d1_dim_date"] = with_(ACC, appointments("a0", 0), _PTS0) + f"SELECT {calendar_cols()} FROM pts0"

_LOC = (
    "locrows AS (SELECT CAST(round(Start_Lat, 6) AS DECIMAL(9,6)) AS latitude, "
    "CAST(round(Start_Lng, 6) AS DECIMAL(9,6)) AS longitude, "
    f"{clean('City', True)} AS city, {clean('State', True)} AS state, {clean('Street')} AS street, "
    f"{clean('County')} AS county, {clean('Zipcode')} AS zip_code, coalesce({clean('Country')}, 'US') AS country, "
    "0 AS r, ID AS o FROM acc UNION ALL "
    f"SELECT NULL, NULL, {clean('city', True)}, {clean('state', True)}, {clean('address')}, NULL, "
    f"{clean('zip_code')}, 'US', 1, CAST(customer_id AS VARCHAR) FROM c0), "
    "loc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY latitude, longitude, city, state "
    "ORDER BY r, o) AS rn FROM locrows WHERE city IS NOT NULL AND state IS NOT NULL) WHERE rn = 1)"
)
_LOC_KEY = hkey([n_exact("latitude"), n_exact("longitude"), n_str("city"), n_str("state")])
SQL["d2_dim_location"] = (
    with_(GEO, customers("c0", 0), ACC, _LOC)
    + f"SELECT {_LOC_KEY} AS location_key, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, "
    "city, state, street, county, zip_code, country FROM loc"
)

_WEA = (
    f"wea AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY weather_condition, temperature_f, "
    "wind_speed_mph, visibility_mi ORDER BY o) AS rn FROM ("
    f"SELECT {clean('Weather_Condition')} AS weather_condition, Temperature_F AS temperature_f, "
    "Wind_Speed_mph AS wind_speed_mph, Visibility_mi AS visibility_mi, Wind_Chill_F AS wind_chill_f, "
    f"Humidity_pct AS humidity_percent, Pressure_in AS pressure_in, {clean('Wind_Direction')} AS wind_direction, "
    "Precipitation_in AS precipitation_in, ID AS o FROM acc) "
    "WHERE NOT (weather_condition IS NULL AND temperature_f IS NULL AND wind_speed_mph IS NULL "
    "AND visibility_mi IS NULL)) WHERE rn = 1)"
)
_WEA_KEY = hkey([n_str("weather_condition"), n_exact("temperature_f"), n_exact("wind_speed_mph"),
                 n_exact("visibility_mi")])
SQL["d3_dim_weather"] = (
    with_(ACC, _WEA)
    + f"SELECT {_WEA_KEY} AS weather_key, weather_condition, CAST(temperature_f AS DOUBLE) AS temperature_f, "
    "CAST(wind_speed_mph AS DOUBLE) AS wind_speed_mph, CAST(visibility_mi AS DOUBLE) AS visibility_mi, "
    "CAST(wind_chill_f AS DOUBLE) AS wind_chill_f, CAST(humidity_percent AS DOUBLE) AS humidity_percent, "
    "CAST(pressure_in AS DOUBLE) AS pressure_in, wind_direction, CAST(precipitation_in AS DOUBLE) AS precipitation_in "
    "FROM wea"
)
_FLAG_SEL = ", ".join(
    [f"coalesce({f}, FALSE) AS {c}" for f, c in zip(FLAGS, FLAG_COLS)] + [f"FALSE AS {c}" for c in FLAG_COLS[len(FLAGS):]])
SQL["d4_dim_flags"] = with_(ACC) + f"SELECT DISTINCT {flags_mask()} AS road_features_key, {_FLAG_SEL} FROM acc"

_DAY_COLS = ["sunrise_sunset", "civil_twilight", "nautical_twilight", "astronomical_twilight"]
_DAY = ("day AS (SELECT DISTINCT * FROM (SELECT " + ", ".join(
    f"{clean(s)} AS {c}" for s, c in zip(["Sunrise_Sunset", "Civil_Twilight", "Nautical_Twilight", "Astronomical_Twilight"],
                                         _DAY_COLS)) + " FROM acc) WHERE NOT (" + " AND ".join(f"{c} IS NULL" for c in _DAY_COLS) + "))")
_DAY_KEY = hkey([n_str(c) for c in _DAY_COLS])
SQL["d5_dim_daylight"] = with_(ACC, _DAY) + f"SELECT {_DAY_KEY} AS daylight_key, {', '.join(_DAY_COLS)} FROM day"


def scd_key(id_col: str, vf: str) -> str:
    return hkey([n_int(id_col), n_ts(vf, exact=True)])


def cust_dim_row(src: str, vf: str, vt: str, cur: str, id_col: str = "customer_id") -> str:
    return (f"SELECT {scd_key(id_col, vf)} AS customer_key, {id_col} AS original_customer_id, "
            + strip("concat_ws(' ', first_name, last_name)") + " AS customer_name, email, phone_number, address, city, "
            + f"state, zip_code, {date_out('registration_date')} AS registration_date, {ts_out(vf)} AS dim_valid_from, "
            f"{vt} AS dim_valid_to, {cur} AS is_current FROM {src}")


NULL_TS = "CAST(NULL AS VARCHAR)"
SQL["d6_dim_customer"] = with_(GEO, customers("c0", 0)) + cust_dim_row("c0", T0, NULL_TS, "TRUE")

VEH0 = ("v0 AS (SELECT customer_id AS vehicle_id, customer_id, 'VIN' || CAST(customer_id AS VARCHAR) AS VIN, "
        "last_name AS make FROM c0)")
SQL["d7_dim_vehicle"] = (
    with_(GEO, customers("c0", 0), VEH0)
    + f"SELECT {scd_key('vehicle_id', T0)} AS vehicle_key, vehicle_id AS original_vehicle_id, VIN, make, "
    "CAST(NULL AS VARCHAR) AS model, CAST(NULL AS BIGINT) AS year, CAST(NULL AS VARCHAR) AS fuel_type, "
    f"CAST(NULL AS VARCHAR) AS transmission_type, {ts_out(T0)} AS dim_valid_from, {NULL_TS} AS dim_valid_to, "
    "TRUE AS is_current FROM v0"
)
SQL["d8_dim_employee"] = (
    with_(EMP)
    + f"SELECT {scd_key('employee_id', T0)} AS employee_key, employee_id AS original_employee_id, "
    + strip("concat_ws(' ', first_name, last_name)") + " AS employee_name, role, "
    f"{date_out('hire_date')} AS hire_date, {ts_out(T0)} AS dim_valid_from, {NULL_TS} AS dim_valid_to, "
    "TRUE AS is_current FROM e0"
)


def part_dim() -> str:
    return (f"WITH {KEPT_PARTS} SELECT {scd_key('p_partkey', T0)} AS part_key, p_partkey AS original_part_id, p_brand AS part_name, "
            f"{PART_NUMBER} AS part_number, p_type AS category, {ts_out(T0)} AS dim_valid_from, {NULL_TS} AS dim_valid_to, "
            f"TRUE AS is_current FROM kept")


SQL["d9_dim_part"] = part_dim()
SQL["d10_dim_service_type"] = (
    with_(appointments("a0", 0))
    + f"SELECT DISTINCT {hkey([n_str(strip('service_type'))])} AS service_type_key, {strip('service_type')} "
    "AS service_type_name FROM a0"
)
SQL["k1_dense_key"] = "SELECT c_custkey AS original_customer_id, row_number() OVER (ORDER BY c_custkey) AS dense_key FROM customer"
SQL["k2_hash_key"] = f"SELECT c_custkey AS original_customer_id, {scd_key('c_custkey', T0)} AS hash_key FROM customer"

# ------------------------------------------------------------------------------------------------------ SCD-2
CLOSE_T1 = f"({T1} - INTERVAL 1 MICROSECOND)"
_CDIFF = (
    "cd AS (SELECT coalesce(s.customer_id, a.customer_id) AS id, CASE WHEN a.customer_id IS NULL THEN 'I' "
    "WHEN s.customer_id IS NULL THEN 'D' WHEN s.h <> a.h THEN 'U' ELSE 'N' END AS op "
    f"FROM (SELECT customer_id, md5({CUST_HASH}) AS h FROM c1) s FULL JOIN "
    f"(SELECT customer_id, md5({CUST_HASH}) AS h FROM c0) a ON s.customer_id = a.customer_id)"
)
_SCD_CTES = (GEO, customers("c0", 0), customers("c1", 1), _CDIFF,
             "c0x AS (SELECT c0.*, cd.op FROM c0 JOIN cd ON c0.customer_id = cd.id)",
             "c1x AS (SELECT c1.*, cd.op FROM c1 JOIN cd ON c1.customer_id = cd.id)")


def _close(cond: str) -> str:
    return f"CASE WHEN {cond} THEN {ts_out(CLOSE_T1)} END"


SQL["d11_scd2_apply"] = (
    with_(*_SCD_CTES)
    + cust_dim_row("c0x", T0, _close("op IN ('U','D')"), "op = 'N'") + " UNION ALL "
    + cust_dim_row("(SELECT * FROM c1x WHERE op IN ('I','U'))", T1, NULL_TS, "TRUE")
)
SQL["d11_scd2_delete"] = (
    with_(*_SCD_CTES)
    + cust_dim_row("c0x", T0, _close("op = 'U'"), "op <> 'U'") + " UNION ALL "
    + cust_dim_row("(SELECT * FROM c1x WHERE op IN ('I','U'))", T1, NULL_TS, "TRUE")
)
SQL["d11_scd2_track_subset"] = (
    with_(*_SCD_CTES)
    + cust_dim_row("c0x", T0, _close("op = 'D'"), "op <> 'D'") + " UNION ALL "
    + cust_dim_row("(SELECT * FROM c1x WHERE op = 'I')", T1, NULL_TS, "TRUE")
)
_TWO_RUNS = (
    with_(*_SCD_CTES, customers("c2", 2))
    + cust_dim_row("c0x", T0, _close("op IN ('U','D')"), "op = 'N'") + " UNION ALL "
    + cust_dim_row("(SELECT * FROM c1x WHERE op IN ('I','U'))", T1, NULL_TS, "TRUE") + " UNION ALL "
    + cust_dim_row("(SELECT * FROM c2 WHERE customer_id IN (SELECT id FROM cd WHERE op = 'D'))", T2, NULL_TS, "TRUE")
)
SQL["d11_scd2_two_runs"] = _TWO_RUNS
SQL["d11_scd2_rebuild"] = _TWO_RUNS

SQL["d16_dim_date_incr"] = (
    with_(ACC, appointments("a0", 0), appointments("a1", 1), _PTS0,
          f"new AS (SELECT appointment_date AS d, {hour_of('appointment_time')} AS h FROM a1 EXCEPT SELECT d, h FROM pts0)")
    + f"SELECT {calendar_cols()} FROM new"
)
SQL["d17_service_type_incr"] = (
    with_(appointments("a0", 0), appointments("a1", 1),
          f"new AS (SELECT {strip('service_type')} AS n FROM a1 EXCEPT SELECT {strip('service_type')} FROM a0)")
    + f"SELECT {hkey([n_str('n')])} AS service_type_key, n AS service_type_name FROM new"
)

# ------------------------------------------------------------------------------------------------------ facts
_ACC_LOC_KEY = hkey([n_exact("CAST(round(Start_Lat, 6) AS DECIMAL(9,6))"),
                     n_exact("CAST(round(Start_Lng, 6) AS DECIMAL(9,6))"),
                     n_str(clean("City", True)), n_str(clean("State", True))])
_ACC_WEA_NULL = (f"{clean('Weather_Condition')} IS NULL AND Temperature_F IS NULL AND Wind_Speed_mph IS NULL "
                 "AND Visibility_mi IS NULL")
_ACC_WEA_KEY = hkey([n_str(clean("Weather_Condition")), n_exact("Temperature_F"), n_exact("Wind_Speed_mph"),
                     n_exact("Visibility_mi")])
_ACC_DAY = [clean(s) for s in ["Sunrise_Sunset", "Civil_Twilight", "Nautical_Twilight", "Astronomical_Twilight"]]
_ACC_DAY_NULL = " AND ".join(f"{x} IS NULL" for x in _ACC_DAY)
_ACC_DAY_KEY = hkey([n_str(x) for x in _ACC_DAY])
_US = "datediff('microsecond', Start_Time, End_Time)"
F1 = (
    with_(ACC)
    + f"SELECT {hkey([n_str('ID')])} AS fact_accident_key, ID AS original_accident_id, {date_key('CAST(Start_Time AS DATE)', 'hour(Start_Time)')} AS date_key, "
    f"{_ACC_LOC_KEY} AS location_key, CASE WHEN {_ACC_WEA_NULL} THEN NULL ELSE {_ACC_WEA_KEY} END AS weather_key, "
    f"{flags_mask()} AS road_features_key, CASE WHEN {_ACC_DAY_NULL} THEN NULL ELSE {_ACC_DAY_KEY} END AS daylight_key, "
    "Severity::BIGINT AS severity, CAST(Distance_mi AS DOUBLE) AS distance_mi, "
    f"CAST(sign({_US}) * ((abs({_US}) + 300000) // 600000) AS DOUBLE) / 100 AS duration_minutes, "
    "Description AS description, Source_ AS source_system FROM (SELECT *, 'events' AS Source_ FROM acc)"
)
SQL["f1_fact_accidents"] = F1


def appt_fact(src: str, key_of_customer: str, key_of_vehicle: str) -> str:
    return (f"SELECT {hkey([n_int('appointment_id')])} AS fact_service_appointment_key, "
            f"appointment_id AS original_appointment_id, "
            f"{date_key('appointment_date', hour_of('appointment_time'))} AS date_key, "
            f"{key_of_customer} AS customer_key, {key_of_vehicle} AS vehicle_key, "
            f"CASE WHEN technician_id IS NOT NULL THEN {scd_key('technician_id', T0)} END AS employee_key, "
            f"{hkey([n_str(strip('service_type'))])} AS service_type_key, 0.0::DOUBLE AS total_labor_hours, "
            f"0.0::DOUBLE AS total_parts_cost, CAST(coalesce(total_service_cost, 0) AS DOUBLE) AS total_service_cost "
            f"FROM {src}")


F2 = with_(appointments("a0", 0)) + appt_fact("a0", scd_key("customer_id", T0), scd_key("vehicle_id", T0))
SQL["f2_fact_appointments"] = F2


def parts_fact(details_src: str, appts_src: str, vehicle_key: str, part_key: str) -> str:
    return (f"SELECT {hkey([n_int('d.service_detail_id')])} AS fact_service_parts_usage_key, "
            f"d.service_detail_id AS original_service_detail_id, d.appointment_id AS original_appointment_id, "
            f"{date_key('a.appointment_date', hour_of('a.appointment_time'))} AS date_key, {vehicle_key} AS vehicle_key, "
            f"{part_key} AS part_key, coalesce(d.quantity_used, 0)::BIGINT AS quantity_used, "
            "CAST(coalesce(d.unit_cost, 0) AS DOUBLE) AS unit_cost_at_time_of_service, "
            "CAST(coalesce(d.quantity_used, 0) * coalesce(d.unit_cost, 0) AS DOUBLE) AS total_cost_for_part_line "
            f"FROM {details_src} d JOIN {appts_src} a ON d.appointment_id = a.appointment_id "
            "WHERE d.part_id IN (SELECT p_partkey FROM kept)")


F3 = (with_(LI_FIRST, KEPT_PARTS, details("d0", 0), appointments("a0", 0))
      + parts_fact("d0", "a0", scd_key("a.vehicle_id", T0), scd_key("d.part_id", T0)))
SQL["f3_fact_parts_usage"] = F3

SQL["f_rejects"] = (
    with_(LI_FIRST, details("d0", 0), KEPT_PARTS)
    + "SELECT service_detail_id AS original_service_detail_id, appointment_id AS original_appointment_id, "
    "'missing_part_key' AS reject_reason FROM d0 WHERE part_id IS NOT NULL AND part_id NOT IN (SELECT p_partkey FROM kept)"
)

# Current surrogate key after the day-1 run: opened at T1 for new/updated ids, at T0 for unchanged ones, none
# for deleted ids (vehicles mirror customers, so the customer diff decides both).
_INC_CTES = (GEO, customers("c0", 0), customers("c1", 1), _CDIFF, appointments("a0", 0), appointments("a1", 1))


def cur_key(id_expr: str) -> str:
    return (f"CASE (SELECT op FROM cd WHERE cd.id = {id_expr}) WHEN 'N' THEN {scd_key(id_expr, T0)} "
            f"WHEN 'U' THEN {scd_key(id_expr, T1)} WHEN 'I' THEN {scd_key(id_expr, T1)} END")


_F4_ALL = (with_(*_INC_CTES, "na AS (SELECT * FROM a1 WHERE appointment_id NOT IN (SELECT appointment_id FROM a0))")
           + "SELECT * FROM (" + appt_fact("na", cur_key("na.customer_id"), cur_key("na.vehicle_id")) + ")")
SQL["f4_fact_appointments_incr"] = _F4_ALL + " WHERE customer_key IS NOT NULL AND vehicle_key IS NOT NULL"
SQL["f4_pruned_append"] = SQL["f4_fact_appointments_incr"]
_CHANGED_FACTS = (
    "SELECT * FROM (" + with_(*_INC_CTES, "ca AS (SELECT * FROM a1 EXCEPT SELECT * FROM a0)")
    + "SELECT * FROM (" + appt_fact("ca", cur_key("ca.customer_id"), cur_key("ca.vehicle_id"))
    + ") WHERE customer_key IS NOT NULL AND vehicle_key IS NOT NULL)"
)
SQL["f4_fact_appointments_replace"] = (
    f"WITH n AS ({_CHANGED_FACTS}) SELECT * FROM n UNION ALL SELECT * FROM ({F2}) "
    "WHERE original_appointment_id NOT IN (SELECT original_appointment_id FROM n)"
)
SQL["f_rejects_incr"] = (
    "SELECT fact_service_appointment_key, original_appointment_id, date_key, customer_key, vehicle_key, employee_key, "
    "service_type_key, total_labor_hours, total_parts_cost, total_service_cost, CASE WHEN customer_key IS NULL THEN "
    "'missing_customer_key' ELSE 'missing_vehicle_key' END AS reject_reason FROM (" + _F4_ALL
    + ") WHERE customer_key IS NULL OR vehicle_key IS NULL"
)
SQL["f5_fact_parts_incr"] = (
    with_(*_INC_CTES, LI_FIRST, KEPT_PARTS, details("d0", 0), details("d1", 1),
          "nd AS (SELECT * FROM d1 WHERE service_detail_id NOT IN (SELECT service_detail_id FROM d0))")
    + "SELECT * FROM (" + parts_fact("nd", "a1", cur_key("a.vehicle_id"), scd_key("d.part_id", T0))
    + ") WHERE vehicle_key IS NOT NULL"
)

# ----------------------------------------------------------------------------------------------------- quality
def _count(name: str, sql: str) -> str:
    return f"SELECT '{name}' AS \"table\", count(*)::BIGINT AS rows FROM ({sql})"


_ARCH_COUNTS = {
    "archive_customers": "SELECT * FROM customer",
    "archive_vehicles": "SELECT * FROM customer",
    "archive_employees": "SELECT * FROM supplier",
    "archive_parts_inventory": "SELECT * FROM part",
    "archive_service_appointments": "SELECT * FROM orders",
    "archive_service_details": with_(LI_FIRST) + "SELECT * FROM li",
    "archive_accidents_csv": "SELECT * FROM events",
}
_DIM_SQL = {
    "dim_date": "d1_dim_date", "dim_location": "d2_dim_location", "dim_weather": "d3_dim_weather",
    "dim_road_features": "d4_dim_flags", "dim_daylight": "d5_dim_daylight", "dim_customer": "d6_dim_customer",
    "dim_vehicle": "d7_dim_vehicle", "dim_employee": "d8_dim_employee", "dim_service_type": "d10_dim_service_type",
}
SQL["q1_row_counts"] = " UNION ALL ".join(
    [_count(k, v) for k, v in _ARCH_COUNTS.items()]
    + [_count(k, SQL[v]) for k, v in _DIM_SQL.items()]
    + [_count("dim_part", part_dim()), _count("fact_accidents", F1), _count("fact_service_appointments", F2),
       _count("fact_service_parts_usage", F3)]
)


def _nulls(table: str, sql: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL)::BIGINT AS nulls "
        f"FROM ({sql})" for c in cols)


SQL["q2_fk_nulls"] = " UNION ALL ".join([
    _nulls("fact_accidents", F1, ["original_accident_id", "date_key", "location_key", "weather_key",
                                  "road_features_key", "daylight_key"]),
    _nulls("fact_service_appointments", F2, ["original_appointment_id", "date_key", "customer_key", "vehicle_key",
                                             "employee_key", "service_type_key"]),
    _nulls("fact_service_parts_usage", F3, ["original_service_detail_id", "original_appointment_id", "date_key",
                                            "vehicle_key", "part_key"]),
])
SQL["q3_star_join"] = (
    f"SELECT 'fact_accidents' AS fact, (SELECT count(*) FROM ({F1}))::BIGINT AS fact_rows, "
    f"(SELECT count(*) FROM ({F1}) f JOIN ({SQL['d1_dim_date']}) d ON f.date_key = d.date_key "
    f"JOIN ({SQL['d2_dim_location']}) l ON f.location_key = l.location_key)::BIGINT AS joined_rows "
    f"UNION ALL SELECT 'fact_service_appointments', (SELECT count(*) FROM ({F2}))::BIGINT, "
    f"(SELECT count(*) FROM ({F2}) f JOIN ({SQL['d1_dim_date']}) d ON f.date_key = d.date_key "
    f"JOIN ({SQL['d6_dim_customer']}) c ON f.customer_key = c.customer_key "
    f"JOIN ({SQL['d7_dim_vehicle']}) v ON f.vehicle_key = v.vehicle_key "
    f"JOIN ({SQL['d10_dim_service_type']}) s ON f.service_type_key = s.service_type_key)::BIGINT"
)


def _uniq(table: str, sql: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return (f"SELECT '{table}' AS \"table\", '{','.join(keys)}' AS keys, count(*)::BIGINT AS duplicate_keys, "
            f"coalesce(sum(c - 1), 0)::BIGINT AS extra_rows FROM (SELECT count(*) AS c FROM ({sql}) GROUP BY {k} "
            "HAVING count(*) > 1)")


SQL["q4_uniqueness"] = " UNION ALL ".join([
    _uniq("dim_date", SQL["d1_dim_date"], ["full_date", "hour"]),
    _uniq("dim_location", SQL["d2_dim_location"], ["latitude", "longitude", "city", "state"]),
    _uniq("dim_weather", SQL["d3_dim_weather"], ["weather_condition", "temperature_f", "wind_speed_mph", "visibility_mi"]),
    _uniq("dim_road_features", SQL["d4_dim_flags"], FLAG_COLS),
    _uniq("dim_daylight", SQL["d5_dim_daylight"], _DAY_COLS),
    _uniq("dim_service_type", SQL["d10_dim_service_type"], ["service_type_name"]),
    _uniq("fact_service_appointments", F2, ["original_appointment_id"]),
    _uniq("fact_service_parts_usage", F3, ["original_service_detail_id"]),
    _uniq("dim_location", SQL["d2_dim_location"], ["location_key"]),
    _uniq("dim_weather", SQL["d3_dim_weather"], ["weather_key"]),
    _uniq("dim_customer", SQL["d6_dim_customer"], ["customer_key"]),
])
SQL["q5_load_accounting"] = (
    with_(LI_FIRST, details("d0", 0), KEPT_PARTS)
    + "SELECT 'fact_service_parts_usage' AS \"table\", count(*)::BIGINT AS candidates, "
    "count(*) FILTER (WHERE part_id IN (SELECT p_partkey FROM kept))::BIGINT AS loaded, "
    "count(*) FILTER (WHERE part_id NOT IN (SELECT p_partkey FROM kept))::BIGINT AS rejected "
    "FROM d0 WHERE part_id IS NOT NULL"
)
SQL["q6_scd2_invariants"] = (
    "WITH d AS (SELECT original_customer_id AS id, CAST(dim_valid_from AS TIMESTAMP) AS vf, "
    f"coalesce(CAST(dim_valid_to AS TIMESTAMP), {FAR}) AS vt, is_current FROM ({_TWO_RUNS})), "
    "w AS (SELECT *, lead(vf) OVER (PARTITION BY id ORDER BY vf) AS nxt FROM d), "
    "per AS (SELECT id, sum(is_current::INT) AS cur, sum((nxt IS NOT NULL AND vt >= nxt)::INT) AS ovl, "
    f"sum((vt = {FAR} AND NOT is_current)::INT) AS onc, sum((vt <> {FAR} AND is_current)::INT) AS cno FROM w GROUP BY id) "
    "SELECT count(*) FILTER (WHERE cur > 1)::BIGINT AS multi_current, coalesce(sum(ovl), 0)::BIGINT AS overlaps, "
    "coalesce(sum(onc), 0)::BIGINT AS open_not_current, coalesce(sum(cno), 0)::BIGINT AS current_not_open FROM per"
)
_LT = "TIMESTAMP '1900-01-01 00:00:00'"
SQL["p3_high_water_mark"] = (
    with_(GEO, customers("c0", 0), customers("c1", 1), _CDIFF, appointments("a0", 0), appointments("a1", 1),
          f"lc AS (SELECT max(CASE WHEN op IN ('I', 'U') THEN {T1} ELSE {T0} END) AS lt FROM cd), "
          f"la AS (SELECT max(lt) AS lt FROM (SELECT {T0} AS lt FROM a0 UNION ALL SELECT {T1} FROM "
          "(SELECT * FROM a1 EXCEPT SELECT * FROM a0)))")
    + f"SELECT {ts_out(f'greatest(coalesce(lc.lt, {_LT}), coalesce(la.lt, {_LT}))')} AS high_water_mark FROM lc, la"
)
SQL["q4_one_pass"] = SQL["q4_uniqueness"]

# ------------------------------------------------------------------------------------------------------- marts
SQL["m1_as_of_lookup"] = (
    f"WITH dh AS ({_TWO_RUNS}), dv AS (SELECT original_customer_id AS id, customer_key, "
    f"CAST(dim_valid_from AS TIMESTAMP) AS vf, coalesce(CAST(dim_valid_to AS TIMESTAMP), {FAR}) AS vt FROM dh) "
    "SELECT e.event_id, dv.customer_key FROM events e LEFT JOIN dv ON dv.id = e.user_id AND e.ts >= dv.vf AND e.ts <= dv.vt"
)
SQL["m1_as_of_sliced"] = SQL["m1_as_of_lookup"].replace(
    "FROM events e ", "FROM (SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id FROM events) e ")
SQL["m3_parts_usage"] = (
    f"SELECT p.p_type AS category, count(*)::BIGINT AS lines, sum(f.quantity_used)::BIGINT AS quantity, "
    f"CAST(sum(CAST(f.total_cost_for_part_line AS DECIMAL(18,2))) AS DOUBLE) AS cost FROM ({F3}) f "
    f"JOIN part p ON f.part_key = {scd_key('p.p_partkey', T0)} GROUP BY p.p_type"
)
SQL["m3_staff_performance"] = (
    "SELECT s.s_name AS employee_name, count(*)::BIGINT AS appointments, "
    "CAST(sum(TRY_CAST(o.o_totalprice AS DECIMAL(10,2))) AS DOUBLE) AS billed FROM orders o "
    "LEFT JOIN supplier s ON s.s_suppkey = CASE WHEN o.o_orderkey % 10 <> 0 THEN o.o_orderkey % 10 END "
    "GROUP BY s.s_name"
)
SQL["m4_drill_across"] = (
    with_(ACC)
    + "SELECT coalesce(a.d, b.d) AS full_date, coalesce(a.n, 0)::BIGINT AS accidents, coalesce(b.n, 0)::BIGINT AS appointments, "
    "CAST(coalesce(b.billed, 0) AS DOUBLE) AS billed FROM "
    "(SELECT strftime(CAST(Start_Time AS DATE), '%Y-%m-%d') AS d, count(*) AS n FROM acc GROUP BY 1) a FULL JOIN "
    "(SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS d, count(*) AS n, "
    "sum(TRY_CAST(o_totalprice AS DECIMAL(10,2))) AS billed FROM orders GROUP BY 1) b ON a.d = b.d"
)

# ------------------------------------------------------------------------------------------------- archives
SQL["a3_archive_vehicles"] = (
    with_(GEO, customers("c0", 0), VEH0)
    + f"SELECT vehicle_id AS original_vehicle_id, customer_id, VIN, make, {ts_out(T0)} AS load_timestamp, "
    f"{NULL_TS} AS valid_to_timestamp FROM v0"
)
SQL["a4_archive_employees"] = (
    "SELECT s_suppkey AS original_employee_id, s_name AS first_name, CAST(NULL AS VARCHAR) AS last_name, "
    f"'Technician' AS role, {ts_out(T0)} AS load_timestamp FROM supplier"
)
SQL["a5_archive_parts"] = (
    f"SELECT p_partkey AS original_part_id, p_brand AS part_name, {PART_NUMBER} AS part_number, p_type AS category, "
    "p_size::BIGINT AS current_stock_quantity, CAST(TRY_CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS unit_cost, "
    f"{ts_out(T0)} AS load_timestamp FROM part"
)
SQL["a7_archive_details"] = (
    with_(LI_FIRST, details("d0", 0))
    + "SELECT service_detail_id AS original_service_detail_id, appointment_id, part_id, "
    "quantity_used::BIGINT AS quantity_used, CAST(unit_cost AS DOUBLE) AS unit_cost_at_time_of_service, task_description, "
    f"{ts_out(T0)} AS load_timestamp FROM d0"
)

# ------------------------------------------------------------------------------------------------- sources, scalars
SQL["s2_csv_round_trip"] = (
    "SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars, CAST(NULL AS VARCHAR) AS absent FROM documents"
)
_CSV_QUOTED = "coalesce('\"' || replace(text, '\"', '\"\"') || '\"', '')"
SQL["s8_csv_quarantine"] = f"""
    SELECT doc_id, md5(nullif(text, '')) AS text_md5, nullif(lang, '') AS lang, FALSE AS broken FROM documents
    WHERE doc_id % 7 > 1 OR (doc_id % 7 = 1 AND lang IS NULL)
    UNION ALL
    SELECT doc_id, md5(doc_id || ',' || {_CSV_QUOTED} || CASE doc_id % 7 WHEN 0 THEN '' ELSE ',' || lang || ',one,"more"' END),
           NULL, TRUE FROM documents WHERE doc_id % 7 = 0 OR (doc_id % 7 = 1 AND lang IS NOT NULL)"""
SQL["s7_evolved_read"] = """
    SELECT o_orderkey AS order_id, CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS amount,
           strftime(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS placed,
           CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS status,
           CASE WHEN o_orderkey % 3 = 2 THEN o_custkey END AS customer,
           CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS priority FROM orders"""
SQL["s9_parameterised_sql"] = (
    "SELECT o_orderpriority AS service_type_name, count(*)::BIGINT AS appointments, "
    "CAST(sum(TRY_CAST(o_totalprice AS DECIMAL(10,2))) AS DOUBLE) AS billed FROM orders "
    "WHERE TRY_CAST(o_totalprice AS DECIMAL(10,2)) >= 1000 GROUP BY 1"
)
SQL["x9_timestamp_coerce"] = (
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') END AS at, "
    "CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS on_day FROM events"
)
SQL["x20_boolean_coerce"] = (
    "SELECT event_id, CASE event_type WHEN 'click' THEN TRUE WHEN 'error' THEN NULL ELSE FALSE END AS flag, "
    "event_type = 'click' AS flag_or_false FROM events"
)

# --------------------------------------------------------------------------------------------------- load runs
_TABLE_COLUMNS = {
    "archive_customers": ["original_customer_id", "first_name", "last_name", "address", "city", "state"],
    "archive_vehicles": ["original_vehicle_id", "customer_id", "VIN", "make"],
    "archive_employees": ["original_employee_id", "first_name", "role"],
    "archive_parts_inventory": ["original_part_id", "part_name", "part_number", "category", "unit_cost"],
    "archive_service_appointments": ["original_appointment_id", "customer_id", "appointment_date", "appointment_time",
                                     "service_type", "status", "technician_id", "total_service_cost"],
    "archive_service_details": ["original_service_detail_id", "appointment_id", "part_id", "quantity_used",
                                "unit_cost_at_time_of_service"],
    "archive_accidents_csv": ["ID", "Severity", "City", "State", "Weather_Condition", "Temperature_F", "Bump"],
    "dim_date": ["date_key", "day", "day_of_week", "full_date", "hour", "month", "month_name", "quarter", "year"],
    "dim_location": ["city", "country", "county", "latitude", "location_key", "longitude", "state", "street",
        "zip_code"],
    "dim_weather": ["humidity_percent", "precipitation_in", "pressure_in", "temperature_f", "visibility_mi",
        "weather_condition", "weather_key", "wind_chill_f", "wind_direction", "wind_speed_mph"],
    "dim_road_features": ["has_amenity", "has_bump", "has_crossing", "has_give_way", "has_junction", "has_no_exit",
        "has_railway", "has_roundabout", "has_station", "has_stop", "has_traffic_calming", "has_traffic_signal",
        "is_turning_loop", "road_features_key"],
    "dim_daylight": ["astronomical_twilight", "civil_twilight", "daylight_key", "nautical_twilight",
        "sunrise_sunset"],
    "dim_customer": ["address", "city", "customer_key", "customer_name", "dim_valid_from", "dim_valid_to", "email",
        "is_current", "original_customer_id", "phone_number", "registration_date", "state", "zip_code"],
    "dim_vehicle": ["VIN", "dim_valid_from", "dim_valid_to", "fuel_type", "is_current", "make", "model",
        "original_vehicle_id", "transmission_type", "vehicle_key", "year"],
    "dim_employee": ["dim_valid_from", "dim_valid_to", "employee_key", "employee_name", "hire_date", "is_current",
        "original_employee_id", "role"],
    "dim_part": ["category", "dim_valid_from", "dim_valid_to", "is_current", "original_part_id", "part_key",
        "part_name", "part_number"],
    "dim_service_type": ["service_type_key", "service_type_name"],
    "fact_accidents": ["date_key", "daylight_key", "description", "distance_mi", "duration_minutes",
        "fact_accident_key", "location_key", "original_accident_id", "road_features_key", "severity",
        "source_system", "weather_key"],
    "fact_service_appointments": ["customer_key", "date_key", "employee_key", "fact_service_appointment_key",
        "original_appointment_id", "service_type_key", "total_labor_hours", "total_parts_cost",
        "total_service_cost", "vehicle_key"],
    "fact_service_parts_usage": ["date_key", "fact_service_parts_usage_key", "original_appointment_id",
        "original_service_detail_id", "part_key", "quantity_used", "total_cost_for_part_line",
        "unit_cost_at_time_of_service", "vehicle_key"],
}
_DOUBLES = {"unit_cost", "total_service_cost", "unit_cost_at_time_of_service", "Temperature_F", "latitude", "longitude",
            "temperature_f", "wind_chill_f", "humidity_percent", "pressure_in", "visibility_mi", "wind_speed_mph",
            "precipitation_in", "distance_mi", "duration_minutes", "total_labor_hours", "total_parts_cost",
            "total_cost_for_part_line"}


def _digest(name: str, sql: str) -> str:
    """Row count and the order-free content hash of one table."""
    text = canon([f"CAST(CAST(round({c} * 1000000) AS BIGINT) AS VARCHAR)" if c in _DOUBLES else f"CAST({c} AS VARCHAR)"
                  for c in _TABLE_COLUMNS[name]])
    return (f"SELECT '{name}' AS \"table\", count(*)::BIGINT AS rows, "
            f"CAST(sum(('0x' || substr(md5({text}), 1, 15))::BIGINT) AS VARCHAR) AS content FROM ({sql})")


def _both(base: str, extra: str, columns: list[str]) -> str:
    cols = ", ".join(columns)
    return f"SELECT {cols} FROM ({base}) UNION ALL SELECT {cols} FROM ({extra})"


_ACC_ARCHIVE = with_(ACC) + "SELECT ID, Severity, City, State, Weather_Condition, Temperature_F, Bump FROM acc"
_DAY0 = {
    "archive_customers": with_(GEO, customers("c0", 0)) + "SELECT customer_id AS original_customer_id, * FROM c0",
    "archive_vehicles": SQL["a3_archive_vehicles"], "archive_employees": SQL["a4_archive_employees"],
    "archive_parts_inventory": SQL["a5_archive_parts"], "archive_service_appointments": SQL["a6_archive_appointments"],
    "archive_service_details": SQL["a7_archive_details"], "archive_accidents_csv": _ACC_ARCHIVE,
    "dim_date": SQL["d1_dim_date"], "dim_location": SQL["d2_dim_location"], "dim_weather": SQL["d3_dim_weather"],
    "dim_road_features": SQL["d4_dim_flags"], "dim_daylight": SQL["d5_dim_daylight"], "dim_customer": SQL["d6_dim_customer"],
    "dim_vehicle": SQL["d7_dim_vehicle"], "dim_employee": SQL["d8_dim_employee"], "dim_part": SQL["d9_dim_part"],
    "dim_service_type": SQL["d10_dim_service_type"], "fact_accidents": F1, "fact_service_appointments": F2,
    "fact_service_parts_usage": F3,
}
SQL["p1_full_load"] = SQL["p1_full_reload"] = " UNION ALL ".join(_digest(n, q) for n, q in _DAY0.items())

_VEHICLE_ROW = (
    "SELECT {key} AS vehicle_key, customer_id AS original_vehicle_id, 'VIN' || CAST(customer_id AS VARCHAR) AS VIN, "
    "last_name AS make, CAST(NULL AS VARCHAR) AS model, CAST(NULL AS BIGINT) AS year, CAST(NULL AS VARCHAR) AS fuel_type, "
    "CAST(NULL AS VARCHAR) AS transmission_type, {vf} AS dim_valid_from, {vt} AS dim_valid_to, {cur} AS is_current FROM {src}"
)
_VEHICLES1 = with_(*_SCD_CTES) + _VEHICLE_ROW.format(
    key=scd_key("customer_id", T0), vf=ts_out(T0), vt=_close("op IN ('U','D')"), cur="op = 'N'", src="c0x") + " UNION ALL " \
    + _VEHICLE_ROW.format(key=scd_key("customer_id", T1), vf=ts_out(T1), vt=NULL_TS, cur="TRUE",
                          src="(SELECT * FROM c1x WHERE op IN ('I','U'))")
_CHANGED = with_(*_SCD_CTES) + "SELECT {cols} FROM c1x WHERE op IN ('I', 'U')"
_EXTRA1 = {
    "archive_customers": _CHANGED.format(cols="customer_id AS original_customer_id, *"),
    "archive_vehicles": _CHANGED.format(cols="customer_id AS original_vehicle_id, customer_id, 'VIN' || "
                                             "CAST(customer_id AS VARCHAR) AS VIN, last_name AS make"),
    "archive_service_appointments": (
        with_(appointments("a0", 0), appointments("a1", 1)) + "SELECT appointment_id AS original_appointment_id, customer_id, "
        f"{date_out('appointment_date')} AS appointment_date, appointment_time, service_type, status, technician_id, "
        "total_service_cost FROM (SELECT * FROM a1 EXCEPT SELECT * FROM a0)"),
    "archive_service_details": (
        with_(LI_FIRST, details("d0", 0), details("d1", 1)) + "SELECT service_detail_id AS original_service_detail_id, "
        "appointment_id, part_id, quantity_used, unit_cost AS unit_cost_at_time_of_service FROM d1 "
        "WHERE service_detail_id NOT IN (SELECT service_detail_id FROM d0)"),
    "dim_date": SQL["d16_dim_date_incr"], "dim_service_type": SQL["d17_service_type_incr"],
    "fact_service_appointments": SQL["f4_fact_appointments_incr"], "fact_service_parts_usage": SQL["f5_fact_parts_incr"],
}
_DAY1 = {n: _both(q, _EXTRA1[n], _TABLE_COLUMNS[n]) if n in _EXTRA1 else q for n, q in _DAY0.items()}
_DAY1 |= {"dim_customer": SQL["d11_scd2_apply"], "dim_vehicle": _VEHICLES1}
SQL["p2_incremental_load"] = " UNION ALL ".join(_digest(n, q) for n, q in _DAY1.items())
SQL["s5_bucket_update"] = SQL["p2_resumed_run"] = SQL["p2_incremental_load"]
SQL["p6_late_extract"] = SQL["d11_scd2_two_runs"]
SQL["d11_scd2_late"] = SQL["d11_scd2_two_runs"]

# Customers deleted on day 1 are back on day 2 with a version opened then; so are their vehicles.
SQL["p4_reject_replay"] = (
    f"SELECT original_appointment_id, {scd_key('a.customer_id', T2)} AS customer_key, "
    f"{scd_key('a.vehicle_id', T2)} AS vehicle_key, date_key, 0::BIGINT AS still_rejected FROM ({SQL['f_rejects_incr']}) r "
    f"JOIN ({with_(appointments('a1', 1))} SELECT * FROM a1) a ON a.appointment_id = r.original_appointment_id"
)
