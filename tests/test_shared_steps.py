"""Steps that the load runs and the fact queries share: the diff, the details' fact, and the text functions under them."""

from datetime import datetime

from pyspark.sql import functions as F

from starloom.functions import clean as X
from starloom.functions.hashing import value_hash
from starloom.operators import archive as A
from starloom.plans import car_service as CS
from starloom.plans import catalog as C
from starloom.plans import stand_in as SI
from starloom.plans import state as ST
from tests.conftest import SF_SMALL

T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def _employees(spark, rows):
    return spark.createDataFrame(rows, "employee_id bigint, first_name string, last_name string, role string")


def _diff(spark):
    old = _employees(spark, [(1, "A", None, "r"), (2, "B", "b", "r"), (3, "C", "c", "r"), (4, "D\r\nd", "d", "r")])
    new = _employees(spark, [(1, "A", None, "r"), (2, "B", None, "r"), (4, " D\nd", "d", "r"), (5, "E", "e", "r")])
    return A.snapshot_diff(new, A.archive_initial(old, CS.EMPLOYEES, T0), CS.EMPLOYEES)


def test_diff_shuffles_no_hashes_and_still_compares_by_them(spark):
    diff = _diff(spark)
    shuffled = diff._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)[1]
    assert "md5" not in shuffled
    ops = {r["original_employee_id"]: r["op"] for r in diff.collect()}
    assert ops == {1: "N", 2: "U", 3: "D", 4: "N", 5: "I"}  # 4: the same but for line breaks and outer blanks


def test_written_diff_has_unchanged_rows_once(spark):
    diff, slim = _diff(spark), A.to_write(_diff(spark))
    assert slim.filter("op = 'N' and _src is not null").isEmpty() and not diff.filter("op = 'N' and _src is not null").isEmpty()
    for rows in (A.open_after, A.closed_versions, A.new_versions):
        assert sorted(map(str, rows(diff, T1).collect())) == sorted(map(str, rows(slim, T1).collect()))


def test_open_versions_come_from_one_pass_over_the_diff(spark):
    diff = _diff(spark)
    rows = A.open_after(diff, T1)
    assert "Union" not in rows._jdf.queryExecution().optimizedPlan().toString()
    two = diff.filter("op = 'N'").select("_arc.*").unionByName(A.new_versions(diff, T1))
    assert rows.columns == two.columns and rows.dtypes == two.dtypes
    assert sorted(map(str, rows.collect())) == sorted(map(str, two.collect())) and rows.count() == 4


def test_rejects_and_facts_of_details_read_the_details_once(spark):
    plan = C.QUERIES["f_rejects"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_linenumber#") and sum("Relation" in x and "l_linenumber#" in x for x in plan.splitlines()) == 1


def test_orphans_and_rejects_keep_their_reasons(spark):
    details = spark.createDataFrame(
        [(1, 10, 7), (2, 99, 7), (3, None, 7), (4, 10, 8), (5, 11, 7), (6, 12, 7), (7, 10, None), (None, 10, 7)],
        "original_service_detail_id bigint, appointment_id bigint, part_id bigint").withColumns({
            "quantity_used": F.lit(2), "unit_cost_at_time_of_service": F.lit("1.50").cast("decimal(10,2)")})
    appts = spark.sql("select * from values (10, 5, date'2024-01-01', '9:00:00'), (11, 6, date'2024-01-01', '09:00:00'), "
                      "(12, 5, cast(null as date), null) t(original_appointment_id, vehicle_id, appointment_date, appointment_time)")
    dims = {"dim_date": spark.sql("select 2024010109L as date_key"),
            "dim_vehicle": spark.sql("select 50L as vehicle_key, 5 as original_vehicle_id, true as is_current"),
            "dim_part": spark.sql("select 70L as part_key, 7L as original_part_id, true as is_current")}
    facts, rejects = CS.fact_service_parts_usage(details, appts, dims)
    assert facts.columns == ["fact_service_parts_usage_key", "original_service_detail_id", "original_appointment_id", "date_key",
                             "vehicle_key", "part_key", "quantity_used", "unit_cost_at_time_of_service", "total_cost_for_part_line"]
    assert [(r[1], r[2], r[3], r[4], r[5], r[6], str(r[8])) for r in facts.collect()] == [(1, 10, 2024010109, 50, 70, 2, "3.00")]
    assert {(r[0], r[1], r[2]) for r in rejects.collect()} == {
        (2, 99, "missing_parent"), (3, None, "missing_parent"), (4, 10, "missing_part_key"), (5, 11, "missing_vehicle_key"),
        (6, 12, "missing_date_key"), (None, 10, "missing_original_service_detail_id")}


def test_plain_times_and_blanks_as_by_parser_and_pattern(spark):
    times = ["9:05:03", "09:05:03", "23:59:59", "24:00:00", "9:5:3", "9:05:60", "x", "", None, "9:05:03\n", " 9:05:03", "00:00:00"]
    parsed = X.parse_time_of_day("t")
    df = spark.createDataFrame([(t,) for t in times], "t string").select(
        "t", X.hour_of_time("t").alias("h"), X.time_to_hms("t").alias("s"), F.coalesce(F.hour(parsed), F.lit(0)).alias("h0"),
        F.date_format(parsed, "HH:mm:ss").alias("s0"))
    assert [(r.h, r.s) for r in df.collect()] == [(r.h0, r.s0) for r in df.collect()]
    texts = [" a ", "\t\r\n a ", "a  ", "a  \n", "a \x85", " a ", "", "  ", None, "a\x0b\f", "a b", "  "]
    pattern = f"^{X.WHITESPACE_CLASS}+|{X.WHITESPACE_CLASS}+$"
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        X.strip("t").alias("a"), F.regexp_replace("t", pattern, "").alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]


def test_tables_are_written_together(spark):
    wh = ST.initial_warehouse(spark, SF_SMALL, share=True)
    ST.write_together(wh, ["archive_employees"], ["dim_employee"])
    assert dict.keys(wh.archives) >= {"archive_employees"} and dict.keys(wh.dims) == {"dim_employee"}


def test_a_run_tries_new_versions_and_earlier_rejects_only(spark):
    far = "timestamp_ntz'9999-12-31 23:59:59'"
    at = lambda t: f"timestamp_ntz'{t:%Y-%m-%d} 00:00:00'"
    archive = spark.sql(f"""select * from values (1, 'a', {at(T0)}), (2, 'a', {at(T0)}), (2, 'b', {at(T1)}), (3, 'a', {at(T0)}),
        (4, 'a', {at(T1)}), (5, 'a', timestamp_ntz'2023-01-01'), (6, 'a', timestamp_ntz'2023-01-01')
        t(id, v, valid_from_timestamp)""").withColumn("valid_to_timestamp", F.expr(far))
    rejects = spark.createDataFrame([(2,), (3,), (5,)], "id int")
    tried = CS.fact_candidates(archive, T0, T1, rejects, "id")
    assert sorted((r["id"], r["v"]) for r in tried.collect()) == [(2, "a"), (2, "b"), (3, "a"), (4, "a"), (5, "a")]  # 1 is a fact
    whole = CS.fact_candidates(archive, T0, T1, None, "id")
    assert sorted((r["id"], r["v"]) for r in whole.collect()) == [(1, "a"), (2, "a"), (2, "b"), (3, "a"), (4, "a")]


def test_digest_diff_reads_its_source_once(spark):
    old = _employees(spark, [(1, "A", None, "r"), (2, "B", "b", "r")])
    kept = A.archive_initial(old, CS.EMPLOYEES, T0)
    cuts = []
    entry = {"of": 4, "schema": kept.schema.jsonValue(), "buckets": {}, "digests": {}}
    diff, found = A.digest_diff(old, entry, CS.EMPLOYEES, lambda d: cuts.append(d) or d.filter("original_employee_id = 1"))
    assert len(cuts) == 1 and diff.count() == 1 and len(found) == 1  # both the digests and the join read what was cut


def test_details_of_all_days_are_those_of_each_day(spark, tmp_path):
    rows = [(k, p, 1, n, q, 10.5 * (n + 1), 0.1, 0.0, "N", "O") for n, (k, p, q) in enumerate(
        [(1, 5, 3.0), (41, 5, 3.0), (2, 6, 0.0), (None, 7, 2.0), (40, 8, None), (81, None, 7.0)])]
    li = spark.createDataFrame(rows + rows[:2], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                               "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string")
    li.withColumn("l_shipdate", F.expr("timestamp_ntz'1995-01-02 00:00:00'")).write.parquet(f"{tmp_path}/lineitem.parquet")
    lines = SI.detail_lines(spark, str(tmp_path))
    for day, n in ((0, 6), (1, 9), (2, 9)):
        one, shared = SI.details(spark, str(tmp_path), day), SI.details(spark, str(tmp_path), day, lines)
        assert one.schema == shared.schema and sorted(map(str, one.collect())) == sorted(map(str, shared.collect()))
        assert shared.count() == n


def test_value_hash_tells_nulls_and_places(spark):
    rows = [("a", None), (None, "a"), ("a", ""), ("", "a"), (None, None), ("a", "a")]
    df = spark.createDataFrame(rows, "x string, y string").select(value_hash(["x", "y"]).alias("h"), value_hash(["y", "x"]).alias("k"))
    got = df.collect()
    assert len({r["h"] for r in got}) == len(rows) and all(r["h"] == r["k"] for r in got)


def test_candidates_are_cut_before_they_are_looked_up(spark):
    appts = spark.sql(f"""select 1L as original_appointment_id, 5L as customer_id, 5L as vehicle_id, 1L as technician_id, date'2024-01-01' as appointment_date,
        '9:00:00' as appointment_time, 's' as service_type, 1.0BD as total_labor_hours, 1.0BD as total_parts_cost, 1.0BD as total_service_cost,
        timestamp_ntz'{T1}' as valid_from_timestamp, timestamp_ntz'9999-12-31 23:59:59' as valid_to_timestamp""")
    dims = {"dim_date": spark.sql("select 2024010109L as date_key"), "dim_service_type": spark.sql("select 1L as service_type_key, 's' as service_type_name")}
    for dim, of in (("customer", "customer"), ("vehicle", "vehicle"), ("employee", "employee")):
        dims[f"dim_{dim}"] = spark.sql(f"select 1L as {of}_key, 5L as original_{of}_id, true as is_current")
    cuts, asked = [], []
    cut = lambda d: cuts.append(d) or d
    known = lambda c: asked.append(c) or c.limit(0).select("original_appointment_id")
    facts, _ = CS.fact_service_appointments_incremental(appts, known, dims, T0, T1, None, cut)
    assert facts.count() == 1 and len(cuts) == 2 and asked[0] is cuts[0]
