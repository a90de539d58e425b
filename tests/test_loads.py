"""Load runs through the manifest store: contents, repeated and failed runs, reject replay, compaction."""

import tempfile

import pytest
from pyspark.sql import functions as F

from starloom.plans import loads
from starloom.plans import stand_in as SI
from starloom.plans import state as ST
from starloom.plans.loads import run_full, run_incremental, table_digests
from starloom.sources.store import Store, _fs, _intermediates, passing
from tests.conftest import SF_SMALL


def contents(spark, store):
    return {r["table"]: (r["rows"], r["content"]) for r in table_digests(spark, store).collect()}


def full(spark, store, ts=SI.T0, accidents=True):
    run_full(spark, store, ST.sources(spark, SF_SMALL, 0), ts,
             SI.accident_extract_raw(spark, SF_SMALL) if accidents else None)


def test_runs_repeated_failed_and_out_of_order(spark, monkeypatch):
    store = Store(spark, tempfile.mkdtemp(prefix="wh-"))
    full(spark, store)
    c0 = contents(spark, store)
    assert len(c0) == 20 and all(v[0] > 0 for v in c0.values())
    run_incremental(spark, store, ST.sources(spark, SF_SMALL, 1), SI.T1)
    c1 = contents(spark, store)
    assert c1["archive_customers"] > c0["archive_customers"]
    assert c1["fact_service_appointments"][0] > c0["fact_service_appointments"][0]
    cur = store.read("dim_customer", "open")
    assert cur.groupBy("original_customer_id").count().filter("count > 1").count() == 0

    run_incremental(spark, store, ST.sources(spark, SF_SMALL, 1), SI.T1)  # the same run again
    assert contents(spark, store) == c1 and len(store.run_ids()) == 2

    def broken(*args, **kw):
        raise RuntimeError("lost connection")

    with monkeypatch.context() as m:  # the same run, failing before its facts are written
        m.setattr(loads, "_write_facts", broken)
        with pytest.raises(RuntimeError, match="lost connection"):
            run_incremental(spark, store, ST.sources(spark, SF_SMALL, 1), SI.T1)
    assert contents(spark, store) == c1

    with pytest.raises(RuntimeError, match="older"):
        full(spark, store)
    m = store.manifest()
    assert any(len(e.get("parts", [])) > 1 for e in m["tables"].values())
    store.compact()
    assert contents(spark, store) == c1
    assert all(len(e.get(k, [])) <= 1 for e in store.manifest()["tables"].values() for k in ("parts", "closed"))


def test_second_full_load_replaces(spark):
    store = Store(spark, tempfile.mkdtemp(prefix="wh-"))
    full(spark, store, accidents=False)
    once = {t: v[0] for t, v in contents(spark, store).items()}
    full(spark, store, SI.T1, accidents=False)
    assert {t: v[0] for t, v in contents(spark, store).items()} == once


def test_rejects_are_replayed_until_the_customer_arrives(spark):
    store = Store(spark, tempfile.mkdtemp(prefix="wh-"))
    full(spark, store, accidents=False)
    day1 = ST.sources(spark, SF_SMALL, 1).copy()
    late = day1["ServiceAppointments"].filter(F.col("appointment_id") >= SI.ORDER_COPY_OFFSET).agg(
        F.min("customer_id")).first()[0]
    ids = {r[0] for r in day1["ServiceAppointments"].filter(
        (F.col("appointment_id") >= SI.ORDER_COPY_OFFSET) & (F.col("customer_id") == late)).select("appointment_id").collect()}
    without = {**dict(day1.items()), "Customers": day1["Customers"].filter(F.col("customer_id") != late),
               "Vehicles": day1["Vehicles"].filter(F.col("customer_id") != late)}
    facts = lambda t, c: {r[0] for r in store.read(t).select(c).collect()}
    run_incremental(spark, store, without, SI.T1)
    assert ids <= facts("rejects_fact_service_appointments", "original_appointment_id")
    assert not ids & facts("fact_service_appointments", "original_appointment_id")
    lines = facts("rejects_fact_service_parts_usage", "original_service_detail_id")
    run_incremental(spark, store, dict(day1.items()), SI.T2)
    assert ids <= facts("fact_service_appointments", "original_appointment_id")
    assert not facts("rejects_fact_service_appointments", "original_appointment_id")
    left = facts("rejects_fact_service_parts_usage", "original_service_detail_id")
    assert left < lines and lines - left <= facts("fact_service_parts_usage", "original_service_detail_id")


def test_delete_guard_is_opt_in(spark):
    store = Store(spark, tempfile.mkdtemp(prefix="wh-"))
    full(spark, store, accidents=False)
    day = dict(ST.sources(spark, SF_SMALL, 1).items())
    empty = {**day, "Employees": day["Employees"].limit(0)}
    with pytest.raises(RuntimeError, match="archive_employees"):
        run_incremental(spark, store, empty, SI.T1, max_delete_ratio=0.5)
    run_incremental(spark, store, empty, SI.T1)
    assert store.read("dim_employee", "open").count() == 0


def test_runs_leave_no_intermediate_tables(spark):
    """What only the writes of a step read is deleted behind them: looked-up facts, diffs, versions to close."""
    def left():
        fs, p = _fs(spark, _intermediates(spark))
        return {st.getPath().getName() for st in fs.listStatus(p)} if fs.exists(p) else set()

    store, before = Store(spark, tempfile.mkdtemp(prefix="wh-")), left()
    full(spark, store)
    run_incremental(spark, store, ST.sources(spark, SF_SMALL, 1), SI.T1)
    assert left() == before
    assert all(v[0] > 0 for v in contents(spark, store).values())


def test_passing_tables_go_with_their_block_even_if_it_fails(spark):
    with pytest.raises(RuntimeError, match="stop"):
        with passing(spark) as cut:
            rows = cut(spark.range(3))
            assert rows.count() == 3
            raise RuntimeError("stop")
    with pytest.raises(Exception):
        spark.read.parquet(rows.inputFiles()[0]).count()
