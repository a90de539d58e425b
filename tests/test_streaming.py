"""A daily extract dropped into the control directory is loaded once by the availableNow stream."""

import json
import os
import shutil
import tempfile
from datetime import timedelta

import pytest

from starloom.plans import ledger
from starloom.plans import stand_in as SI
from starloom.plans import state as ST
from starloom.plans.ledger import Extract, apply_extract
from starloom.plans.loads import run_full, run_incremental, table_digests
from starloom.sources.store import Store, list_manifests
from starloom.streaming import increments
from starloom.streaming.increments import run_increments
from tests.conftest import SF_SMALL


def test_stream_runs_incremental(spark):
    base = tempfile.mkdtemp(prefix="stream-")
    store = Store(spark, f"{base}/wh")
    run_full(spark, store, ST.sources(spark, SF_SMALL, 0), SI.T0, SI.accident_extract_raw(spark, SF_SMALL))
    day1 = f"{base}/extracts/day1"
    for name, df in ST.sources(spark, SF_SMALL, 1).items():
        df.write.parquet(f"{day1}/{name}")
    os.makedirs(f"{base}/control")
    with open(f"{base}/control/day1.json", "w") as fh:
        fh.write(json.dumps({"run_ts": SI.T1.isoformat(), "root": day1}) + "\n")
    q = run_increments(spark, store, f"{base}/control", f"{base}/stream-ckpt")
    q.awaitTermination(600)
    assert len(list_manifests(spark, store.root)) == 2
    counts = {r["table"]: r["rows"] for r in table_digests(spark, store).collect()}
    assert counts["archive_customers"] > 150
    q2 = run_increments(spark, store, f"{base}/control", f"{base}/stream-ckpt")  # nothing new: no new run
    q2.awaitTermination(600)
    assert len(list_manifests(spark, store.root)) == 2


def _extracts(spark, base, days):
    for day in days:
        for name, df in ST.sources(spark, SF_SMALL, day).items():
            df.write.parquet(f"{base}/extracts/day{day}/{name}")


def _control(base, day, ts):
    os.makedirs(f"{base}/control", exist_ok=True)
    with open(f"{base}/control/day{day}.json", "w") as fh:
        fh.write(json.dumps({"run_ts": ts.isoformat(), "root": f"{base}/extracts/day{day}"}) + "\n")


def _contents(spark, store):
    return {r["table"]: (r["rows"], r["content"]) for r in table_digests(spark, store).collect()}


@pytest.fixture(scope="module")
def in_order(spark):
    """Extracts of days 1 and 2, a store after the full load, and the contents after both days."""
    base = tempfile.mkdtemp(prefix="stream-")
    _extracts(spark, base, (1, 2))
    store = Store(spark, f"{base}/in-order")
    run_full(spark, store, ST.sources(spark, SF_SMALL, 0), SI.T0)
    start = f"{base}/start"
    shutil.copytree(store.root, start)
    for day, ts in ((1, SI.T1), (2, SI.T2)):
        run_incremental(spark, store, increments.load_extract(spark, f"{base}/extracts/day{day}"), ts)
    return base, _contents(spark, store)


def _fresh(spark, base, name):
    """A store after the full load, with the directories that ``in-order`` wrote."""
    store = Store(spark, f"{base}/{name}")
    shutil.copytree(f"{base}/start/_manifest", f"{store.root}/_manifest")
    return store


def test_a_stream_that_dies_behind_its_second_extract_goes_on(spark, in_order, monkeypatch):
    base, want = in_order
    store = _fresh(spark, base, "dies")
    _control(base, 1, SI.T1)
    _control(base, 2, SI.T2)
    seen = []

    def dies(sess, st, extract, load, **kw):
        seen.append(apply_extract(sess, st, extract, load, **kw))
        if len(seen) == 2:
            raise RuntimeError("lost the driver")

    monkeypatch.setattr(increments, "apply_extract", dies)
    q = run_increments(spark, store, f"{base}/control", f"{base}/ckpt-dies")
    with pytest.raises(Exception, match="lost the driver"):
        q.awaitTermination(600)
    q = run_increments(spark, store, f"{base}/control", f"{base}/ckpt-dies")
    q.awaitTermination(600)
    assert seen == ["run", "run", "skipped", "skipped"]
    assert len(list_manifests(spark, store.root)) == 3 and _contents(spark, store) == want


def test_late_repeated_and_misplaced_extracts(spark, in_order, monkeypatch):
    base, want = in_order
    store = _fresh(spark, base, "late")
    one, two = (Extract(ts.isoformat(), f"{base}/extracts/day{d}") for d, ts in ((1, SI.T1), (2, SI.T2)))
    assert apply_extract(spark, store, two, increments.load_extract) == "run"
    real, calls = ledger.run_incremental, []

    def fails(sess, st, src, ts, **kw):
        calls.append(ts)
        if len(calls) == 2:  # behind the late extract, before the one that follows it
            raise RuntimeError("lost the driver")
        return real(sess, st, src, ts, **kw)

    monkeypatch.setattr(ledger, "run_incremental", fails)
    with pytest.raises(RuntimeError, match="lost the driver"):
        apply_extract(spark, store, one, increments.load_extract)
    assert len(ledger.Ledger(store).pending()) == 1
    assert apply_extract(spark, store, one, increments.load_extract) == "skipped"  # and the one after it is made good
    assert calls == [SI.T1, SI.T2, SI.T2] and not ledger.Ledger(store).pending()
    assert _contents(spark, store) == want
    old = Extract((SI.T0 - timedelta(days=3)).isoformat(), "/nowhere")
    assert apply_extract(spark, store, old, increments.load_extract) == "refused"
    assert ledger.Ledger(store).refused() == [old.run_id] and _contents(spark, store) == want


def test_a_failed_run_is_resumed_table_by_table(spark, in_order, monkeypatch):
    base, want = in_order
    store = _fresh(spark, base, "resumed")
    src = increments.load_extract(spark, f"{base}/extracts/day1")
    assert "dim_customer" in run_incremental(spark, store, src, SI.T1, resume="one", until="dimensions")
    assert len(store.run_ids()) == 1
    written = []
    real = Store.write
    monkeypatch.setattr(Store, "write", lambda self, df, table, *a, **kw: written.append(table) or real(self, df, table, *a, **kw))
    run_incremental(spark, store, src, SI.T1, resume="one")
    assert {t.removeprefix("rejects_") for t in written} == {"fact_service_appointments", "fact_service_parts_usage"}
    assert len(store.run_ids()) == 2
    run_incremental(spark, store, increments.load_extract(spark, f"{base}/extracts/day2"), SI.T2)
    assert _contents(spark, store) == want
    written.clear()
    run_incremental(spark, store, increments.load_extract(spark, f"{base}/extracts/day2"), SI.T2, resume="other")
    assert "archive_customers" in written and _contents(spark, store) == want
