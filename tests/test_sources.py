"""Accident CSV extract: header, unit-suffixed names, bad values -> NULL, malformed lines quarantined."""

import os
import tempfile
from datetime import datetime

import pytest

from starloom.plans import car_service as CS
from starloom.sources import store
from starloom.sources.store import Conflict, Store
from starloom.sources.tables import project_to, read_csv_with_quarantine, write_csv

COLS = ["ID", "Severity", "Start_Time", "End_Time", "City", "State", "Temperature(F)", "Bump", "Sunrise_Sunset"]


def write(folder, name, *lines):
    with open(os.path.join(folder, name), "w", newline="") as fh:
        fh.write("\n".join(lines) + "\n")


def test_csv_extract_with_quarantine(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    write(d, "acc.csv", ",".join(COLS),
          "A-1,2,2024-01-01 10:00:00,2024-01-01 10:30:00,Austin , tx,71.5,True,Day",
          "A-2,x,not a time,2024-01-01 11:00:00,Dallas,TX,abc,maybe,Night",
          'A-3,1,2024-01-01 12:00:00,2024-01-01 12:10:00,"New ""Old""\nTown, upper",TX,1,False,Day',
          "A-4,1,too,few", "A-5,1,2024-01-01 12:00:00,2024-01-01 12:10:00,Waco,TX,1,False,Day,one,more")
    good, bad = read_csv_with_quarantine(spark, d, COLS)
    assert sorted(r.ID for r in good.select("ID").collect()) == ["A-1", "A-2", "A-3"]
    assert good.count() == 3 and bad.count() == 2
    assert sorted(r.line.split(",")[0] for r in bad.collect()) == ["A-4", "A-5"]
    assert good.filter("ID = 'A-3'").first().City == 'New "Old"\nTown, upper'
    arch = CS.archive_accidents(good, datetime(2024, 1, 1))
    rows = {r.ID: r for r in arch.collect()}
    assert float(rows["A-1"].Temperature_F) == 71.5 and rows["A-1"].Bump is True
    assert rows["A-2"].Severity is None and rows["A-2"].Start_Time is None and rows["A-2"].Temperature_F is None
    assert rows["A-2"].Bump is None
    loc = CS.dim_location(arch, spark.createDataFrame([], "original_customer_id bigint, city string, state string, "
                                                         "address string, zip_code string"))
    assert ("AUSTIN", "TX") in {(r.city, r.state) for r in loc.collect()}


def test_csv_columns_are_bound_by_header(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    write(d, "a.csv", "b,c,a", "2,3,1", "5,6,4")
    good, bad = read_csv_with_quarantine(spark, d, ["a", "b", "missing"])
    assert sorted(map(tuple, good.collect())) == [("1", "2", None), ("4", "5", None)] and bad.count() == 0


def test_csv_round_trip(spark):
    d = tempfile.mkdtemp(prefix="csv-") + "/out"
    rows = [(1, "plain"), (2, 'quo"te, comma'), (3, "line\nbreak\r\nand more"), (4, None), (5, " padded ")]
    write_csv(spark.createDataFrame(rows, "id int, text string"), d + "/first")
    write_csv(spark.createDataFrame([(6, "")], "id int, text string"), d + "/more")  # CSV: no text is NULL
    good, bad = read_csv_with_quarantine(spark, d + "/*", ["id", "text"])
    rows.append((6, None))
    assert sorted((int(r.id), r.text) for r in good.collect()) == rows and bad.count() == 0


def test_schema_drift_projection(spark):
    df = spark.createDataFrame([(1, "a", "extra")], "id int, name string, surprise string")
    out, dropped = project_to(df, ["id", "name", "missing"])
    assert out.columns == ["id", "name"] and dropped == ["surprise"]


def test_interleaved_publishers(spark):
    """Of two publishers on one state, the second goes on top of the first if their tables differ, and gives up if not."""
    root = tempfile.mkdtemp(prefix="wh-")
    a, b, c = (Store(spark, root) for _ in range(3))
    a.begin("r1")
    a.publish("r1", "t1", {"x": {"parts": [a.write(spark.range(3), "x", "r1")]}})
    for s in (a, b, c):
        s.begin("r2")
    new = {s: {t: {"parts": [s.write(spark.range(n), t, "r2")]}} for s, t, n in ((a, "y", 1), (b, "z", 2), (c, "y", 5))}
    a.publish("r2", "t2", new[a])
    b.publish("r2", "t2", new[b])  # another table: on top of the other's
    with pytest.raises(Conflict, match="changed y"):
        c.publish("r2", "t2", new[c])
    assert {t: a.read(t).count() for t in a.manifest()["tables"]} == {"x": 3, "y": 1, "z": 2}
    late = Store(spark, root)
    late.begin("r3")
    b.begin("r4")
    b.publish("r4", "t4", {"w": {"parts": [b.write(spark.range(4), "w", "r4")]}})
    with pytest.raises(Conflict, match="r4"):  # a later run was built without this one
        late.publish("r3", "t3", {"v": {"parts": [late.write(spark.range(4), "v", "r3")]}})
    assert not [n for n in os.listdir(f"{root}/_manifest") if n.startswith(".draft")]


def test_a_manifest_is_never_replaced(spark, monkeypatch):
    """The file that another publisher creates between the look and the rename is found by the rename."""
    root = tempfile.mkdtemp(prefix="wh-")
    a, b = Store(spark, root), Store(spark, root)
    for s in (a, b):
        s.begin("r1")
    real, between = store.replace_text, []

    def meanwhile(spark, path, text, overwrite=True):
        if not between and not overwrite:
            between.append(path)
            b.publish("r1", "t1", {"y": {"parts": [b.write(spark.range(2), "y", "r1")]}})
        return real(spark, path, text, overwrite)

    monkeypatch.setattr(store, "replace_text", meanwhile)
    a.publish("r1", "t1", {"x": {"parts": [a.write(spark.range(1), "x", "r1")]}})
    assert sorted(a.manifest()["tables"]) == ["x", "y"] and len(store.list_manifests(spark, root)) == 2


def test_intermediates_are_cleared(spark):
    df = store.materialize(spark.range(5))
    assert df.count() == 5
    store.clear_intermediates(spark)
    with pytest.raises(Exception, match="not exist"):
        store.materialize(spark.range(1)).sparkSession.read.parquet(df.inputFiles()[0].rsplit("/", 1)[0]).count()
