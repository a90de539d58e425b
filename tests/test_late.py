"""A late snapshot spliced into later history: as if all had come in order."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starloom.operators import archive as A
from starloom.operators.late import apply_splice, rekey_facts, splice_dimension, splice_snapshot
from starloom.operators.scd2 import scd2_rebuild
from starloom.sources.store import materialize
from starloom.spec import EntitySpec, Scd2Spec

SPEC = EntitySpec("archive_things", "id", "thing_id", {"id": "bigint", "name": "string", "note": "string"}, ("name", "note"))
DIM = Scd2Spec("dim_thing", "thing_id", "thing_key", lambda: [F.col("name"), F.col("note")], ("name", "note"))
DAYS = [datetime(2024, 1, 1) + timedelta(days=d) for d in range(5)]


def _snapshots(seed):
    rnd = random.Random(seed)
    return [[(i, rnd.choice("ab"), rnd.choice(["x", None])) for i in range(60) if rnd.random() < 0.7] for _ in DAYS]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id long, name string, note string")


def _run(spark, arch, rows, ts):
    src = _frame(spark, rows)
    if arch is None:
        return materialize(A.archive_initial(src, SPEC, ts))
    diff = materialize(A.snapshot_diff(src, A.open_versions(arch), SPEC))
    closed = arch.filter(~arch.thing_id.isNull()).join(A.open_versions(arch).select("thing_id", A.VALID_FROM),
                                                       ["thing_id", A.VALID_FROM], "left_anti").select(*arch.columns)
    return materialize(closed.unionByName(A.open_after(diff, ts)).unionByName(A.closed_versions(diff, ts)))


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("late", [1, 3])
def test_splice_equals_runs_in_order(spark, late):
    snaps = _snapshots(late)
    ordered = out_of_order = None
    for d, rows in enumerate(snaps):
        ordered = _run(spark, ordered, rows, DAYS[d])
        if d != late:
            out_of_order = _run(spark, out_of_order, rows, DAYS[d])
    src = _frame(spark, snaps[late])
    removed, added = splice_snapshot(out_of_order, src, SPEC, DAYS[late], DAYS[late + 1])
    removed, added = materialize(removed), materialize(added)
    spliced = materialize(apply_splice(out_of_order, removed, added, SPEC))
    assert removed.count() and _rows(spliced) == _rows(ordered)
    dim, gone, new = splice_dimension(scd2_rebuild(out_of_order, DIM), removed, added, DIM)
    assert _rows(dim) == _rows(scd2_rebuild(ordered, DIM))
    untouched = out_of_order.join(removed.select("thing_id"), "thing_id", "left_anti").count()
    assert untouched > 0
    # once more: nothing differs
    again, more = splice_snapshot(spliced, src, SPEC, DAYS[late], DAYS[late + 1])
    assert again.count() == more.count() == 0
    # facts keyed by the wrong history get the keys of the true one, wherever a row is in force at their time
    facts = (scd2_rebuild(out_of_order, DIM).select("thing_id", "thing_key", "dim_valid_from", "dim_valid_to")
             .crossJoin(spark.createDataFrame([(t + timedelta(hours=1),) for t in DAYS], "at timestamp_ntz"))
             .filter("at between dim_valid_from and dim_valid_to").select("thing_id", "thing_key", "at"))
    facts = materialize(facts)
    moved = rekey_facts(facts, gone, new, DIM, "at")
    true = scd2_rebuild(ordered, DIM).select("thing_id", F.col("thing_key").alias("true_key"), "dim_valid_from", "dim_valid_to")
    j = moved.join(true, "thing_id").filter("at between dim_valid_from and dim_valid_to")
    assert moved.count() == facts.count() and j.count() > 100 and j.filter("thing_key <> true_key").count() == 0
    assert moved.join(facts, ["thing_id", "thing_key", "at"], "left_anti").count() > 0
