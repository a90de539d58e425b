"""Part filters, the as-of look-up in time slices, and unique keys in one pass."""

import tempfile
from datetime import datetime, timedelta

import pytest

from starloom.operators import marts as M
from starloom.operators import quality as Q
from starloom.operators.facts import new_facts_only
from starloom.session import FAR_FUTURE
from starloom.sources import parts as P
from starloom.sources.store import Store


def _noted(spark, parts, kind="id long, v int"):
    store = Store(spark, tempfile.mkdtemp(prefix="wh-"))
    filters = {}
    for i, ids in enumerate(parts):
        run = f"r{i}"
        path = store.write(spark.createDataFrame([(x, i) for x in ids], kind), "facts", run)
        filters[path] = P.describe(store, path, "facts", run, "id")
    return store, filters


def test_only_parts_that_can_hold_an_id_are_read(spark):
    store, filters = _noted(spark, [range(0, 2000, 2), range(2000, 4000), range(1, 2001, 2), [], [None, None]])
    paths = list(filters)
    ids = lambda x: spark.createDataFrame([(i,) for i in x], "id long")
    assert P.in_range(filters, 5000, 9000) == [] and P.known_ids(store, ids([5000, 9000]), "id", filters).count() == 0
    assert P.in_range(filters, 2500, 2600) == [paths[1]]
    # the ranges of the first and third part overlap, their filters tell them apart
    _, found = P.candidate_parts(store, ids([10]), "id", filters)
    assert paths[0] in found and len(found) == 1
    # no lost and no doubled fact, whatever the filters say
    asked = [*range(1990, 2010), 7, 8, 9_000_000, -4, 3999, 3999, None]
    known = sorted(r["id"] for r in P.known_ids(store, ids(asked), "id", filters).collect())
    assert known == sorted({x for x in asked if x is not None and 0 <= x < 4000})
    new = new_facts_only(ids(asked), lambda c: P.known_ids(store, c, "id", filters), ["id"])
    assert sorted((r["id"] is None, r["id"]) for r in new.collect()) == [(False, -4), (False, 9_000_000), (True, None)]
    # parts outside the range aren't touched: their places may be gone
    gone = {(p if p == paths[1] else f"/nowhere/{i}"): f for i, (p, f) in enumerate(filters.items())}
    assert P.known_ids(store, ids([2500, 5000]), "id", {p: f for p, f in gone.items() if f["min"] is None or f["min"] >= 2000}).count() == 1


def test_filters_of_text_ids_and_a_large_part(spark):
    store, filters = _noted(spark, [[f"a{i}" for i in range(3000)], ["b1"]], "id string, v int")
    asked = spark.createDataFrame([(f"a{i}",) for i in range(2990, 3300)] + [("b1",), ("c",)], "id string")
    assert P.known_ids(store, asked, "id", filters).count() == 11
    false = P.candidate_parts(store, spark.createDataFrame([(f"a{i}x",) for i in range(1000, 3000)], "id string"), "id", filters)[0]
    assert false.count() < 60  # 12 bits a row: about one in 300


def test_a_filter_takes_one_row_an_id(spark):
    ids = spark.range(5000).withColumnRenamed("id", "x")
    asked = P._asked(ids, "x", 65536)
    assert "Generate" not in asked._jdf.queryExecution().optimizedPlan().toString()
    rows = asked.collect()
    assert len(rows) == 5000 and all(0 <= r["word"] < 1024 and 1 <= (r["mask"] & (2**64 - 1)).bit_count() <= P.HASHES for r in rows)


def _versions(n):
    t0 = datetime(2024, 1, 1)
    out = []
    for i in range(n):
        for v in range(4):
            a = t0 + timedelta(days=10 * v + i % 3)
            b = FAR_FUTURE if v == 3 else t0 + timedelta(days=10 * (v + 1) + i % 3 - (2 if v == 1 else 0), microseconds=-1)
            out.append((i, i * 10 + v, a, b))
    return out


@pytest.mark.parametrize("slices", [1, 2, 7, 64])
def test_sliced_as_of_equals_brute_force(spark, slices):
    versions = _versions(6)
    t0 = datetime(2023, 12, 28)
    facts = [(k, 0 if k % 3 == 0 else k % 7, t0 + timedelta(hours=7 * k % 1200)) for k in range(600)]
    facts += [(1000, None, t0), (1001, 0, None), (1002, 99, t0), (1003, 1, datetime(2024, 1, 2)), (1004, 0, datetime(2024, 1, 11)),
              (1004, 0, datetime(2024, 1, 11))]
    f = spark.createDataFrame(facts, "fact long, who long, at timestamp_ntz")
    d = spark.createDataFrame(versions, "id int, k long, dim_valid_from timestamp_ntz, dim_valid_to timestamp_ntz").union(
        spark.createDataFrame([(None, 7, t0, FAR_FUTURE)], "id int, k long, dim_valid_from timestamp_ntz, dim_valid_to timestamp_ntz"))
    got = sorted(((r["fact"], r["k"]) for r in M.as_of_sliced(f, "who", "at", d, "id", "k", slices=slices).collect()), key=str)

    def key(who, at):
        hit = [k for i, k, a, b in versions if at is not None and i == who and a <= at <= b]
        return hit[0] if hit else None

    assert got == sorted(((n, key(who, at)) for n, who, at in facts), key=str)


def test_a_hot_id_is_spread_over_slices(spark):
    f = spark.range(4000).selectExpr("id AS fact", "0L AS who", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(id AS int)) AS at")
    d = spark.createDataFrame(_versions(1), "id int, k long, dim_valid_from timestamp_ntz, dim_valid_to timestamp_ntz")
    assert len(M._bounds(f, "at", 16)) == 15
    plan = M.as_of_sliced(f, "who", "at", d, "id", "k", slices=16)._jdf.queryExecution().optimizedPlan().toString()
    assert "_id" in plan and "Cartesian" not in plan
    empty = f.limit(0)
    assert M.as_of_sliced(empty, "who", "at", d, "id", "k").count() == 0


def test_keys_in_one_pass_equal_one_by_one(spark):
    rows = [(1, "a", None), (1, "a", None), (2, None, "a"), (2, "a", "b"), (3, "x", "y"), (None, None, None), (None, None, None), (4, "", None)]
    df = spark.createDataFrame(rows, "a int, b string, c string").repartition(3)
    sets = [["a"], ["b", "c"], ["a", "b", "c"], ["c"]]
    want = [tuple(Q.uniqueness_summary(df, "t", k).first()) for k in sets]
    got = {r["keys"]: tuple(r) for r in Q.uniqueness_one_pass(df, "t", sets).collect()}
    assert [got[",".join(k)] for k in sets] == want
    unique = spark.range(100).selectExpr("id", "id % 7 AS m")
    assert [tuple(r) for r in Q.uniqueness_one_pass(unique, "u", [["id"]]).collect()] == [("u", "id", 0, 0)]
    plan = Q._fingerprints(unique, [["id"], ["m"], ["id", "m"]]).groupBy("set", "h1", "h2").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
