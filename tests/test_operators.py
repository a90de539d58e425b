from pyspark.sql import functions as F

from starloom.operators import dedupe as DD
from starloom.operators import lookup as L
from starloom.operators.keys import dense_key


def test_keep_first_last_deterministic(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "z")], "k int, o int, v string")
    first = {r.k: r.v for r in DD.keep_first(df.repartition(3), ["k"], ["o"]).collect()}
    last = {r.k: r.v for r in DD.keep_last(df.repartition(2), ["k"], ["o"]).collect()}
    assert first == {1: "a", 2: "z"} and last == {1: "c", 2: "z"}


def test_two_stage_dedupe(spark):
    df = spark.createDataFrame([(1, "V1"), (2, "V1"), (3, "V2"), (3, "V3")], "id int, vin string")
    out = sorted((r.id, r.vin) for r in DD.two_stage(df, ["id"], ["vin"]).collect())
    assert out == [(1, "V1"), (3, "V2")]


def test_lookup_null_safe(spark):
    fact = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "b", 1)], "id int, x string, y int")
    dim = spark.createDataFrame([(10, "a", None), (20, None, None), (30, "b", 2)], "k int, x string, y int")
    out = {r.id: r.k for r in L.lookup_key(fact, dim, [("x", "x"), ("y", "y")], "k", null_safe=True).collect()}
    assert out == {1: 10, 2: 20, 3: None}
    strict = {r.id: r.k for r in L.lookup_key(fact, dim, [("x", "x"), ("y", "y")], "k").collect()}
    assert strict == {1: None, 2: None, 3: None}


def test_anti_join_null_safe(spark):
    a = spark.createDataFrame([("a", None), (None, None), ("b", 1)], "x string, y int")
    b = spark.createDataFrame([(None, None)], "x string, y int")
    out = sorted((r.x or "", r.y or 0) for r in L.anti_join(a, b, ["x", "y"]).collect())
    assert out == [("a", 0), ("b", 1)]


def test_dense_key(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("nk"))
    out = dense_key(df, ["nk"], key="k", start=100, num_partitions=5)
    rows = out.collect()
    assert sorted(r.k for r in rows) == list(range(101, 1101))
    assert all(r.k == r.nk + 101 for r in rows)
