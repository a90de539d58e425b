import re
from datetime import datetime

from pyspark.sql import functions as F

from starloom.functions import clean as X
from starloom.functions.hashing import hash_key, row_hash
from starloom.operators import dims as D
from starloom.plans import car_service as CS
from starloom.plans.stand_in import _rounded


def test_strip_and_clean(spark):
    df = spark.createDataFrame([("\t  Boston \r\n",), ("None",), ("  ",), (None,), ("nan",)], "c string")
    out = [r[0] for r in df.select(X.strip("c")).collect()]
    assert out[0] == "Boston" and out[2] == ""
    cleaned = [r[0] for r in df.select(X.clean_text("c", upper=True)).collect()]
    assert cleaned == ["BOSTON", None, None, None, None]


def test_full_name_and_crlf(spark):
    df = spark.createDataFrame([(" Ann", "Lee "), ("Bo", None)], "a string, b string")
    assert [r[0] for r in df.select(X.full_name("a", "b")).collect()] == ["Ann Lee", "Bo"]
    df2 = spark.createDataFrame([("x\r\ny",)], "t string")
    assert df2.select(X.crlf_to_lf("t")).first()[0] == "x\ny"


def test_time_of_day(spark):
    df = spark.createDataFrame([("9:05:03",), ("09:05:03",), ("25:00:00",), ("bad",), (None,)], "t string")
    rows = df.select(X.hour_of_time("t").alias("h"), X.time_to_hms("t").alias("s")).collect()
    assert [r.h for r in rows] == [9, 9, 0, 0, 0]
    assert [r.s for r in rows] == ["09:05:03", "09:05:03", None, None, None]


def test_numeric_coerce(spark):
    df = spark.createDataFrame([("12.345",), ("abc",), ("123456.7",)], "v string")
    rows = [r[0] for r in df.select(X.to_decimal("v", 5, 2)).collect()]
    assert str(rows[0]) == "12.35" and rows[1] is None and rows[2] is None


def test_duration_minutes_half_up(spark):
    a = datetime(2024, 1, 1, 0, 0, 0)
    df = spark.createDataFrame([(a, datetime(2024, 1, 1, 0, 0, 0, 300000)), (a, datetime(2024, 1, 1, 1, 30)),
                                (datetime(2024, 1, 1, 0, 0, 0, 300000), a)], "s timestamp_ntz, e timestamp_ntz")
    out = [str(r[0]) for r in df.select(X.duration_minutes("s", "e")).collect()]
    assert out == ["0.01", "90.00", "-0.01"]


def test_row_hash_is_collision_safe(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("None", "x")], "p string, q string")
    hs = [r[0] for r in df.select(row_hash(df, ["p", "q"])).collect()]
    assert len(set(hs)) == 4


def test_row_hash_ignores_numeric_rendering(spark):
    a = spark.createDataFrame([(5, 1.50)], "n bigint, d double")
    b = spark.createDataFrame([(5, 1.5000001)], "n bigint, d double")
    ha = a.select(row_hash(a, ["n", "d"])).first()[0]
    hb = b.select(row_hash(b, ["n", "d"])).first()[0]
    assert ha == hb  # fractional values compared at 4 decimals


def test_hash_key_stable_and_distinct(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (1, datetime(2024, 1, 2)), (2, datetime(2024, 1, 1))],
                               "id bigint, vf timestamp_ntz")
    keys = [r[0] for r in df.select(hash_key(df, ["id", "vf"])).collect()]
    assert len(set(keys)) == 3 and all(0 <= k < 2 ** 60 for k in keys)
    again = [r[0] for r in df.repartition(3).select(hash_key(df, ["id", "vf"])).orderBy(F.lit(1)).collect()]
    assert sorted(again) == sorted(keys)


def test_clean_text_as_by_pattern(spark):
    texts = [" a\x85", "a \x85", "\t\n\x85", " b  ", "c  ", " ", " nan", "nan ", "nan", "NaT", "nan,NaN", "a,b", ",", "", " ",
             "\x0bStraße\x0c", " x ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    stripped = F.regexp_replace(X.null_if_token("t"), f"^{X.WHITESPACE_CLASS}+|{X.WHITESPACE_CLASS}+$", "")
    expected = F.when(stripped != "", stripped)
    rows = df.select("t", X.clean_text("t").alias("a"), expected.alias("b"), X.clean_text("t", upper=True).alias("c"),
                     F.upper(expected).alias("d"), X.clean_text("t", blank_to_null=False).alias("e"), stripped.alias("f")).collect()
    assert all(r.a == r.b and r.c == r.d and r.e == r.f for r in rows)


def test_rounded_as_round(spark):
    values = [0.0, -0.0, 0.49999999999999994, 0.5, -0.5, 1.5, 2.5, -2.5, 2.4999999999999996, 0.1 * 3 * 100, 1234567.5, 4503599627370495.5,
              4503599627370497.0, -9007199254740993.0, 1e15 + 0.5, 1e18, 901.00 * 100, 8.115 * 100, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", _rounded(F.col("v")).alias("a"), F.round("v").cast("bigint").alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]


def test_code_of_accident_steps_is_compiled(spark, tmp_path):
    """The JVM interprets methods of more than 8,000 bytes for good; no generated method of these steps is that long."""
    types = {"string": "'x'", "timestamp_ntz": "timestamp_ntz'2024-01-01 10:00:00'", "boolean": "true"}
    row = [F.expr(f"cast({types.get(t, '1')} as {t})").alias(c) for c, t in CS.ACCIDENT_TYPES.items()]
    spark.range(3).select(*row).write.parquet(f"{tmp_path}/accidents")
    spark.range(3).select(*[F.lit("x").cast(t).alias(CS.CUSTOMERS.archive_name(c)) if t == "string" else F.lit(None).cast(t).alias(
        CS.CUSTOMERS.archive_name(c)) for c, t in CS.CUSTOMERS.columns.items()]).write.parquet(f"{tmp_path}/customers")
    accidents, customers = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("accidents", "customers"))
    dims = {"dim_location": CS.dim_location(accidents, customers), "dim_weather": CS.dim_weather(accidents),
            "dim_daylight": CS.dim_daylight(accidents), "dim_road_features": CS.dim_road_features(accidents),
            "dim_date": D.calendar_dim([D.date_hours(accidents, ts="Start_Time")])}
    for name, df in dims.items():
        df.write.parquet(f"{tmp_path}/{name}")
    written = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in dims}
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the code of all stages is there without running them
    try:
        for df in (dims["dim_location"], dims["dim_daylight"], CS.fact_accidents(accidents, written)[0]):
            text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
            sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert sizes and max(sizes) <= 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
