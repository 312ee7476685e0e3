from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import cast_column, target_type
from millrace.functions.times import normalise_iso_text
from millrace.operators.project import cast_fields


def cast_all(spark, values, type_name, kind="string", extended=False):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = cast_fields(df, {"v": type_name}, extended)
    return [r["v"] for r in out.orderBy("i").collect()]


def test_whole_numbers(any_ansi):
    values = [None, "", "12", "12.7", "-12.9", "12.9999999999", " 7 ", "+5", ".5", "1e3", "x", "9999999999", "12.x"]
    assert cast_all(any_ansi, values, "Int") == [None, None, 12, 12, -12, 12, 7, 5, 0, None, None, None, None]
    assert cast_all(any_ansi, ["9999999999.5", "99999999999999999999"], "Bigint") == [9999999999, None]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789.+- eEx\t", max_size=13), min_size=20, max_size=60))
def test_whole_numbers_like_a_plain_cast(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    ours = df.select("v", cast_column(F.col("v"), T.StringType(), "Int").alias("x")).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        plain = df.select("v", F.col("v").cast("int").alias("x")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert ours == plain


def test_other_numbers(any_ansi):
    assert cast_all(any_ansi, ["1.5", "1e3", "x", None], "Double") == [1.5, 1000.0, None, None]
    assert cast_all(any_ansi, [1.9, -1.9, None], "Int", "double") == [1, -1, None]
    assert cast_all(any_ansi, [3000000000, 5], "Int", "bigint") == [None, 5]
    assert cast_all(any_ansi, [True, None], "Int", "boolean") == [1, None]
    assert cast_all(any_ansi, [12, None], "String", "bigint") == ["12", None]


def test_timestamp(any_ansi):
    values = ["2020-05-06T07:08:09.5-05:00", "2020-05-06 07:08:09", "2020/05/06 07:08:09", "2020-13-01 00:00:00", "", None]
    assert cast_all(any_ansi, values, "Timestamp") == [
        datetime(2020, 5, 6, 12, 8, 9, 500000), datetime(2020, 5, 6, 7, 8, 9), None, None, None, None]
    assert cast_all(any_ansi, [86400], "Timestamp", "bigint") == [datetime(1970, 1, 2)]
    assert cast_all(any_ansi, [True], "Timestamp", "boolean") == [None]


def test_slash_timestamp(any_ansi):
    values = ["2019/12/17 15:47:47", "2019/12/17 15:47:47.767", "2019/1/7 5:07:07", "2019/13/17 15:47:47",
              "2019-12-17 15:47:47", "12", "", None]
    assert cast_all(any_ansi, values, "Timestamp_2") == [
        datetime(2019, 12, 17, 15, 47, 47), datetime(2019, 12, 17, 15, 47, 47), datetime(2019, 1, 7, 5, 7, 7),
        None, None, None, None, None]
    moment = datetime(2019, 12, 17, 15, 47, 47, 5)
    assert cast_all(any_ansi, [moment], "Timestamp_2", "timestamp") == [moment.replace(microsecond=0)]


@pytest.mark.parametrize("name", ["Integer", "Date", "", None, "string", "INT"])
def test_unknown_names_pass_through(any_ansi, name):
    assert cast_all(any_ansi, ["12.7"], name) == ["12.7"]
    assert cast_all(any_ansi, [1.5], name, "double") == [1.5]


def test_extended_names(any_ansi):
    assert cast_all(any_ansi, ["12.7", "x"], "Integer", extended=True) == [12, None]
    assert [str(d) for d in cast_all(any_ansi, ["2020-05-06", "x"], "Date", extended=True)] == ["2020-05-06", "None"]


def test_target_type():
    assert target_type("Bigint") == T.LongType()
    assert target_type("Integer") is None
    assert target_type("Integer", extended=True) == T.IntegerType()


def test_normalise_iso_text(any_ansi):
    df = any_ansi.createDataFrame([("2020-05-06T07:08:09-05:00",), (None,)], "v string")
    assert [r[0] for r in df.select(normalise_iso_text(F.col("v"))).collect()] == ["2020-05-06 07:08:09", None]
