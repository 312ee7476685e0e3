from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators.enrich import enrich
from millrace.operators.split import split_wide


def test_day_key_is_taken_before_the_shift(any_ansi):
    rows = [(datetime(2020, 5, 6, 2, 0), "2020-05-06 04:59:59"), (datetime(2020, 5, 6, 5, 0), "junk")]
    df = any_ansi.createDataFrame(rows, "clock timestamp, fecha_hora_operacion string")
    out = enrich(df, "America/Bogota", F.col("clock")).drop("clock")
    assert out.columns == ["fecha_hora_operacion", "fecha_hora_kudu", "periodo"]
    assert [tuple(r) for r in out.collect()] == [
        (datetime(2020, 5, 5, 23, 59, 59), datetime(2020, 5, 5, 21, 0), 20200506),
        (None, datetime(2020, 5, 6, 0, 0), 20200506),
    ]


def test_event_time_in_another_case(spark):
    df = spark.createDataFrame([(datetime(2020, 5, 6, 5, 0),)], "Fecha_Hora_Operacion timestamp")
    out = enrich(df, "America/Bogota", period_source="FECHA_hora_operacion")
    assert out.columns[1:] == ["fecha_hora_kudu", "periodo"]
    assert (out.first()[0], out.first()["periodo"]) == (datetime(2020, 5, 6, 0, 0), 20200506)


def test_no_event_time_no_zone(any_ansi):
    out = enrich(any_ansi.range(1), clock=F.lit(datetime(2020, 5, 6, 2, 0)))
    assert tuple(out.first()) == (0, datetime(2020, 5, 6, 2, 0), 20200506)


def test_period_source(any_ansi):
    df = any_ansi.createDataFrame([("2020-02-29 23:00:00",), ("x",)], "t string")
    assert [r["periodo"] for r in enrich(df, period_source="t").collect()] == [20200229, None]


def test_default_clock_is_one_value(spark):
    assert enrich(spark.range(100, numPartitions=8)).select("fecha_hora_kudu").distinct().count() == 1


TEXTS = [None, "", "ab", "abcd", "abcdefgh", "abcdefghi", "abcdefghijklmnopqrstuvwxyz", "ñandú€x"]


@pytest.mark.parametrize("names", [["c0"], ["c0", "c1"], ["c0", "c1", "c2", "c3"]])
def test_contiguous_chunks_join_up(any_ansi, names):
    df = any_ansi.createDataFrame([(t,) for t in TEXTS], "t string")
    out = split_wide(df.withColumn("k", F.col("t")), "t", 5, names, rest="rest")
    assert out.columns == ["k", *names, "rest"]
    for row in out.collect():
        parts = [row[c] for c in [*names, "rest"]]
        if row["k"] is None:
            assert parts == [None] * len(parts)
        else:
            assert "".join(parts) == row["k"]
            assert all(len(p) <= 4 for p in parts[:-1])


def test_rest_is_kept_by_default(any_ansi):
    df = any_ansi.createDataFrame([("abcdefghij",)], "t string")
    assert split_wide(df, "t", 4, ["c0", "c1"]).first().asDict() == {"c0": "abc", "c1": "def", "t_rest": "ghij"}
    for capacity, names in ((1, ["c0"]), (4, ["t"]), (4, ["c0", "c0"]), (4, ["t_rest"])):
        with pytest.raises(ValueError):
            split_wide(df, "t", capacity, names)


def test_strided_chunks_skip_a_character(any_ansi):
    df = any_ansi.createDataFrame([("abcdefghijklmnopqrstuvwxyz",), ("abc",)], "t string")
    out = split_wide(df, "t", 5, ["c0", "c1", "c2"], layout="strided", rest=None)
    assert [tuple(r) for r in out.collect()] == [("abcd", "efgh", "jklm"), ("abc", "", "")]
