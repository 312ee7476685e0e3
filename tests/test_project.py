import pytest
from pyspark.sql import functions as F

from millrace.operators.project import FieldPlan, present_fields, project_fields

DDL = "m STRUCT<a: STRING, items: ARRAY<STRUCT<name: STRING, value: STRING>>, `user-agent`: STRING, service: ARRAY<STRUCT<d: STRUCT<id: STRING>>>>"
ROWS = [
    '{"m":{"a":"1.5","items":[{"name":"n0","value":"v0"},{"name":"n1"}],"user-agent":"ua","service":[{"d":{"id":"s"}}]}}',
    '{"m":{"items":[]}}',
    '{"m":null}',
]
FIELDS = [
    FieldPlan("m.a", "whole", "Int"),
    FieldPlan("m.items.name[0]", "first", "String"),
    FieldPlan("m.items.value[12]", "far", "String"),
    FieldPlan("m.gone.leaf", "gone", "Bigint"),
    FieldPlan("m.user-agent", "user-agent", "String"),
    FieldPlan("m.service.d.id[0]", "a.dotted", None),
    FieldPlan("m.items.name", "names", None),
]


@pytest.fixture()
def df(spark):
    text = spark.createDataFrame([(r,) for r in ROWS], "v string")
    return text.select(F.from_json("v", DDL).alias("x")).select("x.*")


def test_missing_null(any_ansi, df):
    out = project_fields(df, FIELDS)
    assert out.columns == [f.name for f in FIELDS]
    assert out.schema["gone"].dataType.simpleString() == "bigint"
    assert [tuple(r) for r in out.collect()] == [
        (1, "n0", None, None, "ua", "s", ["n0", "n1"]),
        (None, None, None, None, None, None, []),
        (None, None, None, None, None, None, None),
    ]


def test_missing_omit(any_ansi, df):
    out = project_fields(df, FIELDS, missing="omit", cast=False)
    assert out.columns == [f.name for f in FIELDS if f.name != "gone"]
    assert out.first()["whole"] == "1.5"
    assert [f.name for f in present_fields(df.schema, FIELDS)] == out.columns


def test_nothing_present(df):
    assert project_fields(df, [FieldPlan("x.y", "z")], missing="omit").columns == []
