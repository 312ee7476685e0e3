import pytest
from pyspark.sql import types as T

from millrace.functions.paths import Step, has_path, only_paths, parse_path, path_column, path_type, with_paths

DDL = (
    "a STRUCT<b: STRUCT<c: STRING>, items: ARRAY<STRUCT<name: STRING, deep: STRUCT<id: INT>, "
    "inner: ARRAY<STRUCT<z: INT>>>>, tags: ARRAY<STRING>, attrs: MAP<STRING, INT>, `user-agent`: STRING>, s STRING"
)


@pytest.fixture(scope="module")
def schema(spark):
    return T.StructType.fromDDL(DDL)


def test_parse_path():
    assert parse_path("a.b") == (Step("a"), Step("b"))
    assert parse_path("a.items.name[12]") == (Step("a"), Step("items"), Step("name", (12,)))
    assert parse_path("a[1].b[2][3]") == (Step("a", (1,)), Step("b", (2, 3)))
    assert parse_path("a.`x.y`.user-agent") == (Step("a"), Step("x.y"), Step("user-agent"))


@pytest.mark.parametrize("bad", ["", "a.", ".a", "a..b", "a[x]", "a[1"])
def test_parse_path_rejects(bad):
    with pytest.raises(ValueError):
        parse_path(bad)


@pytest.mark.parametrize(
    "path, kind",
    [
        ("a.b.c", "string"),
        ("a.B.C", "string"),
        ("a.items.name", "array<string>"),
        ("a.items.name[3]", "string"),
        ("a.items.name[12]", "string"),
        ("a.items.deep.id", "array<int>"),
        ("a.items[0].deep.id", "int"),
        ("a.items.inner[0].z", "array<int>"),
        ("a.tags[0]", "string"),
        ("a.attrs.x", "int"),
        ("a.user-agent", "string"),
        ("a.nope", None),
        ("nope.b", None),
        ("s.x", None),
        ("s[0]", None),
        ("a.items.inner.z", None),
        ("a.tags.x", None),
    ],
)
def test_path_type(schema, path, kind):
    found = path_type(schema, path)
    assert (found and found.simpleString()) == kind
    assert has_path(schema, path) == (kind is not None)


def test_case_sensitive(schema):
    assert not has_path(schema, "a.B.c", case_sensitive=True)
    both = T.StructType.fromDDL("x INT, X STRING")
    assert path_type(both, "X") == T.StringType()


def test_path_column_agrees_with_path_type(any_ansi, schema):
    df = any_ansi.createDataFrame([], schema)
    for path in ["a.b.c", "a.items.name[3]", "a.items.deep.id", "a.items[0].deep.id", "a.items.inner[0].z",
                 "a.attrs.x", "a.user-agent"]:
        assert df.select(path_column(path).alias("x")).schema["x"].dataType == path_type(schema, path)


def test_with_paths(spark):
    base = T.StructType.fromDDL("a STRUCT<items: ARRAY<STRUCT<name: STRING>>, n: BIGINT>")
    wide = with_paths(base, ["a.items.value[1]", "a.new.leaf", "a.list[0]", "b", "a.n.x", "A.items.NAME"])
    assert wide.simpleString() == (
        "struct<a:struct<items:array<struct<name:string,value:string>>,n:bigint,"
        "new:struct<leaf:string>,list:array<string>>,b:string>"
    )


def test_only_paths(schema):
    kept = only_paths(schema, ["a.b", "A.items.NAME[3]", "a.items.deep.id", "a.attrs.x", "nope.x", "a.nope"])
    assert kept.simpleString() == (
        "struct<a:struct<b:struct<c:string>,items:array<struct<name:string,deep:struct<id:int>>>,attrs:map<string,int>>>"
    )
    assert only_paths(schema, ["s"]).simpleString() == "struct<s:string>"
    assert only_paths(schema, []).fields == []
