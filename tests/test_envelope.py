import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators.envelope import (
    infer_message_schema, parse_messages, payload_gate, split_root_arrays, strip_prefix,
)

EDGE = [
    '{"jsonPayload":{"a":1,"user-agent":"x","VARIANT":2},"c":[{"name":"n","v":1.5}],"d":null,"e":[],"f":{},"g":[{}],'
    '"h":12345678901234567890}',
    '{"jsonPayload":{"a":"s"},"c":[],"d":null,"i":1e10,"j":true,"k":3}',
    '{"k":2.5,"l":[1,"a"],"m":{"x":1}}',
    '{"m":"str"}',
    "bad {",
    '[{"k":1},{"k":2}]',
    "[]",
    "",
    '"text"',
    "{'single':1}",
    "{}",
    ' {"k":7}',
]


def frame(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_strip_prefix(any_ansi):
    rows = ['{"a":1}', 'ev:1\t{"a":{"b":1}}', 'a b {"a":1}', "no brace", "{", None, "ab{c{", 'é{"a":1}']
    got = [r[0] for r in strip_prefix(frame(any_ansi, rows)).collect()]
    assert got == ['{"a":1}', '{"a":{"b":1}}', 'a b {"a":1}', "no brace", "{", None, "{c{", 'é{"a":1}']


def assert_like_the_json_reader(spark, rows):
    """Same fields, types and rows as Spark's own reader, but for its column of broken text."""
    theirs = spark.read.json(spark.sparkContext.parallelize(rows, 1)).drop("_corrupt_record")
    text = split_root_arrays(frame(spark, rows))
    schema = infer_message_schema(text)
    assert {f.name: f.dataType for f in schema} == {f.name: f.dataType for f in theirs.schema}
    if theirs.columns:
        ours = parse_messages(text, schema).select(*[f"`{c}`" for c in theirs.columns])
        assert sorted(map(repr, ours.collect())) == sorted(map(repr, theirs.collect()))


@pytest.mark.parametrize("text", ['{"a": 1, "z": 2, "z": 3, "only": "x"}', '{"n": {"z": 1, "z": 2, "only": "x"}}'])
def test_repeated_keys_are_found(any_ansi, text):
    before = any_ansi.conf.get("spark.sql.variant.allowDuplicateKeys", None)
    for texts in ([text], ['{"a": 1}', text, "{broken", None]):
        df = any_ansi.createDataFrame([(t,) for t in texts], "value string")
        parsed = parse_messages(df, infer_message_schema(df)).selectExpr("to_json(struct(*)) AS j")
        assert any('"only":"x"' in row["j"] for row in parsed.collect())
    assert any_ansi.conf.get("spark.sql.variant.allowDuplicateKeys", None) == before


def test_inference_like_the_json_reader(any_ansi):
    assert_like_the_json_reader(any_ansi, EDGE)


@pytest.mark.parametrize(
    "rows",
    [
        ['{"a":3}', '{"a":3.0}', '{"b":[1.0, 2.0 ]}', '{"c":{"d":-0.0}}'],
        ['{"a":true}', '{"a":""}', '{ "b" : [ "" , 1 ] }', "{'c':''}", '{"d":""}'],
        ['{"a":"k:\\"\\","}', '{"b":": \'\' ,"}', '{"c":"1.0,"}'],
        ['{"a":1E5}', '{"b":1.0e5}', '{"c":0.10}', '{"d":1e400}', '{"e":99999999999999999999999999999999999999.5}'],
        ['{"a":9223372036854775807}', '{"a":9223372036854775808}', '{"b":9223372036854775808}', '{"b":1.0}'],
        ["\n\t {\"a\":1}", "\ufeff{\"b\":1}", " \n ", "\n[{\"a\":2}]"],
        ["[1,2]", '[{"a":1},2]', '[[{"a":1}]]', '[{"a":1},{"a":2}]', '{"a":3}', "[", "null", "1", "[null]"],
        ['{"a":NaN}', '{"a":01}', '{"a":+1}', '{"a":.5}', '{"a":1.}', '{"a":1,}', "{a:1}", '{"a":1} x', '{"a":1}{"a":"x"}'],
    ],
)
def test_awkward_texts_like_the_json_reader(spark, rows):
    assert_like_the_json_reader(spark, rows)


VALUES = st.recursive(
    st.none()
    | st.booleans()
    | st.sampled_from([0, 1, -5, 2**31, 10**18, 10**19, 10**37, 10**40, 1.5, 3.0, 1e10, -0.0, 1e300])
    | st.sampled_from(["", "x", "12", "1.0", 'é\n"', ":\"\","]),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from(["a", "b", "a-b", "x.y"]), inner, max_size=3),
    max_leaves=8,
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.sampled_from(["a", "b", "c"]), VALUES, max_size=3), min_size=1, max_size=5))
def test_any_objects_like_the_json_reader(spark, objects):
    assert_like_the_json_reader(spark, [json.dumps(o) for o in objects])


def test_inference_of_nothing(spark):
    assert infer_message_schema(frame(spark, ["bad", "", None, "[1]", "{}"])).fields == []
    assert infer_message_schema(frame(spark, [])).fields == []


def test_null_message_keeps_its_row(any_ansi):
    df = parse_messages(split_root_arrays(frame(any_ansi, [None, '{"a":1}'])), "a INT")
    assert sorted((r["a"] for r in df.collect()), key=str) == [1, None]


def test_parse_keeps_other_columns(spark):
    df = frame(spark, ['{"a":1}']).withColumn("clock", F.lit(5))
    assert parse_messages(df, "a INT").collect() == [(1, 5)]


def test_payload_gate(spark):
    df = parse_messages(frame(spark, ['{"p":{"a":1}}', '{"q":1}', "bad"]), "p STRUCT<a: INT>, q INT")
    assert payload_gate(df, "p").columns == ["p"]
    assert payload_gate(df, "p").filter("p IS NULL").count() == 2
    assert payload_gate(df, "P") is None
    assert payload_gate(df, "p", ("q",)).columns == ["p", "q"]
