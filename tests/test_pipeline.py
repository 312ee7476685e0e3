from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace import FieldPlan, FileSink, PipelineConfig, RoutePlan, run_batch, write_batch
from millrace.plans.pipeline import route_messages

FIELDS = (
    FieldPlan("p.id", "id", "Bigint"),
    FieldPlan("p.steps.name[3]", "step", "String"),
    FieldPlan("p.when", "fecha_hora_operacion", "Timestamp_2"),
    FieldPlan("p.text", "wide", "String"),
)
DDL = "p STRUCT<id: STRING, kind: STRING, when: STRING, text: STRING, steps: ARRAY<STRUCT<name: STRING>>>"
MESSAGES = [
    'x:1\t{"p":{"id":1,"kind":"a","when":"2020/05/06 02:00:00","text":"abcdefghij","steps":[{"name":"s"}]}}',
    '{"p":{"id":2,"kind":"b","when":"bad","steps":[{"name":"1"},{"name":"2"},{"name":"3"},{"name":"END"}]}}',
    '{"p":{"id":3,"kind":"a"}}',
    '{"q":1}',
    "broken {",
]


def plan(route, predicate, fields=FIELDS, table="t"):
    return RoutePlan(route, "S", predicate, "db", table, fields)


def config(**changes):
    base = dict(identifier="x", message_schema=DDL, payload_column="p", time_zone="America/Bogota")
    return PipelineConfig(**{**base, **changes})


@pytest.fixture()
def messages(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    return df.withColumn("at", F.lit(datetime(2020, 5, 6, 2, 0)))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("ddl", [DDL, None], ids=["declared", "inferred"])
@pytest.mark.parametrize("first", ["p.kind&a", "SELECT * FROM DataIN WHERE DataIN.p.kind = 'a'"])
def test_end_to_end(any_ansi, messages, ddl, first):
    frames = run_batch(
        messages, [plan("a", first), plan("end", "SELECT * FROM DataIN WHERE p.steps.name[3] = 'END'")],
        config(message_schema=ddl), "at")
    assert frames["a"].columns == ["id", "step", "fecha_hora_operacion", "wide", "fecha_hora_kudu", "periodo"]
    ingest = datetime(2020, 5, 5, 21, 0)
    assert rows(frames["a"]) == [
        (1, None, datetime(2020, 5, 5, 21, 0), "abcdefghij", ingest, 20200506),
        (3, None, None, None, ingest, 20200506)]
    assert rows(frames["end"]) == [(2, "END", None, None, ingest, 20200506)]


def test_split_in_pipeline(messages):
    settings = config(split_column="wide", split_capacity=5, split_names=("w0", "w1"), split_rest="more")
    out = run_batch(messages, [plan("a", "p.id&1")], settings, "at")["a"]
    assert out.columns[-3:] == ["w0", "w1", "more"] and "wide" not in out.columns
    assert tuple(out.first())[-3:] == ("abcd", "efgh", "ij")


def test_missing_path_in_the_whole_batch(messages):
    """Inferred mode: a path no message has, in a predicate and in the fields."""
    fields = (*FIELDS, FieldPlan("p.none.x[0]", "none", "Int"))
    routes = [plan("eq", "SELECT * FROM DataIN WHERE p.none.x[0] = 'v'", fields),
              plan("null", "p.none.x[0] IS NULL AND p.id = 2", fields)]
    frames = run_batch(messages, routes, config(message_schema=None), "at")
    assert frames["eq"].count() == 0 and frames["null"].count() == 1
    assert frames["null"].schema["none"].dataType.simpleString() == "int"
    omitted = run_batch(messages, routes, config(message_schema=None, missing="omit"), "at")
    assert "none" not in omitted["null"].columns and "step" in omitted["null"].columns


def test_no_payload_in_the_batch(spark):
    df = spark.createDataFrame([('{"other":1}',), ("bad",)], "value string")
    assert run_batch(df, [plan("a", "p.kind&a")], config(message_schema=None)) == {}
    empty = df.limit(0)
    assert run_batch(empty, [plan("a", "p.kind&a")], config(message_schema=None)) == {}


def test_whole_messages_without_a_payload(spark):
    df = spark.createDataFrame([('{"id":1,"kind":"a"}',), ('{"id":2,"kind":"b"}',)], "value string")
    route = plan("a", "SELECT * FROM DataIN WHERE kind = 'a'", (FieldPlan("id", "id", "Int"),))
    for ddl in ("id INT, kind STRING", None):
        out = run_batch(df, [route], config(payload_column=None, message_schema=ddl))["a"]
        assert [r["id"] for r in out.collect()] == [1]


@pytest.mark.parametrize("reuse", ["persist", "stage", "none"])
def test_write_batch(spark, messages, tmp_path, reuse):
    sink = FileSink(str(tmp_path))
    routes = [plan("a", "p.kind&a"), plan("b", "p.kind = 'b'"), plan("none", "p.kind&zz", table="u"),
              plan("sql", "SELECT p FROM DataIN WHERE p.id IN (SELECT max(p.id) FROM DataIN)", table="v")]
    reports = write_batch(messages, routes, config(reuse=reuse), sink, "at")
    assert [(r.route, r.rows, r.ok) for r in reports] == [("a", 2, True), ("b", 1, True), ("none", 0, True), ("sql", 1, True)]
    assert sink.read(spark, routes[0]).count() == 3
    assert sink.read(spark, routes[3]).select("id").first()[0] == 3
    assert not (tmp_path / "db" / "u").exists()
    assert (tmp_path / "db" / "t" / "periodo=20200506").exists()
    write_batch(messages, routes, config(reuse=reuse), sink, "at")
    assert sink.read(spark, routes[0]).count() == 6


def test_bad_routes_are_isolated(messages, tmp_path):
    routes = [plan("bad", "p.nope.x = 1"), plan("syntax", "p.kind = = 1"), plan("a", "p.kind&a"),
              plan("gone", "p.kind&a", (FieldPlan("p.not.there", "x"),))]
    with pytest.raises(ValueError, match="nope"):
        run_batch(messages, routes[:1], config())
    assert list(run_batch(messages, routes, config(on_error="skip", missing="omit"), "at")) == ["a"]
    reports = write_batch(
        messages, routes, config(on_error="skip", missing="omit"), FileSink(str(tmp_path)), "at")
    assert [(r.route, r.ok) for r in reports] == [("bad", False), ("syntax", False), ("a", True), ("gone", False)]
    with pytest.raises(RuntimeError, match="bad"):
        write_batch(messages, routes, config(), FileSink(str(tmp_path / "again")), "at")


def test_unmatched_payloads_are_not_held(messages):
    held = route_messages(messages, [plan("a", "p.id = 1")], config(), "at").hold()
    try:
        assert held.frame.filter("_slot_0 IS NOT NULL").count() == 1
        assert held.counts() == {"a": 1, "total": 5, "unmatched": 4}
    finally:
        held.release()


def test_config_checks():
    with pytest.raises(ValueError):
        config(missing="drop")
    with pytest.raises(ValueError):
        config(split_column="wide")
    with pytest.raises(ValueError):
        config(route_threads=0)


def test_only_wanted_fields_are_parsed(messages):
    routed = route_messages(messages, [plan("a", "p.kind&a", FIELDS[:1])], config(), "at")
    assert routed.frame.schema["p"].dataType.simpleString() == "struct<id:string,kind:string>"
    assert "when" in routed.known["p"].dataType.names
    everything = route_messages(messages, [plan("s", "SELECT p FROM DataIN", FIELDS[:1])], config(), "at")
    assert "when" in everything.frame.schema["p"].dataType.names


def test_field_names_that_are_sql_words(spark):
    df = spark.createDataFrame([('{"p":{"end":"x","id":1}}',)], "value string")
    route = plan("a", "SELECT * FROM DataIN WHERE p.end = 'x' AND size(p.list) = 2", FIELDS[:1])
    ddl = "p STRUCT<end: STRING, id: STRING, list: ARRAY<INT>, other: INT>"
    assert run_batch(df, [route], config(message_schema=ddl))["a"].count() == 0
    route = plan("a", "p.end = 'x' AND p.list IS NULL", FIELDS[:1])
    assert run_batch(df, [route], config(message_schema=ddl))["a"].count() == 1


def test_all_routes_of_a_batch_share_one_ingest_time(spark, messages, tmp_path):
    began, sink = datetime.now().astimezone(), FileSink(str(tmp_path))
    routes = [plan("a", "p.kind&a", table="a"), plan("b", "p.kind&b", table="b")]
    write_batch(messages.select("value"), routes, config(time_zone=None, reuse="none"), sink)
    times = {r[0] for p in routes for r in sink.read(spark, p).select("fecha_hora_kudu").collect()}
    assert len(times) == 1
    assert abs((times.pop().astimezone() - began).total_seconds()) < 60


@pytest.mark.parametrize("ddl", ["p STRUCT<id: INT, ID: STRING, kind: STRING>", None], ids=["declared", "inferred"])
def test_keys_that_differ_only_in_case(spark, ddl):
    """One message with odd keys must not stop a stream; the exact name wins."""
    rows = ['{"p":{"id":1,"kind":"a"}}', '{"p":{"ID":"x","Kind":"b","id":2,"kind":"a"},"P":1}']
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    out = run_batch(df, [plan("a", "p.kind = 'a'", FIELDS[:1])], config(message_schema=ddl))["a"]
    assert sorted(r["id"] for r in out.collect()) == [1, 2]


def test_no_routes_at_all(messages, tmp_path):
    assert write_batch(messages, [], config(), FileSink(str(tmp_path))) == []
